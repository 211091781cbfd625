"""DuckDB SQL with the rows of the queries that SQL can express. It is written on its own, not generated from the operators."""

from __future__ import annotations

ROUNDS = 20

_FLOW_ROUNDS = ",\n".join(
    f"""r{k} as materialized (
  select host, kind, sum(score) as score from (
    select host, kind, score from base
    union all
    select f.dst, f.kind, r.score * f.share * 0.85 from r{k - 1} r join flow f on r.host = f.src and r.kind = f.kind)
  group by host, kind)"""
    for k in range(1, ROUNDS + 1)
)

URL_SQL = rf"""
with parsed as (
  select page_id, html,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
ruled as (
  select *, case
    when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/' end as rule
  from parsed),
judged as (
  select *, case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow' end as own from ruled),
seeds as (
  select host, kind from (
    select host, avg((own is not distinct from 'allow')::int) as trust, avg((own is not distinct from 'block')::int) as distrust
    from judged where host <> '' group by host)
  unpivot (share for kind in (trust, distrust)) where share >= 0.5),
links as (
  select distinct page_id, host as src, unnest(list_distinct(list_transform(
    regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"''\s<>\\]+)', 1),
    lambda h: translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')))) as dst
  from judged where host <> ''),
edges as (select src, dst, count(*)::double as weight from links where src <> dst group by src, dst),
flow as materialized (
  select src, dst, 'trust' as kind, weight / sum(weight) over (partition by src) as share from edges
  union all
  select dst, src, 'distrust', weight / sum(weight) over (partition by dst) from edges),
base as materialized (select host, kind, 1.0::double * (1 - 0.85) as score from seeds),
r0 as materialized (select * from base),
{_FLOW_ROUNDS},
hosts as (
  select host, coalesce(sum(score) filter (kind = 'trust'), 0) as trust, coalesce(sum(score) filter (kind = 'distrust'), 0) as distrust
  from r{ROUNDS} group by host)
select page_id, judged.host as host, path, rule,
       coalesce(own, case when distrust >= 0.001 and distrust > 0.5 * (trust + distrust) then 'block' else 'allow' end) as verdict
from judged left join hosts on judged.host = hosts.host
"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {10 * k + 1}, 10))::bigint >> {35 - 5 * i}) & 31)::int + 1, 1)" for k in range(4) for i in range(8)
)

WARC_SQL = f"""
with sized as (select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as h from pages),
told as (select *, max(page_id) over (partition by h) as first_key from sized)
select page_id, payload_bytes, {_BASE32} as payload_digest,
       case when page_id is not distinct from first_key then 'response' else 'revisit' end as record_type,
       case when page_id is not distinct from first_key then null else first_key end as refers_to
from told
"""

_METRICS = {"symbols": "n_symbols * 1000 // n_words", "dup_lines": "n_dup_lines * 1000 // greatest(n_lines, 1)", "repeats": "n_repeat_words * 1000 // n_words", "word_length": "word_chars * 100 // n_words"}
_LEAST = {"symbols": 100, "dup_lines": 100, "repeats": 70, "word_length": 100}
_VALUES = " union all ".join(f"select lang, source, '{m}' as metric, {e} as value from measured where not base_failed" for m, e in _METRICS.items())
_TOPS = " and ".join(f"coalesce({e} <= top['{m}'], true)" for m, e in _METRICS.items())

QUALITY_SQL = rf"""
with docs as (
  select row_number() over () as row_id, doc_id, lang, source, coalesce(text, '') as text from documents),
split as (
  select *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') as words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines from docs),
windows as (
  select row_id, i, array_to_string(words[i:i + 4], chr(1)) as win from (select row_id, words, unnest(range(1, len(words) - 3)) as i from split where len(words) >= 5)),
twice as (select row_id, i from (select row_id, i, count(*) over (partition by row_id, win) as n from windows) where n > 1),
covered as (select row_id, count(distinct i + k) as n_repeat_words from twice, (select unnest(range(0, 5)) as k) group by row_id),
measured as (
  select s.row_id, doc_id, lang, source, len(words)::bigint as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols, len(lines)::bigint as n_lines,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
         len(words) < 10 or 100 * coalesce(n_repeat_words, 0) > 20 * len(words) as base_failed
  from split s left join covered c on s.row_id = c.row_id),
vals as ({_VALUES}),
buckets as (select lang, source, metric, case when value <= 0 then 0 else floor(ln(value::double) / ln(1.05::double)) + 1 end as b from vals),
sketch as (
  select lang, source, metric, b, count(*) as n, 0 as level from buckets group by all
  union all select lang, null, metric, b, count(*), 1 from buckets group by lang, metric, b
  union all select null, null, metric, b, count(*), 2 from buckets group by metric, b),
ranked as (
  select *, sum(n) over (partition by level, lang, source, metric order by b) as upto, sum(n) over (partition by level, lang, source, metric) as docs from sketch),
quantiles as (
  select level, lang, source, metric, max(docs) as docs, min(b) filter (upto >= docs * 0.25) as b_low, min(b) filter (upto >= docs * 0.75) as b_high from ranked group by level, lang, source, metric),
vals_q as (
  select *, case when b_low = 0 then 0 else floor(pow(1.05::double, b_low - 0.5)) end as low, case when b_high = 0 then 0 else floor(pow(1.05::double, b_high - 0.5)) end as high from quantiles),
fenced as (
  select level, lang, source, metric, docs, low - 3 * greatest(high - low, least_spread) as bottom, high + 3 * greatest(high - low, least_spread) as top
  from vals_q join (values {", ".join(f"('{m}', {v})" for m, v in _LEAST.items())}) as t(m, least_spread) on metric = m),
sets as (
  select level, lang, source, max(docs) as docs, map_from_entries(list((metric, top))) as top, max(bottom) filter (metric = 'word_length') as bottom from fenced group by level, lang, source),
picked as (
  select m.*, case when s0.docs >= 100 then s0.top when s1.docs >= 100 then s1.top else s2.top end as top,
         case when s0.docs >= 100 then s0.bottom when s1.docs >= 100 then s1.bottom else s2.bottom end as bottom
  from measured m
  left join sets s0 on s0.level = 0 and s0.lang is not distinct from m.lang and s0.source is not distinct from m.source
  left join sets s1 on s1.level = 1 and s1.lang is not distinct from m.lang
  left join sets s2 on s2.level = 2)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       case when base_failed then false else {_TOPS} and coalesce({_METRICS["word_length"]} >= bottom, true) end as kept
from picked
"""
