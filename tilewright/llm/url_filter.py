"""URL filters by rules and by trust that flows over the link graph between hosts. DataFrame operations only.

Rules judge a url directly. A host that no rule reaches is judged by two personalised PageRanks over host edges: trust starts at
hosts whose pages rules allow and follows links; distrust starts at hosts whose pages rules block and goes against the links, so
that it reaches who links to them. Seeds, thresholds and scores are all per host.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.operators.spread import ROWS_A_PART, SENT_ROWS, spread_join
from tilewright.workspace import Workspace

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST_PATTERN, PATH_PATTERN = r"(?s)^.*?://([^/?#]*)", r"(?s)^.*?://[^/?#]*([^?#]*)"
#: An anchor's absolute or protocol-relative target: group 1 is the host with its port, group 0 of a relative link doesn't match.
LINK_PATTERN = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s<>\\]+)"""


@dataclass(frozen=True)
class Rule:
    """``net/`` or ``example.net/en/``: fits the host and its subdomains where the url's path starts with the rule's path."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


@dataclass(frozen=True)
class Propagation:
    """``rounds`` of PageRank with ``damping``; seeds are hosts of whose pages rules allow, or block, ``seed_share`` or more.

    A host is blocked when its distrust is ``least_distrust`` or more and over ``block_share`` of its trust plus distrust.
    """

    rounds: int = 20
    damping: float = 0.85
    seed_share: float = 0.5
    block_share: float = 0.5
    least_distrust: float = 0.001
    #: Rounds between two tables that cut the lineage.
    save_every: int = 5


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for null or without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, HOST_PATTERN, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, PATH_PATTERN, 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct ``(text, verdict)`` of the longest rule that fits, else null; of equal texts the first given.

    The list is a parameter of the job. It becomes one ``CASE`` evaluated where the row is, without a join.
    """
    found = None
    for rule in sorted(rules, key=lambda r: -len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return F.lit(None).cast("struct<text:string,verdict:string>") if found is None else found


def host_edges(pages: DataFrame, html: str = "html") -> DataFrame:
    """``(src, dst, weight)``: on how many pages of ``src`` (column ``host``) is a link to another host ``dst``."""
    targets = F.array_distinct(F.transform(F.regexp_extract_all(F.col(html), F.lit(LINK_PATTERN), F.lit(1)), lambda h: F.translate(h, UPPER, LOWER)))
    linked = pages.where(F.col(html).contains("//") & (F.col("host") != "")).select(F.col("host").alias("src"), F.explode(targets).alias("dst"))
    return linked.where("src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def propagate(ws: Workspace, seeds: DataFrame, edges: DataFrame, how: Propagation) -> DataFrame:
    """``(host, kind, score)`` after ``how.rounds`` rounds, from ``seeds(host, kind, seed)``; kind is ``trust`` or ``distrust``.

    A round is ``(1 - damping) * seed + damping * inflow``; what a host without outgoing links holds isn't sent on. Distrust uses the
    reversed edges. The flow table is written once; partial sums precede each shuffle, so a hub costs one row a task. Scores are sent to
    all tasks where hosts are few; else a hub's links are dealt to several tasks.
    """
    out_w = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    in_w = edges.groupBy("dst").agg(F.sum("weight").alias("total"))
    trust = spread_join(edges, out_w, ["src"], "inner").select(F.col("src").alias("host"), F.col("dst").alias("to"), F.lit("trust").alias("kind"), (F.col("weight") / F.col("total")).alias("share"))
    distrust = spread_join(edges, in_w, ["dst"], "inner").select(F.col("dst").alias("host"), F.col("src").alias("to"), F.lit("distrust").alias("kind"), (F.col("weight") / F.col("total")).alias("share"))
    flow = ws.save(trust.union(distrust), "flow")
    base = seeds.select("host", "kind", (F.col("seed") * (1 - how.damping)).alias("score"))
    if flow.isEmpty():  # no link between hosts: every round gives the seeds again
        return base
    base = ws.save(base, "base")
    few = base.select("host").union(flow.select("host")).distinct().count() * 2 <= SENT_ROWS
    hubs = flow.groupBy("host", "kind").agg(F.ceil(F.count("*") / ROWS_A_PART).cast("int").alias("parts")).where("parts > 1")
    if not few:  # the links of a hub are dealt to several tasks, each of which gets its score
        hubs = ws.save(hubs, "hubs")
        flow = spread_join(flow, hubs, ["host", "kind"], "left")
        flow = ws.save(flow.withColumn("part", F.pmod(F.xxhash64("to"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts"), "dealt")
    scores, last = base, None
    for k in range(1, how.rounds + 1):
        if few:
            met = flow.join(F.broadcast(scores), ["host", "kind"])
        else:
            parts = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
            met = flow.join(scores.join(F.broadcast(hubs), ["host", "kind"], "left").withColumn("part", parts).drop("parts"), ["host", "kind", "part"])
        sent = met.select(F.col("to").alias("host"), "kind", (F.col("score") * F.col("share") * how.damping).alias("score"))
        scores = base.union(sent).groupBy("host", "kind").agg(F.sum("score").alias("score"))
        if k % how.save_every == 0 and k < how.rounds:
            scores = ws.save(scores, f"scores-{k}")
            if last:
                ws.drop(last)
            last = f"scores-{k}"
    return scores


def filter_urls(pages: DataFrame, rules: list[Rule], how: Propagation = Propagation(), url: str = "url", html: str = "html", key: str = "page_id") -> DataFrame:
    """``(key, host, path, rule, verdict, trust, distrust)``, a row for each row of ``pages``.

    ``rule`` is the text of the longest rule that fits, else null. ``verdict`` is that rule's; without one it is ``block`` if the
    host's scores say so (:class:`Propagation`), else ``allow``. A null url, or one without ``://``, has an empty host,
    which has no links and no seeds: ``allow`` unless a rule fits. Null or empty html has no links; a very long one is searched whole, in its
    row. A host on a threshold counts as over it where that is a least value, and as under it where it is a share of trust and distrust.
    Repeated rows each count and each come back; an empty table gives an empty one. Columns beyond the three named are left out, so their names can't clash.
    """
    judged = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))
    judged = judged.select("key", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), "html")
    judged = judged.withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules))
    ws = Workspace(pages.sparkSession, "url")
    counts = judged.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("n"), F.count_if(F.col("fit.verdict") == "allow").alias("allowed"), F.count_if(F.col("fit.verdict") == "block").alias("blocked")
    )
    seeds = counts.select("host", F.explode(F.create_map(F.lit("trust"), F.col("allowed") / F.col("n"), F.lit("distrust"), F.col("blocked") / F.col("n"))).alias("kind", "share"))
    seeds = seeds.where(F.col("share") >= how.seed_share).select("host", "kind", F.lit(1.0).alias("seed"))
    edges = ws.save(host_edges(judged, "html"), "edges")
    scores = propagate(ws, seeds, edges, how)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
    hosts = scores.groupBy("host").agg(of("trust"), of("distrust"))
    both = spread_join(judged.drop("html"), ws.save(hosts, "hosts"), ["host"], "left").na.fill(0.0, ["trust", "distrust"])
    flows = F.when((F.col("distrust") >= how.least_distrust) & (F.col("distrust") > how.block_share * (F.col("trust") + F.col("distrust"))), "block").otherwise("allow")
    return both.select(
        F.col("key").alias(key), "host", "path", F.col("fit.text").alias("rule"), F.coalesce(F.col("fit.verdict"), flows).alias("verdict"), "trust", "distrust"
    )
