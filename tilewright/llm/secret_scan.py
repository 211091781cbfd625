"""Secret scans: fixed patterns, and assignments read by a lexer for source and configuration syntax.

The lexer turns a text into name-literal pairs: quoted and triple-quoted literals, literals that are put together by ``+`` or by standing side
by side, bare values, element contents, and the indented lines of a block scalar. A name that is assigned another name takes over its literals, so ``x = "..."`` and
``db_password = x`` give a pair of ``db_password`` and that literal. A literal is scored by the most sensitive word of its
target names and by how much it looks like a credential.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.arrow_rows import with_made

#: Kinds in the order in which spans with equal starts are listed.
KINDS = ("assign", "access", "hex", "named")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f] that have 24 characters

#: Words of a target name and their weights; compound words are compared without separators.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.8, "apikey": 1.0, "accesskey": 1.0,
    "privatekey": 1.0, "secretkey": 1.0, "encryptionkey": 1.0, "signingkey": 1.0, "credential": 0.9, "credentials": 0.9, "authkey": 0.9, "clientsecret": 1.0,
}
#: Every sensitive name contains one of these, in any case and without separators; a text with none has no pair to report.
STEMS = ("passw", "passphrase", "pwd", "secret", "token", "key", "credential")
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|changeme|example|placeholder|none|null|true|false|todo|your[_-].*|<.*>|\$\{.*\}|\{\{.*\}\})$")

NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*"
#: One token: a quoted literal (escapes allowed; over several lines if the quote is tripled), an element with its content, a name, an assignment sign, +, a line break that goes on, a line end, or what ends an expression.
LEX = re.compile(
    rf"""(?P<triple>\"\"\"(?s:[^\\]|\\.)*?\"\"\"|'''(?s:[^\\]|\\.)*?''')|(?P<quoted>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|(?P<tag><(?P<open>{NAME})>(?P<inner>[^<>\n]*)</(?P=open)>)|(?P<name>{NAME})|(?P<sign>:=|=>|==|!=|<=|>=|=|:)|(?P<plus>\+)|(?P<skip>\\\n)|(?P<end>\n|;)|(?P<other>\S)""",
    re.ASCII,
)
#: A value without quotes; = only at its end, as in base64.
BARE = re.compile(r"[A-Za-z0-9+/_.~!@%^&*-]{6,}={0,2}")
BLANKS = re.compile(r"[ \t]*")
#: What follows the sign of a block scalar up to the end of the line, and a line with its indentation.
BLOCK = re.compile(r"[ \t]*[|>][0-9+-]{0,2}[ \t]*\n")
LINE = re.compile(r"([ \t]*)([^\n]*)\n?")
Span = tuple[int, int]


@dataclass(frozen=True)
class Scan:
    """``least_score`` of a named literal and ``least_length`` of its characters."""

    least_score: float = 0.6
    least_length: int = 8


def name_weight(name: str) -> float:
    """Weight of the most sensitive word, or two neighbouring words, of an identifier in snake, kebab, dotted or camel case."""
    words = [w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", name)]
    return max((SENSITIVE.get(w, 0.0) for w in words + [a + b for a, b in zip(words, words[1:])] + [a + b + c for a, b, c in zip(words, words[1:], words[2:])]), default=0.0)


def literal_strength(value: str) -> float:
    """0 for placeholders and plain words, up to 1: entropy per character and number of character classes."""
    if not value or PLACEHOLDER.match(value) or re.search(r"\s", value):
        return 0.0
    n, counts = len(value), Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, entropy / 4.0) * (0.5 if classes == 1 else 0.9 if classes == 2 else 1.0)


def block_lines(text: str, key: int, at: int) -> tuple[list[Span], int]:
    """The lines of a block scalar whose key stands at ``key`` and whose first line begins at ``at``, and where it ends.

    Lines belong to it that are blank or indented deeper than the line of the key.
    """
    begin = text.rfind("\n", 0, key) + 1
    depth, lines = BLANKS.match(text, begin).end() - begin, []
    while at < len(text):
        m = LINE.match(text, at)
        if m[2].strip() and len(m[1]) <= depth:
            break
        if m[2].strip():
            lines.append((m.start(2), m.start(2) + len(m[2].rstrip())))
        at = m.end()
    return lines, at


def line_spans(text: str, start: int, end: int) -> list[Span]:
    """The lines of a stretch without the blanks round them; none for blank lines."""
    return [m.span() for m in re.compile(r"\S(?:[^\n]*\S)?").finditer(text, start, end)]


def name_literal_pairs(text: str) -> tuple[dict[str, list[list[Span]]], list[tuple[str, str]]]:
    """Literals by name, each the spans of its parts, and pairs of a name and the name that it is assigned."""
    literals: dict[str, list[list[Span]]] = {}
    links: list[tuple[str, str]] = []
    # open_: the target takes operands now; beside: the literal that a next one may stand beside; depth: brackets round the operands
    target, last, last_at, open_, beside, depth = None, None, 0, False, None, 0
    at = 0
    while m := LEX.search(text, at):
        at = m.end()
        kind = "tag" if m.lastgroup in ("tag", "open", "inner") else m.lastgroup
        if kind == "tag":
            literals.setdefault(m.group("open"), []).append([m.span("inner")])
            target = last = beside = None
        elif kind == "sign":
            beside = None
            if m.group() in ("==", "!=", "<=", ">=") or last is None:
                target = last = None
                continue
            target, last, open_, depth = last, None, True, 0
            if block := BLOCK.match(text, at):
                lines, at = block_lines(text, last_at, block.end())
                if lines:
                    literals.setdefault(target, []).append(lines)
                target = None
                continue
            bare = BARE.match(text, BLANKS.match(text, at).end())
            if bare and re.search("[0-9]", bare.group()) and not re.fullmatch(r"[0-9.]+", bare.group()):
                literals.setdefault(target, []).append([bare.span()])
        elif kind in ("quoted", "triple"):
            span = m.start() + 1, m.end() - 1
            parts = line_spans(text, m.start() + 3, m.end() - 3) if kind == "triple" else [span]
            if target and open_ and beside is None:
                beside = parts
                literals.setdefault(target, []).append(beside)
            elif target and beside is not None:
                beside += parts
            last, last_at, open_ = text[slice(*span)] if re.fullmatch(NAME, text[slice(*span)], re.ASCII) else None, m.start(), False
        elif kind == "name":
            if target and open_:
                links.append((target, m.group()))
            last, last_at, open_ = m.group(), m.start(), False
            if beside is not None:
                target = beside = None
        elif kind == "plus":
            open_ = target is not None
        elif kind == "end":
            if depth and m.group() == "\n":
                continue
            target = last = beside = None
            open_, depth = False, 0
        elif m.group() == "(" and target and open_:
            depth += 1
        elif m.group() == ")" and target and depth:
            depth -= 1
        elif m.group() in ",)}]{[(":
            target = last = beside = None
            open_, depth = False, 0
    return literals, links


def named_spans(text: str, how: Scan = Scan()) -> list[tuple[int, int]]:
    """Spans of literals that reach ``how.least_score`` under their own or a propagated target name."""
    low = text.lower()
    if not any(s in low for s in STEMS):
        low = low.replace("_", "").replace("-", "").replace(".", "")  # names are weighed without their separators
        if not any(s in low for s in STEMS):
            return []
    literals, links = name_literal_pairs(text)
    weight = {name: name_weight(name) for name in {*literals, *(a for a, _ in links), *(b for _, b in links)}}
    sources: dict[str, list[str]] = {}
    for name, source in links:
        sources.setdefault(name, []).append(source)
    done = set()
    for name in sorted(sources, key=weight.__getitem__, reverse=True):  # what a sensitive name is assigned becomes as sensitive, over any number of hops
        open_, top = [name], weight[name]
        while open_:
            name = open_.pop()
            if name not in done:  # the heaviest name that reaches it came first
                done.add(name)
                weight[name] = max(weight[name], top)
                open_ += sources.get(name, ())
    found = set()
    for name, parts in literals.items():
        if weight[name]:
            strong = lambda value: len(value) >= how.least_length and weight[name] * literal_strength(value) >= how.least_score  # noqa: B023, E731
            for spans in parts:
                if len(spans) > 1 and strong("".join(text[a:b] for a, b in spans)):
                    found.update((a, b) for a, b in spans if a < b)
                else:
                    found.update((a, b) for a, b in spans if strong(text[a:b]))
    return sorted(found)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the fixed patterns, leftmost and without overlap within each kind."""
    low = text.lower()
    found = []
    if any(s in low for s in ("passw", "secret", "token", "api")):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def all_spans(text: str, how: Scan = Scan()) -> list[tuple[int, int, str]]:
    """Fixed and named spans by start, then kind as in :data:`KINDS`."""
    found = base_spans(text) + [(s, e, "named") for s, e in named_spans(text, how)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def join_spans(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact(text: str, spans: list[tuple[int, int, str]], mark: str = "<secret>") -> str:
    """``text`` with each maximal covered stretch replaced by ``mark``."""
    out, at = [], 0
    for start, end, _ in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, carry: list[str], text: str = "text", how: Scan = Scan()) -> DataFrame:
    """The columns ``carry`` and ``secret_spans array<struct<start, end, kind>>`` (code points, end exclusive), a row for each row.

    Null and empty texts have no spans. Texts are scanned whole, in time about in proportion to their length; a row depends on itself only,
    so skew, repeated rows and empty tables need nothing special. Spans with one start are listed by kind as in :data:`KINDS`, then by end.
    Carried columns go through unchanged, by place, so their names can't clash.
    """

    def start():
        return lambda texts: [[[{"start": s, "end": e, "kind": k} for s, e, k in all_spans(t, how)] if t else [] for t in texts]]

    return with_made(docs, carry, [docs[text]], "secret_spans array<struct<start:int,end:int,kind:string>>", start)


def redact_secrets(docs: DataFrame, text: str = "text", how: Scan = Scan(), mark: str = "<secret>", length: str | None = None) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mark``; ``length``: a column that holds the number of code points.

    All columns come back in order, the others unchanged. Null stays null and empty stays empty; repeated rows each come back. ``length`` is
    written where the text changes only.
    """
    names = docs.columns
    held = docs.toDF(*[f"_c{i}" for i in range(len(names))])

    def start():
        def make(texts):
            new = [redact(t, s, mark) if t and (s := all_spans(t, how)) else None for t in texts]
            return [new, [None if t is None else len(t) for t in new]]

        return make

    out = with_made(held, held.columns, [held[f"_c{names.index(text)}"]], "_new string, _length long", start)
    replaced = {names.index(text): F.col("_new")}
    if length:
        replaced[names.index(length)] = F.col("_length").cast(docs.schema[length].dataType)
    return out.select(*[F.coalesce(replaced[i], F.col(f"_c{i}")).alias(f"_c{i}") if i in replaced else F.col(f"_c{i}") for i in range(len(names))]).toDF(*names)


def span_digests(docs: DataFrame, carry: list[str], text: str = "text", how: Scan = Scan()) -> DataFrame:
    """The columns ``carry``, counts of the fixed kinds, ``base_sha256`` of the fixed spans and ``spans`` of all, as joined text."""
    held = docs.select(*[docs[f"`{c}`"].alias(f"_k{i}") for i, c in enumerate(carry)], docs[text].alias("_text"))
    found = scan_secrets(held, held.columns[:-1], "_text", how)
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("secret_spans", lambda s: s["kind"] != "named")
    kept = [F.col(f"_k{i}").alias(c) for i, c in enumerate(carry)]
    return found.select(*kept, of("assign"), of("access"), of("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secret_spans")).alias("spans"))
