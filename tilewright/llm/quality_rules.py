"""Quality rules whose cutoffs come from mergeable quantile sketches of each language and source. DataFrame operations only.

A sketch is a histogram over logarithmic buckets with relative width ``GAMMA``: counts of two sketches of the same metric add up, so
task, source and language levels merge exactly and in any order, and a quantile is off by that relative width at most.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.workspace import Workspace

#: White space of a word boundary, as a character class and as plain characters.
SPACE, SPACES = r"\x20\x09-\x0D", " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
GAMMA = 1.05
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Metrics that get fences: name -> (expression over the base columns, checks the upper side, checks the lower side, least spread).
METRICS = {
    "symbols": ("n_symbols * 1000 div greatest(n_words, 1)", True, False, 100),
    "dup_lines": ("n_dup_lines * 1000 div greatest(n_lines, 1)", True, False, 100),
    "repeats": ("n_repeat_words * 1000 div greatest(n_words, 1)", True, False, 70),
    "word_length": ("word_chars * 100 div greatest(n_words, 1)", True, True, 100),
}


@dataclass(frozen=True)
class Fences:
    """A document is out when a metric lies over ``high + reach * spread`` or under ``low - reach * spread``.

    ``low`` and ``high`` are the group's quantiles, ``spread`` their distance or the metric's least spread. A (language, source) group
    with fewer than ``least_docs`` documents takes its language's merged sketch, a small language that of all documents.
    """

    low: float = 0.25
    high: float = 0.75
    reach: float = 3.0
    least_docs: int = 100
    #: Fence tables of up to so many rows are sent to every task; larger ones are joined by a shuffle.
    broadcast_rows: int = 20_000


def word_array(text: Column) -> Column:
    """The runs of characters that aren't white space; an empty array for null or blank."""
    return F.coalesce(F.array_remove(F.split(text, f"[{SPACE}]+"), ""), F.array().cast("array<string>"))


def with_base_measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_lines`` and the five columns of :data:`BASE`, over the whole text; all zero for null, empty or blank text.

    Everything stays in the row. Rows in which the 64-bit hashes of two five-word windows agree sort the windows and compare those with equal
    hashes by their words; the usual row costs one hash a word. A very long text takes memory and time in proportion to it, but for
    the sort. The working columns start with ``_q_``.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    ws_free = F.translate(t, SPACES, "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    df = df.withColumns({
        "_q_words": word_array(t), "_q_lines": lines, "word_chars": F.length(ws_free).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
    })
    df = df.withColumn("n_words", F.size("_q_words").cast("long"))
    at = lambda i: F.get(F.col("_q_words"), i.cast("int"))
    window = lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2), at(i + 3), at(i + 4))
    hashes = F.when(F.col("n_words") >= 5, F.transform(F.sequence(F.lit(0), (F.col("n_words") - 5).cast("int")), window)).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumns({
        "n_lines": F.size("_q_lines").cast("long"), "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"), "_q_hash": hashes,
    })
    df = df.withColumn("_q_twice", F.size(F.array_distinct("_q_hash")) < F.size("_q_hash"))
    by_hash = F.array_sort(F.transform("_q_hash", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_q_sorted", F.when(F.col("_q_twice"), by_hash))
    near = lambda i: F.get(F.col("_q_sorted"), i)["h"]
    words_at = lambda i: F.concat_ws(" ", F.slice("_q_words", i + 1, F.lit(5)))  # noqa: E731  no word holds a space
    alike = F.array_compact(F.transform("_q_sorted", lambda x, i: F.when((near(i - 1) == x["h"]) | (near(i + 1) == x["h"]), F.struct(words_at(x["i"]).alias("w"), x["i"].alias("i")))))
    df = df.withColumn("_q_alike", F.array_sort(alike))
    beside = lambda i: F.get(F.col("_q_alike"), i)["w"]
    starts = F.sort_array(F.array_compact(F.transform("_q_alike", lambda x, i: F.when((beside(i - 1) == x["w"]) | (beside(i + 1) == x["w"]), x["i"]))))
    df = df.withColumn("_q_starts", starts)
    n = F.size("_q_starts")
    overlap = F.aggregate(
        F.zip_with(F.slice("_q_starts", F.lit(1), n - 1), F.slice("_q_starts", F.lit(2), n - 1), lambda a, b: F.greatest(F.lit(5) - (b - a), F.lit(0)).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x
    )
    df = df.withColumn("n_repeat_words", F.when(F.col("_q_twice"), 5 * n.cast("long") - overlap).otherwise(F.lit(0).cast("long")))
    return df.drop("_q_words", "_q_lines", "_q_hash", "_q_twice", "_q_sorted", "_q_alike", "_q_starts")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def bucket(x: Column) -> Column:
    """Bucket 0 holds 0; bucket b > 0 holds the whole numbers x with ``floor(ln x / ln GAMMA) = b - 1``."""
    return F.when(x <= 0, F.lit(0)).otherwise(F.floor(F.ln(x.cast("double")) / F.lit(math.log(GAMMA))) + 1).cast("int")


def bucket_value(b: Column) -> Column:
    """A whole number that stands for a bucket: its geometric middle."""
    return F.when(b == 0, F.lit(0)).otherwise(F.floor(F.pow(F.lit(GAMMA), b.cast("double") - F.lit(0.5)))).cast("long")


def sketches(measured: DataFrame) -> DataFrame:
    """``(lang, source, level, metric, bucket, n)``: the sketches of each source in a language, each language, and of all.

    Only documents that pass the base rules count. The first sum is partial in each task, and the upper levels add up the lower ones.
    """
    rows = measured.where(~base_failed()).select(
        "lang", "source", F.explode(F.create_map(*[x for m, (e, *_) in METRICS.items() for x in (F.lit(m), F.expr(e))])).alias("metric", "value")
    )
    source = rows.groupBy("lang", "source", "metric", bucket(F.col("value")).alias("bucket")).agg(F.count("*").alias("n")).withColumn("level", F.lit(0))
    language = source.groupBy("lang", "metric", "bucket").agg(F.sum("n").alias("n")).withColumns({"source": F.lit(None).cast("string"), "level": F.lit(1)})
    everything = language.groupBy("metric", "bucket").agg(F.sum("n").alias("n")).withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"), "level": F.lit(2)})
    return source.unionByName(language).unionByName(everything)


def sketch_quantiles(sketch: DataFrame, how: Fences) -> DataFrame:
    """``(level, lang, source, metric, docs, low, high)``; a window holds one sketch, some hundred buckets at most."""
    group = ["level", "lang", "source", "metric"]
    w = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketch.withColumns({"upto": F.sum("n").over(w), "docs": F.sum("n").over(Window.partitionBy(*group))})
    at = lambda q: bucket_value(F.min(F.when(F.col("upto") >= F.col("docs") * q, F.col("bucket"))))
    return ranked.groupBy(*group).agg(F.max("docs").alias("docs"), at(how.low).alias("low"), at(how.high).alias("high"))


def fence_table(ws: Workspace, measured: DataFrame, how: Fences) -> DataFrame:
    """One row for each (lang, source) with columns ``<metric>_top`` and, for two-sided metrics, ``<metric>_bottom``."""
    found = ws.save(sketch_quantiles(ws.save(sketches(measured), "sketches"), how), "quantiles")
    wide = {}
    for level, keys in ((0, ["lang", "source"]), (1, ["lang"]), (2, [])):
        picks = []
        for metric, (_, _, lower, least) in METRICS.items():
            mine = F.col("metric") == metric
            spread = how.reach * F.greatest(F.col("high") - F.col("low"), F.lit(least))
            picks.append(F.max(F.when(mine, F.col("high") + spread)).alias(f"{metric}_top"))
            if lower:
                picks.append(F.max(F.when(mine, F.col("low") - spread)).alias(f"{metric}_bottom"))
        wide[level] = found.where(F.col("level") == level).groupBy(*keys).agg(F.max("docs").alias("docs"), *picks)
    names = [c for c in wide[2].columns if c != "docs"]
    renamed = {k: df.select(*[F.col(c).alias(f"k{k}_{c}") for c in df.columns]) for k, df in wide.items()}
    groups = measured.select("lang", "source").distinct()
    joined = (
        groups.join(renamed[0], F.col("lang").eqNullSafe(F.col("k0_lang")) & F.col("source").eqNullSafe(F.col("k0_source")), "left")
        .join(renamed[1], F.col("lang").eqNullSafe(F.col("k1_lang")), "left")
        .join(F.broadcast(renamed[2]), F.lit(True), "left")  # one row
    )
    enough = lambda k: F.coalesce(F.col(f"k{k}_docs"), F.lit(0)) >= how.least_docs
    pick = lambda c: F.when(enough(0), F.col(f"k0_{c}")).when(enough(1), F.col(f"k1_{c}")).otherwise(F.col(f"k2_{c}")).alias(c)
    return joined.select(F.col("lang").alias("f_lang"), F.col("source").alias("f_source"), *map(pick, names))


def within_fences() -> Column:
    """True where no metric lies outside its fence; a fence that no document set lets everything pass."""
    ok = F.lit(True)
    for metric, (expression, upper, lower, _) in METRICS.items():
        if upper:
            ok = ok & F.coalesce(F.expr(expression) <= F.col(f"{metric}_top"), F.lit(True))
        if lower:
            ok = ok & F.coalesce(F.expr(expression) >= F.col(f"{metric}_bottom"), F.lit(True))
    return ok


def _judge(ws: Workspace, measured: DataFrame, fences: DataFrame, how: Fences) -> DataFrame:
    small = fences.count() <= how.broadcast_rows
    same = F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source"))
    judged = measured.join(F.broadcast(fences) if small else fences, same, "left").withColumn("base_failed", base_failed())
    # One sum, not a conjunction: parts of a filter on it would else be evaluated again below the join, with all that they are measured from.
    return judged.withColumn("kept", F.col("base_failed").cast("int") + (~within_fences()).cast("int") == 0)


def _held(docs: DataFrame, carry: list[str], text: str) -> DataFrame:
    """The carried columns as ``_c<i>`` beside ``lang``, ``source`` and the text as ``_q_text``."""
    return docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)], F.col("lang").alias("lang"), F.col("source").alias("source"), F.col(text).alias("_q_text"))


def quality_verdicts(docs: DataFrame, carry: list[str], how: Fences = Fences(), text: str = "text") -> DataFrame:
    """The columns ``carry`` and :data:`BASE`, ``base_failed``, ``kept``: a row for each row of ``docs``, which needs ``lang`` and ``source``.

    ``kept`` is false where a base rule fails, else true where every metric lies within the fences of the row's language and source; a
    value on a fence is within. Null, empty or blank text has no words and fails. A null language or source is a group of its own. Repeated rows
    each count and come back; an empty table gives an empty one. Texts are measured whole, however long. Carried columns go through as
    ``_c<i>``, so their names can't clash.
    """
    ws = Workspace(docs.sparkSession, "quality")
    measured = ws.save(with_base_measures(_held(docs, carry, text), "_q_text").drop("_q_text"), "measured")
    judged = _judge(ws, measured, ws.save(fence_table(ws, measured, how), "fences"), how)
    return judged.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], *BASE, "base_failed", "kept")


def keep_good(docs: DataFrame, how: Fences = Fences(), text: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`quality_verdicts` keeps, with all their columns in order, whatever their names.

    Texts are measured twice, for the sketches and for the verdict, so that no second copy of them is ever written.
    """
    ws, names = Workspace(docs.sparkSession, "quality"), docs.columns
    measured = ws.save(with_base_measures(_held(docs, [], text), "_q_text").drop("_q_text"), "measured")
    fences = ws.save(fence_table(ws, measured, how), "fences")
    ws.keep("fences")
    judged = _judge(ws, with_base_measures(_held(docs, names, text), "_q_text"), fences, how)
    return judged.where("kept").select(*[F.col(f"_c{i}") for i in range(len(names))]).toDF(*names)
