"""Sums over an order of all rows, without a task that holds them all.

Rows are dealt to ranges of the ordered value whose limits are literals (approximate quantiles, a fixed number of them). A running sum is the sum of the
lower ranges, of which there is one row each, plus a window within the own range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that an order is cut into.
RANGES = 64


def range_number(rows: DataFrame, value: str, ranges: int = RANGES) -> Column:
    """The range of a numeric column, ascending; null and NaN values are in the first and the last."""
    shares = [(k + 1) / ranges for k in range(ranges - 1)]
    limits = rows.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).agg(F.percentile_approx(F.col(value).cast("double"), shares, 10_000)).first()[0]
    above = [(F.col(value).cast("double") > limit).cast("int") for limit in sorted({*(limits or [])})]
    return F.coalesce(sum(above, F.lit(0)), F.lit(0))


def with_running_sums(rows: DataFrame, value: str, columns: list[str], ranges: int = RANGES) -> DataFrame:
    """``rows``, whose ``value`` is distinct, with ``run_<c>``, the sum up to and with this row by ascending value, and ``all_<c>``, the whole sum."""
    dealt = rows.withColumn("_range", range_number(rows, value, ranges))
    sums = dealt.groupBy("_range").agg(*[F.sum(c).alias(f"_s_{c}") for c in columns])
    below = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    every = Window.partitionBy()
    bases = sums.select("_range", *[F.coalesce(F.sum(f"_s_{c}").over(below), F.lit(0)).alias(f"_b_{c}") for c in columns], *[F.sum(f"_s_{c}").over(every).alias(f"all_{c}") for c in columns])
    within = Window.partitionBy("_range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    joined = dealt.join(F.broadcast(bases), "_range")
    out = joined.withColumns({f"run_{c}": F.col(f"_b_{c}") + F.sum(c).over(within) for c in columns})
    return out.drop("_range", *[f"_b_{c}" for c in columns])
