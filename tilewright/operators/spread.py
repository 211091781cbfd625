"""Joins that keep one hot key from landing in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tables of up to so many narrow rows are sent to every task.
SENT_ROWS = 1_000_000
#: Rows of one key that a task takes before the key is split.
ROWS_A_PART = 100_000


def spread_join(large: DataFrame, small: DataFrame, on: list[str], how: str = "left", most: int = SENT_ROWS, part_rows: int = ROWS_A_PART) -> DataFrame:
    """``large`` joined with ``small(on, ...)``, whose rows are narrow and at most one for each key; ``how`` is ``inner``, ``left`` or ``left_semi``.

    ``small`` is counted: up to ``most`` rows it is sent to all tasks and ``large`` isn't moved. Beyond that both sides are shuffled, with
    every key of over ``part_rows`` rows in ``large`` dealt to several tasks, each of which gets that key's row of ``small``. Null keys match nothing.
    """
    if small.count() <= most:
        return large.join(F.broadcast(small), on, how)
    hot = large.groupBy(*on).agg(F.count("*").alias("_rows")).where(F.col("_rows") > part_rows)
    hot = hot.select(*on, F.ceil(F.col("_rows") / part_rows).cast("int").alias("_parts"))  # at most the rows over part_rows
    if hot.count() > most:
        raise ValueError("more hot keys than can be sent: raise part_rows")
    salted = large.join(F.broadcast(hot), on, "left").withColumn("_part", F.when(F.col("_parts").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.col("_parts"))).otherwise(F.lit(0)).cast("int")).drop("_parts")
    copies = small.join(F.broadcast(hot), on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return salted.join(copies, [*on, "_part"], how).drop("_part")
