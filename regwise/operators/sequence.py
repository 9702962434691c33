"""Dense numbering, forward fill and runs over a global order.

A window without partitions would pull all rows into one task. Here rows are
range-partitioned by the order, each range is numbered on its own, and only
one summary row per range is combined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regwise.session import durable, small


def _ranges(df: DataFrame, order, label: str) -> DataFrame:
    """``df`` with its range number, written so that the ranges stay fixed."""
    return durable(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), label)


def global_index(df: DataFrame, order: list[Column], to: str = "idx") -> DataFrame:
    """Add a dense 0-based position in ``order`` (make the order total with a unique last key)."""
    ranged = _ranges(df, order, "ranges")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_range").orderBy(*order)
    return (ranged.join(small(starts), "_range")
            .withColumn(to, (F.col("_start") + F.row_number().over(within) - 1).cast("long"))
            .drop("_range", "_start"))


def index_within(df: DataFrame, keys: list[str], order: list[Column], to: str = "seq") -> DataFrame:
    """Add the 1-based position inside each key group, however large the group is.

    Rows are written once, in ranges of keys and order. A group that goes on
    from an earlier range starts after the rows it has there; such groups are
    at most one per range.
    """
    ranged = _ranges(df, [*[F.col(k) for k in keys], *order], "ranges")
    sizes = ranged.groupBy("_range", *keys).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per group and range
    ahead = sizes.withColumn("_ahead", F.sum("_n").over(earlier)).filter("_ahead IS NOT NULL")
    ahead = ahead.select(F.col("_range").alias("_r"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_ahead")
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    within = Window.partitionBy("_range", *keys).orderBy(*order)
    return (ranged.join(small(ahead), same, "left")
            .withColumn(to, (F.coalesce("_ahead", F.lit(0)) + F.row_number().over(within)).cast("long"))
            .drop("_range", "_r", "_ahead", *[f"_k{i}" for i in range(len(keys))]))


def forward_fill(df: DataFrame, order: list[Column], column: str, to: str | None = None) -> DataFrame:
    """Replace blank cells by the last non-blank cell above."""
    ranged = _ranges(df, order, "fill")
    filled = F.nullif(F.col(column), F.lit(""))
    key = F.struct(*order).alias("_k")
    tails = ranged.filter(filled.isNotNull()).groupBy("_range").agg(F.max_by(column, key).alias("_tail"))
    all_ranges = ranged.select("_range").distinct().join(tails, "_range", "left")
    above = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    carried = all_ranges.select("_range", F.last("_tail", ignorenulls=True).over(above).alias("_carry"))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (ranged.join(small(carried), "_range")
            .withColumn(to or column, F.coalesce(F.last(filled, ignorenulls=True).over(within), F.col("_carry"), F.lit("")))
            .drop("_range", "_carry"))


def runs(df: DataFrame, number: str) -> DataFrame:
    """Merge consecutive distinct numbers into (first, last, size) runs."""
    placed = global_index(df.select(number).distinct(), [F.col(number)], "_idx")
    return (placed.groupBy((F.col(number) - F.col("_idx")).alias("_island"))
            .agg(F.min(number).alias("first"), F.max(number).alias("last"), F.count(F.lit(1)).alias("size")).drop("_island"))
