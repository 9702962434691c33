"""Session helpers: durable cuts of a plan and size-checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A place dictionary of a whole country stays below these sizes; a frame above
# the bound is joined by shuffle instead.
SMALL_ROWS = 20_000
# Names the shared folder where the cluster's own setting is absent; entry
# points of local runs set it.
SHARED = "spark.regwise.shared.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder of this run for written intermediates, which all executors share.

    ``spark.checkpoint.dir`` names its parent, else ``spark.regwise.shared.dir``.
    Without either there is no safe place, and this raises.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SHARED, None)
    if not named:
        raise RuntimeError(f"set spark.checkpoint.dir or {SHARED} to a folder that all executors share")
    return f"{named.rstrip('/')}/regwise-{spark.sparkContext.applicationId}"


def remove_shared(spark: SparkSession) -> None:
    """Delete the folder of this run; nothing that reads from it works afterwards."""
    place = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the table.

    Used where one reduced result feeds several branches, so that the large
    input is scanned once and a lost executor never costs the whole lineage.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Broadcast ``df`` only when it is proven to hold at most ``max_rows`` rows.

    Above the bound the frame is returned as it is, and Spark joins it by
    shuffle (adaptive execution splits skewed partitions).
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns behind a generator, so that later filters do not repeat them.

    Filters are pushed below a projection together with the expressions they
    use; they stay above ``inline``.
    """
    row = F.struct(*[e.alias(name) for name, e in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def settled(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with its own costly columns computed once, however often the steps after it use them."""
    return once(df.withColumnsRenamed({n: f"_{n}" for n in names}), **{n: F.col(f"_{n}") for n in names}).select(*df.columns)
