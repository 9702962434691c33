"""Input files with names of their own, as crawlers leave them behind."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regwise.operators.sequence import global_index


def name_files(spark: SparkSession, folder: str, to: str, name: Callable[[str, int], str]) -> str:
    """Move the part files of each ``column=value`` folder to ``to``, named by value and number; a file of that name is replaced."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root, target = hadoop.Path(folder), hadoop.Path(to)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    for status in fs.listStatus(root):
        if status.isDirectory():
            value = unquote(status.getPath().getName().partition("=")[2])
            parts = sorted((s.getPath() for s in fs.listStatus(status.getPath()) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
            for i, part in enumerate(parts):
                place = hadoop.Path(target, name(value, i))
                fs.delete(place, False)
                fs.rename(part, place)
    return to


def in_file_order(rows: DataFrame, to: str = "position") -> DataFrame:
    """Rows of a table of files with their position, file by file in the order of the names."""
    place = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    return global_index(rows.withColumn("_place", place), [F.col("_place")], to).drop("_place")
