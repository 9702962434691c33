"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import inspect
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regwise.session import scratch_path

# texts handed to one numpy pass; a longer single text forms a pass of its own
PASS_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` as long and ``text`` without nulls; other columns play no part."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def free(name: str, df: DataFrame) -> str:
    """``name``, or a longer one where the frame has a column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Cut:
    """A frame written once to the shared folder, in folders ``by`` columns if named; ``drop`` removes the files."""

    def __init__(self, df: DataFrame, label: str, *by: str):
        self.spark, self.path = df.sparkSession, scratch_path(df.sparkSession, label)
        df.write.parquet(self.path, partitionBy=list(by) or None)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(self.path)
        place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def passes(batches: Iterator[pa.RecordBatch], column: int = 1, most: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of text, so that memory does not follow the row count."""
    for batch in batches:
        start = size = 0
        for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
            size += n or 0
            if size >= most:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def text_bytes(batch: pa.RecordBatch, column: int = 1) -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


_HELD: dict[str, Callable[[], None]] = {}  # module: forgets what it keeps in a worker from task to task


def forgets(module: str, clear: Callable[[], None]) -> None:
    _HELD[module] = clear


def _free_others(module: str) -> None:
    """What other modules keep goes: a worker holds the memories of one operator at a time."""
    others = [m for m in _HELD if m != module]
    for m in others:
        _HELD[m]()
    if others:
        _give_back()


def lean(work: Callable) -> Callable:
    """``work`` of a task, after which freed memory goes back to the system: Spark keeps its Python workers for later stages."""
    module = work.__module__
    if inspect.isgeneratorfunction(work):
        def stream(batches):
            _free_others(module)
            yield from work(batches)
            _give_back()
        return stream

    def done(*args):
        _free_others(module)
        out = work(*args)
        _give_back()
        return out

    # Spark reads the number of arguments
    if len(inspect.signature(work).parameters) == 2:
        return lambda key, rows: done(key, rows)
    return lambda key, rows, other: done(key, rows, other)
