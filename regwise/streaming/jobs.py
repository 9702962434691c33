"""Incremental variants on Structured Streaming."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from regwise import schema as S
from regwise.operators.samples import first_seen
from regwise.plans.notices import classify
from regwise.session import durable, small
from regwise.sources.readers import file_stem, read_envelopes, records_of
from regwise.streaming.store import Levels, Snapshots


def stream_envelopes(spark: SparkSession, path: str, glob: str = "*.json", lines: bool = False) -> DataFrame:
    """New record files as they arrive; the checkpoint remembers what was read."""
    return (spark.readStream.schema(S.ENVELOPE).option("multiLine", not lines).option("pathGlobFilter", glob).json(path)
            .withColumn("file_stem", file_stem()))


def stream_records(spark: SparkSession, path: str, glob: str = "*.json", lines: bool = False) -> DataFrame:
    return records_of(stream_envelopes(spark, path, glob, lines))


def ingest(stream: DataFrame, table_path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that is new and stop; running it again continues where it stopped."""
    return (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(table_path))


def glob_free(path: str) -> str:
    """A path in which no character stands for others."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def first_seen_stream(stream: DataFrame, key: list[str], event_time: str, delay: str) -> DataFrame:
    """First row per key within the watermark delay; state older than the delay is dropped."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(key)


def classify_stream(stream: DataFrame, places: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Full classification of notices as they arrive, against the static place dictionary.

    A micro-batch goes through the same plan as a table, so its distinct
    agencies, brackets and addresses are located once. It is written under its
    own number: a replayed batch replaces what it wrote.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        classify(batch, places).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return upsert_stream(stream, write, checkpoint)


def upsert_stream(stream: DataFrame, merge, checkpoint: str) -> StreamingQuery:
    """Run ``merge(batch, batch_id)`` for every micro-batch; a replayed batch must change nothing."""
    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


class MasterStore:
    """A keyed table on shared storage, in parts, that changes by whole batches.

    A batch is merged with the rows of the parts it touches in one run of
    ``combine(previous rows, rows of the batch)`` and one write, split by part;
    the manifest, which names for each part the batch that wrote it last, makes
    all of it visible at once. Other parts stay where they are. Rows without a
    part (null) are a part of their own, beside that of the empty text. A batch
    that was committed changes nothing when it comes again. Folders stay for
    one commit longer than they are needed, for readers that are under way.
    """

    def __init__(self, spark: SparkSession, root: str, part: str, schema: str):
        self.table, self.part, self.schema = Snapshots(spark, root), part, schema
        self.columns = spark.createDataFrame([], schema).columns

    def _key(self) -> Column:
        """Name of a part's folder: hex digits need no escaping, and null differs from the empty text."""
        return F.coalesce(F.concat(F.lit("v"), F.hex(F.encode(F.col(self.part).cast("string"), "utf-8"))), F.lit("null"))

    def _rows(self, parts: dict[str, int]) -> DataFrame:
        return self.table.read("rows", [f"rows/at={number}/_part={key}" for key, number in sorted(parts.items())], self.schema)

    def read(self) -> DataFrame:
        """The rows of the newest commit."""
        return self._rows(self.table.state().get("parts", {}))

    def merge(self, batch: DataFrame, batch_id: int, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        if self.table.done(batch_id):
            return
        parts = self.table.state().get("parts", {})
        touched = {r[0] for r in batch.select(self._key()).distinct().collect()}  # parts, not rows; the manifest lists as many
        new = combine(self._rows({k: n for k, n in parts.items() if k in touched}), batch)
        place = self.table.write(new.select(*self.columns, self._key().alias("_part")).repartition("_part"), "rows", batch_id, "_part")
        written = {name.partition("=")[2]: batch_id for name in self.table.folders(place)}
        before = self.table.state().get("parts", {})
        self.table.commit(batch_id, {"parts": {k: n for k, n in parts.items() if k not in touched} | written})
        self.table.sweep("rows", [f"rows/at={n}" for n in {*before.values(), *written.values(), batch_id}])


class FirstSeen:
    """The first row of each key ever, without a horizon.

    Keys are stored with their rows, split by hash. A batch is reduced to one
    row per key; three bits of a stored Bloom filter tell which of these keys
    cannot have come before, and only the others are compared with the stored
    keys of their hash parts, which are scanned but not shuffled while those
    others are few. Rows of one batch appear together or not at all, and a
    batch that was committed changes nothing when it comes again.

    Null is a value of a key like any other. ``order`` decides which row of a
    key is first within a batch; between batches the earlier batch is.
    """

    BITS = 3

    def __init__(self, spark: SparkSession, root: str, keys: list[str], schema: str, filter_bits: int = 1 << 24, parts: int = 64):
        self.spark, self.table, self.keys, self.filter_bits, self.parts = spark, Snapshots(spark, root), keys, filter_bits, parts
        self.columns = spark.createDataFrame([], schema).columns
        self.levels = Levels(self.table, "rows", f"{schema}, _part int", "_part")

    def read(self) -> DataFrame:
        return self.levels.rows(self.table.state().get("rows", [])).select(*self.columns)

    def _hash(self, seed: int) -> Column:
        null = [F.col(k).isNull() for k in self.keys]
        return F.xxhash64(F.lit(seed), *[F.col(k) for k in self.keys], *null)

    def _bit(self, i: int) -> Column:
        return F.pmod(self._hash(i + 1), F.lit(self.filter_bits)) + 1

    def _bitmaps(self, rows: DataFrame) -> DataFrame:
        """``bucket, bits``: the filter's part of 32,768 bits each."""
        bit = rows.select(F.explode(F.array(*[self._bit(i) for i in range(self.BITS)])).alias("bit"))
        return bit.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))

    def _marked(self, rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
        """``rows`` with ``_maybe``: whether the filter has all bits of the key."""
        maybe = F.lit(True)
        bitmaps = small(bitmaps, max_rows=2048)  # of 4 kB each
        for i in range(self.BITS):
            rows = rows.join(bitmaps.select(F.col("bucket").alias(f"_b{i}"), F.col("bits").alias(f"_m{i}")), F.bitmap_bucket_number(self._bit(i)) == F.col(f"_b{i}"), "left")
            at = F.bitmap_bit_position(self._bit(i))
            byte = F.conv(F.hex(F.substring(F.col(f"_m{i}"), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            maybe = maybe & F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1, F.lit(False))
        return rows.withColumn("_maybe", maybe).drop(*[f"_{x}{i}" for x in "bm" for i in range(self.BITS)])

    def merge(self, batch: DataFrame, batch_id: int, order: Column) -> None:
        if self.table.done(batch_id):
            return
        state = self.table.state()
        part = F.pmod(self._hash(0), F.lit(self.parts)).cast("int")
        rows = first_seen(batch, self.keys, order).select(*self.columns, part.alias("_part"))
        bitmaps = self.table.read("filter", state.get("filter", []), "bucket long, bits binary")
        rows = durable(self._marked(rows, bitmaps), "seen")
        doubtful = rows.filter("_maybe")
        asked = [r[0] for r in doubtful.select("_part").distinct().collect()]  # at most ``parts``
        stored = self.levels.rows(state.get("rows", [])).filter(F.col("_part").isin(asked)).select("_part", *self.keys)
        same = lambda a, b: reduce(Column.__and__, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in ("_part", *self.keys)])
        known = durable(stored.alias("s").join(small(doubtful.select("_part", *self.keys)).alias("d"), same("s", "d"), "left_semi"), "known")
        new = rows.filter("NOT _maybe").unionByName(doubtful.alias("d").join(small(known).alias("k"), same("d", "k"), "left_anti")).drop("_maybe")
        levels = self.levels.added(state.get("rows", []), new, batch_id)
        added = self._bitmaps(self.table.read("rows", [f"rows/at={batch_id}"], self.levels.schema))
        merged = bitmaps.unionByName(added).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        filters = [self.table.write(merged, "filter", batch_id)]
        self.table.commit(batch_id, {"rows": levels, "filter": filters})
        self.table.sweep("rows", [place for place, _ in [*levels, *state.get("rows", [])]])
        self.table.sweep("filter", [*filters, *state.get("filter", [])])


class RecordLog:
    """Records of crawl files that are saved again and again, each taken in once.

    A crawler writes its state file anew with more records. A run looks at the
    files whose path, time or length it has not seen, counts their records by
    content, and takes what is above the count known for that file: equal
    records of one file are told apart by their number only. Records that are
    gone from a file stay. Known counts are stored in parts by file name, so a
    run reads the parts of the files that changed. A run that found nothing
    new leaves no trace; one that broke off is repeated by the next.
    """

    FILES = "path string, modified timestamp, length long"

    def __init__(self, spark: SparkSession, root: str, fields: dict[str, int] = S.PROVINCE_FIELDS, parts: int = 64):
        self.spark, self.table, self.fields, self.parts = spark, Snapshots(spark, root), fields, parts
        self.content = ["prov_code", "file_stem", "city_name", *fields]
        kinds = ", ".join(f"{c} {'int' if c == 'module' else 'string'}" for c in self.content)
        self.levels = Levels(self.table, "records", f"{kinds}, pos int, digest binary, copies long, run int, _part int", "_part")
        self.seen = Levels(self.table, "files", f"{self.FILES}, _part int", "_part")

    def _part(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.parts)).cast("int")

    def read(self) -> DataFrame:
        """All records taken in, with ``run``, the number of the run, and ``pos``, the first place of such a record in its file."""
        rows = self.levels.rows(self.table.state().get("records", []))
        return rows.select(*self.content, "pos", "run", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")

    def ingest(self, path: str, glob: str = "*.json", lines: bool = False) -> int | None:
        """Take in what is new below ``path``; returns the number of the run, or None where no file has changed."""
        state = self.table.state()
        number = max(self.table.commits(), default=-1) + 1
        files = (self.spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)  # names, not contents
                 .select("path", F.col("modificationTime").alias("modified"), "length", self._part("path").alias("_part")))
        changed = durable(files.join(self.seen.rows(state.get("files", [])), ["path", "modified", "length", "_part"], "left_anti"), "files")
        names = [r["path"] for r in changed.select("path").collect()]  # Spark lists as many to read them
        if not names:
            return None
        envelopes = read_envelopes(self.spark, [glob_free(n) for n in names], lines=lines)
        counted = records_of(envelopes, self.fields).groupBy(*self.content).agg(F.count("*").alias("n"), F.min("pos").cast("int").alias("pos"))
        digest = F.unhex(F.md5(F.to_json(F.struct(*[c for c in self.content if c != "file_stem"]))))
        counted = durable(counted.withColumns({"digest": digest, "_part": self._part("file_stem")}), "counted")
        asked = [r[0] for r in counted.select("_part").distinct().collect()]  # at most ``parts``
        key = ["_part", "file_stem", "digest"]
        known = self.levels.rows(state.get("records", [])).filter(F.col("_part").isin(asked)).groupBy(*key).agg(F.sum("copies").alias("known"))
        new = counted.join(known, key, "left").withColumn("copies", F.col("n") - F.coalesce("known", F.lit(0))).filter("copies > 0")
        new = new.select(*self.content, "pos", "digest", "copies", F.lit(number).alias("run"), "_part")
        state = {"records": self.levels.added(state.get("records", []), new, number), "files": self.seen.added(state.get("files", []), changed, number)}
        before = self.table.state()
        self.table.commit(number, state)
        for table in ("records", "files"):
            self.table.sweep(table, [place for place, _ in [*state[table], *before.get(table, [])]])
        return number
