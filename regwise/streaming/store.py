"""Tables on shared storage that change by whole commits."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


class Snapshots:
    """Folders of a table, and a numbered manifest for each state that the table was in.

    Data goes to a folder of its own first; the manifest that names it is
    written last, under another name, and moved in place in one step. Readers
    take the folders of the newest manifest, so they see a commit whole or not
    at all. The number of a commit is given by the caller (the batch id of a
    stream), and a number that is not above the newest one was committed
    before: ``done`` says so, and the caller leaves the table as it is.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self._hadoop.Path("/".join(parts))

    def folders(self, *parts: str) -> list[str]:
        """Names of the folders inside one folder."""
        place = self._path(self.root, *parts)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(place) if s.isDirectory()) if self._fs.exists(place) else []

    def commits(self) -> list[int]:
        place = self._path(self.root, "commits")
        names = [s.getPath().getName() for s in self._fs.listStatus(place)] if self._fs.exists(place) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def state(self, before: int | None = None) -> dict:
        """The newest manifest, or the newest one older than commit ``before``; empty for a new table."""
        known = [c for c in self.commits() if before is None or c < before]
        if not known:
            return {}
        stream = self._fs.open(self._path(self.root, "commits", f"{known[-1]}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def done(self, number: int) -> bool:
        known = self.commits()
        return bool(known) and number <= known[-1]

    def commit(self, number: int, state: dict) -> None:
        """Make ``state`` the newest one; a commit of the same number by someone else makes this fail."""
        folder, draft = self._path(self.root, "commits"), self._path(self.root, f".draft-{number}")
        self._fs.mkdirs(folder)
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        if not self._fs.rename(draft, self._path(self.root, "commits", f"{number}.json")):
            raise RuntimeError(f"commit {number} of {self.root} exists")

    def write(self, df: DataFrame, table: str, number: int, by: str | None = None) -> str:
        """Write the folder ``at=number`` of a table, which no manifest names yet; what an earlier try left there goes."""
        place = f"{table}/at={number}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(f"{self.root}/{place}")
        return place

    def read(self, table: str, places: list[str], schema: str) -> DataFrame:
        """Rows of folders of one table; ``schema`` may name the column that the folders are split by."""
        if not places:
            return self.spark.createDataFrame([], schema)
        columns = self.spark.createDataFrame([], schema).columns
        rows = self.spark.read.schema(f"{schema}, at long").option("basePath", f"{self.root}/{table}")
        return rows.parquet(*[f"{self.root}/{p}" for p in places]).select(*columns)

    def drop(self, place: str) -> None:
        self._fs.delete(self._path(self.root, place), True)

    def sweep(self, table: str, keep: list[str]) -> None:
        """Delete the folders of a table that are not in ``keep``."""
        for name in self.folders(table):
            if f"{table}/{name}" not in keep:
                self.drop(f"{table}/{name}")


class Levels:
    """A table of ``store`` that grows by folders, of which there are logarithmically many.

    A folder that is not much larger than the one behind it is merged with it,
    so every row is rewritten a logarithmic number of times.
    """

    def __init__(self, store: Snapshots, table: str, schema: str, by: str):
        self.store, self.table, self.schema, self.by = store, table, schema, by

    def rows(self, levels: list) -> DataFrame:
        return self.store.read(self.table, [place for place, _ in levels], self.schema)

    def added(self, levels: list, df: DataFrame, number: int) -> list:
        """``levels`` ((folder, rows) pairs of a manifest) with ``df`` as the newest one, merged where due."""
        place = self.store.write(df, self.table, number, self.by)
        levels = [*levels, [place, self.rows([[place, 0]]).count()]]
        due = len(levels) - 1
        while due and levels[due - 1][1] <= 2 * sum(n for _, n in levels[due:]):
            due -= 1
        if due == len(levels) - 1:
            return levels
        merged = self.rows(levels[due:]).repartition(self.by)
        # beside the folder of the commit itself, which is one of those that are read
        place = self.store.write(merged, self.table, -number - 1, self.by)
        return [*levels[:due], [place, sum(n for _, n in levels[due:])]]
