"""Approximate nearest neighbours by inner product: lists of rotated vectors in column blocks, scanned with early abandonment."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regwise.llm.common import Cut, lean
from regwise.llm.grid_join import usable
from regwise.session import small

NEAREST = 20
LIST_ROWS, MOST_LISTS = 2048, 1024  # aimed rows of a list; the lists' centres go to every task, so their number is bounded
FIT_BYTES = 4 << 20  # of vectors on which the centres are fitted; they place rows and order lists
TRIAL = 128  # queries that are also compared with all rows, to find how many lists must be probed
FOUND = 0.98  # share of the trial's true neighbours that the probed lists must hold
COLUMN = 16  # dimensions of a column block
SURE = 3.0  # standard errors by which a partial distance must exceed the bound before its candidate is abandoned
BLOCK_ROWS, CHUNK_ROWS = 1024, 256  # of candidates and queries that meet in one row
SLACK = 1e-9
SEED = 11


class Space:
    """Vectors of one length as points whose distances order like inner products, turned by a random rotation.

    Each vector gets one more coordinate that makes all lengths equal; a
    query gets zero there and that same length.
    """

    def __init__(self, d: int, unit: float, longest: float):
        self.d, self.unit, self.longest = d, unit, longest
        turn, upper = np.linalg.qr(np.random.default_rng(SEED).normal(size=(d + 1, d + 1)))
        self.turn = turn * np.sign(np.diag(upper))
        self.centres = np.zeros((1, d + 1))

    def points(self, x: np.ndarray) -> np.ndarray:
        x = x / self.unit
        rest = np.sqrt(np.maximum(0, self.longest ** 2 - (x * x).sum(axis=1)))
        return np.column_stack([x, rest]) @ self.turn

    def asked(self, q: np.ndarray) -> np.ndarray:
        q = q / np.abs(q).max(axis=1, keepdims=True)
        q *= self.longest / np.linalg.norm(q, axis=1, keepdims=True)
        return np.column_stack([q, np.zeros(len(q))]) @ self.turn

    def reach(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Squared distances that belong to inner products with ``q``; infinite where there is none yet."""
        top = np.abs(q).max(axis=1)
        norm = top * np.linalg.norm(q / top[:, None], axis=1)
        return 2 * self.longest ** 2 - 2 * self.longest * (score / self.unit / norm)

    def fit(self, sample: np.ndarray, lists: int) -> None:
        """Centres of ``lists`` clusters of a sample."""
        p = self.points(sample)
        draw = np.random.default_rng(SEED)
        c = p[draw.choice(len(p), lists, replace=False)]
        for _ in range(8):
            near = self._nearest(p, c)
            count = np.bincount(near, minlength=lists)
            total = np.zeros_like(c)
            np.add.at(total, near, p)
            c = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], c)
        self.centres = c

    @staticmethod
    def _nearest(p: np.ndarray, c: np.ndarray) -> np.ndarray:
        return np.concatenate([((c * c).sum(axis=1) - 2 * p[i:i + 4096] @ c.T).argmin(axis=1) for i in range(0, len(p), 4096)])

    def list_of(self, x: np.ndarray) -> np.ndarray:
        return self._nearest(self.points(x), self.centres)

    def order(self, q: np.ndarray) -> np.ndarray:
        """For each query all lists, nearest centre first."""
        c = self.centres
        return np.argsort((c * c).sum(axis=1) - 2 * self.asked(q) @ c.T, axis=1, kind="stable")


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products row by row, added up from the first dimension to the last, so that equal rows score equally everywhere."""
    out = np.zeros(len(q))
    for i in range(q.shape[1]):
        out += q[:, i] * x[:, i]
    return out


def survivors(q: np.ndarray, columns: list[np.ndarray], bound: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of query and candidate within ``bound`` and among the ``most`` nearest of the query here, ties included.

    ``columns`` holds the candidates' coordinates, one block of dimensions
    after the other. After each block a candidate goes where its distance so
    far, scaled up to all dimensions, is above the bound by more than chance
    explains; candidates and queries that nobody is left for are not read on.
    """
    dims = sum(len(c) for c in columns)
    row, col = np.arange(len(q)), np.arange(columns[0].shape[1])
    part = np.zeros((len(row), len(col)))
    alive = np.ones(part.shape, bool)
    seen = 0
    for block in columns:
        a, b = q[row, seen:seen + len(block)], block[:, col]
        part += (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=0) - 2 * (a @ b)
        seen += len(block)
        limit = bound[row] + SLACK * (1 + np.abs(bound[row]))
        alive &= part * (dims / seen) <= (limit * (1 + (SURE / math.sqrt(seen) if seen < dims else 0)) ** 2)[:, None]
        rows, cols = alive.any(axis=1), alive.any(axis=0)
        if rows.sum() * cols.sum() < 0.7 * alive.size:
            row, col = row[rows], col[cols]
            part, alive = part[np.ix_(rows, cols)], alive[np.ix_(rows, cols)]
        if not alive.size:
            break
    if alive.size and alive.shape[1] > most:
        part[~alive] = np.inf
        last = np.partition(part, most - 1, axis=1)[:, most - 1]
        alive &= part <= (last + SLACK * (1 + np.abs(last)))[:, None]
    i, j = np.nonzero(alive)
    return row[i], col[j]


def best_of(k: np.ndarray, ids: np.ndarray, marks: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` best rows of each ``k``, ties to the smaller id."""
    order = np.lexsort((marks, ids, -score, k))
    first = np.searchsorted(k[order], k[order])
    return order[np.arange(len(order)) - first < most]


def _matrix(cell: pa.Scalar, width: int) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), np.float64).reshape(-1, width)


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


PLACED = "list int, d int, vec_id long, mark long, v array<double>"


def _place(space: Space) -> Callable:
    """Puts rows of the usual length into their lists; every other length is a list of its own, numbered below zero."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.column("d").to_numpy()
            out = -d.astype(np.int32)
            usual = np.flatnonzero(d == space.d)
            if len(usual):
                out[usual] = space.list_of(_vectors(batch.column("v").take(pa.array(usual))))
            yield pa.RecordBatch.from_arrays([pa.array(out), batch.column("d"), batch.column("vec_id"), batch.column("mark"), batch.column("v")],
                                             ["list", "d", "vec_id", "mark", "v"])
    return run


BLOCK = "block long, list int, d int, vec_ids array<long>, marks array<long>, vectors binary, columns binary"


def _runs(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of one list with at most ``most`` rows."""
    lists = batch.column("list").to_numpy()
    edges = [0, *(np.flatnonzero(np.diff(lists)) + 1).tolist(), len(lists)]
    for s, e in zip(edges, edges[1:]):
        for at in range(s, e, most):
            yield batch.slice(at, min(most, e - at))


def _blocks(space: Space, rows: int) -> Callable:
    """Candidates of one list with their vectors, and their rotated points laid out dimension by dimension."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = 0
        for batch in batches:
            for part in _runs(batch, rows) if batch.num_rows else ():
                x, d = _vectors(part.column("v")), part.column("d")[0].as_py()
                points = space.points(x).T.tobytes() if d == space.d else b""
                lists = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), pa.array(part.column(c).to_numpy())) for c in ("vec_id", "mark")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(TaskContext.get().partitionId() << 32) + seq]), part.column("list")[:1], part.column("d")[:1], *lists,
                     pa.array([x.tobytes()], pa.binary()), pa.array([points], pa.binary())], [c.split()[0] for c in BLOCK.split(", ")])
                seq += 1
    return run


def _probes(space: Space, start: int, stop: int) -> Callable:
    """Each query with the lists that it probes, from the ``start``-th nearest on; another length has its one list at the start."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.column("d").to_numpy()
            usual, other = np.flatnonzero(d == space.d), np.flatnonzero(d != space.d)
            at, lists = [], []
            if len(usual):
                near = space.order(_vectors(batch.column("v").take(pa.array(usual))))[:, start:stop]
                at.append(np.repeat(usual, near.shape[1]))
                lists.append(near.ravel())
            if not start:
                at.append(other)
                lists.append(-d[other])
            at, lists = (np.concatenate([np.empty(0, np.int64), *x]) for x in (at, lists))
            for s in range(0, len(at), 1 << 16):
                rows = pa.array(at[s:s + (1 << 16)])
                yield pa.RecordBatch.from_arrays([pa.array(lists[s:s + (1 << 16)].astype(np.int32)), *(batch.column(c).take(rows) for c in ("d", "k", "least", "v"))],
                                                 ["list", "d", "k", "least", "v"])
    return run


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _runs(batch, CHUNK_ROWS) if batch.num_rows else ():
            lists = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), pa.array(part.column(c).to_numpy())) for c in ("k", "least")]
            yield pa.RecordBatch.from_arrays([part.column("list")[:1], *lists, pa.array([_vectors(part.column("v")).tobytes()], pa.binary())], ["list", "ks", "least", "asked"])


def _scan(space: Space, most: int) -> Callable:
    """Queries of a chunk against the candidates of a block: the best rows found, above what each query has already."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                cell = {c: batch.column(c)[r] for c in batch.schema.names}
                d = cell["d"].as_py()
                q, x = _matrix(cell["asked"], d), _matrix(cell["vectors"], d)
                ks, least, ids, marks = (cell[c].values.to_numpy() for c in ("ks", "least", "vec_ids", "marks"))
                if d == space.d:
                    points = _matrix(cell["columns"], len(x))
                    columns = [points[i:i + COLUMN] for i in range(0, len(points), COLUMN)]
                    i, j = survivors(space.asked(q), columns, space.reach(q, least), most)
                else:
                    i, j = (y.ravel() for y in np.indices((len(q), len(x))))
                for s in range(0, len(i), 1 << 18):
                    a, b = i[s:s + (1 << 18)], j[s:s + (1 << 18)]
                    found = scores(q[a], x[b])
                    at = best_of(a, ids[b], marks[b], found, most)
                    at = at[found[at] >= least[a[at]]]
                    yield pa.RecordBatch.from_arrays([pa.array(ks[a[at]]), pa.array(ids[b[at]]), pa.array(marks[b[at]]), pa.array(found[at])], ["k", "vec_id", "mark", "score"])
    return run


HIT = "k long, vec_id long, mark long, score double"


def _top(hits: DataFrame, most: int) -> DataFrame:
    best = Window.partitionBy("k").orderBy(F.desc("score"), "vec_id", "mark")
    return hits.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most)


def _searched(queries: DataFrame, blocks: DataFrame, space: Space, start: int, stop: int, most: int) -> DataFrame:
    """The best candidates of ``queries`` (d, k, least, v) in the lists that they probe."""
    probes = queries.mapInArrow(_probes(space, start, stop), "list int, d int, k long, least double, v array<double>")
    order = [F.col("list"), F.xxhash64("k")]
    chunks = probes.repartitionByRange(*order).sortWithinPartitions("list").mapInArrow(_chunks, "list int, ks array<long>, least array<double>, asked binary")
    # a list of many blocks, too, meets its queries block by block
    pairs = chunks.join(small(blocks.select("list", "block")), "list").drop("list").join(blocks.drop("list"), "block")
    return pairs.mapInArrow(_scan(space, most), HIT)


def _trial(asked: np.ndarray, most: int) -> Callable:
    """All candidates of a block against the trial's queries: list and score of the best."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                score = asked @ _matrix(batch.column("vectors")[r], asked.shape[1]).T
                top = np.argpartition(-score, min(most, score.shape[1]) - 1, axis=1)[:, :most]
                k = np.repeat(np.arange(len(asked)), top.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(np.full(len(k), batch.column("list")[r].as_py(), np.int32)),
                                                  pa.array(np.take_along_axis(score, top, 1).ravel())], ["k", "list", "score"])
    return run


def _lists_to_probe(queries: DataFrame, blocks: DataFrame, space: Space, most: int) -> int:
    """How many lists hold the wanted share of the true neighbours of a bounded number of queries, compared with all rows."""
    lists = len(space.centres)
    if lists == 1:
        return 1
    sample = queries.where(F.col("d") == space.d).orderBy(F.xxhash64("v")).limit(TRIAL).select("v").collect()
    if not sample:
        return 1
    asked = np.array([r["v"] for r in sample])
    hits = blocks.where(F.col("d") == space.d).select("list", "vectors").mapInArrow(_trial(asked, most), "k long, list int, score double")
    best = Window.partitionBy("k").orderBy(F.desc("score"))
    true = hits.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most).select("k", "list").collect()
    place = np.argsort(space.order(asked), axis=1)
    ranks = np.sort([place[r["k"], r["list"]] for r in true])
    return int(ranks[min(len(ranks) - 1, math.ceil(FOUND * len(ranks)) - 1)]) + 1


@lean
def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length: rows, the largest component, and the logarithm of the largest norm."""
    for batch in batches:
        d = batch.column("d").to_numpy()
        for length in np.unique(d):
            x = _vectors(batch.column("v").filter(pa.array(d == length)))
            top = np.abs(x).max(axis=1)
            longest = (np.log2(top) + np.log2(np.linalg.norm(x / top[:, None], axis=1))).max()
            yield pa.RecordBatch.from_arrays([pa.array([length], pa.int32()), pa.array([len(x)], pa.int64()), pa.array([top.max()]), pa.array([longest])],
                                             ["d", "n", "unit", "longest"])


def _fitted(rows: DataFrame, list_rows: int) -> tuple[Space, tuple] | None:
    """The space of the most frequent length, with centres fitted on a bounded sample in hash order, and that sample: vectors, ids, marks."""
    sizes = rows.select("d", "v").mapInArrow(_measured, "d int, n long, unit double, longest double")
    found = sizes.groupBy("d").agg(F.sum("n").alias("n"), F.max("unit").alias("unit"), F.max("longest").alias("longest")).orderBy(F.desc("n"), "d").first()
    if not found:
        return None
    d = found["d"]
    space = Space(d, found["unit"], 2.0 ** (found["longest"] - math.log2(found["unit"])) * (1 + 1e-12))
    sample = rows.where(F.col("d") == d).orderBy(F.xxhash64("v")).limit(max(64, FIT_BYTES // (8 * d))).select("v", "vec_id", "mark").collect()
    vectors, ids, marks = (np.array([r[c] for r in sample]) for c in ("v", "vec_id", "mark"))
    space.fit(vectors, max(1, min(MOST_LISTS, round(found["n"] / list_rows), len(sample) // 16)))
    return space, (vectors, ids, marks)


def _sampled(space: Space, sample: tuple, most: int) -> Callable:
    """The best rows of the sample for each query: the first ones found, which bound what is worth finding."""
    vectors, ids, marks = sample

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far = np.linalg.norm(vectors / space.unit, axis=1).max() * space.unit
        for batch in batches:
            usual = np.flatnonzero(batch.column("d").to_numpy() == space.d)
            q = _vectors(batch.column("v").take(pa.array(usual))) if len(usual) else np.empty((0, space.d))
            k = batch.column("k").to_numpy()[usual]
            for s in range(0, len(q), CHUNK_ROWS):
                part = q[s:s + CHUNK_ROWS]
                near = part @ vectors.T
                top = np.abs(part).max(axis=1)
                rounding = 1e-12 * top * np.linalg.norm(part / top[:, None], axis=1) * far
                last = max(0, len(vectors) - most)
                i, j = np.nonzero(near >= (np.partition(near, last, axis=1)[:, last] - rounding)[:, None])
                score = scores(part[i], vectors[j])
                at = best_of(i, ids[j], marks[j], score, most)
                yield pa.RecordBatch.from_arrays([pa.array(k[s:s + CHUNK_ROWS][i[at]]), pa.array(ids[j[at]]), pa.array(marks[j[at]]), pa.array(score[at])],
                                                 ["k", "vec_id", "mark", "score"])
    return run


def _above(queries: DataFrame, hits: DataFrame, most: int) -> DataFrame:
    """``queries`` with the score of their last of ``most`` hits as ``least``; infinitely low where there are fewer."""
    last = hits.where(F.col("place") == most).select("k", F.col("score").alias("least"))
    return queries.join(last, "k", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))


def nearest(embeddings: DataFrame, queries: Column | None = None, most: int = NEAREST, list_rows: int = LIST_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``queries`` picks (vec_id divisible by 20), the ``most`` largest inner products found.

    Inner products are turned into distances, and points stand in the list of
    their nearest centre, rotated, one block of dimensions after the other. A
    query starts with the best rows of a bounded sample and scans its nearest
    list for better ones; what it then has bounds the scan of further lists.
    Candidates are abandoned as soon as a test on their partial distance says
    so. How many lists are probed is measured on
    a bounded set of queries against all rows. Scores are exact: products of
    the original components, added in order.

    Null, empty, zero and non-finite vectors, and rows without an id, take no
    part; vectors meet those of their length only, and every length but the
    most frequent is compared whole. Repeated rows of an id and a vector are
    one; rows that share only the id are different rows. Of equal vectors no
    more than ``most`` + 1 can be found by anyone, those of the smallest ids,
    so only these are indexed, and equal queries are one. Other columns are
    not read; without rows or queries there is no result.
    """
    queries = F.col("vec_id") % 20 == 0 if queries is None else queries
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).select("vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v")).distinct()
    rows = Cut(rows.select("vec_id", "v", F.size("v").alias("d"), F.xxhash64("v").alias("mark")), "vectors").df
    copies = Window.partitionBy("mark", "v").orderBy("vec_id")
    indexed = Cut(rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= most + 1).drop("copy"), "vectors").df
    fitted = _fitted(indexed, list_rows)
    if fitted is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    space, sample = fitted
    placed = indexed.mapInArrow(_place(space), PLACED)
    blocks = Cut(placed.repartitionByRange("list", "mark", "vec_id").sortWithinPartitions("list").mapInArrow(_blocks(space, BLOCK_ROWS), BLOCK), "blocks").df
    asking = rows.where(queries)
    classes = Cut(asking.groupBy("mark", "v", "d").agg(F.min("vec_id").alias("k")).withColumn("k", F.monotonically_increasing_id()), "queries").df
    lists = _lists_to_probe(classes, blocks, space, most + 1)
    first = Cut(_top(classes.select("d", "k", "v").mapInArrow(_sampled(space, sample, most + 1), HIT), most + 1), "hits").df
    home = _searched(_above(classes, first, most + 1), blocks, space, 0, 1, most + 1)
    hits = Cut(_top(first.drop("place").union(home).distinct(), most + 1), "hits").df
    if lists > 1:
        further = _searched(_above(classes, hits, most + 1), blocks, space, 1, lists, most + 1)
        hits = hits.drop("place").union(further).distinct()
    best = _top(hits.drop("place"), most + 1).select("k", F.col("vec_id").alias("found"), F.col("mark").alias("found_mark"), "score")
    named = asking.join(classes.select("mark", "v", "k"), ["mark", "v"]).select(F.col("vec_id").alias("query_id"), "mark", "k")
    met = named.join(best, "k").where(~((F.col("found") == F.col("query_id")) & (F.col("found_mark") == F.col("mark"))))
    by = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "found", "found_mark")
    return met.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= most).select("query_id", "rank", F.col("found").alias("vec_id"), "score")
