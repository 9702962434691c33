"""Embedding near-duplicates: a self-join of vectors in epsilon grid order."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regwise.llm.common import Cut
from regwise.llm.components import components, local_roots

COSINE = 0.9
LEADING = 8  # principal dimensions that make the grid; one more holds the length of the rest
FILTER = 31  # principal dimensions that pairs are first compared by, with the length of the rest
FIT_BYTES = 8 << 20  # of vectors on which the directions are fitted; they steer the order, not the result
BLOCK_BYTES = 1 << 20
GROUP = 64  # blocks that a task holds while others pass; a range beyond the first FINE is a quarter of that
FINE = 256
ROWS = 256  # of a matrix product
SLACK = 1e-4  # of single precision, in a cosine
PASS_BYTES = 4 << 20  # of pairs compared in double precision at once
EDGES = 1 << 20  # that a task gathers before it keeps a forest of them
ROUNDS = 16  # in one job at most
MERGE = 4  # times the vectors: links beyond that are summed before the next job
BATCH = "16m"  # of pairs of blocks on their way to Python; a task holds several
PLACE = ["h1", "h2", "n", "least"]
SMALL = "h1 long, h2 long, n long, least long"


def unit(vectors: list[np.ndarray] | np.ndarray) -> np.ndarray:
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # huge and tiny values would leave the range when squared
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(embedding: Column) -> Column:
    """Not null, not empty, all components finite, one of them not zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return embedding.isNotNull() & F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _keyed(v: Column) -> list[Column]:
    """128 bits for a vector; null for null."""
    return [F.when(v.isNotNull(), F.xxhash64(v)).alias("h1"), F.when(v.isNotNull(), F.xxhash64(F.lit(1), v)).alias("h2")]


def directions(vectors: DataFrame, lengths: list[Row], leading: int = FILTER) -> np.ndarray:
    """Leading principal directions (rows) of a bounded sample, taken in hash order, of the most frequent length."""
    if not lengths:
        return np.zeros((leading, 1))
    width = min(lengths, key=lambda r: (-r["n"], r["d"]))
    d, most = width["d"], max(64, FIT_BYTES // (8 * width["d"]))
    sample = vectors.where(F.size("v") == d)
    if width["n"] > 2 * most:  # hashes are even: this passes on about twice as many as are taken
        sample = sample.where(F.col("h1") < int(-2.0**63 + 2.0**64 * 2 * most / width["n"]))
    sample = sample.dropDuplicates(["h1"]).orderBy("h1").limit(most).select("v").collect()
    x = unit([np.array(r["v"]) for r in sample])
    w, axes = np.linalg.eigh(np.cov(x.T).reshape(d, d)) if len(x) > 1 else (np.ones(d), np.eye(d))
    out = np.zeros((leading, d))
    out[:min(leading, d)] = axes[:, np.argsort(-w)[:leading]].T
    return out


def _projected(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Coordinates that never lie farther apart than the vectors: the leading ones, and the length of what they leave.

    A vector has the same coordinates in any company, which a matrix product does not promise.
    """
    d = min(x.shape[1], axes.shape[1])  # vectors of another length use what fits
    p = np.empty((len(x), len(axes)))
    for at in range(0, len(x), 1024):
        p[at:at + 1024] = (x[at:at + 1024, None, :d] * axes[None, :, :d]).sum(axis=2)
    return np.column_stack([p, np.sqrt(np.maximum(0, 1 - (p * p).sum(axis=1)))]) if axes.shape[1] == x.shape[1] else np.column_stack([p, np.zeros(len(p))])


def _cells(axes: np.ndarray, eps: float):
    """Each vector of a batch once, as bytes, with its rows' count and least id, its length and its cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.table([batch.column(c) for c in ("h1", "h2", "vec_id")] + [pa.array(np.arange(batch.num_rows))], ["h1", "h2", "vec_id", "i"])
            rows = rows.group_by(["h1", "h2"], use_threads=False).aggregate([("i", "min"), ("i", "count"), ("vec_id", "min")]).combine_chunks()
            v = batch.column("v").take(rows["i_min"].combine_chunks())
            values, size = v.flatten().to_numpy(), v.value_lengths().to_numpy()
            start = np.cumsum(size) - size
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                x = np.ascontiguousarray(values[start[at][:, None] + np.arange(d)])
                cell = np.floor(_projected(unit(x), axes)[:, :len(axes)] / eps).astype(np.int32)
                ends = pa.py_buffer(np.arange(0, (len(at) + 1) * x[0].nbytes, x[0].nbytes, dtype=np.int32))
                own = rows.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*(own[c].combine_chunks() for c in ("h1", "h2", "i_count", "vec_id_min")), pa.Array.from_buffers(pa.binary(), len(at), [None, ends, pa.py_buffer(x)]),
                     pa.array(np.full(len(at), d, np.int32)), *(pa.array(cell[:, i]) for i in range(len(axes)))],
                    [*PLACE, "v", "d", *(f"c{i}" for i in range(len(axes)))])
    return run


def _to_blocks(block_bytes: int, axes: np.ndarray, kind: np.dtype):
    """Intervals of the order, of one vector length and about ``block_bytes``, with the box of their points.

    Rows of one vector follow each other and become one. Vectors are numbered from ``first`` of their block on.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, done, held, size = TaskContext.get().partitionId(), 0, 0, [], 0

        def block() -> pa.RecordBatch:
            own = list(zip(*held, strict=True))
            d, vectors = held[0][4], b"".join(own[5])
            box = _projected(unit(np.frombuffer(vectors, kind).reshape(-1, d)), axes)
            columns = [[seq], [d], [(part << 40) + done], [len(held)], *([list(c)] for c in own[:4]), [vectors], *([x] for x in box.min(axis=0)), *([x] for x in box.max(axis=0)), [part]]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * 4 + [pa.binary()] + [pa.float64()] * (2 * box.shape[1]) + [pa.int64()]
            names = ["seq", "d", "first", "m", *PLACE, "vectors", *(f"lo{i}" for i in range(box.shape[1])), *(f"hi{i}" for i in range(box.shape[1])), "part"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            for h1, h2, n, least, d, v in zip(*(batch.column(c).to_pylist() for c in (*PLACE, "d", "v")), strict=True):
                if held and (d, h1, h2) == (held[-1][4], held[-1][0], held[-1][1]):
                    known = held[-1]
                    held[-1] = (h1, h2, known[2] + n, least if known[3] is None else known[3] if least is None else min(least, known[3]), d, v)
                    continue
                if held and (held[0][4] != d or size + len(v) > block_bytes):
                    yield block()
                    seq, done, held, size = seq + 1, done + len(held), [], 0
                held.append((h1, h2, n, least, d, v))
                size += len(v)
        if held:
            yield block()
    return run


def _joined(cosine: float, axes: np.ndarray, kind: np.dtype):
    """Pairs of blocks to ``k, links, root``: links found for each vector of a task, and a vector it is connected with.

    The leading coordinates and the lengths of the rests bound a cosine from above. Pairs whose bound falls short of
    ``cosine`` in single precision, by more than that can err, are done with; the others are compared in double precision.
    """
    def coarse(raw: np.ndarray) -> np.ndarray:
        x = unit(raw)
        if x.shape[1] == axes.shape[1] > len(axes):
            p = x @ axes.T
            x = np.column_stack([p, np.sqrt(np.maximum(0, 1 - (p * p).sum(axis=1)))])
        return x.astype(np.float32)

    def linked(a: np.ndarray, b: np.ndarray, fa: np.ndarray, fb: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        bound, whole = np.float32(cosine - SLACK), None
        for at in range(0, len(a), ROWS):
            start = at if same else 0
            hit = fa[at:at + ROWS] @ fb[start:].T >= bound
            if same:
                hit &= ~np.tri(*hit.shape, dtype=bool)  # each pair once
            if not hit.any():
                continue
            i, j = np.divmod(np.flatnonzero(hit), hit.shape[1])
            if 8 * len(i) > hit.size:
                whole = unit(b) if whole is None else whole
                near = (unit(a[at:at + ROWS]) @ whole[start:].T >= cosine) & hit
                i, j = np.divmod(np.flatnonzero(near), hit.shape[1])
            else:
                step = max(1, PASS_BYTES // (8 * a.shape[1]))
                near = [np.einsum("ij,ij->i", unit(a[i[s:s + step] + at]), unit(b[j[s:s + step] + start])) >= cosine for s in range(0, len(i), step)]
                near = np.concatenate(near)
                i, j = i[near], j[near]
            if len(i):
                yield i + at, j + start

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[int, np.ndarray] = {}  # by block
        links: dict[int, np.ndarray] = {}  # by the number of a block's first vector
        nodes, roots, gathered = [], [], 0
        for batch in batches:
            for at in range(batch.num_rows):
                (a, b, d, ka, kb), (na, nb), (va, vb) = ([batch.column(c)[at].as_py() for c in ("a", "b", "d", "ka", "kb")], [batch.column(c)[at].values.to_numpy() for c in ("na", "nb")],
                                                         [np.frombuffer(batch.column(c)[at].as_buffer(), kind) for c in ("va", "vb")])
                va, vb = va.reshape(-1, d), vb.reshape(-1, d)
                if len(ready) > 4 * GROUP:
                    ready.clear()
                for block, v in ((a, va), (b, vb)):
                    if block not in ready:
                        ready[block] = coarse(v)
                for i, j in linked(va, vb, ready[a], ready[b], a == b):
                    np.add.at(links.setdefault(ka, np.zeros(len(na), np.int64)), i, nb[j])
                    np.add.at(links.setdefault(kb, np.zeros(len(nb), np.int64)), j, na[i])
                    # of these links only a spanning forest goes on
                    found = local_roots(ka + i, kb + j)
                    nodes.append(found[0])
                    roots.append(found[1])
                    gathered += len(found[0])
                    if gathered > EDGES:
                        forest = local_roots(np.concatenate(nodes), np.concatenate(roots))
                        nodes, roots, gathered = [forest[0]], [forest[1]], min(len(forest[0]), EDGES // 2)
        if nodes:
            found, root = local_roots(np.concatenate(nodes), np.concatenate(roots))
            count = np.concatenate([links[first][links[first] > 0] for first in sorted(links)])
            for at in range(0, len(found), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[at:at + (1 << 16)]) for x in (found, count, root)], ["k", "links", "root"])
    return run


def _rounds(parts: list[Row], width: int, eps: float, group_bytes: int) -> list[tuple[list[int], list[int]]]:
    """Groups of neighbouring ranges, each with the ranges from it on whose boxes lie within ``eps`` of one of its own."""
    parts = sorted(parts, key=lambda r: r["part"])
    low, high = (np.array([[r[f"{e}{i}"] for i in range(width)] for r in parts]) for e in ("lo", "hi"))
    shortest, longest = (np.array([r[c] for r in parts]) for c in ("d0", "d1"))
    out, start = [], 0
    while start < len(parts):
        end, size = start + 1, parts[start]["bytes"]
        while end < len(parts) and size + parts[end]["bytes"] <= group_bytes:
            size += parts[end]["bytes"]
            end += 1
        near = np.zeros(len(parts), bool)
        for i in range(start, end):
            gap = np.maximum(0, np.maximum(low[i] - high, low - high[i]))
            near |= ((gap * gap).sum(axis=1) <= eps * eps) & (shortest[i] <= longest) & (shortest <= longest[i])
        near[:start] = False
        out.append((list(range(start, end)), np.flatnonzero(near).tolist()))
        start = end
    return [([parts[i]["part"] for i in left], [parts[i]["part"] for i in right]) for left, right in out]


def _round(blocks: DataFrame, left: list[int], right: list[int], tasks: int, width: int, eps: float) -> DataFrame:
    """Pairs of blocks that can hold a link, one of a group and one of its ranges: every task reads both where they were written, so none is shuffled."""
    low, high = [f"lo{i}" for i in range(width)], [f"hi{i}" for i in range(width)]
    side = lambda s, ranges: blocks.where(F.col("part").isin(ranges)).select(
        F.col("node").alias(s), F.col("part").alias(f"p{s}"), F.col("d").alias(f"d{s}"), F.col("first").alias(f"k{s}"), F.col("n").alias(f"n{s}"),
        F.col("vectors").alias(f"v{s}"), *(F.col(c).alias(f"{s}_{c}") for c in (*low, *high)))
    apart = F.lit(0.0)
    for lo, hi in zip(low, high, strict=True):
        gap = F.greatest(F.col(f"a_{lo}") - F.col(f"b_{hi}"), F.col(f"b_{lo}") - F.col(f"a_{hi}"), F.lit(0.0))
        apart = apart + gap * gap
    # of two blocks of the group either may fetch the other
    turn = (F.col("a") == F.col("b")) | ((F.col("a") < F.col("b")) == ((F.col("a") + F.col("b")) % 2 == 0))
    can = (F.col("da") == F.col("db")) & (apart <= eps * eps) & ((F.col("pb") > left[-1]) | turn)
    pairs = side("a", left).coalesce(1).hint("shuffle_replicate_nl").join(side("b", right).coalesce(tasks), can)
    return pairs.select("a", "b", F.col("da").alias("d"), "ka", "kb", "na", "nb", "va", "vb")


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, BATCH)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _summed(found: list[Cut]) -> DataFrame:
    rows = reduce(DataFrame.union, [x.df for x in found])
    roots = components(rows.select(F.col("k").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "k")
    return rows.groupBy("k").agg(F.sum("links").alias("links")).join(roots, "k")


def _links(blocks: DataFrame, parts: list[Row], cosine: float, eps: float, axes: np.ndarray, kind: np.dtype, group_bytes: int) -> DataFrame:
    """``k, links, root`` of all vectors that have links, group by group; what was found is summed before it outgrows the vectors."""
    spark, width = blocks.sparkSession, LEADING + 1
    rounds, cores, vectors = _rounds(parts, width, eps, group_bytes), spark.sparkContext.defaultParallelism, sum(r["m"] for r in parts)
    size = {r["part"]: r["bytes"] for r in parts}
    found, rows, schema = [], 0, "k long, links long, root long"
    while rounds:
        job = [rounds.pop(0)]
        while rounds and len(job) < ROUNDS and sum(len(right) for _, right in job) < 4 * cores:
            job.append(rounds.pop(0))
        pairs = [_round(blocks, left, right, max(4 * cores, math.ceil(sum(size[i] for i in right) / group_bytes)), width, eps) for left, right in job]
        with _small_batches(spark):
            found.append(Cut(reduce(DataFrame.union, [p.mapInArrow(_joined(cosine, axes, kind), schema) for p in pairs]), "links"))
        rows += found[-1].df.count()
        if rows > MERGE * vectors and len(found) > 1:
            merged = Cut(_summed(found), "links")
            for old in found:
                old.drop()
            found, rows = [merged], merged.df.count()
    return _summed(found) if found else spark.createDataFrame([], schema)


def linked_vectors(embeddings: DataFrame, cosine: float = COSINE, block_bytes: int = BLOCK_BYTES, group: int = GROUP) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: vectors of the same length are linked at ``cosine`` or more.

    Equal vectors (by 128 bits) are one class with a count, so copies are never
    paired. The classes are sorted by the cells, as wide as the largest
    distance of a link, of their leading principal coordinates; the sequence is
    cut into ranges, ranges into blocks, and pairs of either are followed while
    their boxes lie within that distance. Blocks are written once; a task reads
    a group of them and the ranges it meets from there, so that disk follows the
    vectors, not their pairs. Matrix products over the leading coordinates
    exclude most pairs of the blocks that are left, and double precision decides
    on the others. A task passes on counts and a spanning forest, never its links.

    One row per row. Null, empty, zero or non-finite vectors link with nothing
    and stand alone; so do repeated rows of these. Repeated rows of a usable
    vector are other vectors that it links with. A null vec_id never names a
    component that has another id. Other columns are not read; an empty table
    gives no rows. Where the leading dimensions tell nothing, no block can be
    skipped and the join compares all blocks with all.
    """
    element = getattr(embeddings.schema["embedding"].dataType, "elementType", None)
    element = "float" if isinstance(element, T.FloatType) else "double"
    kind = np.dtype(np.float32 if element == "float" else np.float64)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{element}>").alias("v"))
    plain = F.transform("v", lambda x: x + F.lit(0.0).cast(element))  # -0.0 is 0.0
    vectors = rows.where(usable(F.col("v"))).select("vec_id", plain.alias("v")).select("vec_id", "v", *_keyed(F.col("v")))
    lengths = vectors.groupBy(F.size("v").alias("d")).agg(F.approx_count_distinct("h1").alias("n")).collect()
    eps = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9
    axes = directions(vectors, lengths)
    leading = axes[:LEADING]
    cells = [f"c{i}" for i in range(len(leading))]
    placed = vectors.mapInArrow(_cells(leading, eps), f"{SMALL}, v binary, d int, " + ", ".join(f"{c} int" for c in cells))
    order = ["d", *cells, "h1"]
    width = len(leading) + 1
    n_blocks = math.ceil(sum(r["n"] * r["d"] * kind.itemsize for r in lengths) / block_bytes)
    ranges = max(1, min(n_blocks, FINE) + max(0, n_blocks - FINE) // max(1, group // 4))
    schema = "seq long, d int, first long, m long, " + ", ".join(f"{c} array<long>" for c in PLACE) + ", vectors binary, " + ", ".join(
        f"{e}{i} double" for e in ("lo", "hi") for i in range(width)) + ", part long"
    cut = Cut(placed.repartitionByRange(ranges, *order).sortWithinPartitions(*order, "h2").mapInArrow(_to_blocks(block_bytes, leading, kind), schema), "blocks", "part")
    boxes = [F.min(f"lo{i}").alias(f"lo{i}") for i in range(width)] + [F.max(f"hi{i}").alias(f"hi{i}") for i in range(width)]
    parts = cut.df.groupBy("part").agg(F.min("d").alias("d0"), F.max("d").alias("d1"), F.sum("m").alias("m"), F.sum(F.col("m") * F.col("d") * F.lit(kind.itemsize)).alias("bytes"),
                                       F.max("seq").alias("seq"), *boxes).collect()
    # numbers that follow the order, with room for the blocks of the fullest range
    per_range = max((r["seq"] for r in parts), default=0) + 1
    blocks = cut.df.withColumn("node", F.col("part") * per_range + F.col("seq"))
    links = _links(blocks, parts, cosine, eps, axes, kind, group * block_bytes)
    classes = Cut(cut.df.select("first", F.posexplode(F.arrays_zip(*PLACE))).select((F.col("first") + F.col("pos")).alias("k"), "col.*"), "vectors").df
    cut.drop()
    linked = Cut(classes.select("k", "least").join(links, "k"), "vectors").df
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.join(least, "root").select("k", "links", "component_id", F.lit(True).alias("joined"))
    named = classes.join(linked, "k", "left").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                                                     F.when(F.col("joined"), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))
    # one row a vector, even if two ranges held it
    named = named.groupBy("h1", "h2").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = rows.select("vec_id", F.when(usable(F.col("v")), plain).alias("v")).select("vec_id", *_keyed(F.col("v"))).join(named, ["h1", "h2"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                     F.when(F.col("h1").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
