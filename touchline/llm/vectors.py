"""Embedding near-dedup by an epsilon grid order join.

Within a label, equal vectors are first combined to one with a count.  The
leading principal axes come from sums over all vectors; a projection onto
them never grows a distance, so vectors whose cells differ by more than one
on any axis cannot be within epsilon (the chord of the cosine bound).  Vectors
are range-partitioned and sorted by (label, cells): the epsilon grid order.
Runs of that sequence form blocks with bounding boxes, runs of blocks form
intervals.  Interval pairs whose boxes are too far apart are skipped, then
block pairs; a surviving block pair is joined recursively in a task: halves
whose boxes are too far apart are skipped, small leaves are compared by a
matrix product in double precision.  A task returns link counts and a
spanning forest of its links, never the pairs.

Defined results: a null label, a null, empty or zero vector or one with a null
or non-finite component links with nothing (n_links 0, a component of its
own); vectors of different lengths never link; copies (repeated rows too) link
with each other; an id names one node: rows that repeat an id add up; a null
id takes part for its partners' counts, but its component_id is that of the
smallest id reachable, if any; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph
from .shared import python_tasks, partitions, store

COSINE = 0.93
#: Leading axes of the grid, vectors in a block, blocks in an interval, vectors in a leaf.
AXES, BLOCK, INTERVAL, LEAF = 6, 1024, 32, 128


def near_duplicates(table: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    python_tasks(table.sparkSession)
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                        F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.col("label").isNotNull() & F.coalesce(finite & F.exists("vec", lambda x: x != 0), F.lit(False))
    # the vector's digest names it in the joins; -0.0 counts as 0.0
    rows = store(rows.withColumn("vec", F.when(valid, F.transform("vec", lambda x: x + F.lit(0.0))))
                 .withColumn("key", F.when(F.col("vec").isNotNull(), F.sha2(F.concat_ws(",", "label", F.col("vec").cast("array<string>")), 256))), "vectors")
    # a stand-in id for copies none of whose rows has an id
    distinct = store(rows.filter("key is not null").groupBy("key")
                     .agg(F.first("label").alias("label"), F.first("vec").alias("vec"),
                          F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
                     .withColumn("rep", F.coalesce("least", -F.abs(F.xxhash64("key")) - 1)), "distinct-vectors")
    links, edges = None, None
    for dim in [r[0] for r in distinct.select(F.size("vec")).distinct().collect()]:
        found = join(distinct.filter(F.size("vec") == dim), dim, cosine)
        part, ties = found.filter("links > 0").select("rep", "links"), found.filter("a is not null").select("a", "b")
        links = part if links is None else links.unionByName(part)
        edges = ties if edges is None else edges.unionByName(ties)
    if links is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    nodes = (distinct.select("key", "rep", "least", "copies").join(counts, "rep", "left")
             .join(graph.components(edges), F.col("rep") == F.col("node"), "left")
             .select("key", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
                     F.coalesce("component", "rep").alias("component")))
    # a component is named by its smallest id of a row; a stand-in, whatever its number, names none
    names = nodes.groupBy("component").agg(F.min("least").alias("named"))
    nodes = nodes.join(names, "component").select("key", "n_links", "named")
    # rows without a key would all meet under null: they stay apart by a key of their own
    joined = rows.select("id", F.coalesce("key", F.concat(F.lit("-"), F.xxhash64("id").cast("string"))).alias("key")).join(nodes, "key", "left")
    component = F.coalesce("named", "id")
    return joined.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                         component.alias("component_id"),
                         F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """The leading principal axes (dim x AXES) of unit vectors, from sums over all of them: a
    partial matrix per task, added up in 16 groups, so the driver gets 16 small matrices."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1))
        for b in batches:
            x = _unit(_matrix(b.column(0), dim))
            x = np.hstack([x, np.ones((len(x), 1))])
            total += x.T @ x
        from pyspark import TaskContext

        yield pa.record_batch([pa.array([TaskContext.get().partitionId() % 16], pa.int32()), pa.array([total.tobytes()])], ["g", "m"])

    def add(pdf):
        import pandas as pd

        total = sum(np.frombuffer(m) for m in pdf["m"])
        return pd.DataFrame({"g": [int(pdf["g"].iloc[0])], "m": [total.tobytes()]})

    sums = (vectors.select("vec").mapInArrow(partial, "g int, m binary").groupBy("g").applyInPandas(add, "g int, m binary").collect())
    m = sum((np.frombuffer(r["m"]).reshape(dim + 1, dim + 1) for r in sums), np.zeros((dim + 1, dim + 1)))
    n = max(m[-1, -1], 1)
    mean = m[-1, :-1] / n
    _, vectors_ = np.linalg.eigh(m[:-1, :-1] / n - np.outer(mean, mean))
    return np.ascontiguousarray(vectors_[:, ::-1][:, :AXES])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    # the largest component first, so that squares neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


BLOCK_SCHEMA = "label string, interval string, block string, low array<double>, high array<double>, reps binary, copies binary, vecs binary"


def join(vectors: DataFrame, dim: int, cosine: float) -> DataFrame:
    """Rows (rep, links) with the links of a vector found in a block pair, and (a, b) edges of
    that pair's spanning forest; the stored result of all block pairs that cannot be skipped."""
    spark = vectors.sparkSession
    basis = axes(vectors, dim)
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-9
    k = basis.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _unit(_matrix(b.column(3), dim))
            p = x @ basis
            cells = np.floor(p / eps).astype(np.int32)
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), *[pa.array(cells[:, j]) for j in range(k)],
                                   pa.array([r.tobytes() for r in p], pa.binary()), pa.array([r.tobytes() for r in x], pa.binary())],
                                  ["label", "rep", "copies", *[f"c{j}" for j in range(k)], "p", "x"])

    cells = ", ".join(f"c{j} int" for j in range(k))
    order = ["label", *[f"c{j}" for j in range(k)], "rep"]
    placed = (vectors.select("label", "rep", "copies", "vec").mapInArrow(project, f"label string, rep long, copies long, {cells}, p binary, x binary")
              .repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, no, label, held = TaskContext.get().partitionId(), 0, None, []

        def block():
            p = np.frombuffer(b"".join(r[2] for r in held)).reshape(-1, k)
            return pa.record_batch([
                pa.array([label]), pa.array([f"{part}-{no // INTERVAL}"]), pa.array([f"{part:08d}-{no:08d}"]),
                pa.array([p.min(0).tolist()], pa.list_(pa.float64())), pa.array([p.max(0).tolist()], pa.list_(pa.float64())),
                pa.array([np.array([r[0] for r in held], np.int64).tobytes()]), pa.array([np.array([r[1] for r in held], np.int64).tobytes()]),
                pa.array([b"".join(r[3] for r in held)])], ["label", "interval", "block", "low", "high", "reps", "copies", "vecs"])

        for b in batches:
            for lab, *r in zip(*[b.column(c).to_pylist() for c in range(5)]):
                if held and (lab != label or len(held) == BLOCK):
                    yield block()
                    no, held = no + 1, []
                label = lab
                held.append(r)
        if held:
            yield block()

    blocks = store(placed.select("label", "rep", "copies", "p", "x").mapInArrow(cut, BLOCK_SCHEMA), "blocks")
    boxes = blocks.select("label", "interval", "block", "low", "high")
    span = lambda f, c, j: f(F.col(c)[j])
    intervals = boxes.groupBy("label", "interval").agg(
        F.array(*[span(F.min, "low", j) for j in range(k)]).alias("low"), F.array(*[span(F.max, "high", j) for j in range(k)]).alias("high"))
    near = _close(intervals, "interval", eps).select("label", F.col("interval").alias("i1"), F.col("interval2").alias("i2"))
    one = boxes.select("label", F.col("interval").alias("i1"), "block", "low", "high")
    two = boxes.select("label", F.col("interval").alias("i2"), F.col("block").alias("block2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    pairs = (near.join(one, ["label", "i1"]).join(two, ["label", "i2"])
             .filter((F.col("i1") < F.col("i2")) | (F.col("block") <= F.col("block2"))).filter(_gap() <= eps * eps).select("block", "block2"))
    data = blocks.select("block", "reps", "copies", "vecs")
    # pairs are dealt evenly by block; a block's data travels with its pairs
    work = (pairs.join(data, "block").withColumnsRenamed({"reps": "reps1", "copies": "copies1", "vecs": "vecs1", "block": "block1"})
            .join(data.withColumnRenamed("block", "block2"), "block2")
            .select("block1", "block2", "reps1", "copies1", "vecs1", "reps", "copies", "vecs"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = [b.column(c)[i].as_py() for c in range(8)]
                rep1, n1, rep2, n2 = (np.frombuffer(r[c], np.int64) for c in (2, 3, 5, 6))
                x1, x2 = np.frombuffer(r[4]).reshape(-1, dim), np.frombuffer(r[7]).reshape(-1, dim)
                counts, ties = _links(x1, x2, n1, n2, basis, eps, cosine, r[0] == r[1])
                names = np.concatenate([rep1, rep2])
                hit = np.flatnonzero(counts)
                yield pa.record_batch([
                    pa.array(np.concatenate([names[hit], np.zeros(len(ties), np.int64)])), pa.array(np.concatenate([counts[hit], np.zeros(len(ties), np.int64)])),
                    pa.array([None] * len(hit) + [int(min(names[s], names[t])) for s, t in ties], pa.int64()),
                    pa.array([None] * len(hit) + [int(max(names[s], names[t])) for s, t in ties], pa.int64())], ["rep", "links", "a", "b"])

    return store(work.mapInArrow(compare, "rep long, links long, a long, b long"), "links")


def _gap():
    """The squared distance of two boxes."""
    apart = F.zip_with(F.arrays_zip("low", "high"), F.arrays_zip("low2", "high2"),
                       lambda s, t: F.greatest(s["low"] - t["high2"], t["low2"] - s["high"], F.lit(0.0)))
    return F.aggregate(apart, F.lit(0.0), lambda total, x: total + x * x)


def _close(boxes: DataFrame, name: str, eps: float) -> DataFrame:
    """Pairs of boxes of a label within eps.  They meet on the cells of the first axis, so
    boxes in distant stretches of the order are never paired."""
    cell = lambda x: F.floor(x / eps)
    first = boxes.withColumn("cell", F.explode(F.sequence(cell(F.col("low")[0]) - 1, cell(F.col("high")[0]) + 1)))
    second = (boxes.withColumn("cell", F.explode(F.sequence(cell(F.col("low")[0]), cell(F.col("high")[0]))))
              .select("label", "cell", F.col(name).alias(f"{name}2"), F.col("low").alias("low2"), F.col("high").alias("high2")))
    return (first.join(second, ["label", "cell"]).filter(F.col(name) <= F.col(f"{name}2")).filter(_gap() <= eps * eps)
            .select("label", name, f"{name}2").distinct())


def _links(x1, x2, n1, n2, basis, eps, cosine, same) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Link counts (copies of the partners) of the vectors of both blocks, and a spanning forest."""
    p1, p2 = x1 @ basis, x2 @ basis
    off = 0 if same else len(x1)
    counts = np.zeros(len(x1) + len(x2), np.int64)
    part = np.arange(len(x1) + len(x2))
    ties: list[tuple[int, int]] = []
    stack = [(0, len(x1), 0, len(x2))]
    while stack:
        a, z, c, e = stack.pop()
        s, t = p1[a:z], p2[c:e]
        apart = np.maximum(0, np.maximum(s.min(0) - t.max(0), t.min(0) - s.max(0)))
        if (same and c >= z) or (apart * apart).sum() > eps * eps:
            continue  # the mirror of a pair of halves, or provably distant
        if max(z - a, e - c) > LEAF:
            h1 = [(a, (a + z) // 2), ((a + z) // 2, z)] if z - a > LEAF else [(a, z)]
            h2 = [(c, (c + e) // 2), ((c + e) // 2, e)] if e - c > LEAF else [(c, e)]
            stack += [(*i, *j) for i in h1 for j in h2]
            continue
        hit = x1[a:z] @ x2[c:e].T >= cosine
        if same:  # each pair of rows once: the first one the later
            hit &= np.arange(a, z)[:, None] > np.arange(c, e)[None, :]
        if not hit.any():
            continue
        counts[a:z] += hit @ n2[c:e]
        counts[off + c:off + e] += n1[a:z] @ hit
        for i in np.flatnonzero(hit.any(1)):
            others = off + c + np.flatnonzero(hit[i])
            while len(others := others[part[others] != part[a + i]]):
                ties.append((a + int(i), int(others[0])))
                part[part == part[others[0]]] = part[a + i]
    return counts, ties
