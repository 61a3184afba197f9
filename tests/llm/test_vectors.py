"""Embedding near-dedup and connected components against brute force."""

import numpy as np

from touchline.llm import graph, vectors


def brute(rows, cosine=0.93):
    ids = [r[0] for r in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def unit(v):
        if not v or any(x is None for x in v):
            return None
        a = np.array(v, float)
        return a / np.sqrt((a * a).sum()) if np.isfinite(a).all() and a.any() else None

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    units = [unit(r[1]) if r[2] is not None else None for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]):
                if units[i] @ units[j] >= cosine - 1e-12:
                    links[i] += 1
                    links[j] += 1
                    parent[root(i)] = root(j)
    least = {}
    for i in range(len(rows)):
        least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return sorted((ids[i], links[i], least[root(i)], least[root(i)] == ids[i]) for i in range(len(rows)))


def got(df):
    return sorted(tuple(r) for r in vectors.near_duplicates(df).collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1.0) for r in rows], "vec_id long, embedding array<float>, label int, rep string, links double").repartition(4)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0], 1), (2, [2.0, 0.0, -0.0], 1), (3, [1.0, 0.0, 0.0], 1), (4, [1.0, 0.1, 0.0], 1), (5, [1.0, 0.0, 0.0], 2),
            (6, [1.0, 0.0, 0.0], None), (7, None, 1), (8, [], 1), (9, [0.0, 0.0, 0.0], 1), (10, [nan, 0.0, 1.0], 1), (11, [inf, 0.0, 0.0], 1),
            (12, [1.0, None, 0.0], 1), (13, [1.0, 0.0], 1), (14, [1.0, 0.01], 1), (15, [-1.0, 0.0, 0.0], 1), (16, [1e-30, 0.0, 0.0], 1), (17, [3e38, 0.0, 0.0], 1)]
    assert got(frame(spark, rows)) == brute(rows)
    assert vectors.near_duplicates(frame(spark, rows).limit(0)).count() == 0
    assert got(frame(spark, rows[5:7])) == brute(rows[5:7])


def test_clusters_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows, key = [], 0
    for label in range(3):
        for _ in range(25):
            centre = rng.normal(size=16)
            for _ in range(int(rng.integers(1, 25))):
                rows.append((key, (centre + rng.normal(size=16) * rng.choice([0.0, 0.1, 0.25, 0.4])).astype(np.float32).tolist(), label))
                key += 1
    monkeypatch.setattr(vectors, "BLOCK", 20)
    monkeypatch.setattr(vectors, "INTERVAL", 2)
    monkeypatch.setattr(vectors, "LEAF", 4)
    assert got(frame(spark, rows)) == brute(rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(205, 203), (203, 209), (300, 300), (129, 205)]
    out = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(out[i] == 0 for i in range(41)) and all(out[100 + i] == 100 for i in range(30))
    assert out[203] == out[205] == out[209] == 100
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_negative_ids_and_rows_without_id(spark):
    """Components take the smallest id of a row, whatever its sign; rows without an id name none."""
    a, b = [1.0, 0.0, 0.1], [0.0, 1.0, 0.0]
    rows = [(-5, a, "x"), (-3, [1.0, 0.01, 0.1], "x"), (-9, [1.0, 0.02, 0.1], "x"), (4, b, "x"), (0, [0.0, 1.0, 0.05], "x"), (-1, b, "y"),
            (-2 ** 63, [0.3, 0.3, 0.3], "y"), (2 ** 63 - 1, [0.3, 0.3, 0.31], "y")]
    schema = "vec_id long, embedding array<double>, label string"
    assert got(spark.createDataFrame(rows, schema)) == brute(rows)
    lost = [(None, [0.5, 0.0, 0.5], "z"), (None, [0.5, 0.0, 0.51], "z"), (-7, [0.5, 0.0, 0.52], "z"), (None, [0.0, 0.5, 0.0], "w"), (None, [0.0, 0.5, 0.01], "w")]
    found = vectors.near_duplicates(spark.createDataFrame(lost, schema)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(None, 2, -7, True), (None, 2, -7, True), (-7, 2, -7, True), (None, 1, None, True), (None, 1, None, True)], key=repr)
