"""Near-duplicate vectors against all pairs."""

import math

import numpy as np
import pytest

from llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, component_id double"


def _plain(rows, least=0.98):
    """vec_id, links, component by comparing all pairs in double precision."""
    def direction(v):
        if v is None or not len(v) or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, np.float32).astype(float)
        return x / np.linalg.norm(x)

    units = [direction(v) for _, v, _ in rows]
    links, parent = [0] * len(rows), {r[0]: r[0] for r in rows if r[0] is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            a, b = rows[i], rows[j]
            if None in (a[0], b[0], a[2], b[2]) or a[2] != b[2] or units[i] is None or units[j] is None:
                continue
            if len(units[i]) == len(units[j]) and (units[i] @ units[j] >= least or list(a[1]) == list(b[1])):
                links[i] += 1
                links[j] += 1
                low, high = sorted((root(a[0]), root(b[0])))
                parent[high] = low
    out = [(r[0], n, None if r[0] is None else root(r[0])) for r, n in zip(rows, links)]
    return sorted(((v, n, c, v is None or v == c) for v, n, c in out), key=repr)


def _got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=repr)


def _frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], l, "x", 1.0) for i, v, l in rows], SCHEMA)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1, 0], 1), (2, [2, 0], 1), (3, [1, 0], 2), (4, [1, 0], None), (5, None, 1), (6, [], 1), (7, [0, 0], 1),
            (8, [nan, 1], 1), (9, [inf, 1], 1), (10, [None, 1], 1), (None, [1, 0], 1), (11, [1, 0], 1), (12, [1, 0, 0], 1),
            (13, [1, 0.2], 1), (14, [-1, 0], 1), (15, [1e30, 1e28], 1), (16, [0, 1], 1), (17, [0, 1], 1), (8, [nan, 1], 1)]
    assert _got(vectors.near_duplicates(_frame(spark, rows))) == _plain(rows)
    assert vectors.near_duplicates(_frame(spark, [])).collect() == []
    assert _got(vectors.near_duplicates(_frame(spark, rows[4:10]))) == _plain(rows[4:10])


@pytest.mark.parametrize("block, queries", [(8192, 65536), (50, 40)])
def test_clusters_equal_all_pairs(spark, block, queries):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(30):
        centre = rng.normal(size=12)
        for _ in range(rng.integers(1, 25)):
            rows.append((len(rows) * 37 % 2003, (centre + rng.normal(size=12) * rng.choice([0.02, 0.08, 0.15])).tolist(), int(rng.integers(0, 2))))
    step = rng.normal(size=12) * 0.06
    start = rng.normal(size=12)
    rows += [(3000 + k, (start + k * step).tolist(), 0) for k in range(40)]
    rows += [(4000 + k, rows[0][1], rows[0][2]) for k in range(60)]
    rows = [(i, np.array(v, np.float32).tolist(), l) for i, v, l in rows]
    got = vectors.near_duplicates(_frame(spark, rows), block=block, queries=queries, most_rows=200, list_rows=20)
    assert _got(got) == _plain(rows)


def test_query_equals_all_pairs(spark, small):
    from llm.queries import QUERIES

    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    assert _got(QUERIES["op2_pq_near_dedup"](spark, small)) == _plain(rows)


def test_probes_and_errors_lose_nothing():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(600, 16))
    base /= np.linalg.norm(base, axis=1)[:, None]
    moved = base + rng.normal(size=base.shape) * 0.04
    moved /= np.linalg.norm(moved, axis=1)[:, None]
    book = vectors.fit(base, 40)
    home, _ = vectors.probes(moved, book.centres, 0.2)
    _, near = vectors.probes(base, book.centres, 0.2)
    close = np.linalg.norm(base - moved, axis=1) <= 0.2
    assert close.sum() > 300 and near[np.arange(600), home][close].all() and near.mean() < 1
