import numpy as np
import pytest

from terrasync.llm import topk


def norms(x):
    return np.sqrt((x.astype(float) ** 2).sum(axis=1))


@pytest.mark.parametrize("seed", range(12))
def test_block_equals_brute_force(monkeypatch, seed):
    monkeypatch.setattr(topk, "SLICE", 64)
    rng = np.random.default_rng(seed)
    n, d = int(rng.integers(1, 900)), int(rng.integers(1, 6))
    c = rng.integers(-50, 50, (n, d)) * rng.integers(1, 100, (n, 1))
    if seed % 3 == 0:
        c[: n // 2] = c[0]
    ids = rng.permutation(n)
    at = rng.integers(0, n, 20)
    got = topk.search_block(ids[at], c[at], norms(c[at]), np.full(20, -np.inf), ids, c, norms(c), 10)
    for i, q in enumerate(at):
        s = c @ c[q]
        best = [j for j in np.lexsort((ids, -s)) if j != q][:10]
        assert got[i] == [(int(s[j]), int(ids[j])) for j in best]


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<float>, norm string")


@pytest.mark.parametrize("n", [7, 5000])
def test_spark_equals_brute_force(spark, monkeypatch, n):
    monkeypatch.setattr(topk, "BLOCK", 700)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 20)
    monkeypatch.setattr(topk, "AT_ONCE", 7)
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(n, 8)) * rng.uniform(0.1, 3, (n, 1))).astype(np.float32)
    x[n // 2 :: 3] = x[0]
    got = topk.top_k(table(spark, [(i, v.tolist()) for i, v in enumerate(x)]), every=50).collect()
    y = np.floor(1024 * x.astype(np.float64)).astype(np.int64)
    for q in range(0, n, 50):
        s = y @ y[q]
        best = [j for j in np.lexsort((np.arange(n), -s)) if j != q][:10]
        mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert mine == [(k + 1, int(j), int(s[j])) for k, j in enumerate(best)]


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]), (5, [2.0]), (6, [0.5, 9.0, 1.0]), (0, [1.0, 0.0]), (7, []), (100, [3e38, 3e38]), (8, [1e30, 0.0])]
    got = topk.top_k(table(spark, rows)).collect()
    assert {r.vec_id for r in got if r.query_id == 0} == {5, 6, 7, 8, 100}
    first = min((r for r in got if r.query_id == 0), key=lambda r: r["rank"])
    assert first.vec_id == 8 and first.score == (1 << 63) - 1  # held to a long; ties to the smaller id
    assert topk.top_k(table(spark, [])).collect() == []
    assert topk.top_k(table(spark, [(100, [1.0])])).collect() == []


def test_repeated_rows_are_candidates_each(spark):
    got = topk.top_k(table(spark, [(0, [1.0]), (1, [2.0]), (1, [3.0]), (1, [3.0]), (2, [-1.0])])).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(1, 1, 3145728), (2, 1, 3145728), (3, 1, 2097152), (4, 2, -1048576)]


def test_small_tables_have_buckets_too(spark, monkeypatch):
    """As few as 500 vectors meet bucket by bucket, and short candidates aren't copied to queries beyond their reach."""
    seen = []
    meet = topk._meet

    def counted(candidates, queries, k):
        seen.append((candidates.select("bucket").distinct().count(), candidates.count(), queries.count()))
        return meet(candidates, queries, k)

    monkeypatch.setattr(topk, "_meet", counted)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 20)
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(500, 4)) * np.geomspace(0.5, 3, 500)[:, None]).astype(np.float32)
    got = topk.top_k(table(spark, [(i, v.tolist()) for i, v in enumerate(x)]), every=5).collect()
    assert seen[0][0] == 1 and seen[1][0] > 2
    assert seen[1][1] < 0.7 * 5 * 500  # five blocks of queries
    y = np.floor(1024 * x.astype(np.float64)).astype(np.int64)
    for q in range(0, 500, 5):
        s = y @ y[q]
        best = [j for j in np.lexsort((np.arange(500), -s)) if j != q][:10]
        assert sorted((r["rank"], r.vec_id) for r in got if r.query_id == q) == [(k + 1, int(j)) for k, j in enumerate(best)]
