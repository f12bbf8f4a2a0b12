import numpy as np
import pytest

from halyard.llm import mtree as M

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score long"


def brute(rows, k=5, every=50):
    ok = [(i, v) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    dim = max((len(v) for _, v in ok), default=0)
    x = np.zeros((len(ok), dim), np.int64)
    for j, (_, v) in enumerate(ok):
        x[j, : len(v)] = np.floor(256 * np.array(v, np.float32).astype(float))
    out = []
    for a, (i, _) in enumerate(ok):
        if i % every == 0:
            s = x @ x[a]
            best = sorted((-int(s[b]), ok[b][0]) for b in range(len(ok)) if b != a)[:k]
            out += [(i, r, v, -n) for r, (n, v) in enumerate(best, 1)]
    return sorted(out)


def check(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA)
    got = M.top_products(df, **kw)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, kw.get("k", 5), kw.get("every", 50))


def test_clusters_copies_and_ties(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 40)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.05 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(200)]
    rows += [(200 + i, [0.5] * 8) for i in range(120)]  # one vector in many copies
    rows += [(320, [0.0] * 8), (350, [-1.0] * 8)]
    check(spark, rows, every=10)


def test_rings_and_many_pivots(spark, monkeypatch):
    """More rows than the pivots' blocks hold: rings, equal distances among them, and more pivots."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(500)] + [(500 + i, [1.0] * 6) for i in range(100)]
    for most in (3, 1024):
        monkeypatch.setattr(M, "PIVOTS", 2)
        monkeypatch.setattr(M, "MAX_PIVOTS", most)
        monkeypatch.setattr(M, "BLOCK", 20)
        monkeypatch.setattr(M, "LEAF", 8)
        check(spark, rows, every=10)


def test_queries_together_and_alone():
    rng = np.random.default_rng(6)
    raw = np.floor(rng.normal(size=(400, 5)) * 100)
    norms = (raw * raw).sum(1)
    x = np.hstack([raw, np.sqrt(norms.max() - norms)[:, None]])
    tree = M.Tree(pages_of(x), 5, norms.max())
    q = np.hstack([raw, np.zeros((400, 1))])
    together = tree.search_all(np.arange(400), q, 3, np.full(400, -np.inf))
    assert together == [tree.search(i, q[i], 3) for i in range(400)]
    assert together[7] == sorted(((float(raw[i] @ raw[7]), i) for i in range(400) if i != 7), key=lambda t: (-t[0], t[1]))[:3]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, None), (100, [nan, 1.0]), (150, [inf, 1.0]), (200, [None, 1.0]), (250, []), (300, [1.0]), (7, [0.1, 0.2, 0.3]), (None, [1.0, 1.0]), (-50, [-1.0, 0.5])]
    check(spark, rows)
    check(spark, [(0, [1.0])])
    df = spark.createDataFrame([], SCHEMA)
    assert M.top_products(df).count() == 0
    doubles = SCHEMA.replace("float", "double")
    with pytest.raises(ValueError, match="overflow"):
        M.top_products(spark.createDataFrame([(0, [1e200], 0, 1, 2)], doubles))


def test_large_components(spark):
    """Products beyond a double's whole numbers, and beyond a long."""
    rng = np.random.default_rng(8)
    rows = [(i, (rng.integers(-(2**20), 2**20, 3) + 2.0**21).tolist()) for i in range(60)]
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA.replace("float", "double"))
    x = [[int(256 * c) for c in v] for _, v in rows]
    want = []
    for i in (0, 50):
        best = sorted((-sum(a * b for a, b in zip(x[i], y, strict=True)), j) for j, y in enumerate(x) if j != i)[:5]
        want += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    assert any(s > 2**53 for *_, s in want)
    assert sorted(map(tuple, M.top_products(df).collect())) == want
    huge = M.top_products(spark.createDataFrame([(i, [v], 0, 1, 2) for i, v in enumerate([1e30, 1e30, 2e30, -1e30, 0.0])], SCHEMA))
    top, least = 2**63 - 1, -(2**63)
    assert sorted(map(tuple, huge.collect())) == [(0, 1, 1, top), (0, 2, 2, top), (0, 3, 4, 0), (0, 4, 3, least)]


def test_query_against_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = M.top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def pages_of(x):
    import pandas as pd

    out = [(i, p["leaf"], x[p["rows"]].tobytes(), *(a.tobytes() for a in (p["child"].astype(np.int64), p["radius"], p["parent"], p["rows"].astype(np.int64), p["rows"].astype(np.int64)))) for i, p in enumerate(M.build(x, 16, 4))]
    return pd.DataFrame(out, columns=["page", "leaf", "x", "child", "radius", "parent", "rid", "vec_id"])


def test_tree_invariants_and_pruning():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 6)) * 5
    raw = np.floor((centres[rng.integers(0, 20, 2000)] + 0.1 * rng.normal(size=(2000, 6))) * 100)
    norms = (raw * raw).sum(1)
    most = norms.max()
    x = np.hstack([raw, np.sqrt(most - norms)[:, None]])
    pages = M.build(x, 16, 4)
    under = lambda p: [r for r, c in zip(pages[p]["rows"], pages[p]["child"], strict=True) for r in ([r] if c < 0 else under(c))]
    assert sorted(under(0)) == list(range(2000)) and max(len(p["rows"]) for p in pages) <= 16
    for p in pages:
        for r, c, radius in zip(p["rows"], p["child"], p["radius"], strict=True):
            if c >= 0:
                assert np.linalg.norm(x[under(c)] - x[r], axis=1).max() <= radius + 1e-3
                assert np.allclose(pages[c]["parent"], np.linalg.norm(x[pages[c]["rows"]] - x[r], axis=1), atol=1e-3)
    tree = M.Tree(pages_of(x), 6, most)
    for q in range(0, 2000, 97):
        want = sorted(((float(raw[i] @ raw[q]), -i) for i in range(2000) if i != q), reverse=True)[:5]
        assert tree.search(q, np.append(raw[q], 0.0), 5) == [(s, -i) for s, i in want]
    assert tree.seen < 0.6 * 2000 * 21  # many distances were never computed
