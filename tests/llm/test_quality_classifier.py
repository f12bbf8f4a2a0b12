import zlib

import numpy as np
from pyspark.sql import functions as F

from halyard.llm import quality as Q


def test_em_recovers_planted_accuracies():
    rng = np.random.default_rng(2)
    n, j = 60_000, len(Q.LABELLERS)
    good = rng.random(n) < 0.8
    right = np.linspace(0.7, 0.97, j)
    cast = rng.random((n, j)) < 0.7
    says_good = np.where(rng.random((n, j)) < right, good[:, None], ~good[:, None])
    v = np.where(cast, np.where(says_good, 1, 2), 0)
    patterns, counts = np.unique((v * 3 ** np.arange(j)[::-1]).sum(1), return_counts=True)
    model = Q.fit_labels(patterns, counts)
    assert abs(model.prior - good.mean()) < 0.02 and np.abs(model.accuracy() - right).max() < 0.03
    q = model.posterior((v * 3 ** np.arange(j)[::-1]).sum(1))
    assert ((q > 0.5) == good).mean() > 0.97


def test_votes_and_features():
    assert Q.votes(None) == Q.votes("") == Q.votes(" \n") == -1
    v = dict(zip([f.__name__ for f in Q.LABELLERS], Q._digits3(np.array([Q.votes("WORD!! OTHER!! THING!! MORE!! " * 20)]))[0].tolist(), strict=True))
    assert v["_capitals"] == v["_shouting"] == 2 and v["_tables"] == 1
    assert Q.features("") is None and Q.features("a").shape == (Q.DIM,) and np.isfinite(Q.features("é 1 ! |" * 999)).all()


def test_against_true_labels(spark):
    """Trained without labels, held against them."""
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = Q.classify(spark.read.parquet(f"{d}/documents.parquet")).join(labels, "doc_id").groupBy("quality", "keep").count().collect()
    n = {(r.quality, r.keep): r["count"] for r in got}
    assert n.get((1, False), 0) <= 0.01 * n[1, True] and n.get((0, True), 0) <= 0.15 * n[0, False]


def test_rows_and_stage(spark, odd_docs):
    out = Q.classify(odd_docs)
    assert out.columns == ["doc_id", "score", "keep"] and out.count() == odd_docs.count()
    by = {r.doc_id: r for r in out.collect()}
    assert all(by[i].score == 0 and not by[i].keep for i in (2, 3, 4)) and by[8].score == by[9].score
    kept = Q.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(r.doc_id or -1 for r in out.filter("keep").collect())
    assert Q.classify(odd_docs.limit(0)).count() == 0
    assert Q.classify(odd_docs.filter(F.col("text").isNull())).first().score == 0


def test_reruns_agree(spark, documents):
    a, b = (sorted(map(tuple, Q.classify(d).collect())) for d in (documents, documents.repartition(5)))
    assert a == b


def test_em_against_loops():
    """The same EM, in plain loops over documents' votes."""
    rng = np.random.default_rng(4)
    j = len(Q.LABELLERS)
    v = rng.choice(3, (40, j), p=[0.4, 0.45, 0.15])
    patterns = [sum(int(x) * 3 ** (j - 1 - i) for i, x in enumerate(row)) for row in v]
    counts = rng.integers(1, 9, 40)
    bad = [sum(x == 2 for x in row) for row in v]
    q = [0.95 if b == 0 else 0.4 if b == 1 else 0.1 for b in bad]
    for _ in range(5):
        prior = (sum(a * n for a, n in zip(q, counts)) + 1) / (sum(counts) + 2)
        prior = min(max(prior, 0.05), 0.98)
        wrong = []
        for i in range(j):
            rates = []
            for good in (False, True):
                weight = [(a if good else 1 - a) * n for a, n in zip(q, counts)]
                says_bad = sum(w for w, row in zip(weight, v) if row[i] == 2)
                cast = sum(w for w, row in zip(weight, v) if row[i])
                rates.append((says_bad + 0.5) / (cast + 1))
            wrong.append(rates if rates[0] >= rates[1] else [sum(rates) / 2] * 2)
        q = []
        for row in v:
            p = [1 - prior, prior]
            for i, x in enumerate(row):
                for k in range(2):
                    p[k] *= 1 if x == 0 else wrong[i][k] if x == 2 else 1 - wrong[i][k]
            q.append(p[1] / sum(p))
    model = Q.fit_labels(np.array(patterns), counts, rounds=5)
    assert np.isclose(model.prior, prior) and np.allclose(model.wrong, wrong)
    assert np.allclose(model.posterior(np.array(patterns)), q)


def brute_features(text):
    kind = {}
    groups = [" \t", "\n\r\v\f", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", None, ".", ",;:", "!", "?", "'\"", "()", "|", "#$%&*@", "-_/\\"]
    for i, g in enumerate(groups):
        for c in range(128, 256) if g is None else g.encode():
            kind[c] = i
    raw = text.encode()
    words, classes = raw.split(), [kind.get(c, 15) for c in raw]
    n, out = len(words), [0.0] * Q.DIM
    for w in words:
        shape = []
        for c in w:
            if not shape or shape[-1] != kind.get(c, 15):
                shape.append(kind.get(c, 15))
        out[zlib.crc32(bytes(shape)) % 512] += 1 / n
    for a, b in zip(classes, classes[1:]):
        out[512 + 16 * a + b] += 1 / (len(classes) - 1)
    out[-2] = sum(a == b for a, b in zip(words, words[1:])) / n
    out[-1] = 1 - sum(len(set(words[i : i + 500])) for i in range(0, n, 500)) / n
    return [x**0.5 * n / (n + 10) for x in out]


def test_features_and_scorer_against_loops():
    texts = ["One, two (three) | 4#5 six six!", "é " + "word Word " * 700, "x"]
    assert all(np.allclose(Q.features(t), brute_features(t), atol=1e-6) for t in texts)
    x, q = np.stack([Q.features(t) for t in texts]), np.array([0.9, 0.1, 0.5])
    w, m, v = [0.0] * (Q.DIM + 1), [0.0] * (Q.DIM + 1), [0.0] * (Q.DIM + 1)
    rows = [[*map(float, r), 1.0] for r in x]
    for step in range(1, 6):
        p = [1 / (1 + np.exp(-sum(a * b for a, b in zip(w, r)))) for r in rows]
        for i in range(len(w)):
            g = sum((p[k] - q[k]) * rows[k][i] for k in range(3)) / 3 + (1e-3 * w[i] / len(w) if i < Q.DIM else 0)
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
        w = [a - 0.05 * (b / (1 - 0.9**step)) / ((c / (1 - 0.999**step)) ** 0.5 + 1e-9) for a, b, c in zip(w, m, v)]
    assert np.allclose(Q.fit_scorer(x, q, steps=5), w, atol=1e-6)


def test_long_repetitive_texts():
    rng = np.random.default_rng(6)
    plain = " ".join(f"w{x}" for x in rng.integers(0, 3000, 20_000))
    dull = " ".join(["buy now cheap pills today"] * 4000)
    vote = lambda t: Q._variety(Q.Text.of(t))
    assert vote(plain) == 1 and vote(dull) == 2 and vote(dull[:3000]) == 2
