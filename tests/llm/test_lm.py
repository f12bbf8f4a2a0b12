import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from halyard.llm import lm


def words(t):
    return (t or "").encode().lower().split()


def test_tokens_of_odd_texts():
    texts = ["", None, "A b", " a\tb\r\nc\x0bd\x0ce ", "É é À\x1cà x\u0085y z w", "İ ẞ"]
    codes, distinct, ends = lm.tokens(pa.array(texts))
    got = [[distinct[c] for c in codes[a:b]] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    assert got == [[*words(t), b""] for t in texts]


def check(docs, out, train=lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 != 0):
    counts, rows = Counter(), docs.collect()
    for r in rows:
        if train(r.doc_id):
            counts.update([*words(r.text), b""])
    n, v = sum(counts.values()), len(counts)
    want = defaultdict(list)
    for r in rows:
        t = [*words(r.text), b""]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        want[r.doc_id].append((not train(r.doc_id), len(t), sum(counts[w] > 0 for w in t), n, base))
    got = defaultdict(list)
    for r in out:
        got[r.doc_id].append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score))
        assert r.score <= 1e-6 and math.isfinite(r.score)
    assert {k: len(x) for k, x in got.items()} == {k: len(x) for k, x in want.items()}
    for k in want:
        for a, b in zip(sorted(got[k]), sorted(want[k]), strict=True):
            assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 300, 0])
def test_counts_and_base_against_brute_force(documents, frequent):
    out = lm.score(documents, frequent, rounds=1).collect()
    check(documents, out)


def test_the_model_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = lm.score(docs).filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert out[0] / out[2] > out[1] / out[2] + 0.1


def test_odd_documents(spark, odd_docs):
    check(odd_docs, lm.score(odd_docs).collect())
    assert lm.score(odd_docs.limit(0)).count() == 0
    lone = odd_docs.filter("doc_id IS NULL")  # held out, and nothing to learn from
    row = lm.score(lone).first()
    assert row.held_out and row.n_known == 0 and row.train_tokens == 0
    check(lone, [row])


def test_shares_add_up(spark):
    """Of each leaf: over its known words and, if hashed, its unknown ones."""
    docs = spark.createDataFrame([(i, "a b c der die das a a b xyz qrs tuv " * 3 + f"w{i} " + " ".join(f"v{j}ab" for j in range(50 + i))) for i in range(1, 30)], "doc_id long, text string")
    counts = lm.count_words(docs)
    vocab = lm.vocabulary(counts, 1000)
    assert vocab.n == sum(r.c for r in counts.collect())
    share = np.zeros(lm.LEAVES)
    for w, i in vocab.words.items():
        k = vocab.leaves[i]
        share[k] += 1 if lm._SINGLE[k] else 10 ** (vocab.logs[i] - vocab.log_totals[k])
    hashed = ~lm._SINGLE
    share[hashed] += lm.SMOOTH / 10 ** vocab.log_totals[hashed]
    used = np.unique(vocab.leaves)
    assert np.allclose(share[used], 1) and np.allclose(share[hashed], 1) and (used >= lm.ALONE).any() and hashed[used].any()


def test_probabilities_add_up():
    rng = np.random.default_rng(1)
    draw = lambda *shape: rng.normal(size=shape)
    own = lm.Own(draw(lm.KINDS, lm.CLASSES), draw(lm.KINDS, lm.SLOTS, lm.CLASSES), draw(lm.KINDS, lm.ENDINGS, lm.MEMBERS))
    first, second = lm.tables(lm.Shared(draw(lm.CLASSES), draw(lm.SKIPS, lm.CLASSES), draw(lm.ENDINGS, lm.MEMBERS)), own)
    assert np.allclose(np.exp(first.reshape(-1, lm.CLASSES)).sum(1), 1, atol=1e-4) and np.allclose(np.exp(second.reshape(-1, lm.MEMBERS)).sum(1), 1, atol=1e-4)


def brute_scores(rows, rounds):
    """The whole model in loops over tokens: leaves, features, training and scores."""
    texts = {r.doc_id: [*words(r.text), b""] for r in rows}
    training = [d for d in texts if zlib.crc32(str(d).encode()) % 10 != 0]
    counts = Counter(w for d in training for w in texts[d])
    alone, heads, leaf = [b""], defaultdict(list), {}
    for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        if w and len(alone) < 40:
            alone.append(w)
        elif w and len(heads[zlib.crc32(w[-2:]) % 24]) < 40:
            heads[zlib.crc32(w[-2:]) % 24].append(w)
    place = {w: ("alone", i) for i, w in enumerate(alone)} | {w: (k, i) for k, own in heads.items() for i, w in enumerate(own)}

    def leaf_of(w):
        return place.get(w) or (zlib.crc32(w[-2:]) % 24, 40 + zlib.crc32(w) % 24)

    mass, kinds = Counter(), Counter()
    for w, c in counts.items():
        mass[leaf_of(w)] += c
        kinds[leaf_of(w)] += 1
    klass = lambda x: 64 if x == "start" else x[1] if x[0] == "alone" else 40 + x[0]

    def tokens_of(d):
        line = ["start", "start", *(leaf_of(w) for w in texts[d])]
        for t in range(2, len(line)):
            one, skip, x = line[t - 1], klass(line[t - 2]), line[t]
            yield ("class",), [("bias",), ("skip", skip), ("word", one), ("pair", one, skip * 40503 // 16 % 16)], klass(x)
            if x[0] != "alone":
                yield ("member",), [("kind", x[0]), ("inner", one, x[0])], x[1]

    w = defaultdict(lambda: np.zeros(64))
    seen = [x for d in training for x in tokens_of(d)]
    n = defaultdict(lambda: np.zeros(64))
    for _, features, y in seen:
        for f in features:
            n[f][y] += 1
    for f in [f for f in n if f[0] in ("bias", "kind")]:
        w[f] = np.log((n[f] + 1) / (n[f].sum() + 64))
    for f in [f for f in n if f[0] in ("word", "inner")]:
        q = w["bias",] if f[0] == "word" else w["kind", f[2]]
        q = q - math.log(np.exp(q).sum())
        w[f] = np.log((n[f] + 20 * np.exp(q)) / (n[f].sum() + 20)) - q
    for _ in range(rounds):
        g, h = defaultdict(lambda: np.zeros(64)), defaultdict(lambda: np.zeros(64))
        for _, features, y in seen:
            p = np.exp(sum(w[f] for f in features))
            p /= p.sum()
            for f in features:
                g[f] += p
                g[f][y] -= 1
                h[f] += p * (1 - p)
        for f in g:
            w[f] = w[f] - np.clip(0.5 * (g[f] + 2 * w[f]) / (h[f] + 2), -1, 1)
    out = {}
    for d in texts:
        total = 0.0
        for _, features, y in tokens_of(d):
            z = sum(w[f] for f in features)
            total += (z[y] - math.log(np.exp(z).sum())) / math.log(10)
        for x in texts[d]:
            k = leaf_of(x)
            if k[0] != "alone" and k[1] >= 40:
                total += math.log10((counts[x] + 0.1) / (mass[k] + 0.1 * (kinds[k] + 1)))
        out[d] = total
    return out


def test_scores_against_brute_force(spark, documents):
    docs = documents.filter("doc_id IS NOT NULL").orderBy("doc_id").limit(40).withColumn("text", F.substring("text", 1, 700))
    rows = docs.collect()
    got = {r.doc_id: r.score for r in lm.score(spark.createDataFrame(rows, docs.schema), rounds=3).collect()}
    want = brute_scores(rows, 3)
    assert len(got) == 40 and all(math.isclose(got[d], want[d], rel_tol=1e-4, abs_tol=1e-4) for d in want)


def test_scores_do_not_depend_on_partitions(documents):
    a, b = ({r.doc_id: r.score for r in lm.score(d, rounds=4).collect()} for d in (documents, documents.repartition(5)))
    assert a.keys() == b.keys() and all(math.isclose(a[d], b[d], rel_tol=1e-6) for d in a)
