from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from halyard.llm import copies, mixing, quality
from halyard.llm.fingerprint import shingle_hashes


def similar(a, b):
    x, y = shingle_hashes(a), shingle_hashes(b)
    both = len(np.intersect1d(x, y))
    return both / max(1, len(x) + len(y) - both)


def test_copies_leave_one(spark, odd_docs):
    out = copies.keep_one(odd_docs)
    assert out.columns == odd_docs.columns
    # 1 and null share a text, as do 2 (null) and 3 (empty), and 8 and 9.
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 4, 5, 6, 7, 8]
    assert copies.keep_one(odd_docs.limit(0)).count() == 0


def test_a_large_group_of_near_copies(spark):
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 5000, 300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 400):
        t = list(base)
        for j in rng.choice(300, 3, replace=False):
            t[j] = f"x{i}y{j}"
        rows.append((i, " ".join(t)))
    rows += [(1000 + i, " ".join(f"w{x}" for x in rng.integers(0, 5000, 300))) for i in range(50)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in copies.keep_one(docs).collect()}
    assert kept >= {0, *range(1000, 1050)} and len(kept) <= 53


def test_stages_in_order(spark, sf_dir, documents):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "language ID", "SimHash near-dedup", "mixing", "packing"]
    assert P.ORACLE_SQL is None
    kept = quality.keep_good(documents).select("doc_id")
    docs = documents
    for k, (_, stage) in enumerate(P.STAGES[:-1]):
        out = stage(spark, docs, sf_dir)
        assert out.columns == documents.columns
        if k < 3:  # filters: rows of the input, each at most as often
            assert out.exceptAll(docs).isEmpty()
        out = spark.createDataFrame(out.collect(), out.schema)
        docs = out
    assert docs.join(kept, "doc_id", "left_anti").isEmpty()
    packed = P.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.agg(F.countDistinct("doc_id")).first()[0] == docs.select("doc_id").distinct().count()


def test_run(spark, sf_dir):
    out = P.run(spark, sf_dir)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns)


def corpus(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")


def test_copies_are_found_whatever_the_edit(spark):
    rng = np.random.default_rng(7)
    originals = [[f"w{x}" for x in rng.integers(0, 20000, n)] for n in rng.integers(60, 400, 120)]
    cut = [w[: int(np.ceil(0.84 * len(w)))] for w in originals[:40]]
    longer = [w + [f"v{x}" for x in rng.integers(0, 20000, int(0.2 * len(w)))] for w in originals[40:80]]
    before = [[f"v{x}" for x in rng.integers(0, 20000, int(0.2 * len(w)))] + w for w in originals[80:]]
    texts = [" ".join(w) for w in originals + cut + longer + before]
    assert all(0.8 <= similar(texts[i], texts[120 + i]) < 0.86 for i in range(120))
    kept = {r.doc_id for r in copies.keep_one(corpus(spark, texts)).collect()}
    assert len(kept & set(range(120, 240))) <= 3 and kept >= set(range(120))


def test_groups_of_copies_in_a_crowd(spark):
    """Texts of one template, far from copies of each other, and copies of some of them."""
    rng = np.random.default_rng(11)
    template = [f"w{x}" for x in rng.integers(0, 5000, 300)]

    def changed(words, share):
        out = list(words)
        for j in np.flatnonzero(rng.random(len(out)) < share):
            out[j] = f"x{rng.integers(1 << 40)}"
        return out

    own = [changed(template, 0.025) for _ in range(240)]
    near = [changed(own[i // 3], 0.006) for i in range(180)]
    texts = [" ".join(w) for w in own + near]
    sets = [shingle_hashes(t) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    want = {find(i) for i in range(len(texts))}
    assert 150 < len(want) < 260
    kept = {r.doc_id for r in copies.keep_one(corpus(spark, texts)).collect()}
    assert kept <= want  # no copy is left


def test_pairs_are_verified_on_whole_texts(spark):
    """Pairs around 0.8 of far more shingles than a sketch holds: those at 0.8 or more, no others."""
    rng = np.random.default_rng(13)
    texts = []
    for i in range(120):
        words = [f"w{x}" for x in rng.integers(0, 50000, 1500)]
        texts += [" ".join(words), " ".join(words[: int(1200 + rng.integers(-45, 46))])]
    want = {i for i in range(240) if i % 2 == 0 or similar(texts[i - 1], texts[i]) < 0.8}
    assert 150 < len(want) < 210
    assert {r.doc_id for r in copies.keep_one(corpus(spark, texts)).collect()} == want


def test_documents_against_exact_components(spark, documents):
    rows = [r for r in documents.collect()]
    sets = [shingle_hashes(r.text) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if rows[i].text == rows[j].text or both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[find(i)].append(r.doc_id)
    assert sorted(r.doc_id for r in copies.keep_one(documents).collect()) == sorted(map(min, least.values()))


def test_pairs_over_one_vocabulary(spark):
    """Many pairs of copies, all pairs of the same words in another order: each loses one."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(100):
        a = list(rng.permutation(words))
        b = a[:-1] + ["end"]
        texts += [" ".join(a), " ".join(b)]
    assert all(similar(texts[i], texts[i + 1]) > 0.96 for i in range(0, 200, 2))
    assert sorted(r.doc_id for r in copies.keep_one(corpus(spark, texts)).collect()) == list(range(0, 200, 2))


def test_judge_leaves_doubt_to_the_whole_sets():
    rng = np.random.default_rng(1)
    cut = lambda h: (h[: copies.SKETCH] >> np.uint64(32)).astype(np.uint32).tobytes()
    says = []
    for share in (0.3, 0.8, 0.99):
        both = rng.integers(0, 1 << 63, 4000).astype(np.uint64) << np.uint64(1)
        n = int(len(both) * (1 + share) / 2)  # of each set; ``both`` is their union
        x, y = np.unique(both[:n]), np.unique(both[len(both) - n :])
        says.append(copies.judge(cut(x), cut(y), len(x), len(y)))
    assert says == [0, 2, 1]
    one = np.arange(100, dtype=np.uint64) << np.uint64(40)
    assert copies.judge(cut(one), cut(one), 100, 100) == 1 and copies.judge(cut(one), cut(one[:50]), 100, 50) == 0


def test_names_of_helpers(spark):
    """Columns named as helpers, and a dotted one, come through the stages unchanged."""
    rows = [(i, f"text number {i} of a few words here", "a", 5, 6, 7, 8, "r", 9, 1, 2) for i in range(6)] + [(9, "text number 0 of a few words here", "a", 5, 6, 7, 8, "r", 9, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _size int, _rank int, _h int, _node int, row string, `a.b` int, node int, id int")
    kept = copies.keep_one(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == rows[:6]
    mixed = mixing.emit(mixing.mix(docs))
    assert mixed.columns == docs.columns and {tuple(r)[3:] for r in mixed.collect()} == {rows[0][3:]}
