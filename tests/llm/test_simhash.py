import random

import xxhash

from halyard.llm import simhash as S

SCHEMA = "doc_id long, text string, node string"


def brute_fingerprint(text, k=4):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in words).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius=4):
    label = dict.fromkeys(fps)
    for f in fps:
        if label[f] is not None:
            continue
        stack, label[f] = [f], f
        while stack:
            x = stack.pop()
            for y in label:
                if label[y] is None and (x ^ y).bit_count() <= radius:
                    label[y] = f
                    stack.append(y)
    groups = {}
    for f, r in label.items():
        groups.setdefault(r, set()).add(f)
    return sorted(sorted(g) for g in groups.values())


def test_fingerprint_against_brute_force():
    for text in (None, "", " \t\n", "One", "a b c", "a b c d", "A b c d e", "x\x1cy z é ÉÀ a b", "w " * 900, "lorem ipsum dolor sit amet " * 40 + "end"):
        assert S.simhash(text) == brute_fingerprint(text)


def test_links_keep_all_components(spark):
    rnd = random.Random(5)
    centres = [rnd.getrandbits(64) for _ in range(25)] + [0]
    fps = set(centres)
    for c in centres:
        for _ in range(30):
            x = c
            for b in rnd.sample(range(64), rnd.choice([1, 2, 3, 4, 5, 6, 9])):
                x ^= 1 << b
            fps.add(x)
    fps |= {rnd.getrandbits(64) for _ in range(200)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f, f) for f in signed], "node long, fp long")
    want = brute_components(sorted(fps))
    found = S.links(nodes, 4)
    pairs = [(r.a, r.b) for r in found.collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 4 and a < b for a, b in pairs)
    roots = {r.node: r.root for r in S.components(found).collect()}
    groups = {}
    for f, s in zip(fps, signed, strict=True):
        groups.setdefault(roots.get(s, s), set()).add(f)
    assert sorted(sorted(g) for g in groups.values()) == want


def test_near_duplicates_rows(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(5, text), (3, text.upper()), (9, text + " more"), (7, None), (8, ""), (None, "alone here"), (1, "other words entirely"), (1, "other words entirely")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).withColumnRenamed("node", "fp")
    out = S.near_duplicates(docs)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in out.collect()), key=str)
    fp = lambda t: f"{brute_fingerprint(t):016x}"
    assert (brute_fingerprint(text) ^ brute_fingerprint(text + " more")).bit_count() <= 4
    want = [(5, fp(text), 3), (3, fp(text), 3), (9, fp(text + " more"), 3), (7, "0" * 16, 7), (8, "0" * 16, 7), (None, fp("alone here"), None), (1, fp("other words entirely"), 1), (1, fp("other words entirely"), 1)]
    assert got == sorted(want, key=str)
    assert S.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (500, 502)], "a long, b long")
    roots = {r.node: r.root for r in S.components(edges).collect()}
    assert roots == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500, 502: 500}


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.near_duplicates(docs).collect()}
    fps = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    group = {f: min(g) for g in brute_components(sorted(set(fps.values()))) for f in g}
    least = {}
    for d, f in fps.items():
        least[group[f]] = min(d, least.get(group[f], d))
    assert got == {d: (f"{f:016x}", least[group[f]]) for d, f in fps.items()}
