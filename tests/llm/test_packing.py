import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from halyard.llm import packing as P


def encode(texts):
    tok = P.tokenizer(P.default_tokenizer()).tok
    return [np.array([*e.ids, 1], "<u4") for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


ODD = ["", " a b", "été ÉTÉ. naïve!!! don't DON'T ... x's's ΣΣ. ΟΔΟΣ İstanbul ẞ", "<|endoftext|> <|startoftext|>.. a<|endoftext|>b", "a\tb\r\nc\x0bd\x1ce f​g", "a.̸ b≠ 中文字. \U0001f600\U0001f600! กำ क़ ﬁ ª Ⅰ 1234.5 a1b2.", "J̌ ǰ Å.,", "'s 'll. re've", "x.'s y!'d z|'ll"]


def test_tokens_of_odd_texts():
    import pyarrow as pa

    flat, at = P.tokenizer(P.default_tokenizer()).ids(pa.array([*ODD, None]), 1)
    assert [flat[i:j].tolist() for i, j in zip(at[:-1], at[1:], strict=True)] == [x.tolist() for x in encode([*ODD, ""])]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aBJAé.,!'sT \n\t<|>enDOfx#$Σ́̌1"), max_size=40))
def test_tokens_of_any_text(text):
    import pyarrow as pa

    flat, _ = P.tokenizer(P.default_tokenizer()).ids(pa.array([text]))
    assert flat.tolist() == encode([text])[0][:-1].tolist()


def test_tokens_around_capitals_and_marks():
    import pyarrow as pa

    for text in ("<|ENDOFTEXT|> A", "<|endoftext|> A", "J̌ Ǩ K̇ É", "THE Cat.", "\u0041\u0323\u0302 B"):
        flat, _ = P.tokenizer(P.default_tokenizer()).ids(pa.array([text]))
        assert flat.tolist() == encode([text])[0][:-1].tolist()


def check(docs, rows):
    want = defaultdict(list)
    for r, ids in zip(rows, encode([r.text for r in rows]), strict=True):
        want[r.doc_id].append(ids)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in docs:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(want)
    for k, found in pieces.items():
        if len(want[k]) == 1:
            ids, at = want[k][0], 0
            for r in sorted(found, key=lambda r: r.start):
                assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
                assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
                at += r.length
            assert at == len(ids)
        else:
            assert sum(r.length for r in found) == sum(map(len, want[k]))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0


def test_query(documents):
    check(P.pack(documents).collect(), documents.collect())
    check(P.pack(documents.repartition(5), pool=4).collect(), documents.collect())


def test_odd_documents(odd_docs):
    check(P.pack(odd_docs, pool=2).collect(), odd_docs.collect())
    assert P.pack(odd_docs.limit(0)).count() == 0


def test_pool_fills_sequences_and_balances_cost():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 700, 4000).tolist()
    n = sum(sizes) // 2048
    pieces, left = [], n * 2048
    for k, s in enumerate(sizes):
        pieces.append((k, 0, min(s, left)))
        left -= pieces[-1][2]
    out = P.pack_pool(pieces, [2048] * n)
    load, cost = np.zeros(n, int), np.zeros(n)
    for _, _, take, s, _ in out:
        load[s] += take
        cost[s] += P.cost(take)
    assert (load == 2048).all()
    first_fit, at = np.zeros(n), 0
    for _, _, s in pieces:  # documents one after the other
        while s:
            take = min(s, 2048 - at % 2048)
            first_fit[at // 2048] += P.cost(take)
            at, s = at + take, s - take
    assert cost.max() - cost.min() < 0.5 * (first_fit.max() - first_fit.min())


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 2047])
def test_powers(n):
    assert sum(P.powers(n)) == n and all(x & (x - 1) == 0 for x in P.powers(n))
