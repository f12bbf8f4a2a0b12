"""Operator 2, cost-balanced packing of documents into sequences.

Tokens are cut into pools of whole sequences. Within a pool the documents, longest
first, each go to the sequence of the lowest cost (linear plus quadratic in the length
of each of its pieces) that has room; where none has, the document is cut to fill the
one with the most room. A pool is full to the last token. What remains at the end of a
partition, less than one sequence, is split at powers of two, which need no padding.
"""

from __future__ import annotations

import heapq
import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LONG_WORD, give_back

LENGTH, POOL, END = 2048, 256, 1
#: Cost of a piece of n tokens: LINEAR * n + n * n, as attention sees pieces apart.
LINEAR = 4096
MAX_WORDS = 300_000
_TRAIL = ".,!?;:&$%*#|"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Ids of a text, by cached words.

    The vocabulary drops white space, so no token spans two words: encoding words apart
    and joining the ids is exact. A word is split further only between letters and a
    tail of ASCII punctuation, where the vocabulary's own rule always cuts. Words that
    are nothing but letters, lower-cased and composed, are all that its normaliser and
    its splitter would leave whole, so they go straight to its merges, many at once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.tok.model)  # the same model, shared
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.cache: dict[str, bytes] = {"": b""}
        self.recent: list[str] = []
        self.long: list[str] = []  # keys of the cache that go when the texts at hand are done

    def forget(self) -> None:
        """Keep only the words of the last texts, the commonest among them: a Python worker goes on to serve other operators."""
        self.cache = {"": b""} | {w: self.cache[w] for w in self.recent if w in self.cache}

    def _learn(self, words: list[str]) -> None:
        """Fill the cache for words not in it."""
        cache, stems, whole, parts = self.cache, set(), set(), []
        for w in words:
            if w.isalpha() and w.isascii() and w.islower():
                stems.add(w)
                continue
            stem = w.rstrip(_TRAIL)
            if stem.isascii():
                low = stem.lower()
            else:
                stem = unicodedata.normalize("NFC", stem) if "\u03a3" not in stem else ""
                low = stem.lower()
            if low.isalpha():
                tail = w[len(w.rstrip(_TRAIL)) :]
                if not tail and low == w:
                    stems.add(w)
                    continue
                parts.append((w, low, tail))
                if low not in cache:
                    stems.add(low)
                if tail not in cache:
                    whole.add(tail)
            else:
                whole.add(w)
        stems = list(stems)
        for i in range(0, len(stems), 1000):
            some = stems[i : i + 1000]
            ids = np.array(self.merges.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            at = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(at) != len(some):  # not one token group for each word: leave it to the tokenizer
                whole.update(some)
                continue
            raw, start = ids.astype("<u4").tobytes(), 0
            for w, stop in zip(some, at.tolist(), strict=True):
                cache[w] = raw[start:stop]
                start = stop
        whole = list(whole)
        for w, e in zip(whole, self.tok.encode_batch_fast(whole, add_special_tokens=False), strict=True):
            cache[w] = np.array(e.ids, "<u4").tobytes()
        for w, low, tail in parts:
            cache[w] = cache[low] + cache[tail]
        self.long += [w for some in (words, stems, whole) for w in some if len(w) > LONG_WORD]

    def ids(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's ids begin and the last ends); null is empty.

        The distinct words of the texts are looked up once; the rest is array work."""
        cache = self.cache
        if texts.offset:  # see _lots
            texts = pc.take(texts, np.arange(len(texts)))
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lower = pc.ascii_lower(texts)
        # The vocabulary is in lower case. A-Z may be lowered first unless that made a special
        # token, or a letter would then be composed with a mark that it isn't composed with now.
        if not pc.any(pc.match_substring(lower, "<|")).as_py() and not pc.any(pc.match_substring_regex(texts, r"[A-Z]\p{M}")).as_py():
            texts = lower
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        ends = words.offsets.to_numpy()[1:] - words.offsets[0].as_py()
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        parts = list(map(cache.get, distinct))
        if None in parts:
            self._learn([w for w, x in zip(distinct, parts, strict=True) if x is None])
            parts = [cache[w] if x is None else x for w, x in zip(distinct, parts, strict=True)]
        for w in self.long:
            cache.pop(w, None)
        self.long.clear()
        self.recent = distinct
        if len(cache) > MAX_WORDS:
            self.forget()
        at = coded.indices.to_numpy().astype(np.int64)
        if end is not None:
            parts.append(int(end).to_bytes(4, "little"))
            at = np.insert(at, ends, len(distinct))
            ends = ends + np.arange(1, len(ends) + 1)
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        first = np.cumsum(size) - size
        known = np.frombuffer(b"".join(parts), "<u4")
        n = size[at]
        stop = np.cumsum(n)
        flat = known[np.repeat(first[at] - (stop - n), n) + np.arange(n.sum())]
        return flat, np.concatenate(([0], stop))[np.concatenate(([0], ends))]


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def cost(n: int) -> int:
    return LINEAR * n + n * n


def pack_pool(pieces: list[tuple[int, int, int]], rooms: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length) into sequences of the given rooms, which add up
    to the pieces' tokens. Returns (document, start, length, sequence, offset)."""
    room = np.array(rooms, np.int64)
    size = room.copy()
    load = np.zeros(len(rooms), np.int64)
    heap = [(-n, doc, start) for doc, start, n in pieces if n]
    heapq.heapify(heap)
    out = []
    while heap:
        neg, doc, start = heapq.heappop(heap)
        n = -neg
        fits = np.flatnonzero(room >= n)
        if len(fits):
            s, take = int(fits[np.argmin(load[fits])]), n
        else:
            s = int(np.argmax(room))
            take = int(room[s])
        out.append((doc, start, take, s, int(size[s] - room[s])))
        room[s] -= take
        load[s] += cost(take)
        if take < n:
            heapq.heappush(heap, (take - n, doc, start + take))
    return out


def powers(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"


#: Bytes of text that are tokenized at once, unless one text is longer.
LOT = 4_000_000


# The lots are copied out with ``take``: string kernels of pyarrow 23 read a slice of
# large strings at a wrong offset.
def _lots(texts: pa.Array) -> Iterator[tuple[int, int]]:
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        done = size[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(size, done + LOT, "right")))
        yield at, stop
        at = stop


def _packer(path: str, length: int, pool: int, end: int | None):
    names = [c.split()[0] for c in _SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        base = TaskContext.get().partitionId() << 40
        seq, held, tokens = 0, [], 0  # held: (doc_id, ids, start) still to be packed

        def close(rooms: list[int]) -> pa.RecordBatch:
            nonlocal seq, held, tokens
            want, pieces, kept = sum(rooms), [], []
            for k, (doc_id, ids, start) in enumerate(held):
                n = len(ids) - start
                take = min(n, want)
                want -= take
                if take:
                    pieces.append((k, start, take))
                if take < n:
                    kept.append((doc_id, ids, start + take))
            rows = []
            for k, start, n, s, offset in pack_pool(pieces, rooms):
                doc_id, ids, _ = held[k]
                rows.append((doc_id, start, n, zlib.crc32(ids[start : start + n]), len(ids), base + seq + s, offset, rooms[s]))
            seq += len(rooms)
            held, tokens = kept, tokens - sum(rooms)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)

        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for a, b in _lots(texts):
                flat, at = tok.ids(pc.take(texts, np.arange(a, b)), end)
                for doc_id, i, j in zip(doc_ids[a:b], at[:-1].tolist(), at[1:].tolist(), strict=True):
                    held.append((doc_id, flat[i:j], 0))
                    tokens += j - i
                    while tokens >= pool * length:
                        yield close([length] * pool)
        tok.forget()
        give_back()
        full, rest = divmod(tokens, length)
        if tokens:
            yield close([length] * full + powers(rest))

    return run


def pack(docs: DataFrame, tokenizer_path: str | None = None, length: int = LENGTH, pool: int = POOL, end: int | None = END) -> DataFrame:
    """One row for each piece of a document in a sequence.

    No shuffle: a partition packs its own documents pool by pool and holds one pool of
    ids at a time; its last tokens make at most log2(length) short sequences, whose
    lengths are powers of two. A document longer than a sequence is cut, each id lies
    in one piece. Null text: empty, so one end token. Null id: kept as null. Repeated
    rows are packed each. An empty table gives no sequence. Other columns are left out.
    """
    path = tokenizer_path or default_tokenizer()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(_packer(path, length, pool, end), _SCHEMA)
