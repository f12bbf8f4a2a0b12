"""Operator 1, language identification by rank-order n-gram profiles.

A language's profile is the ranked list of its most frequent letter n-grams (one to
three letters, a blank at word ends). A document's own ranked list is compared with
each profile: every n-gram counts how far out of place it is, one that the profile
lacks counts the full length of a profile. The nearest profile wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import give_back, materialise, release, remainder, small_batches

PROFILE = 400
MAX_LANGUAGES = 2000
BLANK = 0x20
#: Characters handled at once; n-grams of longer texts are counted part by part.
PART = 250_000
#: Characters counted before a task hands its counts on.
HELD = 64_000_000
_BITS = 21

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Code point to itself if a letter, else to a blank."""
    global _letters
    if _letters is None:
        points = np.arange(0x110000, dtype=np.uint32)
        is_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        _letters = np.where(is_letter, points, BLANK).astype(np.uint32)
    return _letters


def letter_codes(text: str) -> np.ndarray:
    """Letters of a lower-case text as code points, anything else a blank."""
    return letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def _squeezed(codes: np.ndarray) -> np.ndarray:
    """Each run of blanks as one."""
    blank = codes == BLANK
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return codes[keep]


def _grams(codes: np.ndarray, old: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams in order of code points, counts) of those that end after the first ``old``
    codes. An n-gram is packed into 63 bits, last letter lowest."""
    if len(codes) <= old:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    alphabet = np.flatnonzero(np.bincount(codes)).astype(np.int64)
    place = np.zeros(int(alphabet[-1]) + 1, np.uint32)
    place[alphabet] = np.arange(len(alphabet), dtype=np.uint32)
    a, size = place[codes], len(alphabet)
    # Letters renumbered in order of code points: short keys sort alike and faster. 0 is the blank.
    wide = np.uint64 if size >= 1023 else np.uint32
    bits = _BITS if size >= 1023 else 10
    blank = wide(1) + wide(int(np.searchsorted(alphabet, BLANK))) if BLANK in alphabet else wide(0)
    a = a.astype(wide) + wide(1)
    new = a[old:]
    one, two = new[new != blank], ((a[:-1] << wide(bits)) | a[1:])[max(0, old - 1) :]
    three = (a[:-2] << wide(2 * bits)) | (a[1:-1] << wide(bits)) | a[2:]
    three = three[max(0, old - 2) :][(a[1:-1] != blank)[max(0, old - 2) :]]
    keys, counts = np.unique(np.concatenate((one, two, three)), return_counts=True)
    mask = wide((1 << bits) - 1)
    back = np.concatenate(([0], alphabet))
    out = np.zeros(len(keys), np.int64)
    for shift in (2 * bits, bits, 0):
        out = (out << _BITS) | back[((keys >> wide(shift)) & mask).astype(np.int64)]
    return out, counts


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams in order of code points, counts) of a text of any length: one to three
    letters, a blank at both ends and for each run of anything but letters. Long texts are
    gone through part by part, with the last two codes carried over."""
    text = text.lower()
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    found, last = [], np.array([BLANK], np.uint32)
    for at in range(0, len(text), PART):
        codes = letter_codes(text[at : at + PART])
        ends = [BLANK] if at + PART >= len(text) else []
        line = _squeezed(np.concatenate((last, codes, ends)).astype(np.uint32))
        if len(line) > 1:
            found.append(_grams(line, len(last)))
        last = line[-2:]
    if len(found) < 2:
        return found[0] if found else (np.empty(0, np.int64), np.empty(0, np.int64))
    both, where = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    return both, np.bincount(where, np.concatenate([c for _, c in found]), len(both)).astype(np.int64)


@dataclass
class Profiles:
    """Of at most some MAX_LANGUAGES languages, ``size`` n-grams each: its size doesn't depend on the input."""

    languages: list[str]
    grams: np.ndarray  # all n-grams of any profile, sorted
    ranks: np.ndarray  # (n-grams, languages), ``size`` where a profile lacks one
    size: int

    def ranked(self, text: str | None) -> np.ndarray:
        """The text's most frequent n-grams in order, at most ``size``."""
        keys, counts = gram_counts(text) if text else (np.empty(0, np.int64),) * 2
        return keys[np.argsort(-counts, kind="stable")[: self.size]]

    def similarities(self, top: np.ndarray) -> np.ndarray | None:
        """1 - distance / largest possible distance of a ranked list to each profile; None without a letter."""
        if not len(top) or not self.languages:
            return None
        at = np.minimum(np.searchsorted(self.grams, top), len(self.grams) - 1)
        found = self.grams[at] == top
        place = np.arange(len(top))
        ranks = self.ranks[at[found]]
        off = np.where(ranks == self.size, self.size, np.abs(ranks - place[found][:, None]))
        return 1 - (off.sum(0) + self.size * int((~found).sum())) / (self.size * len(top))

    def nearest(self, text: str | None) -> tuple[str, float]:
        """(language, similarity). Without a letter: ('und', 0). Ties: first by name."""
        s = self.similarities(self.ranked(text))
        return ("und", 0.0) if s is None else (self.languages[int(np.argmax(s))], float(s.max()))


#: The least similarity of a text to its nearest language: SHORT_FLOOR up to FEW distinct
#: n-grams (two words or so), FLOOR from MANY on, in between by their number. On sf0.1 no
#: document is under 0.415 and no piece of one to three words under 0.29; unlearned
#: languages in its alphabet reach 0.20 to 0.36, letter junk of ten words 0.31. Languages
#: of very many characters, whose n-grams hardly fit a profile, would need lower ones.
FLOOR, SHORT_FLOOR, FEW, MANY = 0.38, 0.28, 20, 100


def floor(grams: int) -> float:
    return float(np.interp(grams, (FEW, MANY), (SHORT_FLOOR, FLOOR)))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of each language's n-grams, added up over a task's batches before the shuffle."""
    held: dict[str, list] = {}  # language: what is counted, the texts to come, their length
    waiting = 0

    def add(own: list) -> None:
        if own[1]:
            own[0].append(gram_counts(" ".join(own[1])))
            own[1], own[2] = [], 0

    def total(own: list) -> tuple[np.ndarray, np.ndarray]:
        keys, where = np.unique(np.concatenate([k for k, _ in own[0]]), return_inverse=True)
        return keys, np.bincount(where, np.concatenate([c for _, c in own[0]]), len(keys)).astype(np.int64)

    def out() -> Iterator[pd.DataFrame]:
        for lang, own in held.items():
            add(own)
            keys, counts = total(own)
            yield pd.DataFrame({"lang": lang, "gram": keys, "n": counts})
        held.clear()

    for pdf in batches:
        for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
            own = held.setdefault(lang, [[], [], 0])
            own[1].append(text)
            own[2] += len(text)
            waiting += len(text)
            if own[2] >= PART:
                add(own)
                if len(own[0]) > 16:
                    own[0] = [total(own)]
        if waiting > HELD:  # a bound on texts held, whatever the number of languages
            yield from out()
            waiting = 0
    yield from out()
    give_back()


def learn(labelled: DataFrame, size: int = PROFILE) -> list[Profiles]:
    """Profiles from all rows of (text, lang); rows with a null of either are left out.

    Only the ``size`` most frequent n-grams of each language leave the cluster. Languages
    are dealt by hash to parts of some MAX_LANGUAGES / 2: one part, unless they are very many."""
    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    total = rows.mapInPandas(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram")))
    top, at = materialise(total.withColumn("rank", rank - 1).filter(F.col("rank") < size).select("lang", "gram", "rank"), "profiles")
    many = top.filter("rank = 0").count()
    parts = 1 if many <= MAX_LANGUAGES else -(-2 * many // MAX_LANGUAGES)
    out = []
    for part in range(parts):
        own = top.filter(F.pmod(F.xxhash64("lang"), F.lit(parts)) == part).toPandas()
        languages = sorted(own["lang"].unique())
        grams = np.unique(own["gram"].to_numpy(np.int64))
        ranks = np.full((len(grams), len(languages)), size, np.int32)
        place = {x: i for i, x in enumerate(languages)}
        ranks[np.searchsorted(grams, own["gram"]), [place[x] for x in own["lang"]]] = own["rank"]
        out.append(Profiles(languages, grams, ranks, size))
    release(labelled.sparkSession, at)
    return out


def predictor(profiles: Profiles, spark):
    """A column function: text to struct (lang_pred, score)."""
    shared = spark.sparkContext.broadcast(profiles)

    @F.pandas_udf("lang_pred string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in parts:
            yield pd.DataFrame([own.nearest(t) for t in texts], columns=["lang_pred", "score"])
        give_back()

    return predict


def identify(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, whole texts.

    Learns from rows whose crc32 of doc_id modulo 4 is not 2 (null id: the empty text)
    and that have a lang and a text. Prediction sees the text alone. Null text or no
    letter, or nothing to learn from: 'und', score 0. Repeated rows agree; ties go to
    the n-gram and the language first in code point order. An empty table stays empty.
    Any number of languages: each part of their profiles names its nearest.
    """
    held = remainder("doc_id", 4) == 2
    found = [predictor(p, docs.sparkSession)(F.col("text")) for p in learn(docs.filter(~held), size)]
    out = docs.select("doc_id", held.alias("held_out"), F.array(*found).alias("_p"))
    # The highest score, then the first name.
    best = F.expr("aggregate(_p, _p[0], (x, y) -> IF(y.score > x.score OR (y.score = x.score AND y.lang_pred < x.lang_pred), y, x))")
    return out.select("doc_id", "held_out", best.alias("_p")).select("doc_id", "held_out", "_p.lang_pred", "_p.score")


#: A declared language this far behind the nearest is taken to be wrong. Documents that
#: mix languages lie well under it, mislabelled ones well over.
MOST_BEHIND = 0.15


def keep_identified(docs: DataFrame, size: int = PROFILE, most: float = MOST_BEHIND) -> DataFrame:
    """Rows in a recognisable language that is, where ``lang`` declares one, the declared one.

    Rejects null texts, texts without a letter, texts whose similarity to the nearest
    language is under ``floor``, whatever ``lang`` is, and texts whose declared language is
    behind the nearest by ``most``. Repeated rows are judged alike; an empty table stays
    empty. All columns of ``docs`` stay, whatever their names.
    """
    said = [_standing(p, docs.sparkSession)(F.col("text").cast("string"), F.col("lang").cast("string")) for p in learn(docs, size)]
    every = F.array(*said)
    best = F.array_max(F.transform(every, lambda x: x["best"]))
    own = F.array_max(F.transform(every, lambda x: x["own"]))  # null unless declared and learnt
    least = F.array_max(F.transform(every, lambda x: x["least"]))
    return docs.filter(F.coalesce((best >= least) & (F.coalesce(best - own, F.lit(0.0)) < most), F.lit(False)))


def _standing(profiles: Profiles, spark):
    """A column function of text and lang: similarity to the nearest language, the least
    that will do, and the similarity to ``lang`` (null if it isn't learnt); nulls without a letter."""
    shared = spark.sparkContext.broadcast(profiles)

    @F.pandas_udf("best double, least double, own double")
    def standing(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        p = shared.value
        place = {x: i for i, x in enumerate(p.languages)}
        for texts, langs in parts:
            out = []
            for t, lang in zip(texts, langs, strict=True):
                top = p.ranked(t)
                s = p.similarities(top)
                out.append((None, None, None) if s is None else (float(s.max()), floor(len(top)), float(s[place[lang]]) if lang in place else None))
            yield pd.DataFrame(out, columns=["best", "least", "own"], dtype="float64")
        give_back()

    return standing
