"""Language ID with bit-sliced Bloom filters over character n-grams.

Learning counts the n-grams of all documents of each language (distributed,
summed in every task first).  An n-gram belongs to a language if it makes up at
least ``min_share`` of that language's n-grams, so a language has at most
1 / min_share of them, however large the corpus.  The filter is bit-sliced:
slot s holds a mask with one bit per language, and the AND of an n-gram's
slots gives all languages that contain it at once.

A document counts, per language, its n-grams whose mask has the language's bit;
with false-positive rate f of that language's slice, hits h of n n-grams are
corrected to (h - n f) / (1 - f).  The largest corrected count decides (ties: the
language that sorts first); the score is its share of n, between 0 and 1.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so
is any text when nothing was learnt; texts shorter than an n-gram are padded
with spaces; rows with null lang are not learnt from; an empty table gives no
rows; repeated rows are scored alike; whole texts are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlumen.llm.common import arrow_map

N = 4                  # characters of an n-gram
MIN_SHARE = 2e-5       # of a language's n-grams
SLOTS = 1 << 20
HASHES = 2
HELD = 2_000_000       # n-grams that a counting task holds, of all languages together
UND = "und"
_LETTER = re.compile(r"[^\W\d_]")
_MULT = np.uint64(0x9E3779B97F4A7C15)


def ngrams(text: str) -> np.ndarray:
    """64-bit hashes of all n-grams of the lower-cased text, bounded by spaces."""
    codes = np.frombuffer(f" {text.lower()} ".ljust(N).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    codes[codes < 65] = 32  # digits, signs and line ends are all a border
    h = codes[: len(codes) - N + 1].copy()
    for i in range(1, N):
        h *= _MULT
        h += codes[i: len(codes) - N + 1 + i]
    h ^= h >> np.uint64(29)
    h *= _MULT
    h ^= h >> np.uint64(32)
    return h


def slots(h: np.ndarray) -> list[np.ndarray]:
    m = np.uint64(SLOTS - 1)
    return [(h >> np.uint64(21 * k) & m).astype(np.int64) for k in range(HASHES)]


@dataclass
class Filters:
    """Languages, one mask per slot (row w: languages 64 w to 64 w + 63), false-positive rates."""

    languages: list[str]
    masks: np.ndarray
    rates: np.ndarray

    def hits(self, text: str) -> tuple[int, np.ndarray]:
        """Number of n-grams and, per language, how many of them it contains."""
        h = ngrams(text)
        places = slots(h)
        out = np.zeros(len(self.languages))
        for w, row in enumerate(self.masks):
            m = row[places[0]]
            for p in places[1:]:
                m &= row[p]
            here = min(64, len(out) - 64 * w)
            if here <= 8:
                of = np.bincount(m.astype(np.int64), minlength=1 << here)
                values = np.arange(1 << here)
                out[64 * w: 64 * w + here] = [of[(values >> i & 1) == 1].sum() for i in range(here)]
            else:
                out[64 * w: 64 * w + here] = [np.count_nonzero(m >> np.uint64(i) & np.uint64(1)) for i in range(here)]
        return len(h), out

    def decide(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not any(m[0].isalpha() for m in _LETTER.finditer(text)):
            return UND, 0.0
        n, hits = self.hits(text)
        right = np.clip((hits - n * self.rates) / (1 - self.rates), 0, n)
        best = int(np.argmax(right))
        return self.languages[best], float(right[best] / n)


def count_ngrams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all of ``docs``; each task sums what it has seen."""

    def make():
        held: dict[str, list[np.ndarray]] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        waiting = 0

        def settle():
            nonlocal waiting
            waiting = 0
            for lang in list(held):
                g, c = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
                if lang in sums:
                    g0, c0 = sums[lang]
                    g, at = np.unique(np.concatenate([g0, g]), return_inverse=True)
                    c = np.bincount(at, weights=np.concatenate([c0, c])).astype(np.int64)
                sums[lang] = g, c

        def flush():
            parts = sorted(sums.items())
            sums.clear()
            return {"lang": pa.concat_arrays([pa.repeat(pa.scalar(x, pa.string()), len(g)) for x, (g, _) in parts]),
                    "gram": np.concatenate([g.view(np.int64) for _, (g, _) in parts]),
                    "n": np.concatenate([c for _, (_, c) in parts])} if parts else None

        def step(cols):
            nonlocal waiting
            if cols is None:
                settle()
                return flush()
            for lang, text in zip(cols["lang"], cols["text"], strict=True):
                g = ngrams(text)
                held.setdefault(lang, []).append(g)
                waiting += len(g)
            if waiting < HELD:
                return None
            settle()
            return flush() if sum(len(g) for g, _ in sums.values()) >= HELD else None

        return step

    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    part = arrow_map(known.select(F.col("lang").cast("string").alias("lang"), "text"),
                     "lang string, gram bigint, n bigint", make, finish=True)
    return part.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, min_share: float = MIN_SHARE) -> Filters:
    """Fit the filters to ``docs`` (text, lang).

    The driver gets at most 1 / min_share hashes per language and one row per language.
    """
    from adlumen.session import materialize

    counts, _, _ = materialize(count_ngrams(docs), "ngrams")
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    masks = np.zeros((max(1, -(-len(languages) // 64)), SLOTS), dtype=np.uint64)
    if languages:
        bounds = docs.sparkSession.createDataFrame(
            [(x, k, max(1.0, totals[x] * min_share)) for k, x in enumerate(languages)], "lang string, k int, least double")
        # one pass over the n-grams for all languages; one row per language is broadcast
        own = counts.join(F.broadcast(bounds), "lang").where("n >= least").select("k", "gram").toArrow()
        which, grams = own["k"].to_numpy(), own["gram"].to_numpy().view(np.uint64)
        for p in slots(grams):
            np.bitwise_or.at(masks, (which // 64, p), np.uint64(1) << (which % 64).astype(np.uint64))
    fill = np.array([np.mean(masks[k // 64] >> np.uint64(k % 64) & np.uint64(1)) for k in range(len(languages))])
    return Filters(languages, masks, np.minimum(fill ** HASHES, 0.5))


def identify(docs: DataFrame, filters: Filters, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (default doc_id), lang_pred and score."""
    keep = keep or ["doc_id"]
    sent = docs.sparkSession.sparkContext.broadcast(filters)
    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in keep), "lang_pred string", "score double"])
    cols_in = list(dict.fromkeys([*keep, "text"]))

    def make():
        model = sent.value

        def step(cols):
            said = [model.decide(t) for t in cols["text"]]
            return {c: cols[c] for c in keep} | {"lang_pred": [x for x, _ in said], "score": [y for _, y in said]}

        return step

    return arrow_map(docs.select(*cols_in), schema, make)
