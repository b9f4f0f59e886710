"""Benchmark decontamination by latent semantic retrieval.

The benchmark's items are the stated queries; they come in the order of their
ids in blocks of ``BLOCK`` passages, each block in two passes over all documents.  Items of more than
``PASSAGE`` words give overlapping passages, a quarter of their length apart, so
an excerpt that would suffice at one place of the item suffices at any other.

1. Every task turns its documents into passages over the block's terms and sums
   document frequencies and (TF^T TF) Omega, the sketch of a randomised SVD; the
   sums are added in a tree of tasks.  As A = TF D with
   D = diag(idf), taking D^-1 Omega as test matrix makes D (TF^T TF) Omega the
   sketch of A^T A, so idf and sketch need one pass.  The benchmark's passages
   are added with the same total energy as the corpus, so that their terms are
   among the leading directions.  The sketch has ``OVERSAMPLE`` columns more than
   dimensions; the small matrix between test matrix and sketch and an SVD (the
   single-pass Nystroem form) give the leading right singular vectors of A.
2. Overlapping windows of every document are projected and compared with all
   passages of the block by cosine; a window must also contain ``CONTAINED`` of
   the passage's length along its direction.  The latent space blurs as passages
   per dimension grow and as passages get shorter than the window, so every place
   that has ``SHINGLE`` words in a row of a passage is a candidate as well.
   Candidates are checked exactly: the
   longest common subsequence of the words around the window with the passage,
   and, for paraphrases, whether the answer is there, that is the passage's rarest terms.

A document is contaminated by a passage if the subsequence covers ``VERBATIM``
of it, or covers ``PARAPHRASE`` of it and the text has ``ANSWER`` of the answer.

Items with fewer than ``LEAST`` words are found by their whole run of words, in
one pass for all of them.  In scripts written without spaces every character
counts as a word, so their passages are found by characters in a row.

Defined cases: null and empty texts have no words and are clean; an item
without words is in no document; items that repeat are each reported; a document row that repeats is reported once; a null
doc_id is reported as null; an empty table on either side gives no rows.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlumen.llm.common import arrow_map, steps, tree_sum

STRIDE = 16                   # words; a window is three strides
PASSAGE = 3 * STRIDE
DIMENSIONS = 128
OVERSAMPLE = 10               # columns of the sketch beyond the dimensions
RANK = 1e-6                   # directions of less energy than this share of the first are noise
COSINE = 0.35
CONTAINED = 0.45              # of a passage's vector must lie in the window's
VERBATIM, PARAPHRASE, ANSWER = 0.75, 0.6, 0.7
LEAST = 6
SHINGLE = 3                   # words in a row that make a candidate by themselves
BLOCK = 2048
CELLS = 1 << 26               # terms times passages of a block at most: one byte each in a task
SEED = 5
PAIRS = 1 << 14               # windows and passages that are bounded at once
RUN = 32                      # rows of a key that are added place by place
_WORD = re.compile(r"\w+")
#: Latin-1 bytes with all but word characters blanked.
_LATIN = bytes(c if chr(c).isalnum() or chr(c) == "_" else 32 for c in range(256))
# Thai, Lao, Myanmar, Khmer, kana, Han (extensions as well): no spaces between words
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_ANY_UNSPACED = re.compile(f"[{_UNSPACED}]")
_WORD_OR_CHARACTER = re.compile(f"[{_UNSPACED}]|[^\\W{_UNSPACED}]+")


def split_words(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores, in lower case; single characters of unspaced scripts."""
    if not text:
        return []
    text = text.lower()
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        if _ANY_UNSPACED.search(text):
            return _WORD_OR_CHARACTER.findall(text)
        return _WORD.findall(text)
    return raw.translate(_LATIN).decode("latin-1").split()  # the same words, much faster


@dataclass
class Block:
    """Passages of the benchmark and the terms they are made of."""

    items: list[int | None]
    passages: list[np.ndarray]       # term numbers in order
    terms: dict[str, int]

    def counts(self) -> np.ndarray:
        tf = np.zeros((len(self.passages), len(self.terms)), dtype=np.float32)
        for row, p in zip(tf, self.passages, strict=True):
            np.add.at(row, p, 1)
        return tf


def _make_block(items, passages) -> Block:
    terms: dict[str, int] = {}
    coded = [np.array([terms.setdefault(w, len(terms)) for w in p], dtype=np.int32) for p in passages]
    return Block(items, coded, terms)


def passage_spans(n: int) -> list[tuple[int, int]]:
    """Passages of an item of ``n`` words.

    Besides the parts that do not overlap there is one of ``width`` words at
    every ``width // 4`` words: any ``VERBATIM`` of a width in a row lies in one of them.
    """
    parts = max(1, -(-n // PASSAGE))
    spans = {(int(x[0]), int(x[-1]) + 1) for x in np.array_split(np.arange(n), parts)}
    if parts > 1:
        width = n // parts
        spans.update((at, at + width) for at in [*range(0, n - width, width // 4), n - width])
    return sorted(spans)


def benchmark_blocks(benchmark: DataFrame, size: int = BLOCK) -> Iterator[Block]:
    """The benchmark in blocks, by item_id; long items are cut into overlapping passages.

    A block ends, also inside an item, at ``size`` passages, or at ``CELLS`` if they are rich in terms.
    """
    items: list[int | None] = []
    passages: list[list[str]] = []
    terms: set[str] = set()
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    for r in rows.where(F.col("text").isNotNull()).orderBy("item_id", "text").toLocalIterator():
        words = split_words(r.text)
        if len(words) < LEAST:
            continue
        for start, end in passage_spans(len(words)):
            items.append(r.item_id)
            passages.append(words[start:end])
            terms.update(passages[-1])
            if len(passages) >= size or len(passages) * len(terms) >= CELLS:
                yield _make_block(items, passages)
                items, passages, terms = [], [], set()
    if passages:
        yield _make_block(items, passages)


def _coder(terms: dict[str, int]):
    """text -> term number of each of its words (-1: not in the block)."""
    get = terms.get

    def code(text: str | None) -> np.ndarray:
        words = split_words(text)
        return np.fromiter(map(get, words, itertools.repeat(-1)), dtype=np.int32, count=len(words))

    return code


def _occurrences(ids: list[np.ndarray], width: int, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Terms of several texts: span number and term of each, the texts'
    first spans, and the number of spans (``width`` words; ``gap`` empty spans after a text)."""
    spans, terms, first, at = [], [], [], 0
    for x in ids:
        first.append(at)
        known = np.flatnonzero(x >= 0)
        spans.append(at + known // width)
        terms.append(x[known])
        at += -(-len(x) // width) + gap
    return np.concatenate(spans), np.concatenate(terms), np.array(first, dtype=np.int64), at


def _sums(source: np.ndarray, rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (sorted) keys and, of each, the sum of ``source[rows]`` over its places.

    A key's places are cut into runs of ``RUN``; the first places of all runs
    are added at once, then the second ones, and so on, longest runs first.
    """
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    end = np.append(start[1:], len(keys))
    runs = -(-(end - start) // RUN)
    first = np.cumsum(runs) - runs
    key = np.repeat(np.arange(len(start)), runs)
    begin = start[key] + (np.arange(len(key)) - first[key]) * RUN
    size = np.minimum(RUN, end[key] - begin)
    order = np.argsort(-size, kind="stable")
    begin = begin[order]
    total = source[rows[begin]]
    for k in range(1, int(size.max(initial=1))):
        n = np.count_nonzero(size > k)
        total[:n] += source[rows[begin[:n] + k]]
    out = np.empty_like(total)
    out[order] = total
    return keys[start], out if len(key) == len(start) else np.add.reduceat(out, first, axis=0)


def corpus_sketch(docs: DataFrame, block: Block, omega: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Passages of the corpus, and by term: document frequency, sum of squared
    counts, and its row of (TF^T TF) Omega."""
    import pyarrow as pa

    n, k = omega.shape
    sent = docs.sparkSession.sparkContext.broadcast((block.terms, omega))

    def run(batches):
        terms, om = sent.value
        code = _coder(terms)
        df, squares, sketch, passages = np.zeros(n), np.zeros(n), np.zeros((n, k)), 0
        for cols in steps(batches, "text"):
            span, term, _, count = _occurrences([code(t) for t in cols["text"]], PASSAGE, 0)
            passages += count
            if not len(term):
                continue
            pair, tf = np.unique(span * n + term, return_counts=True)
            df += np.bincount(pair % n, minlength=n)
            squares += np.bincount(pair % n, weights=tf.astype(float) ** 2, minlength=n)
            for a in range(0, count, 4096):  # whole passages, a bounded number at a time
                lo, hi = np.searchsorted(span, [a, a + 4096])
                if lo == hi:
                    continue
                keys, z = _sums(om, term[lo:hi], span[lo:hi])
                order = lo + np.argsort(term[lo:hi], kind="stable")
                t, y = _sums(z, np.searchsorted(keys, span[order]), term[order])
                sketch[t] += y
        flat = np.concatenate([[passages], df, squares, sketch.ravel()]).astype(np.float32)
        yield pa.RecordBatch.from_pydict({"v": [flat.tobytes()]}, schema=pa.schema([("v", pa.binary())]))

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "v binary")
    v = tree_sum(parts, "float32")
    if v is None:
        v = np.zeros(1 + n * (k + 2), dtype=np.float32)
    return float(v[0]), v[1: n + 1], v[n + 1: 2 * n + 1], v[2 * n + 1:].reshape(n, k)


@dataclass
class Index:
    """Term vectors of the latent space, the passages in it, and what the exact checks need."""

    block: Block
    vectors: np.ndarray
    embedded: np.ndarray
    norms: np.ndarray
    answers: list[frozenset]


def singular_vectors(test: np.ndarray, sketch: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` leading right singular vectors of A, from ``sketch`` = A^T A ``test``.

    A^T A is about sketch (test^T sketch)^+ sketch^T = B B^T, and the left
    singular vectors of B are the right ones of A.
    """
    core = test.T @ sketch
    energy, rotation = np.linalg.eigh((core + core.T) / 2)
    full = energy > RANK * max(energy[-1], 0.0)
    b = sketch @ (rotation[:, full] / np.sqrt(energy[full]))
    vectors, values, _ = np.linalg.svd(b, full_matrices=False)
    return vectors[:, :k][:, values[:k] ** 2 > RANK * values[:1] ** 2]


def build_index(docs: DataFrame, block: Block, dimensions: int = DIMENSIONS) -> Index:
    tf = block.counts()
    n = tf.shape[1]
    omega = np.random.default_rng(SEED).standard_normal((n, min(dimensions + OVERSAMPLE, n))).astype(np.float32)
    passages, df, squares, sketch = corpus_sketch(docs, block, omega)
    own = (tf > 0).sum(axis=0)
    idf = np.log((1 + passages + len(tf)) / (1 + df + own)) + 1e-3
    energy, own_energy = float((idf ** 2 * squares).sum()), float(((tf * idf) ** 2).sum())
    y = idf[:, None] * (sketch / max(energy, 1e-9) + tf.T @ (tf @ omega) / max(own_energy, 1e-9))
    basis = singular_vectors(omega / idf[:, None], y, dimensions)
    vectors = (idf[:, None] * basis).astype(np.float32)
    e = tf @ vectors
    norms = np.maximum(np.linalg.norm(e, axis=1), 1e-9)
    e /= norms[:, None]
    answers = []
    for p in block.passages:
        rare = sorted(set(p.tolist()), key=lambda t: (-idf[t], t))
        answers.append(frozenset(rare[: max(2, -(-len(rare) // 5))]))
    return Index(block, vectors, e.astype(np.float32), norms.astype(np.float32), answers)


def common_subsequence(masks: dict[int, int], length: int, words) -> int:
    """Length of the longest common subsequence with a passage, bit-parallel
    (``masks``: positions of each term in the passage)."""
    full = (1 << length) - 1
    v = full
    for w in words:
        m = masks.get(w)
        if m is not None:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return length - v.bit_count()


class Step:
    """Term numbers of several texts end to end, a gap (-1) after each."""

    def __init__(self, texts: list[np.ndarray]):
        self.texts = texts
        gap = np.array([-1], dtype=np.int32)
        self.ids = np.concatenate([x for t in texts for x in (t, gap)])
        self.length = np.array([len(t) for t in texts], dtype=np.int64)
        self.begin = np.cumsum(self.length + 1) - self.length - 1

    def near(self, text: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the words around windows begin and end: a stride before, the window, a stride after."""
        return (self.begin[text] + np.maximum(window - 1, 0) * STRIDE,
                self.begin[text] + np.minimum((window + 4) * STRIDE, self.length[text]))


class Shingles:
    """All runs of ``SHINGLE`` words of a block's passages, by exact keys."""

    def __init__(self, block: Block):
        self.base = max(1, len(block.terms))  # at most some 10^5 terms: the cube fits a bigint
        found = [(self.keys(p), k) for k, p in enumerate(block.passages)]
        keys = np.concatenate([x for x, _ in found])
        order = np.argsort(keys, kind="stable")
        self.passage = np.concatenate([np.full(len(x), k) for x, k in found])[order]
        self.offset = np.concatenate([np.arange(len(x)) for x, _ in found])[order]
        self.known, self.first, self.places = np.unique(keys[order], return_index=True, return_counts=True)

    def keys(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.int64)
        key = np.zeros(max(0, len(x) - SHINGLE + 1), dtype=np.int64)
        for k in range(SHINGLE):
            key = key * self.base + x[k: len(x) - SHINGLE + 1 + k]
        return key

    def hits(self, step: Step) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, window, passage): where a passage would begin if its shingle stands in a text."""
        ids = step.ids
        at = np.flatnonzero(ids >= 0)
        at = at[: max(0, len(at) - SHINGLE + 1)][at[SHINGLE - 1:] - at[: max(0, len(at) - SHINGLE + 1)] == SHINGLE - 1]
        key = np.zeros(len(at), dtype=np.int64)
        for k in range(SHINGLE):
            key = key * self.base + ids[at + k]
        place = np.minimum(np.searchsorted(self.known, key), len(self.known) - 1)
        hit = self.known[place] == key
        at, place = at[hit], place[hit]
        times = self.places[place]
        row = np.repeat(self.first[place] + times - np.cumsum(times), times) + np.arange(times.sum())
        at = np.repeat(at, times)
        text = np.searchsorted(step.begin, at, side="right") - 1
        window = np.maximum(at - step.begin[text] - self.offset[row], 0) // STRIDE
        return text, window, self.passage[row]


MATCH = ("doc_id bigint, item_id bigint, cosine double, common_words int, passage_words int, "
         "share double, answer_share double, first_word bigint")


def _search(index: Index):
    block = index.block
    code = _coder(block.terms)
    masks: list[dict[int, int]] = []
    for p in block.passages:
        m: dict[int, int] = {}
        for i, t in enumerate(p.tolist()):
            m[t] = m.get(t, 0) | 1 << i
        masks.append(m)
    passages = np.ascontiguousarray(index.embedded.T)
    shingles = Shingles(block)
    enough = CONTAINED * index.norms[None, :]

    # how often each term stands in each passage: bounds a common subsequence from
    # above; the last row is for words that no passage has
    n_terms = len(block.terms)
    held = np.zeros((n_terms + 1, len(block.passages)), dtype=np.uint8)  # a passage has at most PASSAGE words
    for k, p in enumerate(block.passages):
        np.add.at(held[:, k], p, 1)
    lengths = np.array([len(p) for p in block.passages])
    least = PARAPHRASE * lengths

    def possible(at: Step, text, window, p) -> np.ndarray:
        """Whether the distinct words around a window could hold enough of the passage."""
        out = np.zeros(len(p), dtype=bool)
        for a in range(0, len(p), PAIRS):
            some = slice(a, a + PAIRS)
            begin, end = at.near(text[some], window[some])
            place = begin[:, None] + np.arange(5 * STRIDE)
            words = at.ids[np.minimum(place, len(at.ids) - 1)]
            words = np.sort(np.where((place < end[:, None]) & (words >= 0), words, n_terms), axis=1)
            words[:, 1:][words[:, 1:] == words[:, :-1]] = n_terms
            out[some] = held[words, p[some, None]].sum(axis=1, dtype=np.uint8) >= least[p[some]]  # at most PASSAGE
        return out

    def candidates(ids: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, window, passage) of all windows near a passage."""
        span, term, first, count = _occurrences(ids, STRIDE, 2)
        if not len(term):
            return
        for a in range(0, count, 4096):
            lo, hi = np.searchsorted(span, [a, a + 4096 + 2])
            if lo == hi:
                continue
            sums = np.zeros((4096 + 2, index.vectors.shape[1]), dtype=np.float32)
            keys, rows = _sums(index.vectors, term[lo:hi], span[lo:hi])
            sums[keys - a] = rows
            windows = sums[:-2] + sums[1:-1] + sums[2:]
            norm = np.sqrt(np.einsum("ij,ij->i", windows, windows))
            full = np.flatnonzero(norm > 1e-6)
            product = windows[full] @ passages
            at, p = np.nonzero(product >= np.maximum(COSINE * norm[full][:, None], enough))
            place = full[at] + a
            text = np.searchsorted(first, place, side="right") - 1
            yield text, place - first[text], p

    def pairs(at: Step) -> Iterator[tuple[int, int, int]]:
        """Distinct (text, window, passage) of both searches that an exact check may confirm."""
        found = [np.stack(x) for x in (*candidates(at.texts), shingles.hits(at))]
        text, window, p = np.unique(np.concatenate(found, axis=1), axis=1)
        keep = possible(at, text, window, p)
        yield from zip(text[keep].tolist(), window[keep].tolist(), p[keep].tolist(), strict=True)

    def closeness(ids: np.ndarray, window: int, p: int) -> float:
        words = ids[window * STRIDE: window * STRIDE + PASSAGE]
        v = index.vectors[words[words >= 0]].sum(axis=0)
        return float(v @ index.embedded[p]) / max(float(np.linalg.norm(v)), 1e-9)

    def step(cols):
        out: dict[str, list] = {c.split()[0]: [] for c in MATCH.split(", ")}
        ids = [code(t) for t in cols["text"]]
        at = Step(ids)
        best: dict[tuple[int, int | None], tuple] = {}
        for (text, window), group in itertools.groupby(pairs(at), key=lambda x: x[:2]):
            begin, end = at.near(text, window)
            words = at.ids[begin:end]
            words = words[words >= 0].tolist()
            for _, _, p in group:
                common = common_subsequence(masks[p], int(lengths[p]), words)
                share, answer = common / int(lengths[p]), index.answers[p]
                answer = len(answer.intersection(words)) / len(answer)
                if share < VERBATIM and not (share >= PARAPHRASE and answer >= ANSWER):
                    continue
                key, cosine = (text, block.items[p]), closeness(ids[text], window, p)
                if key not in best or (share, cosine) > (best[key][2], best[key][0]):
                    best[key] = (cosine, common, share, answer, int(lengths[p]), window * STRIDE)
        for (text, item), (cosine, common, share, answer, length, start) in best.items():
            for name, value in zip(out, (cols["doc_id"][text], item, cosine, common, length, share, answer, start),
                                   strict=True):
                out[name].append(value)
        return out

    return step


def short_items(benchmark: DataFrame, size: int = 50 * BLOCK) -> Iterator[dict[tuple, list]]:
    """The items of fewer than ``LEAST`` words, as ids by words, some at a time."""
    def make():
        def step(cols):
            words = [split_words(t) for t in cols["text"]]
            keep = [k for k, w in enumerate(words) if 0 < len(w) < LEAST]
            return {"item_id": [cols["item_id"][k] for k in keep], "words": [words[k] for k in keep]}

        return step

    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    found: dict[tuple, list] = {}
    n = 0
    for r in arrow_map(items, "item_id bigint, words array<string>", make).distinct().toLocalIterator():
        found.setdefault(tuple(r.words), []).append(r.item_id)
        n += 1
        if n >= size:
            yield found
            found, n = {}, 0
    if n:
        yield found


def _search_short(items: dict[tuple, list]):
    """Whole items of few words: the first place of each in every text."""
    sizes = sorted({len(k) for k in items})
    starts = {k[0] for k in items}

    def step(cols):
        out: dict[str, list] = {c.split()[0]: [] for c in MATCH.split(", ")}
        for doc_id, text in zip(cols["doc_id"], cols["text"], strict=True):
            words, seen = split_words(text), set()
            for at, word in enumerate(words):
                if word not in starts:
                    continue
                for n in sizes:
                    key = tuple(words[at: at + n])
                    if len(key) < n or key in seen or key not in items:
                        continue
                    seen.add(key)
                    for item in items[key]:
                        for name, value in zip(out, (doc_id, item, 1.0, n, n, 1.0, 1.0, at), strict=True):
                            out[name].append(value)
        return out

    return step


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per (doc_id, item_id) of a document that holds a benchmark passage."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = spark.createDataFrame([], MATCH)
    for block in benchmark_blocks(benchmark):
        sent = spark.sparkContext.broadcast(build_index(rows, block))
        found = found.unionByName(arrow_map(rows, MATCH, lambda sent=sent: _search(sent.value)))
    for items in short_items(benchmark):
        few = spark.sparkContext.broadcast(items)
        found = found.unionByName(arrow_map(rows, MATCH, lambda few=few: _search_short(few.value)))
    # blocks and passages of one item meet here; only matches are shuffled
    best = F.max(F.struct("share", "cosine", *[c for c in found.columns if c not in
                                               ("doc_id", "item_id", "share", "cosine")])).alias("m")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", *[f"m.{c}" for c in found.columns if c not in ("doc_id", "item_id")])
