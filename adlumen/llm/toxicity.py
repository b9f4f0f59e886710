"""Toxicity by a gap-weighted subsequence kernel, Nyström landmarks and an SVM.

Texts are folded to letters and spaces: case, accents, digits and signs go, so
characters put between an insult's letters vanish or count as gaps.  The unit
is a window of ``WINDOW`` letters.  The kernel of two windows sums, over the
letter subsequences of length 4 that both contain within a span of 7, the decay
``DECAY`` to the number of skipped characters in each; so ``id x iot`` keeps
most of what ``idiot`` has.

Documents, not windows, are labelled, so training is multiple-instance: from a
bounded sample of labelled documents (``MOST`` per label) the windows with the
letter 5-grams that toxic documents have more often are taken first; an SVM
(squared hinge, on Nyström features) is fitted, and the windows that it scores
highest in each document replace them; copies with a letter or space put in
teach it to tolerate gaps.  A space counts only as a subsequence's first symbol,
where it marks the start of a word.  Landmarks are up to ``LANDMARKS``
strings: the commonest cores of those first windows (the letters that their
strongest 5-grams cover), and windows of documents that are not toxic.

Because f(s) = sum_j beta_j k(s, landmark_j) is linear in the subsequence
features, the landmarks fold into one weight per feature; scoring a text is one
table look-up per subsequence, over the whole text.  A document's evidence is
the margin of its highest window and the mean of the next two that do not
overlap it; a logistic fit over both makes it a probability.

Defined cases: a null text is empty; texts without letters have the margin of
an empty window and so a low score; null labels are not learnt from; with
labels of one kind only every score is that label's share (0 without labels);
repeated rows score alike, and of the rows of one doc_id one is learnt from; an
empty table gives no rows.
"""

from __future__ import annotations

import functools
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlumen.llm.common import arrow_map, remainder, small_side
from adlumen.session import materialize

WINDOW = 16
SPAN = 7               # letters a subsequence may reach over
DECAY = 0.7           # per skipped character
LANDMARKS = 512
MOST = 4000            # labelled documents of each label that are learnt from
GRAMS = 4096           # 5-grams that seed the first windows
ROUNDS = 4
NEAR = 0.4
HIGHEST = 3            # windows of a document that decide
SEED = 11
TABLE = 1 << 20        # 32 letters, four at a time


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code of each character below U+0250: 1-26 letters, 0 white space, 255 dropped."""
    out = np.full(0x250, 255, dtype=np.uint8)
    for c in range(0x250):
        base = unicodedata.normalize("NFD", chr(c).lower())[0]
        base = "s" if base == "ß" else base
        if "a" <= base <= "z":
            out[c] = ord(base) - 96
        elif chr(c).isspace():
            out[c] = 0
    return out


def fold(text: str | None) -> np.ndarray:
    """Letters and single spaces of a text as codes (letters beyond U+0250: 27 to 31)."""
    u = np.frombuffer((text or "").encode("utf-32-le"), dtype="<u4")
    c = _letters()[np.minimum(u, 0x24F)]
    if len(u) and u.max() >= 0x250:
        wide = u >= 0x250
        c[wide] = 27 + u[wide] % 5
        c[wide & (u >= 0x2000) & (u < 0x2070)] = 255  # general punctuation
    c = c[c != 255]
    if len(c):
        c = c[(c != 0) | np.concatenate([[True], c[1:] != c[:-1]])]
    if len(c) > 2:  # a space between two words of one letter each goes: spelled-out words
        gap = np.concatenate([[False, True], c == 0, [True, False]])
        one = np.flatnonzero(c == 0)
        one = one[gap[one] & gap[one + 4]]
        c = np.delete(c, one)
    return c


def _padded(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts in one array with a window's worth of spaces after each, and their starts."""
    starts = np.cumsum([0, *(len(c) + WINDOW for c in codes)])
    out = np.zeros(starts[-1], dtype=np.int32)
    for s, c in zip(starts, codes, strict=False):
        out[s: s + len(c)] = c
    return out, starts


def subsequences(c: np.ndarray):
    """Per pattern: skipped characters, and the feature of each start (0: has a space).

    A start reaches ``SPAN`` letters on, so the last SPAN - 1 starts are left out.
    """
    n = len(c) - SPAN + 1
    if n <= 0:
        return
    at = [c[k: k + n] for k in range(SPAN)]
    first = at[0] << 15
    for a in range(1, SPAN - 2):
        one = first + (at[a] << 10)
        for b in range(a + 1, SPAN - 1):
            two = one + (at[b] << 5)
            for d in range(b + 1, SPAN):
                yield d - 3, two + at[d]


@functools.lru_cache(maxsize=1)
def _spaced() -> np.ndarray:
    """Features with a space after their first symbol; they count nothing (a first space marks a word's start)."""
    i = np.arange(TABLE)
    return ((i & 31) == 0) | ((i >> 5 & 31) == 0) | ((i >> 10 & 31) == 0)


def margins(c: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of the table over every window of ``c`` (one value per window start)."""
    n = len(c) - SPAN + 1
    sums = [np.zeros(max(n, 0)) for _ in range(SPAN - 3)]
    for gap, index in subsequences(c):
        sums[gap] += table[index]
    total = sum(DECAY ** g * s for g, s in enumerate(sums))
    run = np.concatenate([[0.0], np.cumsum(total)])
    width = WINDOW - SPAN + 1
    return run[width:] - run[:-width] if n >= width else np.zeros(0)


def five_grams(c: np.ndarray) -> np.ndarray:
    c = c.astype(np.int64)
    if len(c) < 5:
        return np.zeros(0, dtype=np.int64)
    return (((c[:-4] << 20) + (c[1:-3] << 15)) + ((c[2:-2] << 10) + (c[3:-1] << 5))) + c[4:]


@dataclass
class Model:
    table: np.ndarray      # weight of each subsequence feature
    base: float            # margin of a window without any
    slopes: np.ndarray     # of the highest margin, of the mean of the next two, and the constant
    constant: float | None = None

    def document_margins(self, texts: list) -> np.ndarray:
        """Per text the highest margin and the mean of the next two, of windows that don't overlap."""
        out = np.zeros((len(texts), 2))
        for at, codes in _blocks([fold(t) for t in texts]):
            c, starts = _padded(codes)
            m = margins(np.concatenate([c, np.zeros(WINDOW, np.int32)]), self.table)
            for k, x in enumerate(codes):  # windows that start in a text; they end in the spaces after it
                own = m[starts[k]: starts[k] + max(1, len(x))]
                out[at + k] = _evidence(own, _best(own, HIGHEST))
        return out + self.base

    def score(self, texts: list) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.document_margins(texts) @ self.slopes[:2] + self.slopes[2], -30, 30)))


def _blocks(codes: list[np.ndarray], most: int = 32_768):
    """Consecutive texts of about ``most`` letters together."""
    at = 0
    while at < len(codes):
        n, size = 0, 0
        while at + n < len(codes) and (n == 0 or size + len(codes[at + n]) <= most):
            size += len(codes[at + n])
            n += 1
        yield at, codes[at: at + n]
        at += n


def sample_documents(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column,
                     most: int = MOST) -> tuple[DataFrame, dict[int, int]]:
    """y and folded codes of about ``most`` labelled documents of each label, and the labels' counts."""
    rows = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
    rows = rows.where(F.col("y").isin(0, 1) & learn_from).distinct()
    count = {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("y") == 1, F.lit(most / max(count.get(1, 0), 1))).otherwise(F.lit(most / max(count.get(0, 0), 1)))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    chosen = small_side(chosen, "toxic-labels")

    def make():
        return lambda cols: {"y": cols["y"], "codes": [fold(t).tobytes() for t in cols["text"]]}

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # of the rows of one doc_id only that with the smallest hash, so that rows are as few as ids
    named = F.struct(F.xxhash64("text").alias("h"), "text")
    texts = texts.join(chosen, "doc_id").groupBy("doc_id", "y").agg(F.min(named).alias("row"))
    found = arrow_map(texts.select("y", F.col("row.text").alias("text")), "y int, codes binary", make)
    return materialize(found, "toxic-sample")[0], count


def seed_grams(sample: DataFrame, n: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """5-grams that toxic documents have more often, and lift times root of support."""

    def make():
        held: list[list[np.ndarray]] = [[], []]

        def step(cols):
            if cols is not None:
                for y, codes in zip(cols["y"], cols["codes"], strict=True):
                    held[y].append(np.unique(five_grams(np.frombuffer(codes, dtype=np.uint8))))
                if sum(map(len, held)) < 2000:
                    return None
            out: dict[str, list] = {"gram": [], "pos": [], "neg": []}
            for y in (0, 1):
                if held[y]:
                    g, k = np.unique(np.concatenate(held[y]), return_counts=True)
                    held[y].clear()
                    out["gram"] += g.tolist()
                    out["pos"] += (k * y).tolist()
                    out["neg"] += (k * (1 - y)).tolist()
            return out if out["gram"] else None

        return step

    parts = arrow_map(sample, "gram bigint, pos bigint, neg bigint", make, text=None, finish=True)
    both = parts.groupBy("gram").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    lift = F.log((F.col("pos") + 0.5) / (n[1] + 1.0)) - F.log((F.col("neg") + 0.5) / (n[0] + 1.0))
    top = (both.where(F.col("pos") >= max(3, n[1] // 300)).withColumn("w", lift).where("w > 1.5")
               .withColumn("z", F.col("w") * F.sqrt("pos")).orderBy(F.desc("z"), "gram").limit(GRAMS))
    rows = sorted((r.gram, r.z) for r in top.select("gram", "z").collect())
    return np.array([g for g, _ in rows], dtype=np.int64), np.array([w for _, w in rows])


def _evidence(m: np.ndarray, best: list[int]) -> tuple[float, float]:
    """The highest margin and the mean of the next; an absent window has none of the features, so 0."""
    v = [float(m[i]) for i in best] + [0.0] * (HIGHEST - len(best))
    return v[0], sum(v[1:]) / (HIGHEST - 1)


def _best(m: np.ndarray, k: int) -> list[int]:
    """Starts of the ``k`` highest windows that do not overlap."""
    m, out = m.copy(), []
    for _ in range(k):
        i = int(np.argmax(m)) if len(m) else -1
        if i < 0 or not np.isfinite(m[i]):
            break
        out.append(i)
        m[max(0, i - WINDOW + 1): i + WINDOW] = -np.inf
    return out


def windows(sample: DataFrame, score) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(y, evidence, codes) of each document's highest windows by ``score`` (codes -> window values).

    Bounded by the sample: three windows of a document at most.  Of a toxic
    document the further ones must come to ``NEAR`` of the highest.  The first
    window of each document has the document's evidence, the others NaN.
    """

    def make():
        rng = np.random.default_rng(SEED)

        def step(cols):
            out: dict[str, list] = {"y": [], "m": [], "next": [], "codes": []}
            for y, raw in zip(cols["y"], cols["codes"], strict=True):
                c = np.concatenate([np.zeros(4, np.int32), np.frombuffer(raw, dtype=np.uint8).astype(np.int32),
                                    np.zeros(WINDOW, np.int32)])
                m = score(c)
                at = _best(m, HIGHEST)
                top, further = _evidence(m, at)
                if y:
                    at = at[:1] + [i for i in at[1:] if m[i] >= NEAR * m[at[0]] > 0]
                elif len(m):
                    at = [*at[:2], int(rng.integers(len(m)))]
                for k, i in enumerate(at):
                    out["y"].append(y)
                    out["m"].append(float("nan") if k else top)
                    out["next"].append(further)
                    out["codes"].append(c[i: i + WINDOW].astype(np.uint8).tobytes())
            return out

        return step

    rows = arrow_map(sample, "y int, m double, next double, codes binary", make, text=None).collect()
    rows.sort(key=lambda r: (r.y, r.codes))
    codes = np.array([np.frombuffer(bytes(r.codes), dtype=np.uint8) for r in rows], dtype=np.int32)
    return np.array([r.y for r in rows]), np.array([(r.m, r.next) for r in rows]), codes.reshape(len(rows), WINDOW)


def _features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (windows x subsequences) and the weight of each column."""
    flat, weight = [], []
    for gap, index in subsequences(codes.T):
        flat.append(index.T)
        weight.append(np.full(index.shape[0], DECAY ** gap))
    return np.hstack(flat), np.concatenate(weight)


class Kernel:
    """Kernel values of windows against fixed landmarks."""

    def __init__(self, landmarks: np.ndarray):
        index, weight = _features(landmarks)
        self.used = np.setdiff1d(np.unique(index), np.flatnonzero(_spaced()))
        self.matrix = np.zeros((len(self.used) + 1, len(landmarks)))
        for j, row in enumerate(index):
            at = self.place(row)
            np.add.at(self.matrix[:, j], at, weight)
        self.matrix[-1] = 0

    def place(self, features: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.used, features)
        at[at == len(self.used)] = 0
        return np.where(self.used[at] == features, at, len(self.used)) if len(self.used) else at

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), self.matrix.shape[1]))
        for a in range(0, len(codes), 64):
            index, weight = _features(codes[a: a + 64])
            out[a: a + 64] = np.einsum("sfm,f->sm", self.matrix[self.place(index)], weight)
        return out


def svm(z: np.ndarray, y: np.ndarray, w: np.ndarray | None = None, c: float = 100.0) -> np.ndarray:
    """Linear SVM with squared hinge loss and balanced labels, by Newton steps from ``w`` (default zero).

    The last column of ``z`` is the constant's; rows are added up in blocks.
    """
    sign = np.where(y == 1, 1.0, -1.0)
    cost = c * np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w, ridge = np.zeros(z.shape[1]) if w is None else w, np.eye(z.shape[1])
    ridge[-1, -1] = 1e-6

    def reach(w):
        return sign * np.concatenate([z[k: k + 4096] @ w for k in range(0, len(z), 4096)])

    def loss(w):
        return 0.5 * w @ ridge @ w + 0.5 * (cost * np.maximum(0, 1 - reach(w)) ** 2).sum()

    for _ in range(30):
        inside = np.flatnonzero(reach(w) < 1)
        grad, curve = ridge @ w, ridge.copy()
        for k in range(0, len(inside), 4096):
            i = inside[k: k + 4096]
            a = z[i].astype(np.float64)
            grad -= a.T @ (cost[i] * (sign[i] - a @ w))
            curve += (a.T * cost[i]) @ a
        step = np.linalg.solve(curve, grad)
        size, now = 1.0, loss(w)
        while loss(w - size * step) > now and size > 1e-4:
            size /= 2
        w = w - size * step
        if np.abs(step).max() < 1e-6:
            break
    return w


def cores(codes: np.ndarray, grams: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Windows with only the letters that their strongest 5-grams cover, moved
    to the front; the commonest first."""
    found: Counter = Counter()
    for c in codes:
        g = five_grams(c)
        at = np.minimum(np.searchsorted(grams, g), len(grams) - 1)
        w = np.where(grams[at] == g, weights[at], 0.0)
        if w.max(initial=0) <= 0:
            continue
        cover = np.zeros(WINDOW, dtype=bool)
        for i in np.flatnonzero(w >= 0.8 * w.max()):
            cover[i: i + 5] = True
        kept = bytes(np.where(cover, c, 0).astype(np.uint8)).strip(b"\0")
        if len(kept) >= 4:
            found[kept] += 1
    top = sorted(found, key=lambda k: (-found[k], k))
    rows = [np.frombuffer(k.ljust(WINDOW, b"\0"), dtype=np.uint8) for k in top]
    return np.array(rows, dtype=np.int32).reshape(len(rows), WINDOW)


def with_gaps(codes: np.ndarray, times: int = 2) -> np.ndarray:
    """Copies of windows with a letter or space put in at a random place."""
    rng = np.random.default_rng(SEED)
    out = np.repeat(codes, times, axis=0)
    at = rng.integers(2, WINDOW - 2, len(out))
    new = np.where(rng.random(len(out)) < 0.5, 0, rng.integers(1, 27, len(out)))
    col = np.arange(WINDOW)[None, :]
    moved = np.where(col > at[:, None], np.roll(out, 1, axis=1), out)
    return np.where(col == at[:, None], new[:, None], moved).astype(codes.dtype)


class Nystrom:
    """Kernel features of windows from fixed landmarks, and the SVM's weights folded back."""

    def __init__(self, marks: np.ndarray):
        self.marks, self.kernel = marks, Kernel(marks)
        among = self.kernel(marks)
        self.scale = max(np.median(np.diag(among)), 1e-9)
        value, vector = np.linalg.eigh(among / self.scale)
        keep = value > 1e-6 * value.max()
        self.root = vector[:, keep] / np.sqrt(value[keep])      # K^(-1/2) on its range

    def features(self, codes: np.ndarray) -> np.ndarray:
        """The last column is the constant's."""
        z = np.ones((len(codes), self.root.shape[1] + 1), dtype=np.float32)
        for a in range(0, len(codes), 1024):
            z[a: a + 1024, :-1] = self.kernel(codes[a: a + 1024]) / self.scale @ self.root
        return z

    def table(self, w: np.ndarray) -> np.ndarray:
        """Weight of each subsequence feature."""
        beta = self.root @ w[:-1] / self.scale
        table = np.zeros(TABLE)
        index, weight = _features(self.marks)
        np.add.at(table, index.ravel(), np.outer(beta, weight).ravel())
        table[_spaced()] = 0
        return table.astype(np.float32)


def logistic(m: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Slopes and constant of P(y = 1 | evidence), with a slight pull to a slope of 1 for the highest margin."""
    x = np.hstack([m, np.ones((len(m), 1))])
    pull, ridge = np.array([1.0, 0.0, 0.0]), np.diag([1e-2, 1e-2, 1e-4])
    w = pull
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge @ (w - pull)
        h = (x.T * (weight * np.maximum(p * (1 - p), 1e-6))) @ x + ridge
        step = np.linalg.solve(h, g)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return np.array([max(w[0], 1e-3), max(w[1], 0.0), w[2]])


def fit(sample: DataFrame, counts: dict[int, int], rounds: int = ROUNDS) -> Model:
    nothing = np.zeros(0)
    n = {0: 0, 1: 0} | {r.y: r.n for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n[0] or not n[1]:
        return Model(nothing, 0.0, nothing, constant=float(n[1] > 0))
    grams, lifts = seed_grams(sample, n)

    def by_grams(c):
        g = five_grams(c)
        at = np.minimum(np.searchsorted(grams, g), max(len(grams) - 1, 0))
        v = np.where(grams[at] == g, lifts[at], 0.0) if len(grams) else np.zeros(len(g))
        # only 5-grams early in a window count, so that subsequences starting in them fit in
        run = np.concatenate([[0.0], np.cumsum(v)])
        n = len(c) - WINDOW + 1
        return run[7: 7 + n] - run[2: 2 + n] if n > 0 else nothing

    y, _, codes = windows(sample, by_grams)
    rng = np.random.default_rng(SEED)
    first = cores(codes[y == 1], grams, lifts) if len(grams) else codes[:0]
    others = rng.permutation(np.flatnonzero(y == 0))[: LANDMARKS // 4]
    if not len(first):  # nothing sets the labels apart: plain windows
        first = codes[y == 1]
    marks = np.unique(np.vstack([first[: LANDMARKS * 3 // 4], codes[others]]), axis=0)
    negatives = codes[y == 0]
    positives = codes[y == 1]
    nystrom, w = Nystrom(marks), None
    for _ in range(rounds + 1):
        toxic = np.vstack([positives, with_gaps(positives)])
        labels = np.repeat([1, 0], [len(toxic), len(negatives)])
        w = svm(nystrom.features(np.vstack([toxic, negatives])), labels, w)
        table, base = nystrom.table(w), float(w[-1])
        y, m, codes = windows(sample, lambda c, table=table: margins(c, table))
        negatives = np.unique(np.vstack([negatives, codes[y == 0]]), axis=0)
        positives = codes[y == 1]
    first = ~np.isnan(m[:, 0])
    y, m = y[first], m[first]
    # the logistic fit sees each label as often as the labelled rows have it
    weight = np.where(y == 1, counts.get(1, 1) / max(1, (y == 1).sum()), counts.get(0, 1) / max(1, (y == 0).sum()))
    return Model(table, base, logistic(m + base, y, weight / weight.mean()))


def score_documents(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", modulus: int = 4,
                    held: int = 2, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    out_of = remainder("doc_id", modulus) == held
    sample, counts = sample_documents(docs, labels, label, ~out_of)
    sent = docs.sparkSession.sparkContext.broadcast(fit(sample, counts))

    def make():
        model = sent.value
        return lambda cols: {"doc_id": cols["doc_id"], "score": model.score(cols["text"]).tolist()}

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = arrow_map(rows, "doc_id bigint, score double", make)
    return scored.select("doc_id", out_of.alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
