"""Quality scores: random Fourier features, ridge normal equations, isotonic calibration.

Each document becomes a fixed vector of statistics of its whole text.  Random
Fourier features of the standardised statistics approximate a Gaussian kernel.
Every task adds its labelled rows' normal equations into one matrix; the
matrices are added in a tree of tasks, and the driver solves one system of
``FEATURES`` + 1 unknowns.  The equations are kept by fold, so the scores that
the isotonic step is fitted to come from models that did not see their rows;
it works on ``BINS`` bins of the raw score, whatever the number of rows.

Defined cases: a null text counts as empty, and empty texts get a score like
any other; labels that are null, or of no document, are not learnt from; of
several labels of a document each is a row; without labels of both kinds every
score is the share of label 1 (0.5 without any); ties share a score; repeated
rows score alike; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlumen.llm.common import arrow_map, remainder, tree_sum
from adlumen.session import materialize

FEATURES = 256
FOLDS = 3
RIDGE = 0.03
WIDTH = 0.5
BINS = 500
SEED = 17
_WORD = re.compile(r"\S+")

STATISTICS = (
    "log_chars", "log_words", "mean_word", "sd_word", "letters", "upper", "digits", "spaces", "signs",
    "bars", "bangs", "stops", "commas", "line_ends", "distinct_words", "top_word", "repeated_next",
    "repeated_lines", "short_words", "long_words", "words_with_sign", "upper_words", "distinct_pairs",
    "mean_line", "distinct_chars",
)


def statistics(text: str | None) -> list[float]:
    """The ``STATISTICS`` of a whole text."""
    text = text or ""
    n = len(text)
    words = text.split()
    k = len(words)
    lines = [x for x in text.split("\n") if x]
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    count = np.bincount(np.minimum(codes, 255), minlength=256) if n else np.zeros(256, dtype=np.int64)
    upper, lower, digits = count[65:91].sum(), count[97:123].sum(), count[48:58].sum()
    wide, spaces = count[192:].sum(), count[32] + count[9:14].sum()
    signs = n - upper - lower - digits - wide - spaces
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=k)
    tally: dict[str, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    same_next = sum(map(str.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:], strict=False)))
    per, per_word, per_line = 1 / max(n, 1), 1 / max(k, 1), 1 / max(len(lines), 1)
    edge = sum(1 for w in words if not w[-1].isalnum())
    return [
        np.log1p(n), np.log1p(k), lengths.mean() if k else 0.0, lengths.std() if k else 0.0,
        (upper + lower + wide) * per, upper * per, digits * per, spaces * per, signs * per,
        count[124] * per_word, count[33] * per_word, count[46] * per_word, count[44] * per_word,
        count[10] * per_word, len(tally) * per_word, max(tally.values(), default=0) * per_word,
        same_next * per_word, (len(lines) - len(set(lines))) * per_line,
        (lengths <= 2).sum() * per_word, (lengths >= 12).sum() * per_word, edge * per_word,
        sum(map(str.isupper, words)) * per_word, pairs * per_word, np.log1p(n * per_line),
        float(np.count_nonzero(count)) / np.log(n + 2),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics ``x`` of every row."""

    def make():
        return lambda cols: {"doc_id": cols["doc_id"], "x": [statistics(t) for t in cols["text"]]}

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(rows, "doc_id bigint, x array<double>", make)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray            # the last one is the constant's
    knots: np.ndarray              # raw scores
    values: np.ndarray             # calibrated, not falling

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        r = np.sqrt(2 / len(self.phase)) * np.cos(z @ self.omega + self.phase)
        return np.hstack([r, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(x), self.values[0])
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def isotonic(at: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted least-squares fit that does not fall along ``at`` (sorted): pool adjacent violators."""
    pools: list[list[float]] = []
    for m, w in zip(mean, weight, strict=True):
        pools.append([m, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m1, w1, n1 = pools.pop()
            m0, w0, n0 = pools.pop()
            pools.append([(m0 * w0 + m1 * w1) / (w0 + w1), w0 + w1, n0 + n1])
    return np.concatenate([np.full(int(n), m) for m, _, n in pools]) if pools else np.zeros(0)


def _rows(batches):
    for b in batches:
        x = np.array(b.column(0).to_pylist(), dtype=np.float64).reshape(b.num_rows, -1)
        yield x, b.column(1).to_numpy().astype(np.float64), b.column(2).to_numpy()


def fit(labelled: DataFrame, features: int = FEATURES, ridge: float = RIDGE) -> Model:
    """``labelled``: x, y (0 or 1), fold (0 .. FOLDS - 1)."""
    d = len(STATISTICS)
    xi = [F.element_at("x", i + 1) for i in range(d)]
    m = labelled.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("y"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(xi)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(xi)]).first()
    rng = np.random.default_rng(SEED)
    empty = np.zeros(0)
    if not m.n or m.y in (0.0, 1.0):
        share = 0.5 if not m.n else float(m.y)
        return Model(empty, empty, empty, empty, empty, empty, np.array([share]))
    mean = np.array([m[f"m{i}"] for i in range(d)])
    scale = np.maximum(np.array([m[f"s{i}"] for i in range(d)]), 1e-6)
    # the kernel spans the bulk of standardised statistics, so outliers keep a say
    omega = rng.standard_normal((d, features)) * WIDTH / np.sqrt(d)
    model = Model(mean, scale, omega, rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1), empty, empty)
    size = features + 1
    shape = (FOLDS, size, size + 1)

    def equations(batches):
        total = np.zeros(shape)
        for x, y, fold in _rows(batches):
            z = model.features(x)
            for f in range(FOLDS):
                a = z[fold == f]
                total[f, :, :-1] += a.T @ a
                total[f, :, -1] += a.T @ y[fold == f]
        yield pa.RecordBatch.from_pydict({"v": [total.tobytes()]}, schema=pa.schema([("v", pa.binary())]))

    rows = labelled.select("x", "y", "fold")
    sums = tree_sum(rows.mapInArrow(equations, "v binary")).reshape(shape)
    eye = ridge * np.eye(size)
    eye[-1, -1] = 1e-6

    def solve(s):
        return np.linalg.solve(s[:, :-1] + eye, s[:, -1])

    held = [solve(sums.sum(axis=0) - sums[f]) for f in range(FOLDS)]
    model.weights = solve(sums.sum(axis=0))

    def binned(batches):
        n = np.zeros((2, BINS))
        for x, y, fold in _rows(batches):
            z = model.features(x)
            raw = np.choose(fold.astype(int), [z @ w for w in held])
            b = np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
            n += [np.bincount(b, minlength=BINS), np.bincount(b, weights=y, minlength=BINS)]
        yield pa.RecordBatch.from_pydict({"v": [n.tobytes()]}, schema=pa.schema([("v", pa.binary())]))

    n, y = tree_sum(rows.mapInArrow(binned, "v binary")).reshape(2, BINS)
    full = np.flatnonzero(n)
    at = (full + 0.5) / BINS * 2 - 0.5
    # half a row of the overall share in each bin keeps scores off 0 and 1
    means = (y[full] + 0.5 * m.y) / (n[full] + 0.5)
    model.knots, model.values = at, isotonic(at, means, n[full])
    return model


def labelled_rows(stats: DataFrame, labels: DataFrame, label: str, learn_from: Column) -> DataFrame:
    """x, y, fold of labelled documents that may be learnt from."""
    y = labels.where(F.col(label).isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("double").alias("y"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int")
    return stats.where(learn_from).join(y, "doc_id").select("x", "y", fold.alias("fold"))


def score_documents(docs: DataFrame, labels: DataFrame, *, label: str = "quality", modulus: int = 5,
                    held: int = 0, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    stats, _, _ = materialize(document_statistics(docs), "statistics")
    out_of = remainder("doc_id", modulus) == held
    sent = docs.sparkSession.sparkContext.broadcast(fit(labelled_rows(stats, labels, label, ~out_of)))

    def make():
        model = sent.value
        return lambda cols: {"doc_id": cols["doc_id"], "score": model.score(np.array(cols["x"])).tolist()}

    scored = arrow_map(stats, "doc_id bigint, score double", make, text=None)
    return scored.select("doc_id", out_of.alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
