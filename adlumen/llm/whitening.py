"""Whitening of embeddings with a covariance from bit-sliced scatter.

An entry c becomes the integer x = floor(``scale`` * c) + ``shift``.  Over the
distinct vectors, each dimension is shifted to begin at zero and cut into bit
planes; a plane packs one bit of 64 rows into a word.  The sum of x_i * x_j over
the rows is then the sum over pairs of planes (a, b) of 2^(a+b) times the
popcount of their AND: exact, whatever the order of the rows.  Blocks of rows
are counted in tasks, the counts are weighted and summed as decimals, and the
driver receives one number per pair of dimensions.  The scatter is centred as
integers, n * sum(x_i x_j) - S_i * S_j, before it becomes floating point.

Defined cases: rows whose vector is null, or holds null or non-finite entries
or one whose integer needs more than 62 bits, are dropped; so are empty vectors,
and vectors that have not the most frequent length (of equally frequent ones the
longest).  Repeated vectors count once in the fit, and each row is whitened.
Directions without variance (below 1e-12 of the total) have no whitened value
and no rows; an empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlumen.session import drop_materialized, materialize

ROWS = 1 << 16          # rows whose planes are held at once
LEAST_SHARE = 1e-12     # a component's least share of the total variance
MOST = 1 << 61


def integer_vectors(table: DataFrame, scale: int, shift: int, vector: str) -> DataFrame:
    """vec_id and x (array of longs) of the rows whose vector is whole."""
    v = F.col(vector).cast("array<double>")
    fits = F.forall(v, lambda c: F.coalesce(F.abs(c * scale) < F.lit(float(MOST)), F.lit(False)) & ~F.isnan(c))
    rows = table.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(fits)
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                       F.transform(v, lambda c: F.floor(c * scale) + F.lit(shift).cast("bigint")).alias("x"))


def _matrix(col: pa.Array) -> np.ndarray:
    """Equally long lists of longs as a matrix."""
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1)


def planes(x: np.ndarray) -> np.ndarray:
    """Bit planes of non-negative columns: (dimension, bit, word), 64 rows to a word."""
    bits = max(1, int(x.max()).bit_length())
    rows = -(-len(x) // 64) * 64
    padded = np.zeros((rows, x.shape[1]), dtype=np.uint64)
    padded[: len(x)] = x
    out = np.empty((x.shape[1], bits, rows // 64), dtype=np.uint64)
    for b in range(bits):
        bit = ((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        out[:, b] = np.packbits(np.ascontiguousarray(bit.T), axis=1, bitorder="little").view(np.uint64)
    return out


def cross_products(x: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(i, j, sum of x_i * x_j) for i <= j, by weighted AND-popcounts."""
    p = planes(x)
    dims, bits, _ = p.shape
    flat = p.reshape(dims * bits, -1)
    weight = np.add.outer(np.arange(bits), np.arange(bits))
    wide = 2 * bits + len(x).bit_length() + 2 * bits.bit_length() > 62
    for i in range(dims):
        counts = np.zeros((bits, (dims - i) * bits), dtype=np.int64)
        for b in range(bits):
            counts[b] = np.bitwise_count(flat[i * bits:] & p[i, b]).sum(axis=1, dtype=np.int64)
        c = counts.reshape(bits, dims - i, bits).transpose(1, 0, 2)
        if wide:        # Python's integers where 64 bits may not do
            w = np.array([[1 << int(e) for e in row] for row in weight], dtype=object)
            sums = [int((m.astype(object) * w).sum()) for m in c]
        else:
            sums = (c << weight).sum(axis=(1, 2)).tolist()
        for j, s in enumerate(sums):
            yield i, i + j, s


def scatter(fit: DataFrame, least: np.ndarray) -> np.ndarray:
    """Matrix of exact sums of (x_i - least_i) * (x_j - least_j) over ``fit``, as Python integers."""
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("s", pa.decimal128(38, 0))])

    def count(batches):
        from decimal import Decimal

        held: list[np.ndarray] = []
        size = 0

        def flush():
            i, j, s = zip(*cross_products(np.concatenate(held)), strict=True)
            return pa.RecordBatch.from_pydict({"i": i, "j": j, "s": [Decimal(x) for x in s]}, schema=schema)

        for batch in batches:
            if batch.num_rows:
                held.append((_matrix(batch.column(0)) - least).astype(np.uint64))
                size += batch.num_rows
                if size >= ROWS:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    sums = fit.select("x").mapInArrow(count, "i int, j int, s decimal(38,0)")
    dims = len(least)
    out = np.zeros((dims, dims), dtype=object)
    for r in sums.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r.i, r.j] = out[r.j, r.i] = int(r.s)
    return out


def whiten(table: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000,
           vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error.

    ``deviation`` (the sum of (n * x - S)^2) is exact, as decimal(38,0).
    """
    spark = table.sparkSession
    result = ("vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, "
              "explained double, identity_error double")
    vectors = integer_vectors(table, scale, shift, vector)
    rows, _, _ = materialize(vectors, "integer-vectors")
    top = rows.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), F.desc("dims")).limit(1).collect()
    if not top:
        return spark.createDataFrame([], result)
    dims = top[0].dims
    rows = rows.where(F.size("x") == dims)
    fit, fit_at, seen = materialize(rows.select("x").distinct(), "distinct-vectors", [F.count(F.lit(1)).alias("n")])
    n = seen["n"]
    each = fit.select(F.posexplode("x").alias("d", "x")).groupBy("d").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.min("x").alias("least")).orderBy("d").collect()
    total = np.array([int(r.s) for r in each], dtype=object)
    least = np.array([r.least for r in each], dtype=np.int64)
    # sums of the shifted entries, then n^2 times the covariance, in integers
    moved = total - n * least.astype(object)
    centred = n * scatter(fit, least) - np.outer(moved, moved)
    cov = (centred / (n * n)).astype(np.float64)    # integer / integer rounds once
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(values, kind="stable")[::-1]
    trace = float(sum(int(centred[d, d]) for d in range(dims)) / (n * n))
    keep = [k for k in order[:components] if values[k] > LEAST_SHARE * trace] if trace > 0 else []
    if not keep:
        drop_materialized(spark, fit_at)
        return spark.createDataFrame([], result)
    basis = axes[:, keep] / np.sqrt(values[keep])
    explained = [float(values[k] / trace) for k in keep]
    whole = [int(t) for t in total]

    def project(x: np.ndarray) -> np.ndarray:
        """Rows on the components.  n * x - S is exact, and rounds once as it becomes a double."""
        return (_away(x, n, whole) / n) @ basis

    # covariance of the whitened fit list, summed in tasks
    k = len(keep)

    def moments(batches):
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = project(_matrix(batch.column(0)))
                first += w.sum(axis=0)
                second += w.T @ w
        flat = np.concatenate([first, second.ravel()])
        yield pa.RecordBatch.from_pydict({"d": np.arange(len(flat), dtype=np.int32), "s": flat})

    got = fit.mapInArrow(moments, "d int, s double").groupBy("d").agg(F.sum("s").alias("s")).collect()
    flat = np.zeros(k + k * k)
    for r in got:
        flat[r.d] = r.s
    mean = flat[:k] / n
    error = float(np.abs(flat[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())
    drop_materialized(spark, fit_at)

    arrow = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()),
                       ("deviation", pa.decimal128(38, 0)), ("whitened", pa.float64()),
                       ("explained", pa.float64()), ("identity_error", pa.float64())])

    def emit(batches):
        from decimal import Decimal

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = _matrix(part.column(1))
                m = len(x)
                far = [Decimal(d) for d in _deviations(x, n, whole)]
                yield pa.RecordBatch.from_pydict({
                    "vec_id": part.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                    "n": np.full(m * k, n), "deviation": [d for d in far for _ in range(k)],
                    "whitened": project(x).ravel(), "explained": explained * m,
                    "identity_error": np.full(m * k, error)}, schema=arrow)

    return rows.select("vec_id", "x").mapInArrow(emit, result)


def _fits(x: np.ndarray, n: int, total: list[int]) -> bool:
    """Whether n * x - S and the sum of its squares stay within 64 bits for all entries."""
    low, high = x.min(axis=0).tolist(), x.max(axis=0).tolist()
    most = [max(abs(n * a - s), abs(n * b - s), abs(n * a), abs(n * b), abs(s)) for a, b, s in zip(low, high, total, strict=True)]
    far = [max(abs(n * a - s), abs(n * b - s)) for a, b, s in zip(low, high, total, strict=True)]
    return max(most) < 1 << 62 and sum(d * d for d in far) < 1 << 62


def _away(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - S as doubles."""
    if len(x) and _fits(x, n, total):
        return (n * x - np.array(total, dtype=np.int64)).astype(np.float64)
    return (n * x.astype(object) - np.array(total, dtype=object)).astype(np.float64).reshape(x.shape)


def _deviations(x: np.ndarray, n: int, total: list[int]) -> list[int]:
    """Sum over dimensions of (n * x - S)^2, exactly."""
    if len(x) and _fits(x, n, total):
        d = n * x - np.array(total, dtype=np.int64)
        return (d * d).sum(axis=1).tolist()
    d = n * x.astype(object) - np.array(total, dtype=object)
    return [int(v) for v in (d * d).sum(axis=1)]
