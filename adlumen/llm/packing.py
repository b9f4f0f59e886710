"""Best-fit packing of tokenised documents under several capacities.

A document's ids (with an end id) are cut only if they exceed the token
capacity: the first piece takes the remainder, all others are full.  Pieces
are dealt to shards of about ``SHARD`` pieces by a hash of their row numbers, so
that equal rows spread as well; each shard is packed
on its own, longest piece first.  A bin has a residual vector (tokens,
documents, attention cost = sum of squared piece lengths); of the bins that
can take a piece under every capacity, the one whose weighted residual
afterwards has the smallest norm is selected (or, by ``select="dot"``, the one
whose residual has the largest weighted dot product with the piece's demand).
A shard leaves only its last few bins partly filled, so sharding costs well
under a thousandth of the sequences.

Only piece lengths and checksums are shuffled, never ids.  Null texts count as
empty (a single end id).  Repeated rows are packed as separate documents.
Columns other than doc_id and text are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlumen.llm.common import arrow_map
from adlumen.llm.tokens import as_bytes, encoder, vocabulary
from adlumen.session import materialize

#: Pieces packed together in one task.
SHARD = 16_384
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


@dataclass(frozen=True)
class Capacity:
    """Limits of one sequence, and the weights of their residuals."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)


def document_pieces(docs: DataFrame, capacity: Capacity = Capacity(), end_id: int = 0,
                    path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    path, most = path or vocabulary(), capacity.tokens
    if capacity.attention < most * most:
        most = min(most, math.isqrt(capacity.attention))  # a piece must fit a bin by itself

    def make():
        encode = encoder(path)

        def step(cols):
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for doc_id, text in zip(cols["doc_id"], cols["text"], strict=True):
                ids = [*encode(text), end_id]
                n, at, piece = len(ids), 0, 0
                view = memoryview(as_bytes(ids))
                while at < n:
                    size = (n % most or most) if at == 0 else most
                    out["doc_id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(at)
                    out["length"].append(size)
                    out["ids_crc32"].append(zlib.crc32(view[4 * at: 4 * (at + size)]))
                    at, piece = at + size, piece + 1
            return out

        return step

    return arrow_map(docs.select("doc_id", "text"), PIECES, make)


def best_fit(lengths: np.ndarray, capacity: Capacity, select: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; pieces are placed longest first.

    Open bins are kept as three residual arrays; each placement looks at all
    bins that still have room, so the choice is exact.
    """
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], dtype=np.int64)
    w = np.asarray(capacity.weights) / full.astype(float) ** 2
    n = len(lengths)
    bins, offsets = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    left = np.zeros((3, max(n, 1)), dtype=np.int64)  # residuals of open bins
    names = np.zeros(max(n, 1), dtype=np.int64)
    n_open = n_bins = 0
    order = np.argsort(-lengths, kind="stable")
    least = int(lengths[order[-1]]) if n else 0
    for i in order:
        size = int(lengths[i])
        need = np.array([size, 1, size * size], dtype=np.int64)
        t, d, a = left[0, :n_open], left[1, :n_open], left[2, :n_open]
        can = np.flatnonzero((t >= size) & (d >= 1) & (a >= need[2]))
        if len(can):
            if select == "dot":
                score = -(w[0] * t[can] * size + w[1] * d[can] + w[2] * a[can] * float(need[2]))
            else:
                score = (w[0] * (t[can] - size).astype(float) ** 2 + w[1] * (d[can] - 1).astype(float) ** 2
                         + w[2] * (a[can] - need[2]).astype(float) ** 2)
            k = int(can[np.argmin(score)])
        else:
            k, n_open = n_open, n_open + 1
            left[:, k], names[k] = full, n_bins
            n_bins += 1
        bins[i], offsets[i] = names[k], capacity.tokens - left[0, k]
        left[:, k] -= need
        if left[0, k] < least or left[1, k] < 1 or left[2, k] < least * least:  # closed: nothing fits any more
            n_open -= 1
            left[:, k], names[k] = left[:, n_open], names[n_open]
    return bins, offsets


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), select: str = "norm") -> DataFrame:
    """``pieces`` with sequence_id (unique, any numbers) and offset."""
    table, _, seen = materialize(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces", [F.count(F.lit(1)).alias("n")])
    shards = max(1, math.ceil(seen["n"] / SHARD))
    keyed = table.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    cols = [c for c in pieces.columns]

    def one(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], kind="stable")
        bins, offsets = best_fit(pdf["length"].to_numpy(np.int64), capacity, select)
        out = pdf[cols].copy()
        out["sequence_id"] = (int(key[0]) << 32) + bins
        out["offset"] = offsets
        return out

    return keyed.groupBy("shard").applyInPandas(one, f"{PIECES}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, capacity: Capacity = Capacity(), end_id: int = 0,
                   select: str = "norm", path: str | None = None) -> DataFrame:
    """Tokenise, cut and pack ``docs``; one row per piece."""
    return pack(document_pieces(docs, capacity, end_id, path), capacity, select)
