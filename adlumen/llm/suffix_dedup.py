"""Removal of repeated substrings with a difference cover of the suffixes.

A ``window``-byte string that starts at two places has, for some shift below
``v``, a *sampled* position at the same shift in both copies: the sampled
residues form a difference cover modulo ``v`` (17 residues of 273 for 400
bytes).  As in the difference-cover suffix array the sampled suffixes go first:

1. each sampled suffix gets the name of its first ``window - v + 1`` bytes,
   put together from a triple of block names; names are dealt to buckets and
   sorted there, and equal neighbours survive;
2. recursion: survivors get the name of a longer prefix, put together from
   shorter names.  Suffixes that share ``window + v - 1`` bytes share every
   window that starts in their next ``v`` bytes: these repeat, and only the
   first copy's go on, to meet shorter repeats of theirs;
3. the remaining (unsampled) starts near a survivor are merged with the sampled
   ones: all get the name of their ``window``-byte prefix, are sorted, and equal
   neighbours are repeats.

Only equality of prefixes matters here, never which is smaller, so a name is a
fingerprint instead of a rank: names of a concatenation follow from those of its
parts, and no pass is needed to number them.  Names that decide have 95 bits
(a 64-bit and a 31-bit polynomial); those of step 1 only choose candidates and
have 32 bits besides their bucket.

Texts lie in blocks of about ``BLOCK`` bytes, as compressed rows of one table.  A
block sends each bucket one message with its names and gets a bit per name back,
so a hot string costs one name per block and copy, and no position is shuffled.
A long document is cut into segments that overlap, each of its starts being
owned by one; a last pass streams the segments of such documents in order.  The
texts that no name of step 1 holds back are set aside there and come out whole.

Defined cases: null text is empty; texts shorter than the window lose nothing;
a null doc_id or one that repeats names its own row each time; an empty table
gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from adlumen.llm.common import steps
from adlumen.session import drop_materialized, materialize, release_shuffles

BLOCK = 1 << 20         # bytes of text in a block
SEGMENT = 1 << 18       # bytes of a document that one segment owns
BUCKET_NAMES = 2_000_000  # names of a bucket, some 8 to 24 MB
MASK64 = (1 << 64) - 1
BASE64 = 0x9E3779B97F4A7C15 | 3
PRIME31, BASE31 = 2_147_483_629, 1_203_870_247
#: Primitive polynomials over GF(2), by degree.
PRIMITIVE = {3: 0b1011, 6: 0b1000011, 9: 0b1000010001, 12: 0b1000001010011}


@functools.lru_cache
def difference_cover(window: int) -> tuple[int, tuple[int, ...]]:
    """(v, residues) for a window: every difference modulo v occurs among the residues.

    Singer's construction: exponents of a primitive element of GF(q^3) whose
    trace to GF(q) is zero, q + 1 residues modulo q^2 + q + 1; the largest q of
    2, 4, 8, 16 that leaves at least three tenths of the window to compare.
    """
    bits = max((m for m in (1, 2, 3, 4) if 2 ** (2 * m) + 2 ** m + 1 <= 0.7 * window), default=0)
    if not bits:
        return 1, (0,)
    q, degree = 2 ** bits, 3 * bits
    v = q * q + q + 1
    exp = [1]
    for _ in range(2 ** degree - 2):
        x = exp[-1] << 1
        exp.append(x ^ PRIMITIVE[degree] if x >> degree else x)
    order = len(exp)
    return v, tuple(i for i in range(v) if exp[i] ^ exp[i * q % order] ^ exp[i * q * q % order] == 0)


@functools.lru_cache
def _tables():
    rng = np.random.default_rng(20240501)
    return (rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(1, PRIME31, 256, dtype=np.uint64))


@functools.lru_cache(maxsize=2)
def _powers(n: int):
    """Powers of both bases and of their inverses, 0 .. n - 1."""
    def wrap(b):
        out = np.full(n, b, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def prime(b):
        out = np.ones(n, dtype=np.uint64)
        k = 1
        while k < n:
            m = min(k, n - k)
            out[k: k + m] = out[:m] * np.uint64(pow(b, k, PRIME31)) % np.uint64(PRIME31)
            k += m
        return out

    return (wrap(BASE64), wrap(pow(BASE64, -1, 1 << 64)), prime(BASE31), prime(pow(BASE31, -1, PRIME31)))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Names:
    """Names of any substring of a byte array, from running sums."""

    def __init__(self, data: np.ndarray, strong: bool):
        n = len(data)
        room = 1 << max(16, n.bit_length())
        up, self.down, up31, self.down31 = _powers(room)
        wide, narrow = _tables()
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(wide[data] * up[:n], out=self.sums[1:])
        self.sums31 = None
        if strong:
            self.sums31 = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(narrow[data] * up31[:n] % np.uint64(PRIME31), out=self.sums31[1:])

    def wide(self, at: np.ndarray, length) -> np.ndarray:
        """64-bit names of the ``length`` bytes from ``at``; the length counts too."""
        size = np.asarray(length, dtype=np.uint64)
        return _mix((self.sums[at + length] - self.sums[at]) * self.down[at] + size * np.uint64(0xD6E8FEB86659FD93))

    def both(self, at: np.ndarray, length) -> np.ndarray:
        """The 64-bit names beside the 31-bit ones, as pairs."""
        out = np.empty(len(at), dtype=PAIR)
        out["a"] = self.wide(at, length)
        out["b"] = (self.sums31[at + length] - self.sums31[at]) % np.uint64(PRIME31) * self.down31[at] % np.uint64(PRIME31)
        return out


PAIR = np.dtype([("a", "<u8"), ("b", "<u4")])
BLOCKS = ("block bigint, ids array<bigint>, nums array<bigint>, starts array<bigint>, owns array<int>, "
          "totals array<bigint>, lens array<int>, data binary, hits binary, runs binary")
#: Blocks with the texts that may hold repeats ("blocks") or with those that hold none ("clean").
DEALT = BLOCKS + ", kind string"
MESSAGES, REPLIES = "bucket int, block bigint, names binary", "block bigint, bucket int, bits binary"
KEPT = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,length:bigint>>, kept binary"
PIECES = "num bigint, start bigint, own int, data binary, runs binary"
#: What the last step gives: whole documents, and segments of long ones.
LAST = KEPT + ", " + PIECES
PER_SEGMENT = ("ids", "nums", "starts", "owns", "totals", "lens")


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(_parse_datatype_string(schema))


def _number() -> int:
    """First of the numbers that are this task's own."""
    return TaskContext.get().partitionId() << 36


def pack_blocks(docs: DataFrame, overlap: int, segment: int, block: int) -> DataFrame:
    """Whole texts as blocks of segments; a segment holds ``overlap`` bytes of the next one too."""
    schema = _arrow(BLOCKS)

    def run(batches):
        number, cols, parts, size = _number(), None, [], 0
        press = zstandard.ZstdCompressor(level=3)

        def flush():
            row = {c: [v] for c, v in cols.items()}
            row |= {"block": [number], "data": [press.compress(b"".join(parts))], "hits": [b""], "runs": [b""]}
            return pa.RecordBatch.from_pydict(row, schema=schema)

        def fresh():
            return {c: [] for c in PER_SEGMENT}

        cols = fresh()
        for step in steps(batches, "text"):
            for doc_id, text in zip(step["doc_id"], step["text"], strict=True):
                raw = (text or "").encode()
                num = number = number + 1
                for at in range(0, max(1, len(raw)), segment):
                    own = min(segment, len(raw) - at)
                    part = raw[at: at + own + overlap]
                    for c, v in zip(PER_SEGMENT, (doc_id, num, at, own, len(raw), len(part)), strict=True):
                        cols[c].append(v)
                    parts.append(part)
                    size += len(part)
                    if size >= block:
                        number += 1
                        yield flush()
                        cols, parts, size = fresh(), [], 0
        if cols["ids"]:
            number += 1
            yield flush()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, BLOCKS)


class Block:
    """One block: its bytes, and for every segment where it lies and which starts it owns."""

    def __init__(self, row: dict, window: int, v: int):
        self.row, self.window, self.v = row, window, v
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"]), dtype=np.uint8)
        lens = np.array(row["lens"], dtype=np.int64)
        self.at = np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64)
        self.end = self.at + lens
        held = lens > 0
        owns = np.where(held, np.array(row["owns"], dtype=np.int64), 0)
        self.own_end = self.at + owns
        # starts of whole windows that the segment owns
        self.last = np.maximum(self.at, np.minimum(self.own_end, self.end - window + 1))
        self.first_pos = np.array(row["starts"], dtype=np.int64)

    def segment_of(self, pos: np.ndarray) -> np.ndarray:
        """Segment of each position (empty segments hold none)."""
        return np.searchsorted(self.end, pos, side="right")

    def samples(self, length: int) -> np.ndarray:
        """Sampled positions (by place in their document) with ``length`` bytes to follow."""
        v, residues = difference_cover(self.window)
        out = []
        for at, end, first in zip(self.at.tolist(), self.end.tolist(), self.first_pos.tolist(), strict=True):
            for d in residues:
                lo = at + (d - first) % v
                if lo <= end - length:
                    out.append(np.arange(lo, end - length + 1, v, dtype=np.int64))
        return np.sort(np.concatenate(out)) if out else np.zeros(0, dtype=np.int64)

    def spread(self, pos: np.ndarray, before: int, after: int) -> np.ndarray:
        """Mask of owned window starts within [pos - before, pos + after] of the same segment."""
        seg = self.segment_of(pos)
        lo = np.maximum(pos - before, self.at[seg])
        hi = np.minimum(pos + after + 1, self.last[seg])
        ok = lo < hi
        return mask(lo[ok], hi[ok], len(self.data))


def mask(lo: np.ndarray, hi: np.ndarray, n: int) -> np.ndarray:
    """Union of the ranges [lo, hi) as a mask of n places."""
    edge = np.bincount(lo, minlength=n + 1)[: n + 1] - np.bincount(hi, minlength=n + 1)[: n + 1]
    return np.cumsum(edge)[:n] > 0


def ranges(m: np.ndarray) -> np.ndarray:
    """Maximal runs of a mask as rows (start, end)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], m.view(np.int8), [0]])))
    return edge.reshape(-1, 2)


def _deal(names: np.ndarray, n_buckets: int):
    """(order, bounds): names in the order of their buckets, and where each bucket begins."""
    key = names["a"] if names.dtype == PAIR else names
    bucket = ((key >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=n_buckets))])


def _messages(block: int, names: np.ndarray, n_buckets: int, schema: pa.Schema):
    order, bounds = _deal(names, n_buckets)
    sent = names if names.dtype == PAIR else (names & np.uint64(0xFFFFFFFF)).astype("<u4")
    sent = sent[order]
    full = [b for b in range(n_buckets) if bounds[b] < bounds[b + 1]]
    return pa.Table.from_pydict({"bucket": full, "block": [block] * len(full),
                                 "names": [sent[bounds[b]: bounds[b + 1]].tobytes() for b in full]}, schema=schema)


def _answers(replies: pa.Table, names: np.ndarray, n_buckets: int, kinds: int = 1) -> np.ndarray:
    """Bits for ``names``, in their order, one row for each kind; a bucket that is silent says no."""
    order, bounds = _deal(names, n_buckets)
    out = np.zeros((kinds, len(names)), dtype=bool)
    for b, bits in zip(replies["bucket"].to_pylist(), replies["bits"].to_pylist(), strict=True):
        n = int(bounds[b + 1] - bounds[b])
        flags = np.unpackbits(np.frombuffer(bits, dtype=np.uint8))[: n * kinds].reshape(kinds, n).astype(bool)
        out[:, order[bounds[b]: bounds[b + 1]]] = flags
    return out


def _ask(messages: DataFrame, dtype: np.dtype, leaders: bool) -> DataFrame:
    """Buckets: sort all names; a bit per name that is not alone.

    With ``leaders`` a second bit per name, set for all but the first place (by
    block, then order) of those that share it.
    """
    schema = _arrow(REPLIES)

    def bucket(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        parts = [np.frombuffer(x.as_buffer(), dtype=dtype) for x in table["names"]]
        names = np.concatenate(parts)
        order = np.lexsort((names["b"], names["a"])) if dtype == PAIR else np.argsort(names, kind="stable")
        ranked = names[order]
        same = ranked[1:] == ranked[:-1]
        later = np.concatenate([[False], same])         # equal to its predecessor
        shared = later | np.concatenate([same, [False]])
        flags = np.zeros((2, len(names)), dtype=bool)
        flags[0, order], flags[1, order] = shared, later
        out: dict[str, list] = {"block": [], "bucket": [], "bits": []}
        at = 0
        for block, b, part in zip(table["block"].to_pylist(), table["bucket"].to_pylist(), parts, strict=True):
            mine = flags[: 2 if leaders else 1, at: at + len(part)]
            at += len(part)
            if mine.any():
                out["block"].append(block)
                out["bucket"].append(b)
                out["bits"].append(np.packbits(mine.reshape(-1)).tobytes())
        return pa.Table.from_pydict(out, schema=schema)

    return messages.groupBy("bucket").applyInArrow(bucket, REPLIES)


def _rows(table: pa.Table):
    return table.to_pylist()


def _each_block(blocks: DataFrame, replies: DataFrame, schema: str, work) -> DataFrame:
    """``work(row, replies)`` for every block beside the replies sent to it."""
    arrow = _arrow(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [work(row, right) for row in _rows(left)]
        return pa.concat_tables(found) if found else arrow.empty_table()

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)


def _from_blocks(blocks: DataFrame, schema: str, work) -> DataFrame:
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                yield from work(batch.slice(k, 1).to_pylist()[0]).to_batches()

    return blocks.mapInArrow(run, schema)


def _sample_names(b: Block, short: int):
    at = b.samples(short)
    return at, Names(b.data, False).wide(at, short)


def _long_names(b: Block, hits: np.ndarray) -> np.ndarray:
    """Names of prefixes that hold the next ``v`` windows, or those that the segment owns."""
    more = np.minimum(b.last[b.segment_of(hits)] - 1 - hits, b.v - 1)
    return Names(b.data, True).both(hits, b.window + more)


def remove_repeats(docs: DataFrame, window: int = 400, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row (see ``kept_texts``)."""
    return digests(kept_texts(docs, window, segment, block)).drop("text")


def digests(texts: DataFrame) -> DataFrame:
    """What ``kept_texts`` gave as doc_id, n_bytes, n_removed, n_spans, kept_sha256, text.

    A removal may cut a character: what is left of it is U+FFFD in ``text``,
    while the hash is that of the bytes.
    """
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["length"])
    return texts.select("doc_id", "n_bytes", removed.alias("n_removed"),
                        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def kept_texts(docs: DataFrame, window: int = 400, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_bytes, spans (maximal removed runs: start, length), kept (the bytes that stay) of every row.

    A byte goes if a ``window``-byte string that covers it also starts anywhere
    else in the table, the same document included.
    """
    spark = docs.sparkSession
    v, residues = difference_cover(window)
    short = window - v + 1
    count = F.coalesce(F.sum(F.aggregate("lens", F.lit(0).cast("bigint"), lambda x, y: x + y)), F.lit(0))
    packed, packed_at, seen = materialize(pack_blocks(docs, window, segment, block), "blocks",
                                          [count.alias("n")])
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                    math.ceil(seen["n"] * len(residues) / v / BUCKET_NAMES))
    messages, blocks_schema, dealt_schema, last_schema = (_arrow(x) for x in (MESSAGES, BLOCKS, DEALT, LAST))

    # 1. names of the sampled suffixes
    def sampled(row):
        b = Block(row, window, v)
        return _messages(row["block"], _sample_names(b, short)[1], n_buckets, messages)

    first, first_at, _ = materialize(
        _ask(_from_blocks(packed, MESSAGES, sampled), np.dtype("<u4"), False), "sampled-names")

    def survivors(row, replies):
        """The block with the sampled places that share a name (``hits``) and the starts before
        them (``runs``); texts without any go to a row of their own."""
        b = Block(row, window, v)
        at, names = _sample_names(b, short)
        hits = at[_answers(replies, names, n_buckets)[0]]
        starts = b.spread(hits, v - 1, 0)
        total = np.concatenate([[0], np.cumsum(starts)])
        long = np.array(row["totals"]) > np.array(row["owns"])
        keep = (total[b.end] > total[b.at]) | long
        kept = np.flatnonzero(keep)
        lens = np.where(keep, b.end - b.at, 0)
        moved = np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64) - b.at   # what is added to a place
        hits = hits[keep[b.segment_of(hits)]]
        seg = b.segment_of(hits)
        hits, seg = hits[hits < b.last[seg]], seg[hits < b.last[seg]]
        runs = ranges(starts)
        runs = runs + moved[b.segment_of(runs[:, 0])][:, None]
        out = []
        for kind, members in (("blocks", kept), ("clean", np.flatnonzero(~keep))):
            if len(members):
                data = b"".join(b.data[b.at[k]: b.end[k]].tobytes() for k in members)
                out.append({c: [row[c][k] for k in members] for c in PER_SEGMENT} | {
                    "block": row["block"], "data": zstandard.ZstdCompressor(level=3).compress(data), "kind": kind})
        if len(kept):
            out[0] |= {"hits": (hits + moved[seg]).astype("<i4").tobytes(), "runs": runs.astype("<i4").tobytes()}
        return pa.Table.from_pylist(out, schema=dealt_schema)

    dealt, dealt_at, seen = materialize(
        _each_block(packed, first, DEALT, survivors), "survivors",
        [F.coalesce(F.sum(F.octet_length("hits") / 4), F.lit(0)).alias("n")], partition_by="kind")
    left, clean = dealt.where("kind = 'blocks'").drop("kind"), dealt.where("kind = 'clean'")
    drop_materialized(spark, packed_at)
    drop_materialized(spark, first_at)
    release_shuffles(spark)
    few = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(seen["n"] / BUCKET_NAMES))

    # 2. recursion: longer names of the surviving sampled suffixes
    def hits_of(row):
        return np.frombuffer(row["hits"], dtype="<i4").astype(np.int64)

    def longer(row):
        b = Block(row, window, v)
        return _messages(row["block"], _long_names(b, hits_of(row)), few, messages)

    second, second_at, _ = materialize(_ask(_from_blocks(left, MESSAGES, longer), PAIR, True), "longer-names")

    def starts_of(b: Block, row, replies):
        """(starts known to repeat, starts whose names go on to the merge)."""
        hits = hits_of(row)
        shared, later = _answers(replies, _long_names(b, hits), few, 2)
        known, copied = b.spread(hits[shared], 0, v - 1), b.spread(hits[later], 0, v - 1)
        runs = np.frombuffer(row["runs"], dtype="<i4").reshape(-1, 2).astype(np.int64)
        return known, np.flatnonzero(mask(runs[:, 0], runs[:, 1], len(b.data)) & ~copied)

    # 3. merge: names of the window that begins at each remaining start.  The
    # table keeps those starts, so the last step need not ask for them again.
    def merged(row, replies):
        b = Block(row, window, v)
        known, rest = starts_of(b, row, replies)
        m = np.zeros(len(b.data), dtype=bool)
        m[rest] = True
        out = {c: [row[c]] for c in ("block", *PER_SEGMENT, "data")} | {
            "hits": [ranges(known).astype("<i4").tobytes()], "runs": [ranges(m).astype("<i4").tobytes()]}
        return pa.Table.from_pydict(out, schema=blocks_schema)

    spans = F.expr("octet_length(runs)")
    rest, rest_at, _ = materialize(_each_block(left, second, BLOCKS, merged), "remaining", [F.sum(spans).alias("n")])
    drop_materialized(spark, f"{dealt_at}/kind=blocks")
    drop_materialized(spark, second_at)
    release_shuffles(spark)

    def place(row, name, n):
        runs = np.frombuffer(row[name], dtype="<i4").reshape(-1, 2).astype(np.int64)
        return mask(runs[:, 0], runs[:, 1], n)

    def windows(row):
        b = Block(row, window, v)
        at = np.flatnonzero(place(row, "runs", len(b.data)))
        return _messages(row["block"], Names(b.data, True).both(at, window), n_buckets, messages)

    third, third_at, _ = materialize(_ask(_from_blocks(rest, MESSAGES, windows), PAIR, False), "window-names")
    release_shuffles(spark)     # the names of the windows are the largest of all

    def finish(row, replies):
        b = Block(row, window, v)
        n = len(b.data)
        at = np.flatnonzero(place(row, "runs", n))
        repeats = place(row, "hits", n)
        repeats[at[_answers(replies, Names(b.data, True).both(at, window), n_buckets)[0]]] = True
        runs = ranges(repeats)
        covered = mask(runs[:, 0], runs[:, 1] + window - 1, n)
        out: dict[str, list] = {f.name: [] for f in last_schema}
        for k, (doc_id, num, start, own, total) in enumerate(zip(
                *(row[c] for c in ("ids", "nums", "starts", "owns", "totals")), strict=True)):
            part, gone = b.data[b.at[k]: b.end[k]], covered[b.at[k]: b.end[k]]
            if own == total:
                values = (doc_id, total, _spans(ranges(gone)), part[~gone].tobytes(), None, None, None, None, None)
            else:
                values = (doc_id, total, None, None, num, start, own, part[:own].tobytes(),
                          ranges(gone).astype("<i8").tobytes())
            for c, x in zip(out, values, strict=True):
                out[c].append(x)
        return pa.Table.from_pydict(out, schema=last_schema)

    done, _, _ = materialize(_each_block(rest, third, LAST, finish), "removed")
    drop_materialized(spark, rest_at)
    drop_materialized(spark, third_at)
    names = [f.name for f in _arrow(KEPT)]
    return (_unchanged(clean).unionByName(done.where("num is null").select(*names))
            .unionByName(_in_order(done.where("num is not null"))))


def _spans(runs: np.ndarray) -> list[dict]:
    return [{"start": lo, "length": hi - lo} for lo, hi in runs.tolist()]


def _unchanged(clean: DataFrame) -> DataFrame:
    """The whole documents of blocks from which nothing goes."""
    schema = _arrow(KEPT)

    def texts(row):
        data = zstandard.ZstdDecompressor().decompress(row["data"])
        ends = np.cumsum(row["lens"]).tolist()
        kept = [data[hi - n: hi] for n, hi in zip(row["lens"], ends, strict=True)]
        return pa.Table.from_pydict({"doc_id": row["ids"], "n_bytes": row["totals"], "spans": [[]] * len(kept),
                                     "kept": kept}, schema=schema)

    return _from_blocks(clean.select("ids", "totals", "lens", "data"), KEPT, texts)


def _in_order(pieces: DataFrame) -> DataFrame:
    """Long documents: their segments streamed in order, each covering bytes of the next one too."""
    schema = _arrow(KEPT)

    def run(batches):
        runs, kept, until = [], [], 0       # removed runs so far, the last of which may go on
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["start"] == 0:
                    runs, kept, until = [], [], 0
                own = r["own"]
                covered = np.frombuffer(r["runs"], dtype="<i8").reshape(-1, 2)
                gone = mask(np.minimum(covered[:, 0], own), np.minimum(covered[:, 1], own), own)
                gone[: max(0, min(own, until - r["start"]))] = True
                until = max([until, *(r["start"] + covered[:, 1]).tolist()])
                for lo, hi in (r["start"] + ranges(gone)).tolist():
                    if runs and runs[-1][1] == lo:
                        runs[-1][1] = hi
                    else:
                        runs.append([lo, hi])
                kept.append(np.frombuffer(r["data"], dtype=np.uint8)[~gone].tobytes())
                if r["start"] + own == r["n_bytes"]:
                    yield pa.RecordBatch.from_pydict(
                        {"doc_id": [r["doc_id"]], "n_bytes": [r["n_bytes"]],
                         "spans": [_spans(np.array(runs, dtype=np.int64).reshape(-1, 2))],
                         "kept": [b"".join(kept)]}, schema=schema)

    return pieces.repartition("num").sortWithinPartitions("num", "start").mapInArrow(run, KEPT)
