"""SimHash near-dedup by anchor points of a covering code.

Fingerprints are 64 bits over word shingles.  Two that differ in at most D
bits differ in at most t = D // 2 bits of one of their 32-bit halves.  A half
lies in F2^31 x F2; the anchors are the Hamming [31, 26] code (covering radius
R = 1: every point is within 1 of an anchor) times the free last bit.

Every half is replicated to all anchors within R + h, h = ceil(t / 2): two
halves within t have a midpoint within h of both, the midpoint has an anchor
within R, and that anchor is within R + h of both.  So no linked pair is
missed, and with D = 4 a fingerprint visits at most 17 anchors per half of
2^27; comparing whole fingerprints at each anchor decides.  (Replicating one
side to its own anchor and the other to R + t would need ten times the copies.)

Only distinct fingerprints are replicated, as two numbers each.  An anchor
holding more than ``CROWD`` of them is cut into blocks by a hash, and pairs of
blocks are compared in tasks of their own.  Inside a task links are found by a
breadth-first search that compares each fingerprint with those not reached
yet, and a spanning forest is emitted, never all pairs.  Components of the
forest come from the alternating-star algorithm.

Defined cases: a null text is empty; a text without words has fingerprint 0 and
links like any other; repeated rows share their component; a null doc_id is
never a component's name unless all its members' are null; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import itertools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlumen.llm.common import arrow_map, lower_ascii, small_side
from adlumen.operators.graph import connected_components
from adlumen.session import materialize

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CROWD = 32_768
HOT = 10_000            # a fingerprint is hot if over one row in HOT has it; so fewer than HOT are
HAMMING = 31


def shingle_hashes(text: str, shingle: int = 4) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of ``shingle`` words, as uint64."""
    words = WORD.findall(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    data = [w.encode() for w in words]
    joined = memoryview(b" ".join(data))
    ends = list(itertools.accumulate(map(len, data), lambda a, n: a + n + 1))
    starts = [0, *(e + 1 for e in ends[:-1])]
    h = xxhash.xxh64_intdigest
    return np.array([h(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1:] or ends[-1:])], dtype=np.uint64)


def simhash(text: str | None, shingle: int = 4) -> int:
    """Unsigned fingerprint; a bit is 1 if it is set in over half the hashes."""
    h = shingle_hashes(text or "", shingle)
    if not len(h):
        return 0
    bits = np.zeros(64, dtype=np.int64)
    raw = h.astype(">u8").view(np.uint8).reshape(-1, 8)
    for a in range(0, len(raw), 1 << 14):  # a block's bits at a time
        bits += np.unpackbits(raw[a: a + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(h)).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every row."""
    norm = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), lower_ascii(F.col("text")).alias("text"))

    def make():
        return lambda cols: {"doc_id": cols["doc_id"], "fp": [_signed(simhash(t, shingle)) for t in cols["text"]]}

    return arrow_map(norm, "doc_id bigint, fp bigint", make)


@functools.lru_cache(maxsize=4)
def anchor_masks(excess: int) -> list[np.ndarray]:
    """By syndrome: XOR masks that lead from a 32-bit half to every anchor
    within covering radius + ``excess`` (the free bit costs 1 if it is flipped).

    Bit i (0..30) has syndrome i + 1, so a codeword is a point of syndrome 0.
    """
    by: list[list[int]] = [[] for _ in range(HAMMING + 1)]
    for weight in range(0, 2 + excess):
        for bits in itertools.combinations(range(HAMMING), weight):
            s = m = 0
            for b in bits:
                s, m = s ^ (b + 1), m | 1 << b
            by[s].append(m)
            if weight <= excess:  # one step is left for the free bit
                by[s].append(m | 1 << HAMMING)
    return [np.array(sorted(x), dtype=np.uint32) for x in by]


def syndromes(halves: np.ndarray) -> np.ndarray:
    s = np.zeros(len(halves), dtype=np.uint32)
    for b in range(HAMMING):
        s ^= ((halves >> np.uint32(b)) & np.uint32(1)) * np.uint32(b + 1)
    return s


def anchors(fps: np.ndarray, excess: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, anchor) of every visit; an anchor's number
    has the half (0 or 1) in bit 32."""
    masks, who, where = anchor_masks(excess), [], []
    u = fps.view(np.uint64)
    for half in (0, 1):
        x = ((u >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        s = syndromes(x)
        for syndrome in np.unique(s):
            rows = np.flatnonzero(s == syndrome)
            a = (x[rows][:, None] ^ masks[syndrome][None, :]).astype(np.int64) | (half << 32)
            who.append(np.repeat(rows, a.shape[1]))
            where.append(a.ravel())
    return np.concatenate(who), np.concatenate(where)


def visits(fps: DataFrame, max_distance: int) -> DataFrame:
    """(anchor, fp) of all anchors of every distinct fingerprint."""
    excess = -(-(max_distance // 2) // 2)
    arrow = pa.schema([("anchor", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy()
            for i in range(0, len(fp), 4096):
                part = np.ascontiguousarray(fp[i: i + 4096])
                who, where = anchors(part, excess)
                yield pa.RecordBatch.from_pydict({"anchor": where, "fp": part[who]}, schema=arrow)

    return fps.select("fp").mapInArrow(run, "anchor bigint, fp bigint")


def _close(x: np.ndarray, one: np.uint64, d: int) -> np.ndarray:
    return np.bitwise_count(x ^ one) <= d


def forest(fp: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among distinct fingerprints."""
    left = np.sort(fp).view(np.uint64)
    out = []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = _close(left, x, max_distance)
            if near.any():
                new, left = left[near], left[~near]
                queue += list(new)
                out += [(x, y) for y in new]
    return [(_signed(int(a)), _signed(int(b))) for a, b in out]


def bridges(a: np.ndarray, b: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between two blocks of one anchor."""
    sides = [np.sort(a).view(np.uint64), np.sort(b).view(np.uint64)]
    out = []
    while len(sides[0]):
        queue, sides[0] = [(0, sides[0][0])], sides[0][1:]
        while queue:
            side, x = queue.pop()
            other = sides[1 - side]
            near = _close(other, x, max_distance)
            if near.any():
                new = other[near]
                sides[1 - side] = other[~near]
                queue += [(1 - side, y) for y in new]
                out += [(x, y) for y in new]
    return [(_signed(int(x)), _signed(int(y))) for x, y in out]


def links(fps: DataFrame, max_distance: int) -> DataFrame:
    """(src, dst) fingerprints whose components are those of all links."""
    v = visits(fps, max_distance)
    crowds = v.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD).withColumn(
        "blocks", F.ceil(F.col("n") / CROWD).cast("int")).drop("n")
    crowded = small_side(crowds, "crowded-anchors")
    j = v.join(crowded, "anchor", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # task (lo, hi) of an anchor compares block lo with block hi; lo = hi compares inside
    tasks = j.withColumn("block", block).select("anchor", "fp", "block", F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    tasks = tasks.select("anchor", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                         "block", "fp")
    placed = tasks.repartition("anchor", "lo", "hi").sortWithinPartitions("anchor", "lo", "hi", "block")
    arrow = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def compare(key, block, fp):
        if len(fp) < 2:
            return []
        if key[1] == key[2]:
            return forest(fp, max_distance)
        return bridges(fp[block == key[1]], fp[block == key[2]], max_distance)

    def run(batches):
        now, held = None, []
        for b in batches:
            a, lo, hi, block, fp = (b.column(i).to_numpy() for i in range(5))
            if not len(a):
                continue
            cuts = np.flatnonzero((a[1:] != a[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
            bounds = [0, *cuts.tolist(), len(a)]
            out = []
            for s, e in itertools.pairwise(bounds):
                key = (a[s], lo[s], hi[s])
                if key != now:
                    if held:
                        out += compare(now, *map(np.concatenate, zip(*held, strict=True)))
                    now, held = key, []
                if e - s > 1 or held or e == len(a):
                    held.append((block[s:e], fp[s:e]))
            if out:
                yield pa.RecordBatch.from_pydict(
                    {"src": [x for x, _ in out], "dst": [y for _, y in out]}, schema=arrow)
        if held and (out := compare(now, *map(np.concatenate, zip(*held, strict=True)))):
            yield pa.RecordBatch.from_pydict({"src": [x for x, _ in out], "dst": [y for _, y in out]}, schema=arrow)

    found = placed.mapInArrow(run, "src bigint, dst bigint")
    return found.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    rows, _, _ = materialize(fingerprints(docs, shingle), "simhash")
    names = rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    distinct, _, seen = materialize(names, "simhash-distinct", [
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows")])
    edges = links(distinct, max_distance)
    labels = connected_components(edges.select(F.col("src").cast("string").alias("src"),
                                               F.col("dst").cast("string").alias("dst")))
    labels = labels.select(F.col("id").cast("bigint").alias("fp"), "component")
    # linked fingerprints only: a component's name is the smallest doc_id of its members
    linked = labels.join(distinct, "fp")
    named = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    by_fp = distinct.join(labels.join(named, "component").select("fp", "component_id"), "fp", "left").select(
        "fp", F.coalesce("component_id", "first").alias("component_id"), (F.col("n") * HOT > seen["rows"]).alias("hot"))
    table, _, _ = materialize(by_fp, "simhash-components")
    # rows of hot fingerprints (copies, empty texts) are named where they are; the rest is shuffled
    hot = table.where("hot").drop("hot")
    here = rows.join(F.broadcast(hot), "fp")
    rest = rows.join(F.broadcast(hot.select("fp")), "fp", "left_anti").join(table.where("not hot").drop("hot"), "fp")
    return here.unionByName(rest).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
