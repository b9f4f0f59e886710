"""Exact dedup by composable polynomial fingerprints, then chunk comparison.

A text (A-Z lower-cased, null as empty) is a byte string b_0..b_{n-1}.  Its
fingerprint is, for two primes below 2^31, sum b_i * B^(n-1-i) mod p.  Chunks
are hashed independently and combine by length-shifted arithmetic,
H(xy) = H(x) * B^|y| + H(y): in a task for ordinary documents, and across
tasks for documents of more than ``HUGE_CHARS`` characters, whose chunks are
dealt out and whose shifted chunk hashes are then summed per document.

Documents with equal (fingerprint, byte length) are compared, repeated rows
once: texts of such groups only are shuffled, a group being dealt to one bucket per ``BUCKET``
members, and each bucket streams its members' chunks past those of the
group's candidate (its largest doc_id).  Members that differ from it, that is
collisions, go round again among themselves until none is left.

Defined cases: null text is the empty text; of rows with the same doc_id and
equal texts one stays; a null doc_id is smaller than any other; an empty table
gives no rows; columns other than doc_id and text are ignored.  All of this
holds for colliding fingerprints too.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlumen.llm.common import arrow_map, lower_ascii, small_side
from adlumen.session import materialize

PRIMES = (2_147_483_629, 2_147_483_587)
BASES = (1_000_003, 69_069_069)
CHUNK = 4096            # bytes hashed by one vector product
HUGE_CHARS = 1 << 16    # longer documents are hashed in parallel
PART_CHARS = 1 << 14    # their chunks
BUCKET = 2048           # members of a group compared in one bucket
COMPARE_CHARS = 1 << 14
REPEATS = 1 << 16       # copies of one row that one task gives back


@functools.lru_cache(maxsize=8)
def _powers(which: int, n: int = CHUNK) -> np.ndarray:
    """B^(n-1) .. B^0 mod p."""
    p, b = PRIMES[which], BASES[which]
    out, x = [], 1
    for _ in range(n):
        out.append(x)
        x = x * b % p
    return np.array(out[::-1], dtype=np.int64)


def chunk_hash(data: bytes, which: int) -> int:
    """Fingerprint of at most ``CHUNK`` bytes."""
    a = np.frombuffer(data, dtype=np.uint8)
    # bytes < 2^8, powers < 2^31, at most 2^12 terms: below 2^51
    return int(np.dot(a.astype(np.int64), _powers(which)[CHUNK - len(a):]) % PRIMES[which])


def combine(left: int, right: int, right_length: int, which: int) -> int:
    """Fingerprint of a concatenation from those of its parts."""
    return (left * pow(BASES[which], right_length, PRIMES[which]) + right) % PRIMES[which]


def fingerprint(data: bytes, which: int) -> int:
    """Fingerprint of ``data``, chunk by chunk."""
    h = 0
    for i in range(0, len(data), CHUNK):
        part = data[i: i + CHUNK]
        h = combine(h, chunk_hash(part, which), len(part), which)
    return h


def _hashed(df: DataFrame) -> DataFrame:
    """``df`` with h1 and h2 of its column ``text``, which is dropped."""
    names = [c for c in df.columns if c != "text"]
    types = dict(df.dtypes)
    schema = ", ".join([*(f"{c} {types[c]}" for c in names), "h1 bigint", "h2 bigint"])

    def make():
        def step(cols):
            data = [t.encode() for t in cols["text"]]
            out = {c: cols[c] for c in names}
            return out | {"h1": [fingerprint(x, 0) for x in data], "h2": [fingerprint(x, 1) for x in data]}

        return step

    return arrow_map(df, schema, make)


def _cut(df: DataFrame, size: int) -> DataFrame:
    """Rows of ``df`` with ``text`` cut into parts of ``size`` characters, numbered by ``part``."""
    names, types = [c for c in df.columns if c != "text"], dict(df.dtypes)
    schema = ", ".join([*(f"{c} {types[c]}" for c in names), "part int", "text string"])

    def make():
        def step(cols):
            out: dict[str, list] = {c: [] for c in (*names, "part", "text")}
            for k, text in enumerate(cols["text"]):
                for part, at in enumerate(range(0, max(1, len(text)), size)):
                    for c in names:
                        out[c].append(cols[c][k])
                    out["part"].append(part)
                    out["text"].append(text[at: at + size])
            return out

        return step

    return arrow_map(df, schema, make)


def _normalised(docs: DataFrame) -> DataFrame:
    norm = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    return norm.withColumns({"sha": F.sha2(F.col("text").cast("binary"), 256),
                             "n_bytes": F.octet_length("text").cast("bigint")})


DOC, GROUP = ("doc_id", "sha", "n_bytes"), ("h1", "h2", "n_bytes")


def _shift():
    def step(cols):
        after = cols.pop("after")
        for name, which in (("h1", 0), ("h2", 1)):
            cols[name] = [combine(h, 0, n, which) for h, n in zip(cols[name], after, strict=True)]
        return cols

    return step


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, sha (of the normalised text), n_bytes, h1, h2 of every row."""
    norm = _normalised(docs)
    huge = F.length("text") > HUGE_CHARS
    small = _hashed(norm.where(~huge))
    # huge documents: parts are dealt to tasks and hashed there; each is shifted
    # by the bytes that follow it, and the sums are the documents' fingerprints.
    # Equal rows count once in the sums and come back by their number.
    parts = _cut(norm.where(huge), PART_CHARS).repartition("doc_id", "part")
    hashed = _hashed(parts.withColumn("size", F.octet_length("text").cast("bigint")))
    each = hashed.groupBy(*DOC, "part", "size").agg(
        F.min("h1").alias("h1"), F.min("h2").alias("h2"), F.count(F.lit(1)).alias("copies"))
    later = Window.partitionBy(*DOC).orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    placed = each.withColumn("after", F.coalesce(F.sum("size").over(later), F.lit(0).cast("bigint")))
    shifted = arrow_map(placed.select(*DOC, "copies", "after", "h1", "h2"),
                        "doc_id bigint, sha string, n_bytes bigint, copies bigint, h1 bigint, h2 bigint",
                        _shift, text=None)
    whole = shifted.groupBy(*DOC).agg(
        F.pmod(F.sum("h1"), F.lit(PRIMES[0])).alias("h1"), F.pmod(F.sum("h2"), F.lit(PRIMES[1])).alias("h2"),
        F.min("copies").alias("copies"))
    whole = whole.select(*DOC, "h1", "h2", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("x"))
    return small.select(*DOC, "h1", "h2").unionByName(whole.drop("x"))


def _leaders(rows: DataFrame, least: int = 2) -> DataFrame:
    """Groups of at least ``least`` rows: number of distinct rows, and the one with the largest doc_id."""
    each = rows.groupBy(*GROUP, "doc_id", "sha").agg(F.count(F.lit(1)).alias("copies"))
    g = each.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("size"), F.sum("copies").alias("rows"),
                                 F.max(F.struct("doc_id", "sha")).alias("top"))
    return g.where(F.col("rows") >= least).select(*GROUP, "size", F.col("top.doc_id").alias("leader"),
                                      F.col("top.sha").alias("leader_sha"))


def _once(texts: DataFrame) -> DataFrame:
    """Members of groups without repeats; those of a task meet before the shuffle."""
    keys = [c for c in texts.columns if c != "text"]
    return texts.groupBy(*keys).agg(F.first("text").alias("text"))


def _compare(texts: DataFrame) -> DataFrame:
    """``texts``: GROUP, size, leader, leader_sha, doc_id, sha, text -> GROUP,
    doc_id, sha, same: whether the text is the leader's, byte by byte.

    The leader goes to every bucket of its group.  A bucket's chunks are sorted
    by position with the leader's first, so one chunk is held at a time.
    """
    buckets = F.ceil(F.col("size") / BUCKET).cast("int")
    leads = F.col("doc_id").eqNullSafe(F.col("leader")) & (F.col("sha") == F.col("leader_sha"))
    dealt = texts.select(*GROUP, "doc_id", "sha", "text", leads.alias("leads"), F.explode(
        F.when(leads, F.sequence(F.lit(0), buckets - 1))
         .otherwise(F.array(F.pmod(F.xxhash64("doc_id", "sha"), buckets).cast("int")))).alias("bucket"))
    at = [*GROUP, "bucket", "part"]
    placed = _cut(dealt, COMPARE_CHARS).repartition(*GROUP, "bucket").sortWithinPartitions(
        *at, F.desc("leads"), "doc_id", "sha")
    names = (*GROUP, "doc_id", "sha")

    def make():
        now: dict = {"at": None, "text": None}

        def step(cols):
            differs = []
            for key, text in zip(zip(*(cols[c] for c in at), strict=True), cols["text"], strict=True):
                if key != now["at"]:
                    now["at"], now["text"] = key, text
                differs.append(text != now["text"])
            return {c: cols[c] for c in names} | {"differs": differs}

        return step

    schema = "h1 bigint, h2 bigint, n_bytes bigint, doc_id bigint, sha string, differs boolean"
    seen = arrow_map(placed, schema, make)
    return seen.groupBy(*names).agg((~F.max("differs")).alias("same"))


def _key(rows: DataFrame, *more: str) -> DataFrame:
    """``rows`` with doc_id as a pair that is never null, for plain equality joins."""
    return rows.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("unnamed"), *more)


def _members(texts: DataFrame, rows: DataFrame, groups: DataFrame, name: str) -> DataFrame:
    """Texts of the rows (doc_id, sha, GROUP) whose group is in ``groups``, with GROUP,
    size, leader and leader_sha.  Rows are named by (doc_id, sha), null ids too, so
    nothing of their texts is hashed again."""
    found = rows.select("doc_id", "sha", *GROUP).distinct().join(groups, list(GROUP))
    found = small_side(_key(found, "sha", *GROUP, "size", "leader", "leader_sha"), name)
    on = ["id", "unnamed", "sha"]
    return _key(texts, "doc_id", "sha", "text").join(found, on).drop("id", "unnamed")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    rows, _, _ = materialize(fingerprints(docs), "fingerprints")
    texts = _normalised(docs).drop("n_bytes")
    groups = small_side(_leaders(rows), "equal-fingerprints")
    members = _members(texts, rows, groups, "equal-rows")
    classes = None
    while True:
        table, _, seen = materialize(_compare(_once(members)), "compared", [
            F.coalesce(F.sum((~F.col("same")).cast("bigint")), F.lit(0)).alias("left")])
        found = table.where("same").join(groups.select(*GROUP, "leader", "leader_sha"), list(GROUP))
        found = found.select("doc_id", "sha", F.col("leader").alias("keep"), "leader_sha")
        classes = found if classes is None else classes.unionByName(found)
        if not seen["left"]:
            break
        # collisions: texts that differ from their group's leader form groups of their own
        rest = table.where("not same").select("doc_id", "sha", *GROUP)
        # (repeats were dropped, so one row may stand for several)
        groups = small_side(_leaders(rest, 1), "collided")
        members = _members(texts, rest, groups, "collided-rows")
    # one row for all repeats of a row, counted in every task before the shuffle
    each = rows.groupBy("doc_id", "sha", *GROUP).agg(F.count(F.lit(1)).alias("copies"))
    r, c = each.alias("r"), classes.alias("c")
    named = r.join(c, F.col("r.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("r.sha") == F.col("c.sha")), "left")
    named = named.select("r.doc_id", "r.sha", *(f"r.{x}" for x in GROUP), "copies",
                         F.col("c.sha").isNotNull().alias("shared"),
                         F.when(F.col("c.sha").isNotNull(), F.col("keep")).otherwise(F.col("r.doc_id")).alias("keep_id"),
                         F.coalesce("leader_sha", "r.sha").alias("keep_sha"))
    # a class is (group, row that stays): its rows are counted in every task before the shuffle
    sizes = named.where("shared").groupBy(*GROUP, "keep_id", "keep_sha").agg(F.sum("copies").alias("group_size"))
    n, z = named.alias("n"), small_side(sizes, "class-sizes").alias("z")
    on = [F.col(f"n.{x}") == F.col(f"z.{x}") for x in (*GROUP, "keep_sha")]
    on.append(F.col("n.keep_id").eqNullSafe(F.col("z.keep_id")))
    out = n.join(z, on, "left").select(
        "n.doc_id", "n.keep_id", F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (F.col("n.doc_id").eqNullSafe(F.col("n.keep_id")) & (F.col("n.sha") == F.col("n.keep_sha"))).alias("keeps"),
        F.col("n.sha").alias("text_sha256"), "copies")
    out, _, seen = materialize(out, "classes", [F.max("copies").alias("most")])
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    once = out.where("copies = 1").withColumn("kept", F.col("keeps")).select(*columns)
    if (seen["most"] or 1) == 1:
        return once
    # repeats come back as rows; those of a row that repeats very often by several tasks
    dealt = out.where("copies > 1").withColumn("first", F.explode(F.sequence(
        F.lit(1).cast("bigint"), F.col("copies"), F.lit(REPEATS).cast("bigint")))).repartition("text_sha256", "first")
    again = dealt.withColumn("copy", F.explode(F.sequence(
        F.col("first"), F.least(F.col("copies"), F.col("first") + (REPEATS - 1)))))
    return once.unionByName(again.withColumn("kept", F.col("keeps") & (F.col("copy") == 1)).select(*columns))
