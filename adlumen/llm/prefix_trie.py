"""The trie of conversations' shared turn prefixes, by bursting.

Every conversation is a sequence of turns; each turn has an id (a digest of its
role and text), and each prefix a 128-bit name, the xor of the hashes of its
(turn id, depth) pairs, so names need no walk along the sequence.

A container holds all suffixes below one trie head.  It starts at the root;
while a container has over ``capacity`` rows it bursts by the next turn id: its
head becomes a node of the trie, counted by an aggregate with partial sums, and
its suffixes go to the containers of the head's children.  Levels are burst in
rounds of 1, 2, 4, ... at once, each over the conversations whose containers are
still too large.  What is left has at most ``capacity`` rows to a container: a
task sorts its suffixes and sweeps them into nodes with a stack.  A container
with one conversation is a chain and needs no sorting, however long it is.  The
totals of containers are then added to the burst nodes above them, along the
path of one member each.

A conversation with a large share of all rows is numbered by a range sort on
(conv_id, turn, role, text), so its rows spread over tasks.  The digest of
members that end in one burst node is put together from pieces made in
parallel; only hashing the pieces is in order.

Defined cases: null role or text is empty; turns are ordered by turn (null
first), then role, then text; repeated rows are turns of their own; rows
without conv_id belong to no conversation and are ignored; an empty table has
only a root without members, and gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlumen.llm.common import small_side
from adlumen.session import materialize

CAPACITY = 1024         # rows of a container
CHUNK = 4096            # turns whose names one window runs through
PIECE = 8192            # conversation ids in a piece of a digest
WORD = r"[^\x20\x09-\x0D]+"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
        "n_leaves bigint, saved_tokens bigint, ends_sha256 string")
PREFIX = ["depth", "a", "b"]


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, pos, turn id, words of each row; conv, total of each conversation), pos from 0."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("tie"))
    order = ["conv", F.asc_nulls_first("turn"), "role", "text", "tie"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("idx"),
        F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("turn_id"),
        F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("words"))
    table, _, _ = materialize(dealt, "turns")
    parts = table.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("low"))
    by_conv = Window.partitionBy("conv")
    before = F.coalesce(F.sum("n").over(by_conv.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("conv", "part", (before - F.col("low")).alias("add"))
    turns = table.join(parts, ["conv", "part"]).select(
        "conv", (F.col("idx") + F.col("add")).alias("pos"), "turn_id", "words")
    return turns, table.groupBy("conv").agg(F.count(F.lit(1)).alias("total"))


def share_heads(turns: DataFrame, totals: DataFrame, every: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt to share beginnings: the first h turns of conversation
    c - c % ``every``, then those of c after its first h; h = crc32(c as text) mod ``most``.
    (conv, depth from 1, turn id, words; conv, length)."""
    turns = materialize(turns, "numbered")[0]
    heads = turns.where((F.col("conv") % every == 0) & (F.col("pos") < most - 1)).groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("pos", "turn_id", "words"))).alias("head"))
    convs = totals.select("conv", "total", (F.crc32(F.col("conv").cast("string")) % most).alias("h"),
                          (F.col("conv") - F.col("conv") % every).alias("base"))
    convs = convs.join(heads.withColumnRenamed("conv", "base"), "base", "left")
    taken = F.least(F.col("h"), F.coalesce(F.size("head"), F.lit(0)).cast("bigint"))
    taken = F.when(F.col("head").isNull(), F.lit(0).cast("bigint")).otherwise(taken)
    convs = convs.select("conv", "h", taken.alias("taken"), F.slice("head", 1, taken.cast("int")).alias("head"),
                         (taken + F.greatest(F.lit(0).cast("bigint"), F.col("total") - F.col("h"))).alias("len"))
    convs = materialize(convs, "rebuilt")[0]
    lent = convs.select("conv", "len", F.explode("head").alias("t")).select(
        "conv", (F.col("t.pos") + 1).alias("depth"), "t.turn_id", "t.words", "len")
    # h is known from conv; what was taken is needed per conversation
    own = turns.where(F.col("pos") >= F.crc32(F.col("conv").cast("string")) % most).join(
        convs.select("conv", "h", "taken", "len"), "conv")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("depth"), "turn_id", "words", "len")
    return lent.unionByName(own), convs.select("conv", "len")


def named_prefixes(turns: DataFrame) -> DataFrame:
    """conv, depth, len, words, (a, b): name of the prefix, (pa, pb): of the one before."""
    at = turns.withColumns({"ta": F.xxhash64("turn_id", "depth"), "tb": F.xxhash64("depth", F.lit("b"), "turn_id"),
                            "chunk": F.floor(F.col("depth") / CHUNK)})
    sums = at.groupBy("conv", "chunk").agg(F.bit_xor("ta").alias("ca"), F.bit_xor("tb").alias("cb"))
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    sums = sums.select("conv", "chunk", F.coalesce(F.bit_xor("ca").over(before), zero).alias("ca"),
                       F.coalesce(F.bit_xor("cb").over(before), zero).alias("cb"))
    within = Window.partitionBy("conv", "chunk").orderBy("depth")
    at = at.join(sums, ["conv", "chunk"])
    named = at.select("conv", "depth", "len", "words", "ta", "tb",
                      F.col("ca").bitwiseXOR(F.bit_xor("ta").over(within)).alias("a"),
                      F.col("cb").bitwiseXOR(F.bit_xor("tb").over(within)).alias("b"))
    return named.select("conv", "depth", "len", "words", "a", "b", F.col("a").bitwiseXOR(F.col("ta")).alias("pa"),
                        F.col("b").bitwiseXOR(F.col("tb")).alias("pb"))


def burst(prefixes: DataFrame, convs: DataFrame, capacity: int) -> DataFrame:
    """Nodes whose containers burst, the root among them: PREFIX, pa, pb, n, conv (smallest member), words."""
    root = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).where("n > 0").select(
        *(F.lit(0).cast("bigint").alias(c) for c in (*PREFIX, "pa", "pb")), "n", "conv",
        F.lit(0).cast("bigint").alias("words"))
    found, low, step, live = [root], 0, 1, prefixes
    while True:
        high = low + step
        level = live.where(F.col("depth").between(low + 1, high))
        sizes = level.groupBy(*PREFIX).agg(
            F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), F.max("words").alias("words"),
            F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.sum(F.col("len") - F.col("depth") + 1).alias("rows"))
        table, _, seen = materialize(
            sizes.where((F.col("rows") > capacity) & (F.col("n") > 1)).drop("rows"), "burst",
            [F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("depth") == high, 1)).alias("deep")])
        if seen["n"]:
            found.append(table)
        if not seen["deep"]:
            break
        # suffixes of containers that are still too large
        deep = small_side(table.where(F.col("depth") == high).select("a", "b"), "deep")
        still = live.where(F.col("depth") == high).join(deep, ["a", "b"], "left_semi").select("conv")
        live, _, _ = materialize(live.where(F.col("depth") > high).join(still, "conv", "left_semi"), "live")
        low, step = high, step * 2
    out = found[0]
    for t in found[1:]:
        out = out.unionByName(t.select(*out.columns))
    return out


def _sweep(rows: list[tuple]) -> Iterator[tuple]:
    """Nodes of one container, from (conv, depth, a, b, words, len, parent) rows in order of conv, depth."""
    suffixes: dict[int, list] = {}
    for conv, depth, a, b, words, _, _ in rows:
        suffixes.setdefault(conv, []).append((a, b, depth, words))
    parent = rows[0][6]
    nodes: list[dict] = []
    stack: list[int] = []
    last: list = []

    def close():
        k = stack.pop()
        x = nodes[k]
        x["saved"] += (x["n"] - 1) * x["words"]
        x["leaves"] = x["leaves"] or 1
        if stack:
            up = nodes[stack[-1]]
            up["n"] += x["n"]
            up["conv"] = min(up["conv"], x["conv"])
            up["saved"] += x["saved"]
            up["leaves"] += x["leaves"]
            up["children"] += 1

    for conv, path in sorted(suffixes.items(), key=lambda kv: (kv[1], kv[0])):
        same = 0
        while same < min(len(path), len(last)) and path[same] == last[same]:
            same += 1
        while len(stack) > same:
            close()
        for _, _, depth, words in path[same:]:
            nodes.append({"depth": depth, "words": words, "up": stack[-1] if stack else None, "n": 0, "conv": conv,
                          "saved": 0, "leaves": 0, "children": 0, "ends": []})
            stack.append(len(nodes) - 1)
        end = nodes[stack[-1]]
        end["n"] += 1
        end["conv"] = min(end["conv"], conv)
        end["ends"].append(conv)
        last = path
    while stack:
        close()
    for x in nodes:
        ends = ",".join(map(str, sorted(x["ends"])))
        yield (x["conv"], x["depth"], parent if x["up"] is None else nodes[x["up"]]["conv"], x["n"], x["children"],
               x["leaves"], x["saved"], hashlib.sha256(ends.encode()).hexdigest())


def sweep_containers(rows: DataFrame) -> DataFrame:
    """Nodes of containers (ha, hb); ``top`` marks the head, whose totals the nodes above need."""
    schema = NODE + ", g bigint, pa bigint, pb bigint, top boolean"
    names = [c.split()[0] for c in schema.split(", ")]
    cols = ["ha", "hb", "g", "pa", "pb", "conv", "depth", "a", "b", "words", "len", "parent"]
    dealt = rows.select(*cols).repartition("ha", "hb").sortWithinPartitions("ha", "hb", "conv", "depth")

    def run(batches):
        key, held = None, []

        def flush():
            out = [(*node, *key[2:], node[1] == key[2] + 1) for node in _sweep(held)]
            return pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out, strict=True)), strict=True)))

        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in cols), strict=True):
                if r[:5] != key:
                    if held:
                        yield flush()
                    key, held = r[:5], []
                held.append(r[5:])
        if held:
            yield flush()

    return dealt.mapInArrow(run, schema)


def end_digests(ends: DataFrame) -> DataFrame:
    """PREFIX and the SHA-256 of its ``conv`` values, ascending and joined by commas."""
    order = [*PREFIX, "conv"]

    def cut(batches):
        now, held = None, []

        def flush():
            return pa.RecordBatch.from_pydict({c: pa.array([v], pa.int64()) for c, v in zip(order, (*now, held[0]))}
                                              | {"ids": [",".join(map(str, held))]})

        for batch in batches:
            for *key, conv in zip(*(batch.column(c).to_pylist() for c in order), strict=True):
                if key != now or len(held) >= PIECE:
                    if held:
                        yield flush()
                    now, held = key, []
                held.append(conv)
        if held:
            yield flush()

    def join(batches):
        now, digest = None, None

        def done():
            return pa.RecordBatch.from_pydict({c: pa.array([v], pa.int64()) for c, v in zip(PREFIX, now)}
                                              | {"ends_sha256": [digest.hexdigest()]})

        for batch in batches:
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*PREFIX, "ids")), strict=True):
                if key != now:
                    if now is not None:
                        yield done()
                    now, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if now is not None:
            yield done()

    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        cut, "depth bigint, a bigint, b bigint, conv bigint, ids string")
    return pieces.repartition(*PREFIX).sortWithinPartitions(*order).mapInArrow(
        join, "depth bigint, a bigint, b bigint, ends_sha256 string")


def trie_nodes(turns: DataFrame, convs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per distinct prefix of the conversations, the empty one included.

    ``turns``: conv, depth (from 1), turn_id, words, len; ``convs``: conv, len.
    """
    convs = materialize(convs, "conversations")[0]
    prefixes = materialize(named_prefixes(turns), "prefixes")[0]
    inner = materialize(burst(prefixes, convs, capacity), "inner")[0]
    keys = small_side(inner.select(*PREFIX), "inner-names")

    # how deep each conversation runs through burst nodes, and the head of its container
    path = prefixes.join(keys, PREFIX, "left_semi").select("conv", *PREFIX)
    deep = path.groupBy("conv").agg(F.max("depth").alias("g"))
    where = convs.join(deep, "conv", "left").select("conv", "len", F.coalesce("g", F.lit(0)).cast("bigint").alias("g"))
    where = materialize(where, "reach")[0]
    below = prefixes.join(where.select("conv", "g"), "conv").where(F.col("depth") > F.col("g"))
    below = materialize(below, "below")[0]
    heads = below.where(F.col("depth") == F.col("g") + 1).select(
        "conv", "g", F.col("a").alias("ha"), F.col("b").alias("hb"), "pa", "pb")
    up = small_side(inner.select(F.col("depth").alias("g"), F.col("a").alias("pa"), F.col("b").alias("pb"),
                                 F.col("conv").alias("parent")), "parents")
    heads = heads.join(up, ["g", "pa", "pb"])
    heads = materialize(heads, "heads")[0]
    alone = heads.groupBy("ha", "hb").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"))
    alone = materialize(alone.where("n = 1").select("conv"), "chains")[0]
    single = heads.join(alone, "conv", "left_semi")
    shared = heads.join(alone, "conv", "left_anti")

    rest = below.drop("pa", "pb", "g")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    ends = F.col("depth") == F.col("len")
    chains = rest.join(single, "conv").select(
        F.col("conv").alias("conv_id"), "depth",
        F.when(F.col("depth") == F.col("g") + 1, F.col("parent")).otherwise(F.col("conv")).alias("parent_conv_id"),
        one.alias("n_convs"), F.when(ends, zero).otherwise(one).alias("n_children"), one.alias("n_leaves"),
        zero.alias("saved_tokens"),
        F.when(ends, F.sha2(F.col("conv").cast("string"), 256)).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256"))
    swept = materialize(sweep_containers(rest.join(shared, "conv")), "swept")[0]

    # totals of containers at the burst nodes above them
    tops = swept.where("top").select("g", "pa", "pb", "n_leaves", "saved_tokens").unionByName(
        single.select("g", "pa", "pb", one.alias("n_leaves"), zero.alias("saved_tokens")))
    hung = tops.groupBy(F.col("g").alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count(F.lit(1)).alias("heads"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    kids = inner.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"),
                                            F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("kids"))
    own = inner.join(hung, PREFIX, "left").join(kids, PREFIX, "left").select(
        *PREFIX, "pa", "pb", "n", "conv",
        (F.coalesce("heads", zero) + F.coalesce("kids", zero)).alias("n_children"),
        F.coalesce("leaves", zero).alias("leaves"),
        (F.coalesce("saved", zero) + (F.col("n") - 1) * F.col("words")).alias("saved"))
    own = own.withColumn("leaves", F.when(F.col("n_children") == 0, one).otherwise(F.col("leaves")))
    own = materialize(own, "inner-totals")[0]
    # ... and from each burst node along its smallest member's path
    at = own.select("conv", F.col("depth").alias("upto"), "leaves", "saved")
    trail = path.unionByName(where.select("conv", *(zero.alias(c) for c in PREFIX)))
    sums = trail.join(at, "conv").where(F.col("depth") <= F.col("upto")).groupBy(*PREFIX).agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    ended = where.where(F.col("len") == F.col("g")).select("conv", "len")
    last = path.join(ended, (path["conv"] == ended["conv"]) & (path["depth"] == ended["len"])).select(
        *(path[c] for c in ("conv", *PREFIX)))
    last = last.unionByName(ended.where("len = 0").select("conv", *(zero.alias(c) for c in PREFIX)))
    parents = inner.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
                           F.col("conv").alias("parent_conv_id"))
    top = own.join(sums, PREFIX).join(parents, ["depth", "pa", "pb"], "left").join(end_digests(last), PREFIX, "left")
    names = [c.split()[0] for c in NODE.split(", ")]
    top = top.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
                     "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
    return top.unionByName(chains.select(*names)).unionByName(swept.select(*names))


def conversation_trie(conversations: DataFrame, every: int = 20, most: int = 4, capacity: int = CAPACITY) -> DataFrame:
    """The trie of conversations rebuilt by ``share_heads``."""
    turns, totals = numbered_turns(conversations)
    return trie_nodes(*share_heads(turns, totals, every, most), capacity)
