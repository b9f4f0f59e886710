"""Keyed lookups: dictionary fill and stop-word removal.

A lookup side is written once as a table in the checkpoint folder; its rows and
bytes are observed during that write (partial sums in every task).  It is
broadcast only if both are under a bound.  Beyond the bound ``lookup_join``
splits the join by the big side's own keys: a frequent-items sketch (bounded,
whatever the number of keys) names the keys that hold more rows than a task
should get, and those rows stay where they are, joined with a broadcast of just
their lookup rows; rows of null keys stay too; all others are shuffled, with no
hot key left among them.  Should the hot keys' own values be too large to
broadcast, their rows are dealt by a salt and the values repeated for each salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlumen.functions.strings import is_blank
from adlumen.session import materialize, shuffles_freed

# What a lookup side may have and still be broadcast: rows, and bytes of its
# strings (the hash relation on an executor is a few times that).
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def size_metrics(df: DataFrame) -> list[Column]:
    """Aggregates ``n`` (rows) and ``bytes`` (of the strings; 8 for other columns)."""
    width = F.lit(0).cast("bigint")
    for name, kind in df.dtypes:
        width = width + (F.coalesce(F.octet_length(F.col(name)), F.lit(0)) if kind == "string" else F.lit(8))
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")]


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` is under both bounds (one aggregate over it, summed
    in every task first; use it on tables, not on expensive plans)."""
    with shuffles_freed(df.sparkSession):
        m = df.agg(*size_metrics(df)).first()
    return m["n"] <= max_rows and m["bytes"] <= max_bytes


def measured_side(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                  max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``df`` as a table, and whether it is under both bounds."""
    table, _, m = materialize(df, "lookup", size_metrics(df))
    return table, m["n"] <= max_rows and m["bytes"] <= max_bytes


def lookup_side(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``df`` as a table, with a broadcast hint only when it is proven small."""
    table, small = measured_side(df, max_rows, max_bytes)
    return F.broadcast(table) if small else table


#: Items that the frequent-items sketch tracks, and the most hot keys taken from it.
SKETCH_ITEMS, MOST_HOT = 65_536, 2_000


def hot_keys(df: DataFrame, key: str, least: int = 0) -> list[str]:
    """Keys with more than a quarter of an even task's share of the rows, and more than ``least`` rows.

    One aggregate over ``df`` with a sketch in every task.  It misses no key above
    2.7 / (0.75 * ``SKETCH_ITEMS``) of the rows, far below the share asked for; at
    most ``MOST_HOT`` keys can have that share.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1 / (4 * tasks), 1 / MOST_HOT)
    top = F.expr(f"approx_top_k({key}, {MOST_HOT}, {SKETCH_ITEMS})")
    sums = df.select(F.col(key).cast("string").alias(key)).agg(top.alias("top"), F.count(F.lit(1)).alias("n"))
    with shuffles_freed(df.sparkSession):
        seen = sums.first()
    return sorted(t["item"] for t in seen["top"] or [] if t["item"] is not None and t["count"] > max(share * seen["n"], least))


def lookup_join(df: DataFrame, side: DataFrame, key: str, side_key: str, how: str = "left", *,
                broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, salts: int | None = None,
                sketch: DataFrame | None = None, small: bool | None = None) -> DataFrame:
    """``df`` joined with ``side`` on ``key = side_key`` (strings; ``how``: left,
    inner, left_semi or left_anti).  ``side`` is unique on its key, or ``how``
    is semi or anti; null keys match nothing.  Beyond the broadcast bounds ``df``
    is read for its sketch and then for each part.  ``sketch`` may be a table that is
    read instead for the sketch: one with the keys of ``df``, whose hot ones are hot there.
    ``small``: ``side`` is a table already, known to be under the bounds or not (``measured_side``).
    """
    table, small = measured_side(side, broadcast_rows, broadcast_bytes) if small is None else (side, small)

    def join(rows, lookup, more=None):
        on = rows[key] == lookup[side_key]
        return rows.join(lookup, on if more is None else on & more, how)

    if small:
        return join(df, F.broadcast(table))
    hot = hot_keys(df if sketch is None else sketch, key)
    stays = F.col(key).isNull() | (F.col(key).isin(hot) if hot else F.lit(False))
    cold = join(df.where(~stays), table)
    few = table.where(F.col(side_key).isin(hot) if hot else F.lit(False))
    here = df.where(stays)
    if fits_broadcast(few, MOST_HOT, broadcast_bytes):
        return cold.unionByName(join(here, F.broadcast(few)))
    salts = salts or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = here.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    copies = few.withColumn("__to", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = join(dealt, copies, dealt["__salt"] == copies["__to"]).drop("__salt", "__to")
    return cold.unionByName(salted)


def fill_from_dictionary(df: DataFrame, dictionary: DataFrame, *, target: str = "appname",
                         key: str = "appid", dict_key: str = "key", dict_value: str = "value",
                         default: Column | str | None = None,
                         broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Replace a blank ``target`` by ``dictionary[key]``; missing key -> ``default``.

    ``default`` may be a literal string (e.g. ``"unknow"``), a Column (e.g.
    ``F.col("appid")`` to fall back to the key itself) or None (stays null).
    The dictionary must be unique on ``dict_key`` (see ``sources.dictionary``).
    Non-blank targets are kept as they are.
    """
    if isinstance(default, str):
        default = F.lit(default)
    lk = dictionary.select(F.col(dict_key).alias("__k"), F.col(dict_value).alias("__v"))
    joined = lookup_join(df, lk, key, "__k", broadcast_rows=broadcast_rows)
    found = F.col("__v") if default is None else F.coalesce(F.col("__v"), default)
    filled = F.when(is_blank(F.col(target)), found).otherwise(F.col(target))
    cols = [filled.alias(target) if c == target else F.col(c) for c in df.columns]
    return joined.select(*cols)


def drop_stopwords(words: DataFrame, stopwords: DataFrame, *, word: str = "word",
                   stop_col: str = "value",
                   broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Rows of ``words`` whose ``word`` is not in the stop list (left-anti join)."""
    stop = stopwords.select(F.col(stop_col).alias("__w")).distinct()
    return lookup_join(words, stop, word, "__w", "left_anti", broadcast_rows=broadcast_rows)
