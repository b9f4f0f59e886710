"""Tag generators and tag merging.

A generator is a function returning nullable string Columns: the tags one log
row contributes, each with weight 1.  Generators are pure expressions (no UDF);
the per-tag arrays and the profiles use the same ones.  Two sources need a
lookup table: app names get the dictionary value as an extra column (a
left join per row), keywords are checked against the stop list in *long
form* (one row per word, anti join).  Merging sums weights per (user, tag),
a user's rows brought together first; a heavy user is pre-summed in every
task instead (``weigh_tags``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlumen.functions.strings import is_blank, not_blank
from adlumen.operators.lookup import DEFAULT_BROADCAST_ROWS, drop_stopwords, hot_keys, lookup_join, measured_side
from adlumen.schema import (
    CARRIER_CODES, CARRIER_OTHER, KEYWORD_MAX_LEN, KEYWORD_MIN_LEN, NETWORK_CODES,
    NETWORK_OTHER, OS_CODES, OS_OTHER, TAG_AD_SLOT, TAG_AD_SLOT_NAME, TAG_APP, TAG_CHANNEL,
    TAG_CITY, TAG_KEYWORD, TAG_PROVINCE,
)


#: Columns that lookups add to a row.
DICT_APP, BUSINESS = "__dict_app", "__business"
#: A finished tag that travels beside the rows (``tags_long``).
_MADE = "__made"
#: Sign before a keyword piece while it shares an array with finished tags.
_MARK = "\x00K"


def _compact(*items: Column) -> Column:
    """Array of the non-null items.

    ``array_except`` with ``[null]`` drops the nulls in generated code (a
    lambda ``filter`` would be evaluated interpreted, row by row).  It also
    drops repeats, which cannot occur here: every item has its own prefix.
    """
    return F.array_except(F.array(*items), F.array(F.lit(None).cast("string")))


def _code(c: Column, codes: dict, other: str) -> Column:
    expr = None
    for k, v in codes.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(other))


def ad_items(slot_type: str = "adspacetype", slot_name: str = "adspacetypename",
             channel: str = "adplatformproviderid") -> list[Column]:
    """Slot type ``LC``nn (one digit padded; <= 0 none), slot name ``LN``, channel ``CN``."""
    v = F.col(slot_type)
    lc = (F.when(v > 9, F.concat(F.lit(TAG_AD_SLOT), v.cast("string")))
           .when(v > 0, F.concat(F.lit(TAG_AD_SLOT + "0"), v.cast("string"))))
    ln = F.when(not_blank(slot_name), F.concat(F.lit(TAG_AD_SLOT_NAME), F.col(slot_name)))
    cn = F.concat(F.lit(TAG_CHANNEL), F.coalesce(F.col(channel), F.lit(0)).cast("string"))
    return [lc, ln, cn]


def app_items(appname: str = "appname", appid: str = "appid",
              dict_name: str | None = DICT_APP) -> list[Column]:
    """``APP`` + name; a blank name falls back to dictionary(appid), then appid.

    ``dict_name`` names a column already holding the dictionary lookup of
    ``appid`` (see ``with_app_lookup``); without it the id itself is used.
    """
    fallback = F.col(appid) if dict_name is None else F.coalesce(F.col(dict_name), F.col(appid))
    return [F.when(not_blank(appname), F.concat(F.lit(TAG_APP), F.col(appname)))
             .when(not_blank(appid), F.concat(F.lit(TAG_APP), fallback))]


def named_app_items(appname: str = "appname") -> list[Column]:
    """The ``APP`` tag of rows that name their app; ``needs_app_lookup`` tells the others."""
    return [F.when(not_blank(appname), F.concat(F.lit(TAG_APP), F.col(appname)))]


def needs_app_lookup(appname: str = "appname", appid: str = "appid") -> Column:
    return is_blank(appname) & not_blank(appid)


def looked_up_apps(rows: DataFrame, dictionary: DataFrame, *, appid: str = "appid",
                   sketch: DataFrame | None = None,
                   broadcast_rows: int = DEFAULT_BROADCAST_ROWS, small: bool | None = None) -> DataFrame:
    """Rows that name no app, cut to ``appid`` and a key: ``appid`` becomes the ``APP`` tag ``tag``.

    So a dictionary beyond a broadcast meets narrow rows, not whole ones.
    ``sketch`` and ``small`` as in ``lookup_join``.
    """
    joined = with_app_lookup(rows, dictionary, appid=appid, broadcast_rows=broadcast_rows, sketch=sketch, small=small)
    tag = F.concat(F.lit(TAG_APP), F.coalesce(F.col(DICT_APP), F.col(appid))).alias("tag")
    return joined.select(*[tag if c == appid else F.col(c) for c in rows.columns])


def device_items(client: str = "client", network: str = "networkmannername",
                 carrier: str = "ispname") -> list[Column]:
    """Operating system, network and carrier codes (always three tags)."""
    return [
        _code(F.coalesce(F.col(client), F.lit(0)), OS_CODES, OS_OTHER),
        _code(F.col(network), NETWORK_CODES, NETWORK_OTHER),
        _code(F.col(carrier), CARRIER_CODES, CARRIER_OTHER),
    ]


def location_items(province: str = "provincename", city: str = "cityname") -> list[Column]:
    return [
        F.when(not_blank(province), F.concat(F.lit(TAG_PROVINCE), F.col(province))),
        F.when(not_blank(city), F.concat(F.lit(TAG_CITY), F.col(city))),
    ]


#: Generators of a row's tags: each gives nullable string columns, one tag or null.
GENERATORS: tuple[Callable[[], list[Column]], ...] = (ad_items, location_items, device_items, app_items)


def ad_tags(**columns) -> Column:
    return _compact(*ad_items(**columns))


def app_tags(dict_name: str | None = None, **columns) -> Column:
    return _compact(*app_items(dict_name=dict_name, **columns))


def device_tags(**columns) -> Column:
    return _compact(*device_items(**columns))


def location_tags(**columns) -> Column:
    return _compact(*location_items(**columns))


def keyword_candidates(keywords: str = "keywords") -> Column:
    """All ``|``-separated pieces of the keyword field (null -> [""])."""
    return F.split(F.coalesce(F.col(keywords), F.lit("")), r"\|")


def keyword_ok(word: Column) -> Column:
    """A keyword counts when it has 3..8 characters (code points)."""
    return F.length(word).between(KEYWORD_MIN_LEN, KEYWORD_MAX_LEN)


def with_app_lookup(df: DataFrame, dictionary: DataFrame | None, *, appid: str = "appid",
                    out: str = DICT_APP, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                    sketch: DataFrame | None = None, small: bool | None = None) -> DataFrame:
    """Add ``out`` = dictionary value of ``appid`` (null if missing or no dictionary)."""
    if dictionary is None:
        return df.withColumn(out, F.lit(None).cast("string"))
    lk = dictionary.select(F.col("key").alias("__k"), F.col("value").alias(out))
    return lookup_join(df, lk, appid, "__k", broadcast_rows=broadcast_rows, sketch=sketch, small=small).drop("__k")


def row_tags(dict_name: str | None = DICT_APP) -> Column:
    """All expression-only tags of a row: ad, location, device and app."""
    return F.concat(ad_tags(), location_tags(), device_tags(), app_tags(dict_name=dict_name))


def tags_long(df: DataFrame, keys: Sequence[str], *, dictionary: DataFrame | None = None,
              stopwords: DataFrame | None = None, business_lookup: DataFrame | None = None,
              include_keywords: bool = True,
              generators: Sequence[Callable[[], list[Column]]] = GENERATORS,
              keywords: str = "keywords", gather: str | None = None, made: DataFrame | None = None,
              small: bool | None = None) -> DataFrame:
    """One row ``(keys..., tag)`` per tag occurrence of every input row.

    One scan: the generators' items, the row's keyword pieces and its business
    areas form one array, exploded once with its position.  Keywords are told
    by their position; stop words are removed by an anti join on those rows
    only, business areas come from a left join on the row's geohash.
    ``generators`` may be any functions that give nullable string columns; a
    generator that needs a lookup reads a column that was joined before.
    ``gather`` names a key whose rows are brought together before they are exploded
    (no key may hold a large share of them: ``weigh_tags`` sees to that).  ``made`` holds
    finished tags of the same keys, ``(keys..., tag)``, which are gathered along with the
    rows.  ``small`` tells of the dictionary what it tells in ``lookup_join``.
    """
    keys = list(keys)
    items = [c for g in generators for c in g()]
    base = with_app_lookup(df, dictionary, small=small) if app_items in generators else df
    if business_lookup is not None:
        from adlumen.operators.geo import with_business

        base = with_business(base, business_lookup)
    if made is not None:
        base = base.unionByName(made.withColumnRenamed("tag", _MADE), allowMissingColumns=True)
    if gather is not None:
        base = base.repartition(gather)
    parts = [F.array(*items) if items else F.array().cast("array<string>")]
    if business_lookup is not None:
        parts.append(F.coalesce(F.split(F.col(BUSINESS), ";"), F.array().cast("array<string>")))
    if include_keywords:
        # behind everything else, marked, so that only these are checked
        parts.append(F.split(F.concat(F.lit(_MARK), F.replace(
            F.coalesce(F.col(keywords), F.lit("")), F.lit("|"), F.lit("|" + _MARK))), r"\|"))
    tags = F.concat(*parts)
    if made is not None:
        tags = F.when(F.col(_MADE).isNull(), tags).otherwise(F.array(_MADE))
    long = base.select(*keys, F.explode(tags).alias("tag"))
    long = long.where(F.col("tag").isNotNull() & (F.col("tag") != ""))
    if not include_keywords:
        return long
    marked = F.col("tag").startswith(_MARK)
    word = F.substring(F.col("tag"), len(_MARK) + 1, 1 << 30)
    long = long.select(*keys, F.when(~marked, F.col("tag")).alias("tag"), F.when(marked, word).alias("__word"))
    long = long.where(F.col("__word").isNull() | keyword_ok(F.col("__word")))
    if stopwords is not None:
        long = drop_stopwords(long, stopwords, word="__word")
    return long.select(*keys, F.coalesce("tag", F.concat(F.lit(TAG_KEYWORD), F.col("__word"))).alias("tag"))


def merge_tags(long: DataFrame, user: str = "user_id") -> DataFrame:
    """``(user, tag)`` occurrences -> ``(user, tag, weight)``."""
    return long.groupBy(user, "tag").agg(F.count(F.lit(1)).alias("weight"))


#: Rows that one task takes of a key without a thought; only keys with more can be hot.
GATHERED_ROWS = 500_000


def weigh_tags(rows: DataFrame, key: str, *, least: int = GATHERED_ROWS, dictionary: DataFrame | None = None,
               broadcast_rows: int = DEFAULT_BROADCAST_ROWS, **lookups) -> DataFrame:
    """Tags of all rows, ``(key, tag, weight)``; ``lookups`` as in ``tags_long``.

    A row has over a dozen tags, and hardly any repeat among the rows that one task
    happens to read: sums made there hold nearly every occurrence.  So the rows of
    a key are brought together first, not yet exploded, and one aggregate over a
    task's whole keys follows.  Keys with a large share of the rows
    (``operators.lookup.hot_keys``) stay where they are: of such, sums in every
    task are small.

    A dictionary beyond a broadcast meets the app ids of the rows that name no app,
    beside their keys, instead of whole rows; the tags made so are gathered with the
    rows.  The rows are then read several times: they should come from a table.
    """
    hot = hot_keys(rows, key, least)
    made = None
    if dictionary is not None:
        dictionary, small = measured_side(dictionary, broadcast_rows)
        lookups["small"] = small
        if not small:
            unnamed = rows.where(needs_app_lookup()).select(key, "appid")
            made = looked_up_apps(unnamed, dictionary, small=False)
            lookups["generators"] = (*(g for g in GENERATORS if g is not app_items), named_app_items)
            dictionary = None
    lookups["dictionary"] = dictionary

    def part(keep, gather):
        kept = [x if keep is None or x is None else x.where(keep) for x in (rows, made)]
        return merge_tags(tags_long(kept[0], [key], gather=gather, made=kept[1], **lookups), key)

    if not hot:
        return part(None, key)
    return part(F.col(key).isNull() | ~F.col(key).isin(hot), key).unionByName(part(F.col(key).isin(hot), None))


def collect_profiles(merged: DataFrame, user: str = "user_id") -> DataFrame:
    """``(user, tag, weight)`` -> ``(user, tags array<struct<tag,weight>>)`` sorted by tag.

    One array per user: its size is the user's number of distinct tags.
    """
    return merged.groupBy(user).agg(
        F.array_sort(F.collect_list(F.struct("tag", "weight"))).alias("tags"))
