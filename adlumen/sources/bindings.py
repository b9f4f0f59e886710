"""Bindings: the driver's TPC-H-like tables -> log-shaped inputs.

The library works on ad-request logs; the shared test tables are
orders/lineitem/customer/...  These bindings derive whole-table, log-shaped
inputs from them (one log row per lineitem row, no row subsets).  Each
binding is written once as portable SQL text with ``{table}`` placeholders:
Spark runs it through ``spark.sql(text, **frames)``; the DuckDB oracle runs
the same text with the placeholders replaced by view names, so both engines
see identical inputs and only the operators are implemented twice.

Modulo expressions below only *derive column values* (flags, codes, ids);
they never filter rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlumen.schema import ID_COLUMNS, LOG_FIELDS

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Log columns bound to driver columns; every other log column gets its
# type's default ('' / 0 / 0.0), as a parsed log line with empty fields would.
_AD_LOG_BOUND = {
    "sessionid": "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string))",
    "provincename": "r_name",
    "cityname": "n_name",
    "requestmode": "1 + l_linenumber % 3",
    "processnode": "1 + cast(l_quantity as int) % 4",
    "iseffective": "case when l_returnflag = 'R' then 0 else 1 end",
    "isbilling": "case when l_discount >= 0.05 then 1 else 0 end",
    "isbid": "cast(l_partkey % 2 as int)",
    "iswin": "cast(l_suppkey % 2 as int)",
    "adorderid": "cast(l_orderkey % 5 as int)",
    "winprice": "l_extendedprice",
    "adpayment": "o_totalprice",
    "appid": "cast(l_partkey as string)",
    "appname": "case when l_partkey % 4 = 0 then '' when l_partkey % 4 = 1 then '  ' else p_name end",
    "adspacetype": "l_linenumber * 2 - 2",
    "adspacetypename": "case when l_partkey % 5 = 0 then ' ' else p_type end",
    "adplatformproviderid": "cast(l_suppkey as int)",
    "client": "l_linenumber % 5",
    "networkmannername": (
        "case cast(l_orderkey % 6 as int) when 0 then 'WIFI' when 1 then '4G' when 2 then '3G' "
        "when 3 then '2G' when 4 then 'wifi' else '' end"
    ),
    "ispname": (
        "case cast(l_orderkey % 4 as int) when 0 then '移动' when 1 then '联通' "
        "when 2 then '电信' else 'x' end"
    ),
    "keywords": (
        "concat(replace(p_name, ' ', '|'), '|', p_type, '|ab|', replace(p_name, ' ', '|'))"
    ),
    # ids: a customer's imei; macs shared inside blocks of three neighbouring
    # customers (so households really merge, components stay small); a
    # whitespace-only idfa on some rows; an md5 id on some rows.
    "imei": "case when o_custkey % 11 = 0 then '' else cast(o_custkey as string) end",
    "mac": "cast(o_custkey - o_custkey % 3 + o_orderkey % 3 as string)",
    "idfa": "case when o_orderkey % 60 = 0 then ' ' else '' end",
    "imeimd5": "case when o_orderkey % 7 = 0 then md5(cast(o_custkey as string)) else '' end",
    "long": (
        "case when c_custkey % 50 = 0 then '' when c_custkey % 51 = 0 then 'bad' "
        "else concat(cast(60 + c_custkey % 90 as string), '.', cast(c_custkey % 10 as string), '3') end"
    ),
    "lat": "concat(cast(c_custkey % 60 as string), '.', cast(c_custkey % 7 as string), '7')",
}

_DEFAULTS = {"string": "cast('' as string)", "int": "cast(0 as int)", "double": "cast(0.0 as double)"}


_AD_LOG_FROM = (
    "from {lineitem} join {orders} on l_orderkey = o_orderkey\n"
    "  join {customer} on o_custkey = c_custkey\n"
    "  join {nation} on c_nationkey = n_nationkey\n"
    "  join {region} on n_regionkey = r_regionkey\n"
    "  join {part} on l_partkey = p_partkey"
)
# The same inner joins in another order, for Spark: orders meet their customers
# first, so the far longer line items are moved once less, and they are not moved
# with the names of nations and regions.
_AD_LOG_FROM_SPARK = (
    "from {lineitem} join {placed} on l_orderkey = o_orderkey\n"
    "  join {part} on l_partkey = p_partkey\n"
    "  join {nation} on c_nationkey = n_nationkey\n"
    "  join {region} on n_regionkey = r_regionkey"
)
_PLACED_TEXT = (
    "select o_orderkey, o_custkey, o_totalprice, c_custkey, c_nationkey\n"
    "from {orders} join {customer} on o_custkey = c_custkey"
)


def _ad_log_text(tables: str = _AD_LOG_FROM) -> str:
    cols = []
    for name, kind in LOG_FIELDS:
        expr = _AD_LOG_BOUND.get(name, _DEFAULTS[kind])
        cols.append(f"cast({expr} as {kind}) as {name}")
    return "select " + ",\n  ".join(cols) + "\n" + tables


# Reverse-geocode responses, one per customer, keyed by the customer's
# (long, lat) strings: some JSONP-wrapped, some with business areas, some with
# only POI tags, some failed (status 1), some malformed.
_GEO_TEXT = (
    "select c_custkey,\n"
    "  " + _AD_LOG_BOUND["long"] + " as long,\n"
    "  " + _AD_LOG_BOUND["lat"] + " as lat\n"
    "from {customer}"
)

_GEO_RESPONSES_TEXT = (
    "select " + _AD_LOG_BOUND["long"] + " as long,\n"
    "  " + _AD_LOG_BOUND["lat"] + " as lat,\n"
    """  case when c_custkey % 7 = 0 then 'renderReverse&&renderReverse({{"status":1,"result":{{}}}})'
       when c_custkey % 13 = 0 then '{{"status":0,"result":'
       when c_custkey % 3 = 0 then concat('{{"status":0,"result":{{"business":"","pois":[{{"tag":"',
            c_mktsegment, '"}},{{"tag":""}},{{"tag":"', c_mktsegment, '"}},{{"tag":"', n_name, '"}}]}}}}')
       else concat('renderReverse&&renderReverse({{"status":0,"result":{{"business":"',
            c_mktsegment, ',', n_name, '","pois":[]}}}})') end as response
from {customer} join {nation} on c_nationkey = n_nationkey"""
)

# App dictionary as raw TSV lines: key (field 4) = part key, value (field 1)
# = part name.  Every third part gets a 4-field line (dropped: a lookup miss);
# every seventh a trailing empty key field (kept only by the lenient reader);
# small parts an extra trailing field.
_DICTIONARY_TEXT = (
    "select case when p_partkey % 3 = 0 then\n"
    "    concat_ws(chr(9), cast(p_size as string), p_name, p_brand, p_type)\n"
    "  when p_partkey % 7 = 0 then\n"
    "    concat_ws(chr(9), cast(p_size as string), p_name, p_brand, p_type, '')\n"
    "  when p_size < 10 then\n"
    "    concat_ws(chr(9), cast(p_size as string), p_name, p_brand, p_type, cast(p_partkey as string), 'x')\n"
    "  else concat_ws(chr(9), cast(p_size as string), p_name, p_brand, p_type, cast(p_partkey as string))\n"
    "  end as value\n"
    "from {part}"
)


def _raw_line_fields() -> list[str]:
    """Per-field text of a raw log line, with some deliberately bad values."""
    out = []
    for name, kind in LOG_FIELDS:
        v = name
        if name == "requestmode":
            v = ("case when sk % 17 = 0 then concat(' ', cast(requestmode as string), ' ') "
                 "when sk % 19 = 0 then concat('+', cast(requestmode as string)) "
                 "else cast(requestmode as string) end")
        elif name == "adorderid":
            v = ("case when sk % 23 = 0 then '1.5' when sk % 29 = 0 then '99999999999' "
                 "else cast(adorderid as string) end")
        elif name == "winprice":
            v = ("case when sk % 31 = 0 then 'nan' when sk % 37 = 0 then "
                 "concat(' ', cast(winprice as string), ' ') when sk % 43 = 0 then '1e3' "
                 "else cast(winprice as string) end")
        elif kind != "string":
            v = f"cast({name} as string)"
        out.append(v)
    return out


def _raw_lines_text() -> str:
    line = "concat_ws(',', " + ", ".join(_raw_line_fields()) + ")"
    return (
        "select case when ln = 7 then regexp_replace(line, ',[^,]*$', '')\n"
        "            when ln = 6 then concat(line, ',x,y,z,\"q,r\"')\n"
        "            else line end as value\n"
        "from (select " + line + " as line, sk, ln from (\n"
        "  select *, cast(split_part(sessionid, '-', 1) as bigint) as sk,\n"
        "            cast(split_part(sessionid, '-', 2) as int) as ln from {ad_log}) t) u"
    )


def _id_log_text() -> str:
    """One row per order with every id column in turn the first that is filled.

    ``k`` is the first filled position (from 15 on: none); later positions are
    filled now and then, the others are null, a space or empty.
    """
    cols = []
    for j, name in enumerate(ID_COLUMNS):
        cols.append(
            f"case when k = {j} or (k < {j} and ({j} - k) % 4 = 1) "
            f"then concat('{name[:2]}', cast(o_custkey as string)) "
            f"when (o_orderkey + {j}) % 5 = 0 then cast(null as string) "
            f"when (o_orderkey + {j}) % 5 = 1 then ' ' else '' end as {name}")
    return ("select o_orderkey, " + ",\n  ".join(cols)
            + "\nfrom (select o_orderkey, o_custkey, cast(o_orderkey % 17 as int) as k from {orders}) o")


# Edges with a hub that holds a third of all ids, a chain of another third,
# and single ids.
_HUB_CHAIN_TEXT = (
    "select case cast(o_orderkey % 3 as int) when 0 then 'hub'\n"
    "    when 1 then concat('c', cast(o_orderkey - 3 as string)) else concat('s', cast(o_orderkey as string)) end as src,\n"
    "  concat(case cast(o_orderkey % 3 as int) when 0 then 'h' when 1 then 'c' else 's' end,\n"
    "    cast(o_orderkey as string)) as dst\n"
    "from {orders}"
)

# Stop words: the first word of every part name.
_STOPWORD_TEXT = "select distinct split_part(p_name, ' ', 1) as value from {part}"

# Dictionary lines of four parts to a key, in three files by place.
_REPEATED_DICTIONARY_TEXT = (
    "select cast(p_partkey % 3 as int) as file, p_partkey as pos,\n"
    "  concat_ws(chr(9), cast(p_size as string), p_name, p_brand, p_type,\n"
    "    concat('com.', cast(p_partkey - p_partkey % 4 as string))) as value\n"
    "from {part}"
)

# The log with a third of its rows on one app, one keyword list and one place.
_HOT_LOG_TEXT = (
    "select sessionid,\n"
    "  case when k % 3 = 0 then '8' else appid end as appid,\n"
    "  case when k % 3 = 0 then '' else appname end as appname,\n"
    "  case when k % 3 = 0 then 'hotword|cold|cold' else keywords end as keywords,\n"
    "  case when k % 3 = 0 then '100.03' else long end as long,\n"
    "  case when k % 3 = 0 then '40.57' else lat end as lat\n"
    "from (select *, cast(split_part(sessionid, '-', 1) as bigint) as k from {ad_log}) t"
)

# The log with a day for every row, three days in all.
_DATED_LOG_TEXT = (
    "select *, concat('2024-05-0', cast(1 + cast(split_part(sessionid, '-', 1) as bigint) % 3 as string)) as day\n"
    "from {ad_log}"
)

# Three batches of keyed values: all parts, small ones anew, some more and others besides.
_KEYED_BATCHES_TEXT = (
    "select 1 as batch, cast(p_partkey as string) as key, p_name as value from {part}\n"
    "union all select 2, cast(p_partkey as string), p_brand from {part} where p_size < 20\n"
    "union all select 3, case when p_size < 5 then concat('n', cast(p_partkey as string))\n"
    "  else cast(p_partkey as string) end, p_type from {part} where p_size < 10"
)

# One response per place.
_PLACE_RESPONSES_TEXT = (
    "select long, lat, min(response) as response from {geo_responses} group by long, lat"
)
# Places of the customers of some nations: those a lookup was built for before.
_OLD_PLACES_TEXT = (
    "select p.long, p.lat from {geo_points} p join {customer} c on p.c_custkey = c.c_custkey where c.c_nationkey < 12"
)


BINDINGS = {
    "ad_log": (_ad_log_text(), ["lineitem", "orders", "customer", "nation", "region", "part"]),
    "geo_points": (_GEO_TEXT, ["customer"]),
    "geo_responses": (_GEO_RESPONSES_TEXT, ["customer", "nation"]),
    "app_dictionary_lines": (_DICTIONARY_TEXT, ["part"]),
    "raw_log_lines": (_raw_lines_text(), ["ad_log"]),
    "id_log": (_id_log_text(), ["orders"]),
    "hub_chain_edges": (_HUB_CHAIN_TEXT, ["orders"]),
    "stopword_lines": (_STOPWORD_TEXT, ["part"]),
    "repeated_dictionary_lines": (_REPEATED_DICTIONARY_TEXT, ["part"]),
    "hot_log": (_HOT_LOG_TEXT, ["ad_log"]),
    "dated_log": (_DATED_LOG_TEXT, ["ad_log"]),
    "keyed_batches": (_KEYED_BATCHES_TEXT, ["part"]),
    "place_responses": (_PLACE_RESPONSES_TEXT, ["geo_responses"]),
    "old_places": (_OLD_PLACES_TEXT, ["geo_points", "customer"]),
}


#: Bindings that Spark joins in another order, and what only they need.
_SPARK_BINDINGS = {
    "ad_log": (_ad_log_text(_AD_LOG_FROM_SPARK), ["lineitem", "placed", "part", "nation", "region"]),
    "placed": (_PLACED_TEXT, ["orders", "customer"]),
}


def binding_sql(name: str) -> str:
    """The binding as DuckDB SQL over the pre-registered table views."""
    text, deps = BINDINGS[name]
    subs = {}
    for d in deps:
        subs[d] = f"({binding_sql(d)})" if d in BINDINGS else d
    return text.format(**subs)


def binding(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The binding as a Spark DataFrame over the parquet tables in ``sf_dir``."""
    text, deps = _SPARK_BINDINGS.get(name) or BINDINGS[name]
    frames = {}
    for d in deps:
        bound = d in BINDINGS or d in _SPARK_BINDINGS
        frames[d] = binding(spark, sf_dir, d) if bound else read_table(spark, sf_dir, d)
    return spark.sql(text, **frames)


def ad_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding(spark, sf_dir, "ad_log")


def geo_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding(spark, sf_dir, "geo_points")


def geo_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding(spark, sf_dir, "geo_responses")


def app_dictionary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding(spark, sf_dir, "app_dictionary_lines")


def raw_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log lines as a plain ``value`` column, as text files give them.

    The lines come from a generator of one row, which the optimizer does not
    move the parsers' conditions past: so the very large expression that builds a
    line is computed once, and nothing has to be written for it.
    """
    lines = binding(spark, sf_dir, "raw_log_lines")
    return lines.select(F.explode(F.array("value")).alias("value"))


def stopwords(spark: SparkSession, words=("cold", "bolt")) -> DataFrame:
    """Stop-word list (a parameter, like the word file a deployment ships)."""
    return spark.createDataFrame([(w,) for w in words], "value string")
