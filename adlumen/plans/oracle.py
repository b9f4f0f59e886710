"""Independent DuckDB SQL for every registered query (the correctness oracle).

Inputs come from the same binding text as the Spark side
(``sources.bindings.binding_sql``); the operator logic below is written
separately in SQL, with its fixed values spelled out here, so that a wrong one
in ``schema`` shows (the 85 fields also shape the bindings and are shared).
Counts are cast to BIGINT (DuckDB sums ints to HUGEINT).
"""

from __future__ import annotations

from adlumen.schema import LOG_FIELDS
from adlumen.sources.bindings import binding_sql

ORACLES: dict[str, str] = {}


def _b(name: str) -> str:
    return f"({binding_sql(name)})"


# Java whitespace (Character.isWhitespace) as an RE2 class.
_WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}]"


def blank(x: str) -> str:
    return f"({x} is null or regexp_full_match({x}, '{_WS}*'))"


def not_blank(x: str) -> str:
    return f"({x} is not null and not regexp_full_match({x}, '{_WS}*'))"


FUNNEL_MEASURES = ["ysrequest", "yxrequest", "adrequest", "cyrequest", "cybidsuccess",
                   "shows", "clicks", "dspcost", "dspapy"]


def _cnt(cond: str) -> str:
    return f"cast(sum(case when {cond} then 1 else 0 end) as bigint)"


def _money(cond: str, col: str) -> str:
    return (f"cast(sum(case when {cond} then cast(round({col} * 100) as bigint) else 0 end) "
            f"as double) / 100000.0")


def funnel_sql(mode: str) -> list[str]:
    eb = "coalesce(iseffective,0) = 1 and coalesce(isbilling,0) = 1"
    rm, node = "coalesce(requestmode,0)", "coalesce(processnode,0)"
    if mode == "cumulative":
        ys, yx = f"{rm} = 1 and {node} >= 1", f"{rm} = 1 and {node} >= 2"
        succ = f"{eb} and coalesce(iswin,0) = 1 and coalesce(adorderid,0) <> 0"
        paid = f"{eb} and coalesce(iswin,0) = 1"
    else:
        ys, yx = f"{rm} = 1 and {node} in (1, 2, 3)", f"{rm} = 1 and {node} in (2, 3)"
        succ = (f"{eb} and coalesce(isbid,0) <> 1 and coalesce(iswin,0) = 1 "
                f"and coalesce(adorderid,0) <> 0")
        paid = succ
    exprs = [
        _cnt(ys), _cnt(yx), _cnt(f"{rm} = 1 and {node} = 3"),
        _cnt(f"{eb} and coalesce(isbid,0) = 1"), _cnt(succ),
        _cnt(f"{rm} = 2 and coalesce(iseffective,0) = 1"),
        _cnt(f"{rm} = 3 and coalesce(iseffective,0) = 1"),
        _money(paid, "winprice"), _money(paid, "adpayment"),
    ]
    return [f"{e} as {n}" for e, n in zip(exprs, FUNNEL_MEASURES)]


def _dictionary_sql(strict: bool) -> str:
    arity = ("len(string_split(regexp_replace(value, '\\t+$', ''), chr(9)))" if strict
             else "len(string_split(value, chr(9)))")
    return (f"select key, min(val) as value from (select string_split(value, chr(9))[5] as key, "
            f"string_split(value, chr(9))[2] as val from {_b('app_dictionary_lines')} "
            f"where {arity} >= 5) d group by key")


ORACLES["row_counts_by_location"] = (
    f"select provincename, cityname, count(*) as cts from {_b('ad_log')} l "
    f"group by provincename, cityname"
)

for _mode in ("cumulative", "exclusive"):
    ORACLES[f"funnel_location_{_mode}"] = (
        "select provincename, cityname, " + ", ".join(funnel_sql(_mode))
        + f" from {_b('ad_log')} l group by provincename, cityname"
    )


def _app_funnel(default_sql: str) -> str:
    name = (f"case when {blank('l.appname')} then coalesce(d.value, {default_sql}) "
            f"else l.appname end")
    return (
        f"select appname, " + ", ".join(funnel_sql("exclusive"))
        + f" from (select {name} as appname, requestmode, processnode, iseffective, isbilling, "
        f"isbid, iswin, adorderid, winprice, adpayment from {_b('ad_log')} l "
        f"left join ({_dictionary_sql(False)}) d on l.appid = d.key) x group by appname"
    )


ORACLES["funnel_location_sql"] = ORACLES["funnel_location_cumulative"]
ORACLES["funnel_app_unknown_default"] = _app_funnel("'unknow'")
ORACLES["funnel_app_key_default"] = _app_funnel("l.appid")
ORACLES["funnel_app_null_default"] = _app_funnel("null")
ORACLES["app_dictionary"] = _dictionary_sql(False)
ORACLES["app_dictionary_strict"] = _dictionary_sql(True)


# --- shared SQL fragments ----------------------------------------------------------

# Column, prefix as first id, prefix among all ids.
IDS = [
    ("imei", "IM", "IM:"), ("mac", "MC", "MC:"), ("idfa", "ID", "ID:"), ("openudid", "OD", "OD:"),
    ("androidid", "AOD", "AOD:"), ("imeimd5", "MD5IM", "IMM:"), ("macmd5", "MD5MC", "MCM:"),
    ("idfamd5", "MD5ID", "IDM:"), ("openudidmd5", "MD5OD", "ODM:"), ("androididmd5", "MD5AOD", "AODM:"),
    ("imeisha1", "SHIM", "IMS:"), ("macsha1", "SHMC", "MCS:"), ("idfasha1", "SHID", "IDS:"),
    ("openudidsha1", "SHOD", "ODS:"), ("androididsha1", "SHAOD", "AODS:"),
]
# As first id, idfamd5 comes after the other md5 ids.
FIRST_ORDER = ["imei", "mac", "idfa", "openudid", "androidid", "imeimd5", "macmd5", "openudidmd5",
               "androididmd5", "idfamd5", "imeisha1", "macsha1", "idfasha1", "openudidsha1", "androididsha1"]
OS_CODES, OS_OTHER = {1: "D00010001", 2: "D00010002", 3: "D00010003"}, "D00010004"
NETWORK_CODES = {"WIFI": "D00020001", "4G": "D00020002", "3G": "D00020003", "2G": "D00020004"}
NETWORK_OTHER = "D00020005"
CARRIER_CODES = {"移动": "D00030001", "联通": "D00030002", "电信": "D00030003"}
CARRIER_OTHER = "D00030004"
BUSINESS_BBOX = (73.66, 135.05, 3.86, 53.55)
COARSE_BBOX = (73.0, 136.0, 3.0, 54.0)
GEOHASH_BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"
FUNNEL_LEGACY_ORDER = ["ysrequest", "yxrequest", "adrequest", "cyrequest", "cybidsuccess",
                       "dspcost", "dspapy", "shows", "clicks"]

AL = _b("ad_log")
STOPWORDS_SQL = "('cold', 'bolt')"
HAS_ANY_ID = "(" + " or ".join(f"{c} <> ''" for c, _, _ in IDS) + ")"
FIRST_ID = "coalesce(" + ", ".join(
    f"case when {not_blank(c)} then '{p}' || {c} end"
    for c, p, _ in sorted(IDS, key=lambda i: FIRST_ORDER.index(i[0]))) + ")"
ID_LIST = "list_filter([" + ", ".join(
    f"case when {not_blank(c)} then '{p}' || {c} end" for c, _, p in IDS) + "], lambda x: x is not null)"


def in_bbox_sql(box, lng="long", lat="lat") -> str:
    a, b, c, d = box
    return (f"coalesce(try_cast({lng} as double) between {a} and {b} "
            f"and try_cast({lat} as double) between {c} and {d}, false)")


def _case(col, codes, other, quote=True):
    arms = " ".join(
        f"when {(repr(k) if quote else k)} then '{v}'" for k, v in codes.items())
    return f"case {col} {arms} else '{other}' end"


AD_TAGS = ("[case when adspacetype > 9 then 'LC' || cast(adspacetype as varchar) "
           "when adspacetype > 0 then 'LC0' || cast(adspacetype as varchar) end, "
           f"case when {not_blank('adspacetypename')} then 'LN' || adspacetypename end, "
           "'CN' || cast(coalesce(adplatformproviderid, 0) as varchar)]")
DEVICE_TAGS = ("[" + _case("coalesce(client, 0)", OS_CODES, OS_OTHER, quote=False) + ", "
               + _case("networkmannername", NETWORK_CODES, NETWORK_OTHER) + ", "
               + _case("ispname", CARRIER_CODES, CARRIER_OTHER) + "]")
LOCATION_TAGS = (f"[case when {not_blank('provincename')} then 'ZP' || provincename end, "
                 f"case when {not_blank('cityname')} then 'ZC' || cityname end]")
APP_TAGS = (f"[case when {not_blank('appname')} then 'APP' || appname "
            f"when {not_blank('appid')} then 'APP' || coalesce(dict_value, appid) end]")


def _with_dict(src: str) -> str:
    return (f"(select s.*, d.value as dict_value from {src} s left join "
            f"({_dictionary_sql(False)}) d on s.appid = d.key)")


def _tag_rows(src: str, key: str, lists=(AD_TAGS, LOCATION_TAGS, DEVICE_TAGS, APP_TAGS),
              keywords: bool = True, stop: str = STOPWORDS_SQL) -> str:
    """Long-form tag occurrences ``(key, tag)`` of the rows of ``src``."""
    parts = []
    for lst in lists:
        s = _with_dict(src) if lst is APP_TAGS else src
        parts.append(f"select {key}, unnest(list_filter({lst}, lambda x: x is not null)) as tag from {s} t")
    if keywords:
        parts.append(
            f"select {key}, 'K' || w as tag from (select {key}, "
            f"unnest(string_split(coalesce(keywords, ''), '|')) as w from {src} t) k "
            f"where length(w) between 3 and 8 and w not in {stop}")
    return " union all ".join(parts)


def _counted(inner: str, key: str) -> str:
    return (f"select {key}, tag, count(*) as weight from ({inner}) x "
            f"group by {key}, tag")


# --- ETL -----------------------------------------------------------------------------

_INT_SQL = "case when regexp_full_match({f}, '[+-]?[0-9]+') then coalesce(try_cast({f} as integer), 0) else 0 end"
_DBL_SQL = ("case when regexp_full_match({f}, '(?i)\\s*[+-]?(inf|infinity|nan)\\s*') "
            "and not regexp_full_match({f}, '\\s*([+-]?Infinity|NaN)\\s*') then 0.0 "
            "else coalesce(try_cast(trim({f}) as double), 0.0) end")


def _parse_cols() -> str:
    cols = []
    for i, (name, kind) in enumerate(LOG_FIELDS):
        f = f"fs[{i + 1}]"
        if kind == "int":
            e = _INT_SQL.format(f=f)
        elif kind == "double":
            e = _DBL_SQL.format(f=f)
        else:
            e = f
        cols.append(f"cast({e} as {kind}) as {name}")
    return ", ".join(cols)


ORACLES["etl_parse_log"] = (
    f"select {_parse_cols()} from (select string_split(value, ',') as fs "
    f"from {_b('raw_log_lines')} r) x where len(fs) >= 85"
)
ORACLES["etl_rejects"] = (
    f"select split_part(value, ',', 1) as sessionid, cast(len(string_split(value, ',')) as int) "
    f"as n_fields from {_b('raw_log_lines')} r where len(string_split(value, ',')) < 85"
)
ORACLES["report_lines_text"] = (
    "select concat_ws(',', coalesce(provincename, 'null'), coalesce(cityname, 'null'), "
    + ", ".join(f"cast(cast({m} as double) as varchar)" for m in FUNNEL_LEGACY_ORDER)
    + ") as value from (" + ORACLES["funnel_location_cumulative"] + ") f"
)

# --- identity ------------------------------------------------------------------------

ORACLES["has_any_id"] = f"select sessionid from {AL} l where {HAS_ANY_ID}"
ORACLES["has_any_id_in_bbox"] = (
    f"select sessionid from {AL} l where {in_bbox_sql(COARSE_BBOX)} and {HAS_ANY_ID}")
ORACLES["first_id"] = f"select sessionid, {FIRST_ID} as user_id from {AL} l where {HAS_ANY_ID}"
ORACLES["all_ids"] = (
    f"select sessionid, array_to_string({ID_LIST}, ',') as ids from {AL} l where {HAS_ANY_ID}")

# --- tags ----------------------------------------------------------------------------

ORACLES["tags_ad"] = _counted(_tag_rows(AL, "sessionid", (AD_TAGS,), False), "sessionid")
ORACLES["tags_device"] = _counted(_tag_rows(AL, "sessionid", (DEVICE_TAGS,), False), "sessionid")
ORACLES["tags_location"] = _counted(_tag_rows(AL, "sessionid", (LOCATION_TAGS,), False), "sessionid")
ORACLES["tags_app"] = _counted(_tag_rows(AL, "sessionid", (APP_TAGS,), False), "sessionid")
ORACLES["tags_keyword"] = _counted(_tag_rows(AL, "sessionid", (), True), "sessionid")

_USERS = f"(select *, {FIRST_ID} as user_id from {AL} l where {HAS_ANY_ID})"
_USERS = f"(select * from {_USERS} u where user_id is not null)"
ORACLES["user_tags"] = _counted(_tag_rows(_USERS, "user_id"), "user_id")
ORACLES["user_tag_lines"] = (
    "select user_id || ',' || string_agg(tag || ':' || cast(weight as varchar), ',' order by tag) "
    f"as value from ({ORACLES['user_tags']}) p group by user_id"
)

# --- identity graph --------------------------------------------------------------------

_ID_ROWS = (f"(select * from (select *, {ID_LIST} as ids from {AL} l where {HAS_ANY_ID}) r "
            f"where len(ids) > 0)")
_ID_ROWS = f"(select *, ids[1] as head from {_ID_ROWS} h)"
ORACLES["id_edges"] = f"select distinct ids[1] as src, unnest(ids) as dst from {_ID_ROWS} r"

_CC_CTE = (
    f"with recursive edges as ({ORACLES['id_edges']}), "
    "e as (select src as a, dst as b from edges union select dst as a, src as b from edges), "
    "r(id, c) as (select a, a from e union select e.b, r.c from r join e on r.id = e.a), "
    "labels as (select id, min(c) as component from r group by id) "
)
ORACLES["connected_components"] = _CC_CTE + "select id, component from labels"
ORACLES["component_members"] = _CC_CTE + "select component, id as member from labels"
ORACLES["component_sizes"] = _CC_CTE + "select component, count(*) as n_members from labels group by component"
ORACLES["person_profiles"] = (
    _CC_CTE
    + f", tagged as ({_tag_rows(_ID_ROWS, 'head')}) "
    + "select l.component, t.tag as entry, count(*) as weight "
    + "from tagged t join labels l on t.head = l.id group by l.component, t.tag "
    + "union all select component, id as entry, 0 as weight from labels"
)

# --- geo ---------------------------------------------------------------------------------

_SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
           (2, 0x3333333333333333), (1, 0x5555555555555555)]


def geohash_sql(lng: str, lat: str, precision: int = 8) -> str:
    nbits = 5 * precision
    nx, ny = (nbits + 1) // 2, nbits // 2

    def cell(v, lo, span, bits):
        n = 1 << bits
        return (f"least(greatest(cast(floor(({v} - ({lo})) / {span} * {float(n)}) as bigint), 0), "
                f"{n - 1})")

    def spread(v):
        for s, m in _SPREAD:
            v = f"((({v}) << {s}) | ({v})) & {m}"
        return v

    x = spread(cell(f"try_cast({lng} as double)", -180.0, 360.0, nx))
    y = spread(cell(f"try_cast({lat} as double)", -90.0, 180.0, ny))
    code = f"((({x}) << 1) | ({y}))" if nbits % 2 == 0 else f"(({x}) | (({y}) << 1))"
    chars = [f"substr('{GEOHASH_BASE32}', cast(((gh_code >> {nbits - 5 * (k + 1)}) & 31) as integer) + 1, 1)"
             for k in range(precision)]
    return f"(select {' || '.join(chars)} from (select {code} as gh_code))"


_GEO = _b("geo_points")
ORACLES["bbox_points"] = f"select distinct long, lat from {_GEO} g where {in_bbox_sql(BUSINESS_BBOX)}"
ORACLES["geohash8"] = (
    f"select c_custkey, {geohash_sql('long', 'lat')} as geohash from {_GEO} g "
    f"where {in_bbox_sql(BUSINESS_BBOX)}")

_POIS = "json_extract_string(b, '$.result.pois[*].tag')"
_BIZ = "json_extract_string(b, '$.result.business')"
_PARSE = (
    "case when b is null or not json_valid(b) then null "
    "when json_extract(b, '$.status') is null then null "
    "when try_cast(json_extract_string(b, '$.status') as integer) = 0 then "
    f"case when {_BIZ} is null then null when {_BIZ} = '' then array_to_string(list_filter({_POIS}, "
    f"lambda x, i: x is not null and x <> '' and list_position({_POIS}, x) = i), ';') "
    f"else replace({_BIZ}, ',', ';') end "
    "else '' end"
)
ORACLES["parse_responses"] = (
    f"select long, lat, {_PARSE} as business from (select long, lat, case when "
    "starts_with(response, '{') then replace(response, 'renderReverse&&renderReverse(', '') "
    "else substr(replace(response, 'renderReverse&&renderReverse(', ''), 1, "
    "length(replace(response, 'renderReverse&&renderReverse(', '')) - 1) end as b "
    f"from {_b('geo_responses')} r) x"
)
ORACLES["business_lookup"] = (
    f"select geohash, min(business) as business from (select {geohash_sql('p.long', 'p.lat')} "
    f"as geohash, r.business from ({ORACLES['bbox_points']}) p join ({ORACLES['parse_responses']}) r "
    f"on p.long = r.long and p.lat = r.lat where {not_blank('r.business')}) k group by geohash"
)
ORACLES["tags_business"] = (
    "select sessionid, tag, count(*) as weight from (select sessionid, "
    "unnest(string_split(k.business, ';')) as tag from (select sessionid, "
    f"{geohash_sql('long', 'lat')} as geohash from {AL} l where {in_bbox_sql(BUSINESS_BBOX)}) a "
    f"join ({ORACLES['business_lookup']}) k on a.geohash = k.geohash) t where tag <> '' "
    "group by sessionid, tag"
)

# --- raw-text app funnel and tags with business areas ---------------------------------

_PARSED = f"({ORACLES['etl_parse_log']})"
ORACLES["funnel_app_from_text"] = (
    "select appname, " + ", ".join(funnel_sql("exclusive"))
    + f" from (select case when {blank('l.appname')} then d.value else l.appname end as appname, "
    "requestmode, processnode, iseffective, isbilling, isbid, iswin, adorderid, winprice, "
    f"adpayment from {_PARSED} l left join ({_dictionary_sql(True)}) d on l.appid = d.key) x "
    "group by appname"
)

_BIZ_TAGS = (
    f"select u.user_id, unnest(string_split(k.business, ';')) as tag from (select user_id, "
    f"{geohash_sql('long', 'lat')} as geohash from {_USERS} u0 where {in_bbox_sql(BUSINESS_BBOX)}) u "
    f"join ({ORACLES['business_lookup']}) k on u.geohash = k.geohash"
)
ORACLES["user_tags_with_business"] = _counted(
    _tag_rows(_USERS, "user_id") + f" union all select * from ({_BIZ_TAGS}) b where tag <> ''",
    "user_id")

# --- every id column, hot ids, member attributes ---------------------------------------

_IL = _b("id_log")
ORACLES["first_id_every_column"] = f"select o_orderkey, {FIRST_ID} as user_id from {_IL} l where {HAS_ANY_ID}"
ORACLES["all_ids_every_column"] = (
    f"select o_orderkey, array_to_string({ID_LIST}, ',') as ids from {_IL} l where {HAS_ANY_ID}")
# all ids of a customer that some row of theirs ties together; ids of several
# customers never meet, so the closure stays small
ORACLES["components_every_column"] = ORACLES["connected_components"].replace(AL, _IL)
# known from the binding: the hub's ids, the chain's ids, and single ids
ORACLES["components_hub_and_chain"] = (
    f"with e as (select * from {_b('hub_chain_edges')} x), v as (select src as id from e union select dst from e) "
    "select id, min(id) over (partition by case when id[1] = 's' then id else id[1] end) as component from v"
)
ORACLES["component_attributes"] = (
    _CC_CTE + "select component, id as member, c_name, c_mktsegment from labels "
    "left join customer on id = 'IM:' || cast(c_custkey as varchar)"
)

# --- jobs: the same rows as the plans they write ------------------------------------------

ORACLES["job_etl_plain"] = ORACLES["etl_parse_log"]
ORACLES["job_etl_partitioned"] = ORACLES["etl_parse_log"]
ORACLES["job_location_report_json"] = ORACLES["funnel_location_cumulative"]
ORACLES["job_app_dictionary"] = ORACLES["app_dictionary_strict"]
_STOP = f"(select value from {_b('stopword_lines')} s)"
ORACLES["job_user_tags"] = (
    "select *, '2024-05-01' as day from (" + _counted(_tag_rows(_USERS, "user_id", stop=_STOP), "user_id") + ") p"
)
ORACLES["job_etl_rejects"] = ORACLES["etl_rejects"]

# --- keyed lookups ---------------------------------------------------------------------------

ORACLES["app_dictionary_last_wins"] = (
    "select string_split(value, chr(9))[5] as key, arg_max(string_split(value, chr(9))[2], (file, pos)) as value "
    f"from {_b('repeated_dictionary_lines')} d group by 1"
)
ORACLES["keyed_upsert"] = (
    "select key, value from (select *, row_number() over (partition by key order by batch desc) as r "
    f"from {_b('keyed_batches')} b) k where r = 1"
)
ORACLES["keyed_points"] = (
    f"select * from ({ORACLES['keyed_upsert']}) u where key in (select cast(s_suppkey as varchar) from supplier)"
)


def _lookup_of(points: str) -> str:
    """geohash -> smallest business of the responses captured for ``points``."""
    parsed = ORACLES["parse_responses"].replace(_b("geo_responses"), _b("place_responses"))
    return (
        f"select geohash, min(business) as business from (select {geohash_sql('p.long', 'p.lat')} as geohash, "
        f"r.business from (select distinct long, lat from {points} g where {in_bbox_sql(BUSINESS_BBOX)}) p "
        f"join ({parsed}) r on p.long = r.long and p.lat = r.lat where {not_blank('r.business')}) k group by geohash"
    )


# a place not stored before is asked for at its geohash's smallest coordinates
_ASKED = (
    f"(select min({{'long': long, 'lat': lat}}) as place from {_GEO} g where {in_bbox_sql(BUSINESS_BBOX)} "
    f"group by {geohash_sql('long', 'lat')})"
)
ORACLES["resolve_new_places"] = (
    f"with stored as ({_lookup_of(_b('old_places'))}), asked as (select place.long as long, place.lat as lat from {_ASKED} a) "
    f"select * from stored union all select n.* from ({_lookup_of('asked')}) n "
    "where geohash not in (select geohash from stored)"
)

# --- hot keys ----------------------------------------------------------------------------------

_HOT = _b("hot_log")
ORACLES["lookup_hot_app"] = (
    f"select tag, count(*) as weight from ({_tag_rows(_HOT, 'sessionid', (APP_TAGS,), False)}) x group by tag")
ORACLES["lookup_hot_word"] = (
    f"select substr(tag, 2) as word, count(*) as weight from ({_tag_rows(_HOT, 'sessionid', (), True)}) x group by tag")
ORACLES["lookup_hot_place"] = (
    f"select tag, count(*) as weight from (select unnest(string_split(k.business, ';')) as tag from (select "
    f"{geohash_sql('long', 'lat')} as geohash from {_HOT} l where {in_bbox_sql(BUSINESS_BBOX)}) a "
    f"join ({ORACLES['business_lookup']}) k on a.geohash = k.geohash) t where tag <> '' group by tag"
)

# --- days ----------------------------------------------------------------------------------------

_DATED = f"(select *, {FIRST_ID} as user_id from {_b('dated_log')} l where {HAS_ANY_ID})"
_DATED = _counted(_tag_rows(f"(select * from {_DATED} u where user_id is not null)", "user_id, day"), "user_id, day")
ORACLES["profile_days_map"] = (
    "select user_id, cast(count(*) over (partition by user_id) as int) as n_days, day, tags from (select user_id, day, "
    f"string_agg(tag || ':' || cast(weight as varchar), ',' order by tag) as tags from ({_DATED}) d "
    "group by user_id, day) x"
)
ORACLES["profile_days_merged"] = (
    f"select user_id, tag, cast(sum(weight) as bigint) as weight from ({_DATED}) d "
    "where day between '2024-05-02' and '2024-05-03' group by user_id, tag"
)
ORACLES["components_next_day"] = ORACLES["connected_components"]
ORACLES["person_profiles_bucketed"] = ORACLES["person_profiles"]
