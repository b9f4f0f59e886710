"""Geo enrichment: bounding box, reverse-geocode response parsing, the
geohash -> business-area lookup and business-area tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlumen.functions.geohash import geohash, with_geohash
from adlumen.functions.strings import is_blank
from adlumen.functions.util import as_col
from adlumen.operators.lookup import DEFAULT_BROADCAST_ROWS, lookup_join
from adlumen.schema import BUSINESS_BBOX, JSONP_PREFIX

RESPONSE_SCHEMA = T.StructType([
    T.StructField("status", T.IntegerType()),
    T.StructField("result", T.StructType([
        T.StructField("business", T.StringType()),
        T.StructField("pois", T.ArrayType(T.StructType([T.StructField("tag", T.StringType())]))),
    ])),
])


def in_bbox(lng="long", lat="lat", box=BUSINESS_BBOX) -> Column:
    """Inclusive box test on string coordinates; unparsable -> false."""
    lng_lo, lng_hi, lat_lo, lat_hi = box
    x, y = as_col(lng).try_cast("double"), as_col(lat).try_cast("double")
    inside = x.between(lng_lo, lng_hi) & y.between(lat_lo, lat_hi)
    return F.coalesce(inside, F.lit(False))


def point_geohash(lng="long", lat="lat", precision: int = 8) -> Column:
    return geohash(as_col(lat).try_cast("double"), as_col(lng).try_cast("double"), precision)


def add_geohash(df: DataFrame, lng: str = "long", lat: str = "lat", out: str = "geohash",
                precision: int = 8) -> DataFrame:
    """``df`` with the geohash of its string coordinates (unparsable: null)."""
    return with_geohash(df, F.col(lat).try_cast("double"), F.col(lng).try_cast("double"), out, precision)


def parse_business(response) -> Column:
    """Reverse-geocode response text -> business areas joined by ``;``.

    Strips an optional JSONP wrapper, parses the JSON; for status 0 takes
    ``result.business`` with ``,`` -> ``;``, or, when that is empty, the
    distinct non-empty POI tags in order of appearance.  Other status -> ''.
    Malformed text or a missing field -> null.
    """
    r = as_col(response)
    body = F.replace(r, F.lit(JSONP_PREFIX), F.lit(""))
    # a wrapped response also loses its closing ")"
    body = F.when(r.startswith("{"), body).otherwise(body.substr(F.lit(1), F.length(body) - 1))
    doc = F.from_json(body, RESPONSE_SCHEMA)
    business = F.regexp_replace(doc["result"]["business"], ",", ";")
    tags = F.filter(doc["result"]["pois"]["tag"], lambda t: t.isNotNull() & (t != ""))
    from_pois = F.array_join(F.array_distinct(tags), ";")
    ok = F.when(business == "", from_pois).otherwise(business)
    return (F.when(doc.isNull() | doc["status"].isNull(), F.lit(None).cast("string"))
             .when(doc["status"] == 0, ok)
             .otherwise(F.lit("")))


def in_box_points(df: DataFrame, lng: str = "long", lat: str = "lat",
                  box=BUSINESS_BBOX) -> DataFrame:
    """Distinct (long, lat) string pairs inside the box."""
    return df.select(lng, lat).where(in_bbox(lng, lat, box)).dropDuplicates([lng, lat])


def build_business_lookup(points: DataFrame, responses: DataFrame, *, lng: str = "long",
                          lat: str = "lat", response: str = "response",
                          precision: int = 8) -> DataFrame:
    """``(geohash, business)``, one row per geohash, from captured responses.

    In-box distinct points are joined with the responses captured for them
    (instead of one remote call per point), parsed, blank results dropped;
    when several points share a geohash the smallest business string wins.
    """
    pts = in_box_points(points, lng, lat)
    resp = responses.select(F.col(lng).alias("__lng"), F.col(lat).alias("__lat"),
                            parse_business(F.col(response)).alias("business"))
    joined = pts.join(resp, (pts[lng] == resp["__lng"]) & (pts[lat] == resp["__lat"]))
    keyed = add_geohash(joined.where(~is_blank(F.col("business"))).select(pts[lng], pts[lat], "business"),
                        lng, lat, "geohash", precision).select("geohash", "business")
    return keyed.groupBy("geohash").agg(F.min("business").alias("business"))


def _boxed_geohash(df: DataFrame, lng: str, lat: str, precision: int, out: str) -> DataFrame:
    """``df`` with the geohash of in-box coordinates; elsewhere null, and nothing is computed."""
    inside = df.withColumns({"__lng": F.when(in_bbox(lng, lat), F.col(lng)),
                             "__lat": F.when(in_bbox(lng, lat), F.col(lat))})
    return add_geohash(inside, "__lng", "__lat", out, precision).drop("__lng", "__lat")


def with_business(df: DataFrame, lookup: DataFrame, *, lng: str = "long", lat: str = "lat",
                  precision: int = 8, out: str = "__business",
                  broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Add ``out``: the business areas (``;``-joined) of an in-box row's geohash, else null."""
    side = lookup.select(F.col("geohash").alias("__lgh"), F.col("business").alias(out))
    keyed = _boxed_geohash(df, lng, lat, precision, "__gh")
    return lookup_join(keyed, side, "__gh", "__lgh", broadcast_rows=broadcast_rows).drop("__gh", "__lgh")


def business_tag_words(df: DataFrame, lookup: DataFrame, *, lng: str = "long", lat: str = "lat",
                       keep: tuple[str, ...] = (), precision: int = 8,
                       broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Rows in the box -> geohash -> lookup -> one row per ``;``-piece (``tag``).

    Empty pieces are dropped; repeated pieces stay (each adds weight).
    """
    pts = df.select(*keep, lng, lat).where(in_bbox(lng, lat))
    pts = add_geohash(pts, lng, lat, "__gh", precision).select(*keep, "__gh")
    joined = lookup_join(pts, lookup.select("geohash", "business"), "__gh", "geohash", "inner",
                         broadcast_rows=broadcast_rows)
    words = joined.select(*keep, F.explode(F.split(F.col("business"), ";")).alias("tag"))
    return words.where(F.col("tag") != "")
