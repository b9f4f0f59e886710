"""Registered queries: (spark, sf_dir) -> DataFrame, over whole tables.

Each query reads the shared tables through a binding (``sources.bindings``)
and applies one library operator; ``plans.oracle`` holds the independent
DuckDB SQL for the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlumen.operators import geo as GEO
from adlumen.operators import graph as G
from adlumen.operators import identity as I
from adlumen.operators import tags as TG
from adlumen.operators.lookup import drop_stopwords
from adlumen.plans import jobs
from adlumen.plans import profiles as P
from adlumen.plans import reports
from adlumen.schema import ID_COLUMNS
from adlumen.session import materialize, scratch_path, shuffles_freed
from adlumen.operators.resolve import CapturedResolver
from adlumen.sinks import keyed
from adlumen.sinks.writers import format_report_lines, format_tag_lines, write_log, write_profiles
from adlumen.sources import bindings as B
from adlumen.sources.dictionary import parse_app_dictionary, read_app_dictionary
from adlumen.sources.logs import parse_log, read_log, read_profiles, read_rejects

# Money is compared exactly across engines: prices are 2-decimal values, so
# sum them as exact cents (order-independent) and divide once at the end.
MONEY_SCALE = 2

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _dictionary(spark, sf_dir, strict=False):
    return parse_app_dictionary(B.app_dictionary_lines(spark, sf_dir), strict=strict)


@query
def row_counts_by_location(spark, sf_dir):
    return reports.row_counts(B.ad_log(spark, sf_dir))


@query
def funnel_location_cumulative(spark, sf_dir):
    return reports.location_report(B.ad_log(spark, sf_dir), "cumulative", money_scale=MONEY_SCALE)


@query
def funnel_location_exclusive(spark, sf_dir):
    return reports.location_report(B.ad_log(spark, sf_dir), "exclusive", money_scale=MONEY_SCALE)


@query
def funnel_app_unknown_default(spark, sf_dir):
    return reports.app_report(B.ad_log(spark, sf_dir), _dictionary(spark, sf_dir),
                              default="unknow", money_scale=MONEY_SCALE)


@query
def funnel_app_key_default(spark, sf_dir):
    return reports.app_report(B.ad_log(spark, sf_dir), _dictionary(spark, sf_dir),
                              default=F.col("appid"), money_scale=MONEY_SCALE)


@query
def funnel_app_null_default(spark, sf_dir):
    return reports.app_report(B.ad_log(spark, sf_dir), _dictionary(spark, sf_dir),
                              default=None, money_scale=MONEY_SCALE)


@query
def funnel_location_sql(spark, sf_dir):
    """The cumulative funnel as SQL text over a temp view."""
    return reports.location_report_sql(spark, B.ad_log(spark, sf_dir),
                                       money_scale=MONEY_SCALE)


@query
def funnel_app_from_text(spark, sf_dir):
    """App funnel straight from raw log lines; unknown ids stay null."""
    log, _ = parse_log(B.raw_log_lines(spark, sf_dir))
    return reports.app_report(log, _dictionary(spark, sf_dir, strict=True), default=None,
                              money_scale=MONEY_SCALE)


@query
def app_dictionary(spark, sf_dir):
    return _dictionary(spark, sf_dir, strict=False)


@query
def app_dictionary_strict(spark, sf_dir):
    return _dictionary(spark, sf_dir, strict=True)


# --- ETL: raw text lines -> typed log ------------------------------------------------

@query
def etl_parse_log(spark, sf_dir):
    good, _ = parse_log(B.raw_log_lines(spark, sf_dir))
    return good


@query
def etl_rejects(spark, sf_dir):
    _, rejected = parse_log(B.raw_log_lines(spark, sf_dir))
    return rejected.select(F.substring_index("line", ",", 1).alias("sessionid"), "n_fields")


@query
def report_lines_text(spark, sf_dir):
    rep = reports.location_report(B.ad_log(spark, sf_dir), "cumulative", money_scale=MONEY_SCALE)
    return format_report_lines(rep, ["provincename", "cityname"], legacy=True)


# --- identity ----------------------------------------------------------------------

@query
def has_any_id(spark, sf_dir):
    return B.ad_log(spark, sf_dir).where(I.has_any_id()).select("sessionid")


@query
def has_any_id_in_bbox(spark, sf_dir):
    return B.ad_log(spark, sf_dir).where(I.has_any_id_in_bbox()).select("sessionid")


@query
def first_id(spark, sf_dir):
    log = B.ad_log(spark, sf_dir)
    return log.where(I.has_any_id()).select("sessionid", I.first_id().alias("user_id"))


@query
def all_ids(spark, sf_dir):
    log = B.ad_log(spark, sf_dir)
    return log.where(I.has_any_id()).select("sessionid", F.array_join(I.all_ids(), ",").alias("ids"))


# --- tags per row (long form: one row per (row, tag) with its weight) ---------------

def _row_tag_counts(df, tag_col):
    return (df.select("sessionid", F.explode(tag_col).alias("tag"))
              .groupBy("sessionid", "tag").agg(F.count(F.lit(1)).alias("weight")))


@query
def tags_ad(spark, sf_dir):
    return _row_tag_counts(B.ad_log(spark, sf_dir), TG.ad_tags())


@query
def tags_device(spark, sf_dir):
    return _row_tag_counts(B.ad_log(spark, sf_dir), TG.device_tags())


@query
def tags_location(spark, sf_dir):
    return _row_tag_counts(B.ad_log(spark, sf_dir), TG.location_tags())


@query
def tags_app(spark, sf_dir):
    log = TG.with_app_lookup(B.ad_log(spark, sf_dir), _dictionary(spark, sf_dir))
    return _row_tag_counts(log, TG.app_tags(dict_name="__dict_app"))


@query
def tags_keyword(spark, sf_dir):
    log = B.ad_log(spark, sf_dir)
    words = log.select("sessionid", F.explode(TG.keyword_candidates()).alias("word"))
    words = words.where(TG.keyword_ok(F.col("word")))
    kept = drop_stopwords(words, B.stopwords(spark), word="word")
    tags = kept.select("sessionid", F.concat(F.lit("K"), F.col("word")).alias("tag"))
    return tags.groupBy("sessionid", "tag").agg(F.count(F.lit(1)).alias("weight"))


def _tag_log(spark, sf_dir, log=None, more=()):
    """The log's ids and tag sources as a written table, as real logs are: tags read it
    several times, and the shuffles that bind it are gone before they make their own."""
    log = B.ad_log(spark, sf_dir) if log is None else log
    return materialize(log.select(*ID_COLUMNS, *P.TAG_SOURCES, *more), "tag-log")[0]


@query
def user_tags(spark, sf_dir):
    return P.user_tags(_tag_log(spark, sf_dir), dictionary=_dictionary(spark, sf_dir),
                       stopwords=B.stopwords(spark))


@query
def user_tags_with_business(spark, sf_dir):
    return P.user_tags(_tag_log(spark, sf_dir), dictionary=_dictionary(spark, sf_dir),
                       stopwords=B.stopwords(spark),
                       business_lookup=business_lookup(spark, sf_dir))


@query
def user_tag_lines(spark, sf_dir):
    merged = user_tags(spark, sf_dir)
    return format_tag_lines(TG.collect_profiles(merged, "user_id"), user="user_id")


# --- identity graph ----------------------------------------------------------------

@query
def id_edges(spark, sf_dir):
    return P.id_edge_list(B.ad_log(spark, sf_dir))


@query
def connected_components(spark, sf_dir):
    return G.connected_components(id_edges(spark, sf_dir))


@query
def component_members(spark, sf_dir):
    return G.component_members(connected_components(spark, sf_dir))


@query
def component_sizes(spark, sf_dir):
    return G.component_sizes(connected_components(spark, sf_dir))


@query
def person_profiles(spark, sf_dir):
    return P.person_profiles(_tag_log(spark, sf_dir), dictionary=_dictionary(spark, sf_dir),
                             stopwords=B.stopwords(spark))


# --- geo -----------------------------------------------------------------------------

@query
def bbox_points(spark, sf_dir):
    return GEO.in_box_points(B.geo_points(spark, sf_dir))


@query
def geohash8(spark, sf_dir):
    pts = B.geo_points(spark, sf_dir).where(GEO.in_bbox())
    return GEO.add_geohash(pts).select("c_custkey", "geohash")


@query
def parse_responses(spark, sf_dir):
    r = B.geo_responses(spark, sf_dir)
    return r.select("long", "lat", GEO.parse_business("response").alias("business"))


@query
def business_lookup(spark, sf_dir):
    return GEO.build_business_lookup(B.geo_points(spark, sf_dir), B.geo_responses(spark, sf_dir))


@query
def tags_business(spark, sf_dir):
    lookup = business_lookup(spark, sf_dir)
    words = GEO.business_tag_words(B.ad_log(spark, sf_dir), lookup, keep=("sessionid",))
    return words.groupBy("sessionid", "tag").agg(F.count(F.lit(1)).alias("weight"))


# --- every id column, hot ids, member attributes ---------------------------------------

def _id_log(spark, sf_dir):
    """The id log as a written table, as real logs are."""
    return materialize(B.binding(spark, sf_dir, "id_log"), "id-log")[0]


@query
def first_id_every_column(spark, sf_dir):
    rows = _id_log(spark, sf_dir).where(I.has_any_id())
    return rows.select("o_orderkey", I.first_id().alias("user_id"))


@query
def all_ids_every_column(spark, sf_dir):
    rows = _id_log(spark, sf_dir).where(I.has_any_id())
    return rows.select("o_orderkey", F.array_join(I.all_ids(), ",").alias("ids"))


@query
def components_every_column(spark, sf_dir):
    return P.person_graph(_id_log(spark, sf_dir))


@query
def components_hub_and_chain(spark, sf_dir):
    """A hub with a third of all ids and a chain of another third; a low
    threshold sends the hub and the chain's label through the hot-key joins."""
    return G.connected_components(B.binding(spark, sf_dir, "hub_chain_edges"), hot_degree=300)


@query
def component_attributes(spark, sf_dir):
    customer = B.read_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("IM:"), F.col("c_custkey").cast("string")).alias("id"), "c_name", "c_mktsegment")
    return G.component_attributes(connected_components(spark, sf_dir), customer)


# --- jobs: written by the sinks, read back by the sources --------------------------------

def _text(spark, lines, name, **options):
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        lines.write.options(**options).text(path)
    return path


def _log_table(spark, sf_dir):
    path = scratch_path(spark, "log")
    with shuffles_freed(spark):
        write_log(B.ad_log(spark, sf_dir), path)
    return path


def _etl(spark, sf_dir, partition_by):
    raw = _text(spark, B.raw_log_lines(spark, sf_dir), "raw-gz", compression="gzip")
    path = scratch_path(spark, "etl")
    jobs.etl_job(spark, raw, path, partition_by=partition_by)
    return read_log(spark, path)


@query
def job_etl_plain(spark, sf_dir):
    """Compressed lines -> typed log, plain layout."""
    return _etl(spark, sf_dir, None)


@query
def job_etl_partitioned(spark, sf_dir):
    """Compressed lines -> typed log, one folder per province and city."""
    return _etl(spark, sf_dir, ["provincename", "cityname"])


@query
def job_location_report_json(spark, sf_dir):
    path = scratch_path(spark, "report-json")
    rep = jobs.location_report_job(spark, _log_table(spark, sf_dir), path, fmt="json",
                                   money_scale=MONEY_SCALE)
    return spark.read.schema(rep.schema).json(path)


@query
def job_app_dictionary(spark, sf_dir):
    path = scratch_path(spark, "dictionary")
    jobs.app_dictionary_job(spark, _text(spark, B.app_dictionary_lines(spark, sf_dir), "dictionary-text"), path)
    return spark.read.parquet(path)


@query
def job_user_tags(spark, sf_dir):
    """Log table, dictionary and stop-word files -> day-partitioned profiles."""
    path = scratch_path(spark, "profiles")
    jobs.user_tags_job(
        spark, _log_table(spark, sf_dir),
        _text(spark, B.app_dictionary_lines(spark, sf_dir), "dictionary-text"),
        _text(spark, B.binding(spark, sf_dir, "stopword_lines"), "stopwords"), path, day="2024-05-01")
    return read_profiles(spark, path)


@query
def job_etl_rejects(spark, sf_dir):
    """The rejected lines of the same write as the typed rows, by province and city."""
    raw = _text(spark, B.raw_log_lines(spark, sf_dir), "raw-gz", compression="gzip")
    path = scratch_path(spark, "etl")
    jobs.etl_job(spark, raw, path, partition_by=["provincename", "cityname"])
    return read_rejects(spark, path).select(F.substring_index("line", ",", 1).alias("sessionid"), "n_fields")


# --- keyed lookups: last line wins, upserts, point reads ----------------------------------

@query
def app_dictionary_last_wins(spark, sf_dir):
    """Repeated keys over several files: the last line of the last file stays."""
    path = scratch_path(spark, "dictionary-files")
    lines = B.binding(spark, sf_dir, "repeated_dictionary_lines")
    lines.repartition(3, "file").sortWithinPartitions("file", "pos").select("file", "value").write.partitionBy(
        "file").text(path)
    return read_app_dictionary(spark, path, duplicates="last")


def _keyed_table(spark, sf_dir):
    """Three batches of upserts, compacted between the second and the third."""
    path = scratch_path(spark, "keyed")
    batches = B.binding(spark, sf_dir, "keyed_batches")
    for batch in (1, 2, 3):
        keyed.put(batches.where(F.col("batch") == batch), path, batch, buckets=16)
        if batch == 2:
            keyed.compact(spark, path)
    return path


@query
def keyed_upsert(spark, sf_dir):
    return keyed.read(spark, _keyed_table(spark, sf_dir))


@query
def keyed_points(spark, sf_dir):
    """Values of the keys that a table names, read from their buckets alone."""
    keys = B.read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("key"))
    return keyed.read(spark, _keyed_table(spark, sf_dir), keys=keys)


@query
def resolve_new_places(spark, sf_dir):
    """A stored lookup of some places, and a resolver asked for all others."""
    path = scratch_path(spark, "places")
    points, responses = B.geo_points(spark, sf_dir), B.binding(spark, sf_dir, "place_responses")
    stored = GEO.build_business_lookup(B.binding(spark, sf_dir, "old_places"), responses)
    keyed.put(stored, path, 1, key="geohash", value="business", buckets=16)
    asked = points.select("long", "lat").distinct().join(responses, ["long", "lat"], "left")
    jobs.resolve_business_job(spark, asked, path, scratch_path(spark, "failed"), batch=2,
                              make_resolver=CapturedResolver, in_flight=4)
    return keyed.read(spark, path, key="geohash", value="business")


# --- lookup joins beyond the broadcast bound, a third of the rows on one key --------------

def _hot_log(spark, sf_dir):
    return materialize(B.binding(spark, sf_dir, "hot_log"), "hot-log")[0]


@query
def lookup_hot_app(spark, sf_dir):
    log = TG.with_app_lookup(_hot_log(spark, sf_dir), _dictionary(spark, sf_dir), broadcast_rows=0)
    tags = log.select(F.explode(TG.app_tags(dict_name=TG.DICT_APP)).alias("tag"))
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("weight"))


@query
def lookup_hot_word(spark, sf_dir):
    words = _hot_log(spark, sf_dir).select(F.explode(TG.keyword_candidates()).alias("word"))
    kept = drop_stopwords(words.where(TG.keyword_ok(F.col("word"))), B.stopwords(spark), word="word", broadcast_rows=0)
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("weight"))


@query
def lookup_hot_place(spark, sf_dir):
    words = GEO.business_tag_words(_hot_log(spark, sf_dir), business_lookup(spark, sf_dir), broadcast_rows=0)
    return words.groupBy("tag").agg(F.count(F.lit(1)).alias("weight"))


# --- profiles over days, the next day's components ------------------------------------------

def _profile_table(spark, sf_dir):
    path = scratch_path(spark, "profile-days")
    log = _tag_log(spark, sf_dir, B.binding(spark, sf_dir, "dated_log"), ["day"])
    for day in ("2024-05-01", "2024-05-02", "2024-05-03"):
        of_day = P.user_tags(log.where(F.col("day") == day), dictionary=_dictionary(spark, sf_dir),
                             stopwords=B.stopwords(spark))
        write_profiles(of_day, path, day=day)
    return path


@query
def profile_days_map(spark, sf_dir):
    """The wide row of every user: a map from day to that day's tags."""
    days = P.profile_days(read_profiles(spark, _profile_table(spark, sf_dir)))
    return days.select("user_id", F.size("days").alias("n_days"), F.explode("days").alias("day", "tags"))


@query
def profile_days_merged(spark, sf_dir):
    """Weights summed over the last two of three days."""
    return P.merge_days(read_profiles(spark, _profile_table(spark, sf_dir), first="2024-05-02", last="2024-05-03"))


@query
def components_next_day(spark, sf_dir):
    """Components of one half of the edges, then the other half added to them."""
    edges = materialize(id_edges(spark, sf_dir), "edges")[0]
    early = F.pmod(F.xxhash64("src", "dst"), F.lit(2)) == 0
    return G.update_components(G.connected_components(edges.where(early)), edges.where(~early))


@query
def person_profiles_bucketed(spark, sf_dir):
    """Person profiles from a log bucketed by head id."""
    return P.person_profiles_colocated(B.ad_log(spark, sf_dir), dictionary=_dictionary(spark, sf_dir),
                                       stopwords=B.stopwords(spark))
