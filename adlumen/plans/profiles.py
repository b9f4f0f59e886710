"""Profile plans: per-user tags and per-person (connected ids) profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlumen.operators.graph import connected_components
from adlumen.operators.identity import all_ids, first_id, has_any_id, head_id, id_edges
from adlumen.operators.lookup import DEFAULT_BROADCAST_ROWS, fits_broadcast, hot_keys, lookup_join
from adlumen.operators.tags import (
    GENERATORS, app_items, looked_up_apps, merge_tags, named_app_items, needs_app_lookup, tags_long, weigh_tags,
)
from adlumen.session import materialize, write_bucketed

ROW_KEY = "sessionid"


def user_tags(log: DataFrame, *, dictionary: DataFrame | None = None,
              stopwords: DataFrame | None = None,
              business_lookup: DataFrame | None = None) -> DataFrame:
    """``(user_id, tag, weight)``: tags of every row merged per first id.

    Rows without any id are skipped (the id filter is pushed to the scan);
    rows whose ids are all whitespace have no first id and are dropped too.
    """
    rows = log.where(has_any_id()).withColumn("user_id", first_id()).where(
        F.col("user_id").isNotNull())
    return weigh_tags(rows, "user_id", dictionary=dictionary, stopwords=stopwords, business_lookup=business_lookup)


def id_rows(log: DataFrame) -> DataFrame:
    """Rows with at least one usable id, with the head id ``head`` (the first
    of the row's ids).  The cheap ``has_any_id`` part is pushed to the scan;
    rows whose ids are all whitespace have no head and are dropped."""
    rows = log.where(has_any_id()).withColumn("head", head_id())
    return rows.where(F.col("head").isNotNull())


def id_edge_list(log: DataFrame) -> DataFrame:
    """Star edges of every log row (``src`` = head id, ``dst`` = each id);
    a row without usable ids has an empty id array and yields no edge.

    Rows repeat the same id set on every request, so id sets are made
    distinct first (partial aggregation collapses repeats, a hot set too,
    before anything is shuffled) and only distinct sets are exploded.
    """
    ids = log.where(has_any_id()).select(all_ids().alias("ids")).distinct()
    return id_edges(ids)


def person_graph(log: DataFrame) -> DataFrame:
    """``(id, component)`` for every id seen in the log."""
    return connected_components(id_edge_list(log))


def person_profiles(log: DataFrame, *, dictionary: DataFrame | None = None,
                    stopwords: DataFrame | None = None,
                    labels: DataFrame | None = None,
                    business_lookup: DataFrame | None = None,
                    broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Long-form person profiles ``(component, entry, weight)``.

    A person is a connected component of ids that co-occur in a row.  Each
    row's tags count once, attached to the row's head id, then summed per
    component; every id of the component is an entry of weight 0.
    """
    rows = id_rows(log)
    if labels is None:
        labels = person_graph(log)
    lab = labels.select(F.col("id").alias("head"), "component")
    if fits_broadcast(lab, broadcast_rows):
        # small id table: label every row map-side, then one aggregation
        labelled = rows.join(F.broadcast(lab), "head")
    else:
        # large id table: label the rows by a shuffle join (those of hot heads where
        # they are) and write them as a table: so the shuffle of that join is gone
        # before the rows, still not exploded, are brought together by person
        unread = () if business_lookup is not None else ("long", "lat")
        needed = rows.select("head", *(c for c in TAG_SOURCES if c in rows.columns and c not in unread))
        labelled = lookup_join(needed, lab.withColumnRenamed("head", "__head"), "head", "__head", "inner", small=False)
        labelled = materialize(labelled.drop("head", "__head"), "labelled")[0]
    tagged = weigh_tags(labelled, "component", dictionary=dictionary, stopwords=stopwords,
                        business_lookup=business_lookup, broadcast_rows=broadcast_rows)
    ids = labels.select("component", F.col("id").alias("entry"), F.lit(0).cast("bigint").alias("weight"))
    return tagged.select("component", F.col("tag").alias("entry"), "weight").unionByName(ids)


#: Columns that tag generators, keywords and business areas read.
TAG_SOURCES = ("adspacetype", "adspacetypename", "adplatformproviderid", "provincename", "cityname", "client",
               "networkmannername", "ispname", "appname", "appid", "keywords", "long", "lat")


def write_head_buckets(log: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """The log's usable rows (head id, ids, tag sources), written once for a day's jobs.

    Returns the rows as a table bucketed and sorted by ``head``, those of hot
    heads (``operators.lookup.hot_keys``) as a table of their own, which no
    bucket could hold, and the hot heads.
    """
    rows = id_rows(log).select("head", all_ids().alias("ids"), *TAG_SOURCES)
    hot = hot_keys(rows, "head")
    apart = F.col("head").isin(hot) if hot else F.lit(False)
    few = materialize(rows.where(apart), "hot-heads")[0]
    return write_bucketed(rows.where(~apart), "head", buckets, "heads"), few, hot


def person_profiles_colocated(log: DataFrame, *, dictionary: DataFrame | None = None,
                              stopwords: DataFrame | None = None,
                              business_lookup: DataFrame | None = None,
                              buckets: int | None = None,
                              broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``person_profiles`` for id tables beyond a broadcast: the log is read once for its
    hot heads and once for its rows, which are shuffled once, to buckets by head id.
    The labels are bucketed alike, so rows meet their component without another
    shuffle, are exploded there, and only a bucket's sums are shuffled.

    A large dictionary meets app ids beside their components, not the rows.  Rows of hot heads
    are labelled where they are: at most ``operators.lookup.MOST_HOT`` heads, whose
    labels are broadcast.
    """
    buckets = buckets or int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, few, hot = write_head_buckets(log, buckets)

    def edges(part):
        # as ``id_edges``, but by head: a bucket's sets are made distinct where they are
        sets = part.select("head", "ids").distinct()
        return sets.select(F.col("head").alias("src"), F.explode("ids").alias("dst")).distinct()

    labels = connected_components(edges(rows).unionByName(edges(few)) if hot else edges(rows))
    beside = write_bucketed(labels.select(F.col("id").alias("head"), "component"), "head", buckets, "labels")
    generators = GENERATORS if dictionary is None else (
        *(g for g in GENERATORS if g is not app_items), named_app_items)

    def entries(part, labelled):
        long = tags_long(part.join(labelled, "head"), ["component"], stopwords=stopwords,
                         business_lookup=business_lookup, generators=generators)
        if dictionary is None:
            return long
        unnamed = part.where(needs_app_lookup()).select("head", "appid")
        apps = unnamed.join(labelled, "head").select("component", "appid")
        return long.unionByName(looked_up_apps(apps, dictionary, sketch=unnamed, broadcast_rows=broadcast_rows))

    long = entries(rows, beside)
    if hot:
        long = long.unionByName(entries(few, F.broadcast(beside.where(F.col("head").isin(hot)))))
    # the only aggregate: its sums in a bucket are those of the bucket's heads
    tagged = merge_tags(long, "component").withColumnRenamed("tag", "entry")
    zero = labels.select("component", F.col("id").alias("entry"), F.lit(0).cast("bigint").alias("weight"))
    return tagged.unionByName(zero)


def profile_days(profiles: DataFrame, user: str = "user_id", tag: str = "tag") -> DataFrame:
    """Day-partitioned profiles ``(user, tag, weight, day)`` -> ``(user, days)``: the wide
    row of a user, a map from day to that day's tags as ``tag:n,tag:n`` (by tag).

    A day's tags become one text per user in a first aggregate; the map then
    holds one entry per day.
    """
    item = F.concat(F.col(tag), F.lit(":"), F.col("weight").cast("string"))
    daily = profiles.groupBy(user, "day").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(tag).alias("t"), item.alias("i")))),
                                 lambda x: x["i"]), ",").alias("tags"))
    return daily.groupBy(user).agg(F.map_from_entries(
        F.array_sort(F.collect_list(F.struct("day", "tags")))).alias("days"))


def merge_days(profiles: DataFrame, user: str = "user_id", tag: str = "tag") -> DataFrame:
    """``(user, tag, weight, day)`` -> ``(user, tag, weight)`` over all its days."""
    return profiles.groupBy(user, tag).agg(F.sum("weight").alias("weight"))
