"""What tags and person profiles leave on disk: bound logs, dictionaries and labels beyond a broadcast."""

import time

import pytest
from pyspark.sql import functions as F

from adlumen.operators.lookup import hot_keys
from adlumen.operators.tags import weigh_tags
from adlumen.plans.profiles import id_edge_list, person_graph, person_profiles
from adlumen.session import materialize
from adlumen.sources import bindings as B
from log_rows import log_rows


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_lines(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def exchanges_above(lines, scan):
    """The shuffles between the scan in that line and the plan's result, by their indent."""
    depth, above = len(lines[scan]), []
    for x in reversed(lines[:scan + 1]):
        indent = len(x) - len(x.lstrip(" :+-*"))
        if indent < depth:
            depth = indent
            above.append(x)
    return [x for x in above if "Exchange hashpartitioning" in x]


def rows_of(df):
    return sorted(map(str, df.collect()))


def skewed_log(spark):
    return log_rows(spark, [dict(
        sessionid=str(i), imei="HOT" if i % 3 == 0 else None if i % 7 == 0 else f"i{i % 40}", mac=f"m{i % 17}",
        keywords="alpha|beta|stop|alpha", provincename=f"P{i % 4}", appid=f"{i % 7}" if i % 5 else [" ", None][i % 2],
        appname=["", " ", "N1", None][i % 4], long="100.03", lat="40.57") for i in range(240)])


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {p for p in (files.apply(i).getName() for i in range(files.size())) if p.startswith("shuffle_")}


def test_finished_steps_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = spark.range(5000).select((F.col("id") % 900).cast("string").alias("key"), "id").repartition(8, "key")
    kept = materialize(rows.groupBy("key").agg(F.sum("id").alias("s")), "step", [F.count(F.lit(1)).alias("n")])
    assert kept[2]["n"] == 900 and kept[0].count() == 900
    assert hot_keys(rows, "key") == []
    for _ in range(40):     # files are deleted in the background; kept[0].count() may leave one
        left = shuffle_files(spark) - before
        if len(left) <= 2:
            break
        time.sleep(0.25)
    assert len(left) <= 2, left


def test_a_large_dictionary_does_not_move_rows(spark, no_broadcast):
    """Whole rows (keywords and all) are moved once, to their key; rows of hot keys never."""
    log, stop = skewed_log(spark), spark.createDataFrame([("stop",)], "value string")
    d = spark.createDataFrame([("1", "N1"), ("2", "N2"), ("4", None), (None, "N9")], "key string, value string")
    business = spark.createDataFrame([("nothing", "A;B")], "geohash string, business string")
    for least in (0, 1000):
        for more in ({}, {"stopwords": stop}, {"stopwords": stop, "business_lookup": business}):
            expected = rows_of(weigh_tags(log, "imei", least=least, dictionary=d, **more))
            out = weigh_tags(log, "imei", least=least, dictionary=d, broadcast_rows=0, **more)
            assert rows_of(out) == expected
    log = materialize(log, "log")[0]
    lines = plan_lines(weigh_tags(log, "imei", least=0, dictionary=d, broadcast_rows=0))
    moved = [exchanges_above(lines, i) for i, x in enumerate(lines) if "FileScan parquet" in x and "keywords" in x]
    assert len(moved) == 2 and max(map(len, moved)) == 1


def test_people_gather_rows_instead_of_tags(spark, no_broadcast):
    """Labels beyond a broadcast: rows are labelled before they are exploded, so no tag is shuffled."""
    log = skewed_log(spark)
    labels = person_graph(log)
    d = spark.createDataFrame([("1", "N1"), ("2", "N2"), ("4", None)], "key string, value string")
    expected = rows_of(person_profiles(log, dictionary=d, labels=labels))
    out = person_profiles(log, dictionary=d, labels=labels, broadcast_rows=1)
    assert rows_of(out) == expected
    lines = plan_lines(out)
    moved = [exchanges_above(lines, i) for i, x in enumerate(lines) if "FileScan parquet" in x and "keywords" in x]
    assert moved and all(len(m) <= 1 for m in moved)
    assert all("hashpartitioning(component" in x and "tag" not in x for m in moved for x in m)
    some = labels.where("component <> 'x'").unionByName(labels.limit(3))      # labels may repeat, ids may lack one
    some = materialize(some.where("id <> 'IM:i1'"), "some")[0]
    assert rows_of(person_profiles(log, labels=some)) == rows_of(person_profiles(log, labels=some, broadcast_rows=1))


def test_profiles_need_no_more_columns_than_they_read(spark):
    log = log_rows(spark, [dict(sessionid="a", imei="1", keywords="alpha"), dict(sessionid="b", imei="2")])
    log = log.drop("long", "lat")
    assert rows_of(person_profiles(log, broadcast_rows=1)) == rows_of(person_profiles(log))
    assert id_edge_list(log).count() == 2


def test_line_items_are_not_moved_to_their_customers(spark, tmp_path, no_broadcast):
    """The log's joins in another order than the SQL's: the same rows, one shuffle of the line items less."""
    odd = {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey", "lineitem": "l_partkey"}
    for name in ("lineitem", "orders", "customer", "nation", "region", "part"):
        t = B.read_table(spark, "/root/testdata/sf0.001", name)
        if name in odd:     # repeated and null keys
            t = t.unionByName(t.limit(7)).unionByName(t.limit(5).withColumn(odd[name], F.lit(None).cast(t.schema[odd[name]].dataType)))
        t.write.parquet(str(tmp_path / f"{name}.parquet"))
    text, deps = B.BINDINGS["ad_log"]
    plain = spark.sql(text, **{d: B.read_table(spark, str(tmp_path), d) for d in deps})
    log = B.ad_log(spark, str(tmp_path))
    assert log.columns == plain.columns and log.dtypes == plain.dtypes
    assert log.exceptAll(plain).isEmpty() and plain.exceptAll(log).isEmpty()
    lines = plan_lines(log)
    scan = next(i for i, x in enumerate(lines) if "FileScan parquet [l_orderkey" in x)
    moved = exchanges_above(lines, scan)
    assert len(moved) == 4 and not any("custkey" in x for x in moved)     # with nothing broadcast, not even nations
