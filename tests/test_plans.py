"""Plan checks: pruning, pushdown, broadcast of checked-small sides, no Python UDFs."""

import pytest
from pyspark.sql import functions as F

from adlumen.operators import graph
from adlumen.operators.geo import add_geohash
from adlumen.operators.lookup import hot_keys, lookup_join
from adlumen.operators.tags import tags_long
from adlumen.plans.catalog import QUERIES
from adlumen.plans.profiles import person_profiles, person_profiles_colocated, user_tags
from adlumen.plans.reports import app_report, location_report
from adlumen.session import checkpoint_dir
from adlumen.sources.dictionary import parse_app_dictionary
from adlumen.sources.logs import read_log
from log_rows import log_rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_funnel_reads_only_needed_columns(spark, tmp_path):
    log_rows(spark, [dict(sessionid="a")]).write.parquet(str(tmp_path / "l"))
    text = _plan(location_report(read_log(spark, str(tmp_path / "l"))))
    read_schema = [x for x in text.splitlines() if "ReadSchema" in x][0]
    assert "sessionid" not in read_schema and "keywords" not in read_schema
    assert "winprice" in read_schema and "provincename" in read_schema


def test_app_report_broadcasts_small_dictionary(spark):
    log = log_rows(spark, [dict(sessionid="a", appid="x", appname="")])
    d = parse_app_dictionary(spark.createDataFrame([("1\tN\tx\ty\tx",)], "value string"))
    text = _plan(app_report(log, d))
    assert "BroadcastHashJoin" in text or "BroadcastExchange" in text


def test_no_python_udfs_in_registered_queries(spark):
    for name, fn in QUERIES.items():
        if name in ("connected_components", "component_members", "component_sizes",
                    "person_profiles"):
            continue  # these run their rounds eagerly; covered by test_graph
        text = _plan(fn(spark, "/root/testdata/sf0.001"))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name


# --- one scan, aggregates below joins, generated code, hot keys ------------------------------


def test_tags_scan_the_log_once_and_take_other_generators(spark, tmp_path):
    path = str(tmp_path / "log")
    log_rows(spark, [dict(sessionid="a", imei="1", appid="x", keywords="alpha|stop", provincename="P")]).write.parquet(path)
    stop = spark.createDataFrame([("stop",)], "value string")
    d = parse_app_dictionary(spark.createDataFrame([("1\tN\tx\ty\tx",)], "value string"))
    log = read_log(spark, path)
    text = _plan(user_tags(log, dictionary=d, stopwords=stop))
    assert text.count(f"[file:{path}]") == 1
    own = tags_long(log, ["sessionid"], include_keywords=False, generators=[lambda: [F.lit("X1"), F.lit(None).cast("string")]])
    assert [tuple(r) for r in own.collect()] == [("a", "X1")]


def test_app_report_sums_before_the_dictionary_join(spark, tmp_path):
    path = str(tmp_path / "log")
    log_rows(spark, [dict(sessionid="a", appid="x", appname="")]).write.parquet(path)
    d = parse_app_dictionary(spark.createDataFrame([("1\tN\tx\ty\tx",)], "value string"))
    lines = _plan(app_report(read_log(spark, path), d)).splitlines()
    join = next(i for i, x in enumerate(lines) if "HashJoin" in x)
    partial = [i for i, x in enumerate(lines) if "partial_sum" in x]
    scan = next(i for i, x in enumerate(lines) if f"[file:{path}]" in x)
    assert any(join < i < scan for i in partial)


def test_geohash_is_generated_code_and_each_cell_computed_once(spark, tmp_path):
    path = str(tmp_path / "log")
    log_rows(spark, [dict(sessionid="a", long="116.39", lat="39.92")]).write.parquet(path)
    df = add_geohash(read_log(spark, path).select("long", "lat")).where("geohash is not null").select("geohash")
    lines = [x for x in _plan(df).splitlines() if "FLOOR" in x]
    assert len(lines) == 1 and "*(" in lines[0] and "Generate" in lines[0]
    assert lines[0].count("FLOOR") <= 12        # five uses of each cell's clamp, not eighty


def test_hot_keys_stay_where_they_are(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 97 == 0, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("key"), "id").write.parquet(path)
    rows = spark.read.parquet(path)
    side = spark.range(400).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("name"), F.col("id").alias("v"))
    side = side.unionByName(spark.createDataFrame([("hot", -1)], "name string, v bigint"))
    assert hot_keys(rows, "key") == ["hot"]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for how in ("left", "inner", "left_semi", "left_anti"):
            expected = sorted(map(str, lookup_join(rows, side, "key", "name", how).collect()))
            split = lookup_join(rows, side, "key", "name", how, broadcast_rows=0)
            text = _plan(split)
            assert sorted(map(str, split.collect())) == expected
            # the shuffled part filters the hot key out; the other has no shuffle
            assert text.count("Exchange hashpartitioning") == 2 and "BroadcastHashJoin" in text
            assert "NOT (key" in text.replace("(NOT", "NOT") or "<> hot" in text or "NOT key" in text
            salted = lookup_join(rows, side, "key", "name", how, broadcast_rows=0, broadcast_bytes=1)
            assert sorted(map(str, salted.collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_key_is_hot_among_even_ones(spark):
    even = spark.range(5000).select(F.concat(F.lit("k"), (F.col("id") % 1000).cast("string")).alias("key"))
    assert hot_keys(even, "key") == [] and hot_keys(even.limit(0), "key") == []


def test_a_component_round_shuffles_for_two_joins_at_most(spark):
    edges = spark.createDataFrame([(2, 1), (3, 1)], "a bigint, b bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for step in (graph._large_star, graph._small_star):
            assert _plan(step(edges, None)).count("SortMergeJoin") <= 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_colocated_profiles_shuffle_neither_rows_nor_labels(spark):
    rows = [dict(sessionid=str(i), imei="HOT" if i % 3 == 0 else f"i{i}", mac=f"m{i % 17}", keywords="alpha|beta",
                 provincename=f"P{i % 4}") for i in range(120)]
    log = log_rows(spark, rows)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = person_profiles_colocated(log, buckets=4)
        lines = _plan(out).splitlines()
        assert sorted(map(str, out.collect())) == sorted(map(str, person_profiles(log).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = next(i for i, x in enumerate(lines) if "SortMergeJoin [head" in x)
    scans = [i for i, x in enumerate(lines) if "FileScan parquet" in x and "Bucketed: true" in x and i > join][:2]
    assert len(scans) == 2 and not any("Exchange" in x for x in lines[join:scans[1]])
    assert any("BroadcastHashJoin [head" in x for x in lines)       # the hot head's rows


def test_a_cluster_refuses_a_local_checkpoint_folder(spark, monkeypatch):
    from types import SimpleNamespace

    hadoop = SimpleNamespace(get=lambda key, default: "file:///")

    def session(folder):
        sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077", setCheckpointDir=lambda d: None,
                             _jsc=SimpleNamespace(hadoopConfiguration=lambda: hadoop),
                             getConf=lambda: SimpleNamespace(get=lambda k, d=None: None))
        return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: folder))

    with pytest.raises(RuntimeError, match="local folder"):
        checkpoint_dir(session("/tmp/ckpt"))
    assert checkpoint_dir(session("hdfs://nn/ckpt")) == "hdfs://nn/ckpt"
    assert checkpoint_dir(session("file:///mnt/shared")) == "file:///mnt/shared"
    with pytest.raises(RuntimeError, match="not set"):
        checkpoint_dir(session(None))


def test_a_large_dictionary_meets_app_ids_instead_of_rows(spark):
    """No shuffle moves the buckets' rows (keywords and all) again, neither to the dictionary nor to their sums."""
    rows = [dict(sessionid=str(i), imei="HOT" if i % 3 == 0 else f"i{i % 40}", mac=f"m{i % 17}", keywords="alpha|beta",
                 appid=f"{i % 7}" if i % 5 else " ", appname=["", " ", "N1", None][i % 4]) for i in range(120)]
    log = log_rows(spark, rows)
    d = spark.createDataFrame([("1", "N1"), ("2", "N2"), ("4", None)], "key string, value string")
    expected = sorted(map(str, person_profiles(log, dictionary=d).collect()))
    assert sorted(map(str, person_profiles_colocated(log, dictionary=d, buckets=4).collect())) == expected
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = person_profiles_colocated(log, dictionary=d, buckets=4, broadcast_rows=0)
        lines = _plan(out).splitlines()
        assert sorted(map(str, out.collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scans = [i for i, x in enumerate(lines) if "FileScan parquet" in x and "keywords" in x]
    assert scans
    for scan in scans:      # every operator above a scan of whole rows, by its indent
        depth, above = len(lines[scan]), []
        for x in reversed(lines[:scan + 1]):
            indent = len(x) - len(x.lstrip(" :+-*"))
            if indent < depth:
                depth = indent
                above.append(x)
        moved = [x for x in above if "Exchange hashpartitioning" in x]
        assert len(moved) == 1 and "component" in moved[0] and "tag" in moved[0]
