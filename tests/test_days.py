"""Profiles over days, one-pass ETL, components of a growing graph."""

import os

from adlumen.operators.graph import connected_components, update_components
from adlumen.plans import jobs
from adlumen.plans.profiles import merge_days, profile_days
from adlumen.schema import LOG_SCHEMA
from adlumen.sinks.writers import write_profiles
from adlumen.sources.logs import read_log, read_profiles, read_rejects

PROFILE = "user_id string, tag string, weight bigint"


def days_of(spark, path, **options):
    return {r.user_id: r.days for r in profile_days(read_profiles(spark, path, **options)).collect()}


def test_wide_rows_over_days(spark, tmp_path):
    p = str(tmp_path / "profiles")
    big = 1 << 31
    for day, rows in (("2024-05-01", [("u", "b", big), ("u", "a", 2), ("v", "a", 1)]),
                      ("2024-05-02", [("u", "b", big)]), ("2024-05-10", [("v", "c", 7)])):
        write_profiles(spark.createDataFrame(rows, PROFILE), p, day=day)
    assert days_of(spark, p) == {"u": {"2024-05-01": f"a:2,b:{big}", "2024-05-02": f"b:{big}"},
                                 "v": {"2024-05-01": "a:1", "2024-05-10": "c:7"}}
    # a day that is run again changes its own entry only
    write_profiles(spark.createDataFrame([("u", "z", 1)], PROFILE), p, day="2024-05-02")
    assert days_of(spark, p) == {"u": {"2024-05-01": f"a:2,b:{big}", "2024-05-02": "z:1"},
                                 "v": {"2024-05-01": "a:1", "2024-05-10": "c:7"}}
    write_profiles(spark.createDataFrame([("u", "b", big)], PROFILE), p, day="2024-05-02")
    merged = merge_days(read_profiles(spark, p, first="2024-05-01", last="2024-05-02"))
    assert {tuple(r) for r in merged.collect()} == {("u", "b", 2 * big), ("u", "a", 2), ("v", "a", 1)}
    assert dict(merged.dtypes)["weight"] == "bigint"


def test_a_range_of_days_opens_its_folders_only(spark, tmp_path):
    p = str(tmp_path / "profiles")
    for day in ("2024-05-01", "2024-05-02", "2024-05-03"):
        write_profiles(spark.createDataFrame([("u", "a", 1)], PROFILE).coalesce(1), p, day=day)
    df = read_profiles(spark, p, first="2024-05-02", last="2024-05-02")
    assert [r.day for r in df.collect()] == ["2024-05-02"]
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    assert plan.collectLeaves().apply(0).metrics().apply("numFiles").value() == 1


# --- one pass over the raw text ------------------------------------------------------------


def raw_lines():
    good = [f"s{i}," + ",".join(["1"] * 84) for i in range(40)]
    return good + ["too,short", "", "a," * 80]


def test_raw_text_is_read_once(spark, tmp_path, monkeypatch):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "log.txt").write_text("\n".join(raw_lines()) + "\n")
    seen = spark.sparkContext.accumulator(0)
    plain = jobs.read_raw_lines

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    monkeypatch.setattr(jobs, "read_raw_lines", lambda s, path: plain(s, path).mapInArrow(counted, "value string"))
    n = len(raw_lines())
    for k, options in enumerate(({}, {"partition_by": ["provincename", "cityname"]},
                                 {"rejects_path": str(tmp_path / "rejects")})):
        out = str(tmp_path / f"out{k}")
        before = seen.value
        assert jobs.etl_job(spark, str(tmp_path / "raw"), out, **options) == {"lines": n, "rejected": 3}
        assert seen.value - before == n, options
        assert read_log(spark, out).columns == LOG_SCHEMA.fieldNames()
        assert {r.sessionid for r in read_log(spark, out).collect()} == {f"s{i}" for i in range(40)}
    for rejects in (read_rejects(spark, str(tmp_path / "out1")), read_rejects(spark, str(tmp_path / "out2")),
                    spark.read.parquet(str(tmp_path / "rejects"))):
        assert sorted(tuple(r) for r in rejects.collect()) == [("", 1), ("a," * 80, 81), ("too,short", 2)]


def test_tagged_log_of_only_good_or_only_bad_lines(spark, tmp_path):
    for name, lines, counts in (("good", raw_lines()[:40], (40, 0)), ("bad", raw_lines()[40:], (3, 3)), ("none", [], (0, 0))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.txt").write_text("".join(x + "\n" for x in lines))
        out = str(tmp_path / f"{name}-out")
        stats = jobs.etl_job(spark, str(tmp_path / name), out, partition_by=["provincename"])
        assert (stats["lines"], stats["rejected"]) == counts
        if name != "none":
            assert read_log(spark, out).count() == counts[0] - counts[1] and read_rejects(spark, out).count() == counts[1]
    assert os.path.exists(tmp_path / "none-out")


# --- components of a growing graph -------------------------------------------------------------


def labels_of(df):
    return {r.id: r.component for r in df.collect()}


def test_new_edges_join_old_components(spark):
    schema = "src string, dst string"
    old = [("b", "c"), ("c", "d"), ("m", "n"), ("x", "x"), ("p", "q")]
    for new in ([("d", "n")], [("a", "q"), ("q", "x")], [("z", "zz")], [("b", "d"), ("b", "b")], [],
                [(None, "b"), ("b", None)], [("a", "b"), ("n", "a"), ("k", "k")]):
        whole = connected_components(spark.createDataFrame(old + new, schema))
        labels = connected_components(spark.createDataFrame(old, schema))
        assert labels_of(update_components(labels, spark.createDataFrame(new, schema))) == labels_of(whole), new


def test_growth_day_by_day_with_a_hub(spark):
    schema = "src string, dst string"
    edges = [("hub", f"h{i}") for i in range(300)] + [(f"c{i}", f"c{i + 1}") for i in range(60)] + [("c30", "h7")]
    labels = spark.createDataFrame([], "id string, component string")
    for day in range(4):
        labels = update_components(labels, spark.createDataFrame(edges[day::4], schema), hot_degree=20)
    assert labels_of(labels) == labels_of(connected_components(spark.createDataFrame(edges, schema)))
