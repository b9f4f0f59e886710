
from adlumen.operators.identity import all_ids, first_id, has_any_id, id_edges
from log_rows import log_rows


def test_first_and_all_ids(spark):
    rows = [dict(sessionid="a", imei=" ", mac="m1", idfa="d1"),
            dict(sessionid="b", idfamd5="a", openudidmd5="b"),
            dict(sessionid="c", imei=" "),
            dict(sessionid="d")]
    df = log_rows(spark, rows)
    got = {r.sessionid: (r.f, r.a) for r in
           df.where(has_any_id()).select("sessionid", first_id().alias("f"), all_ids().alias("a")).collect()}
    assert got["a"] == ("MCm1", ["MC:m1", "ID:d1"])
    assert got["b"] == ("MD5ODb", ["IDM:a", "ODM:b"])
    assert got["c"] == (None, [])
    assert "d" not in got


def test_id_filter_is_pushed_down(spark, tmp_path):
    df = log_rows(spark, [dict(sessionid="a", imei="x")])
    df.write.parquet(str(tmp_path / "log"))
    from adlumen.sources.logs import read_log

    plan = read_log(spark, str(tmp_path / "log")).where(has_any_id()).select("sessionid")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in text
    assert "ReadSchema: struct<sessionid:string,imei:string" in text


def test_star_edges(spark):
    df = spark.createDataFrame([(["x", "y", "z"],), (["q"],), (["x", "y"],)], "ids array<string>")
    got = sorted(tuple(r) for r in id_edges(df).collect())
    assert got == [("q", "q"), ("x", "x"), ("x", "y"), ("x", "z")]
