from pyspark.sql import functions as F

from adlumen.operators import tags as TG
from adlumen.plans.profiles import user_tags
from log_rows import log_rows


def _tags(spark, rows, col):
    df = log_rows(spark, rows)
    return [r[0] for r in df.select(col.alias("t")).collect()]


def test_ad_tags(spark):
    rows = [dict(adspacetype=12, adspacetypename="banner", adplatformproviderid=7),
            dict(adspacetype=3, adspacetypename=" ", adplatformproviderid=7),
            dict(adspacetype=0, adplatformproviderid=7)]
    assert _tags(spark, rows, TG.ad_tags()) == [["LC12", "LNbanner", "CN7"], ["LC03", "CN7"], ["CN7"]]


def test_device_tags(spark):
    rows = [dict(client=1, networkmannername="WIFI", ispname="移动"),
            dict(client=2, networkmannername="4G", ispname="联通"),
            dict(client=3, networkmannername="3G", ispname="电信"),
            dict(client=9, networkmannername="2G", ispname="other"),
            dict(client=0, networkmannername="wifi"),
            dict(networkmannername=None)]
    got = _tags(spark, rows, TG.device_tags())
    assert [g[0] for g in got[:4]] == ["D00010001", "D00010002", "D00010003", "D00010004"]
    assert [g[1] for g in got] == ["D00020001", "D00020002", "D00020003", "D00020004",
                                   "D00020005", "D00020005"]
    assert [g[2] for g in got[:4]] == ["D00030001", "D00030002", "D00030003", "D00030004"]


def test_location_and_app(spark):
    rows = [dict(provincename="P", cityname=" ", appname="", appid="q"),
            dict(provincename="", cityname="C", appname="Name", appid="q"),
            dict(appname=" ", appid="")]
    assert _tags(spark, rows, TG.location_tags()) == [["ZPP"], ["ZCC"], []]
    assert _tags(spark, rows, TG.app_tags()) == [["APPq"], ["APPName"], []]


def test_app_tag_from_dictionary(spark):
    df = log_rows(spark, [dict(sessionid="1", appname="", appid="com.a"),
                          dict(sessionid="2", appname="", appid="missing")])
    d = spark.createDataFrame([("com.a", "Video")], "key string, value string")
    got = dict(TG.with_app_lookup(df, d).select("sessionid", TG.app_tags(dict_name="__dict_app")[0]).collect())
    assert got == {"1": "APPVideo", "2": "APPmissing"}


def test_keywords_with_stopwords(spark):
    df = log_rows(spark, [dict(sessionid="u", keywords="ab|abc|movie|abcdefgh|abcdefghi|abc"),
                          dict(sessionid="n", keywords=None)])
    df = df.withColumn("user_id", F.col("sessionid"))
    stop = spark.createDataFrame([("movie",)], "value string")
    long = TG.tags_long(df, ["user_id"], stopwords=stop)
    merged = {(r.user_id, r.tag): r.weight for r in TG.merge_tags(long).collect()
              if r.tag.startswith("K")}
    assert merged == {("u", "Kabc"): 2, ("u", "Kabcdefgh"): 1}


def test_user_tags_merge_and_weight_conservation(spark):
    rows = [dict(sessionid="1", imei="i1", adplatformproviderid=7),
            dict(sessionid="2", imei="i1", adplatformproviderid=7),
            dict(sessionid="3", imei=" ", mac="m1", adplatformproviderid=8),
            dict(sessionid="4", imei=" "),  # passes the id filter, but no usable id
            dict(sessionid="5")]            # no id at all
    out = user_tags(log_rows(spark, rows))
    got = {(r.user_id, r.tag): r.weight for r in out.collect()}
    assert got[("IMi1", "CN7")] == 2
    assert got[("MCm1", "CN8")] == 1
    assert {u for u, _ in got} == {"IMi1", "MCm1"}
    # every tag occurrence of the three usable rows is counted exactly once
    df = log_rows(spark, rows[:3])
    per_row = df.select(F.size(TG.row_tags(dict_name=None)).alias("n")).groupBy().sum("n").collect()[0][0]
    assert sum(got.values()) == per_row


def test_large_lookup_side_is_materialised_not_broadcast(spark):
    from adlumen.operators.lookup import fill_from_dictionary

    log = log_rows(spark, [dict(sessionid=str(i), appid=str(i % 3), appname="") for i in range(30)])
    d = spark.createDataFrame([(str(i), f"N{i}") for i in range(3)], "key string, value string")
    big = fill_from_dictionary(log, d, broadcast_rows=2)   # 3 rows > bound: no broadcast
    small = fill_from_dictionary(log, d)
    plan = big._jdf.queryExecution().executedPlan().toString()
    assert "adlumen-loo" in plan   # read from the materialised table
    assert sorted(big.select("appname").collect()) == sorted(small.select("appname").collect())
