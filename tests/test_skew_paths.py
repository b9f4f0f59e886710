"""The skew-handling paths give the same answers as the default paths on a
log where one device id and one app hold a third of all rows."""

from adlumen.operators.graph import connected_components
from adlumen.plans.profiles import id_edge_list, person_profiles, user_tags
from adlumen.plans.reports import app_report
from adlumen.sources.dictionary import parse_app_dictionary
from log_rows import log_rows


def _skewed_log(spark):
    rows = []
    for i in range(240):
        hot = i % 3 == 0
        rows.append(dict(
            sessionid=str(i), imei="HOT" if hot else f"i{i % 40}", mac=f"m{i % 17}",
            appid="com.hot" if hot else f"com.{i % 11}", appname="" if i % 2 else f"N{i % 5}",
            provincename=f"P{i % 4}", cityname="C", requestmode=1 + i % 3, processnode=1 + i % 3,
            iseffective=1, isbilling=i % 2, isbid=i % 2, iswin=(i + 1) % 2, adorderid=i % 4,
            winprice=float(i), adpayment=float(2 * i), keywords="alpha|beta|gamma|stop",
            adplatformproviderid=i % 6, client=i % 5))
    return log_rows(spark, rows)


def _dictionary(spark):
    lines = ["1\tHotApp\tx\ty\tcom.hot"] + [f"1\tApp{i}\tx\ty\tcom.{i}" for i in range(0, 11, 2)]
    return parse_app_dictionary(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_lookup_paths_agree(spark):
    from pyspark.sql import functions as F

    from adlumen.operators.funnel import funnel
    from adlumen.operators.lookup import drop_stopwords, fill_from_dictionary
    from adlumen.operators.tags import keyword_candidates

    log, d = _skewed_log(spark), _dictionary(spark)
    stop = spark.createDataFrame([("stop",)], "value string")

    def report(bound):
        named = fill_from_dictionary(log, d, default="unknow", broadcast_rows=bound)
        return sorted(funnel(named, ["appname"], "exclusive", money_scale=2).collect())

    def words(bound):
        w = log.select("sessionid", F.explode(keyword_candidates()).alias("word"))
        return sorted(drop_stopwords(w, stop, word="word", broadcast_rows=bound).collect())

    assert report(1_000_000) == report(0)        # broadcast vs materialised lookup
    assert any(r.appname == "HotApp" for r in report(0))
    assert words(1_000_000) == words(0)
    assert all(r.word != "stop" for r in words(0))


def test_profile_paths_agree(spark):
    log, d = _skewed_log(spark), _dictionary(spark)
    base = sorted(person_profiles(log, dictionary=d).collect())
    labels = connected_components(id_edge_list(log), hot_degree=5)   # hub split exercised
    forced = sorted(person_profiles(log, dictionary=d, labels=labels, broadcast_rows=1).collect())
    assert base == forced
    # the hot imei links every row that shares any mac with it
    comps = {r.component for r in base}
    assert len(comps) >= 1
