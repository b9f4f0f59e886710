
from adlumen.operators.geo import (
    build_business_lookup, business_tag_words, in_bbox, in_box_points, parse_business,
)

R_BIZ = 'renderReverse&&renderReverse({"status":0,"result":{"business":"A,B","pois":[]}})'
R_POIS = '{"status":0,"result":{"business":"","pois":[{"tag":"x"},{"tag":""},{"tag":"x"},{"tag":"y"}]}}'
R_FAIL = '{"status":1,"result":{}}'
R_BAD = '{"status":0,"result":'
R_MISSING = '{"result":{"business":"A"}}'


def test_parse_business(spark):
    df = spark.createDataFrame([(r,) for r in [R_BIZ, R_POIS, R_FAIL, R_BAD, R_MISSING, None]], "r string")
    got = [row[0] for row in df.select(parse_business("r")).collect()]
    assert got == ["A;B", "x;y", "", None, None, None]


def test_bbox(spark):
    df = spark.createDataFrame([("73.66", "53.55"), ("73.65", "10"), ("", "10"), ("bad", "x"),
                                ("100", "60")], "long string, lat string")
    assert [r[0] for r in df.select(in_bbox()).collect()] == [True, False, False, False, False]


def test_lookup_and_business_tags(spark):
    pts = spark.createDataFrame([("116.3906", "39.92324"), ("116.3906", "39.92324"), ("10", "10"),
                                 ("116.39061", "39.92324")], "long string, lat string")
    resp = spark.createDataFrame([("116.3906", "39.92324", R_BIZ), ("10", "10", R_POIS),
                                  ("116.39061", "39.92324", R_POIS)],
                                 "long string, lat string, response string")
    assert in_box_points(pts).count() == 2
    lookup = build_business_lookup(pts, resp)
    got = {r.geohash: r.business for r in lookup.collect()}
    assert got == {"wx4g0ec1": "A;B"}  # both in-box points share a cell; smallest wins
    log = spark.createDataFrame([("s1", "116.3906", "39.92324"), ("s2", "", "")],
                                "sessionid string, long string, lat string")
    tags = sorted(tuple(r) for r in business_tag_words(log, lookup, keep=("sessionid",)).collect())
    assert tags == [("s1", "A"), ("s1", "B")]
