"""Golden totals over the whole sf0.01 log (FIXTURES.md §8)."""

from pyspark.sql import functions as F

from adlumen.operators.funnel import funnel
from adlumen.sources.bindings import ad_log

SF = "/root/testdata/sf0.01"


def _totals(spark, mode):
    rep = funnel(ad_log(spark, SF), ["provincename"], mode, money_scale=2)
    return rep.agg(*[F.sum(c).alias(c) for c in rep.columns[1:]]).collect()[0].asDict()


def test_row_count(spark):
    assert ad_log(spark, SF).count() == 60_000


def test_cumulative_totals(spark):
    t = _totals(spark, "cumulative")
    assert (t["ysrequest"], t["yxrequest"], t["adrequest"]) == (17_151, 12_991, 4_567)
    assert (t["cyrequest"], t["cybidsuccess"]) == (10_947, 8_596)
    assert (t["shows"], t["clicks"]) == (17_134, 11_415)
    assert round(t["dspcost"] * 1000, 2) == 568_602_409.21
    assert round(t["dspapy"] * 1000, 2) == 2_686_807_781.81


def test_exclusive_totals(spark):
    t = _totals(spark, "exclusive")
    assert (t["ysrequest"], t["yxrequest"], t["adrequest"]) == (13_143, 8_983, 4_567)
    assert (t["cyrequest"], t["cybidsuccess"]) == (10_947, 4_316)
    assert (t["shows"], t["clicks"]) == (17_134, 11_415)
    assert round(t["dspcost"] * 1000, 2) == 228_588_344.48
    assert round(t["dspapy"] * 1000, 2) == 1_076_304_493.24
