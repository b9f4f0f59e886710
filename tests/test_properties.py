"""Property tests: results do not depend on how the input is partitioned, and
tag weight is conserved from rows to profiles."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlumen.operators.funnel import funnel
from adlumen.operators.tags import merge_tags, row_tags
from adlumen.plans.profiles import person_profiles
from log_rows import log_rows

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

row = st.fixed_dictionaries({
    "provincename": st.sampled_from(["P1", "P2", " "]),
    "requestmode": st.integers(0, 3), "processnode": st.integers(0, 4),
    "iseffective": st.integers(0, 1), "isbilling": st.integers(0, 1),
    "isbid": st.integers(0, 1), "iswin": st.integers(0, 1), "adorderid": st.integers(0, 2),
    "winprice": st.integers(0, 10**7).map(lambda c: c / 100),
    "adpayment": st.integers(0, 10**7).map(lambda c: c / 100),
    "imei": st.sampled_from(["", "a", "b", "c"]), "mac": st.sampled_from(["", "m1", "m2", " "]),
    "adplatformproviderid": st.integers(0, 3), "client": st.integers(0, 4),
})


def _rows(spark, rows):
    return log_rows(spark, [dict(r, sessionid=str(i)) for i, r in enumerate(rows)])


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=40), parts=st.integers(1, 7))
def test_exact_funnel_is_partitioning_independent(spark, rows, parts):
    df = _rows(spark, rows)
    for mode in ("cumulative", "exclusive"):
        a = sorted(funnel(df.coalesce(1), ["provincename"], mode, money_scale=2).collect())
        b = sorted(funnel(df.repartition(parts), ["provincename"], mode, money_scale=2).collect())
        assert a == b


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=40), parts=st.integers(1, 7))
def test_merge_tags_is_partitioning_independent(spark, rows, parts):
    df = _rows(spark, rows).withColumn("user_id", F.col("imei"))
    long = df.select("user_id", F.explode(row_tags(dict_name=None)).alias("tag"))
    a = sorted(merge_tags(long.coalesce(1)).collect())
    b = sorted(merge_tags(long.repartition(parts, "tag")).collect())
    assert a == b


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=30))
def test_person_profiles_conserve_tag_weight(spark, rows):
    df = _rows(spark, rows)
    prof = person_profiles(df)
    got = prof.where(F.col("weight") > 0).agg(F.sum("weight")).collect()[0][0] or 0
    usable = df.where((F.col("imei") != "") | ((F.col("mac") != "") & (F.col("mac") != " ")))
    keywords_free = usable.select(F.size(row_tags(dict_name=None)).alias("n"))
    want = keywords_free.agg(F.sum("n")).collect()[0][0] or 0
    assert got == want
    # every id of a row ends up in exactly one person
    ids = prof.where(F.col("weight") == 0).groupBy("entry").count().where("count > 1").count()
    assert ids == 0
