"""Dictionary fill (J1-J3) against a Python model of the rules."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlumen.operators.lookup import fill_from_dictionary

NAMES = ["", " ", "\t", "Video", "News", None]
IDS = ["a", "b", "c", "", None]
DICT = {"a": "AppA", "b": "AppB"}


def _blank(s):
    return s is None or s.strip(" \t\n\r\x0b\x0c") == ""


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(NAMES), st.sampled_from(IDS)), min_size=1, max_size=30),
       bound=st.sampled_from([0, 1_000_000]))
def test_fill_matches_model(spark, rows, bound):
    df = spark.createDataFrame([(str(i), n, a) for i, (n, a) in enumerate(rows)],
                               "sessionid string, appname string, appid string")
    d = spark.createDataFrame(list(DICT.items()), "key string, value string")
    for default, model_default in (("unknow", lambda a: "unknow"), (F.col("appid"), lambda a: a),
                                   (None, lambda a: None)):
        got = dict(fill_from_dictionary(df, d, default=default, broadcast_rows=bound)
                   .select("sessionid", "appname").collect())
        for i, (n, a) in enumerate(rows):
            want = n if not _blank(n) else DICT.get(a, model_default(a))
            assert got[str(i)] == want, (n, a, default)
