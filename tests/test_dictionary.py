from adlumen.sources.dictionary import parse_app_dictionary

LINES = [
    "1\tVideo\tx\ty\tcom.a",
    "1\tVideo\tx\ty\tcom.a\tz",
    "1\tNews\tx\ty\t",
    "1\tNews\tx",
    "2\tAlpha\tx\ty\tcom.b",
    "3\tBeta\tx\ty\tcom.b",
]


def _dict(spark, strict):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    return {r.key: r.value for r in parse_app_dictionary(df, strict=strict).collect()}


def test_lenient(spark):
    assert _dict(spark, False) == {"com.a": "Video", "": "News", "com.b": "Alpha"}


def test_strict(spark):
    assert _dict(spark, True) == {"com.a": "Video", "com.b": "Alpha"}
