"""The large generated methods stay short enough for the JVM to compile (8000 bytes of code)."""

import pytest
from pyspark.sql import functions as F

from adlumen.functions.geohash import with_geohash
from adlumen.operators.tags import tags_long, weigh_tags
from adlumen.schema import LOG_COLUMNS
from adlumen.sources.bindings import raw_log_lines
from adlumen.sources.logs import count_fields, parse_log, tagged_log
from log_rows import log_rows


def _longest_method(df):
    found = df._jdf.queryExecution().debug().codegenToSeq()
    return max(found.apply(i)._3().maxMethodCodeSize() for i in range(found.length()))


@pytest.fixture
def fixed_plans(spark):
    """Adaptive plans show no code before they have run."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_parsers_are_compiled(spark, tmp_path, fixed_plans):
    spark.createDataFrame([("," * 84,), ("a,b",)], "value string").write.text(str(tmp_path / "t"))
    lines = spark.read.text(str(tmp_path / "t"))
    for df in (parse_log(lines)[0], tagged_log(lines), tagged_log(lines, gather=["provincename", "cityname"])):
        assert _longest_method(df) <= 8000


def test_geohashes_are_compiled(spark, fixed_plans):
    df = with_geohash(spark.range(3).select(F.col("id").cast("double").alias("x")), F.col("x"), F.col("x"))
    assert _longest_method(df) <= 8000


def test_gathered_lines_give_the_same_rows(spark):
    ok = ["s" + "," * 24 + f"P{i % 3},C" + ",x" * 61 for i in range(30)]
    lines = spark.createDataFrame([(x,) for x in [*ok, "bad,line", "", "," * 84]], "value string")
    moved = tagged_log(lines, gather=["provincename", "cityname"])
    assert sorted(map(str, moved.collect())) == sorted(map(str, tagged_log(lines).collect()))
    assert [r[0] for r in lines.select(count_fields(F.col("value"))).collect()] == [
        len(r[0].split(",")) for r in lines.collect()]
    assert moved.columns == ["kind", *LOG_COLUMNS, "line", "n_fields"]


def test_raw_lines_are_not_written(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    def refuse(*a, **k):
        raise AssertionError("written")

    monkeypatch.setattr(DataFrameWriter, "text", refuse)
    assert raw_log_lines(spark, "/root/testdata/sf0.001").columns == ["value"]


@pytest.mark.parametrize("least", [0, 10, 1000])
def test_tags_of_gathered_rows(spark, least):
    rows = [dict(sessionid=str(i), imei="HOT" if i % 3 == 0 else None if i % 7 == 0 else f"i{i % 40}",
                 keywords="alpha|stop|alpha", provincename=f"P{i % 4}") for i in range(240)]
    log = log_rows(spark, rows)
    stop = spark.createDataFrame([("stop",)], "value string")
    plain = tags_long(log, ["imei"], stopwords=stop).groupBy("imei", "tag").agg(F.count(F.lit(1)).alias("weight"))
    out = weigh_tags(log, "imei", least=least, stopwords=stop)
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))


def test_rows_are_shuffled_before_they_are_exploded(spark, fixed_plans):
    log = log_rows(spark, [dict(sessionid="a", imei="i", keywords="alpha")])
    lines = weigh_tags(log, "imei")._jdf.queryExecution().executedPlan().toString().splitlines()
    exchanges = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    explode = next(i for i, x in enumerate(lines) if "Generate explode" in x)
    assert exchanges and all(i > explode for i in exchanges)
