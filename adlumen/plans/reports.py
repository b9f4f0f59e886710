"""Report plans: row counts and funnels by location or by app."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlumen.functions.strings import is_blank
from adlumen.operators.funnel import MONEY_MEASURES, funnel, row_measures, scaled_sums
from adlumen.operators.lookup import fill_from_dictionary
from adlumen.schema import FUNNEL_MEASURES, UNKNOWN_APP

LOCATION_KEYS = ("provincename", "cityname")


def row_counts(log: DataFrame, keys: Sequence[str] = LOCATION_KEYS) -> DataFrame:
    """Rows per key, column ``cts``."""
    return log.groupBy(*keys).agg(F.count(F.lit(1)).alias("cts"))


def location_report(log: DataFrame, mode: str = "cumulative",
                    keys: Sequence[str] = LOCATION_KEYS,
                    money_scale: int | None = None) -> DataFrame:
    """Nine-measure funnel by province and city."""
    return funnel(log, keys, mode=mode, money_scale=money_scale)


def app_report(log: DataFrame, dictionary: DataFrame, *, default=UNKNOWN_APP,
               mode: str = "exclusive", money_scale: int | None = None) -> DataFrame:
    """Funnel by app name; blank names are looked up by app id first.

    ``default`` is used when the id is not in the dictionary: ``"unknow"``
    (the report's convention), ``F.col("appid")`` or None.
    """
    blank = is_blank(F.col("appname"))
    rows = log.select(F.when(blank, F.lit("")).otherwise(F.col("appname")).alias("appname"),
                      F.when(blank, F.col("appid")).alias("appid"), *row_measures(mode, None, money_scale))
    # sums per name, or per id of unnamed apps, are small: only they meet the
    # dictionary, so no hot app id is ever shuffled row by row
    partial = rows.groupBy("appname", "appid").agg(*[F.sum(m).alias(m) for m in FUNNEL_MEASURES])
    named = fill_from_dictionary(partial, dictionary, default=default)
    return named.groupBy("appname").agg(*scaled_sums(money_scale)).select("appname", *FUNNEL_MEASURES)


def location_report_sql(spark, log: DataFrame, money_scale: int | None = None) -> DataFrame:
    """The cumulative location funnel as SQL text over the rows' contributions.

    The funnel's rules stay in ``operators.funnel``; the text only sums its
    columns by the keys.  No view of the caller's session is touched.
    """
    rows = log.select(*LOCATION_KEYS, *row_measures("cumulative", None, money_scale))
    scale = 1.0 if money_scale is None else 1000.0 * 10 ** money_scale
    keys = ", ".join(LOCATION_KEYS)
    sums = ", ".join(f"cast(sum({m}) as double) / {scale} as {m}" if m in MONEY_MEASURES else f"sum({m}) as {m}"
                     for m in FUNNEL_MEASURES)
    return spark.sql(f"select {keys}, {sums} from {{rows}} group by {keys}", rows=rows)
