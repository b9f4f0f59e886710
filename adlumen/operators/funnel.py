"""Nine-measure ad funnel (requests -> bids -> impressions/clicks -> cost).

Two dialects exist in the log's reporting history and both are supported:

* ``cumulative`` -- the SQL report: a request at node >= 1 / >= 2 counts as
  original / valid request; bids and wins are counted independently; cost is
  summed for every effective, billed, won row.
* ``exclusive`` -- the per-row vector report: node must be exactly 1, 2 or 3;
  a row that is a bid is not also counted as a win; win and cost need a
  non-zero order id.

Each measure is one scalar ``sum(when(...))``, so Spark plans a partial
(map-side) hash aggregate, one exchange on the group keys and a final
aggregate: a hot group key costs nothing extra because each task pre-sums it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlumen.schema import FUNNEL_MEASURES

MODES = ("cumulative", "exclusive")
MONEY_MEASURES = ("dspcost", "dspapy")

_DEFAULT_COLS = {
    "requestmode": "requestmode", "processnode": "processnode",
    "iseffective": "iseffective", "isbilling": "isbilling", "isbid": "isbid",
    "iswin": "iswin", "adorderid": "adorderid", "winprice": "winprice",
    "adpayment": "adpayment",
}


def _ints(colmap: Mapping[str, str] | None) -> dict[str, Column]:
    names = dict(_DEFAULT_COLS)
    names.update(colmap or {})
    out = {}
    for k, v in names.items():
        if k in ("winprice", "adpayment"):
            out[k] = F.col(v)
        else:
            # a missing flag reads as 0, the log format's default
            out[k] = F.coalesce(F.col(v), F.lit(0))
    return out


def contributions(mode: str = "cumulative",
                  colmap: Mapping[str, str] | None = None) -> dict[str, tuple[Column, Column | None]]:
    """Per-row funnel contribution: measure -> (condition, value or None for 1)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    c = _ints(colmap)
    rm, node = c["requestmode"], c["processnode"]
    eff_bill = (c["iseffective"] == 1) & (c["isbilling"] == 1)
    bid = eff_bill & (c["isbid"] == 1)
    if mode == "cumulative":
        ys = (rm == 1) & (node >= 1)
        yx = (rm == 1) & (node >= 2)
        won = eff_bill & (c["iswin"] == 1)
        success = won & (c["adorderid"] != 0)
        paid = won
    else:
        ys = (rm == 1) & node.isin(1, 2, 3)
        yx = (rm == 1) & node.isin(2, 3)
        success = ~bid & eff_bill & (c["iswin"] == 1) & (c["adorderid"] != 0)
        paid = success
    ad = (rm == 1) & (node == 3)
    shows = (rm == 2) & (c["iseffective"] == 1)
    clicks = (rm == 3) & (c["iseffective"] == 1)
    return {
        "ysrequest": (ys, None), "yxrequest": (yx, None), "adrequest": (ad, None),
        "cyrequest": (bid, None), "cybidsuccess": (success, None),
        "shows": (shows, None), "clicks": (clicks, None),
        "dspcost": (paid, c["winprice"]), "dspapy": (paid, c["adpayment"]),
    }


def funnel_aggregates(mode: str = "cumulative", colmap: Mapping[str, str] | None = None,
                      money_scale: int | None = None) -> list[Column]:
    """The nine aggregate expressions, aliased with the measure names.

    Money is reported in thousands (prices are per mille).  With
    ``money_scale=None`` it is summed as doubles, like the log's own reports;
    ``money_scale=k`` rounds each price to k decimals and sums exact integers,
    which is order-independent (the same result for any partitioning) and
    overflow-checked under ANSI mode.
    """
    aggs = []
    for name, (cond, value) in contributions(mode, colmap).items():
        if value is None:
            aggs.append(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).alias(name))
        elif money_scale is None:
            aggs.append(F.sum(F.when(cond, value / F.lit(1000.0)).otherwise(F.lit(0.0))).alias(name))
        else:
            unit = 10 ** money_scale
            units = F.round(value * F.lit(float(unit))).cast("long")
            total = F.sum(F.when(cond, units).otherwise(F.lit(0).cast("long")))
            aggs.append((total.cast("double") / F.lit(1000.0 * unit)).alias(name))
    return aggs


def row_measures(mode: str = "cumulative", colmap: Mapping[str, str] | None = None,
                 money_scale: int | None = None) -> list[Column]:
    """The nine contributions of a row as columns to be summed.

    Money is in units of 10^-money_scale (exact integers), or thousands as
    doubles with ``money_scale=None``; ``scaled_sums`` sums and scales them.
    """
    out = []
    for name, (cond, value) in contributions(mode, colmap).items():
        if value is None:
            v, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        elif money_scale is None:
            v, zero = value / F.lit(1000.0), F.lit(0.0)
        else:
            v, zero = F.round(value * F.lit(float(10 ** money_scale))).cast("long"), F.lit(0).cast("long")
        out.append(F.when(cond, v).otherwise(zero).alias(name))
    return out


def scaled_sums(money_scale: int | None = None) -> list[Column]:
    """Sums of ``row_measures`` columns (or of their partial sums), money in thousands."""
    out = []
    for name in FUNNEL_MEASURES:
        total = F.sum(name)
        if name in MONEY_MEASURES and money_scale is not None:
            total = total.cast("double") / F.lit(1000.0 * 10 ** money_scale)
        out.append(total.alias(name))
    return out


def funnel(df: DataFrame, keys: Sequence[str], mode: str = "cumulative",
           colmap: Mapping[str, str] | None = None,
           money_scale: int | None = None) -> DataFrame:
    """Group ``df`` by ``keys`` and compute the nine funnel measures."""
    out = df.groupBy(*keys).agg(*funnel_aggregates(mode, colmap, money_scale))
    return out.select(*keys, *FUNNEL_MEASURES)
