import pytest

from adlumen.operators.funnel import funnel
from adlumen.schema import FUNNEL_MEASURES
from log_rows import log_rows

# mode, node, eff, bill, bid, win, order -> exclusive, cumulative
# measure order: ys, yx, ad, cy, succ, cost, pay, shows, clicks (prices 2000 / 1000)
TRUTH = [
    ((1, 1, 0, 0, 0, 0, 0), (1, 0, 0, 0, 0, 0, 0, 0, 0), None),
    ((1, 2, 0, 0, 0, 0, 0), (1, 1, 0, 0, 0, 0, 0, 0, 0), None),
    ((1, 3, 0, 0, 0, 0, 0), (1, 1, 1, 0, 0, 0, 0, 0, 0), None),
    ((1, 4, 0, 0, 0, 0, 0), (0, 0, 0, 0, 0, 0, 0, 0, 0), (1, 1, 0, 0, 0, 0, 0, 0, 0)),
    ((0, 0, 1, 1, 1, 0, 0), (0, 0, 0, 1, 0, 0, 0, 0, 0), None),
    ((0, 0, 1, 1, 1, 1, 9), (0, 0, 0, 1, 0, 0, 0, 0, 0), (0, 0, 0, 1, 1, 2, 1, 0, 0)),
    ((0, 0, 1, 1, 0, 1, 9), (0, 0, 0, 0, 1, 2, 1, 0, 0), None),
    ((0, 0, 1, 1, 0, 1, 0), (0, 0, 0, 0, 0, 0, 0, 0, 0), (0, 0, 0, 0, 0, 2, 1, 0, 0)),
    ((2, 0, 1, 0, 0, 0, 0), (0, 0, 0, 0, 0, 0, 0, 1, 0), None),
    ((3, 0, 1, 0, 0, 0, 0), (0, 0, 0, 0, 0, 0, 0, 0, 1), None),
]
ORDER = ["ysrequest", "yxrequest", "adrequest", "cyrequest", "cybidsuccess",
         "dspcost", "dspapy", "shows", "clicks"]


@pytest.mark.parametrize("mode", ["exclusive", "cumulative"])
@pytest.mark.parametrize("money_scale", [None, 2])
def test_truth_table(spark, mode, money_scale):
    rows = []
    for i, ((m, n, e, b, bid, w, o), _, _) in enumerate(TRUTH):
        rows.append(dict(sessionid=str(i), requestmode=m, processnode=n, iseffective=e,
                         isbilling=b, isbid=bid, iswin=w, adorderid=o, winprice=2000.0,
                         adpayment=1000.0))
    out = {r.sessionid: r for r in funnel(log_rows(spark, rows), ["sessionid"], mode,
                                          money_scale=money_scale).collect()}
    for i, (_, excl, cum) in enumerate(TRUTH):
        want = excl if mode == "exclusive" or cum is None else cum
        got = tuple(out[str(i)][c] for c in ORDER)
        assert got == tuple(float(x) if c in ("dspcost", "dspapy") else x
                            for x, c in zip(want, ORDER)), (i, mode)


def test_columns_and_nulls(spark):
    df = spark.createDataFrame([("a", None, None, None, None, None, None, None, None, None)],
                               "k string, requestmode int, processnode int, iseffective int, "
                               "isbilling int, isbid int, iswin int, adorderid int, "
                               "winprice double, adpayment double")
    r = funnel(df, ["k"], "exclusive").collect()[0]
    assert list(r.asDict()) == ["k"] + FUNNEL_MEASURES
    assert all(r[m] == 0 for m in FUNNEL_MEASURES)


def test_funnel_order_property(spark):
    """adrequest <= yxrequest <= ysrequest in both dialects."""
    import random

    rnd = random.Random(3)
    rows = [dict(sessionid=str(i % 7), requestmode=rnd.randint(0, 3), processnode=rnd.randint(0, 4))
            for i in range(500)]
    df = log_rows(spark, rows)
    for mode in ("exclusive", "cumulative"):
        for r in funnel(df, ["sessionid"], mode).collect():
            assert r.adrequest <= r.yxrequest <= r.ysrequest
