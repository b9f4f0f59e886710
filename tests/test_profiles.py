from adlumen.plans.profiles import person_profiles
from log_rows import log_rows


import pytest


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 1])
def test_rows_sharing_an_id_merge_into_one_person(spark, broadcast_rows):
    rows = [dict(sessionid="A", imei="x", mac="y", adplatformproviderid=1),
            dict(sessionid="B", imei="z", mac="y", adplatformproviderid=1),
            dict(sessionid="C", imei="w", adplatformproviderid=2)]
    out = person_profiles(log_rows(spark, rows), broadcast_rows=broadcast_rows).collect()
    comps = {}
    for r in out:
        comps.setdefault(r.component, {})[r.entry] = r.weight
    assert len(comps) == 2
    big = comps["IM:x"]
    assert {k for k, w in big.items() if w == 0} == {"IM:x", "IM:z", "MC:y"}
    assert big["CN1"] == 2          # each row's tags count once
    assert comps["IM:w"]["CN2"] == 1
