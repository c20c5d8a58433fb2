"""The wide table has a column for every industry and loses no market cap."""

import collections

import pytest
from conftest import DATA

from riskloom.plans import registry
from riskloom.sources import driver_tables


def test_all_industries(spark):
    want = collections.defaultdict(float)
    for r in driver_tables.monthly_panel(spark, DATA).collect():
        if r["market_cap"] is not None:
            want[r["trade_date"], str(r["industry"])] += r["market_cap"]
    wide = registry.queries()["long_to_wide_industries"](spark, DATA)
    got = {(r["trade_date"], c): r[c] for r in wide.collect() for c in wide.columns[1:] if r[c] is not None}
    assert len({c for _, c in want}) > 3 and set(got) == set(want)
    assert got == {k: pytest.approx(v, rel=1e-9, abs=0.01) for k, v in want.items()}
