"""Every registered query against its SQL, and the others by what must hold for them."""

import pytest
from conftest import DATA, same_rows

from riskloom.plans import registry

ORACLE = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, duck, name):
    same_rows(registry.queries()[name](spark, DATA), duck.execute(ORACLE[name]))


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(ORACLE)))
def test_runs(spark, name):
    # The smallest tables have no date with enough securities for ten styles.
    rows = registry.queries()[name](spark, DATA.replace("sf0.001", "sf0.01") if name == "normal_equations_full" else DATA).collect()
    assert rows
    if name == "normal_equations_full":
        assert all(r["residual"] == 0 for r in rows)


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.queries()) <= set(entry.queries())
    flagship = entry.entry(spark)
    assert flagship.columns == ["trade_date", "factor_group", "factor", "value"] and flagship.count() > 0


def test_no_session_needed_to_import():
    import subprocess
    import sys

    from conftest import ROOT

    subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; e.queries(); e.oracle_sql()"], cwd=ROOT, check=True)
