import pytest

from quern.plans import registry
from tests.compare import database, same


@pytest.fixture(scope="module")
def db(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, sf_dir, db, name):
    frame = registry.QUERIES[name](spark, sf_dir)
    assert name in registry.ORACLES
    same(frame, db, registry.ORACLES[name])


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = registry.heatmap_cell_drill(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderpriority)" in plan and "o_totalprice" not in plan
    plan = registry.facet_count_lang(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<lang:string>" in plan


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
