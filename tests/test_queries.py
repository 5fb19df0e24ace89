import pytest

import __spark_entry__ as driver
from oracle import compare, connect
from tuplefeed.plans.oracles import all_oracles
from tuplefeed.plans.queries import all_queries

QUERIES = all_queries()
ORACLES = all_oracles()
EAGER = ("stream_",)  # these run streams and read what they wrote


@pytest.fixture(scope="module")
def tables(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_oracle(spark, sf_dir, tables, name):
    assert compare(QUERIES[name](spark, sf_dir), tables, ORACLES[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_driver_has_every_query():
    assert QUERIES.items() <= driver.queries().items()
    assert ORACLES.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(EAGER)])
def test_plans_stay_on_the_jvm_and_pair_no_rows(spark, sf_dir, name):
    physical = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas", "REPARTITION_BY_NUM"):
        assert bad not in physical


def test_results_do_not_depend_on_the_session_time_zone(spark, sf_dir, tables):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert compare(QUERIES["parse_event"](spark, sf_dir), tables, ORACLES["parse_event"]) is None
