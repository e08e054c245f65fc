"""Every registered query against its SQL, as the gate does."""

import pytest

import __spark_entry__ as contract
from pulseframe.catalog import all_queries
from tests.oracle import connect, difference

REGISTERED = all_queries()
WITH_SQL = sorted(n for n, q in REGISTERED.items() if q.sql)
ROWS_ONLY = ("train_protocol", "score_events", "score_samples", "score_stream")


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql(spark, sf, duck, name):
    query = REGISTERED[name]
    got, want = query.spark(spark, sf).toPandas(), duck.execute(query.oracle()).df()
    assert difference(got, want) is None


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_runs(spark, sf, name):
    assert REGISTERED[name].spark(spark, sf).count() > 0


def test_contract(spark):
    assert contract.entry(spark).count() == 100
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(REGISTERED) - set(WITH_SQL) == {
        "train_protocol", "select_variant", "train_on_windows", "score_features", "score_events", "score_batches",
        "score_samples", "scored_metrics", "score_stream"}
