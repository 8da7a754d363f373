"""Every catalog query against its DuckDB oracle, plus plan checks."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF001
from oracle_check import compare, duck
from wirelake.plans.catalog import catalog, oracles

QUERIES = catalog()
ORACLES = oracles()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF001)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "filename" and len(df.columns) == 14
    assert df.count() > 0


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_is_pruned_and_filter_pushed(spark):
    from wirelake.operators.features import feature_table
    from wirelake.sources.tables import packets_events

    # is_udp is event_type = 'purchase': a predicate Parquet can evaluate
    plan = _plan(feature_table(packets_events(spark, SF001).filter("is_udp")))
    # only the four event columns the packet view needs are read
    read_schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "value" not in read_schema and "props" not in read_schema
    assert "event_type" in read_schema
    # the predicate reaches the parquet scan
    assert "PushedFilters: [" in plan and "event_type" in plan[plan.index("PushedFilters"):].split("]")[0]


def test_features_shuffle_key_includes_addresses(spark):
    """The first (big) shuffle of the feature table is keyed by capture and both addresses."""
    plan = _plan(QUERIES["features"](spark, SF001))
    # the deepest aggregation exchange (below it only the key-hash spread of the scan)
    first = plan[plan.rindex("Exchange hashpartitioning(filename"):].split("\n")[0]
    assert "src_ip" in first and "dst_ip" in first


@pytest.mark.parametrize("name", ["line_format", "line_parse", "win_protocol_counts", "stream_win_protocol_counts",
                                  "stream_line_windows", "stream_win_append", "features"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ok, msg = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF001)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert ok, msg
