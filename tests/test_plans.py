"""Structural checks on the physical plans of every registered query."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowmart.plans.mart import get_mart
from flowmart.plans.registry import REGISTRY

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def mart(spark):
    return get_mart(spark, SF)


@pytest.mark.parametrize("name", sorted(n for n in REGISTRY if not n.startswith("x1")))
def test_no_cross_join_or_python_in_plan(mart, name):
    plan = _plan(REGISTRY[name](mart))
    assert not [f for f in FORBIDDEN if f in plan], plan


def test_fact_lookups_are_broadcast(mart):
    from flowmart.operators import facts as FX

    df = FX.g2_fact_connection(mart.stg, mart.dim("dim_service"), mart.dim("dim_port"), mart.dim("dim_state"),
                               mart.dim("dim_protocol"), mart.dim("dim_attack"), 1)
    plan = _plan(df)
    assert plan.count("BroadcastHashJoin") == 6 and "SortMergeJoin" not in plan


def test_last_24h_prunes_month_partitions(mart):
    from flowmart.plans import queries_g2 as G2

    plan = _plan(G2.qc2_last_24h_attacks(mart))
    assert "PartitionFilters: [isnotnull(year_month" in plan or "year_month" in plan.split("PartitionFilters")[1][:200]


def test_small_domain_distincts_need_no_expand(mart):
    from flowmart.plans import queries_g1 as G1

    assert "Expand" not in _plan(G1.d4q_top_attacked_services(mart))


def _fact_rows_read(spark, mart, build) -> int:
    """Relations of the connection fact (known by its columns) in the optimised plan of ``build()``."""
    leaves = build()._jdf.queryExecution().optimizedPlan().collectLeaves()
    outputs = [leaves.apply(i).output().mkString(",") for i in range(leaves.size())]
    return sum("source_ttl" in x or ("dest_port_id" in x and "state_id" in x) for x in outputs)


def test_rollups_and_special_facts_scan_the_fact_once(spark, mart):
    from flowmart.operators import rollups as R
    from flowmart.operators import validation as V
    from flowmart.plans import queries_g2 as G2
    from flowmart.plans import queries_ops as O

    scans = lambda build: _fact_rows_read(spark, mart, build)
    assert scans(lambda: R.port_grain(G2.conn(mart))) == 1
    assert scans(lambda: R.port_words(G2.conn(mart), G2.port_grain(mart))) == 1
    assert scans(lambda: R.hourly_base(G2.port_grain(mart), G2.port_words(mart))) == 0
    for derived in (G2.hourly, G2.daily_literal, G2.monthly_literal, G2.daily_declared, G2.monthly_declared, G2.service_stats, G2.port_usage):
        assert scans(lambda f=derived: f(mart)) == 0
    for query in (G2.qm2_attacks_by_hour, G2.qm3_attack_categories):
        assert scans(lambda f=query: f(mart)) == 1
    assert scans(lambda: V.orphan_counts(mart["fact_connection"], O._g2_dims(mart))) == 1
    assert scans(lambda: G2.qd4_security_summary(mart)) == 0


def test_hourly_rollup_has_no_expand_and_no_window(mart):
    from flowmart.operators import rollups as R
    from flowmart.plans import queries_g2 as G2

    conn = G2.conn(mart)
    grain = R.port_grain(conn)
    for df in (R.hourly_base(grain, R.port_words(conn, grain)), R.hourly_traffic(G2.hourly_base(mart)), G2.r2_daily_distinct_ports(mart)):
        plan = _plan(df)
        assert not [x for x in ("Expand", "Window", "Generate") if x in plan], plan


def test_checks_over_facts_scan_the_fact_once(spark, mart):
    from flowmart.plans import queries_ops as O

    for query in (O.v9_coherence, O.v9_incoherence_found, O.v9_business_rules, O.v9_rules_found):
        assert _fact_rows_read(spark, mart, lambda f=query: f(mart)) == 1


def test_percentile_query_scans_the_fact_three_times(mart):
    """The sketch, the counts and the result; subqueries that are used again do not run again."""
    from flowmart.plans import queries_req as Q

    df = Q.p1_duration_anomalies(mart)
    df.collect()
    lines = _plan(df).splitlines()
    assert sum("FileScan parquet" in x and "fact_connection" in x for x in lines) <= 3 or sum("FileScan" in x for x in lines) <= 3


def test_keys_are_numbered_without_one_task_for_all(spark):
    """No window over all rows: only over a kind's range, and over the counts of ranges."""
    from flowmart.operators.keys import dense_keys

    df = spark.range(1000).selectExpr("id % 3 as kind", "id as k")
    plan = _plan(dense_keys(df, "kind", ["k"], {"n": F.lit(True)}))
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert windows and all("kind" in x.split("windowspecdefinition(")[1][:12] for x in windows), plan


def test_range_reads_open_the_met_partitions_only(mart):
    from flowmart.plans import queries_ops as O

    plan = _plan(O.s16_range_read(mart))
    assert "range_name" in plan.split("PartitionFilters")[1][:120]
    assert O.DECLARED.met(1707000000, 1708300000) == ["2024_feb"]
    assert O.DECLARED.met(1708300000, 1710200000) == ["2024_feb", "2024_mar_late", "default"]
