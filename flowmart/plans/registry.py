"""Registry of named queries: ``name -> f(mart) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowmart.plans import queries_g1 as G1
from flowmart.plans import queries_g2 as G2
from flowmart.plans import queries_req as Q
from flowmart.plans import queries_ops as O
from flowmart.plans.mart import Mart, get_mart

MartQuery = Callable[[Mart], DataFrame]

REGISTRY: dict[str, MartQuery] = {
    # simple generation
    "a1_service_ranking": G1.a1_service_ranking,
    "a2_attack_categories": G1.a2_attack_categories,
    "a3_attack_share": G1.a3_attack_share,
    "a4_attacks_by_time": G1.a4_attacks_by_time,
    "b1_normal_totals": G1.b1_normal_totals,
    "b2_normal_duration": G1.b2_normal_duration,
    "b3_top_normal_ports": G1.b3_top_normal_ports,
    "b4_normal_by_time": G1.b4_normal_by_time,
    "c1_attack_bytes": G1.c1_attack_bytes,
    "c2_attack_duration": G1.c2_attack_duration,
    "c3_top_attack_ports": G1.c3_top_attack_ports,
    "c4_attacks_by_time": G1.c4_attacks_by_time,
    "d1q_compare_literal": G1.d1q_compare_literal,
    "d2q_duration_ratio": G1.d2q_duration_ratio,
    "d3q_attack_only_ports": G1.d3q_attack_only_ports,
    "d4q_top_attacked_services": G1.d4q_top_attacked_services,
    "r5_hourly_service_stats": G1.r5_hourly_service_stats,
    "r6_daily_traffic": G1.r6_daily_traffic,
    "r7_weekly_traffic": G1.r7_weekly_traffic,
    # mart generation
    "d1_calendar": G2.d1_calendar,
    "d2_dim_time": G2.d2_dim_time,
    "d3_dim_service": G2.d3_dim_service,
    "d4_dim_protocol": G2.d4_dim_protocol,
    "d5_dim_state": G2.d5_dim_state,
    "d6_dim_port": G2.d6_dim_port,
    "d7_dim_attack": G2.d7_dim_attack,
    "d9_dimension_counts": G2.d9_dimension_counts,
    "e1_dim_time": G2.e1_dim_time,
    "e2_dim_service": G2.e2_dim_service,
    "e3_dim_protocol": G2.e3_dim_protocol,
    "e4_dim_location": G2.e4_dim_location,
    "e5_dim_attack_category": G2.e5_dim_attack_category,
    "e6_dim_attack": G2.e6_dim_attack,
    "f1_fact_connections": G2.f1_fact_connections,
    "f3_fact_connection": G2.f3_fact_connection,
    "r1_hourly_traffic": G2.r1_hourly_traffic,
    "r2_daily_traffic_literal": G2.r2_daily_traffic_literal,
    "r2i_daily_traffic": G2.r2i_daily_traffic,
    "r3_monthly_traffic_literal": G2.r3_monthly_traffic_literal,
    "r3i_monthly_traffic": G2.r3i_monthly_traffic,
    "r1_hourly_window": G2.r1_hourly_window,
    "r2_daily_window": G2.r2_daily_window,
    "r3_monthly_window": G2.r3_monthly_window,
    "r2_daily_distinct_ports": G2.r2_daily_distinct_ports,
    "r3_monthly_distinct_ports": G2.r3_monthly_distinct_ports,
    "r1_window_distinct_ports": G2.r1_window_distinct_ports,
    "r4_aggregate_facts": G2.r4_aggregate_facts,
    "f6_service_stats": G2.f6_service_stats,
    "f7_port_usage": G2.f7_port_usage,
    "r8_hourly_service_performance": G2.r8_hourly_service_performance,
    "r9_daily_attack_patterns": G2.r9_daily_attack_patterns,
    "r10_service_risk_profile": G2.r10_service_risk_profile,
    "r11_port_security_analysis": G2.r11_port_security_analysis,
    "h0_last_24h": G2.h0_last_24h,
    "qa1_service_ranking": G2.qa1_service_ranking,
    "qa2_attack_stats": G2.qa2_attack_stats,
    "qa3_last_24h_volume": G2.qa3_last_24h_volume,
    "qb1_last_24h_normal": G2.qb1_last_24h_normal,
    "qb2_port_usage_attacked": G2.qb2_port_usage_attacked,
    "qb3_last_24h_by_hour": G2.qb3_last_24h_by_hour,
    "qc1_attack_type_distribution": G2.qc1_attack_type_distribution,
    "qc2_last_24h_attacks": G2.qc2_last_24h_attacks,
    "qc3_service_protocol_attack": G2.qc3_service_protocol_attack,
    "qd1_latest_comparison": G2.qd1_latest_comparison,
    "qd2_service_risk_report": G2.qd2_service_risk_report,
    "qd3_port_usage_report": G2.qd3_port_usage_report,
    "qd4_security_summary": G2.qd4_security_summary,
    "qd4_security_summary_fixed": G2.qd4_security_summary_fixed,
    "qm1_top5_attack_share": G2.qm1_top5_attack_share,
    "qm2_attacks_by_hour": G2.qm2_attacks_by_hour,
    "qm3_attack_categories": G2.qm3_attack_categories,
    "qm4_mart_summary": G2.qm4_mart_summary,
    # documents and requirements
    "p1_duration_anomalies": Q.p1_duration_anomalies,
    "p2_hourly_load_profile": Q.p2_hourly_load_profile,
    "p3_service_protocol_attack_counts": Q.p3_service_protocol_attack_counts,
    "p4_monthly_trend": Q.p4_monthly_trend,
    "p5_attacks_per_service": Q.p5_attacks_per_service,
    "p6_mean_hourly_connections": Q.p6_mean_hourly_connections,
    "k1_by_day_of_week": Q.k1_by_day_of_week,
    "k2_bytes_by_service_category": Q.k2_bytes_by_service_category,
    "k3_duration_by_category_service": Q.k3_duration_by_category_service,
    "k4_top_ports_per_category": Q.k4_top_ports_per_category,
    "k5_attacks_by_category_time": Q.k5_attacks_by_category_time,
    "k6_compare_by_unit": Q.k6_compare_by_unit,
    "k7_duration_by_unit": Q.k7_duration_by_unit,
    "k8_exclusive_ports_per_service": Q.k8_exclusive_ports_per_service,
    "k9_top5_service_summary": Q.k9_top5_service_summary,
    "k10_service_protocol_matrix": Q.k10_service_protocol_matrix,
    "k10_port_service_matrix": Q.k10_port_service_matrix,
    "k10_attack_service_matrix": Q.k10_attack_service_matrix,
    "k10_service_protocol_pivot": Q.k10_service_protocol_pivot,
    "k11_derived_metrics": Q.k11_derived_metrics,
    "k12_monthly_trend_changes": Q.k12_monthly_trend_changes,
    "k13_first_seen_threats": Q.k13_first_seen_threats,
    "k14_protocol_safety": Q.k14_protocol_safety,
    "k15_overload_hours": Q.k15_overload_hours,
    # load, sinks, validation, versioning, streaming
    "e7_attack_flag_facts": O.e7_attack_flag_facts,
    "f5_measure_rejects": O.f5_measure_rejects,
    "s1_csv_with_header": O.s1_csv_with_header,
    "s3_parse_raw_lines": O.s3_parse_raw_lines,
    "s2_line_numbers": O.s2_line_numbers,
    "s8_load_errors": O.s8_load_errors,
    "s7_rejected_rows": O.s7_rejected_rows,
    "s9_quality_profile": O.s9_quality_profile,
    "s11_staging_counts": O.s11_staging_counts,
    "s12_valid_sample": O.s12_valid_sample,
    "s13_distinct_sample": O.s13_distinct_sample,
    "s14_merge_ports": O.s14_merge_ports,
    "s17_partition_counts": O.s17_partition_counts,
    "s20_window_source_count": O.s20_window_source_count,
    "s21_fact_counts": O.s21_fact_counts,
    "v3_orphan_checks": O.v3_orphan_checks,
    "v5_orphan_matrix": O.v5_orphan_matrix,
    "v6_active_service_facts": O.v6_active_service_facts,
    "v8_key_violations": O.v8_key_violations,
    "v9_business_rules": O.v9_business_rules,
    "v3_orphans_found": O.v3_orphans_found,
    "v5_orphans_found": O.v5_orphans_found,
    "v6_inactive_removed": O.v6_inactive_removed,
    "v8_declared_checks": O.v8_declared_checks,
    "v8_checks_found": O.v8_checks_found,
    "v8_duplicates_found": O.v8_duplicates_found,
    "v9_coherence": O.v9_coherence,
    "v9_incoherence_found": O.v9_incoherence_found,
    "v9_rules_found": O.v9_rules_found,
    "f4_appended_fact": O.f4_appended_fact,
    "f4_appended_simple_fact": O.f4_appended_simple_fact,
    "f4_appended_hourly": O.f4_appended_hourly,
    "s16_declared_partitions": O.s16_declared_partitions,
    "s16_range_read": O.s16_range_read,
    "s16_range_read_default": O.s16_range_read_default,
    "d10_facts_as_of": O.d10_facts_as_of,
    "f5_overflow_found": O.f5_overflow_found,
    "d10_scd2_port": O.d10_scd2_port,
    "d10_ports_as_of": O.d10_ports_as_of,
    "d10_scd2_service": O.d10_scd2_service,
    "r12_refresh_views": O.r12_refresh_views,
    "x1_stream_hourly_rollup": O.x1_stream_hourly_rollup,
    "x1_compacted_rollup": O.x1_compacted_rollup,
}


def bind(fn: MartQuery) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(get_mart(spark, sf_dir))

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: bind(fn) for name, fn in REGISTRY.items()}
