"""Row rules, quarantine and data-quality profile of the staging table.

Rules follow SQL CHECK semantics: a rule fails only when its predicate is FALSE, so
NULL fields pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart.functions.classify import MAX_PORT

# Fixed values: (rule name, error message) of the staging row rules.
RULE_MESSAGES = {
    "chk_port_range_src": "source port out of range 0..65535",
    "chk_port_range_dst": "destination port out of range 0..65535",
    "chk_duration": "negative duration",
    "chk_bytes": "negative bytes",
    "chk_packets": "negative packets",
    "chk_time": "invalid start/end time",
}


def rule_predicates() -> dict[str, Column]:
    c = F.col
    return {
        "chk_port_range_src": c("sport").between(0, MAX_PORT),
        "chk_port_range_dst": c("dsport").between(0, MAX_PORT),
        "chk_duration": c("dur") >= 0,
        "chk_bytes": (c("sbytes") >= 0) & (c("dbytes") >= 0),
        "chk_packets": (c("spkts") >= 0) & (c("dpkts") >= 0),
        "chk_time": (c("stime") >= 0) & (c("ltime") >= 0) & (c("ltime") >= c("stime")),
    }


def row_is_valid() -> Column:
    cond = None
    for pred in rule_predicates().values():
        ok = F.coalesce(pred, F.lit(True))
        cond = ok if cond is None else cond & ok
    return cond


def valid_rows(staging: DataFrame) -> DataFrame:
    """Rows that satisfy every staging rule (the clean staging table)."""
    return staging.filter(row_is_valid())


def rejected_rows(staging: DataFrame) -> DataFrame:
    """Rule-breaking rows with one message per broken rule, joined by '; '."""
    messages = [
        F.when(~F.coalesce(pred, F.lit(True)), F.lit(RULE_MESSAGES[name]))
        for name, pred in rule_predicates().items()
    ]
    return staging.filter(~row_is_valid()).withColumn("error_message", F.concat_ws("; ", *messages))


def quality_profile(staging: DataFrame) -> DataFrame:
    """One-row data-quality profile (12 counters) in one pass."""
    c = F.col

    def n(pred: Column) -> Column:
        return F.count(F.when(pred, 1))

    return staging.agg(
        F.count(F.lit(1)).alias("total_records"),
        n(c("srcip").isNull() | c("dstip").isNull()).alias("missing_ips"),
        n(c("sport").isNull() | c("dsport").isNull()).alias("missing_ports"),
        n(c("proto").isNull()).alias("missing_protocols"),
        n(c("state").isNull()).alias("missing_states"),
        n(c("dur") < 0).alias("negative_durations"),
        n((c("sbytes") < 0) | (c("dbytes") < 0)).alias("negative_bytes"),
        n((c("spkts") < 0) | (c("dpkts") < 0)).alias("negative_packets"),
        n(c("stime") > c("ltime")).alias("invalid_timestamps"),
        F.countDistinct("service").alias("distinct_services"),
        F.countDistinct("attack_cat").alias("distinct_attack_categories"),
        n(~c("label").isin(0, 1)).alias("invalid_labels"),
    )


def fact_measure_rejects(fact_measures: DataFrame) -> DataFrame:
    """staging rows whose measures do not fit the fact's declared types.

    ``duration``/``source_load``/``dest_load`` are NUMERIC(10,3): values that overflow give
    NULL under ``try_cast`` while the source was not NULL.
    """
    checks = []
    for src, name in (("dur", "duration"), ("sload", "source_load"), ("dload", "dest_load")):
        checks.append(F.col(src).isNotNull() & F.col(name).isNull())
    cond = checks[0] | checks[1] | checks[2]
    return fact_measures.filter(cond)
