"""Metamorphic checks on the sf0.001 mart, the exact percentile, SCD-2 and the stream."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowmart.operators import scd
from flowmart.plans import queries_g1 as G1
from flowmart.plans import queries_g2 as G2
from flowmart.plans import queries_ops as O
from flowmart.plans.mart import get_mart
from flowmart.operators.sinks import Audit, insert_if_absent, latest_batch
from flowmart.plans.mart import Mart
from flowmart.plans import quantiles
from flowmart.plans.quantiles import above_percentile
from flowmart.sources.fixture import staging_raw
from flowmart.streaming import hourly as X

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def mart(spark):
    return get_mart(spark, SF)


def test_hourly_rollup_sums_to_fact(mart):
    total = mart["fact_connection"].count()
    assert G2.hourly(mart).agg(F.sum("total_connections")).first()[0] == total
    assert G2.daily_declared(mart).agg(F.sum("total_connections")).first()[0] == total
    assert G2.monthly_declared(mart).agg(F.sum("total_connections")).first()[0] == total


def test_normal_plus_attack_is_total(mart):
    for df, cols in ((G2.port_usage(mart), ("total_usage", "normal_usage", "attack_usage")),
                     (G2.hourly(mart), ("total_connections", "normal_connections", "attack_connections"))):
        t, n, a = (F.col(c) for c in cols)
        assert df.filter(t != n + a).count() == 0


def test_port_usage_dates_ordered(mart):
    assert G2.port_usage(mart).filter(F.col("first_seen") > F.col("last_seen")).count() == 0


def test_grouping_sets_equal_union_of_groupbys(mart):
    f = G1.fact(mart, "service", "attack", "time").filter("is_attack")
    union = None
    for unit in ("hour", "day", "month"):
        g = f.groupBy("service_name", unit).agg(F.count(F.lit(1)).alias("n")).select(
            "service_name", F.lit(unit).alias("u"), F.col(unit).alias("v"), "n")
        union = g if union is None else union.unionByName(g)
    gs = G1.a4_attacks_by_time(mart).select(
        "service_name", F.col("grouping_type").alias("u"), F.coalesce("hour", "day", "month").alias("v"),
        F.col("total_attacks").alias("n"))
    assert gs.exceptAll(union).count() == 0 and union.exceptAll(gs).count() == 0


def test_qd4_weighting_equals_literal_fan_out(mart):
    """The weighted formula equals the literal LEFT JOIN fan-out (brute force, tiny data)."""
    f = mart["fact_connection"].join(mart["dim_attack"].select("attack_id", "is_attack"), "attack_id")
    pu = G2.port_usage(mart).select("service_id", "time_id", "port_id", "exclusive_to_attacks")
    brute = f.join(pu, ["service_id", "time_id"], "left").agg(
        F.round(100.0 * F.count(F.when(F.col("is_attack"), 1)) / F.count(F.lit(1)), 2).alias("p")
    ).first().p
    assert G2.qd4_security_summary(mart).first().overall_attack_percentage == brute


@pytest.mark.parametrize("seed,whole", [(1, 10**6), (1, 0), (2, 0), (3, 10**6), (3, 0)])
def test_above_percentile_matches_numpy(spark, seed, whole, monkeypatch):
    """The bound is the next thousandth above the interpolated percentile, for spread values, heavy
    ties and a mass at both ends; null without values."""
    monkeypatch.setattr(quantiles, "WHOLE", whole)
    if not whole:  # a coarse sketch, whose bracket is a small part of the values
        monkeypatch.setattr(quantiles, "ACCURACY", 100)
    rng = random.Random(seed)
    pools = [lambda: rng.randrange(9_999_999_999), lambda: rng.choice((5000, 7250, rng.randrange(10**6))), lambda: rng.choice((0, 0, 9_999_999_999, 9_999_999_999, rng.randrange(300)))]
    vals = [pools[seed - 1]() for _ in range(2000 + seed)]
    df = spark.createDataFrame([(v,) for v in vals], "v long").select((F.col("v") / 1000).cast("decimal(10,3)").alias("x"))
    for p in (0, 50, 95, 100):
        got = spark.range(1).select(above_percentile(df, "x", p).alias("b")).first().b
        s, h = sorted(vals), p * (len(vals) - 1)
        lo, hi = s[h // 100], s[min(len(s) - 1, -(-h // 100))]
        exact = lo * 100 + (h % 100) * (hi - lo)
        assert got is None and exact // 100 + 1 > 9_999_999_999 or int(got * 1000) == exact // 100 + 1
    assert spark.range(1).select(above_percentile(df.limit(0), "x", 95).alias("b")).first().b is None


def test_scd2_merge_and_point_in_time(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 1)
    cur = spark.createDataFrame(
        [("dns", "udp", True, t0, None, 1), ("ssh", "tcp", True, t0, None, 1), ("ftp", "tcp", True, t0, None, 1)],
        "name string, protocol string, is_active boolean, valid_from timestamp, valid_to timestamp, version int",
    )
    snap = spark.createDataFrame([("dns", "tcp"), ("ssh", "tcp"), ("smtp", "tcp")], "name string, protocol string")
    out = scd.scd2_merge(cur, snap, "name", ["protocol"], t1)
    rows = {(r.name, r.version): r for r in out.collect()}
    assert rows[("dns", 1)].is_active is False and rows[("dns", 1)].valid_to == t1
    assert rows[("dns", 2)].protocol == "tcp" and rows[("dns", 2)].is_active
    assert rows[("ssh", 1)].is_active and ("ssh", 2) not in rows
    assert rows[("smtp", 1)].valid_from == t1 and rows[("ftp", 1)].is_active
    feb = {r.name: r.protocol for r in scd.as_of(out, dt.datetime(2024, 2, 1)).collect()}
    apr = {r.name: r.protocol for r in scd.as_of(out, dt.datetime(2024, 4, 1)).collect()}
    assert feb == {"dns": "udp", "ssh": "tcp", "ftp": "tcp"}
    assert apr == {"dns": "tcp", "ssh": "tcp", "ftp": "tcp", "smtp": "tcp"}


def test_stream_counts_equal_batch_hourly(spark, mart):
    out = O.x1_stream_hourly_rollup(mart)
    batch = G2.r1_hourly_traffic(mart).select(
        F.col("time_id").alias("window_start"), "service_name", "protocol_name", "attack_category", "total_connections"
    )
    stream = out.select("window_start", "service_name", "protocol_name", "attack_category", "total_connections")
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def _rollup(spark, events, tmp_path, name, **kwargs):
    sink, ckpt = str(tmp_path / f"sink-{name}"), str(tmp_path / f"ckpt-{name}")
    X.start(spark, events, sink, ckpt, **kwargs).awaitTermination()
    return sink, ckpt


def test_stream_is_exact_for_any_layout_and_batches(spark, mart, tmp_path):
    """A folder of files, one file per micro-batch in any order: the same rows as the batch mart."""
    events = str(tmp_path / "events.parquet")
    spark.read.parquet(f"{SF}/events.parquet").repartition(4).write.parquet(events)
    batch = G2.r1_hourly_traffic(mart).select(
        F.col("time_id").alias("window_start"), "service_name", "protocol_name", "attack_category", "total_connections"
    )
    for n in (None, 1):
        sink, ckpt = _rollup(spark, events, tmp_path, str(n), max_files_per_trigger=n)
        out = X.rollup(spark, sink).select(*batch.columns)
        assert out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0
    batches = spark.read.parquet(sink).select("batch_id").distinct().count()
    assert batches == 4
    X.start(spark, events, sink, ckpt, max_files_per_trigger=1).awaitTermination()  # nothing new
    assert X.rollup(spark, sink).agg(F.sum("total_connections")).first()[0] == batch.agg(F.sum("total_connections")).first()[0]
    spark.read.parquet(f"{SF}/events.parquet").limit(10).write.mode("append").parquet(events)
    X.start(spark, events, sink, ckpt).awaitTermination()  # a late file adds its rows
    assert X.rollup(spark, sink).agg(F.sum("total_connections")).first()[0] > batch.agg(F.sum("total_connections")).first()[0]


def test_missing_sink_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        X.rollup(spark, str(tmp_path / "none")).count()


def test_audit_trail(spark, tmp_path):
    """STARTED rows first, whole messages, ids that go on after a restart, and a failing level that
    leaves the finished ones COMPLETED and the rest FAILED."""
    path = str(tmp_path / "audit")
    audit = Audit(spark, path)
    audit.run("RAW", lambda batch_id: 5)
    message = "x" * 2000

    def fail(batch_id):
        raise RuntimeError(message)

    with pytest.raises(RuntimeError):
        Audit(spark, path).run_all([("HOURLY", lambda b: 7), ("DAILY", fail), ("MONTHLY", lambda b: 9)])
    rows = {r.batch_id: r for r in audit.table().collect()}
    assert [(i, rows[i].status, rows[i].records_processed) for i in sorted(rows)] == [(1, "COMPLETED", 5), (2, "COMPLETED", 7), (3, "FAILED", None), (4, "FAILED", None)]
    assert rows[3].error_message == message
    assert audit.events().filter("status = 'STARTED'").count() == 4
    batch_id, _ = Audit(spark, path).start("RAW")  # the driver dies here
    assert batch_id == 5 and {r.batch_id: r.status for r in audit.table().collect()}[5] == "STARTED"
    assert latest_batch(audit.table()).first().batch_id == 5


def test_insert_if_absent_numbers_new_members(spark):
    old = spark.createDataFrame([(0, 0, "U"), (1, 80, "a"), (2, 443, "b")], "id int, port int, s string")
    new = spark.createDataFrame([(9, 80, "z"), (1, 22, "y"), (2, 22, "x"), (2, 25, "w")], "id int, port int, s string")
    got = sorted(tuple(r) for r in insert_if_absent(new, old, ["port"], id_col="id").collect())
    assert got == [(0, 0, "U"), (1, 80, "a"), (2, 443, "b"), (3, 22, "x"), (4, 25, "w")]


def test_windowed_refresh_replaces_only_the_window(spark):
    """After the stored base was damaged, refreshing a window mends the window and nothing else, and a
    second refresh changes nothing."""
    m = Mart(spark, staging_raw(spark, SF)).build()
    want = [tuple(r) for r in G2.hourly_base(m).orderBy("time_id", "service_id", "protocol_id", "attack_id").select("time_id", "n").collect()]
    damaged = G2.hourly_base(m).withColumn("n", F.col("n") + 100)
    m.rewrite("hourly_base", damaged.withColumn("year_month", F.date_format(F.timestamp_seconds("time_id"), "yyyy-MM")), ["year_month"])
    t0, t1 = G2.WINDOW
    for _ in range(2):
        G2.refresh_rollups(m, t0, t1)
        got = [tuple(r) for r in G2.hourly_base(m).orderBy("time_id", "service_id", "protocol_id", "attack_id").select("time_id", "n").collect()]
        assert got == [(t, n if t0 <= t <= t1 else n + 100) for t, n in want]
        assert any(t0 <= t <= t1 for t, _ in want) and any(t < t0 for t, _ in want)
