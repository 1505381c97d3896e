"""The work of a build is spread over tasks, and sorts see distinct rows only."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from flowmart.operators import dims as D
from flowmart.operators.tables import distinct_rows
from flowmart.plans.mart import Mart
from flowmart.sources import fixture
from tests.conftest import row, staging


@pytest.fixture
def events(spark, tmp_path):
    """One file with one row group: 1,000 events, five of them twice, one without any value."""
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(minutes=i), i % 7, "view", i / 8, "{}") for i in range(1000)]
    rows += [*rows[:5], (None,) * 6]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    df.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_one_row_group_is_many_tasks(spark, events, monkeypatch):
    whole = sorted(map(str, fixture.staging_raw(spark, events).collect()))
    monkeypatch.setattr(fixture, "ROWS_PER_TASK", 100)
    dealt = fixture.staging_raw(spark, events)
    assert sorted(map(str, dealt.collect())) == whole and len(whole) == 1006
    sizes = [r[0] for r in dealt.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) > 5 and max(sizes) < 250


def test_staging_is_written_before_the_lookups(spark):
    rows = [row(), row(), row(sport=None, stime=None, service=None), row(dur=-1.0)]
    m = Mart(spark, staging(spark, rows)).build()
    assert all(m.root.split(":")[-1] in f for f in m.raw.inputFiles()) and m.raw.inputFiles()
    assert (m.raw.count(), m.stg.count()) == (4, 3)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_strings_are_minimised_over_distinct_rows(spark):
    """The scan's rows meet a hash aggregate before any sort aggregate."""
    members = _plan(D.dimension_members(staging(spark, [row()])))
    assert re.search(r"HashAggregate\(keys=\[[^]]*facet", members)
    pairs = distinct_rows(spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None)], "k string, s string"))
    assert "HashAggregate" in _plan(pairs.groupBy("k").agg(F.max("s"))), "the optimizer keeps it"
    assert sorted(map(tuple, pairs.collect()), key=str) == sorted([("a", "x"), ("a", None)], key=str)


def test_members_of_null_and_repeated_rows(spark):
    rows = [row(), row(), row(service=None, proto=None, state=None, attack_cat="", label=None, sport=None, stime=None),
            row(proto="tcp", service="dns", label=1, attack_cat="DoS", dsport=1390, stime=3601), row(service="ftp", proto=None)]
    got = {tuple(r) for r in D.dimension_members(staging(spark, rows)).collect()}
    hour = 1421927414 // 3600 * 3600
    assert got == {
        ("service", "dns", None, None, "tcp"), ("service", "ftp", None, None, None),
        ("proto", "udp", None, None, None), ("proto", "tcp", None, None, None),
        ("state", "CON", None, None, None), ("port", None, None, 1390, "dns"), ("port", None, None, 53, "dns"),
        ("attack_cat", "", None, None, None), ("attack_cat", "DoS", None, None, None),
        ("hour", None, None, hour, None), ("hour", None, None, 3600, None),
        ("proto_state", "udp", "CON", None, None), ("proto_state", "tcp", "CON", None, None),
        ("attack_flag", None, None, 0, None), ("attack_flag", "", None, None, None), ("attack_flag", "DoS", None, 1, None),
    }
