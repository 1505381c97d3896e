"""What changes over time: appended batches, refreshes by month, versions at a fact's own time, declared
ranges, compaction, claims and commits."""

from __future__ import annotations

import datetime as dt
import json
import threading

import pytest
from pyspark.sql import functions as F

from flowmart.operators import commits, scd, temporal
from flowmart.operators import validation as V
from flowmart.operators.keys import dense_keys
from flowmart.operators.sinks import Audit, RangePartitions
from flowmart.plans import queries_g1 as G1
from flowmart.plans import queries_g2 as G2
from flowmart.plans import queries_ops as O
from flowmart.plans import queries_req as Q
from flowmart.plans.batches import BatchedMart
from flowmart.plans.mart import DERIVED, Mart, dependants
from flowmart.sources.fixture import staging_raw
from flowmart.streaming import hourly as X
from tests.conftest import row, staging

SF = "/root/testdata/sf0.001"
JAN, FEB, MAR = 1704110400, 1706788800, 1709294400  # noon of the first day of the month


def same(a, b) -> bool:
    a = a.select(*b.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# ---- appended batches ---------------------------------------------------------------------

def _batch(spark, when, services, n=6):
    return staging(spark, [row(service=s, stime=when + 3600 * i, ltime=when + 3600 * i, sport=1024 + i, dsport=80 + i) for s in services for i in range(n)])


def test_appended_batches_equal_one_build(spark):
    parts = [_batch(spark, JAN, ["dns", "http"]), _batch(spark, FEB, ["dns", "ssh", None]), _batch(spark, FEB, ["ftp"])]
    m = BatchedMart(spark)
    for i, p in enumerate(parts):
        assert m.append(p, f"b{i}") == p.count()
    one = Mart(spark, parts[0].unionByName(parts[1]).unionByName(parts[2])).build()
    for query in (G2.f3_fact_connection, G2.f1_fact_connections, G2.r1_hourly_traffic, G2.r2i_daily_traffic, G2.f7_port_usage, G2.qa1_service_ranking, G1.r6_daily_traffic, G2.r3_monthly_distinct_ports):
        assert same(query(m), query(one)), query.__name__
    assert m["fact_connection"].select("connection_id").distinct().count() == m["fact_connection"].count()
    assert set(O.v3_orphan_checks(m).select("orphan_count").distinct().toPandas()["orphan_count"]) == {0}


def test_replay_changes_nothing_and_a_correction_only_its_rows(spark):
    m = BatchedMart(spark)
    m.append(_batch(spark, JAN, ["dns", "http"]), "a")
    m.append(_batch(spark, FEB, ["ssh"]), "b")
    members = {tuple(r) for r in m["members"].collect()}
    files = lambda: sorted(f for f in m["fact_connection"].inputFiles() if "load=a-" in f)
    first = files()
    before = G2.f3_fact_connection(m).toPandas()
    m.append(_batch(spark, FEB, ["ssh"]), "b")
    assert {tuple(r) for r in m["members"].collect()} == members, "members keep their ids"
    assert files() == first and first, "the other batch keeps its files"
    assert sorted(map(str, before.itertuples(index=False))) == sorted(map(str, G2.f3_fact_connection(m).toPandas().itertuples(index=False)))
    m.append(_batch(spark, MAR, ["ssh", "smtp"], n=2), "b")  # corrected: another month, fewer rows, a new member
    assert {(r.year_month, r["count"]) for r in m["fact_connection"].groupBy("year_month").count().collect()} == {("2024-01", 12), ("2024-03", 4)}
    assert members < {tuple(r) for r in m["members"].collect()}
    hours = {r[0] for r in G2.hourly(m).select("time_id").distinct().collect()}
    assert hours == {JAN + 3600 * i for i in range(6)} | {MAR, MAR + 3600}, "the rollup follows"


def test_state_survives_the_driver_and_a_dead_load_changes_nothing(spark, monkeypatch):
    m = BatchedMart(spark)
    m.append(_batch(spark, JAN, ["dns"]), "a")

    def dies(self, after, state):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(commits.Commits, "commit", dies)
        with pytest.raises(OSError):
            m.append(_batch(spark, FEB, ["ssh"]), "b")
    again = BatchedMart(spark, m.root)
    assert again.batches() == ["a"] and again["fact_connection"].count() == 6
    assert again["dim_service"].filter("name = 'ssh'").isEmpty()
    again.append(_batch(spark, FEB, ["ssh"]), "b")
    assert again.batches() == ["a", "b"] and again["fact_connection"].count() == 12
    assert [r.status for r in again.audit.table().orderBy("batch_id").collect()] == ["COMPLETED", "FAILED", "COMPLETED"]


def test_two_loaders_never_give_an_id_twice(spark):
    """Both read the same state; the second to commit finds new members and starts over."""
    m = BatchedMart(spark)
    m.append(_batch(spark, JAN, ["dns"]), "a")
    other = BatchedMart(spark, m.root)
    real, once = other._facts, []

    def facts(*args):
        out = real(*args)
        if not once:  # while the second loader is at work, the first one commits
            once.append(m.append(_batch(spark, FEB, ["ssh", "ftp"]), "b"))
        return out

    other._facts = facts
    other.append(_batch(spark, MAR, ["smtp", "http"]), "c")
    last = BatchedMart(spark, m.root)
    assert last.batches() == ["a", "b", "c"] and last["fact_connection"].count() == 6 + 12 + 12
    for kind, key in (("service", "key_g2"), ("hour", "key_all"), ("port", "key_g2")):
        ids = [r[0] for r in last["members"].filter(F.col("dim") == kind).select(key).collect()]
        assert sorted(ids) == list(range(1, len(ids) + 1))
    assert last["fact_connection"].select("connection_id").distinct().count() == 30


def test_batches_without_rows(spark):
    m = BatchedMart(spark)
    assert m.append(staging(spark, [row(dsport=70000)]), "empty") == 0
    assert m["fact_connection"].count() == 0 and G2.hourly(m).count() == 0
    assert m.append(_batch(spark, JAN, ["dns"]), "a") == 6
    assert G2.hourly(m).count() == 6 and m.append(staging(spark, [row(dsport=70000)]), "a") == 0
    assert m["fact_connection"].count() == 0 and G2.hourly(m).count() == 0


# ---- refresh --------------------------------------------------------------------------------

def test_dependants():
    assert dependants("hourly_base")[:2] == ["fact_hourly_traffic", "fact_daily_traffic"]
    assert {"fact_daily_traffic_declared", "fact_monthly_traffic_declared", "mv_hourly_service_performance", "mv_daily_attack_patterns"} <= set(dependants("port_grain"))
    assert set(dependants("fact_connection")) | set(dependants("g1_fact_connections")) == set(DERIVED)


def test_a_refresh_reaches_every_table_and_leaves_other_months(spark):
    """Rows of one month are tampered with: after a refresh of that month everything that reads the fact
    is as if built from it, and the files of other months are the same."""
    m = Mart(spark, staging_raw(spark, SF)).build()
    by_month = ("port_grain", "port_words", "hourly_base", "fact_daily_traffic_declared", "fact_monthly_traffic_declared", "daily_ports", "monthly_ports")
    for name in DERIVED:
        m.derived(name)
    files = {n: {month: m._monthly[n].read([month]).inputFiles() for month in m._monthly[n].months} for n in by_month}
    fact = m["fact_connection"]
    month = "2024-02"
    changed = fact.withColumn("source_bytes", F.when(F.col("year_month") == month, F.col("source_bytes") + 1000).otherwise(F.col("source_bytes")))
    changed = changed.filter((F.col("year_month") != month) | (F.col("dest_port_id") % 3 != 0))
    m._write("fact_connection2", changed, ["year_month"])
    m._tables["fact_connection"] = m._tables.pop("fact_connection2")
    G2.refresh_rollups(m, FEB, FEB + 86400 * 27)
    fresh = Mart(spark, staging_raw(spark, SF)).build()
    fresh._tables["fact_connection"] = m["fact_connection"]
    # The window leaves hours of its first and last day out; those stay as they were.
    whole = m.derived("hourly_base").filter(F.col("year_month") != month)
    assert same(whole, fresh.derived("hourly_base").filter(F.col("year_month") != month))
    for name, months in files.items():
        now = {k: m._monthly[name].read([k]).inputFiles() for k in m._monthly[name].months}
        assert {k: v for k, v in now.items() if k != month} == {k: v for k, v in months.items() if k != month}, name
        assert now[month] != months[month], name
    G2.refresh_rollups(m)
    for query in (G2.r1_hourly_traffic, G2.r2_daily_traffic_literal, G2.r2i_daily_traffic, G2.r3i_monthly_traffic, G2.f6_service_stats, G2.f7_port_usage, G2.r2_daily_distinct_ports, Q.k12_monthly_trend_changes):
        assert same(query(m), query(fresh)), query.__name__
    for view in O.VIEWS:
        assert same(m.derived(view), fresh.derived(view)), view


def test_old_versions_go(spark):
    m = Mart(spark, staging_raw(spark, SF)).build()
    G2.monthly_declared(m)
    for _ in range(3):
        m.rebuild("fact_monthly_traffic_declared")
        m.rebuild("fact_service_stats")
    table = m._monthly["fact_monthly_traffic_declared"]
    live = [f for f in table.replaced if commits.exists(spark, f)]
    assert live == table.replaced and len(live) == len(table.months), "one version before the present one"
    folders = lambda: [n for n in commits.children(spark, m.root) if n.startswith("fact_service_stats")]
    assert len(folders()) == 2
    O.s3_parse_raw_lines(m).count()
    m.close()
    assert len(folders()) == 1 and not [n for n in commits.children(spark, m.root) if n.startswith("raw_lines")]
    assert G2.service_stats(m).count() > 0 and G2.monthly_declared(m).count() > 0


def test_results_keep_their_files(spark):
    """A result of a query that writes its own files can be read after the query ran again."""
    m = Mart(spark, staging(spark, [row(sport=i) for i in range(30)])).build()
    first = O.s3_parse_raw_lines(m)
    for _ in range(3):
        O.s3_parse_raw_lines(m)
    assert first.count() == 30


# ---- versions at a fact's own time ----------------------------------------------------------

def test_facts_meet_the_version_of_their_time(spark):
    t = lambda day, hour=0: dt.datetime(2024, 1, day, hour)
    versions = spark.createDataFrame(
        [("a", 1, t(1), t(5, 6)), ("a", 2, t(5, 6), t(5, 7)), ("a", 3, t(5, 7), None), ("b", 1, t(10), t(12))],
        "name string, version int, valid_from timestamp, valid_to timestamp",
    )
    at = lambda day, hour=0, s=0: int((t(day, hour) - dt.datetime(1970, 1, 1)).total_seconds()) + s
    facts = [("a", at(1)), ("a", at(5, 6, -1)), ("a", at(5, 6)), ("a", at(5, 7, -1)), ("a", at(5, 7)), ("a", at(30)), ("b", at(9)), ("b", at(10)), ("b", at(12, 0, -1)), ("b", at(12)), ("c", at(3)), (None, at(3)), ("a", None)]
    want = [1, 1, 2, 2, 3, 3, None, 1, 1, None, None, None, None]
    df = spark.createDataFrame([(n, s, i) for i, (n, s) in enumerate(facts)], "svc string, at long, i int")
    for width in (3600, 86400, 30 * 86400):
        got = temporal.resolve_as_of(df, "at", "svc", versions, "name", {"version": "v"}, width).orderBy("i").collect()
        assert [r.v for r in got] == want
    assert temporal.overlaps(versions, "name").isEmpty()
    late = versions.unionByName(spark.createDataFrame([("b", 2, t(11), None)], versions.schema))
    assert [r.name for r in temporal.overlaps(late, "name").collect()] == ["b"]


def test_several_active_rows_stop_the_build(spark):
    """A second active version of a member would double its facts."""
    dim = spark.createDataFrame([(1, "dns", True), (2, "dns", False), (3, "ssh", True)], "id int, name string, is_active boolean")
    V.assert_one_active({"dim_service": (dim, "name")})
    with pytest.raises(ValueError, match="1 of name in dim_service"):
        V.assert_one_active({"dim_service": (dim.withColumn("is_active", F.lit(True)), "name")})


# ---- keys -------------------------------------------------------------------------------------

def test_dense_keys(spark):
    data = [(k, v, (v or 1) % 3 != 0) for k in ("x", "y") for v in [None, *range(200)]]
    df = spark.createDataFrame(data, "kind string, v int, e boolean").repartition(7)
    last = spark.createDataFrame([("x", 1000, 500)], "kind string, n int, m int")
    for after in (None, last):
        rows = dense_keys(df, "kind", ["v"], {"n": F.lit(True), "m": F.col("e")}, after).collect()
        for kind in ("x", "y"):
            mine = sorted((r for r in rows if r.kind == kind), key=lambda r: (r.v is not None, r.v))
            base_n, base_m = (1000, 500) if after is not None and kind == "x" else (0, 0)
            assert [r.n for r in mine] == list(range(base_n + 1, base_n + 202))
            eligible = [r for r in mine if r.e]
            assert [r.m for r in eligible] == list(range(base_m + 1, base_m + len(eligible) + 1)) and all(r.m is None for r in mine if not r.e)


# ---- declared ranges -----------------------------------------------------------------------

def test_declared_ranges(spark, tmp_path):
    parts = RangePartitions("t", [("b", 20, 30), ("a", 0, 20), ("c", 50, 60)])
    rows = [(i,) for i in range(-5, 70)] + [(None,)] * 3
    table = parts.write(spark.createDataFrame(rows, "t long"), str(tmp_path / "t"))
    counts = {r.range_name: r.record_count for r in parts.counts(table).collect()}
    assert counts == {"a": 20, "b": 10, "c": 10, "default": 38}
    for low, high in ((0, 30), (25, 55), (-3, 2), (30, 50), (60, 61), (5, 5)):
        assert sorted(r.t for r in parts.between(table, low, high).collect()) == list(range(low, high))
    assert parts.met(0, 30) == ["a", "b"] and parts.met(25, 31) == ["b", "default"] and parts.met(100, 200) == ["default"]
    for wrong in ([("a", 0, 5), ("b", 4, 6)], [("a", 5, 5)], [("default", 0, 1)], [("a", 0, 1), ("a", 1, 2)]):
        with pytest.raises(ValueError):
            RangePartitions("t", wrong)


# ---- cross-tab ---------------------------------------------------------------------------------

def test_pivot_counts_every_protocol(spark):
    m = Mart(spark, staging(spark, [row(proto=p) for p in ("sctp", "sctp", "udp", "other", None)])).build()
    r = Q.k10_service_protocol_pivot(m).first().asDict()
    assert r == {"service_name": "dns", "sctp": 2, "udp": 1, "other_": 1, "other": 1}
    assert Q.k10_service_protocol_pivot(m, ["udp"]).first().asDict() == {"service_name": "dns", "udp": 1, "other": 4}


# ---- stream ------------------------------------------------------------------------------------

def test_compaction(spark, tmp_path):
    """100 batches, compacted on the way, a merged batch replayed, a compaction that dies: the same rollup
    from few files."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    from flowmart.operators.quality import valid_rows
    from flowmart.sources.fixture import raw_connections
    from flowmart.sources.schema import conform

    rows = valid_rows(conform(raw_connections(events))).cache()
    want = X.partials(rows)
    sink = str(tmp_path / "sink")
    # The partials of 100 micro-batches, as the stream writes them.
    split = rows.withColumn("b", F.pmod(F.xxhash64("sport", "stime"), F.lit(100)).cast("long"))
    for b in range(0, 100, 20):
        for i in range(b, b + 20):
            X.partials(split.filter(F.col("b") == i)).coalesce(1).write.mode("overwrite").parquet(f"{sink}/batch_id={i}")
        assert X.compact(spark, sink) == b + 18
    assert X.compact(spark, sink, keep=0) == 99
    assert same(X.rollup(spark, sink), want)
    assert len(X._partials_since(spark, sink, commits.Commits(spark, f"{sink}/_merged").latest()[1]).inputFiles()) <= 8
    X.partials(split.filter("b = 7")).write.mode("overwrite").parquet(f"{sink}/batch_id=7")  # a retry of a merged batch
    assert same(X.rollup(spark, sink), want)
    assert X.compact(spark, sink) == 99 and same(X.rollup(spark, sink), want), "nothing to merge"


def test_a_lost_compaction_race_changes_nothing(spark, tmp_path, monkeypatch):
    rows = staging(spark, [row(stime=JAN + i, ltime=JAN + i) for i in range(20)])
    sink = str(tmp_path / "sink")
    for i in range(3):
        X.partials(rows.filter(F.col("stime") % 3 == i)).write.parquet(f"{sink}/batch_id={i}")
    real = commits.Commits.commit

    def second(self, after, state):
        real(self, after, {"merged": "merged=first", "upto": 1, "retired": []})
        return real(self, after, state)

    X._sums(X._partials_since(spark, sink, {}, 1)).write.parquet(f"{sink}/merged=first")
    monkeypatch.setattr(commits.Commits, "commit", second)
    assert X.compact(spark, sink, keep=0) == 1
    assert X.rollup(spark, sink).agg(F.sum("total_connections")).first()[0] == 20
    assert [n for n in commits.children(spark, sink) if n.startswith("merged=")] == ["merged=first"]


# ---- claims and commits --------------------------------------------------------------------------

def test_two_writers_never_share_a_batch_id(spark, tmp_path):
    audits = [Audit(spark, str(tmp_path / "audit")) for _ in range(2)]
    taken: list[int] = []
    lock = threading.Lock()

    def work(a):
        for _ in range(8):
            i = a._claim(dt.datetime(2024, 1, 1), "RAW")
            with lock:
                taken.append(i)

    threads = [threading.Thread(target=work, args=(a,)) for a in audits]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(taken) == list(range(1, 17))


def test_orphans_are_failed_once(spark, tmp_path):
    path = str(tmp_path / "audit")
    dead = Audit(spark, path, lease=dt.timedelta(seconds=-1))
    dead.start("HOURLY")
    live = Audit(spark, path)
    live.start("DAILY")
    live.run("RAW", lambda b: 3)
    again = Audit(spark, path)
    assert again.fail_orphans() == [1] and again.fail_orphans() == [] and live.fail_orphans() == []
    states = {r.batch_id: (r.aggregation_level, r.status) for r in again.table().collect()}
    assert states == {1: ("HOURLY", "FAILED"), 2: ("DAILY", "STARTED"), 3: ("RAW", "COMPLETED")}
    dead.finish(1, "HOURLY", dt.datetime(2024, 1, 1), 9)  # it was only slow
    assert {r.batch_id: r.status for r in again.table().collect()}[1] == "COMPLETED"
    assert Audit(spark, str(tmp_path / "none")).fail_orphans() == []


def test_commits(spark, tmp_path):
    path = str(tmp_path / "log" / "x")
    assert commits.put_if_absent(spark, path, "one") and not commits.put_if_absent(spark, path, "two")
    assert commits.read_text(spark, path) == "one" and commits.children(spark, str(tmp_path / "log")) == ["x"]
    log = commits.Commits(spark, str(tmp_path / "c"))
    assert log.latest() == (0, {}) and log.commit(0, {"a": 1}) and not log.commit(0, {"a": 2})
    log.update(lambda s: {**s, "b": 2})
    assert log.latest() == (2, {"a": 1, "b": 2})
    assert json.loads(commits.read_text(spark, log._path(1))) == {"a": 1}


def test_scd_history_has_no_overlaps(spark):
    t0 = dt.datetime(2024, 1, 1)
    cur = spark.createDataFrame([(1, "dns", "udp", True, t0, None, 1)], "id int, name string, protocol string, is_active boolean, valid_from timestamp, valid_to timestamp, version int")
    for i, protocol in enumerate(("tcp", "tcp", "icmp")):
        snap = spark.createDataFrame([("dns", protocol), (f"new{i}", "udp")], "name string, protocol string")
        cur = scd.scd2_merge(cur, snap, "name", ["protocol"], t0 + dt.timedelta(days=10 * (i + 1)), id_col="id")
    assert temporal.overlaps(cur, "name").isEmpty()
    ids = {r.name: r.id for r in cur.collect()}
    assert ids == {"dns": 1, "new0": 2, "new1": 3, "new2": 4}
    assert [(r.version, r.protocol) for r in cur.filter("name = 'dns'").orderBy("version").collect()] == [(1, "udp"), (2, "tcp"), (3, "icmp")]
