"""Randomised staging rows (NULLs, rule breakers, unseen members) against invariants
and a pure-Python brute force - independent of both Spark and the DuckDB oracle."""

from __future__ import annotations

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowmart.plans import queries_g1 as G1
from flowmart.plans import queries_g2 as G2
from flowmart.plans.mart import Mart
from tests.conftest import row, staging

T0 = 1704067200

rows_strategy = st.lists(
    st.fixed_dictionaries({
        "service": st.sampled_from(["dns", "http", "ssh", "-", None]),
        "proto": st.sampled_from(["tcp", "udp", None]),
        "state": st.sampled_from(["CON", "FIN", None]),
        "dsport": st.sampled_from([0, 53, 80, 31337, 70000, None]),
        "dur": st.sampled_from([0.5, 1.25, 2.0, -1.0, None]),
        "stime": st.integers(min_value=T0, max_value=T0 + 5 * 86400),
        "attack_cat": st.sampled_from(["DoS", "Worms", "", None]),
        "label": st.sampled_from([0, 1, 2, None]),
    }),
    min_size=1, max_size=40,
)


def _clean(r: dict) -> bool:
    ok_port = r["dsport"] is None or 0 <= r["dsport"] <= 65535
    ok_dur = r["dur"] is None or r["dur"] >= 0
    return ok_port and ok_dur


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows_strategy)
def test_random_mart_matches_brute_force(spark, rows):
    full = [row(ltime=r["stime"], **r) for r in rows]
    m = Mart(spark, staging(spark, full)).build()
    clean = [r for r in full if _clean(r)]

    # every clean row is one mart fact; the hourly rollup adds up to the fact
    assert m["fact_connection"].count() == len(clean)
    assert (G2.hourly(m).agg(F.sum("total_connections")).first()[0] or 0) == len(clean)

    # simple generation keeps rows with all inner-join keys present
    g1 = [r for r in clean if r["dsport"] is not None and r["proto"] is not None and r["state"] is not None
          and r["label"] is not None]
    assert m["g1_fact_connections"].count() == len(g1)

    # QA1 brute force: per service (NULL -> UNKNOWN) counts, attacks, exact mean duration
    acc = defaultdict(lambda: [0, 0, Decimal(0), 0])
    for r in clean:
        name = r["service"] if r["service"] is not None else "UNKNOWN"
        a = acc[name]
        a[0] += 1
        a[1] += 1 if r["attack_cat"] not in (None, "", "NORMAL") else 0
        if r["dur"] is not None:
            a[2] += Decimal(str(r["dur"])).quantize(Decimal("0.001"), ROUND_HALF_UP)
            a[3] += 1
    got = {x.service_name: x for x in G2.qa1_service_ranking(m).collect()}
    assert set(got) == set(acc)
    for name, (n, att, s, k) in acc.items():
        g = got[name]
        assert (g.total_connections, g.attack_connections) == (n, att)
        want = None if k == 0 else float((s / k).quantize(Decimal("0.000001"), ROUND_HALF_UP))
        assert g.avg_duration == want

    # D3q brute force: destination ports seen more than once, only in attacks (label = 1)
    by_port = defaultdict(list)
    for r in g1:
        by_port[r["dsport"]].append(r["label"] == 1)
    want_ports = {p for p, flags in by_port.items() if len(flags) > 1 and all(flags)}
    assert {x.port for x in G1.d3q_attack_only_ports(m).collect()} == want_ports
