from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from flowmart.sources.schema import STAGING_SCHEMA, conform  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = (
        SparkSession.builder.master("local[*]")
        .appName("flowmart-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    # Tests own their checkpoint folder (a cluster names a shared one in spark.checkpoint.dir).
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="flowmart-test-ckpt-"))
    yield session


BASE_ROW = dict(
    srcip="59.166.0.0", sport=1390, dstip="149.171.126.6", dsport=53, proto="udp", state="CON", dur=0.5,
    sbytes=132, dbytes=164, sttl=31, dttl=29, sloss=0, dloss=0, service="dns", sload=500.0, dload=600.0,
    spkts=2, dpkts=2, stime=1421927414, ltime=1421927414, ct_srv_src=3, ct_srv_dst=7, ct_state_ttl=0,
    attack_cat=None, label=0,
)


def row(**over) -> dict:
    r = dict(BASE_ROW)
    r.update(over)
    return r


def staging(spark: SparkSession, rows: list[dict]):
    cols = [f.name for f in STAGING_SCHEMA.fields]
    data = [tuple(r.get(c) for c in cols) for r in rows]
    return conform(spark.createDataFrame(data, STAGING_SCHEMA))
