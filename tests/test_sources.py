"""Staging load: raw-line parse, byte-order mark, blanks, bad numbers, line numbers, features."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from flowmart.sources import csv as CSV

# Two invented connection lines with the traps of the format: a byte-order mark and a blank attack
# category in the first, zero ports and no service in the second.
_FIRST = {0: "10.1.2.3", 1: "4021", 2: "10.9.8.7", 3: "53", 4: "udp", 5: "CON", 6: "0.25", 7: "310", 8: "94", 13: "dns", 28: "1500000000", 29: "1500000003", 48: "0"}
_ZERO = {0: "10.20.30.40", 1: "0", 2: "10.20.30.40", 3: "0", 4: "arp", 5: "INT", 6: "0", 7: "46", 8: "0", 13: "-", 28: "1500000007", 29: "1500000007", 48: "0"}
LINE1, LINE8 = ((mark + ",".join(v.get(i, "" if i == 47 else str(i % 4)) for i in range(49))) for mark, v in (("\ufeff", _FIRST), ("", _ZERO)))


def _write(lines: list[str], name: str = "part.csv") -> str:
    d = tempfile.mkdtemp(prefix="flowmart-src-")
    with open(os.path.join(d, name), "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines))  # no newline after the last row, like the sample
    return d


def test_parse_sample_rows(spark):
    path = _write([LINE1, LINE8])
    df = CSV.load_source_data(spark, path).orderBy("stime").collect()
    assert len(df) == 2
    first = df[0]
    assert first.srcip == "10.1.2.3"  # byte-order mark removed
    assert first.attack_cat is None and first.label == 0
    assert first.stime == 1500000000 and first.dur == 0.25
    assert df[1].service == "-" and df[1].sport == 0


def test_blank_short_and_bad_lines(spark):
    short = ",".join(LINE8.split(",")[:48])
    bad = LINE8.replace("10.20.30.40,0,", "10.20.30.40,0x000b,", 1)
    big = LINE8.split(",")
    big[20] = "4294967295"
    path = _write([LINE8, "", "   ", short, bad, ",".join(big)])
    lines = CSV.read_raw_lines(spark, path)
    assert lines.count() == 4  # blank and whitespace-only lines dropped
    parsed = CSV.parse_lines(lines, keep_source=True).orderBy("line_number").collect()
    assert parsed[1].label is None  # 48 fields: the last one is missing
    assert parsed[2].sport is None  # non-numeric port parses to NULL ...
    errors = CSV.parse_errors(lines).collect()
    assert [e.error_message for e in errors] == ["invalid sport"]  # ... and is reported
    assert errors[0].line_number == 5
    assert parsed[3].stcpb == 4294967295  # kept as bigint


def test_line_numbers_exact_across_blocks(spark):
    n = 3000
    lines = [LINE8.replace("1500000007,1500000007", f"{1500000007 + i},{1500000007 + i}") for i in range(n)]
    path = _write(lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")  # force many blocks per file
    try:
        raw = CSV.read_raw_lines(spark, path)
        assert raw.rdd.getNumPartitions() > 1
        got = CSV.parse_lines(raw, keep_source=True).select("line_number", "stime").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(r.line_number for r in got) == list(range(1, n + 1))
    assert all(r.stime == 1500000007 + r.line_number - 1 for r in got)


def test_csv_with_header_roundtrip(spark, tmp_path):
    from tests.conftest import row, staging

    df = staging(spark, [row(), row(service=None, sport=None)])
    out = str(tmp_path / "hdr")
    df.write.option("header", True).csv(out)
    back = CSV.read_with_header(spark, out)
    assert back.count() == 2
    assert back.filter(F.col("sport").isNull()).count() == 1


def test_required_features(spark, tmp_path):
    p = tmp_path / "features.csv"
    p.write_text("feature_id,name,data_type,description\n1,srcip,nominal,x\n2,sport,integer,y\n")
    missing = {r.name for r in CSV.missing_required_features(CSV.read_features(spark, str(p))).collect()}
    assert missing == {"dstip", "dsport", "proto", "state", "service", "attack_cat", "label"}


def test_load_all_checks_features(spark, tmp_path):
    import pytest

    feats = tmp_path / "f.csv"
    feats.write_text("feature_id,name,data_type,description\n" + "\n".join(
        f"{i},{n},t,d" for i, n in enumerate(["srcip", "sport", "dstip", "dsport", "proto", "state", "service", "attack_cat", "label"])))
    data = _write([LINE1, LINE8])
    staging, profile = CSV.load_all(spark, str(feats), data)
    assert staging.count() == 2 and profile.first().total_records == 2
    feats.write_text("feature_id,name,data_type,description\n1,srcip,t,d\n")
    with pytest.raises(ValueError, match="the feature dictionary lacks"):
        CSV.load_all(spark, str(feats), data)


def test_line_numbers_restart_per_file(tmp_path):
    """Each file numbers its own lines from 1."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    d = tmp_path / "multi"
    d.mkdir()
    for name, n in (("a.csv", 5), ("b.csv", 3)):
        (d / name).write_text("\n".join(LINE8 for _ in range(n)))
    rows = CSV.read_raw_lines(spark, str(d)).collect()
    by_file: dict[str, list[int]] = {}
    for r in rows:
        by_file.setdefault(r.file_name.rsplit("/", 1)[-1], []).append(r.line_number)
    assert {k: sorted(v) for k, v in by_file.items()} == {"a.csv": [1, 2, 3, 4, 5], "b.csv": [1, 2, 3]}
