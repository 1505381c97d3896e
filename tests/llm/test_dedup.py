"""Operators 6 and 8 against brute force, and components against union-find."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from flowmart.llm import minhash_dedup, suffix_dedup
from flowmart.llm.blocks import BLOCK, blocked
from flowmart.llm.components import components
from tests.llm.helpers import VOCAB, documents, empty, prose, rows


def _find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def brute_groups(data):
    """(n_shingles, component_id) per row."""
    sets = []
    for _, text, *_ in data:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(data)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[_find(parent, i)] = _find(parent, j)
    least: dict = {}
    for i, r in enumerate(data):
        ids = least.setdefault(_find(parent, i), [])
        if r[0] is not None:
            ids.append(r[0])
    return [(len(sets[i]), min(ids) if (ids := least[_find(parent, i)]) else None) for i in range(len(data))]


def check_groups(spark, data):
    want = sorted(((r[0], n, c) for r, (n, c) in zip(data, brute_groups(data))), key=str)
    got = minhash_dedup.groups(blocked(documents(spark, data).select("doc_id", "text"))).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == want


def test_groups_equal_brute_force(spark):
    check_groups(spark, rows())


def test_chain_of_near_copies_and_a_large_group(spark):
    """A chain whose ends are dissimilar, and many edits of one text of which the smallest id is
    far from most: one component each, found without comparing all pairs."""
    rng = random.Random(4)
    chain = [prose(rng, 120).split(" ")]
    for _ in range(25):
        w = list(chain[-1])
        at = rng.randrange(len(w))
        w[at] = rng.choice(VOCAB) + "z"
        chain.append(w)
    base = prose(rng, 150).split(" ")
    edits = []
    for i in range(120):
        w = list(base)
        for _ in range(7 if i == 0 else rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(1000)}"
        edits.append(w)
    data = [(i, " ".join(w), "en", "s", 0) for i, w in enumerate([*chain, *edits])]
    rng.shuffle(data)
    check_groups(spark, data)


def test_family_that_shares_half(spark):
    """Texts that share a long passage but are not near-copies stay apart."""
    rng = random.Random(9)
    passage = prose(rng, 100)
    check_groups(spark, [(i, passage + " " + prose(rng, 60 + i % 30), "en", "s", 0) for i in range(80)])


def test_keep_one(spark):
    data = rows()
    kept = minhash_dedup.keep_one(documents(spark))
    assert kept.columns == documents(spark).columns
    got = kept.collect()
    want = brute_groups(data)
    with_id = {c for n, c in want if c is not None and n}
    assert with_id <= {r["doc_id"] for r in got}
    # rows without shingles stand alone; every group keeps exactly one row
    expected = len(with_id) + sum(1 for n, c in want if not n) + len({r[1] for r, (n, c) in zip(data, want) if n and c is None})
    assert len(got) == expected
    assert minhash_dedup.keep_one(empty(spark)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000, i) for i in range(1001, 1200)] + [(i, i + 1) for i in range(2000, 2100)]
    parent = {v: v for e in edges for v in e}
    for a, b in edges:
        x, y = _find(parent, a), _find(parent, b)
        parent[max(x, y)] = min(x, y)
    got = {r["v"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: _find(parent, v) for a, b in edges if a != b for v in (a, b)}


def brute_removed(data):
    known = [(r[0], (r[1] or "").encode()) for r in data]
    first: dict = {}
    for d, b in known:
        if d is not None:
            for i in range(len(b) - 49):
                s = b[i : i + 50]
                first[s] = min(first.get(s, d), d)
    out = []
    for d, b in known:
        gone = bytearray(len(b))
        if d is not None:
            for i in range(len(b) - 49):
                if first[b[i : i + 50]] < d:
                    gone[i : i + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest(), kept))
    return out


def test_repeats_equal_brute_force(spark):
    data = rows()
    got = [tuple(r) for r in suffix_dedup.repeat_digests(documents(spark)).collect()]
    assert sorted(got, key=str) == sorted((r[:5] for r in brute_removed(data)), key=str)


def test_repetitive_bytes(spark):
    """Runs of one byte, short periods, exactly 49 and 50 shared bytes, many-byte characters."""
    rng = random.Random(6)
    p49, p50 = "q" + "".join(rng.choice("abcdé") for _ in range(60)), "".join(rng.choice("xyzwv") for _ in range(50))
    p49 = p49.encode()[:49].decode("utf-8", "ignore")
    texts = ["a" * 400, "b" * 49, "a" * 120 + "c", "ab" * 200, "ba" * 90, p49 + "1", p49 + "2", p50 + "1", "0" + p50 + "2", "é日" * 40, "x" + "é日" * 30]
    data = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] * 2
    got = [tuple(r) for r in suffix_dedup.repeat_digests(documents(spark, data)).collect()]
    assert sorted(got, key=str) == sorted((r[:5] for r in brute_removed(data)), key=str)


def digests_of_blocks(data, buckets):
    """The passes of the operator over two blocks of rows, one after the other."""
    cut = len(data) // 2
    blocks = [
        pa.table({BLOCK: pa.array([i] * len(part), pa.int64()), "doc_id": pa.array([r[0] for r in part], pa.int64()), "text": pa.array([r[1] for r in part])})
        for i, part in enumerate((data[:cut], data[cut:]))
    ]

    def by(rows, name, fn):
        return pa.concat_tables([fn(rows.filter(pc.equal(rows[name], v))) for v in pc.unique(rows[name]).to_pylist()])

    seen = pa.concat_tables([suffix_dedup._seen(buckets)(b) for b in blocks])
    assert max(pc.unique(seen["bucket"]).to_pylist()) >= min(buckets - 1, 66_000)
    shared = by(seen, "bucket", suffix_dedup._shared)
    of = lambda rows, i: rows.filter(pc.equal(rows["block"], i))
    stretches = pa.concat_tables([suffix_dedup._stretches(buckets)(b, of(shared, i)) for i, b in enumerate(blocks)])
    holders = by(stretches, "bucket", suffix_dedup._holders)
    out = []
    for i, b in enumerate(blocks):
        s, h = of(shared, i), of(holders, i)
        verdicts = pa.concat_tables([s.append_column("holders", pa.nulls(len(s), pa.binary())), h.append_column("names", pa.nulls(len(h), pa.binary())).select(["block", "bucket", "names", "holders"])])
        out += [tuple(r.values()) for r in suffix_dedup._digests(buckets)(b, verdicts).to_pylist()]
    return out


@pytest.mark.parametrize("buckets", [8, 200_000])
@pytest.mark.parametrize("bits", [64, 6])
def test_hash_collisions_and_many_buckets(monkeypatch, buckets, bits):
    at = suffix_dedup.PrefixHashes.at
    if bits < 64:
        monkeypatch.setattr(suffix_dedup.PrefixHashes, "at", lambda self, i, n: suffix_dedup._mixed(at(self, i, n)) >> np.uint64(64 - bits))
    rng = random.Random(31)
    passage = prose(rng, 60)
    data = [r[:2] for r in rows()] + [(500 + i, prose(rng, 20) + passage[i : 200 - i] + prose(rng, 20)) for i in range(20)] + [(600, "\0" * 300), (601, "\0" * 250)]
    rng.shuffle(data)
    assert sorted(digests_of_blocks(data, buckets), key=str) == sorted((r[:5] for r in brute_removed(data)), key=str)


def test_drop_repeats_keeps_rows_and_columns(spark):
    out = suffix_dedup.drop_repeats(documents(spark))
    assert out.columns == documents(spark).columns
    got = sorted(((r["doc_id"], r["text"] or "") for r in out.collect()), key=str)
    assert got == sorted(((r[0], r[5].decode("utf-8", "ignore")) for r in brute_removed(rows())), key=str)
    assert suffix_dedup.repeat_digests(empty(spark)).count() == 0


def test_suffix_sort_orders_suffixes():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1000:1200] = 97
    raw = data.tobytes()
    starts = np.arange(len(data) - 50)
    group = np.sort(rng.integers(0, 3, len(starts)))
    order = suffix_dedup.suffix_sort(data, suffix_dedup.PrefixHashes(data), starts, group)
    assert sorted(order.tolist()) == list(range(len(starts)))
    keys = [(int(group[i]), raw[starts[i] : starts[i] + 50]) for i in order]
    assert keys == sorted(keys)
    h = suffix_dedup.PrefixHashes(data)
    i, j = rng.integers(0, 2900, 300), rng.integers(0, 2900, 300)
    for a, b, n in zip(i, j, suffix_dedup.common_extension(h, i, j)):
        same = next((k for k in range(50) if raw[a + k] != raw[b + k]), 50)
        assert n == same
