"""Near-duplicate detection with MinHash.

Each document is the set of its 5-word shingles. ``HASHES`` universal hash minima form its
signature, cut into ``BANDS`` bands; documents that share a band are candidates. Candidates
are checked by signature, then confirmed on the full shingle sets, and the links' connected
components are the groups.

Hot groups are never expanded into all pairs:

* documents with equal sets collapse into one vertex before banding;
* a bucket first links its members to its most central one (a star);
* afterwards only buckets that still hold several components are looked at again, in cells
  of bounded size: the signatures of members of different components are compared there;
  members with a candidate get their full sets, and the cell confirms links until its
  components are joined. A pair is tried only in the first band that it shares. So every
  candidate pair across components is confirmed or refuted, and only links leave a cell;
  pairs inside one component can change nothing.

A pair at similarity 0.75 shares no band with probability 5e-6; the signature check lets pairs
down to an estimate of 0.58 pass (4.4 standard deviations below, 5e-6).

Edge cases: null, empty and blank texts have no shingles and stay alone; fewer words than
five are one shingle; repeated rows collapse; a null ``doc_id`` is the largest of its group and
its component id is the smallest id there (null if there is none); an empty table gives an
empty result; extra columns are ignored by ``groups`` and kept by ``keep_one``.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.llm.blocks import BLOCK, ROW, block_of, blocked
from flowmart.llm.common import arrow_rows, shuffle_partitions, stage, table
from flowmart.llm.components import components

WORDS = 5
PERCENT = 75
HASHES = 128
BANDS = 32
BAND_BYTES = HASHES // BANDS * 2
MIN_ESTIMATE = 0.58
CHUNK = 512  # members of a bucket that a task compares at a time

_RNG = np.random.default_rng(31337)
_A = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64)
_C = [np.uint64(x | 1) for x in _RNG.integers(1, 2**62, WORDS + 1).tolist()]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    import xxhash

    numbers: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    tokens = [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in ((t or "").encode().lower().split() for t in texts)]
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in numbers], np.uint64)
    out = []
    for t in tokens:
        h = hashes[t]
        if not len(h):
            out.append(h)
        elif len(h) < WORDS:
            out.append(_mix(np.array([sum((int(x) * int(c) for x, c in zip(h, _C)), len(h) * int(_C[WORDS])) & 0xFFFFFFFFFFFFFFFF], np.uint64)))
        else:
            n = len(h) - WORDS + 1
            s = h[:n] * _C[0]
            for k in range(1, WORDS):
                s += h[k : k + n] * _C[k]
            out.append(np.unique(_mix(s)))
    return out


def _sets(texts: pa.ChunkedArray, at_a_time: int = 256) -> Iterator[np.ndarray]:
    for i in range(0, len(texts), at_a_time):
        yield from shingle_sets(texts.slice(i, at_a_time).to_pylist())


def signature(s: np.ndarray) -> np.ndarray:
    """16 well-mixed bits of the minimum of each universal hash over the set."""
    best = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 2048):
        best = np.minimum(best, (s[i : i + 2048, None] * _A + _B).min(axis=0))
    return (_mix(best) & np.uint64(0xFFFF)).astype("<u2")


SKETCH_DDL = "row long, doc_id long, n long, k1 long, k2 long, sig binary"
SKETCH = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("sig", pa.binary())])


def _sketch(group: pa.Table) -> pa.Table:
    rows = []
    for row, doc_id, s in zip(group[ROW].to_pylist(), group["doc_id"].to_pylist(), _sets(group["text"])):
        k1, k2 = (int(_mix(s ^ np.uint64(c)).sum(dtype=np.uint64).view(np.int64)) for c in (0x51ED270B27D0A7C5, 0x2545F4914F6CDD1D))
        rows.append((row, doc_id, len(s), k1, k2, signature(s).tobytes() if len(s) else None))
    return pa.table({f.name: pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SKETCH)}, schema=SKETCH)


SETS_DDL = "v long, shingles binary"


def _wanted_sets(group: pa.Table, wanted: pa.Table) -> pa.Table:
    rows = set(wanted["v"].to_pylist()) if wanted.num_rows else set()
    at = [i for i, r in enumerate(group[ROW].to_pylist()) if r in rows] if rows else []
    sets = _sets(group["text"].take(at)) if at else []
    return pa.table({"v": pa.array([group[ROW][i].as_py() for i in at], pa.int64()), "shingles": pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())})


LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _confirm(batches: Iterator[dict]) -> Iterator[tuple]:
    for b in batches:
        for x, y, s, t in zip(b["a"].to_pylist(), b["b"].to_pylist(), b["s"], b["t"]):
            s, t = np.frombuffer(s.as_buffer(), "<u8"), np.frombuffer(t.as_buffer(), "<u8")
            both = len(np.intersect1d(s, t, assume_unique=True))
            if 100 * both >= PERCENT * (len(s) + len(t) - both):
                yield x, y


def _similar(batches: Iterator[dict]) -> Iterator[tuple]:
    """Pairs that pass the signature check."""
    for b in batches:
        for x, y, s, t in zip(b["a"].to_pylist(), b["b"].to_pylist(), b["s"], b["t"]):
            if (np.frombuffer(s.as_buffer(), "<u2") == np.frombuffer(t.as_buffer(), "<u2")).mean() >= MIN_ESTIMATE:
                yield x, y


def _with_ends(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    one = values.select(F.col("v").alias("a"), F.col(column).alias("s"))
    two = values.select(F.col("v").alias("b"), F.col(column).alias("t"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "s", "t")


def full_sets(vertices: DataFrame, texts: DataFrame) -> DataFrame:
    """(v, shingles) of the row numbers in column ``v``."""
    wanted = vertices.select("v").distinct().withColumn(BLOCK, block_of(F.col("v")))
    return stage(texts.select(BLOCK, ROW, "text").groupBy(BLOCK).cogroup(wanted.groupBy(BLOCK)).applyInArrow(_wanted_sets, SETS_DDL), "minhash-sets")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of row numbers whose full shingle sets are similar enough."""
    sets = full_sets(pairs.select(F.col("a").alias("v")).unionByName(pairs.select(F.col("b").alias("v"))), texts)
    return stage(_with_ends(pairs, sets, "shingles").mapInArrow(arrow_rows(_confirm, LINK, 20_000), "a long, b long"), "minhash-links")


def _runs(batches: Iterator[dict], columns: tuple[str, ...]) -> Iterator[tuple]:
    """Sorted rows (key, i, j, ..) as ((key, i, j), columns of the run)."""
    key, rows = None, []
    for b in batches:
        for ky, i, j, *rest in zip(*(b[n].to_pylist() for n in ("key", "i", "j", *columns))):
            if (ky, i, j) != key:
                if len(rows) > 1:
                    yield key, list(zip(*rows))
                key, rows = (ky, i, j), []
            rows.append(rest)
    if len(rows) > 1:
        yield key, list(zip(*rows))


class _Cell:
    """Members of a bucket's chunk pair with their signatures."""

    def __init__(self, key: tuple, band, chunk, component, sig):
        chunk = np.array(chunk)
        self.left, self.right, self.band = np.flatnonzero(chunk == key[1]).tolist(), np.flatnonzero(chunk == key[2]), band[0]
        self.component = np.array(component)
        self.sig = np.frombuffer(b"".join(sig), "<u2").reshape(len(sig), HASHES)
        self.bands = self.sig.view("<u8").reshape(len(sig), BANDS)

    def candidates(self, x: int) -> np.ndarray:
        """Members of other components that pass the signature check with ``x`` and share no
        earlier band with it."""
        others = self.right[self.component[self.right] != self.component[x]]
        others = others[(self.sig[others] == self.sig[x]).sum(axis=1) >= MIN_ESTIMATE * HASHES]
        return others[(self.bands[others] == self.bands[x]).argmax(axis=1) == self.band] if len(others) else others


MEMBER = pa.schema([("key", pa.int64()), ("i", pa.int64()), ("j", pa.int64()), ("band", pa.int32()), ("chunk", pa.int64()), ("v", pa.int64()), ("component", pa.int64()), ("sig", pa.binary())])
MEMBER_DDL = "key long, i long, j long, band int, chunk long, v long, component long, sig binary"


def _with_candidates(batches: Iterator[dict]) -> Iterator[tuple]:
    """The members that have a candidate in their cell."""
    for key, (band, chunk, v, component, sig) in _runs(batches, ("band", "chunk", "v", "component", "sig")):
        cell, keep = _Cell(key, band, chunk, component, sig), set()
        for x in cell.left:
            others = cell.candidates(x).tolist()
            if others:
                keep.update(others, [x])
        for x in keep:
            yield (*key, band[x], chunk[x], v[x], component[x], sig[x])


def _link_across(batches: Iterator[dict]) -> Iterator[tuple]:
    """Links between components, confirmed on the full sets: within a cell a pair that earlier
    links have already joined is not looked at again."""
    for key, (band, chunk, v, component, sig, sets) in _runs(batches, ("band", "chunk", "v", "component", "sig", "shingles")):
        cell = _Cell(key, band, chunk, component, sig)
        arrays = [np.frombuffer(s, "<u8") for s in sets]
        size = np.array([len(s) for s in arrays])
        ids = np.unique(np.concatenate(arrays), return_inverse=True)[1]
        begin = np.cumsum(size) - size
        mine = np.zeros(int(ids.max()) + 1, bool)
        for x in cell.left:
            others = cell.candidates(x)
            if not len(others):
                continue
            own = ids[begin[x] : begin[x] + size[x]]
            mine[own] = True
            n = size[others]
            first = np.cumsum(n) - n
            both = np.add.reduceat(mine[ids[np.repeat(begin[others] - first, n) + np.arange(n.sum())]], first, dtype=np.int64)
            mine[own] = False
            for y in others[100 * both >= PERCENT * (size[x] + n - both)].tolist():
                a, b = cell.component[x], cell.component[y]
                if a != b:
                    cell.component[cell.component == max(a, b)] = min(a, b)
                    yield min(v[x], v[y]), max(v[x], v[y])


def groups(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, first_row) for every row of a ``blocked`` table:
    first_row is the row of its group that stays."""
    texts = docs
    spark = docs.sparkSession
    sketches = stage(texts.select(BLOCK, ROW, "doc_id", "text").groupBy(BLOCK).applyInArrow(_sketch, SKETCH_DDL), "minhash-sketches")
    same = sketches.where("n > 0").groupBy("k1", "k2", "n")
    vertices = stage(same.agg(F.min("row").alias("v"), F.min_by("sig", "row").alias("sig")), "minhash-vertices")
    band = F.posexplode(F.array(*[F.substring("sig", 1 + b * BAND_BYTES, BAND_BYTES) for b in range(BANDS)])).alias("band", "part")
    bands = vertices.select("v", band).select("v", "band", F.xxhash64("band", "part").alias("key"))
    # Members of buckets with company; a vertex that meets many others in its buckets is close
    # to the middle of its family.
    size = bands.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    bands = stage(bands.join(size, "key").select("v", "band", "key", "m"), "minhash-bands")
    met = bands.groupBy("v").agg(F.sum("m").alias("met"))

    # Stars: every bucket's members against its most central one.
    lead = bands.join(met, "v").groupBy("key").agg(F.max_by("v", F.struct("met", -F.col("v"))).alias("a"))
    stars = bands.join(lead, "key").where("v <> a").select(F.least("a", "v").alias("a"), F.greatest("a", "v").alias("b")).distinct()
    passed = stage(_with_ends(stars, vertices, "sig").mapInArrow(arrow_rows(_similar, LINK, 20_000), "a long, b long"), "minhash-stars")
    links = confirmed(passed, texts)
    parts = stage(components(links), "minhash-components")

    # Buckets that still hold several components, in cells of at most two chunks of members.
    member = bands.join(parts, "v", "left").select("key", "band", "m", "v", F.coalesce("component", "v").alias("component"))
    open_ = member.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 < c2").select("key")
    chunks = F.ceil(F.col("m") / CHUNK).cast("long")
    chunk = F.pmod(F.xxhash64("v"), chunks)
    cells = (
        member.join(open_, "key")
        .select("key", "band", "v", "component", chunk.alias("chunk"), F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("other"))
        .select("key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "band", "chunk", "v", "component")
        .join(vertices.select("v", "sig"), "v")
        .select(*MEMBER.names)
    )
    n = shuffle_partitions(spark)
    grouped = lambda df: df.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j", "v")
    some = stage(grouped(cells).mapInArrow(arrow_rows(_with_candidates, MEMBER, 5_000), MEMBER_DDL), "minhash-candidates")
    with_sets = some.join(full_sets(some, texts), "v").select(*MEMBER.names, "shingles")
    across = stage(grouped(with_sets).mapInArrow(arrow_rows(_link_across, LINK, 20_000), "a long, b long"), "minhash-across")
    if not across.isEmpty():
        parts = stage(components(links.unionByName(across)), "minhash-components")

    of_row = sketches.join(vertices.select("k1", "k2", "n", "v"), ["k1", "k2", "n"], "left").join(parts, "v", "left")
    of_row = of_row.select("row", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "v", "row").alias("g"))
    first = of_row.groupBy("g").agg(F.min("doc_id").alias("component_id"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("s"))
    return of_row.join(first.select("g", "component_id", F.col("s.row").alias("first_row")), "g").select("row", "doc_id", "n_shingles", "component_id", "first_row")


def _kept_rows(columns: list[str]):
    def run(group: pa.Table, keep: pa.Table) -> pa.Table:
        rows = set(keep["row"].to_pylist()) if keep.num_rows else set()
        return group.filter(pa.array([r in rows for r in group[ROW].to_pylist()], pa.bool_())).select(columns) if group.num_rows else group.select(columns)

    return run


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every group of near-copies: the one with the smallest id."""
    texts = blocked(docs)
    keep = groups(texts).where("row = first_row").select("row", block_of(F.col("row")).alias(BLOCK))
    return texts.groupBy(BLOCK).cogroup(keep.groupBy(BLOCK)).applyInArrow(_kept_rows(docs.columns), docs.schema)


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = blocked(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups(texts).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
