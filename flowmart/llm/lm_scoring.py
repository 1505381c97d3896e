"""Language-model scoring with a log-frequency Bloom filter.

A bigram's count c is quantised to the level 1 + floor(log2 c); the filter holds the pairs
(bigram, 1) .. (bigram, level). A look-up probes level after level until one is missing, and
answers 2**(level - 1), which is never above the true count but for a false positive. A false
hit on level 1 makes an unseen bigram a seen one, for each of the V words that may follow: the
level has an array of its own with so many bits and probes that fewer than ``FALSE_WORDS`` words
of the whole vocabulary are expected to hit falsely after any word. Higher levels are only
reached by hits; a false one there (about 2 % at 8 bits an entry) doubles a count. The answer is
bounded by the exact counts of both words. The filter is partitioned: the task that sums a hash
bucket's counts builds that bucket's segments, each of at most ``SEGMENT_BYTES`` and a range of
names. The blocks' distinct bigrams, held-out ones too, are staged by hash bucket and meet their
bucket's segments in a task of their own, so that no segment passes the driver. A bucket whose segments
exceed ``SHARD_BYTES`` is probed in several rounds, one shard of its segments in each.

The smoothed probability of a token w after v is
    b * min(found(v, w), c(v), c(w)) / c(v) + (1 - b) * P(w),   P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)),
with exact unigram counts and an interpolation weight b per magnitude of c(v), trained by
leave-one-out likelihood over all training tokens on a fixed grid.

All counts run over blocks (see blocks.py): a block sends each distinct word or bigram once with its
count, and gets totals back, so frequent words make no hot group. Words and bigrams are known
by 64-bit hashes.

Edge cases: null and empty texts are the end token alone; a null ``doc_id`` counts as
crc32 of the empty string (training); repeated rows are counted and scored one by one; with
no training text every token has P = 0.5 / 0.5; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import uuid
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.llm.blocks import BLOCK, blocked
from flowmart.llm.common import arrow_rows, made, shuffle_partitions, stage, table
from flowmart.session import scratch_path

BLOCK_ROWS = 4096
HELD_OUT = (5, 1)  # crc32(doc_id) modulo the first is the second: not learned from
#: Of the levels from 2 on.
BITS_PER_ENTRY = 8
PROBES = 4
#: Words of the vocabulary that may falsely be found after a word, as expected.
FALSE_WORDS = 0.1
SHARD_BYTES = 64 << 20
SEGMENT_BYTES = 16 << 20
MAX_LEVEL = 40
#: Grid of interpolation weights and the magnitudes of c(v) that have one each.
GRID = np.array([0.0, 0.01, 0.03, 0.07, 0.15, 0.3, 0.5, 0.7, 0.85, 0.95])
MAGNITUDES = 48

END, START = 0, 1
_SPECIAL = (0x1B873593CC9E2D51, 0x38495AB5E6546B64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % HELD_OUT[0] == HELD_OUT[1]


class Tokens:
    """The tokens of a block's texts as numbers: words in lower case (A-Z), then one end each."""

    def __init__(self, group: pa.Table):
        import xxhash

        self.doc = group["doc_id"].to_pylist()
        numbers: defaultdict[bytes, int] = defaultdict(itertools.count(2).__next__)
        number = numbers.__getitem__
        parts, size = [], []
        for text in group["text"]:
            words = (text.as_py() or "").encode().lower().split()
            parts.append(np.fromiter(map(number, words), np.int32, len(words)))
            parts.append(np.zeros(1, np.int32))
            size.append(len(words) + 1)
        self.token = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.size = np.array(size, np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.held = np.array([is_held_out(d) for d in self.doc], bool)
        self.learn = np.repeat(~self.held, self.size)
        self.hash = np.array([*_SPECIAL, *(xxhash.xxh3_64_intdigest(w) for w in numbers)], np.uint64)
        self.order = np.argsort(self.hash, kind="stable")

        del parts, numbers

    def _pairs(self) -> np.ndarray:
        """(before, word) of every token as one number."""
        before = np.empty(len(self.token), np.int64)
        before[1:] = self.token[:-1]
        before[self.first] = START
        before *= len(self.hash)
        before += self.token
        return before

    def _hashed(self, pair: np.ndarray) -> np.ndarray:
        """The hash of distinct pairs; sets their words and returns the order by hash."""
        v, w = pair // len(self.hash), pair % len(self.hash)
        h = _mix(self.hash[v] * np.uint64(0x9E3779B97F4A7C15) + _mix(self.hash[w]))
        order = np.argsort(h, kind="stable")
        self.pair_hash, self.before, self.word = h[order], v[order], w[order]
        return order

    def distinct(self) -> np.ndarray:
        """All distinct bigrams in hash order; returns how often each occurs in training texts."""
        pairs = self._pairs()
        pair, times = np.unique(pairs, return_counts=True)
        held, unlearned = np.unique(pairs[~self.learn], return_counts=True)
        times[np.searchsorted(pair, held)] -= unlearned
        return times[self._hashed(pair)]

    def located(self) -> np.ndarray:
        """All distinct bigrams in hash order; returns the place of every token's bigram there."""
        pair, of = np.unique(self._pairs(), return_inverse=True)
        order = self._hashed(pair)
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return back[of]


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the hash, so that hash order is bucket order."""
    return ((h >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _zip(a: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def _unzip(data: bytes, kind: str) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _low6(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _from6(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _split(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    return [(int(bucket[a]), a, b) for a, b in zip(first, np.append(first[1:], len(bucket)))]


# --- counts -------------------------------------------------------------------------------

SENT = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])
SENT_DDL = "kind int, bucket long, block long, hashes binary, counts binary"
WORDS, BIGRAMS = 0, 1


def _send(buckets: int):
    """A block's distinct words and bigrams, each with its training count (0: only held out)."""

    def run(group: pa.Table) -> pa.Table:
        t, block = Tokens(group), group[BLOCK][0].as_py()
        rows = []
        h = t.hash[t.order]
        n = np.bincount(t.token[t.learn], minlength=len(h))[t.order]
        for k, a, b in _split(_bucket(h, buckets)):
            rows.append((WORDS, k, block, h[a:b].astype("<u8").tobytes(), _zip(n[a:b].astype("<u4"))))
        n = t.distinct()
        h = t.pair_hash
        for k, a, b in _split(_bucket(h, buckets)):
            rows.append((BIGRAMS, k, block, _low6(h[a:b]).tobytes(), _zip(n[a:b].astype("<u4"))))
        return pa.table({f.name: pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SENT)}, schema=SENT)

    return run


def _sum(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, their summed counts, and the distinct hash of every entry."""
    h, of = np.unique(np.concatenate(hashes), return_inverse=True)
    return h, np.bincount(of, np.concatenate(counts), len(h)).astype(np.int64), of


TOTALS = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("totals", pa.binary()), ("n", pa.int64()), ("v", pa.int64())])
TOTALS_DDL = "block long, bucket long, totals binary, n long, v long"


def _word_totals(group: pa.Table) -> pa.Table:
    """Per block its words' corpus counts; one row without a block carries the bucket's sums."""
    hashes = [np.frombuffer(x, "<u8") for x in group["hashes"].to_pylist()]
    _, total, of = _sum(hashes, [_unzip(x, "<u4") for x in group["counts"].to_pylist()])
    cuts = np.cumsum([0, *map(len, hashes)])
    bucket = group["bucket"][0].as_py()
    rows = [(b, bucket, _zip(total[of[i:j]].astype("<i8")), None, None) for b, i, j in zip(group["block"].to_pylist(), cuts, cuts[1:])]
    rows.append((None, bucket, None, int(total.sum()), int((total > 0).sum())))
    return pa.table({f.name: pa.array([r[i] for r in rows], f.type) for i, f in enumerate(TOTALS)}, schema=TOTALS)


# --- the filter ------------------------------------------------------------------------------


def level(count: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log2(count)).astype(np.int64)


def found_count(levels: np.ndarray) -> np.ndarray:
    return np.where(levels > 0, np.exp2(np.maximum(levels, 1) - 1.0), 0.0)


def first_probes(vocabulary: int) -> int:
    """Probes of level 1, at 1 / log 2 bits each, that keep a false hit under
    FALSE_WORDS / ``vocabulary``."""
    return max(2 * PROBES, math.ceil(math.log2(max(vocabulary, 1) / FALSE_WORDS)))


def _slots(names: np.ndarray, at_level: int, bits: int, probes: int):
    h = _mix(names + np.uint64(at_level * 0x5851F42D4C957F2D & 0xFFFFFFFFFFFFFFFF))
    step = _mix(h) | np.uint64(1)
    for i in range(probes):
        yield (((h + np.uint64(i) * step) >> np.uint64(32)) * np.uint64(bits) >> np.uint64(32)).astype(np.int64)  # bits < 2**32


def build_segment(names: np.ndarray, counts: np.ndarray, vocabulary: int = 1, bits: int = BITS_PER_ENTRY, probes: int = PROBES) -> np.ndarray:
    """One range of names: the probes of level 1, the size of its bit array and the probes of all
    higher levels (8 bytes each), that array, and the array of the higher levels."""
    levels = level(counts)
    most = first_probes(vocabulary)
    first = np.zeros(max(8, math.ceil(len(names) * most / math.log(2) / 8)), np.uint8)
    higher = np.zeros(max(8, int((levels - 1).sum()) * bits // 8), np.uint8)
    for j in range(1, int(levels.max(initial=0)) + 1):
        out, k = (first, most) if j == 1 else (higher, probes)
        for s in _slots(names[levels >= j], j, len(out) * 8, k):
            np.bitwise_or.at(out, s >> 3, (1 << (s & 7)).astype(np.uint8))
    return np.concatenate([np.array([most, len(first), probes], "<i8").view(np.uint8), first, higher])


def probe_segment(segment: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The level found for each name: probe level 1, 2, .. until one is missing."""
    most, size, probes = (int(x) for x in segment[:24].view("<i8"))
    first, higher = segment[24 : 24 + size], segment[24 + size :]
    out = np.zeros(len(names), np.int64)
    alive = np.arange(len(names))
    for j in range(1, MAX_LEVEL + 1):
        bits, k = (first, most) if j == 1 else (higher, probes)
        ok = np.ones(len(alive), bool)
        for s in _slots(names[alive], j, len(bits) * 8, k):
            ok &= (bits[s >> 3] >> (s & 7) & 1).astype(bool)
        alive = alive[ok]
        if not len(alive):
            break
        out[alive] = j
    return out


def cut_segments(names: np.ndarray, counts: np.ndarray, vocabulary: int, bits: int, room: int) -> list[int]:
    """Where the sorted names of a bucket are cut so that no segment takes more than ``room`` bytes
    (but for a single name); a bucket without names has one segment without any."""
    each = first_probes(vocabulary) / math.log(2) / 8 + (level(counts) - 1) * (bits / 8)
    piece = (np.cumsum(each) / max(room - 48, 1)).astype(np.int64)  # header, two rounded arrays
    return [0, *(1 + np.flatnonzero(piece[1:] != piece[:-1])), len(names)]


def bounded(found: np.ndarray, before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A bigram occurs no more often than either of its words."""
    return np.minimum(found, np.minimum(before, word))


SEGMENT = pa.schema([("bucket", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("shard", pa.int64()), ("segment", pa.binary())])
SEGMENT_DDL = "bucket long, low long, high long, shard long, segment binary"


def _segments(vocabulary: int, bits: int, probes: int, room: int, most: int):
    """The segments of a bucket: each holds the names from ``low`` to ``high`` (48 bits each). A shard
    of them takes at most ``most`` bytes or is one segment."""

    def run(group: pa.Table) -> pa.Table:
        names, total, _ = _sum([_from6(x) for x in group["hashes"].to_pylist()], [_unzip(x, "<u4") for x in group["counts"].to_pylist()])
        names, total = names[total > 0], total[total > 0]
        bucket, rows = group["bucket"][0].as_py(), []
        cuts = cut_segments(names, total, vocabulary, bits, room)
        shard, left = -1, 0
        for a, b in zip(cuts, cuts[1:]):
            s = build_segment(names[a:b], total[a:b], vocabulary, bits, probes)
            if shard < 0 or len(s) > left:
                shard, left = shard + 1, most
            left -= len(s)
            rows.append((bucket, int(names[a]) if a else 0, int(names[b]) - 1 if b < len(names) else (1 << 48) - 1, shard, s.tobytes()))
        return pa.table({f.name: pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SEGMENT)}, schema=SEGMENT)

    return run


# --- probing, weights, scores ------------------------------------------------------------------


def _of_block(rows: pa.Table, column: str, kind: str) -> np.ndarray:
    """A block's answers in bucket order, which is hash order. A bucket whose segments make
    several shards has an answer from each, which is 0 where it is not the name's."""
    rows = rows.filter(rows[column].is_valid())
    parts: dict[int, np.ndarray] = {}
    for k, x in zip(rows["bucket"].to_pylist(), rows[column].to_pylist()):
        x = _unzip(x, kind)
        parts[k] = parts[k] + x if k in parts else x
    return np.concatenate([np.zeros(0, kind), *(parts[k] for k in sorted(parts))])


def _counts(t: Tokens, answers: pa.Table) -> np.ndarray:
    """Corpus count per word number; the start has as many as the end."""
    c = np.empty(len(t.hash), np.int64)
    c[t.order] = _of_block(answers, "totals", "<i8")
    c[START] = c[END]
    return c


def _magnitude(c: np.ndarray) -> np.ndarray:
    return np.minimum(level(np.maximum(c, 1)), MAGNITUDES - 1) * (c > 0)


LEVELS = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("levels", pa.binary())])
LEVELS_DDL = "block long, bucket long, levels binary"


def _probe(sent: pa.Table, segments: pa.Table) -> pa.Table:
    """Levels of a bucket's staged bigrams that fall into the given segments of it."""
    rows = []
    if segments.num_rows:
        parts = [(low, high, np.frombuffer(x.as_buffer(), np.uint8)) for low, high, x in zip(segments["low"].to_pylist(), segments["high"].to_pylist(), segments["segment"])]
        for block, bucket, hashes in zip(sent["block"].to_pylist(), sent["bucket"].to_pylist(), sent["hashes"]):
            names = _from6(hashes.as_py())
            levels = np.zeros(len(names), np.uint8)
            for low, high, segment in parts:
                here = np.flatnonzero((names >= low) & (names <= high))
                levels[here] = probe_segment(segment, names[here])
            rows.append((block, bucket, _zip(levels)))
    return pa.table({f.name: pa.array([r[i] for r in rows], f.type) for i, f in enumerate(LEVELS)}, schema=LEVELS)


def _likelihood(n: int, v: int):
    """The leave-one-out log likelihood of a block's training tokens for each grid weight, by
    magnitude of the first word's count."""

    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table({"sums": pa.array([], pa.binary())})
        t = Tokens(group)
        times = t.distinct()
        c = _counts(t, answers)
        at = np.flatnonzero(times)
        times, first, word = times[at], c[t.before[at]], t.word[at]
        levels = _of_block(answers, "levels", np.uint8)[at].astype(np.int64)
        rest = np.maximum(bounded(found_count(levels), first, c[word]) - 1, 0) / np.maximum(first - 1, 1)
        w = ((c + 0.5) / (n + 0.5 * (v + 1)))[word]
        m = _magnitude(first)
        sums = np.zeros((MAGNITUDES, len(GRID)))
        for g, x in enumerate(GRID):
            sums[:, g] = np.bincount(m, times * np.log10(x * rest + (1 - x) * w), MAGNITUDES)
        return pa.table({"sums": pa.array([sums.astype("<f8").tobytes()], pa.binary())})

    return run


SUMS = pa.schema([("m", pa.int32()), ("g", pa.int32()), ("s", pa.float64())])


def _grid_sums(batches):
    """Rows (m, g, s) of the blocks' likelihood sums, added up per task."""
    sums = np.zeros((MAGNITUDES, len(GRID)))
    for b in batches:
        for x in b["sums"]:
            sums += np.frombuffer(x.as_buffer(), "<f8").reshape(sums.shape)
    for m, g in zip(*np.nonzero(sums)):
        yield int(m), int(g), float(sums[m, g])


SCORE = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)
SCORE_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(n: int, v: int, weights: list[float]):
    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not group.num_rows:
            return SCORE.empty_table()
        t = Tokens(group)
        pair = t.located()
        c = _counts(t, answers)
        uni = (c + 0.5) / (n + 0.5 * (v + 1))
        levels = _of_block(answers, "levels", np.uint8)
        found = found_count(levels.astype(np.int64))
        first = c[t.before]
        b = np.array(weights)[_magnitude(first)]
        p = np.log10(b * bounded(found, first, c[t.word]) / np.maximum(first, 1) + (1 - b) * uni[t.word])
        add = lambda x: np.add.reduceat(x, t.first)  # noqa: E731  every document has its end token
        return pa.table(
            [t.doc, t.held, t.size, add((c[t.token] > 0).astype(np.int64)), np.full(len(t.doc), n), add(np.log10(uni)[t.token]), add(p[pair])], schema=SCORE
        )

    return run


def _filed(sent: DataFrame, buckets: int) -> DataFrame:
    """What the blocks sent, written once in files by bucket: sums and probes of a bucket read its
    file only and need no further shuffle."""
    spark = sent.sparkSession
    path, name = scratch_path(spark, "lm-counts"), f"flowmart_lm_{uuid.uuid4().hex}"
    writer = sent.repartition(buckets, "bucket").write.mode("error").partitionBy("kind").bucketBy(buckets, "bucket")
    writer.option("path", path).option("compression", "zstd").saveAsTable(name)
    made(path)
    return spark.table(name)


def score_documents(docs: DataFrame, bits: int = BITS_PER_ENTRY, probes: int = PROBES) -> DataFrame:
    """Train on the documents that are not held out and score all of them. ``bits`` and ``probes``
    are those of the levels from 2 on."""
    spark = docs.sparkSession
    texts = blocked(docs.select("doc_id", "text"), BLOCK_ROWS)
    buckets = shuffle_partitions(spark)
    sent = _filed(texts.groupBy(BLOCK).applyInArrow(_send(buckets), SENT_DDL), buckets)
    totals = stage(sent.where(F.col("kind") == WORDS).groupBy("bucket").applyInArrow(_word_totals, TOTALS_DDL), "lm-totals")
    n, v = totals.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()

    bigrams = sent.where(F.col("kind") == BIGRAMS)
    segments = stage(bigrams.groupBy("bucket").applyInArrow(_segments(v, bits, probes, SEGMENT_BYTES, SHARD_BYTES), SEGMENT_DDL), "lm-filter")
    rounds = segments.agg(F.coalesce(F.max("shard") + 1, F.lit(0))).first()[0]
    levels_path = scratch_path(spark, "lm-levels")
    made(levels_path)
    spark.createDataFrame([], LEVELS_DDL).write.parquet(levels_path)
    own = bigrams.select("block", "bucket", "hashes")
    for shard in range(rounds):
        part = segments.where(F.col("shard") == shard).select("bucket", "low", "high", "segment")
        own.groupBy("bucket").cogroup(part.groupBy("bucket")).applyInArrow(_probe, LEVELS_DDL).write.mode("append").parquet(levels_path)
    levels = spark.read.schema(LEVELS_DDL).parquet(levels_path)
    nothing = F.lit(None).cast("binary")
    answers = (
        totals.where(F.col("block").isNotNull())
        .select(F.col("block").alias(BLOCK), "bucket", "totals", nothing.alias("levels"))
        .unionByName(levels.select(F.col("block").alias(BLOCK), "bucket", nothing.alias("totals"), "levels"))
    )
    both = texts.groupBy(BLOCK).cogroup(answers.groupBy(BLOCK))

    best: dict[int, int] = {}
    if rounds:
        sums = both.applyInArrow(_likelihood(n, v), "sums binary").mapInArrow(arrow_rows(_grid_sums, SUMS), "m int, g int, s double")
        picked = sums.groupBy("m", "g").agg(F.sum("s").alias("s")).groupBy("m").agg(F.max_by("g", F.struct("s", -F.col("g"))))
        best = dict(picked.collect())  # MAGNITUDES rows at most
    weights = [float(GRID[best[m]]) if m and m in best else 0.0 for m in range(MAGNITUDES)]
    return both.applyInArrow(_score(n, v, weights), SCORE_DDL)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
