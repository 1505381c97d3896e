"""Removal of byte passages that an earlier document already holds, by hash-compared suffix sorting.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts in a document with
a smaller ``doc_id``. Suffixes are sorted to that depth: prefix polynomial hashes give
the hash of any substring, a binary search on them finds the common extension of two
suffixes, so a comparison costs log(LENGTH) hash look-ups; a merge sort with that comparison
brings equal strings together, and the order of neighbours is verified byte by byte. Where two
different strings share a hash, the strings concerned are grouped by their bytes instead.

To sort only what can matter, each window of LENGTH bytes is filed under its *anchor*: its
leftmost minimal ``GRAM``-byte substring by hash. Equal windows have equal anchors at equal
offsets. The passes (see blocks.py; texts are written once and not shuffled):

1. per block, the distinct anchor hashes (6 bytes each), sent by hash;
2. hashes that occur in more than one document go back to their blocks;
3. per block, the distinct stretches of text around shared anchors with their smallest
   ``doc_id``, sent by anchor hash; a passage that a third of all documents share is one
   entry per block;
4. per hash bucket, the suffix sort of the stretches' windows; each stretch gets, for
   each of its windows, the smallest ``doc_id`` that holds it;
5. per block, every window whose smallest holder is an earlier document is removed.

Edge cases: null text is empty; texts shorter than LENGTH keep all bytes; rows without a
``doc_id`` are kept whole and remove nothing elsewhere; rows with equal ids do not remove
from each other; an empty table gives an empty result; extra columns are ignored by the
digests and kept by ``drop_repeats`` (whose text drops what is left of a split character).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.llm.blocks import BLOCK, blocked
from flowmart.llm.common import shuffle_partitions, stage, table

LENGTH = 50
GRAM = 20
REACH = LENGTH - GRAM + 1  # places of the anchor inside a window
PIECE = 1 << 19  # window starts that are worked on at a time
SORT_WINDOWS = 1 << 19  # windows that are sorted at a time (whole anchor groups)

_RNG = np.random.default_rng(20240607)
_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the largest length asked for."""
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS[:] = []
        for base in (_BASE, _INVERSE):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS.append(np.cumprod(p, out=p))
    return _POWERS[0][:n], _POWERS[1][:n]


class PrefixHashes:
    """Polynomial prefix hashes modulo 2**64 of a byte array: the hash of any substring is
    (prefix[i + n] - prefix[i]) divided by base**i."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        values = _VALUE[data]
        values *= powers[: len(data)]
        np.cumsum(values, out=self.prefix[1:])

    def at(self, i: np.ndarray, n) -> np.ndarray:
        return (self.prefix[i + n] - self.prefix[i]) * self.inverse[i]

    def every(self, n: int) -> np.ndarray:
        """The hash of every substring of ``n`` bytes."""
        h = self.prefix[n:] - self.prefix[:-n]
        h *= self.inverse[: len(h)]
        return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, .. (size[0] numbers), then the same from begin[1], and so on."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Texts:
    """The texts of a block as one byte array."""

    def __init__(self, group: pa.Table):
        texts = [(t.as_py() or "").encode() for t in group["text"]]
        self.raw = texts
        size = np.array([len(t) for t in texts], np.int64)
        self.end = np.cumsum(size)
        self.start = self.end - size
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        ids = group["doc_id"].cast(pa.int64())
        self.known = ~np.asarray(ids.is_null())
        self.doc = ids.fill_null(0).to_numpy()

    def anchors(self) -> Iterator[tuple[np.ndarray, ...]]:
        """Per piece of the text: (hash, anchor place, first and last window start, row, hash of
        the stretch from the first window to the last one's end) of every anchor; an anchor
        stands for a run of neighbouring windows that share it."""
        n = len(self.data)
        low = np.uint64((1 << 20) - 1)
        for a in range(0, max(0, n - LENGTH + 1), PIECE):
            b = min(a + PIECE, n - LENGTH + 1)  # window starts a .. b - 1
            hashes = PrefixHashes(self.data[a : b + LENGTH - 1])
            h = _mixed(hashes.every(GRAM))
            best = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # of equal hashes the leftmost
            for k in (1, 2, 4, 8):
                best = np.minimum(best[:-k], best[k:])
            place = (np.minimum(best[: b - a], best[15 : 15 + b - a]) & low).astype(np.int64)
            r0, r1 = np.searchsorted(self.end, [a, b - 1], side="right")
            size = np.minimum(self.end[r0 : r1 + 1], b) - np.maximum(self.start[r0 : r1 + 1], a)
            usable = np.where(self.known[r0 : r1 + 1], np.clip(self.end[r0 : r1 + 1] - LENGTH + 1 - np.maximum(self.start[r0 : r1 + 1], a), 0, size), 0)
            inside = np.repeat(np.tile([True, False], len(size)), np.stack([usable, size - usable], axis=1).ravel())
            edge = np.empty(b - a, bool)
            edge[:1] = True
            edge[1:] = place[1:] != place[:-1]
            begins = np.cumsum(size) - size
            edge[begins[size > 0]] = True
            edge[1:] |= inside[1:] != inside[:-1]
            first = np.flatnonzero(edge)
            last = np.append(first[1:], b - a) - 1
            good = inside[first]
            first, last = first[good], last[good]
            row = np.searchsorted(self.end, a + first, side="right")
            whole = hashes.at(first, last - first + LENGTH) ^ (last - first).astype(np.uint64)
            yield h[place[first]], a + place[first], a + first, a + last, row, whole


assert REACH == 31  # the doubling above covers 16 + 15 places


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)


def _name(h: np.ndarray) -> np.ndarray:
    """The 48 bits by which a hash is known inside its bucket."""
    return h >> np.uint64(16)


def _pack48(names: np.ndarray) -> bytes:
    return names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _zip(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(data)


def _unzip(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


# --- pass 1 and 2: shared anchors -------------------------------------------------------

SEEN = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("once", pa.binary()), ("more", pa.binary())])
SEEN_DDL = "bucket long, block long, once binary, more binary"
SHARED = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("names", pa.binary())])
SHARED_DDL = "block long, bucket long, names binary"


def _seen(buckets: int):
    """The block's distinct anchors, apart by whether one or several of its documents hold them."""

    def run(group: pa.Table) -> pa.Table:
        block, texts = group[BLOCK][0].as_py(), Texts(group)
        hashes, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for h, _, _, _, row, _ in texts.anchors():
            hashes.append(h)
            docs.append(texts.doc[row])
        h, d = np.concatenate(hashes), np.concatenate(docs)
        order = np.argsort(h, kind="stable")
        h, d = h[order], d[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1])[: len(h)])
        rows = []
        if len(h):
            several = np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first)
            h = h[first]
            of = _bucket(h, buckets)
            order = np.argsort(of, kind="stable")
            h, several, of = h[order], several[order], of[order]
            edges = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            for a, b in zip(edges, np.append(edges[1:], len(of))):
                part, s = _name(h[a:b]), several[a:b]
                rows.append((int(of[a]), block, _pack48(part[~s]), _pack48(part[s])))
        return pa.table({f.name: pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SEEN)}, schema=SEEN)

    return run


def _shared(group: pa.Table) -> pa.Table:
    """Anchors of one bucket that more than one document holds, for each block that has them."""
    names, blocks, sure = [], [], []
    for i, (once, more) in enumerate(zip(group["once"], group["more"])):
        for data, s in ((once.as_py(), False), (more.as_py(), True)):
            x = _unpack48(data)
            names.append(x)
            blocks.append(np.full(len(x), i, np.int32))
            sure.append(np.full(len(x), s))
    x, b, s = np.concatenate(names), np.concatenate(blocks), np.concatenate(sure)
    order = np.argsort(x, kind="stable")
    x, b, s = x[order], b[order], s[order]
    same = x[1:] == x[:-1]
    keep = s.copy()
    keep[1:] |= same
    keep[:-1] |= same
    x, b = x[keep], b[keep]
    order = np.argsort(b, kind="stable")
    x, b = x[order], b[order]
    edges = np.flatnonzero(np.append(True, b[1:] != b[:-1])[: len(b)])
    block, bucket = group["block"].to_numpy(), group["bucket"][0].as_py()
    rows = [(int(block[b[i]]), bucket, _pack48(x[i:j])) for i, j in zip(edges, np.append(edges[1:], len(b)))]
    return pa.table({f.name: pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SHARED)}, schema=SHARED)


# --- pass 3: stretches -------------------------------------------------------------------

STRETCH = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("sizes", pa.binary()), ("places", pa.binary()), ("text", pa.binary()), ("docs", pa.binary())])
STRETCH_DDL = "bucket long, block long, sizes binary, places binary, text binary, docs binary"


class Stretches:
    """The occurrences of shared anchors in a block, and its distinct stretches around them in
    order of bucket and hash. ``one[k]`` is an occurrence of distinct stretch k, ``which`` the
    stretch of each occurrence."""

    def __init__(self, texts: Texts, shared: dict[int, bytes], buckets: int):
        known = [np.zeros(0, np.uint64)]
        for k, names in shared.items():
            known.append(_unpack48(names) * np.uint64(buckets) + np.uint64(k))
        known = np.sort(np.concatenate(known))
        found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(5)] + [[np.zeros(0, np.uint64)]]
        for h, place, first, last, row, whole in texts.anchors():
            if not len(known) or not len(h):
                continue
            of = _bucket(h, buckets)
            name = _name(h) * np.uint64(buckets) + of.astype(np.uint64)
            at = np.flatnonzero(known[np.minimum(np.searchsorted(known, name), len(known) - 1)] == name)
            for out, x in zip(found, (of, place, first, last, row, whole)):
                out.append(x[at])
        self.bucket, self.place, self.first, self.last, self.row, whole = map(np.concatenate, found)
        self._group(texts, whole)
        if not self._verified(texts):  # two strings share a hash: by their bytes instead
            self._group(texts, _byte_ids(texts.data, self.first, self.last - self.first + LENGTH))
        self.cuts = np.searchsorted(self.bucket[self.one], np.arange(buckets + 1))

    def _group(self, texts: Texts, whole: np.ndarray) -> None:
        order = np.lexsort((whole, self.bucket))
        new = np.append(True, (whole[order][1:] != whole[order][:-1]) | (self.bucket[order][1:] != self.bucket[order][:-1]))[: len(order)]
        starts = np.flatnonzero(new)
        self.one = order[starts]
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.docs = np.minimum.reduceat(texts.doc[self.row][order], starts) if len(order) else np.zeros(0, np.int64)

    def _verified(self, texts: Texts) -> bool:
        """Whether occurrences that share a hash have the same bytes."""
        one = self.one[self.which]
        more = np.flatnonzero(one != np.arange(len(one)))
        for a in range(0, len(more), 1 << 15):
            i, j = more[a : a + (1 << 15)], one[more[a : a + (1 << 15)]]
            size = self.last[i] - self.first[i] + LENGTH
            if not _same(texts.data, self.first[i], size, self.first[j], self.last[j] - self.first[j] + LENGTH):
                return False
        return True


def _same(data: np.ndarray, i: np.ndarray, i_size: np.ndarray, j: np.ndarray, j_size: np.ndarray) -> bool:
    """Whether the strings at ``i`` are, byte by byte, those at ``j``."""
    return np.array_equal(i_size, j_size) and np.array_equal(data[_ranges(i, i_size)], data[_ranges(j, j_size)])


def _byte_ids(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A number for each string: the same for equal bytes, and no other."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(data[b : b + n].tobytes(), len(seen)) for b, n in zip(begin.tolist(), size.tolist())], np.uint64)


def _shared_of(rows: pa.Table) -> dict[int, bytes]:
    return {k: v for k, v in zip(rows["bucket"].to_pylist(), rows["names"].to_pylist()) if v}


def _stretches(buckets: int):
    def run(group: pa.Table, shared: pa.Table) -> pa.Table:
        rows = []
        if group.num_rows and shared.num_rows:
            block = group[BLOCK][0].as_py()
            texts = Texts(group)
            s = Stretches(texts, _shared_of(shared), buckets)
            for k, (a, b) in enumerate(zip(s.cuts, s.cuts[1:])):
                if a < b:
                    one = s.one[a:b]
                    first, size = s.first[one], s.last[one] - s.first[one] + LENGTH
                    text = texts.data[_ranges(first, size)].tobytes()
                    places = (s.place[one] - first).astype(np.uint8)
                    rows.append((k, block, size.astype("<u2").tobytes(), places.tobytes(), _zip(text), _zip(s.docs[a:b].astype("<i8").tobytes())))
        return pa.table({f.name: pa.array([r[i] for r in rows], f.type) for i, f in enumerate(STRETCH)}, schema=STRETCH)

    return run


# --- pass 4: the suffix sort ---------------------------------------------------------------


def common_extension(hashes: PrefixHashes, i: np.ndarray, j: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``i`` and ``j``, up to ``most``."""
    low, high = np.zeros(len(i), np.int64), np.full(len(i), most, np.int64)
    while (open_ := low < high).any():
        mid = (low + high + 1) // 2
        same = hashes.at(i, mid) == hashes.at(j, mid)
        low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)
    return low


def _before(data: np.ndarray, hashes: PrefixHashes, i: np.ndarray, j: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """Whether suffix i sorts before suffix j (to depth LENGTH); ``ties`` answers for equal ones."""
    out = ties.copy()
    differ = np.flatnonzero(hashes.at(i, LENGTH) != hashes.at(j, LENGTH))
    i, j = i[differ], j[differ]
    n = common_extension(hashes, i, j, LENGTH - 1)
    out[differ] = data[i + n] < data[j + n]
    return out


def suffix_sort(data: np.ndarray, hashes: PrefixHashes, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The order of ``starts`` by their suffixes inside each group (``group`` ascends): a merge
    sort from runs of one upwards, all merges of a level at once. An element's new place is its
    place in its own run plus its rank in the run it merges with, found by binary search."""
    n = len(starts)
    order = np.arange(n)
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1])[:n])
    size = np.diff(np.append(first, n))
    largest = int(size.max(initial=0))
    base, count = np.repeat(first, size), np.repeat(size, size)
    width = 1
    while width < largest:
        at = np.flatnonzero(count > width)
        p = at - base[at]  # place inside the group
        run = p // width
        other = base[at] + (run ^ 1) * width
        stop = np.minimum(other + width, base[at] + count[at])
        low, high = np.minimum(other, stop), stop
        right = (run & 1).astype(bool)
        mine = starts[order[at]]
        while (open_ := low < high).any():
            o = np.flatnonzero(open_)
            mid = (low[o] + high[o]) // 2
            # elements of the left run precede equal ones of the right run
            less = _before(data, hashes, starts[order[mid]], mine[o], right[o])
            low[o], high[o] = np.where(less, mid + 1, low[o]), np.where(less, high[o], mid)
        rank = low - np.minimum(other, stop)
        pair = base[at] + (run // 2) * 2 * width
        merged = order.copy()
        merged[pair + (p - run * width) + rank] = order[at]
        order = merged
        width *= 2
    return order


def _distinct(whole: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, one, which): the order by ``gram`` and ``whole``, one of each distinct pair, and the pair
    of each element."""
    order = np.lexsort((whole, gram))
    w, g = whole[order], gram[order]
    new = np.append(True, (w[1:] != w[:-1]) | (g[1:] != g[:-1]))[: len(w)]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return order, order[new], which


def smallest_holders(data: np.ndarray, size: np.ndarray, place: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For stretches that lie one after the other in ``data`` (``place``: the anchor inside
    each, ``docs``: a document that holds it): the smallest document that holds each of their
    windows, for all windows in order."""
    begin = np.cumsum(size) - size
    whole, gram = np.empty(len(size), np.uint64), np.empty(len(size), np.uint64)
    cuts = np.searchsorted(begin, np.arange(0, len(data) + PIECE, PIECE))
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            hashes = PrefixHashes(data[begin[a] : begin[b - 1] + size[b - 1]])
            at = begin[a:b] - begin[a]
            whole[a:b] = hashes.at(at, size[a:b]) ^ size[a:b].astype(np.uint64)
            gram[a:b] = hashes.at(at + place[a:b], GRAM)
    # Equal stretches of several blocks are one; groups share the anchor's bytes.
    order, one, which = _distinct(whole, gram)
    for a in range(0, len(order), 1 << 15):
        i, j = order[a : a + (1 << 15)], one[which[order[a : a + (1 << 15)]]]
        i, j = i[i != j], j[i != j]
        if not _same(data, begin[i], size[i], begin[j], size[j]):  # two strings share a hash: by their bytes instead
            order, one, which = _distinct(_byte_ids(data, begin, size), gram)
            break
    least_doc = np.minimum.reduceat(docs[order], np.searchsorted(which[order], np.arange(len(one))))

    count = size[one] - LENGTH + 1
    offset = np.cumsum(count) - count
    out = np.repeat(least_doc, count)
    head = np.flatnonzero(np.append(True, gram[one][1:] != gram[one][:-1]))
    members = np.diff(np.append(head, len(one)))
    many = np.repeat(members > 1, members)
    group_of = np.repeat(np.arange(len(head)), members)
    todo = np.flatnonzero(many)
    # Sort whole groups at a time, about SORT_WINDOWS windows.
    run = np.cumsum(count[todo]) // SORT_WINDOWS
    # a cut must fall between groups: move each one to the next border
    borders = np.append(np.flatnonzero(group_of[todo][1:] != group_of[todo][:-1]) + 1, len(todo))
    wanted = np.flatnonzero(run[1:] != run[:-1]) + 1
    ends = np.unique(np.append(borders[np.searchsorted(borders, wanted)], len(todo))) if len(todo) else []
    a = 0
    for b in ends:
        part = todo[a:b]
        a = b
        where, got = _sorted_windows(data, begin[one[part]], size[one[part]], place[one[part]], group_of[part], least_doc[part])
        out[offset[part][where[0]] + where[1]] = got
    mine = size - LENGTH + 1
    return out[_ranges(offset[which], mine)]


def _sorted_bytes(text: np.ndarray, starts: np.ndarray, pairs: np.ndarray, same: np.ndarray) -> bool:
    """Whether each window of ``pairs`` is, byte by byte, equal to the one before it if ``same`` says so
    and greater if not."""
    span = np.arange(LENGTH)
    for a in range(0, len(pairs), 1 << 16):
        q = pairs[a : a + (1 << 16)]
        x, y = text[starts[q - 1][:, None] + span], text[starts[q][:, None] + span]
        differ = x != y
        at = differ.argmax(axis=1)[:, None]
        less = np.take_along_axis(x, at, 1) < np.take_along_axis(y, at, 1)
        if not np.array_equal(np.where(same[q], ~differ.any(axis=1), less[:, 0]), np.ones(len(q), bool)):
            return False
    return True


def _sorted_windows(data, begin, size, place, group, docs) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """((stretch, window), smallest document) for the windows of stretches of some groups."""
    text = data[_ranges(begin, size)]
    hashes = PrefixHashes(text)
    count = size - LENGTH + 1
    which = np.repeat(np.arange(len(size)), count)
    inner = _ranges(np.zeros(len(size), np.int64), count)
    starts = (np.cumsum(size) - size)[which] + inner
    # only windows with the anchor at the same place can be equal
    key = group[which] * REACH + place[which] - inner
    # a window whose hash no other one of its group has is alone; it needs no sorting
    by = np.lexsort((hashes.at(starts, LENGTH), key))
    starts, key, which, inner = starts[by], key[by], which[by], inner[by]
    h = hashes.at(starts, LENGTH)
    same = (key[1:] == key[:-1]) & (h[1:] == h[:-1])
    several = np.append(False, same) | np.append(same, False)
    starts, key, which, inner = starts[several], key[several], which[several], inner[several]
    if not len(starts):
        return (which, inner), docs[which]
    # the others, in the order of their places, are sorted by their bytes
    by = np.lexsort((which, key))
    starts, key, which, inner = starts[by], key[by], which[by], inner[by]
    order = suffix_sort(text, hashes, starts, key)
    near = np.flatnonzero(key[1:] == key[:-1])
    same = np.zeros(len(starts), bool)  # equal to the one before
    same[near + 1] = hashes.at(starts[order[near]], LENGTH) == hashes.at(starts[order[near + 1]], LENGTH)
    whole = np.bincount(order, minlength=len(order)).max() == 1
    if not whole or not _sorted_bytes(text, starts[order], near + 1, same):  # some strings share a hash: by their bytes instead
        ids = _byte_ids(text, starts, np.full(len(starts), LENGTH))
        order = np.lexsort((ids, key))
        same[1:] = (key[1:] == key[:-1]) & (ids[order[1:]] == ids[order[:-1]])
    which, inner = which[order], inner[order]
    first = np.flatnonzero(~same)
    least = np.repeat(np.minimum.reduceat(docs[which], first), np.diff(np.append(first, len(which))))
    return (which, inner), least


HOLDERS = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("holders", pa.binary())])
HOLDERS_DDL = "block long, bucket long, holders binary"


def _holders(group: pa.Table) -> pa.Table:
    rows = []
    if group.num_rows:
        sizes = [np.frombuffer(x, "<u2").astype(np.int64) for x in group["sizes"].to_pylist()]
        places = np.concatenate([np.frombuffer(x, np.uint8).astype(np.int64) for x in group["places"].to_pylist()])
        docs = np.concatenate([np.frombuffer(_unzip(x), "<i8") for x in group["docs"].to_pylist()])
        data = np.frombuffer(b"".join(map(_unzip, group["text"].to_pylist())), np.uint8)
        least = smallest_holders(data, np.concatenate(sizes), places, docs).astype("<i8")
        bucket, at = group["bucket"][0].as_py(), 0
        for block, size in zip(group["block"].to_pylist(), sizes):
            n = int((size - LENGTH + 1).sum())
            rows.append((block, bucket, _zip(least[at : at + n].tobytes())))
            at += n
    return pa.table({f.name: pa.array([r[i] for r in rows], f.type) for i, f in enumerate(HOLDERS)}, schema=HOLDERS)


# --- pass 5: removal ------------------------------------------------------------------------


def _removed(group: pa.Table, verdicts: pa.Table, buckets: int) -> tuple[Texts, np.ndarray]:
    """The block's texts and, per byte, whether it goes."""
    texts = Texts(group)
    gone = np.zeros(len(texts.data) + 1, np.int32)
    shared = verdicts.filter(verdicts["names"].is_valid()) if verdicts.num_rows else verdicts
    if verdicts.num_rows and shared.num_rows:
        s = Stretches(texts, _shared_of(shared), buckets)
        answers = verdicts.filter(verdicts["holders"].is_valid())
        for k, data in zip(answers["bucket"].to_pylist(), answers["holders"].to_pylist()):
            least = np.frombuffer(_unzip(data), "<i8")
            one = s.one[s.cuts[k] : s.cuts[k + 1]]
            count = s.last[one] - s.first[one] + 1
            begin = np.cumsum(count) - count
            at = np.flatnonzero(s.bucket == k)
            n = s.last[at] - s.first[at] + 1
            earlier = least[_ranges(begin[s.which[at] - s.cuts[k]], n)] < np.repeat(texts.doc[s.row[at]], n)
            window = _ranges(s.first[at], n)[earlier]
            gone[window] += 1  # every window has one anchor, so none comes twice
            gone[window + LENGTH] -= 1
    return texts, np.cumsum(gone[:-1]) > 0


DIGEST = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
DIGEST_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digests(buckets: int):
    def run(group: pa.Table, verdicts: pa.Table) -> pa.Table:
        if not group.num_rows:
            return DIGEST.empty_table()
        texts, gone = _removed(group, verdicts, buckets)
        rows = []
        for doc, a, b, raw in zip(group["doc_id"].to_pylist(), texts.start.tolist(), texts.end.tolist(), texts.raw):
            g = gone[a:b]
            n = int(g.sum())
            spans = int((g[1:] & ~g[:-1]).sum()) + int(g[:1].sum()) if n else 0
            rows.append((doc, b - a, n, spans, hashlib.sha256(texts.data[a:b][~g].tobytes() if n else raw).hexdigest()))
        return pa.table({f.name: pa.array([r[i] for r in rows], f.type) for i, f in enumerate(DIGEST)}, schema=DIGEST)

    return run


def _rows(buckets: int, columns: list[str]):
    def run(group: pa.Table, verdicts: pa.Table) -> pa.Table:
        if not group.num_rows:
            return group.select(columns)
        texts, gone = _removed(group, verdicts, buckets)
        new, sizes = [], []
        for t, n, a, b in zip(group["text"], group["n_chars"].to_pylist() if "n_chars" in columns else [None] * group.num_rows, texts.start.tolist(), texts.end.tolist()):
            g = gone[a:b]
            if g.any():
                kept = texts.data[a:b][~g].tobytes().decode("utf-8", "ignore")
                new.append(kept)
                sizes.append(len(kept))
            else:
                new.append(t.as_py())
                sizes.append(n)
        group = group.set_column(group.column_names.index("text"), "text", pa.array(new, group.schema.field("text").type))
        if "n_chars" in columns:
            group = group.set_column(group.column_names.index("n_chars"), "n_chars", pa.array(sizes, group.schema.field("n_chars").type))
        return group.select(columns)

    return run


def _verdicts(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The blocked table, the rows that pass 5 needs by block, and the number of buckets."""
    table_ = blocked(docs)
    buckets = shuffle_partitions(docs.sparkSession)
    texts = table_.select(BLOCK, "doc_id", "text")
    seen = texts.groupBy(BLOCK).applyInArrow(_seen(buckets), SEEN_DDL)
    shared = stage(seen.groupBy("bucket").applyInArrow(_shared, SHARED_DDL), "suffix-shared")
    stretches = texts.groupBy(BLOCK).cogroup(shared.withColumnRenamed("block", BLOCK).groupBy(BLOCK)).applyInArrow(_stretches(buckets), STRETCH_DDL)
    holders = stage(stretches.groupBy("bucket").applyInArrow(_holders, HOLDERS_DDL), "suffix-holders")
    verdicts = shared.withColumn("holders", F.lit(None).cast("binary")).unionByName(holders.withColumn("names", F.lit(None).cast("binary")))
    return table_, verdicts.withColumnRenamed("block", BLOCK), buckets


def repeat_digests(docs: DataFrame) -> DataFrame:
    """Per document: bytes, bytes removed, removed runs, and the SHA-256 of what is kept."""
    table_, verdicts, buckets = _verdicts(docs.select("doc_id", "text"))
    return table_.groupBy(BLOCK).cogroup(verdicts.groupBy(BLOCK)).applyInArrow(_digests(buckets), DIGEST_DDL)


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text`` (and ``n_chars`` to match)."""
    table_, verdicts, buckets = _verdicts(docs)
    return table_.groupBy(BLOCK).cogroup(verdicts.groupBy(BLOCK)).applyInArrow(_rows(buckets, docs.columns), docs.schema)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"))
