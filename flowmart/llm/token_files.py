"""Token-id files with directly addressable codes.

A file section stores a run of ids as chunk levels: level 0 holds the low byte of every id,
level 1 the next byte of those ids that need one, and so on. Each level but the last has a
bitmap that says which of its entries continue, and a rank directory (set bits before each
block of 512 entries). Entry ``i`` of one level is entry ``rank(i)`` of the next, so any
token, or any run of tokens, is read by slicing: nothing before it is decoded.

Documents are range-partitioned by ``doc_id``; each partition writes its sections in order, as
binary payloads in Parquet rows (any store that Spark can write then serves them). A section
holds at most ``SECTION_TOKENS`` ids unless a single document is longer, so memory is
bounded by one document or one section.

Edge cases: null and empty text give just the end id; documents of equal ``doc_id`` follow
each other by text; a null ``doc_id`` comes first; an empty table writes no section; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmart.llm.common import Memo, arrow_rows, shuffle_partitions, table
from flowmart.session import scratch_path

MAGIC = b"DACS"
RANK_BLOCK = 512
SECTION_TOKENS = 1 << 21
SECTION_DOCS = 20_000
MEMO_WORDS = 100_000
MEMO_PIECES = 800_000
MEMO_LETTERS = 64


# --- the code -------------------------------------------------------------------------


def pack(ids: np.ndarray) -> bytes:
    """The section bytes of ``ids`` (unsigned 32-bit)."""
    levels, rest = [], ids.astype("<u4")
    while True:
        chunk, more = (rest & 0xFF).astype(np.uint8), rest > 0xFF
        if not more.any():
            levels.append((len(chunk), chunk.tobytes(), b"", b""))
            break
        ends = np.add.reduceat(more, np.arange(0, len(more), RANK_BLOCK), dtype=np.uint32)
        ranks = np.concatenate([[0], np.cumsum(ends)[:-1]]).astype("<u4")
        levels.append((len(chunk), chunk.tobytes(), np.packbits(more).tobytes(), ranks.tobytes()))
        rest = rest[more] >> 8
    out = [MAGIC, struct.pack("<I", len(levels))]
    for n, chunk, bitmap, ranks in levels:
        out += [struct.pack("<IIII", n, len(chunk), len(bitmap), len(ranks)), chunk, bitmap, ranks]
    return b"".join(out)


class Section:
    """Random access to one packed section."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token section")
        (count,) = struct.unpack_from("<I", data, 4)
        at, self.levels = 8, []
        for _ in range(count):
            n, a, b, c = struct.unpack_from("<IIII", data, at)
            at += 16
            chunk = np.frombuffer(data, np.uint8, a, at)
            bitmap = np.frombuffer(data, np.uint8, b, at + a)
            ranks = np.frombuffer(data, "<u4", c // 4, at + a + b)
            at += a + b + c
            self.levels.append((chunk, bitmap, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        return int(self.slice(i, 1)[0])

    def slice(self, start: int, n: int) -> np.ndarray:
        """The ids ``start`` to ``start + n``: per level one slice, placed by a rank look-up."""
        out = np.zeros(n, np.uint32)
        where = np.arange(n)
        for level, (chunk, bitmap, ranks) in enumerate(self.levels):
            out[where] |= chunk[start : start + n].astype(np.uint32) << np.uint32(8 * level)
            if not len(bitmap):
                break
            first = start // RANK_BLOCK * RANK_BLOCK
            bits = np.unpackbits(bitmap[first // 8 : (start + n + 7) // 8])
            before = int(ranks[first // RANK_BLOCK]) if first // RANK_BLOCK < len(ranks) else 0
            more = bits[start - first : start - first + n].astype(bool)
            start, where = before + int(bits[: start - first].sum()), where[more]
            n = len(where)
            if not n:
                break
        return out


# --- tokens ----------------------------------------------------------------------------


#: Texts in these characters are normalised by lower-casing alone and cut by PIECES; the words
#: of all other texts are looked at one by one and go through the library's whole chain if need be.
SIMPLE = re.compile("[\x09-\x0d\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
#: Fixed value: the model's own split pattern, written for those characters.
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\x09-\x0d\x20a-z0-9\xdf-\xf6\xf8-\xff]+")


class WordEncoder:
    """Ids of whole texts through a ``tokenizers`` model that drops white space.

    White space separates tokens for good in such a model, so a text's ids are those of its
    words in order, and a plain text's ids are those of its pieces; both are looked up in
    bounded memos."""

    def __init__(self, model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_str(model.decode())
        self.bpe = self.tok.model
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        whole = lambda t: self.tok.encode(t, add_special_tokens=False).ids
        if whole("a b") != whole("a") + whole("b"):
            raise ValueError("this model keeps white space; words cannot be encoded apart")
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.pieces = Memo(self._piece, MEMO_PIECES, MEMO_LETTERS)
        self.words = Memo(self._word, MEMO_WORDS, MEMO_LETTERS)
        probe = "It's A-1,Straße:\xc9t\xe9<x>don't42"
        self.plain = b"".join(map(self.pieces.__getitem__, PIECES.findall(probe.lower()))) == array("I", whole(probe)).tobytes()

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = self.byte_level.pre_tokenize_str(piece)[0][0]
        return array("I", [t.id for t in self.bpe.tokenize(piece)]).tobytes()

    def _simple(self, text: str) -> bytes | None:
        if self.plain and SIMPLE.fullmatch(text) and not any(t in text for t in self.added):
            return b"".join(map(self.pieces.__getitem__, PIECES.findall(text.lower())))
        return None

    def _word(self, word: str) -> bytes:
        data = self._simple(word)
        return array("I", self.tok.encode(word, add_special_tokens=False).ids).tobytes() if data is None else data

    def encode(self, text: str) -> bytes:
        """The ids as unsigned 32-bit integers."""
        data = self._simple(text)
        return b"".join(map(self.words.__getitem__, text.split(" "))) if data is None else data


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(model: bytes) -> WordEncoder:
    key = hashlib.sha256(model).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(model)
    return _ENCODERS[key]


# --- files -----------------------------------------------------------------------------

FILE_SCHEMA = pa.schema(
    [
        ("shard", pa.int32()),
        ("section", pa.int32()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())),  # per document: the section's ids up to and with it
        ("payload", pa.binary()),
    ]
)
FILE_DDL = "shard int, section int, n_tokens long, doc_ids array<long>, ends array<long>, payload binary"


def write_token_files(docs: DataFrame, model_path: str, end_id: int, path: str) -> None:
    """Encode every document, append ``end_id``, and write the sections in ascending ``doc_id``
    order under ``path``. One range shuffle of (doc_id, text)."""
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())  # a fixed vocabulary file, under 2 MB
    end = np.array([end_id], "<u4").tobytes()

    def sections(batches: Iterator[dict]) -> Iterator[tuple]:
        from pyspark import TaskContext

        enc, shard, number = word_encoder(model.value), TaskContext.get().partitionId(), 0
        ids: list[bytes] = []
        doc_ids: list = []
        ends: list[int] = []
        total = 0
        for b in batches:
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"]):
                data = enc.encode(text.as_py() or "") + end
                ids.append(data)
                total += len(data) // 4
                doc_ids.append(doc_id)
                ends.append(total)
                if total >= SECTION_TOKENS or len(ids) >= SECTION_DOCS:
                    yield shard, number, total, doc_ids, ends, pack(np.frombuffer(b"".join(ids), "<u4"))
                    ids, doc_ids, ends, total, number = [], [], [], 0, number + 1
        if ids:
            yield shard, number, total, doc_ids, ends, pack(np.frombuffer(b"".join(ids), "<u4"))

    parts = shuffle_partitions(spark)
    (
        docs.select("doc_id", "text")
        .repartitionByRange(parts, F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
        .mapInArrow(arrow_rows(sections, FILE_SCHEMA, 1), FILE_DDL)
        .write.mode("error")
        .option("compression", "uncompressed")  # the payload is to be read by slices
        .parquet(path)
    )


READ_SCHEMA = pa.schema([("shard", pa.int32()), ("section", pa.int32()), ("doc_id", pa.int64()), ("local", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files under ``path``: where its ids start in the whole stream, how
    many there are, and the CRC-32 of those ids read back through random access."""
    files = spark.read.parquet(path)

    def digests(batches: Iterator[dict]) -> Iterator[tuple]:
        for b in batches:
            for shard, number, doc_ids, ends, payload in zip(b["shard"].to_pylist(), b["section"].to_pylist(), b["doc_ids"], b["ends"], b["payload"]):
                section, at = Section(payload.as_buffer()), 0
                for doc_id, end in zip(doc_ids.as_py(), ends.as_py()):
                    yield shard, number, doc_id, at, end - at, zlib.crc32(section.slice(at, end - at).astype("<u4"))
                    at = end

    local = files.select("shard", "section", "doc_ids", "ends", "payload").mapInArrow(
        arrow_rows(digests, READ_SCHEMA), "shard int, section int, doc_id long, local long, n_tokens long, ids_crc32 long"
    )
    # One row per section: the running totals over them are small work, and only the digests meet them.
    by_shard = files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before_shard = by_shard.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    before_section = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("section")) - F.col("n_tokens")
    starts = (
        files.select("shard", "section", "n_tokens")
        .withColumn("in_shard", before_section)
        .join(before_shard, "shard")
        .select("shard", "section", (F.col("shard_start") + F.col("in_shard")).alias("section_start"))
    )
    return local.join(starts, ["shard", "section"]).select("doc_id", (F.col("section_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: The end id that the production query appends to each document.
END_ID = 2


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), model_path(), END_ID, path)
    return read_token_digests(spark, path)
