"""Operators 4 and 5: tokenisation against the public libraries, and the file format."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from flowmart.llm import sentencepiece_bpe, token_files
from flowmart.session import scratch_path
from tests.llm.helpers import documents, empty, rows

ALPHABET = "ab éñ\n\t  ▁xthe<s>0x0A123日本🙂éß.,'%    İςΣ²½\x1c\x85|K"


@pytest.fixture(scope="module")
def table():
    with open(sentencepiece_bpe.model_path(), "rb") as f:
        return sentencepiece_bpe.PrefixTable(f.read())


def test_prefix_table_equals_the_library(table):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += [" " * n + w for n in (1, 2, 3, 15, 16, 17, 18, 33, 500) for w in ("", "a", "é", "日")]
    texts += ["ab" * 20_000, "x" * 50_000, " a" * 20_000]
    for t in texts:
        assert table.encode(t) == table.sp.encode(t), t[:80]
        assert table.decode(table.encode(t)) == table.sp.decode(table.sp.encode(t))


def test_long_runs_without_spaces_equal_the_library(table):
    rng = random.Random(9)
    run = lambda alphabet, n=100_000: "".join(rng.choice(alphabet) for _ in range(n))
    han, kana, thai, faces = (list(map(chr, range(*r))) for r in ((0x4E00, 0x9000), (0x3041, 0x30FF), (0xE01, 0xE3A), (0x1F600, 0x1F640)))
    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = [run(a) for a in (han, han + kana, thai, faces, "0123456789abcdef", base64, "\n", "\n\t", "ab\n", "日a1\n🙂")]
    for t in [*texts, "word " + texts[0] + " word", "\n" + texts[4] + "\n"]:
        assert table.encode(t) == table.sp.encode(t), t[:40]


def test_sentencepiece_query_rows(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_bpe.model_path())
    want = []
    for doc_id, text, *_ in rows():
        ids = sp.encode(text or "")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids))))
    got = [tuple(r) for r in sentencepiece_bpe.encode_digests(documents(spark), sentencepiece_bpe.model_path()).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sentencepiece_bpe.encode_digests(empty(spark), sentencepiece_bpe.model_path()).count() == 0
    full = sentencepiece_bpe.encode_documents(documents(spark), sentencepiece_bpe.model_path()).collect()
    assert all(r["ids"] == sp.encode(r["decoded"]) or not r["ids"] for r in full)


def test_codes_are_addressable():
    rng = np.random.default_rng(3)
    for top in (1, 255, 256, 70_000, 2**32 - 1):
        ids = rng.integers(0, top, 3000, dtype=np.uint64, endpoint=True).astype(np.uint32)
        ids[::3] %= 200
        s = token_files.Section(token_files.pack(ids))
        assert len(s) == len(ids) and (s.slice(0, len(ids)) == ids).all()
        for i in (0, 1, 511, 512, 513, 1024, 2999):
            assert s[i] == ids[i]
        for a, n in ((0, 1), (500, 30), (510, 1030), (2999, 1), (17, 0)):
            assert (s.slice(a, n) == ids[a : a + n]).all()
    assert len(token_files.Section(token_files.pack(np.zeros(0, np.uint32)))) == 0


def test_word_encoder_equals_the_library():
    with open(token_files.model_path(), "rb") as f:
        enc = token_files.WordEncoder(f.read())
    tok = Tokenizer.from_file(token_files.model_path())
    rng = random.Random(8)
    parts = [*ALPHABET, "<|endoftext|>", "don't", "STRASSE", "  ", "\x1d"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_token_files_round_trip(spark):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    order = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for doc_id, text, *_ in order:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    path = scratch_path(spark, "test-tokens")
    token_files.write_token_files(documents(spark), token_files.model_path(), token_files.END_ID, path)
    got = [tuple(r) for r in token_files.read_token_digests(spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    path = scratch_path(spark, "test-tokens")
    token_files.write_token_files(empty(spark), token_files.model_path(), token_files.END_ID, path)
    assert token_files.read_token_digests(spark, path).count() == 0
