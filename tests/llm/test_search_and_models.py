"""Operators 1, 2 and 9, and the pipeline."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from flowmart.llm import html_extraction, lm_scoring, topk
from flowmart.llm.crf import ChainCRF
from tests.llm.helpers import SCHEMA, documents, empty, rows


def test_bloom_levels():
    rng = np.random.default_rng(2)
    names = rng.integers(1, 2**48, 4000, dtype=np.uint64)
    counts = rng.integers(1, 5000, 4000)
    segment = lm_scoring.build_segment(names, counts)
    found = lm_scoring.probe_segment(segment, names)
    assert (found >= lm_scoring.level(counts)).all(), "no level that was stored is missed"
    assert (found == lm_scoring.level(counts)).mean() > 0.95
    other = lm_scoring.probe_segment(segment, rng.integers(1, 2**48, 4000, dtype=np.uint64))
    assert (other > 0).mean() < 0.05


def test_false_hits_do_not_make_probability():
    rng = np.random.default_rng(4)
    vocabulary, stored = 300_000, 20_000
    names = rng.integers(1, 2**48, stored, dtype=np.uint64)
    segment = lm_scoring.build_segment(names, rng.integers(1, 50, stored), vocabulary)
    unseen = rng.integers(1, 2**48, 10 * vocabulary, dtype=np.uint64)  # ten words with all that may follow
    assert (lm_scoring.probe_segment(segment, unseen) > 0).sum() <= 10
    found, before, word = (np.array(x) for x in ([8.0, 8.0, 8.0, 4.0], [9, 3, 9, 9], [0, 9, 5, 9]))
    assert lm_scoring.bounded(found, before, word).tolist() == [0, 3, 5, 4], "no more often than either word"


@pytest.mark.parametrize("shard_bytes", [lm_scoring.SHARD_BYTES, 64])
def test_lm_scores(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(lm_scoring, "SHARD_BYTES", shard_bytes)
    data = rows(n=120)
    tokens = [(d, [*(t or "").encode().lower().split(), None]) for d, t, *_ in data]
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 5 == 1
    c = Counter(w for d, ws in tokens if not held(d) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted(((str(d), held(d), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for d, ws in tokens))
    got = lm_scoring.score_documents(documents(spark, data)).collect()
    assert sorted((str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    for part in ([r for r in got if r["held_out"]], got):
        assert sum(r["score"] for r in part) >= sum(r["base_score"] for r in part)


def test_lm_shards_do_not_change_scores(spark, monkeypatch):
    docs = documents(spark).select("doc_id", "text")
    one = sorted((str(r["doc_id"]), r["n_tokens"], round(r["score"], 9)) for r in lm_scoring.score_documents(docs).collect())
    monkeypatch.setattr(lm_scoring, "SHARD_BYTES", 64)
    assert one == sorted((str(r["doc_id"]), r["n_tokens"], round(r["score"], 9)) for r in lm_scoring.score_documents(docs).collect())


def test_lm_filter_does_not_pass_the_driver(spark, monkeypatch):
    """Segments of a few bytes, each a shard of its own: the same scores, and no broadcast of the filter."""
    docs = documents(spark, rows(n=120)).select("doc_id", "text")
    one = sorted((str(r["doc_id"]), r["n_tokens"], r["score"] < 0) for r in lm_scoring.score_documents(docs).collect())
    monkeypatch.setattr(lm_scoring, "SHARD_BYTES", 64)
    monkeypatch.setattr(lm_scoring, "SEGMENT_BYTES", 2048)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda *a: pytest.fail("the filter is broadcast"))
    assert one == sorted((str(r["doc_id"]), r["n_tokens"], r["score"] < 0) for r in lm_scoring.score_documents(docs).collect())


def brute_bigram_scores(data):
    """Interpolated bigrams with counts rounded down to powers of two, weights by leave-one-out."""
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 5 == 1
    docs = [(d, ["<s>", *(t or "").encode().lower().split(), None]) for d, t, *_ in data]
    c, pairs = Counter(), Counter()
    for d, ws in docs:
        if not held(d):
            c.update(ws[1:])
            pairs.update(zip(ws, ws[1:]))
    n, v = sum(c.values()), len(c)
    c["<s>"] = c[None]
    uni = lambda w: (c[w] + 0.5) / (n + 0.5 * (v + 1))
    found = lambda a, b: min(2 ** (pairs[a, b].bit_length() - 1) if pairs[a, b] else 0, c[a], c[b])
    sums = {}
    for (a, b), times in pairs.items():
        rest = max(found(a, b) - 1, 0) / max(c[a] - 1, 1)
        for x in lm_scoring.GRID:
            key = (c[a].bit_length(), float(x))
            sums[key] = sums.get(key, 0.0) + times * math.log10(x * rest + (1 - x) * uni(b))
    weight = {m: max((s, -x) for (k, x), s in sums.items() if k == m)[1] * -1 for m in {k for k, _ in sums}}
    out = []
    for d, ws in docs:
        score = 0.0
        for a, b in zip(ws, ws[1:]):
            x = weight.get(c[a].bit_length(), 0.0) if c[a] else 0.0
            score += math.log10(x * found(a, b) / max(c[a], 1) + (1 - x) * uni(b))
        out.append((str(d), len(ws) - 1, round(score, 6)))
    return sorted(out)


@pytest.mark.parametrize("segment_bytes", [lm_scoring.SEGMENT_BYTES, 2000])
def test_lm_scores_equal_brute_force_bigrams(spark, monkeypatch, segment_bytes):
    monkeypatch.setattr(lm_scoring, "SEGMENT_BYTES", segment_bytes)
    data = rows(n=100)
    got = lm_scoring.score_documents(documents(spark, data), bits=64, probes=16).collect()  # next to no false hits
    assert sorted((str(r["doc_id"]), r["n_tokens"], round(r["score"], 6)) for r in got) == brute_bigram_scores(data)


def test_lm_segments_keep_their_bound():
    rng = np.random.default_rng(6)
    names = np.unique(rng.integers(1, 2**48, 5000, dtype=np.uint64))
    counts = rng.integers(1, 3000, len(names))
    cuts = lm_scoring.cut_segments(names, counts, 10_000, 8, 4096)
    assert cuts[0] == 0 and cuts[-1] == len(names) and all(a < b for a, b in zip(cuts, cuts[1:])) and len(cuts) > 10
    for a, b in zip(cuts, cuts[1:]):
        segment = lm_scoring.build_segment(names[a:b], counts[a:b], 10_000)
        assert len(segment) <= 4096
        assert (lm_scoring.probe_segment(segment, names[a:b]) >= lm_scoring.level(counts[a:b])).all()
    assert lm_scoring.cut_segments(names[:0], counts[:0], 1, 8, 4096) == [0, 0]


def test_lm_shards_read_each_name_once(spark, monkeypatch):
    """A shard probes the staged names of its own buckets and no text."""
    monkeypatch.setattr(lm_scoring, "SHARD_BYTES", 64)
    probed = []
    real = lm_scoring._probe
    monkeypatch.setattr(lm_scoring, "_probe", lambda shard: probed.append(set(shard.value)) or real(shard))
    lm_scoring.score_documents(documents(spark).select("doc_id", "text"))
    assert len(probed) > 1 and sum(map(len, probed)) == len(set().union(*probed))


def test_lm_empty_and_untrained(spark):
    assert lm_scoring.score_documents(empty(spark)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    (r,) = lm_scoring.score_documents(spark.createDataFrame([(held, "a b", None, None, 3)], SCHEMA)).collect()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)


def brute_top(vectors, k):
    ints = {}
    for i, v, *_ in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints[i] = [math.floor(64 * x) for x in v]
    out = []
    for q in sorted(i for i in ints if i % 20 == 0):
        scored = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return out


@pytest.mark.parametrize("spread", [1.0, 0.05, 40.0])
def test_top_k(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    rng = random.Random(1)
    data = [(i, [rng.gauss(0, spread) for _ in range(8)]) for i in range(180)]
    data += [(200 + i, data[0][1]) for i in range(60)]  # one very common vector: ties
    data += [(300, None), (301, [float("nan")] * 8), (320, [1.0, None, *[0.0] * 6]), (340, [float("inf")] * 8), (None, [1.0] * 8), (360, [0.0] * 8), (20, data[20][1]), (380, [0.5, -0.5]), (400, [])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "2 as query_id", "3 as v")
    df32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in data]
    vectors = topk.integer_vectors(df)
    got = topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint"]
    assert sorted(tuple(r) for r in got.collect()) == brute_top(df32, 20)


@pytest.mark.parametrize("sizes", [(1e10, 1e16), (1.0, 1e16), (1e9, 1e9), (1.0, 1e30), (1e30, 1e30), (1e150, 1e300)])
def test_top_k_is_exact_for_large_components(spark, monkeypatch, sizes):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 20)
    rng = random.Random(3)
    data = [(i, [rng.choice((-1, 1)) * rng.random() * sizes[i % 3 == 0] for _ in range(6)]) for i in range(70)]
    data += [(70 + i, data[3 * i][1]) for i in range(8)] + [(80, [sizes[1]] * 6), (81, [sizes[1], *[0.0] * 5]), (90, [1.7e308] * 6)]
    usable = [(i, v) for i, v in data if all(math.isfinite(64 * x) for x in v)]
    vectors = topk.integer_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    got = topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 12).collect()
    clip = lambda x: max(-(2**63), min(2**63 - 1, x))
    assert sorted(tuple(r) for r in got) == [(q, r, i, clip(s)) for q, r, i, s in brute_top(usable, 12)]


def test_top_k_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = topk.integer_vectors(spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], schema))
    assert [tuple(r) for r in topk.top_k(few, few.where("vec_id = 0"), 20).orderBy("rank").collect()] == [(0, 1, 1, 64 * 128), (0, 2, 2, -64 * 64)]
    one = few.where("vec_id = 0")
    assert topk.top_k(one, one, 20).count() == 0
    none = few.where("vec_id < 0")
    assert topk.top_k(none, none, 20).count() == 0


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(0)
    m = ChainCRF([f"f{i}" for i in range(6)])
    m.weights, m.step, m.first = rng.normal(size=(6, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    for _ in range(30):
        items = [[f"f{k}" for k in rng.integers(0, 6, 3)] for _ in range(rng.integers(1, 8))]
        e = m.emissions(items)

        def score(s):
            return m.first[s[0]] + sum(e[i, x] for i, x in enumerate(s)) + sum(m.step[a, b] for a, b in zip(s, s[1:]))

        best = max(np.ndindex(*[2] * len(items)), key=score)
        assert score(m.decode(items)) == pytest.approx(score(best))
    assert m.decode([]) == []


def test_crf_on_held_out_pages():
    model = html_extraction.trained_model()
    right = total = 0
    for html, gold in html_extraction.labelled_pages(150, seed=99):
        blocks = html_extraction.leaf_blocks(html)
        assert [b[0] for b in blocks] == [" ".join(t.split()) for t, _ in gold]
        got = model.decode(html_extraction.features(blocks))
        right += sum(a == b for a, (_, b) in zip(got, gold))
        total += len(gold)
    assert right / total > 0.985


def test_formulas_and_fallback_text_reach_the_model():
    for tag in ("math", "svg", "object", "canvas", "noscript"):
        assert [b[0] for b in html_extraction.leaf_blocks(f"<article><p>One <{tag}>two</{tag}> three.</p></article>")] == ["One two three."], tag
    for tag in ("script", "style", "template"):
        assert [b[0] for b in html_extraction.leaf_blocks(f"<article><p>One <{tag}>two</{tag}> three.</p></article>")] == ["One three."], tag


@pytest.mark.parametrize("tag", ["span", "b", "font", "div", "td"])
def test_depth_has_no_limit(spark, tag):
    """Menu and script after thousands of open elements stay what they are."""
    said = "This is the first sentence of the article, which is long enough. And this is its second one, with a comma."
    rest = f'<nav><ul><li><a href="/a">menu entry</a></li></ul></nav><script>var hidden = 1;</script><article><p>{said}</p></article><footer>&copy; here</footer>'
    blocks = html_extraction.leaf_blocks("<html><body>" + f"<{tag}>" * 5000 + rest + "</body></html>")
    assert [b[0] for b in blocks] == ["menu entry", said, "© here"]
    assert ["tag:nav" in b[2] for b in blocks] == [True, False, False] and "tag:footer" in blocks[2][2]
    page = spark.createDataFrame([(1, "u", "<html><body>" + f"<{tag}>" * 5000 + rest)], "page_id long, url string, html string")
    assert html_extraction.extract(page).first()["text"] == said


def test_extraction(spark):
    article = "<article><h1>A  title</h1><p><b>One &amp; two,\n three.<br><p>Be.</p><p>Caf&eacute; &#8364; &am</p></article>"
    page = f'<html><head><title>x</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- c --><div class="ad">Buy now this.</div>{article}<footer>&copy; here</footer></body></html>'
    text = "A title\nOne & two, three.\nBe.\nCafé € &am"
    data = [(1, "u", page), (2, None, page.replace("</footer></body></html>", "")), (3, "u", None), (4, "u", ""), (5, "u", "<p"), (6, "u", "<nav><a>x</a></nav>"), (None, "u", page), (7, "u", "<div>" * 5000 + "deep" + "</div>" * 10), (1, "u", page)]
    df = spark.createDataFrame(data, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    got = html_extraction.extract(df).collect()
    assert len(got) == len(data) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] in (1, 2, None)] == [text] * 4
    assert [r["text"] for r in got if r["page_id"] in (3, 4, 6)] == [""] * 3
    assert html_extraction.extract(df.limit(0)).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    from flowmart.llm import minhash_dedup, mixing, quality, sentencepiece_bpe, suffix_dedup
    from flowmart.llm.common import stage

    documents(spark, extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "suffix_dedup", "mixing", "encode"]
    for _, step in corpus_pipeline.STAGES:
        before = docs
        docs = stage(step(spark, docs, str(tmp_path)), "test-pipeline")
        if step is not corpus_pipeline.encode_stage:
            assert docs.schema == before.schema
    got = sorted((r["doc_id"], r["ids"], r["decoded"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == sorted((r["doc_id"], r["ids"], r["decoded"]) for r in docs.collect()) and got
    empty(spark).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
