"""Operators 3, 7 and 10: rules and verdicts against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from flowmart.llm import licenses, mixing, quality
from tests.llm.helpers import SCHEMA, VOCAB, documents, empty, prose, rows

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_targets(sizes: dict) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        share = {s: w[s] * left / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= 2 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


@pytest.mark.parametrize("sources", [3, 1, 25])
def test_mix_meets_its_targets(spark, sources):
    rng = random.Random(sources)
    data = [(i, prose(rng, rng.choice((0, 5, 40, 400))), "en", None if i % 11 == 0 else f"s{int(rng.random() ** 2 * sources)}", 0) for i in range(300)]
    got = [r.asDict() for r in mixing.shares_taken(documents(spark, data)).collect()]
    assert len(got) == 300
    size, sizes = {d: len(WORD.findall(t)) for d, t, *_ in data}, defaultdict(int)
    source = {d: s for d, _, _, s, _ in data}
    for d, n in size.items():
        sizes[source[d]] += n
    want, taken = brute_targets(dict(sizes)), defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) < 1 for s in want)
    again = [r.asDict() for r in mixing.shares_taken(documents(spark, data).repartition(7)).collect()]
    key = lambda r: r["doc_id"]
    assert sorted(got, key=key) == sorted(again, key=key)


def brute_taken(data, target, sizes):
    """Every word by its virtual finish time, cut at the budget."""
    queues, words = defaultdict(list), []
    for i, (d, t, _, s, _) in enumerate(data):
        queues[s].append((hashlib.md5(str(d).encode()).hexdigest(), d, i))
    for s, queue in queues.items():
        at = 0
        for _ in range(2):
            for _, _, i in sorted(queue):
                for _ in WORD.findall(data[i][1] or ""):
                    at += 1
                    words.append((at / target[s], str(s), i))
    taken = Counter(i for *_, i in sorted(words)[: sum(math.floor(target[s]) for s in sizes)])
    return {d: taken[i] for i, (d, *_) in enumerate(data)}


@pytest.mark.parametrize("sources", [2, 7])
def test_one_cut_of_all_words_in_the_order_of_finish_times(spark, sources):
    rng = random.Random(40 + sources)
    lengths = (0, 1, 3, 60, 60, 900)
    data = [(i, " ".join(["w"] * rng.choice(lengths)), "en", f"s{int(rng.random() ** 3 * sources)}", 0) for i in range(120)]
    sizes = Counter()
    for _, t, _, s, _ in data:
        sizes[s] += len(WORD.findall(t))
    sizes = {s: n for s, n in sizes.items() if n}
    data = [r for r in data if r[3] in sizes]
    want = brute_taken(data, brute_targets(sizes), sizes)
    docs = documents(spark, data)
    assert {r["doc_id"]: r["taken"] for r in mixing.shares_taken(docs).collect()} == want
    # the ranges tell where the running total of all sources reaches the budget
    narrow = mixing.sizes_of(docs)
    ranges = mixing.range_totals(mixing.served(narrow, narrow)).collect()
    assert sum(r["words"] for r in ranges) == 2 * sum(sizes.values())
    assert sum(r["words"] for r in ranges if r["range"] <= mixing.RANGES) == ranges[0]["budget"] == sum(want.values())
    assert max(r["range"] for r in ranges) > mixing.RANGES


def test_mix_edge_cases(spark):
    got = mixing.shares_taken(documents(spark)).collect()
    assert len(got) == len(rows()) and all(r["taken"] == 0 for r in got if not r["size"])
    assert mixing.shares_taken(empty(spark)).count() == 0
    assert mixing.mix(empty(spark)).count() == 0
    only_blank = [(1, None, "en", "a", None), (2, " ", "en", None, 1)]
    assert [r["taken"] for r in mixing.shares_taken(documents(spark, only_blank)).collect()] == [0, 0]


def test_mixed_documents_hold_the_words_taken(spark):
    docs = documents(spark)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    words = out.select("doc_id", "text").collect()
    texts = defaultdict(set)
    for d, t, *_ in rows():
        texts[d].add(t)
    got = Counter()
    for r in words:
        got[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert any(t and t.startswith(r["text"]) for t in texts[r["doc_id"]])
    want = Counter()
    for r in mixing.shares_taken(docs).collect():
        want[r["doc_id"]] += r["taken"]
    assert got == Counter({k: v for k, v in want.items() if v})


def brute_statistics(text):
    w = WORD.findall(text or "")
    n = len(w)
    seen = Counter(tuple(w[i : i + 8]) for i in range(n - 7))
    cover = {k for i in range(n - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover), n < 20 or 100 * len(cover) > 30 * n


def quality_data():
    rng = random.Random(12)
    data = [(i, prose(rng, rng.randint(40, 200)), rng.choice(["en", "fr"]), rng.choice(["a", "a", "a", "b", None])) for i in range(400)]
    junk = [(1000 + i, re.sub(r" ", lambda m: rng.choice([" ### ", "%%% ", " | "]), prose(rng, 80)), "en", "a") for i in range(15)]
    line = prose(rng, 9)
    odd = [
        (2000, None, "en", "a"),
        (2001, "", None, None),
        (2002, "\n".join([line] * 6 + [" ", "x"]), "en", "a"),
        (2003, " ".join(["la"] * 500), "en", "b"),
        (2004, "ab cd " * 3000, None, "c"),
        (2005, prose(rng, 20_000), "en", "a"),
        (None, prose(rng, 60), "en", "a"),
    ]
    odd += [odd[-2], odd[-2]]
    return [(a, b, c, d, 0) for a, b, c, d in data + junk + odd]


def test_quality_rules(spark):
    data = quality_data()
    got = quality.judge(documents(spark, data)).collect()
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(((r["doc_id"], *(r[c] for c in cols)) for r in got), key=str) == sorted(((d, *brute_statistics(t)) for d, t, *_ in data), key=str)
    verdict = defaultdict(set)
    for r in got:
        verdict[r["doc_id"]].add(r["kept"])
        assert not (r["base_failed"] and r["kept"])
    assert all(verdict[i] == {True} for i in range(400)), "clean documents stay"
    assert all(verdict[i] == {False} for i in range(1000, 1015)), "symbol junk goes"
    assert verdict[2005] == {True} and verdict[None] == {True}
    kept = quality.keep_good(documents(spark, data))
    assert kept.columns == documents(spark, data).columns
    want = Counter(d for d, *_ in data if verdict[d] == {True})
    assert Counter(r["doc_id"] for r in kept.select("doc_id").collect()) == want


def test_quality_statistics_can_each_decide(spark):
    rng = random.Random(21)
    data = [(i, prose(rng, rng.randint(40, 200)), "en", "a", 0) for i in range(300)]
    runs = [(1000 + i, " ".join(w for w in rng.sample(VOCAB, 16) for _ in range(rng.randint(3, 7))), "en", "a", 0) for i in range(10)]
    lines = [(1100 + i, "\n".join(rng.choice(VOCAB) for _ in range(150)), "en", "a", 0) for i in range(10)]
    data += [*runs, *lines, (1200, prose(rng, 20_000), "en", "a", 0)]
    got = {r["doc_id"]: r for r in quality.judge(documents(spark, data)).collect()}
    assert not any(r["base_failed"] for r in got.values()), "the base rules pass all of them"
    assert all(got[i]["kept"] for i in [*range(300), 1200]), "clean documents stay, also a very long one"
    assert not any(got[i]["kept"] for i in range(1000, 1010)), "runs of one word go"
    assert not any(got[i]["kept"] for i in range(1100, 1110)), "lines that repeat each other go"


def test_quality_empty_and_uniform(spark):
    assert quality.judge(empty(spark)).count() == 0
    assert quality.keep_good(empty(spark)).count() == 0
    same = [(i, "one two three " * 3 + " ".join(f"w{k}" for k in range(30)), "en", "a", 0) for i in range(5)]
    assert all(r["kept"] for r in quality.judge(documents(spark, same)).collect())


PLAIN = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_licence(text):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(PLAIN))
    at, labels = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_licences(spark):
    rng = random.Random(3)
    notices = [
        "Released under the MIT License.",
        "licensed under the Apache License, Version 2.0 - MIT-license",
        "GNU Lesser General Public License as published by the Free Software Foundation",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "LİCENSE mit Kicense mit license éMIT license",
        "mit license mit license general public license " * 400,
        "license " * 3000,
    ]
    texts = [prose(rng, 30) + " " + n + " " + prose(rng, 10) for n in notices] + ["mit license", "MIT", "", None, "...", "mit--license!", prose(rng, 50)]
    data = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    data += [data[0], (None, texts[1], "en", "a", 0)]
    got = {(r["doc_id"], i): r for i, r in enumerate(sorted(licenses.scan(documents(spark, data)).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"])))}
    assert len(got) == len(data)
    by_id = {d: r for (d, _), r in got.items()}
    for d, t, *_ in data:
        r = by_id[d]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_licence(t), t and t[:60]
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "")
    assert "lgpl" in by_id[2]["labels"].split(",") and by_id[3]["labels"] == "bsd" and by_id[4]["labels"] == "mit"
    assert by_id[14]["labels"] == "" and by_id[0]["score"] == pytest.approx(1.0)
    assert licenses.scan(empty(spark)).count() == 0


def brute_labels(texts):
    """Labels and best share per text, every template tried at every start."""
    files = [re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(PLAIN)) for t in texts]
    idf = {w: math.log((len(files) + 1) / (sum(w in f for f in files) + 1)) + 1 for w in licenses.VOCABULARY}
    out = []
    for f in files:
        labels, best = set(), 0.0
        for t in licenses.INDEX:
            total = sum(idf[w] for w in t.words if w)
            for start in range(-max(t.key), len(f)):
                at = lambda i: f[i] if 0 <= i < len(f) else None  # noqa: E731, B023
                if not all(at(start + k) == w for k, w in t.key.items()):
                    continue
                places = set()
                for i, w in enumerate(f):
                    near = sorted((abs(k - i + start), k) for k in range(i - start - t.drift, i - start + t.drift + 1) if 0 <= k < len(t.words) and t.words[k] == w)
                    places |= {k for _, k in near[:1]}
                share = sum(idf[t.words[k]] for k in places) / total
                if share >= t.need - 1e-9:
                    labels.add(t.label)
                    best = max(best, share)
        out.append((labels, best))
    return out


def test_licence_labels_against_every_template_at_every_start(spark):
    assert all(set(i for i, w in enumerate(t.words) if w) > set(t.key) for t in licenses.INDEX), "no template is its key phrase alone"
    rng = random.Random(8)
    texts = [
        "All rights reserved.",
        "not under the isc license at all",
        "Redistribution and use in source and binary forms, with or without modification, are permitted. All rights reserved.",
        "Licensed under CC BY-NC 4.0.",
        "we looked at the BSD license, the Mozilla Public License and what is proprietary and confidential",
        "",
        None,
    ]
    exact = len(texts)
    whole = [(label, text) for label, _, text in licenses.TEXTS]
    texts += [prose(rng, 15) + "\n" + t + "\n" + prose(rng, 5) for _, t in whole]
    altered = len(texts)
    for _, t in whole:  # a few words changed, three put in
        w = t.split()
        for _ in range(len(w) // 25):
            w[rng.randrange(len(w))] = "altered" if rng.random() < 0.3 else "Zz"
        w[len(w) // 2 : len(w) // 2] = ["(c)", "2020", "somebody"]
        texts.append(" ".join(w))
    for _, t in whole:  # words in another order, and halves
        w = t.split()
        texts += [" ".join(w[: len(w) // 2]), " ".join(w[len(w) // 2 :]), " ".join(rng.sample(w, len(w)))]
    texts += [" ".join(rng.choice(licenses.VOCABULARY) for _ in range(60)) for _ in range(10)]
    got = {r["doc_id"]: r for r in licenses.scan(documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)])).collect()}
    for i, (labels, best) in enumerate(brute_labels(texts)):
        r = got[i]
        base = set(filter(None, r["base_labels"].split(",")))
        assert set(filter(None, r["labels"].split(","))) == labels | base, texts[i]
        assert r["score"] == pytest.approx(min(1.0, max(best, licenses.BASE_SCORE if base else 0.0))), texts[i]
    assert [got[i]["labels"] for i in range(exact)] == ["", "", "bsd", "cc", "", "", ""]
    for k, (label, _) in enumerate(whole):
        assert label in got[exact + k]["labels"].split(",") and got[exact + k]["score"] == pytest.approx(1.0)
    assert sum(whole[k][0] in got[altered + k]["labels"].split(",") for k in range(len(whole))) >= len(whole) - 2


def test_no_python_in_native_plans(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    for df in (mixing.shares_taken(docs), mixing.mix(docs), licenses.scan(docs), quality.judge(docs).where(F.col("kept"))):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|ArrowEval|CartesianProduct|BroadcastNestedLoop", plan)
