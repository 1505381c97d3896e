"""Operators 11 to 13 against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from flowmart.llm import conversation_repair as repair
from flowmart.llm import embedding_dedup as near
from flowmart.llm import filter_audit
from tests.llm.helpers import documents, empty, rows

# ---- embeddings ---------------------------------------------------------------------------


def vectors(seed: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    out = []
    for i in range(160):
        out.append((i, rng.normal(size=8).tolist()))
    for g in range(6):  # groups of copies and near copies, tight and at the threshold
        centre = rng.normal(size=8)
        for i in range(25):
            spread = (0, 1e-3, 0.05, 0.15, 0.2, 0.3)[g]
            out.append((200 + 40 * g + i, ((1 + i % 3) * (centre + spread * np.linalg.norm(centre) * rng.normal(size=8) / math.sqrt(8))).tolist()))
    out += [
        (900, None), (901, []), (902, [0.0] * 8), (903, [1.0, None, 0, 0]), (904, [1.0, math.nan, 0]), (905, [math.inf, 0]),
        (None, out[3][1]), (None, None), out[5], out[5],
        (906, [3.0, 1.0]), (907, [3.0, 1.0, 0.0, 0.0]), (908, [-0.0, 2.0, -0.0]), (909, [0.0, 2.0]), (908, [5.0, 0.0, 0.0, 9.0]),
        (910, [1e200, 1e200]), (911, [1e-200, 1e-200]), (912, [1e200, 1.1e200]),
        (913, [0.0, 0.0, 0.0, 0.0, 9.0, math.sqrt(19.0)]), (914, [0.0, 0.0, 0.0, 0.0, 1.0]), (915, [0, 0, 0, 0, 0.899999999, math.sqrt(1 - 0.899999999**2)]),
    ]
    return [(k, None if v is None else [None if x is None else float(x) for x in v]) for k, v in out]


def brute_links(data: list[tuple], cosine: float) -> dict:
    trim = lambda v: tuple(v[: max((i + 1 for i, x in enumerate(v) if x), default=0)])
    fine = lambda k, v: k is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    nodes = sorted({(k, tuple(x + 0.0 for x in trim(v))) for k, v in data if fine(k, v)})

    def cos(a, b):
        a, b = (tuple(x / max(map(abs, v)) for x in v) for v in (a, b))
        return math.fsum(x * y for x, y in zip(a, b)) / math.sqrt(math.fsum(x * x for x in a) * math.fsum(x * x for x in b))

    n, parent = Counter(), {k: k for k, _ in nodes}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for (i, a), (j, b) in itertools.combinations(nodes, 2):
        if cos(a, b) >= cosine:
            n[i, a] += 1
            n[j, b] += 1
            p, q = sorted((root(i), root(j)))
            parent[q] = p
    out = []
    for k, v in data:
        if fine(k, v):
            out.append((k, n[k, tuple(x + 0.0 for x in trim(v))], root(k), k == root(k)))
        else:
            out.append((k, 0, k, True))
    return sorted(map(str, out))


@pytest.mark.parametrize("cell,sample,seed", [(4096, 4096, 1), (16, 60, 2), (16, 4096, 3), (7, 5, 4)])
def test_embedding_links(spark, monkeypatch, cell, sample, seed):
    monkeypatch.setattr(near, "CELL", cell)
    monkeypatch.setattr(near, "SAMPLE", sample)
    data = vectors(seed)
    df = spark.createDataFrame([(k, v, "x", 1) for k, v in data], "vec_id long, embedding array<double>, cls string, n int").repartition(3)
    got = sorted(str((r.vec_id, r.n_links, r.component_id, r.kept)) for r in near.groups(df).collect())
    assert got == brute_links(data, near.COSINE)


def test_embedding_floats_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    assert near.groups(spark.createDataFrame([], schema)).collect() == []
    got = near.groups(spark.createDataFrame([(2, [1.0, 2.0]), (1, [1.0, 2.0]), (3, [-1.0, 2.0])], schema)).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_core_is_joined_without_comparisons(spark, monkeypatch):
    """A dense group is one core: no member of it is sent anywhere."""
    monkeypatch.setattr(near, "linked", None)  # a comparison would fail
    rng = np.random.default_rng(5)
    data = [(i, (np.eye(8)[0] + 0.001 * rng.normal(size=8)).tolist()) for i in range(500)]
    got = near.groups(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(499, 0)}


# ---- conversations ------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]")


def brute_edits(marked: list[tuple[str, int]]) -> tuple[int, str]:
    """All least-cost edit strings by exhaustive search over (row, state), the least of them; rows are
    (initial, fault)."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best: dict = {}

    def least(i: int, last: str, inserted: int):
        if (i, last, inserted) in best:
            return best[i, last, inserted]
        options = []
        if i == len(marked):
            if last in ("", "a"):
                options.append((0, ""))
        else:
            initial, fault = marked[i]
            c, rest = least(i + 1, last, 0)
            options.append((4 + c, "D" + rest))
            if fault not in (1, 2):
                more = 3 * (fault == 3)
                to = last if initial == "" else step.get((last, initial))
                if to is not None:
                    c, rest = least(i + 1, to, 0)
                    options.append((more + c, "K" + rest))
                for role in "ua":
                    if (last, role) in step:
                        c, rest = least(i + 1, role, 0)
                        options.append((3 + more + c, "R" + rest))
        if inserted < 3:
            for role in "ua":
                if (last, role) in step:
                    c, rest = least(i, role, inserted + 1)
                    options.append((3 + c, "I" + rest))
        best[i, last, inserted] = min(options, default=(10**9, ""))
        return best[i, last, inserted]

    return least(0, "", 0)


def brute_repair(data: list[tuple]) -> list[tuple]:
    convs: dict = {}
    for conv, turn, role, text in data:
        text_of = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{text_of(conv)}:{text_of(turn)}".encode()) % 20
        role, text = text_of(role), text_of(text)
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        at = convs.setdefault(conv, [])
        at += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, lines in convs.items():
        lines.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, marked = set(), []
        for _, role, text in lines:
            kept = WORD.findall(text)
            fault = 1 if not kept else 2 if (role, text) in seen else 3 if kept[-1] not in ".!?" else 0
            seen.add((role, text))
            marked.append((role[:1], fault))
        cost, audit = brute_edits(marked)
        turns, i, last = [], 0, ""
        for e in audit:
            due = "assistant" if last == "u" else "user"
            if e == "I":
                turns.append(f"{due}:")
                last = due[0]
                continue
            _, role, text = lines[i]
            i += 1
            if e == "K":
                turns.append(f"{role}:{text}")
                last = role[:1] or last
            elif e == "R":
                turns.append(f"{due}:{text}")
                last = due[0]
        assert re.fullmatch("(s?(ua)+)?", "".join(t[:1] for t in turns if not t.startswith(":")))
        known = [t for t, *_ in lines if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        faults = Counter(f for _, f in marked)
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(marked))
        out.append((conv, gaps, faults[1], faults[2], faults[3], illegal, cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest()))
    return sorted(map(str, out))


def talk(seed: int, convs: int = 80) -> list[tuple]:
    rng = random.Random(seed)
    says = ["Yes.", "no", "Why?", "  ", "", "Well \n", "Go! \t", "One. Two", None, "x" * 5000 + "."]
    out = []
    for c in [None, *range(convs)]:
        turn = rng.randint(-2, 3)
        for _ in range(rng.choice([0, 1, 2, 4, 6, 9, 14, 40])):
            role = rng.choice(["user", "assistant"] * 6 + ["system", "tool", "", None, "User"])
            out.append((c, rng.choice([turn] * 12 + [None]), role, rng.choice(says) if rng.random() < 0.6 else f"Line {rng.randint(0, 99)}."))
            turn += rng.choice([1, 1, 1, 0, 3])
    return out + out[:3]


@pytest.mark.parametrize("seed", [1, 2])
def test_repair(spark, seed):
    data = talk(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in data], "conv_id long, turn long, role string, text string, kind string, audit int").repartition(4)
    got = repair.repair(repair.damage(df)).collect()
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert sorted(str(tuple(r[n] for n in names)) for r in got) == brute_repair(data)


def test_repair_of_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert repair.repair(repair.damage(spark.createDataFrame([], schema))).collect() == []
    lost = next(t for t in range(100) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    got = repair.repair(repair.damage(spark.createDataFrame([(7, lost, "user", "Hi.")], schema))).collect()
    assert [tuple(r) for r in got] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_edits_equal_search():
    rng = random.Random(3)
    for n in [*range(9)] * 40 + [50, 200]:
        marked = [(rng.choice("uuuaaastt") if rng.random() < 0.95 else "", rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]
        codes = bytes(10 if f in (1, 2) else (3 if c == "" else "sua".find(c) if c in "sua" else 4) + 5 * (f == 3) for c, f in marked)
        assert repair.edits(codes) == brute_edits(marked)


def test_long_conversation_keeps_few_vectors(monkeypatch):
    """Checkpoints and one block are all that is held: at most 2 sqrt(n) + 3 vectors."""
    held, most = 0, 0

    class Vector(tuple):
        def __del__(self):
            nonlocal held
            held -= 1

    plain = repair.before

    def counted(code, after):
        nonlocal held, most
        held += 1
        most = max(most, held)
        return Vector(plain(code, after))

    monkeypatch.setattr(repair, "before", counted)
    codes = bytes(random.Random(1).choices(range(11), k=10_000))
    cost, audit = repair.edits(codes)
    assert most <= 2 * 100 + 8 and sum(audit.count(c) for c in "DKR") == 10_000


# ---- filters ------------------------------------------------------------------------------


def brute_audit(docs: list[tuple], labels: list[tuple]) -> list[str]:
    word = re.compile(r"[^\x20\x09-\x0D]+")
    text = lambda t: t or ""
    least = {}
    for d, t, *_ in docs:
        if d is not None:
            least[text(t)] = min(d, least.get(text(t), d))
    fails = []
    for d, t, _, source, _ in docs:
        t = text(t)
        w = word.findall(t)
        f = {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
            "D": any(c in t for c in "#$%&*|"), "E": d is not None and least[t] < d,
        }
        mine = [x for x in labels if x[0] == d and d is not None]
        fails.append((source or "", {k for k, v in f.items() if v}, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = []
    for part in {p for p, *_ in fails}:
        here = [x[1:] for x in fails if x[0] == part]
        lines, total = [], Counter()
        for order in itertools.permutations("ABCDE"):
            gone: set = set()
            for step, f in enumerate(order, 1):
                failing = [i for i, x in enumerate(here) if f in x[0]]
                now = [i for i in failing if i not in gone]
                gone |= set(now)
                total[f] += len(now)
                lines.append(("".join(order), step, len(here) - len(gone), len(now), len(failing) - len(now), sum(here[i][0] == {f} for i in failing), sum(here[i][1] for i in now), sum(here[i][2] for i in now), f))
        out += [(part, *x[:-1], total[x[-1]]) for x in lines]
    return sorted(map(str, out))


def test_filter_audit(spark):
    rng = random.Random(8)
    data = rows(n=80)
    data = [(d, t if t is None or rng.random() < 0.8 else (t.upper() if rng.random() < 0.5 else t + " #"), lang, rng.choice([s, "", None]), n) for d, t, lang, s, n in data]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d in range(0, 90, 2)] + [(4, 1, 1), (None, 1, 1)]
    marks = spark.createDataFrame([(*x, "e") for x in labels], "doc_id long, quality int, toxic int, text string")
    got = filter_audit.audit(documents(spark, data).selectExpr("*", "1 as good", "2 as part", "3 as mask"), marks).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_audit(data, labels)
    assert filter_audit.audit(empty(spark), marks).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_shapley_by_least_squares(n):
    rng = random.Random(n)
    counts = {m: rng.randint(0, 50) for m in range(1 << n)}
    v = filter_audit.coalitions(counts, n)
    fair = [Fraction(0)] * n
    for order in itertools.permutations(range(n)):
        s = 0
        for f in order:
            fair[f] += Fraction(v[s | 1 << f] - v[s], math.factorial(n))
            s |= 1 << f
    assert filter_audit.shapley(v, n) == fair
