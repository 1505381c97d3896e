from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCAB = [a + b for a in ("an", "be", "cor", "da", "él", "fi", "gra", "ho") for b in ("", "in", "ju", "ka", "lo", "mer")]


def prose(rng: random.Random, n: int) -> str:
    out = []
    for _ in range(n):
        w = rng.choice(VOCAB)
        out.append(w + rng.choice(["", "", "", ",", ".", ".\n"]))
    return " ".join(out)


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    """Invented documents with copies, near copies, shared passages and the edge cases."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(30, 160)) for _ in range(n)]
    shared = prose(rng, 40)
    out = []
    for i, t in enumerate(base):
        if i % 7 == 3:
            t = base[i - 1]
        elif i % 7 == 5:
            w = base[i - 1].split(" ")
            w[rng.randrange(len(w))] = "changed"
            t = " ".join(w)
        elif i % 7 == 6:
            t = t + "\n" + shared
        out.append((i, t, rng.choice(["en", "fr"]), f"s{i % 3 if i % 2 else 0}"))
    out += [
        (n, None, "en", "s0"),
        (n + 1, "", None, None),
        (n + 2, " \t\n ", "en", "s1"),
        (n + 3, "One", "en", "s1"),
        (n + 4, "a b c", "en", None),
        (n + 5, "a b c", "fr", "s2"),
        (n + 6, "x" * 3000 + " " + "y " * 2000, "en", "s0"),
        (n + 6, "x" * 3000 + " " + "y " * 2000, "en", "s0"),
        (None, base[0], "en", "s0"),
        (None, "lonely words without an id here", None, "s2"),
    ]
    return [(a, b, c, d, None if b is None else len(b)) for a, b, c, d in out]


def documents(spark: SparkSession, data: list[tuple] | None = None, extra: bool = True) -> DataFrame:
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    if extra:  # names that the operators use themselves
        for name in ("size", "words", "row", "key", "v", "print", "g", "block", "hits", "target", "component"):
            df = df.selectExpr("*", f"'x' as {name}")
    return df.repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
