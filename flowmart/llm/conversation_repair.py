"""Conversation structure repair: the cheapest edits that give a conversation the roles
``(s?(ua)+)?``, an optional system turn and then pairs of user and assistant turns.

A row is kept (0), gets the role that is due (3), is deleted (4; the only choice for a blank row or
a repeated one), and an empty turn with the role that is due can be inserted anywhere (3); a
truncated row that stays adds 3. The roles taken so far are one of four states (nothing yet, after
the system turn, after a user turn, after an assistant turn), so the costs of finishing
from a row on are a vector of four. Of the cheapest edit strings the ASCII-least is taken.

Square-root checkpointing: walking backward, the vectors are stored only at every sqrt(n)-th row;
walking forward, the vectors of one block at a time are computed again from the checkpoint behind
it, and the least letter that is still optimal is emitted. Memory is 2 sqrt(n) vectors beside one
byte per row, which the result's own edit string has anyway.

Texts are never gathered. A first pass brings each conversation's rows, without their texts, together in
order and yields the edits; in a second one the texts stream past in the same order beside
the edits, into a running SHA-256. Rows that repeat another (conversation, turn, role and
text) are combined before they are shuffled, and first occurrences are found by partial minima
and a join on a unique key, so neither a hot conversation nor a hot text is sorted by one task
beyond the stream itself.

Edge cases: nulls in role and text are one space; a null conv_id is a conversation of its own; null turns
come first; rows of one turn are ordered by role and the SHA-256 of the text, and equal ones are repeats; an empty
role has no initial and changes no state if kept; a role with another initial cannot be kept;
a conversation that loses all its rows has zeros and an empty edit string; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.llm.common import arrow_rows, shuffle_partitions, stage, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: The state after a role, by state (0 nothing, 1 after s, 2 after u, 3 after a); -1: not allowed.
AFTER = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1), "": (0, 1, 2, 3)}
#: The role that is due in a state, and the state after it.
DUE = ("user", "user", "assistant", "user")
NEXT = (2, 2, 3, 2)
#: What it costs to end in a state: only nothing and whole pairs are legal.
END = (0, 2 * INSERT, INSERT, 0)
#: Codes of rows: 0-4 by initial (s, u, a, none, other), 5 more if truncated; 10: must go.
INITIALS = "sua"
GONE = 10
_KEPT = [*(AFTER[c] for c in ("s", "u", "a", "")), (-1, -1, -1, -1)]


def before(code: int, after: tuple) -> tuple:
    """The cost vector in front of a row, from the one behind it."""
    if code == GONE:
        v = [DELETE + x for x in after]
    else:
        stay, kept = TRUNCATED * (code >= 5), _KEPT[code % 5]
        v = []
        for state in range(4):
            best = min(DELETE + after[state], REROLE + stay + after[NEXT[state]])
            v.append(min(best, KEEP + stay + after[kept[state]]) if kept[state] >= 0 else best)
    for _ in range(3):  # insertions, which lead from every state to 2 and 3 and back
        v = [min(x, INSERT + v[n]) for x, n in zip(v, NEXT)]
    return tuple(v)


def edits(codes: bytes) -> tuple[int, str]:
    """The least cost and the ASCII-least of the cheapest edit strings."""
    n = len(codes)
    step = isqrt(n) + 1
    checkpoints = {}
    v = END
    for i in range(n, 0, -1):
        if i % step == 0 or i == n:
            checkpoints[i] = v
        v = before(codes[i - 1], v)
    cost, out, state = v[0], [], 0
    for start in range(0, n, step):
        stop = min(start + step, n)
        block = [checkpoints[stop]]  # the vectors behind each row of the block, last row first
        for i in range(stop, start, -1):
            block.append(before(codes[i - 1], block[-1]))
        for i in range(start, stop):
            here, after, code = block.pop(), block[-1], codes[i]
            stay, kept = TRUNCATED * (code >= 5), -1 if code == GONE else _KEPT[code % 5][state]
            while True:
                if here[state] == DELETE + after[state]:
                    out.append("D")
                elif here[state] == INSERT + here[NEXT[state]]:
                    out.append("I")
                    state = NEXT[state]
                    kept = -1 if code == GONE else _KEPT[code % 5][state]
                    continue
                elif kept >= 0 and here[state] == KEEP + stay + after[kept]:
                    out.append("K")
                    state = kept
                else:
                    out.append("R")
                    state = NEXT[state]
                break
    while END[state]:
        out.append("I")
        state = NEXT[state]
    return cost, "".join(out)


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the contract's damage by crc32 of ``conv_id:turn`` modulo
    20. Dropped rows stay as rows with 0 copies, so that every conversation keeps one."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(or_space("text"), "[.!?]", "")).otherwise(or_space("text"))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(or_space("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


_AUDIT = pa.schema(
    [("conv", pa.string()), ("conv_id", pa.int64()), *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string())]
)
AUDIT_DDL = "conv string, conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
BLANK, REPEAT, CUT = 1, 2, 3


class _Conversation:
    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.codes = bytearray()
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.role = self.low = self.high = None

    def add(self, turn: int | None, initial: str, fault: int, copies: int) -> None:
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.illegal += (self.role is not None and self.role + initial not in ("su", "ua", "au")) + (copies - 1) * (initial + initial not in ("su", "ua", "au"))
        self.role = initial
        kind = 3 if initial == "" else INITIALS.find(initial) if initial in INITIALS else 4
        self.codes.append(GONE if fault in (BLANK, REPEAT) else kind + 5 * (fault == CUT))
        self.codes += bytes([GONE]) * (copies - 1)
        self.faults[fault] += 1
        self.faults[BLANK if fault == BLANK else REPEAT] += copies - 1

    def row(self, conv: str) -> tuple:
        cost, audit = edits(bytes(self.codes))
        gaps = self.high - self.low + 1 - self.turns if self.high is not None else 0
        return conv, self.conv_id, gaps, *self.faults[1:], self.illegal, cost, audit


def _audits(batches: Iterator[dict]) -> Iterator[tuple]:
    """Rows in the order of (conv, turn, role, hash of the text): one audit per conversation."""
    conv, c = None, None
    for b in batches:
        for key, conv_id, turn, initial, fault, copies in zip(*(b[n].to_pylist() for n in ("conv", "conv_id", "turn", "initial", "fault", "copies"))):
            if key != conv:
                if c:
                    yield c.row(conv)
                conv, c = key, _Conversation(conv_id)
            if copies:
                c.add(turn, initial, fault, copies)
    if c:
        yield c.row(conv)


def _repaired(audit: str, rows: Iterator[tuple[str, str, int]]) -> Iterator[str]:
    """The turns after the edits; rows: (role, text, copies) in order, read as they are needed."""
    state, left, row = 0, 0, ("", "")
    for letter in audit:
        if letter == "I":
            yield f"{DUE[state]}:"
            state = NEXT[state]
            continue
        if not left:
            role, text, left = next(rows)
            row = role, text
        left -= 1
        if letter == "K":
            yield f"{row[0]}:{row[1]}"
            state = AFTER[row[0][:1]][state]
        elif letter == "R":
            yield f"{DUE[state]}:{row[1]}"
            state = NEXT[state]


def _digests(batches: Iterator[dict]) -> Iterator[tuple]:
    """Each conversation's edits, then its rows in order: (conv, sha256 of the repaired turns)."""
    stream = (row for b in batches for row in zip(*(b[n].to_pylist() for n in ("conv", "audit", "role", "text", "copies"))))
    waiting: list[tuple] = []

    def rows_of(conv: str) -> Iterator[tuple[str, str, int]]:
        for row in stream:
            if row[0] != conv:
                waiting.append(row)
                return
            yield row[2], row[3], row[4]

    while True:
        head = waiting.pop() if waiting else next(stream, None)
        if head is None:
            return
        rows, digest, between = rows_of(head[0]), hashlib.sha256(), b""
        for turn in _repaired(head[1], rows):
            digest.update(between + turn.encode())
            between = b"\n"
        for _ in rows:  # none: every row has its letter
            pass
        yield head[0], digest.hexdigest()


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every
    conversation of (conv_id, turn, role, text, copies)."""
    spark = conversations.sparkSession
    n = shuffle_partitions(spark)
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")
    rows = conversations.groupBy(conv, "conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = stage(rows.withColumn("print", F.sha2("text", 256)), "turns")
    there = rows.where("copies > 0")
    # The first occurrence of a role and text in a conversation; a turn has each of them once.
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = there.groupBy("conv", "role", "print").agg(F.min(turn).alias("t"))
    first = first.select("conv", "role", "print", F.coalesce("t.turn", F.lit(0)).alias("at"), F.col("t.known").alias("known"), F.lit(True).alias("first"))
    slim = rows.select(
        "conv", "conv_id", "turn", "role", "print", "copies", F.coalesce("turn", F.lit(0)).alias("at"), F.col("turn").isNotNull().alias("known"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("open"),
    )
    fault = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), REPEAT).when(F.col("open"), CUT).otherwise(0)
    marked = slim.join(first, ["conv", "role", "print", "at", "known"], "left").select(
        "conv", "conv_id", "turn", "role", "print", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), "copies"
    )
    ordered = marked.repartition(n, "conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "print")
    audits = stage(ordered.mapInArrow(arrow_rows(_audits, _AUDIT, 1_000), AUDIT_DDL), "audits")
    # The edits stand before the rows of their conversation (kind 0).
    none = lambda t: F.lit(None).cast(t)
    heads = audits.select("conv", F.lit(0).alias("kind"), "audit", none("long").alias("turn"), none("string").alias("role"), none("string").alias("print"), none("string").alias("text"), none("long").alias("copies"))
    texts = there.select("conv", F.lit(1).alias("kind"), none("string").alias("audit"), "turn", "role", "print", "text", "copies")
    beside = heads.unionByName(texts).repartition(n, "conv").sortWithinPartitions("conv", "kind", F.asc_nulls_first("turn"), "role", "print")
    digest = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])
    digests = beside.mapInArrow(arrow_rows(_digests, digest, 5_000), "conv string, repaired_sha256 string")
    return audits.join(digests, "conv").drop("conv")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(table(spark, sf_dir, "conversations")))
