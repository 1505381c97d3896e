"""SentencePiece (merge-type) encoding with a prefix table, and decoding.

For every prefix of a text the *last token* of that prefix's encoding is unique. An
Aho-Corasick automaton lists the vocabulary pieces that end at each position; exactly one
of them is compatible with the last token of the prefix that it leaves over, i.e. encoding
the two pieces together gives the two pieces back. The table of last tokens is filled from
left to right and the ids are recovered backwards from the full text's entry, in linear time
and without a merge queue.

The rules of the library that are reproduced: identity normalisation, a dummy prefix
space, U+2581 for U+0020, pieces merged by score, byte fallback for characters without a
piece. Pieces never span a word border (only runs of the space mark hold an inner mark),
so the table is built per word and kept for repeated words.

Edge cases: null and empty text give no ids and decode to ''; extra columns are ignored;
repeated rows give one result row each; a null ``doc_id`` is carried through.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from flowmart.llm.common import Memo, arrow_rows, table

MARK = "▁"

#: Entries of the per-worker word memo; it is emptied when full, so memory is bounded.
MEMO_WORDS = 1_000_000
MEMO_TAILS = 200_000
MEMO_LETTERS = 64
MEMO_PAIRS = 1_000_000


class PrefixTable:
    """Encoder for one SentencePiece BPE model (given as the bytes of its file)."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        pieces = {sp.id_to_piece(i): i for i in normal}
        inner = [p for p in pieces if MARK in p[1:]]
        if any(p.strip(MARK) for p in inner):
            raise ValueError("a piece spans a word border; this model needs another segmentation")
        self.bytes = {b: sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        self.byte_fallback = sp.is_byte(self.bytes[0])
        self.ids = pieces
        # Runs of marks share one score: they merge after everything else, left to right.
        self.runs = {len(p) for p in pieces if not p.strip(MARK) and len(p) > 1}
        self.rank = {p: (-sp.get_score(i), i) for p, i in pieces.items() if p not in inner}
        if any(c not in self.rank for p in self.rank for c in p):
            raise ValueError("a piece holds a character that is no piece; byte fallback would hide its merges")
        self.automaton = ahocorasick.Automaton()
        for p in self.rank:
            self.automaton.add_word(p, (pieces[p], len(p)))
        self.automaton.make_automaton()
        #: (left id, right id) as one number -> rank of the piece that the two merge into.
        self.joins = {
            pieces[p[:k]] << 20 | pieces[p[k:]]: r for p, r in self.rank.items() for k in range(1, len(p)) if p[:k] in self.rank and p[k:] in self.rank
        }
        #: id -> (left id, right id) of its last merge; pieces that merging never builds have none.
        self.built: dict[int, tuple[int, int]] = {}
        for p in self.rank:
            if len(p) > 1 and (halves := self._last_merge(p)):
                self.built[pieces[p]] = (pieces[halves[0]], pieces[halves[1]])
        self.by_id = {i: r for p, i in pieces.items() if (r := self.rank.get(p))}
        if any(self.by_id[half] >= self.by_id[i] for i, halves in self.built.items() for half in halves if half in self.built):
            raise ValueError("a piece ranks before its parts; the pair test needs ranks that rise with merging")
        self.reached = {pieces[p] for p in self.rank if len(p) == 1} | self.built.keys()
        self.compatible: dict[int, bool] = {}
        self.right_edge: dict[int, list] = {}
        self.left_edge: dict[int, list] = {}
        #: Neighbouring characters that some piece holds; a word may be cut anywhere else.
        self.neighbours = {p[k : k + 2] for p in self.rank for k in range(len(p) - 1)}
        #: Ids as bytes: of one mark followed by the word (no further marks in it), and of a text
        #: without marks.
        self.words = Memo(lambda word: self._by_parts(word, MARK), MEMO_WORDS, MEMO_LETTERS)
        self.tails = Memo(lambda word: self._by_parts(word, ""), MEMO_TAILS, MEMO_LETTERS)

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two parts that merging joins last to build ``piece``; None if it ends otherwise."""
        parts = list(piece)
        while len(parts) > 2:
            best = min(((self.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.rank), default=None)
            if best is None:
                return None
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _edge(self, token: int, side: int) -> list[tuple[int, tuple]]:
        """The tokens at one edge of ``token`` while it is built, from its character up, each
        with the rank of the merge that ends it (infinite for the token itself)."""
        out, until = [], (float("inf"), 0)
        while True:
            out.append((token, until))
            halves = self.built.get(token)
            if halves is None:
                return out[::-1]
            until = self.by_id[token]
            token = halves[side]

    def _fits(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` side by side stay two tokens: no pair that meets at the
        border, at any moment of building both, merges before its parts merge inwards."""
        right = self.right_edge.get(a) or self.right_edge.setdefault(a, self._edge(a, 1))
        left = self.left_edge.get(b) or self.left_edge.setdefault(b, self._edge(b, 0))
        i = j = 0
        while True:
            x, x_ends = right[i]
            y, y_ends = left[j]
            joined = self.joins.get(x << 20 | y)
            if joined is not None and joined < x_ends and joined <= y_ends:
                return False
            if i + 1 == len(right) and j + 1 == len(left):
                return True
            if j + 1 == len(left) or (i + 1 < len(right) and x_ends <= y_ends):
                i += 1
            else:
                j += 1

    def tokens(self, word: str) -> list[int]:
        """The ids of one word (at most one leading mark)."""
        n = len(word)
        last = [0] * (n + 1)  # last[i]: id of the last token of word[:i]; -1 a character without a piece
        size_of = [0] * (n + 1)
        fits, reached = self.compatible, self.reached
        todo = 1  # the first prefix without an entry
        for end, (token, size) in self.automaton.iter(word):  # of equal ends the longest comes first
            end += 1
            while todo < end:
                if not size_of[todo]:
                    last[todo], size_of[todo] = -1, 1
                todo += 1
            if size_of[end]:
                continue
            before = last[end - size] if end > size else -1
            if before < 0:
                good = token in reached
            else:
                pair = before << 20 | token
                good = fits.get(pair)
                if good is None:
                    if len(fits) >= MEMO_PAIRS:
                        fits.clear()
                    good = fits[pair] = token in reached and self._fits(before, token)
            if good:
                last[end], size_of[end] = token, size
        while todo <= n:
            if not size_of[todo]:
                last[todo], size_of[todo] = -1, 1
            todo += 1
        out, i = [], n
        while i:
            if last[i] >= 0:
                out.append(last[i])
            elif self.byte_fallback:
                out += [self.bytes[b] for b in reversed(word[i - 1].encode())]
            else:
                out.append(self.sp.unk_id())
            i -= size_of[i]
        return out[::-1]

    def _by_parts(self, word: str, mark: str) -> bytes:
        """The ids of a word, cut in one pass wherever no piece can join the two sides (line ends
        are such places if no longer piece holds one); the parts are looked up. Parts have no
        cut, so their own look-up ends here at once: the depth does not grow with the word."""
        cuts = [k for k in range(1, len(word)) if word[k - 1 : k + 1] not in self.neighbours]
        if not cuts:
            return array("I", self.tokens(mark + word)).tobytes()
        head = (self.words if mark else self.tails)[word[: cuts[0]]]
        return b"".join([head, *(self.tails[word[i:k]] for i, k in zip(cuts, [*cuts[1:], len(word)]))])

    def _run(self, n: int) -> bytes:
        """Ids of ``n`` marks in a row: leftmost pairs merge first."""
        parts: list[int] = []
        for _ in range(n):
            parts.append(1)
            # the leftmost possible pair is always the newest one, and merging may cascade
            while len(parts) > 1 and parts[-2] + parts[-1] in self.runs:
                parts[-2:] = [parts[-2] + parts[-1]]
        return array("I", [self.ids[MARK * k] for k in parts]).tobytes()

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        text = text.replace(MARK, " ")
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return array("I", b"".join(map(self.words.__getitem__, text.split(" ")))).tolist()
        alone = array("I", [self.ids.get(MARK, 0)]).tobytes()
        marks, out = 0, []
        for w in text.split(" "):
            marks += 1
            if w:
                ids = self.words[w]
                if marks > 1 and ids.startswith(alone):  # the last mark stayed alone: it joins the run
                    out += [self._run(marks), ids[len(alone) :]]
                else:
                    out += [self._run(marks - 1), ids]
                marks = 0
        return array("I", b"".join([*out, self._run(marks)])).tolist()

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids)


_TABLES: dict[str, PrefixTable] = {}


def prefix_table(model: bytes) -> PrefixTable:
    """One table per worker process and model."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = PrefixTable(model)
    return _TABLES[key]


ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _mapper(spark: SparkSession, model_path: str, digest: bool):
    with open(model_path, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())  # a fixed vocabulary file, under 1 MB

    def rows(batches: Iterator[dict]) -> Iterator[tuple]:
        t = prefix_table(model.value)
        for b in batches:
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"]):
                ids = t.encode(text.as_py() or "")
                decoded = t.decode(ids) if ids else ""
                if digest:
                    joined = str(ids)[1:-1].replace(" ", "")
                    yield doc_id, len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
                else:
                    yield doc_id, ids, decoded

    return arrow_rows(rows, DIGEST if digest else ENCODED, 2000 if digest else 200)


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, decoded) per document; one narrow pass, no shuffle."""
    return docs.select("doc_id", "text").mapInArrow(_mapper(docs.sparkSession, model_path, False), "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """As ``encode_documents``, with the ids and the decoded text as SHA-256 digests."""
    return docs.select("doc_id", "text").mapInArrow(
        _mapper(docs.sparkSession, model_path, True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def model_path() -> str:
    """The production vocabulary: a file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), model_path())
