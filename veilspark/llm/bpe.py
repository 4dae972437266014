"""Byte-level BPE encoding and decoding with DuckDB recursive queries per task.

A task splits its texts by the tokenizer's pattern and hands the distinct
words to an in-memory DuckDB as token-position rows, one row per byte.  A
recursive query joins neighbouring tokens with the merge table and contracts
the leftmost pair of least rank of every word, until no pair of a word is in
the table.  Joins and ordered aggregation then spell every word from its tokens
and every document from its words; ids are gathered by word number.

The vocabulary is given (a rank file); nothing is trained here.
"""

from __future__ import annotations

import base64
import heapq
import sys
import tempfile
from itertools import chain
from types import ModuleType

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.llm.common import map_arrow, text_or_empty

TASK_WORDS = 800_000   # distinct words that a task keeps encodings of
STEP_WORDS = 50_000    # words per recursive query
LONG_WORD = 256        # bytes; longer words are contracted with a heap, as a row per step would be quadratic
DUCKDB_MEMORY = "300MB"

ENCODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
                        T.StructField("decoded", T.BinaryType())])


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Rank file: a token in base64 and its rank on each line."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x)}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """Every pair of tokens whose bytes together are a token, and that token."""
    left, right, new = [], [], []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                new.append(rank)
    return pa.table({"l": pa.array(left, pa.int64()), "r": pa.array(right, pa.int64()), "m": pa.array(new, pa.int64())})


# A row is a token at its place: the word's number and the place in it are one
# key, ``k``, place in the low 16 bits.  One step: of every word's neighbouring
# pairs that are in the merge table, the one of least rank, the leftmost of
# equals; its left row becomes the new token and its right row goes.  The rank and
# both places are packed into one number so that one minimum finds all
# three.  A word without such a pair is done.
CONTRACT = """
WITH RECURSIVE step(k, tok, done) AS (
  SELECT (w::BIGINT << 16) + pos, tok, false FROM letters
  UNION ALL
  SELECT s.k, CASE WHEN (s.k & 65535) = ((best >> 16) & 65535) THEN (best >> 32)::INTEGER ELSE s.tok END, best IS NULL
  FROM step s LEFT JOIN (
    SELECT (p.k >> 16) AS w, min((g.m << 32) + ((p.k & 65535) << 16) + (p.next & 65535)) AS best
    FROM (SELECT k, (tok::BIGINT << 16) + lead(tok) OVER o AS pair, lead(k) OVER o AS next
          FROM step WHERE NOT done WINDOW o AS (ORDER BY k)) p
    JOIN merges g USING (pair) WHERE (p.k >> 16) = (p.next >> 16) GROUP BY (p.k >> 16)) b ON (s.k >> 16) = b.w
  WHERE NOT s.done AND (best IS NULL OR (s.k & 65535) <> (best & 65535))
)
SELECT (k >> 16)::INTEGER AS w, (k & 65535)::INTEGER AS pos, tok FROM step WHERE done
"""

# Bytes of every word from its tokens, and of every text from its words.
SPELL = """INSERT INTO words SELECT w, decode(unhex(string_agg(hex, '' ORDER BY pos))) FROM contracted JOIN tokens USING (tok) GROUP BY w"""

ENCODE = "SELECT o.doc, string_agg(w.decoded, '' ORDER BY o.place) AS decoded FROM occurrences o JOIN words w ON o.w = w.w GROUP BY o.doc ORDER BY o.doc"

DECODE = "SELECT doc, unhex(string_agg(hex, '' ORDER BY place)) AS decoded FROM ids JOIN tokens USING (tok) GROUP BY doc ORDER BY doc"


def contract_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same contraction for one long word: a heap of (rank, position) and linked neighbours."""
    n = len(word)
    end = list(range(1, n + 1))      # where the part that starts here ends; 0: no part starts here
    prev = list(range(-1, n - 1))

    def push(i):
        j = end[i]
        if j < n and (rank := ranks.get(word[i:end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    heap: list = []
    for i in range(n):
        push(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue  # one of the two parts has changed since
        end[i], end[j] = stop, 0
        if stop < n:
            prev[stop] = i
        push(i)
        if prev[i] >= 0:
            push(prev[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start[i], start[i] + 1, ..`` (``size[i]`` numbers) for every i, one after the other."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()), dtype=np.int64)


class _Pieces(dict):
    """Word numbers of the pieces after a space, found when first asked for."""

    def __init__(self, encoder):
        self.encoder = encoder

    def __missing__(self, piece: str) -> tuple:
        at = self[piece] = self.encoder._words_of(" " + piece)
        return at


class TaskEncoder:
    """Encodes texts; keeps the distinct words seen so far, up to a bound."""

    def __init__(self, rank_lines: bytes, pattern: str, task_words: int = TASK_WORDS, cut: bool = False):
        """``cut``: with this pattern a word ends before every space that follows no white space."""
        import duckdb
        import regex

        self.ranks = read_ranks(rank_lines)
        if max(self.ranks.values(), default=0) >= 1 << 16:
            raise ValueError("the merge table's key holds tokens below 65,536 only")
        self.split = regex.compile(pattern).findall
        self.spaced = regex.compile(r"\s ").search
        self.task_words, self.cut = task_words, cut
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "temp_directory": tempfile.gettempdir()})
        pairs = merge_table(self.ranks)
        tokens = pa.table({"tok": pa.array(list(self.ranks.values()), pa.int32()), "hex": [t.hex() for t in self.ranks]})
        self.db.register("pairs", pairs)
        self.db.register("vocabulary", tokens)
        self.db.execute("CREATE TABLE merges AS SELECT l * 65536 + r AS pair, m FROM pairs")
        self.db.execute("CREATE TABLE tokens AS SELECT tok, hex FROM vocabulary")
        self.letter = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.forget()

    def forget(self):
        """Start anew with the words that were met more than once, the more frequent half of the bound at most."""
        old, used = list(getattr(self, "known", ())), getattr(self, "used", np.empty(0, np.int64))
        used = used[:len(old)]
        keep = np.flatnonzero(used > 1)
        if len(keep) > self.task_words // 2:
            keep = np.sort(keep[np.argpartition(-used[keep], self.task_words // 2)[:self.task_words // 2]])
        self.pieces = _Pieces(self)
        if len(keep):
            self.db.register("keep", pa.table({"old": keep.astype(np.int32), "w": np.arange(len(keep), dtype=np.int32)}))
            self.db.execute("CREATE OR REPLACE TABLE words AS SELECT k.w, decoded FROM words o JOIN keep k ON o.w = k.old")
            self.known = {old[i]: n for n, i in enumerate(keep)}
            at = _ranges(self.start[keep], self.size[keep])
            self.ids, self.size = self.ids[at], self.size[keep]
        else:
            self.db.execute("CREATE OR REPLACE TABLE words (w INTEGER, decoded VARCHAR)")
            self.known: dict[str, int] = {}
            self.ids, self.size = np.empty(0, np.int32), np.empty(0, np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.used = np.zeros(len(keep), np.int64)  # counted anew: what is not met again can go the next time

    def _learn(self, words: list[str], first: int) -> None:
        """Encode new words, numbered from ``first``: their ids follow those of the known words, their bytes go to the table of words."""
        for s in range(0, len(words), STEP_WORDS):
            w, pos, tok, letters = [], [], [], []
            step = words[s:s + STEP_WORDS]
            for i, word in enumerate(step, first + s):
                b = word.encode("utf-8", "surrogatepass")
                if (rank := self.ranks.get(b)) is not None:
                    ids = [rank]
                elif len(b) > LONG_WORD:
                    ids = contract_long(b, self.ranks)
                else:
                    letters.append((i, b))
                    continue
                w += [i] * len(ids)
                pos += range(len(ids))
                tok += ids
            size = np.array([len(b) for _, b in letters], np.int64)
            flat = np.frombuffer(b"".join(b for _, b in letters), np.uint8)
            self.db.register("letters", pa.table({
                "w": np.repeat(np.array([i for i, _ in letters], np.int32), size),
                "pos": np.arange(len(flat), dtype=np.int32) - np.repeat(np.cumsum(size, dtype=np.int32) - size.astype(np.int32), size),
                "tok": self.letter[flat]}))
            self.db.register("whole", pa.table({"w": pa.array(w, pa.int32()), "pos": pa.array(pos, pa.int32()), "tok": pa.array(tok, pa.int32())}))
            self.db.execute(f"CREATE OR REPLACE TABLE contracted AS SELECT * FROM ({CONTRACT}) UNION ALL SELECT * FROM whole")
            self.db.execute(SPELL)
            found = self.db.sql("SELECT w, pos, tok FROM contracted").fetchnumpy()
            order = np.argsort((found["w"].astype(np.int64) << 32) + found["pos"])
            self.ids = np.concatenate([self.ids, found["tok"][order].astype(np.int32)])
            self.size = np.concatenate([self.size, np.bincount(found["w"] - (first + s), minlength=len(step))])
        self.start = np.cumsum(self.size) - self.size

    def _numbers(self, text: str) -> np.ndarray:
        """Numbers of the text's words.  Where words end before a space that follows
        no white space, texts without such a pair are cut there first and
        every distinct piece is matched against the pattern once."""
        if not self.cut or " " not in text or self.spaced(text):
            return np.array(self._words_of(text), np.int32)
        first, *rest = text.split(" ")
        return np.fromiter(chain(self._words_of(first), chain.from_iterable(map(self.pieces.__getitem__, rest))), np.int32)

    def _words_of(self, text: str) -> tuple:
        known = self.known
        return tuple([known.setdefault(w, len(known)) for w in self.split(text)])

    def encode(self, texts: list[str]) -> pa.Table:
        """``(doc, ids, decoded)`` for every text, by its place in ``texts``."""
        if len(self.known) > self.task_words:
            self.forget()
        if len(self.pieces) > 3 * self.task_words // 4:
            self.pieces.clear()
        known, first = self.known, len(self.known)
        numbers = [self._numbers(t) for t in texts]
        size = np.array([len(x) for x in numbers], np.int64)
        new = list(known)[first:] if len(known) > first else []
        self._learn(new, first)
        w = np.concatenate(numbers) if numbers else np.empty(0, np.int32)
        self.used = np.concatenate([self.used, np.zeros(len(new), np.int64)]) + np.bincount(w, minlength=len(known))
        self.db.register("occurrences", pa.table({
            "doc": np.repeat(np.arange(len(texts), dtype=np.int32), size), "place": np.arange(len(w), dtype=np.int32), "w": w}))
        r = self.db.sql(ENCODE).to_arrow_table()
        tokens = np.concatenate([[0], np.cumsum(self.size[w])])
        ends = tokens[np.concatenate([[0], np.cumsum(size)])]
        ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(self.ids[_ranges(self.start[w], self.size[w])]))
        decoded = _scatter(len(texts), r.column("doc"), r.column("decoded").cast(pa.binary()), b"")
        return pa.table({"doc": np.arange(len(texts), dtype=np.int32), "ids": ids, "decoded": decoded})

    def decode(self, ids: list[list[int]]) -> pa.Table:
        """``(doc, decoded)`` for the lists that have any id, by their place in ``ids``."""
        size = [len(x) for x in ids]
        flat = np.concatenate([np.asarray(x, np.int64) for x in ids]) if ids else np.empty(0, np.int64)
        self.db.register("ids", pa.table({"doc": np.repeat(np.arange(len(ids), dtype=np.int32), size),
                                          "place": np.arange(len(flat), dtype=np.int64), "tok": flat}))
        return self.db.sql(DECODE).to_arrow_table()


def worker_encoder(rank_lines: bytes, pattern: str, task_words: int, cut: bool) -> TaskEncoder:
    """The worker process's encoder: a worker runs one task after the other, and
    the words of earlier tasks stay known, up to the same bound."""
    held = sys.modules.setdefault("_veilspark_bpe", ModuleType("_veilspark_bpe")).__dict__
    key = hash((rank_lines, pattern, task_words, cut))
    if held.get("key") != key:
        held["encoder"], held["key"] = TaskEncoder(rank_lines, pattern, task_words, cut), key
    return held["encoder"]


def _scatter(n: int, places: pa.ChunkedArray, values: pa.ChunkedArray, empty) -> pa.Array:
    """``values`` at their ``places`` in a column of ``n`` rows, ``empty`` elsewhere."""
    back = np.full(n, len(values), np.int64)
    back[places.to_numpy()] = np.arange(len(places))
    return pa.chunked_array([*values.chunks, pa.array([empty], values.type)]).take(pa.array(back)).combine_chunks()


def bpe_encode(docs: DataFrame, rank_path: str, pattern: str, task_words: int = TASK_WORDS, keep_words: bool = True) -> DataFrame:
    """``doc_id, ids, decoded`` for every row of ``docs``: the ids of the whole
    text without special tokens, and the bytes that they decode to.

    A null or empty text has no ids and decodes to no bytes.  Repeated rows
    and null ids give a row each; extra columns are ignored.  The rank file
    (under 2 MB) travels to the tasks with the function.  A task keeps the
    encodings of at most ``task_words`` words; with ``keep_words`` its Python
    worker keeps them for the next task, which saves time and holds memory.
    """
    with open(rank_path, "rb") as f:
        lines = f.read()
    cut = pattern == public_tokenizers.PATTERN

    def run(batches):
        encoder = (worker_encoder if keep_words else TaskEncoder)(lines, pattern, task_words, cut)
        for b in batches:
            texts = b.column("body").to_pylist()
            if not texts:
                continue
            found = encoder.encode(texts).combine_chunks()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), found.column("ids").chunk(0), found.column("decoded").chunk(0)], ["doc_id", "ids", "decoded"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("body")), run, ENCODED)


def bpe_decode(rows: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``doc_id, decoded`` for rows of ``doc_id, ids``; null or empty ids decode to no bytes."""
    with open(rank_path, "rb") as f:
        lines = f.read()

    def run(batches):
        decoder = TaskEncoder(lines, pattern)
        for b in batches:
            ids = [x or [] for x in b.column("ids").to_pylist()]
            r = decoder.decode(ids)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), _scatter(len(ids), r.column("doc"), r.column("decoded").cast(pa.binary()), b"")], ["doc_id", "decoded"])

    return map_arrow(rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids"), run, "doc_id long, decoded binary")


def token_digests(encoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of :func:`bpe_encode`'s rows."""
    text = F.array_join("ids", " ")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(text.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
