"""Subword lattice likelihood.

An existing subword vocabulary gives the pieces; its scores (ranks) give the
starting weights, and one expectation step over the counts of all training
words gives the probability of each piece.  A word's probability is the sum
over all its segmentations into pieces, by forward recursion (in log space where
plain numbers could lose digits); a text's is the product over its words and an end piece.

The corpus is counted once per distinct word.  Texts are scored in chunks of
bounded size: the distinct words of a chunk meet the table of words by a
shuffled join, and come back to the chunk's texts.  No table of words is broadcast.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.llm.common import id_bucket, kept, map_arrow, text_or_empty

CHUNK_BYTES = 16 << 20  # of text scored together
TASK_WORDS = 300_000    # distinct words that a task counts before it hands them on
START = "▁"        # fixed value: the mark of a word's start in the vocabulary
LOG10 = math.log(10)
PLAIN_CHARS, CHAR_SCALE = 80, 3.0  # words up to this length are tried without logarithms, at this scale per character
PLAIN_LEAST = 1e-280  # a smaller sum at any place of a word is worked out by logarithms


def read_vocabulary(path: str) -> list[str]:
    """Pieces of a sentencepiece model, best score first, single bytes last."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    ids.sort(key=lambda i: (sp.is_byte(i), -sp.get_score(i), i))
    return [sp.id_to_piece(i) for i in ids]


class Lattice:
    """Pieces with log probabilities, as a trie over characters."""

    def __init__(self, pieces: list[str], logp: np.ndarray):
        self.root: dict = {}  # by character: the piece that ends here, if any, and what may follow
        self.byte: dict[int, int] = {}
        self.spelled: dict[str, tuple] = {}
        self.logp = [float(x) for x in logp]
        for i, piece in enumerate(pieces):
            if len(piece) == 6 and piece.startswith("<0x"):
                self.byte[int(piece[3:5], 16)] = i
                continue
            node: list = [None, self.root]
            for c in piece:
                node = node[1].setdefault(c, [None, {}])
            node[0] = self._entry((i,), len(piece))

    def _entry(self, ids: tuple, chars: int) -> tuple:
        """Pieces, log probability, and probability scaled by their characters."""
        lp = sum(self.logp[x] for x in ids)
        return ids, lp, math.exp(lp + CHAR_SCALE * chars)

    def _bytes(self, c: str) -> tuple:
        """The entry of a character spelled by its bytes."""
        e = self.spelled.get(c)
        if e is None:
            e = self.spelled[c] = self._entry(tuple(self.byte[b] for b in c.encode("utf-8", "surrogatepass")), 1)
        return e

    def edges(self, word: str) -> list[tuple]:
        """``(start, end, entry)`` of every piece at every place of the marked word,
        by start.  A character that is no piece is spelled by its bytes."""
        text = START + word
        n, out, root = len(text), [], self.root
        for i, first in enumerate(text):
            node = root.get(first)
            if node is None or node[0] is None:
                out.append((i, i + 1, self._bytes(first)))
            j = i + 1
            while node is not None:
                e, kids = node
                if e is not None:
                    out.append((i, j, e))
                if j == n:
                    break
                node = kids.get(text[j])
                j += 1
        return out

    def forward(self, word: str) -> float:
        """Natural log of the word's probability, over all segmentations; without
        logarithms where no sum comes near the smallest numbers that keep all their digits."""
        n = len(word) + 1
        if n > PLAIN_CHARS:
            return self._forward_long(word)
        text = START + word
        root = self.root
        f = [0.0] * (n + 1)
        f[0] = 1.0
        for i, first in enumerate(text):
            a = f[i]
            if a < PLAIN_LEAST:
                return self._forward_long(word)
            node = root.get(first)
            if node is None or node[0] is None:
                f[i + 1] += a * self._bytes(first)[2]
            j = i + 1
            while node is not None:
                e, kids = node
                if e is not None:
                    f[j] += a * e[2]
                if j == n:
                    break
                node = kids.get(text[j])
                j += 1
        return math.log(f[n]) - CHAR_SCALE * n if f[n] >= PLAIN_LEAST else self._forward_long(word)

    def _forward_long(self, word: str) -> float:
        return _forward(self.edges(word), len(word) + 1)[-1]

    def expect(self, word: str, weight: float, counts: list[float]) -> None:
        """Add the expected number of each piece in ``weight`` copies of the
        word, by forward and backward sums; without logarithms as in :meth:`forward`."""
        n = len(word) + 1
        if n > PLAIN_CHARS:
            return self._expect_long(word, weight, counts)
        edges = self.edges(word)
        f = [0.0] * (n + 1)
        f[0] = 1.0
        for i, j, e in edges:
            f[j] += f[i] * e[2]
        # every place is reached; a backward sum is at most the weight over the forward sum
        if min(f) < PLAIN_LEAST:
            return self._expect_long(word, weight, counts)
        b = [0.0] * (n + 1)
        b[n] = weight / f[n]
        for i, j, (ids, _, p) in reversed(edges):
            share = p * b[j]
            b[i] += share
            share *= f[i]
            for x in ids:
                counts[x] += share

    def _expect_long(self, word: str, weight: float, counts: list[float]) -> None:
        edges, n = self.edges(word), len(word) + 1
        f = _forward(edges, n)
        after: list[list[float]] = [[] for _ in range(n)] + [[0.0]]
        b = [0.0] * (n + 1)
        at = n
        for i, j, e in reversed(edges):
            while at > i:  # all pieces that start at or after ``at`` have been seen
                b[at] = _log_sum(after[at])
                at -= 1
            after[i].append(e[1] + b[j])
            share = weight * math.exp(min(0.0, f[i] + e[1] + b[j] - f[n]))
            for x in e[0]:
                counts[x] += share


def _log_sum(terms: list[float]) -> float:
    if len(terms) == 1:
        return terms[0]
    m = max(terms, default=-math.inf)
    return m if m == -math.inf else m + math.log(sum([math.exp(t - m) for t in terms]))


def _forward(edges: list[tuple], n: int) -> list[float]:
    """Log of the summed probability of all ways to each place; edges come by start."""
    into: list[list[float]] = [[] for _ in range(n + 1)]
    into[0].append(0.0)
    f = [0.0] * (n + 1)
    at = -1
    for i, j, e in edges:
        if i != at:
            a = f[i] = _log_sum(into[i])
            at = i
        into[j].append(a + e[1])
    f[n] = _log_sum(into[n])
    return f


def _hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of the bytes of an array of words."""
    if not len(words):
        return np.zeros(0, np.int64)
    words = words.cast(pa.binary())
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int32, len(words) + 1, 4 * words.offset).tolist()
    data, digest = memoryview(data or b""), xxhash.xxh3_64_intdigest
    return (np.array([digest(data[i:j]) for i, j in pairwise(ends)], np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts, and where each text's words begin
    among them, the end last.  Of bytes: exactly the ASCII letters and white space."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.string())))
    words, begin = lists.flatten(), np.append(0, np.cumsum(pc.list_value_length(lists)))
    real = np.asarray(pc.not_equal(pc.binary_length(words), 0))  # white space at an end leaves an empty word
    if real.all():
        return words, begin
    return words.filter(pa.array(real)), np.append(0, np.cumsum(real))[begin]


_COUNTS = "word binary, n long"


def _count_words(batches):
    """Distinct words of a task with their number in training texts."""
    def rows():
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    counts: Counter = Counter()
    for b in batches:
        for t, train in zip(b.column("body"), b.column("train").to_pylist()):
            words = t.as_py().lower().split()  # of bytes: exactly the ASCII letters and white space
            if train:
                counts.update(words)
            else:
                for w in words:
                    counts[w] += 0
        if len(counts) > TASK_WORDS:
            yield from rows()
            counts = Counter()
    if counts:
        yield from rows()


def _expect(pieces: list[str], logp: np.ndarray):
    def run(batches):
        lattice, counts = Lattice(pieces, logp), [0.0] * len(pieces)
        for b in batches:
            for w, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist()):
                if n:
                    lattice.expect(w.decode("utf-8", "replace"), n, counts)
        some = [i for i, c in enumerate(counts) if c]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([counts[i] for i in some], pa.float64())], ["piece", "expected"])
    return run


def _score_words(pieces: list[str], logp: np.ndarray):
    def run(batches):
        lattice = Lattice(pieces, logp)
        for b in batches:
            words = b.column("word").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(_hashes(b.column("word"))), b.column("n"),
                 pa.array([lattice.forward(w.decode("utf-8", "replace")) / LOG10 for w in words], pa.float64())], ["h", "n", "lp"])
    return run


def train(counts: DataFrame, pieces: list[str], n_docs: int, steps: int = 2, smoothing: float = 0.1) -> np.ndarray:
    """Log probabilities of the pieces and, last, of the end.  ``counts(word, n)``
    covers all training words; what reaches the driver is one number per piece."""
    logp = -np.log(np.arange(len(pieces)) + 2.7)  # the existing order of scores, as a Zipf law
    logp -= np.log(np.exp(logp).sum())
    expected = np.zeros(len(pieces))
    for _ in range(steps):
        sums = (map_arrow(counts, _expect(pieces, logp), "piece long, expected double")
                .groupBy("piece").agg(F.sum("expected").alias("expected")).collect())
        expected = np.zeros(len(pieces))
        for r in sums:
            expected[r["piece"]] = r["expected"]
        logp = np.log((expected + smoothing) / (expected.sum() + smoothing * len(pieces)))
    pieces_total, ends = expected.sum() + smoothing * len(pieces), n_docs + smoothing
    # pieces and the end share one distribution
    return np.append(logp + math.log(pieces_total / (pieces_total + ends)), math.log(ends / (pieces_total + ends)))


def _chunk_words(table: pa.Table) -> pa.Table:
    chunk = table.column("chunk")[0].as_py()
    # each of Spark's batches gives its distinct words first, so that not all words of the chunk are held
    seen = pa.chunked_array([_words(b)[0].unique() for b in table.column("body").chunks], pa.string()).unique()
    return pa.table({"chunk": pa.array(np.full(len(seen), chunk, np.int64)), "h": pa.array(_hashes(seen))})


_SCORES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
                        T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                        T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
                        T.StructField("score", T.DoubleType())])


def _score_chunk(total: int, distinct: int, ends: int, end_lp: float):
    """Scores of a chunk's texts, given the counts and probabilities of its words."""
    names = [f.name for f in _SCORES]

    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        h, n, lp = (words.column(c).to_numpy() for c in ("h", "n", "lp"))
        order = np.argsort(h)
        h, n, lp = h[order], n[order], lp[order]
        base, known = np.log10((n + 1) / (total + distinct + 1)), n > 0
        coded, begins = [], []
        for b in texts.column("body").chunks:
            ws, begin = _words(b)
            coded.append(ws.dictionary_encode())
            begins.append(begin)
        coded = pa.chunked_array(coded, pa.dictionary(pa.int32(), pa.string())).unify_dictionaries().chunks
        wanted = _hashes(coded[0].dictionary)
        place = np.searchsorted(h, wanted)
        if not np.array_equal(h[place[place < len(h)]], wanted):
            raise KeyError("a word of the chunk has no counts")
        cols: list[list] = [[] for _ in names[2:]]
        for ws, begin in zip(coded, begins):
            x = place[ws.indices.to_numpy()]
            for i, j in pairwise(begin.tolist()):
                y = x[i:j]
                row = (j - i + 1, int(np.count_nonzero(known[y])) + (ends > 0), total,
                       float(base[y].sum()) + math.log10((ends + 1) / (total + distinct + 1)), float(lp[y].sum()) + end_lp)
                for c, v in zip(cols, row):
                    c.append(v)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table(dict(zip(names, [texts.column("id"), texts.column("held_out"), *(pa.array(c, t) for c, t in zip(cols, kinds))])))
    return run


def score_documents(docs: DataFrame, vocabulary_path: str, held_out_modulus: int = 7, held_out_rest: int = 2,
                    chunk_bytes: int = CHUNK_BYTES, steps: int = 2) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``.

    Texts are lower-cased (A-Z) and cut into words; an end follows the last
    word and counts as a token.  ``base_score`` is the add-one log10
    probability of the tokens under the training counts, ``score`` the
    log10 marginal probability under the lattice.  Rows with
    ``crc32(doc_id as text) mod held_out_modulus = held_out_rest`` are held out of all
    counts; a null id counts as empty text.  A null or empty text is the end alone.
    Repeated rows count each time.  Without any training row all counts are
    0.  Extra columns are ignored.

    Words meet their counts by 64-bit hash.
    """
    held = id_bucket("doc_id", held_out_modulus) == held_out_rest
    d = docs.select(F.col("doc_id").cast("long").alias("id"), held.alias("held_out"), text_or_empty().cast("binary").alias("body"))
    size = d.agg(F.sum(F.octet_length("body")).alias("bytes"), F.sum((~F.col("held_out")).cast("long")).alias("ends")).first()
    n_bytes, ends = size["bytes"] or 0, size["ends"] or 0
    pieces = read_vocabulary(vocabulary_path)

    partial = map_arrow(d.select("body", (~F.col("held_out")).alias("train")), _count_words, _COUNTS)
    counts = kept(partial.groupBy("word").agg(F.sum("n").alias("n")))
    r = counts.agg(F.sum("n").alias("n"), F.sum((F.col("n") > 0).cast("long")).alias("v")).first()
    total, distinct = (r["n"] or 0) + ends, (r["v"] or 0) + (ends > 0)
    logp = train(counts, pieces, ends, steps)
    words = kept(map_arrow(counts, _score_words(pieces, logp[:-1]), "h long, n long, lp double"))

    chunks = max(1, -(-n_bytes // chunk_bytes))
    parts = d.withColumn("chunk", F.pmod(F.xxhash64("id", "body"), F.lit(chunks))).repartition("chunk")
    chunk_words = parts.groupBy("chunk").applyInArrow(_chunk_words, "chunk long, h long")
    chunk_words = chunk_words.join(words, "h")
    return parts.groupBy("chunk").cogroup(chunk_words.groupBy("chunk")).applyInArrow(
        _score_chunk(total, distinct, ends, logp[-1] / LOG10), _SCORES)
