"""Best-fit packing of documents into training sequences, by patterns.

Few-document length patterns that fill a sequence exactly are enumerated from the histogram of piece lengths,
their repeat counts are fitted to the histogram by non-negative least squares and rounded, and what is left is
packed best-fit on the histogram. The driver only sees the histogram, which has ``capacity`` bins at most;
pieces get their places by their rank among the pieces of their length.
"""

from __future__ import annotations

import bisect
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelrisk.llm.bpe import byte_stand_ins
from parcelrisk.llm.common import blocks, map_rows, stored, text_or_empty, type_of

FIT_STEPS = 80
RANK_ROWS = 100_000       # pieces ranked together
BLOCK_CHARS = 2_000_000
KNOWN_WORDS = 600_000     # a cache; cleared when full
#: Printable ASCII and the Latin letters of Western Europe, which are composed already and have simple lower cases.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: The vocabulary file's way to cut a word of such characters.
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zA-ZÀ-ÖØ-öø-ÿ]+|[0-9]|[^\\sa-zA-Z0-9À-ÖØ-öø-ÿ]+")


class WordBpe:
    """Ids of whole texts for a vocabulary that drops white space, so each word is encoded on its own, once.

    Words of Latin letters and common signs are normalised and cut here, by the vocabulary file's own rules, and only
    the merges are left to the library; all other words go through the whole library.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks take the cores
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.stand_in = {b: ord(c) for c, b in byte_stand_ins().items()}
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.stand_in)
            ids = [t.id for t in self.tok.model.tokenize(mapped)]
            found = self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def _learn(self, words: list[bytes]) -> None:
        rest = []
        for w in words:
            text = w.decode()
            if _PLAIN.fullmatch(text) and not any(a in text for a in self.added):
                self.known[w] = b"".join([self._piece(x) for x in _PIECES.findall(text.lower())])
            else:
                rest.append(w)
        for w, e in zip(rest, self.tok.encode_batch([w.decode() for w in rest], add_special_tokens=False), strict=True):
            self.known[w] = struct.pack(f"<{len(e.ids)}I", *e.ids)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids."""
        words = [t.encode().split() for t in texts]
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        if len(self.pieces) > KNOWN_WORDS:
            self.pieces.clear()
        self._learn(list(set(chain.from_iterable(words)).difference(self.known)))
        get = self.known.__getitem__
        return [b"".join(map(get, ws)) for ws in words]


@lru_cache(maxsize=2)
def word_vocabulary(path: str) -> WordBpe:
    return WordBpe(path)


def cut_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str, text_col: str,
               with_ids: bool = False) -> DataFrame:
    """One row per piece of each document's ids, the end id included."""
    schema = f"{id_col} {type_of(docs, id_col)}, piece int, start long, length long, ids_crc32 long"
    end = np.array([end_id], "<u4").tobytes()

    def run(rows: Iterator[tuple]) -> Iterator[dict]:
        bpe = word_vocabulary(path)
        for part in blocks(rows, lambda r: len(r[1]), BLOCK_CHARS):
            out: dict[str, list] = {k: [] for k in (id_col, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids)}
            for (doc, _), ids in zip(part, bpe.encode_batch([r[1] for r in part]), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at:at + 4 * capacity]
                    values = (doc, k, at // 4, len(cut) // 4, zlib.crc32(cut), *[np.frombuffer(cut, "<u4").tolist()] * with_ids)
                    for name, v in zip(out, values, strict=True):
                        out[name].append(v)
            yield out

    rows = docs.select(F.col(id_col), text_or_empty(F.col(text_col)).alias("text"))
    return map_rows(rows, run, schema + (", ids array<long>" if with_ids else ""))


def enumerate_patterns(counts: np.ndarray) -> np.ndarray:
    """All triples of lengths, 0 for none, that sum to the capacity; ``counts`` by length, 0 to the capacity.

    There are at most capacity^2 / 12 of them, 1.4 million for 4096, however many pieces there are.
    """
    cap = len(counts) - 1
    present = counts > 0
    lengths = np.flatnonzero(present[1:]) + 1
    found = [np.array([[cap, 0, 0]])] if present[cap] else []
    for a in lengths[lengths < cap]:
        b = lengths[lengths <= a]
        c = cap - a - b
        fits = (c >= 0) & (c <= b) & (present[np.maximum(c, 0)] | (c == 0))
        found.append(np.column_stack([np.full(fits.sum(), a), b[fits], c[fits]]))
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def fit_repeats(patterns: np.ndarray, counts: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Non-negative least squares: repeat counts whose patterns use the histogram up (accelerated projected gradient)."""
    if not len(patterns):
        return np.empty(0)
    size, target = len(counts), counts.astype(float)
    target[0] = 0

    def used(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(patterns[:, j], x, size) for j in range(3))
        out[0] = 0
        return out

    def back(r: np.ndarray) -> np.ndarray:
        return r[patterns[:, 0]] + r[patterns[:, 1]] + r[patterns[:, 2]]

    v = np.ones(len(patterns))
    for _ in range(12):  # the largest curvature, by power iteration
        v = back(used(v))
        top = np.linalg.norm(v)
        v /= top
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - back(used(y) - target) / (1.05 * top))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan_sequences(histogram: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Where the pieces of each length go: rows (length, ranks from lo to hi, first sequence, pieces of that length
    in each, place of the first), sorted by length and lo."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    next_rank = np.zeros(capacity + 1, np.int64)
    rows: list[tuple] = []
    n_seq = 0

    def use(lengths: list[int], times: int) -> None:
        nonlocal n_seq
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            k = lengths.count(length)
            rows.append((length, next_rank[length], next_rank[length] + k * times, n_seq, k, offset))
            next_rank[length] += k * times
            left[length] -= k * times
            offset += k * length
        n_seq += times

    patterns = enumerate_patterns(left)
    repeats = np.round(fit_repeats(patterns, left)).astype(np.int64)
    for i in np.argsort(-repeats, kind="stable"):
        if repeats[i] < 1:
            break
        lengths = [int(x) for x in patterns[i] if x]
        times = min(int(repeats[i]), *(int(left[x]) // lengths.count(x) for x in lengths))
        if times:
            use(lengths, times)

    present = [int(x) for x in np.flatnonzero(left)]
    while present:  # the longest piece that still fits, again and again
        lengths, room = [], capacity
        at = len(present) - 1
        while at >= 0:
            x = present[at]
            k = min(room // x, int(left[x]))
            lengths += [x] * k
            room -= k * x
            at = min(at - 1, bisect.bisect_right(present, room) - 1)
        times = min(int(left[x]) // lengths.count(x) for x in set(lengths))
        use(lengths, times)
        for x in set(lengths):
            if not left[x]:
                present.pop(bisect.bisect_left(present, x))
    table = np.array(rows, np.int64).reshape(-1, 6)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    return dict(zip(("length", "lo", "hi", "sequence", "each", "offset"), table.T, strict=True))


def rank_within(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """A rank from 0 among the rows of each key, which may hold any share of all rows.

    Rows of a key are dealt over buckets of about ``RANK_ROWS``, ranked there, and the buckets' sizes added up.
    """
    n = df.count()
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(max(1, n // RANK_ROWS))).cast("int"))
    sizes = df.groupBy(key, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = Window.partitionBy(key, "_bucket").orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(own)).join(starts, [key, "_bucket"])
            .withColumn(name, F.col("_before") + F.col("_rn") - 1).drop("_bucket", "_rn", "_before"))


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Each piece of each document with its sequence and place there; ``with_ids`` adds the piece's ids.

    Null text counts as empty: a document of the end id alone. Only documents longer than ``capacity`` are cut.
    Repeated rows are packed as often as they occur, in any order among themselves; other columns are ignored; an
    empty table gives an empty one.
    """
    pieces = stored(cut_pieces(docs, path, capacity, end_id, id_col, text_col, with_ids), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # capacity rows at most
    plan = pieces.sparkSession.sparkContext.broadcast(plan_sequences(histogram, capacity))
    ranked = rank_within(pieces, "length", [id_col, "piece", "start", "ids_crc32"], "_rank")
    names = pieces.columns

    def place(rows: Iterator[tuple]) -> Iterator[dict]:
        p = plan.value
        keys = p["length"] << 40 | p["lo"]
        for part in blocks(rows, lambda r: 1, 20_000):
            cols = dict(zip((*names, "_rank"), map(list, zip(*part, strict=True)), strict=True))
            length, rank = np.array(cols["length"]), np.array(cols.pop("_rank"))
            at = np.searchsorted(keys, length << 40 | rank, side="right") - 1
            nth = rank - p["lo"][at]
            yield cols | {"sequence_id": (p["sequence"][at] + nth // p["each"][at]).tolist(),
                          "offset": (p["offset"][at] + nth % p["each"][at] * length).tolist()}

    schema = ", ".join(f"{c} {t}" for c, t in pieces.dtypes) + ", sequence_id long, offset long"
    return map_rows(ranked.select(*names, "_rank"), place, schema)
