"""Language-model scoring by a weighted backoff automaton.

The states are the root and one per training word, which is the history after reading that word. A state's arcs
are the pairs seen in training, with an absolutely discounted probability; a word without an arc is read over the
failure arc, whose weight is the mass left by the discount, from the root. The root's arcs are the training words
and the class of all other words, which spells a word by its smoothed count within the class. A text is scored in
one traversal from left to right, which carries the state and adds up log-probabilities.

States and arcs grow with the corpus, and none come to the driver. Tasks count the words and pairs of each chunk of
texts and deal them by history to buckets, each chunk's share of a bucket as one row. A bucket adds up the counts of
all chunks and sends each chunk its own, in the chunk's order and so without the keys; a chunk has them again from its
texts. The pairs of very frequent histories are dealt by both words, and their arcs are summed over the buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (as pa.compute)
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from parcelrisk.llm.common import blocks, fold, map_rows, mix64, stored, text_or_empty, type_of

DISCOUNT = 0.75
CHUNK_BYTES = 4 << 20       # text of a chunk, about
BUCKET_BYTES = 8 << 20     # text whose pairs are added up at once, about
HEAVY = 500_000             # occurrences from which a history's pairs are dealt by both words
FLUSH_TOKENS = 700_000    # of words counted in a task before counts are handed on
HELD_TOKENS = 2_000_000     # of chunks whose pairs a task counts together
KNOWN_WORDS = 150_000
ROWS = 500                  # rows handed on at once
END = 1                     # key of the end token; words' keys are hashes
START, OTHER, WORD = 2, 3, 4     # the history at a text's start, the class of all other words, and what counts of words stand under
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


class WordKeys(dict):
    """64-bit hashes of words, as signed integers."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        self[word] = h = h - (1 << 64) if h >> 63 else h
        return h


@lru_cache(maxsize=1)
def _keys() -> WordKeys:
    return WordKeys()


def token_keys(text: str) -> np.ndarray:
    """Keys of the text's words, then the end's."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    return np.fromiter((*map(_keys().__getitem__, words), END), np.int64, len(words) + 1)


class Chunk:
    """The words and pairs of a chunk's texts, each once: ``a`` is WORD or a history, ``b`` the word or the class after it.

    Words come first, then pairs, both by their keys; ``word`` and ``pair`` have the place of each token's own.
    """

    def __init__(self, texts: list[np.ndarray], frequent: np.ndarray | None, heavy: np.ndarray, buckets: int):
        self.lens = np.array([len(x) for x in texts])
        self.starts = np.cumsum(self.lens) - self.lens
        words, self.word = np.unique(np.concatenate(texts), return_inverse=True)
        self.words = len(words)
        values, at = np.unique(np.append(classes(words, frequent), START), return_inverse=True)
        cls = at[:-1][self.word]
        history = np.empty(len(cls), np.int64)
        history[1:] = cls[:-1]
        history[self.starts] = at[-1]
        pairs, place = np.unique(history * len(values) + cls, return_inverse=True)
        self.history, self.cls = pairs // len(values), pairs % len(values)   # places in values
        self.values, self.class_of = values, at[:-1]
        self.pair = place
        self.a = np.concatenate([np.full(len(words), WORD), values[self.history]])
        self.b = np.concatenate([words, values[self.cls]])
        by = mix64(values.astype(np.uint64))
        both = np.isin(values, heavy)[self.history]
        dealt = np.where(both, mix64(by[self.history] + values[self.cls].astype(np.uint64)), by[self.history])
        dealt = np.concatenate([mix64(words.astype(np.uint64)), dealt])      # a word goes where its arcs go
        self.bucket = ((dealt >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)

    def shares(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each bucket with the places of its words and pairs, in their order."""
        order = np.argsort(self.bucket, kind="stable")
        first = np.flatnonzero(np.diff(self.bucket[order], prepend=-1))
        for i, j in zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
            yield int(self.bucket[order[i]]), order[i:j]


class Automaton:
    """The part of the automaton that a chunk's texts can reach."""

    def __init__(self, chunk: Chunk, c: np.ndarray, arcs: np.ndarray, ends: dict[int, tuple[int, int]], total: int, size: int,
                 other: int, other_distinct: int, frequent: np.ndarray | None):
        """``c`` has the training counts of the chunk's words and pairs, and ``arcs`` the arcs of its words' states. ``ends``
        has the tokens after START, OTHER and very frequent histories, and their arcs; ``size`` classes and ``total`` tokens
        are in training, ``other`` of them in the class of other words, which has ``other_distinct``. Without ``frequent``
        all training words are states."""
        n = chunk.words
        self.chunk, self.counts, words = chunk, c[:n], chunk.b[:n]
        known = self.counts > 0 if frequent is None else (self.counts > 0) & np.isin(words, frequent)
        seen = np.concatenate([self.counts, [ends.get(START, (0, 0))[0], ends.get(OTHER, (0, 0))[0]]]).astype(np.float64)
        many = [k for k in ends if k not in (START, OTHER)]
        at = np.minimum(np.searchsorted(words, many), n - 1).astype(np.int64)
        hit = words[at] == many
        arcs = np.concatenate([arcs, [ends.get(START, (0, 0))[1], ends.get(OTHER, (0, 0))[1]]])
        arcs[at[hit]] = np.array([ends[k][1] for k in many], np.int64)[hit]
        left = np.where(seen > 0, DISCOUNT * arcs / np.maximum(seen, 1), 1.0)    # weight of the failure arc
        root = (np.concatenate([self.counts, [0, other]]) + 1) / (total + size)
        state = np.where(known, np.arange(n), n + 1)         # a word that is no state has the class of all other words
        of = np.full(len(chunk.values), n + 1)
        of[chunk.class_of] = np.where(chunk.values[chunk.class_of] == OTHER, n + 1, state)
        of[chunk.values == START] = n
        history, cls, pairs = of[chunk.history], of[chunk.cls], c[n:]
        p = left[history] * root[cls] + np.where(pairs > 0, np.maximum(pairs - DISCOUNT, 0) / np.maximum(seen[history], 1), 0)
        self.steps = np.log10(p)                             # of each pair
        self.spelt = np.where(known, 0.0, np.log10((self.counts + 1) / (other + other_distinct + 1)))

    def traverse(self) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the probability of each token after the one before it, and its count in training.

        The state after a token is given by the token alone, so the steps of a whole chunk are looked up at once.
        """
        return self.steps[self.chunk.pair] + self.spelt[self.chunk.word], self.counts[self.chunk.word]


def classes(keys: np.ndarray, frequent: np.ndarray | None) -> np.ndarray:
    return keys if frequent is None else np.where(np.isin(keys, frequent), keys, OTHER)


def with_chunks(docs: DataFrame, id_col: str, text_col: str, folds: int, held: int) -> tuple[DataFrame, int]:
    """(id, text, trains, chunk): rows of one piece of a file share a few chunks of bounded size. And the bytes of all texts."""
    rows = (docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("text"),
                        F.input_file_name().alias("f"), F.input_file_block_start().alias("s"))
            .withColumn("trains", fold(F.col("id"), folds) != held))
    most, total = rows.groupBy("f", "s").agg(F.sum(F.octet_length("text")).alias("b")).agg(F.max("b"), F.sum("b")).first()
    part = F.pmod(F.xxhash64("id", "text"), F.lit(int(most or 0) // CHUNK_BYTES + 1))
    return rows.withColumn("chunk", F.xxhash64("f", "s", part)).drop("f", "s"), int(total or 0)


def _counted(keys: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    values, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return values, np.bincount(inverse, np.concatenate(weights), len(values)).astype(np.int64)


def word_counts(rows: DataFrame) -> DataFrame:
    """(key, c): training counts of all words, written down; counted in tasks before they are shuffled."""
    def run(it: Iterator[tuple]) -> Iterator[dict]:
        for part in blocks(it, lambda r: len(r[0]), FLUSH_TOKENS * 6):
            keys = [token_keys(t) for t, trains in part if trains]
            k, c = _counted(keys, [np.ones(len(x)) for x in keys])
            yield {"key": k, "c": c}

    return stored(map_rows(rows.select("text", "trains"), run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c")), "words")


def _key_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a.astype(np.uint64)) + b.astype(np.uint64)


def _dealt_pairs(rows: DataFrame, frequent: np.ndarray | None, heavy: np.ndarray, buckets: int) -> DataFrame:
    """(chunk, bucket, a, n, b, c): the words and pairs of each chunk by bucket with their counts in the chunk's training texts.
    ``a`` is written once for each of its runs, ``n`` is a run's length. Those that only texts held out have are there too."""
    known = rows.sparkSession.sparkContext.broadcast((frequent, heavy))

    def counted(groups: dict[int, list[tuple]]) -> Iterator[dict]:
        while groups:
            number, texts = groups.popitem()
            chunk = Chunk([k for k, _ in texts], *known.value, buckets)
            train = np.repeat([float(t) for _, t in texts], chunk.lens)
            c = np.concatenate([np.bincount(chunk.word, train, chunk.words), np.bincount(chunk.pair, train, len(chunk.cls))]).astype("<i4")
            out: dict[str, list] = {x: [] for x in ("chunk", "bucket", "a", "n", "b", "c")}
            for bucket, at in chunk.shares():
                a = chunk.a[at]
                run = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
                lens = np.diff(np.append(run, len(a))).astype("<i4")
                row = (number, bucket, a[run].astype("<i8").tobytes(), lens.tobytes(), chunk.b[at].astype("<i8").tobytes(), c[at].tobytes())
                for held, v in zip(out.values(), row, strict=True):
                    held.append(v)
                if len(out["chunk"]) == ROWS:
                    yield out
                    out = {x: [] for x in out}
            yield out

    def run(it: Iterator[tuple]) -> Iterator[dict]:
        groups: dict[int, list[tuple]] = {}
        held = 0
        for text, trains, number in it:
            keys = token_keys(text)
            groups.setdefault(number, []).append((keys, trains))
            held += len(keys)
            if held >= HELD_TOKENS:
                yield from counted(groups)
                groups, held = {}, 0
        yield from counted(groups)

    return map_rows(rows.select("text", "trains", "chunk"), run, "chunk long, bucket long, a binary, n binary, b binary, c binary")


_SUMS = "chunk long, bucket long, mark long, c binary, arcs binary, a long, seen long, n long"


def _added_up(dealt: DataFrame, heavy: np.ndarray) -> DataFrame:
    """(chunk, bucket, mark, c, arcs): the counts in all training texts of each chunk's words and pairs in a bucket, in the
    chunk's order, and the arcs of its words' states. ``mark`` is the sum of their keys. Rows without a chunk
    have a very frequent history ``a`` with the tokens and arcs after it, as far as they are in the bucket."""
    known = dealt.sparkSession.sparkContext.broadcast(heavy)
    arrow = to_arrow_schema(StructType.fromDDL(_SUMS))

    def joined(column: pa.ChunkedArray, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), kind)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        bucket = table["bucket"][0].as_py()
        numbers, row_of = np.unique(table["chunk"].to_numpy(), return_inverse=True)
        owner = np.repeat(row_of.astype(np.int32), pa.compute.binary_length(table["b"]).to_numpy() // 8)
        a, b, c = np.repeat(joined(table["a"], "<i8"), joined(table["n"], "<i4")), joined(table["b"], "<i8"), joined(table["c"], "<i4")
        del table
        key = _key_of(a, b)
        order = np.argsort(key)
        first = np.flatnonzero(np.concatenate([[True], key[order[1:]] != key[order[:-1]]]))
        sums = np.add.reduceat(c[order].astype(np.int64), first)
        total = np.empty(len(key), np.int64)
        total[order] = np.repeat(sums, np.diff(np.append(first, len(key))))
        once, sums = order[first][sums > 0], sums[sums > 0]
        once, sums = once[a[once] != WORD], sums[a[once] != WORD]
        histories, of = np.unique(a[once], return_inverse=True)
        arcs, seen = np.bincount(of, minlength=len(histories)), np.bincount(of, sums, len(histories)).astype(np.int64)
        if len(numbers) < len(row_of):      # a chunk whose texts were counted in several goes
            order = np.lexsort((b, a, a != WORD, owner))
            new = np.concatenate([[True], (np.diff(owner[order]) != 0) | (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])])
            owner, a, b, key, total = (x[order[new]] for x in (owner, a, b, key, total))
        out: dict[str, list] = {f.name: [] for f in arrow}
        bounds = np.searchsorted(owner, np.arange(len(numbers) + 1))
        for number, i, j in zip(numbers.tolist(), bounds[:-1], bounds[1:], strict=True):
            word = b[i:j][a[i:j] == WORD]
            at = np.minimum(np.searchsorted(histories, word), max(0, len(histories) - 1))
            after = np.zeros(len(word), "<i8")
            if len(histories):
                after = np.where((histories[at] == word) & ~np.isin(word, known.value), arcs[at], 0).astype("<i8")
            row = (number, bucket, int(key[i:j].sum().view(np.int64)), total[i:j].astype("<i8").tobytes(), after.tobytes(), None, None, None)
            for held, v in zip(out.values(), row, strict=True):
                held.append(v)
        for i in np.flatnonzero(np.isin(histories, known.value)).tolist():
            for held, v in zip(out.values(), (None, None, None, None, None, int(histories[i]), int(seen[i]), int(arcs[i])), strict=True):
                held.append(v)
        return pa.table(out, arrow)

    return dealt.groupBy("bucket").applyInArrow(run, _SUMS)


def _counts_of(chunk: Chunk, sums: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The counts of the chunk's words and pairs, and the arcs of its words' states."""
    c, arcs = np.empty(len(chunk.a), np.int64), np.zeros(chunk.words, np.int64)
    rows = {r["bucket"]: r for r in sums.select(["bucket", "mark", "c", "arcs"]).to_pylist()}
    for bucket, at in chunk.shares():
        r = rows.get(bucket)
        if not r or len(r["c"]) != 8 * len(at) or int(_key_of(chunk.a[at], chunk.b[at]).sum().view(np.int64)) != r["mark"]:
            raise RuntimeError("the texts of a chunk changed, or its files were split in another way, since they were counted")
        c[at] = np.frombuffer(r["c"], "<i8")
        arcs[at[at < chunk.words]] = np.frombuffer(r["arcs"], "<i8")
    return c, arcs


def score_corpus(docs: DataFrame, folds: int = 7, held: int = 2, states: int | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row; learnt from the rows not held out.

    All training words are states, or the ``states`` most frequent ones. Null text counts as empty: only the end token.
    If nothing trains, all counts are 0. Repeated rows train and are scored as often as they occur; other columns are
    ignored; an empty table gives an empty one.
    """
    rows, size = with_chunks(docs, id_col, text_col, folds, held)
    words = word_counts(rows)
    frequent, top = None, F.lit(True)
    if states is not None:
        frequent = np.array([r["key"] for r in words.orderBy(F.desc("c"), "key").limit(states).collect()], np.int64)
        top = F.col("key").isin(frequent.tolist())
    totals = words.agg(F.sum("c"), F.count("*"), F.sum(F.when(~top, F.col("c"))), F.count(F.when(~top, 1))).first()
    total, distinct, other, other_distinct = (int(x or 0) for x in totals)
    # few: each has at least HEAVY of all tokens
    heavy = np.array([START, OTHER, *(r["key"] for r in words.filter(F.col("c") >= HEAVY).select("key").collect())], np.int64)
    buckets = size // BUCKET_BYTES + 1
    sums = stored(_added_up(_dealt_pairs(rows, frequent, heavy, buckets), heavy), "counts")
    summed = sums.filter("chunk is null").groupBy("a").agg(F.sum("seen").alias("seen"), F.sum("n").alias("n")).collect()
    ends = {r["a"]: (r["seen"], r["n"]) for r in summed}
    shared = docs.sparkSession.sparkContext.broadcast((ends, total, distinct - other_distinct + 1, other, other_distinct, frequent))

    kind = type_of(docs, id_col)
    schema = (f"{id_col} {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        frequent = shared.value[-1]
        texts = [token_keys(t) for i in range(0, len(left), 500) for t in left["text"].slice(i, 500).to_pylist()]
        chunk = Chunk(texts, frequent, heavy, buckets)
        steps, c = Automaton(chunk, *_counts_of(chunk, right), *shared.value).traverse()
        add = lambda x: np.add.reduceat(x, chunk.starts)  # noqa: E731  by text
        values = (left["id"], pa.compute.invert(left["trains"]), chunk.lens, add((c > 0).astype(np.int64)), np.full(len(texts), total),
                  add(np.log10(c + 1) - np.log10(total + distinct + 1)), add(steps))
        return pa.table(list(values), schema=arrow)

    known = sums.filter("chunk is not null").select("chunk", "bucket", "mark", "c", "arcs")
    return rows.select("id", "text", "trains", "chunk").groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, schema)
