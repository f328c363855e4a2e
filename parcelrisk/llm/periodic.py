"""Periodic runs of words, by seeds that are extended along their diagonals.

A run of period q whose length is at least max(shortest, 2 q) equals itself q words on for at least
max(shortest - q, q) words: its overlap. Lags are taken in bands, each twice as far as the one before. Within a band
the smallest overlap is known, and k and a step are chosen so that every such overlap holds a whole k-gram that
starts at a multiple of the step. The k-grams of a batch of documents are indexed by document and hash, and the
occurrences of a k-gram of the same document whose distance lies in the band are paired with the ones at multiples
of the step. A pair lies on the diagonal of its lag; pairs of one diagonal are taken in order, and one that lies
within what is covered already carries the cover on instead of being extended. So each stretch is extended once, to
either side by less than a step. A stretch found at several lags is one run of the smallest of them.

However periodic a text is, a band has at most a few pairs per word, so the work grows with n log n.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelrisk.llm.common import blocks, concat_ranges, map_rows, mix64, text_or_empty, type_of

SHORTEST = 12             # words of a run
BLOCK_CHARS = 3_000_000   # text of the documents that are searched together
Edit = Callable[[object, int], "tuple[int, int] | None"]


class SpanHash:
    """Hashes of the spans of a sequence of numbers, modulo 2^64. Equal spans have equal hashes."""

    def __init__(self, numbers: np.ndarray, salt: int):
        base = (0x9E3779B97F4A7C15 + 2 * salt * 0xD1B54A32D192ED03) % (1 << 64) | 1
        power, inverse = (self._powers(b, len(numbers) + 1) for b in (base, pow(base, -1, 1 << 64)))
        self.inverse = inverse
        self.prefix = np.zeros(len(numbers) + 1, np.uint64)
        np.cumsum(mix64(numbers.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019 + salt)) * power[:-1], out=self.prefix[1:])

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:
            out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
        return out[:n]

    def spans(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        return (self.prefix[starts + lengths] - self.prefix[starts]) * self.inverse[starts]


def bands(shortest: int, longest: int) -> Iterator[tuple[int, int, int, int]]:
    """(first lag, last lag, k, step): every run of a lag of the band has a k-gram at a multiple of the step in its overlap."""
    lo, hi = 1, shortest - 1
    while 2 * lo <= longest:
        overlap = min(max(shortest - q, q) for q in range(lo, hi + 1)) if lo < shortest else lo
        step = max(1, overlap // 2)
        yield lo, hi, overlap - step + 1, step
        lo, hi = hi + 1, 2 * hi + 1


def _shared(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index: the places whose key occurs more than once, by key and place, and the number of each one's key."""
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    group = np.cumsum(new) - 1
    several = np.bincount(group)[group] > 1
    return at[several], group[several]


def _reach(equal: Callable[[np.ndarray], np.ndarray], most: np.ndarray) -> np.ndarray:
    """Per stretch the largest extension of at most ``most`` words that ``equal`` holds for."""
    lo, hi = np.zeros_like(most), most
    while (lo < hi).any():
        mid = (lo + hi + 1) // 2
        fits = equal(mid)
        lo, hi = np.where(fits, mid, lo), np.where(fits, hi, mid - 1)
    return lo


def _stretches(hashes: SpanHash, doc: np.ndarray, shortest: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, overlap, lag) of the maximal stretches that hold a seed."""
    n = len(doc)
    found = [np.empty((3, 0), np.int64)]
    at = np.arange(n, dtype=np.int64)
    salt = mix64(doc.astype(np.uint64) + np.uint64(1))
    for lo, hi, k, step in bands(shortest, longest):
        at = at[at + k <= n]
        if not len(at):
            break
        at, group = _shared(hashes.spans(at, k) ^ salt[at], at)
        if not len(at):
            break
        index = group * (2 * n + hi) + at                         # ascending: by k-gram, then place
        seed = index[at % step == 0]
        left, right = np.searchsorted(index, seed + lo), np.searchsorted(index, seed + hi, side="right")
        here = np.repeat(at[at % step == 0], right - left)
        lag = at[concat_ranges(left, right - left)] - here
        order = np.lexsort((here, lag))                           # along each diagonal
        here, lag = here[order], lag[order]
        at = np.sort(at)
        if not len(here):
            continue
        # a seed one step after another of its diagonal starts within what that one covers
        fresh = np.concatenate([[True], (lag[1:] != lag[:-1]) | (here[1:] - here[:-1] != step)])
        first, q = here[fresh], lag[fresh]
        end = here[np.append(np.flatnonzero(fresh)[1:] - 1, len(here) - 1)] + k
        back = _reach(lambda e, a=first, q=q: hashes.spans(a - e, e) == hashes.spans(a - e + q, e), np.minimum(step - 1, first))
        on = _reach(lambda e, a=end, q=q: hashes.spans(a, e) == hashes.spans(a + q, e), np.minimum(step - 1, n - end - q))
        found.append(np.stack([first - back, end + on - first + back, q]))
    return tuple(np.concatenate(found, axis=1))


def _holds(numbers: np.ndarray, start: np.ndarray, overlap: np.ndarray, lag: np.ndarray) -> bool:
    """Whether the words bear out the stretches: equal along each, different on both sides."""
    for i in range(0, len(start), 1000):
        s, m, q = start[i:i + 1000], overlap[i:i + 1000], lag[i:i + 1000]
        place = concat_ranges(s, m)
        if not (np.array_equal(numbers[place], numbers[place + np.repeat(q, m)])
                and (numbers[s - 1] != numbers[s - 1 + q]).all() and (numbers[s + m] != numbers[s + m + q]).all()):
            return False
    return True


def find_runs(texts: list[np.ndarray], shortest: int = SHORTEST) -> tuple[np.ndarray, ...]:
    """(text number, start, length, period) of all runs of texts of word numbers, in this order.

    A run is a stretch of at least max(shortest, 2 * period) words that equals itself a period on, of the smallest
    such period, and that no neighbouring word extends. Hashes find the stretches; the words confirm them, and if
    they don't, the search is repeated with other hashes.
    """
    lens = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lens + 1)
    starts = ends - lens                                          # a number of its own stands before each text, and at the end
    doc = np.append(np.repeat(np.arange(len(texts)), lens + 1), len(texts))
    numbers = np.empty(len(doc), np.int64)
    numbers[np.append(starts - 1, len(numbers) - 1)] = -1 - np.arange(len(texts) + 1)
    if len(texts):
        numbers[concat_ranges(starts, lens)] = np.concatenate(texts)
    for salt in count():
        start, overlap, lag = _stretches(SpanHash(numbers, salt), doc, shortest, int(lens.max(initial=0)))
        long = overlap + lag >= np.maximum(shortest, 2 * lag)
        start, overlap, lag = start[long], overlap[long], lag[long]
        order = np.lexsort((lag, overlap + lag, start))
        start, overlap, lag = start[order], overlap[order], lag[order]
        new = np.ones(len(start), bool)
        new[1:] = (start[1:] != start[:-1]) | ((overlap + lag)[1:] != (overlap + lag)[:-1])
        start, overlap, lag = start[new], overlap[new], lag[new]
        if _holds(numbers, start, overlap, lag):
            break
    order = np.lexsort((lag, start))
    start, overlap, lag = start[order], overlap[order], lag[order]
    return doc[start], start - starts[doc[start]] if len(start) else start, overlap + lag, lag


def repeated_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``n`` words a run contains after its first period."""
    step = np.bincount(start + period, minlength=n + 1)[:n + 1] - np.bincount(start + length, minlength=n + 1)[:n + 1]
    return np.cumsum(step[:n]) > 0


def periodic_edit(doc: object, n: int) -> tuple[int, int] | None:
    """Where a tenth of the documents become periodic: from word a on, with period p. A document without an id never does."""
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST,
                  edit: Edit | None = None) -> DataFrame:
    """Columns id, n_words, runs (array of start, length, period, by start and period) and collapsed, for every row.

    Words stand between ASCII white space. ``collapsed`` has the words that no run contains after its first period,
    joined by one space. With ``edit`` a document's words from a on are first replaced by its word a + (i - a) mod p.
    Null and empty texts have no words, no runs and an empty collapsed text; repeated rows and rows without an id
    are searched like all others; a text of any length is searched whole; other columns are ignored; an empty table
    gives an empty one.
    """
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(rows: Iterator[tuple]) -> Iterator[dict]:
        for part in blocks(rows, lambda r: len(r[1]) + 16, BLOCK_CHARS):
            known: dict[bytes, int] = {}
            texts, numbers = [], []
            for doc, text in part:
                words = text.encode("utf-8", "surrogatepass").split()
                ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
                change = edit(doc, len(words)) if edit else None
                place = np.arange(len(words))
                if change:
                    a, p = change
                    place[a:] = a + (place[a:] - a) % p
                    words, ids = [words[j] for j in place], ids[place]
                texts.append(words)
                numbers.append(ids)
            owner, start, length, period = find_runs(numbers, shortest)
            first = np.searchsorted(owner, np.arange(len(part) + 1))
            collapsed = []
            for i, words in enumerate(texts):
                at = slice(first[i], first[i + 1])
                kept = words
                if at.start < at.stop:
                    kept = [words[j] for j in np.flatnonzero(~repeated_words(len(words), start[at], length[at], period[at]))]
                collapsed.append(b" ".join(kept).decode("utf-8", "surrogatepass"))
            runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
            yield {id_col: [r[0] for r in part], "n_words": [len(w) for w in texts],
                   "runs": pa.ListArray.from_arrays(pa.array(first, pa.int32()), runs).cast(run_type), "collapsed": collapsed}

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("text"))
    return map_rows(rows, run, f"{id_col} {type_of(docs, id_col)}, n_words long, "
                               "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def runs_of_documents(docs: DataFrame) -> DataFrame:
    """Per document the number of runs, its longest one, and digests of all runs and of the collapsed text."""
    found = periodic_runs(docs, edit=periodic_edit)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return (found.withColumn("_best", longest)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.s")).alias("start"), F.col("_best.length").alias("length"),
                    (-F.col("_best.p")).alias("period"), F.expr("(1000 * _best.length) div (-_best.p)").alias("exponent_milli"),
                    F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"), "n_words"))
