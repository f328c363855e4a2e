"""Ranked lexical search over per-term geometric blocks.

The index consists of segments of a bounded number of documents. Within a segment the posting list of each term is
cut into blocks of similar documents: some of the list's documents are its pivots, and each document goes to the
pivot that points the most in its direction, in a signed projection of its weighted terms. A block stores, as its
summary, the largest contribution that any of its documents gets from each term.

The terms of an item are ordered from the rarest to the commonest, and a document counts to the list of its rarest
one. So in a term's list only that term and commoner ones can add to a score, the summary needs no others, and its
product with the item's weights bounds the scores of the block. A block is skipped only if its bound is below a score
that as many documents as are wanted have reached already; ties are looked at. The result is exact: the blocks decide
what is read, never what is found.

A first search of the best blocks alone gives each item a score to beat, which the second search starts from.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelrisk.llm.common import blocks, concat_ranges, map_rows, mix64, stored, text_or_empty, type_of

BLOCK = 64                   # documents of a block, about
DIMS = 16                    # of the projection that tells similar documents
SEGMENT_DOCS = 4096
SEGMENT_CELLS = 16_000_000   # documents times terms of a segment
ITEM_BYTES = 1 << 20         # text of the items that are searched for at once, about
BLOCK_CHARS = 4_000_000
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def search_terms(text: str) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TERMS).split()


@dataclass
class Wanted:
    """The items of a batch, and what the documents say about their terms. Terms are numbered from the rarest on."""

    number: dict[bytes, int]        # of each term, before the documents were counted
    rank: np.ndarray                # by that number, the term's place from the rarest to the commonest
    weights: np.ndarray             # by rank
    items: list[np.ndarray]         # ranks of each item's terms, ascending
    with_term: list[np.ndarray]     # by rank, the term and the commoner ones that some item has along with it
    documents: int
    terms: int

    def contributions(self, n: np.ndarray, tf: np.ndarray) -> np.ndarray:
        m = 10 + (90 * n * self.documents) // max(self.terms, 1)
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def count_terms(docs: DataFrame, number: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tfs) of every document, written down: all its terms counted, and those of the items one by one."""
    known = docs.sparkSession.sparkContext.broadcast(number)

    def run(rows: Iterator[tuple]) -> Iterator[dict]:
        wanted = known.value
        for part in blocks(rows, lambda r: len(r[1]), BLOCK_CHARS):
            out: dict[str, list] = {"id": [], "n": [], "terms": [], "tfs": []}
            for doc, text in part:
                words = search_terms(text)
                counts = Counter(words)
                own = [(wanted[w], counts[w]) for w in counts.keys() & wanted.keys()]
                out["id"].append(doc)
                out["n"].append(len(words))
                out["terms"].append([t for t, _ in own])
                out["tfs"].append([c for _, c in own])
            yield out

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("text"))
    return stored(map_rows(rows, run, f"id {type_of(rows, 'id')}, n long, terms array<int>, tfs array<long>"), "search-terms")


def weigh(counted: DataFrame, number: dict[bytes, int], items: list[list[bytes]]) -> Wanted:
    """Counts over all documents; the driver sees a row per term of the items."""
    total = counted.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    documents, terms = int(total["docs"]), int(total["terms"] or 0)
    df = np.zeros(len(number), np.int64)
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]
    order = np.lexsort((np.arange(len(df)), df))
    rank = np.empty(len(df), np.int64)
    rank[order] = np.arange(len(df))
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df[order]], np.int64)
    ranks = [np.unique(rank[[number[t] for t in set(i)]]) if i else np.empty(0, np.int64) for i in items]
    along: list[set[int]] = [set() for _ in df]
    for r in ranks:
        for i, t in enumerate(r.tolist()):
            along[t].update(r[i:].tolist())
    return Wanted(number, rank, weights, ranks, [np.array(sorted(s), np.int64) for s in along], documents, terms)


class Segment:
    """Some documents with their contributions, and their blocked posting lists."""

    def __init__(self, ids: list, ends: np.ndarray, terms: np.ndarray, values: np.ndarray, lists: np.ndarray, sizes: np.ndarray,
                 members: np.ndarray, tops: np.ndarray, wanted: Wanted):
        """``ends`` of each document's postings; ``lists`` has the term of each block, ``sizes`` its number of documents."""
        self.ids, self.wanted = ids, wanted
        self.forward = forward_matrix(ends, terms, values, len(wanted.weights))
        self.members, self.ends = members, np.cumsum(sizes)
        self.first = np.searchsorted(lists, np.arange(len(wanted.weights) + 1))       # of each list's blocks
        widths = np.array([len(c) for c in wanted.with_term], np.int64)
        stops = np.concatenate([[0], np.cumsum(widths[lists])])
        self.tops = [tops[stops[a]:stops[b]].reshape(b - a, -1) if b > a else None
                     for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True)]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i]) if ids[i] is not None else (False,))
        self.place = np.empty(len(ids), np.int64)                                     # by id, a missing one first
        self.place[order] = np.arange(len(ids))

    def bounds(self, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bound, block) of the blocks of an item's terms, highest bound first."""
        found, at = [], []
        for i, t in enumerate(item.tolist()):
            if self.tops[t] is not None:
                here = np.searchsorted(self.wanted.with_term[t], item[i:])
                found.append(self.tops[t][:, here].astype(np.int64) @ self.wanted.weights[item[i:]])
                at.append(np.arange(self.first[t], self.first[t + 1]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        bound, block = np.concatenate(found), np.concatenate(at)
        order = np.argsort(-bound, kind="stable")
        return bound[order], block[order]

    def best(self, item: np.ndarray, k: int, beat: int, most: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """(document, score) of the ``k`` best documents that score ``beat`` or more, and how many documents were scored.

        With ``most`` it stops after as many blocks, and what it gives need not be the best.
        """
        bound, block = self.bounds(item)
        seen = np.zeros(len(self.ids), bool)
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        beat, at, read, step = max(beat, 1), 0, 0, 1
        end = len(bound) if most is None else min(most, len(bound))
        while at < end and bound[at] >= beat:
            some = block[at:min(at + step, end)][bound[at:min(at + step, end)] >= beat]
            lens = np.diff(self.ends, prepend=0)[some]
            new = np.unique(self.members[concat_ranges(self.ends[some] - lens, lens)])
            new = new[~seen[new]]
            seen[new] = True
            read += len(new)
            score = self.forward[np.ix_(new, item)].astype(np.int64) @ self.wanted.weights[item]
            good = score >= beat
            docs, scores = np.concatenate([docs, new[good]]), np.concatenate([scores, score[good]])
            order = np.lexsort((self.place[docs], -scores))[:k]
            docs, scores = docs[order], scores[order]
            if len(docs) == k:
                beat = max(beat, int(scores[-1]))
            at += step
            step = min(2 * step, 32)
        return docs, scores, read


def forward_matrix(ends: np.ndarray, terms: np.ndarray, values: np.ndarray, n_terms: int) -> np.ndarray:
    out = np.zeros((len(ends), n_terms), np.int32)
    out[np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)), terms] = values
    return out


def block_lists(ends: np.ndarray, terms: np.ndarray, values: np.ndarray, wanted: Wanted, block: int) -> tuple[np.ndarray, ...]:
    """(lists, sizes, members, tops) of a segment: its posting lists in blocks of similar documents, with their summaries."""
    n_terms = len(wanted.weights)
    forward = forward_matrix(ends, terms, values, n_terms)
    lens = np.diff(ends, prepend=0)
    owner = np.repeat(np.arange(len(ends)), lens)
    signs = (mix64(np.arange(1, n_terms * DIMS + 1, dtype=np.uint64)) & np.uint64(1)).astype(np.float32).reshape(n_terms, DIMS) * 2 - 1
    where = np.zeros((len(ends), DIMS), np.float32)
    if len(terms):
        np.add.at(where, owner, signs[terms] * (values * wanted.weights[terms])[:, None].astype(np.float32))
    where /= np.maximum(np.linalg.norm(where, axis=1, keepdims=True), 1e-9)
    order = np.argsort(terms, kind="stable")
    owner = owner[order]
    stops = np.searchsorted(terms[order], np.arange(n_terms + 1))
    lists, sizes, members, tops = [], [], [], []
    for t in np.flatnonzero(np.diff(stops)).tolist():
        own = owner[stops[t]:stops[t + 1]]
        starts = np.zeros(1, np.int64)
        if len(own) > block:
            pivots = own[np.argsort(mix64(own.astype(np.uint64) + np.uint64(1)))[:-(-len(own) // block)]]   # drawn by a hash
            near = np.argmax(where[own] @ where[pivots].T, axis=1)
            by = np.argsort(near, kind="stable")
            own, near = own[by], near[by]
            starts = np.flatnonzero(np.concatenate([[True], near[1:] != near[:-1]]))
        lists.append(np.full(len(starts), t))
        sizes.append(np.diff(np.append(starts, len(own))))
        members.append(own)
        tops.append(np.maximum.reduceat(forward[np.ix_(own, wanted.with_term[t])], starts, axis=0).ravel())
    empty = [np.empty(0, np.int64)]
    return tuple(np.concatenate(x or empty) for x in (lists, sizes, members, tops))


def build_index(counted: DataFrame, wanted: Broadcast, n_terms: int, block: int = BLOCK) -> DataFrame:
    """One row per segment, written down. Documents without a term of any item can't score and are in no segment."""
    kind = type_of(counted, "id")
    most = max(1, min(SEGMENT_DOCS, SEGMENT_CELLS // max(n_terms, 1)))
    names = ("ends", "terms", "vals", "lists", "sizes", "members", "tops")

    def run(rows: Iterator[tuple]) -> Iterator[dict]:
        model: Wanted = wanted.value
        for part in blocks(rows, lambda _: 1, most):
            lens = np.array([len(r[2]) for r in part])
            terms = model.rank[np.concatenate([np.asarray(r[2], np.int64) for r in part])]
            n, tf = np.repeat(np.array([r[1] for r in part], np.int64), lens), np.concatenate([np.asarray(r[3], np.int64) for r in part])
            values, ends = model.contributions(n, tf), np.cumsum(lens)
            arrays = (ends, terms, values, *block_lists(ends, terms, values, model, block))
            yield {"ids": [[r[0] for r in part]], **{k: [a.astype(np.int32).tobytes()] for k, a in zip(names, arrays, strict=True)}}

    rows = counted.filter(F.size("terms") > 0).select("id", "n", "terms", "tfs")
    return stored(map_rows(rows, run, f"ids array<{kind}>, " + ", ".join(f"{n} binary" for n in names)), "search-index")


def search_index(index: DataFrame, wanted: Broadcast, k: int, beat: np.ndarray | None) -> DataFrame:
    """(item, id, score, read): of each segment the best documents of each item, by the item's number in the batch.

    Without ``beat`` the best block of each segment alone is read, else all blocks that can reach the item's score in it.
    """
    kind = index.schema["ids"].dataType.elementType.simpleString()
    least = index.sparkSession.sparkContext.broadcast(beat)

    def run(rows: Iterator[tuple]) -> Iterator[dict]:
        model: Wanted = wanted.value
        for ids, *arrays in rows:
            segment = Segment(ids, *(np.frombuffer(a, np.int32).astype(np.int64) for a in arrays[:-1]), np.frombuffer(arrays[-1], np.int32), model)
            out: dict[str, list] = {"item": [], "id": [], "score": [], "read": []}
            for i, item in enumerate(model.items):
                docs, scores, read = segment.best(item, k, 0 if least.value is None else int(least.value[i]), 1 if least.value is None else None)
                out["item"] += [i] * len(docs)
                out["id"] += [ids[d] for d in docs.tolist()]
                out["score"] += scores.tolist()
                out["read"] += [read] * len(docs)
            yield out

    return map_rows(index, run, f"item int, id {kind}, score long, read long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each item; tasks keep no more of them before they are shuffled."""
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _batches(items: DataFrame, item_col: str, text_col: str) -> Iterator[list]:
    """The items in lists of a bounded size of text; a longer item is a list of its own or goes with a few short ones."""
    rows = items.select(F.col(item_col).alias("item"), text_or_empty(F.col(text_col)).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n = int(total) // ITEM_BYTES + 1
    for i in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i).orderBy("item", "text").collect()
        if part:
            yield part


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Columns of ``item_col``, rank, ``id_col``, score: each item's ``k`` best documents of a score above 0.

    Equal scores stand by ascending id, a missing id first. Null and empty texts have no terms: such a document
    isn't counted, such an item finds nothing. Each row of either table stands for itself, so repeated documents are
    counted and ranked as often as they occur, and an item given twice has its ranks twice. Items are searched for in
    batches of a bounded size of text. Other columns are ignored; empty tables give an empty one.
    """
    spark = docs.sparkSession
    kind, item_kind = type_of(docs, id_col), type_of(items, item_col)
    out = spark.createDataFrame([], f"{item_col} {item_kind}, rank int, {id_col} {kind}, score long")
    for part in _batches(items, item_col, item_text_col):
        texts = [search_terms(r["text"]) for r in part]
        number = {t: i for i, t in enumerate(sorted({t for ts in texts for t in ts}))}
        counted = count_terms(docs, number, id_col, text_col)
        model = weigh(counted, number, texts)
        wanted = spark.sparkContext.broadcast(model)                     # as long as the batch's items
        index = build_index(counted, wanted, len(number), block)
        beat = np.zeros(len(part), np.int64)
        for r in _ranked(search_index(index, wanted, k, None), k).filter(F.col("rank") == k).select("item", "score").collect():
            beat[r["item"]] = r["score"]                                 # a row per item of the batch
        found = _ranked(search_index(index, wanted, k, beat), k)
        named = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(part)], f"item int, name {item_kind}")
        out = out.unionAll(found.join(F.broadcast(named), "item")
                           .select(F.col("name").alias(item_col), "rank", F.col("id").alias(id_col), "score"))
    return out


#: The same ranking of ``documents`` for ``benchmark`` by definition.
ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
i AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark),
it AS (SELECT DISTINCT q, item_id, unnest(ts) AS t FROM i),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
p AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS t FROM d) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY t),
c AS (SELECT q, item_id, r, doc_id, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))) AS c
      FROM it JOIN p USING (t) JOIN w USING (t), s),
z AS (SELECT q, item_id, r, doc_id, CAST(sum(c) AS BIGINT) AS score FROM c GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM z WHERE score > 0) WHERE rank <= 10
"""
