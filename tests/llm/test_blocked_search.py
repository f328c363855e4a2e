"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from parcelrisk.llm import blocked_search as B
from parcelrisk.llm.queries import ORACLE, QUERIES

from .conftest import ODD
from .test_scores import low

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k=10):
    """By the definition, every document for every item."""
    ts = [(i, Counter(_TERM.findall(low(t)))) for i, t in docs]
    ts = [(i, c) for i, c in ts if c]
    big_n, total = len(ts), sum(sum(c.values()) for _, c in ts)
    df = Counter(t for _, c in ts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in ts:
            m = 100 - 90 + (90 * sum(c.values()) * big_n) // total
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(_TERM.findall(low(text))) if t in c)
            if score > 0:
                scored.append((-score, i is not None, i, score))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, rank, i, s) for rank, (_, _, i, s) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    rows = got(QUERIES["op11_ranked_search"](spark, sf))
    assert rows == sorted(con.sql(ORACLE["op11_ranked_search"]).fetchall(), key=str)
    if sf.endswith("0.001"):
        docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(c, "text").collect()]
                       for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
        assert rows == brute(docs, items)


@pytest.mark.parametrize("block", [1, 3, 64])
def test_ties_copies_and_long_texts(spark, block, monkeypatch):
    """Many equal scores at the cut, one id's rows repeated, several segments."""
    monkeypatch.setattr(B, "SEGMENT_CELLS", 400)
    rng = random.Random(block)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(words, weights=range(40, 0, -1), k=rng.choice([1, 5, 30, 400])))) for i in range(150)]
    docs += [(1000 + i, docs[3][1]) for i in range(40)] + [docs[5]] * 3 + [(None, docs[3][1])]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 12])))) for i in range(20)] + [(100, docs[0][1]), (101, None), (102, "unknown")]
    df, it = frames(spark, docs, items)
    for k in (1, 10):
        assert got(B.ranked_search(df, it, k, block=block)) == brute(docs, items, k)


def segment(docs, items, block):
    texts = [B.search_terms(t) for t in items]
    number = {t: i for i, t in enumerate(sorted({t for ts in texts for t in ts}))}
    counts = [Counter(B.search_terms(t)) for t in docs]
    df = np.array([sum(t in c for c in counts) for t in number])
    order = np.lexsort((np.arange(len(df)), df))
    rank = np.argsort(order)
    n = len(docs)
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df[order]], np.int64)
    ranks = [np.unique(rank[[number[t] for t in set(x)]]) for x in texts]
    along = [sorted({u for r in ranks if t in r for u in r[r >= t].tolist()}) for t in range(len(df))]
    wanted = B.Wanted(number, rank, weights, ranks, [np.array(a, np.int64) for a in along], n, sum(sum(c.values()) for c in counts))
    own = [[(int(rank[number[t]]), c[t], sum(c.values())) for t in c if t in number] for c in counts]
    ends = np.cumsum([len(o) for o in own])
    terms, tf, length = (np.array([x[j] for o in own for x in o], np.int64) for j in range(3))
    values = wanted.contributions(length, tf)
    return B.Segment(list(range(n)), ends, terms, values, *B.block_lists(ends, terms, values, wanted, block), wanted), wanted


def test_bounds_hold_and_blocks_are_skipped():
    """In the list of a document's rarest term its block's bound is never below its score; most documents are never scored."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    topics = [rng.sample(words, 25) for _ in range(12)]
    docs = [" ".join(rng.choices(topics[i % 12], k=40) + rng.choices(words[:6], k=10)) for i in range(3000)]
    items = [" ".join(rng.sample(t, 8) + words[:6]) for t in topics]
    seg, wanted = segment(docs, items, 32)
    starts = np.concatenate([[0], seg.ends[:-1]])
    for item in wanted.items:
        scores = seg.forward[:, item].astype(np.int64) @ wanted.weights[item]
        rarest = np.where((seg.forward[:, item] > 0).any(axis=1), item[np.argmax(seg.forward[:, item] > 0, axis=1)], -1)
        bound, block = seg.bounds(item)
        assert (bound[:-1] >= bound[1:]).all()
        lists = np.searchsorted(seg.first, block, side="right") - 1
        held = set()
        for b, at, t in zip(bound.tolist(), block.tolist(), lists.tolist(), strict=True):
            members = seg.members[starts[at]:seg.ends[at]]
            mine = members[rarest[members] == t]
            assert (scores[mine] <= b).all()
            held.update(mine.tolist())
        assert held == set(np.flatnonzero(rarest >= 0).tolist())      # every document with a term is in some block
        docs_, best, read = seg.best(item, 10, 0)
        want = np.lexsort((np.arange(len(scores)), -scores))[:10]
        assert docs_.tolist() == want.tolist() and best.tolist() == scores[want].tolist()
        assert read < len(scores) / 2
        assert seg.best(item, 10, int(best[-1]))[0].tolist() == want.tolist()    # ties with the score to beat are kept
        assert seg.best(item, 10, int(best[0]) + 1)[0].tolist() == []


def test_blocks_hold_similar_documents():
    """Two topics that share a common word: its list is cut along the topics."""
    docs = ["the " + ("apple pear plum " if i % 2 else "iron zinc lead ") * 3 for i in range(64)]
    seg, wanted = segment(docs, ["the apple pear plum iron zinc lead"], 16)
    the = int(wanted.rank[wanted.number[b"the"]])
    sizes = np.diff(seg.ends, prepend=0)
    for b in range(seg.first[the], seg.first[the + 1]):
        members = seg.members[seg.ends[b] - sizes[b]:seg.ends[b]]
        assert len({int(x) % 2 for x in members}) == 1


def test_items_in_batches(spark, monkeypatch):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choices("abcdefgh", k=9))) for i in range(30)]
    items = [(i, " ".join(rng.choices("abcdefghij", k=4))) for i in range(25)] + [(3, "a b")]
    monkeypatch.setattr(B, "ITEM_BYTES", 60)
    assert got(B.ranked_search(*frames(spark, docs, items))) == brute(docs, items)


def test_odd(spark, odd, nothing):
    items = [(1, "long texts of ten WORDS"), (2, None), (3, ""), (None, "without an id 漢字"), (1, "long texts of ten WORDS")]
    it = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, doc_id int")
    assert got(B.ranked_search(odd, it)) == brute(ODD, items)
    assert B.ranked_search(nothing, it).count() == 0 and B.ranked_search(odd, it.limit(0)).count() == 0
    letters = odd.select(odd["doc_id"].cast("string").alias("doc_id"), "text")
    assert len(got(B.ranked_search(letters, it))) == len(brute(ODD, items))
