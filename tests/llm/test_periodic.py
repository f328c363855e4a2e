"""Periodic runs against a brute force over all lags."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from parcelrisk.llm import periodic
from parcelrisk.llm.queries import QUERIES

from .conftest import ODD, SF

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w, shortest=12):
    """(start, length, period): every lag, every stretch along it."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(shortest, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def brute_row(doc, text):
    w = _WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    return (doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query(spark, texts):
    rows = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, SF).select(*COLUMNS).collect()}
    assert len(rows) == len(texts)
    short = {i: t for i, t in texts.items() if len(_WORD.findall(t or "")) <= 1500}
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i in short)
    for i, t in short.items():
        assert tuple(rows[i]) == brute_row(i, t)


def test_random_sequences():
    """Few words make runs within runs; several texts are searched at once and don't meet."""
    rng = random.Random(3)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 5)):
            n, words = rng.choice([0, 1, 5, 12, 40, 150]), rng.choice([1, 2, 2, 3, 40])
            t = [rng.randrange(words) for _ in range(n)]
            if n and rng.random() < 0.5:
                t = t[:n // 3] + t[:rng.randint(1, n)] * rng.randint(1, 4)
            texts.append(np.array(t, np.int64))
        for shortest in (4, 7, 12):
            owner, *rest = periodic.find_runs(texts, shortest)
            for i, t in enumerate(texts):
                got = [tuple(map(int, r)) for r in zip(*(x[owner == i] for x in rest), strict=True)]
                assert got == brute_runs(list(t), shortest)


def test_words_decide_when_hashes_collide(monkeypatch):
    """With hashes that are all equal the words don't bear out the stretches, and the search goes on with other hashes."""
    good, tried = periodic.SpanHash, []

    class Bad(good):
        def __init__(self, numbers, salt):
            super().__init__(numbers, salt)
            tried.append(salt)
            if salt == 0:
                self.prefix[:] = 0

    monkeypatch.setattr(periodic, "SpanHash", Bad)
    t = np.array([*range(30), *[1, 2, 3] * 6, *range(40, 60)])
    assert [tuple(map(int, r)) for r in zip(*periodic.find_runs([t]), strict=True)] == [(0, 30, 18, 3)]
    assert tried == [0, 1]


@pytest.mark.parametrize("n", [100_000])
def test_one_word_throughout_stays_cheap(n):
    """Pairs grow with the words, not with their square."""
    assert [int(x[0]) for x in periodic.find_runs([np.zeros(n, np.int64)])] == [0, 0, n, 1]


def test_operator_gives_runs_and_text(spark):
    df = spark.createDataFrame([(1, "x " + "a b c " * 5 + "y", 9)], "doc_id long, text string, runs long")
    r = periodic.periodic_runs(df).first()
    assert [tuple(x) for x in r["runs"]] == [(1, 15, 3)] and r["collapsed"] == "x a b c y" and r["n_words"] == 17


def test_odd(spark, odd, nothing):
    got = sorted((tuple(r) for r in periodic.runs_of_documents(odd).select(*COLUMNS).collect()), key=str)
    small = [(i, t) for i, t in ODD if len(t or "") < 10_000]
    want = [brute_row(i, t) for i, t in small]
    long = [r for r in got if r[0] == 7]
    assert sorted((r for r in got if r[0] != 7), key=str) == sorted(want, key=str)
    assert len(long) == 2 and long[0] == long[1] and long[0][1:6] == (1, 0, 30_000, 1, 30_000_000)
    assert periodic.runs_of_documents(nothing).count() == 0
