"""BPE and packing against the tokenizers library."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelrisk.llm.bpe import ByteBpe, bpe_round_trip
from parcelrisk.llm.packing import enumerate_patterns, fit_repeats, pack_documents, plan_sequences
from parcelrisk.llm.queries import QUERIES

from .conftest import ODD, SF

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(BYTE)


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(BYTE)


def expected(plain, text):
    ids = plain.encode(text or "", add_special_tokens=False).ids
    data = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(plain.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_query_against_library(spark, texts, plain):
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op5_bpe_round_trip"](spark, SF).collect()}
    assert got == {i: expected(plain, t) for i, t in texts.items()}


def test_odd_rows(odd, nothing, plain):
    got = sorted(tuple(r)[1:] for r in bpe_round_trip(odd, BYTE).collect())
    assert got == sorted(expected(plain, t) for _, t in ODD)
    assert bpe_round_trip(nothing, BYTE).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(list("ab' \n\té漢s1.<|>")), max_size=60), st.integers(2, 12))
def test_tree_of_any_text(text, leaf):
    bpe, plain = _tools()
    assert np.frombuffer(bpe.encode_batch([text], leaf)[0], "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


_held = []


def _tools():
    if not _held:
        _held.extend((ByteBpe(BYTE), Tokenizer.from_file(BYTE)))
    return _held


@pytest.mark.parametrize("leaf", [2, 3, 17, 256])
def test_unsplit_halves(bpe, plain, leaf):
    rng = random.Random(leaf)
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "ab", "éaü", "aA"):
        word = "".join(rng.choice(alphabet) for _ in range(900))
        pieces = [p for p, _ in plain.pre_tokenizer.pre_tokenize_str(word)]
        assert [t for p in pieces for t in bpe.encode_unsplit(p, leaf)] == plain.encode(word, add_special_tokens=False).ids
    assert np.frombuffer(bpe.encode_batch(["x" * 5000])[0], "<u4").tolist() == plain.encode("x" * 5000, add_special_tokens=False).ids


def check_packing(rows, texts, capacity):
    tok = Tokenizer.from_file(WORD)
    pieces = defaultdict(list)
    for i, t in texts:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), capacity):
            cut = ids[k:k + capacity]
            pieces[i].append((k // capacity, k, len(cut), zlib.crc32(cut.tobytes())))
    got = defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(x) for i, x in pieces.items()}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r["length"] for r in rows)


def test_packing_query(spark, texts):
    n, tokens = check_packing(QUERIES["op2_best_fit_packing"](spark, SF).collect(), texts.items(), 4096)
    assert n <= -(-tokens // 4096) * 1.02 + 1


def test_packing_odd(odd, nothing):
    check_packing(pack_documents(odd, WORD, 256).collect(), ODD, 256)
    assert pack_documents(nothing, WORD).count() == 0


def test_fit_uses_the_histogram():
    rng = np.random.default_rng(3)
    counts = np.zeros(257, np.int64)
    np.add.at(counts, rng.integers(1, 257, 40_000), 1)
    patterns = enumerate_patterns(counts)
    assert (patterns.sum(axis=1) == 256).all()
    x = fit_repeats(patterns, counts)
    assert (x >= 0).all()
    used = sum(np.bincount(patterns[:, j], x, 257) for j in range(3))
    assert np.abs(used - counts)[1:].sum() < 0.5 * counts.sum()
    plan = plan_sequences({i: int(c) for i, c in enumerate(counts) if c}, 256)
    n = int((plan["sequence"] + -(-(plan["hi"] - plan["lo"]) // plan["each"])).max())
    assert n <= 1.01 * (counts * np.arange(257)).sum() / 256 + 1
