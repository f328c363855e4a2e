"""Licence scans against plain searches."""

import re

import pytest

from parcelrisk.llm import licenses as L
from parcelrisk.llm.queries import QUERIES

from .conftest import ODD, SF
from .test_scores import low

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LINES = {"this work is licensed under the gnu general public license version 3": "gpl", "licensed under cc by nc 4 0": "cc-by-nc",
         "released under the mit license": "mit", "licensed under the apache license version 2 0": "apache"}


def brute_base(text):
    w = _WORD.findall(low(text))
    at = [(i, label) for i in range(len(w)) for p, label in L.PHRASES.items() if w[i:i + len(p.split())] == p.split()]
    return (len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at})))


def base_of(r):
    return (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])


def scan(spark, *texts, **how):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in sorted(L.scan_licenses(df, **how).collect(), key=lambda r: r["doc_id"])]


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op12_license_scans"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs) and any(r["n_base"] for r in rows)
    for r in rows:
        text = docs[r["doc_id"]]
        assert base_of(r) == brute_base(text)
        plain = " ".join(_WORD.findall(low(text)))
        want = {label for line, label in LINES.items() if re.search(rf"(^| ){line}( |$)", plain)} | set(filter(None, r["base_labels"].split(",")))
        assert set(filter(None, r["labels"].split(","))) == want
        assert (r["score"] >= L.SHARE) == bool(want) and 0 <= r["score"] <= 1


PERMISSION = next(t for _, t in L.TEMPLATES if "free of charge" in t)


def test_edited_notices_are_found(spark):
    words = PERMISSION.split()
    inserted = " ".join(w + (" really" if i in (9, 30, 50) else "") for i, w in enumerate(words))
    changed = " ".join("x" if i % 12 == 5 else w for i, w in enumerate(words))
    cut = " ".join(w for i, w in enumerate(words) if i % 14 != 3)
    half = " ".join(words[:len(words) // 2])
    other = "the " * 40 + "permission was not granted to any person who is free of this software"
    rows = scan(spark, "intro " * 50 + inserted + " outro " * 9, changed, cut, half, other, PERMISSION.upper().replace(" ", "\n"))
    assert [r["labels"] for r in rows] == ["mit", "mit", "mit", "", "", "mit"]
    assert all(r["base_labels"] == "" for r in rows) and rows[0]["score"] == 1.0 and rows[3]["score"] == 0.0


def test_insertions_tear_one_notice_over_neighbouring_diagonals(spark):
    words = PERMISSION.split()
    text = "a b c " + " ".join(w + (" really" if i in (9, 30, 50) else "") for i, w in enumerate(words)) + " d e f"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    known = [("mit", L.license_words(PERMISSION))]
    spans = L.candidate_spans(L._keyed(docs, "doc_id", "text"), known).collect()
    assert [(r["first"], r["last"]) for r in spans] == [(3, 6)]
    # votes are the template's k-grams that stand in the text, counted by hand
    own, there = known[0][1], L.license_words(text)
    there = {tuple(there[i:i + L.K]) for i in range(len(there))}
    assert spans[0]["votes"] == sum(tuple(own[i:i + L.K]) in there for i in range(len(own) - L.K + 1))


def test_notices_far_apart_are_spans_of_their_own(spark):
    text = "Released under the MIT License. " * 3 + "filler " * 30 + "Licensed under CC BY-NC 4.0."
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = sorted((r["label"], r["start"], r["stop"], r["share"]) for r in L.license_spans(df).collect())
    assert got == [("cc-by-nc", 45, 52, 1.0), ("mit", 0, 5, 1.0), ("mit", 5, 10, 1.0), ("mit", 10, 15, 1.0)]


def test_the_fuller_template_wins(spark):
    """CC BY stands within CC BY-NC but for one word; two notices apart keep both labels."""
    rows = scan(spark, "Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0.", "Licensed under CC BY 4.0. Then " + "x " * 20 + "Licensed under CC BY-SA 4.0.")
    assert [r["labels"] for r in rows] == ["cc-by-nc", "cc-by", "cc-by,cc-by-sa"]


def test_own_templates_and_phrases(spark):
    rows = scan(spark, "House rules apply to all of this text, always", "house rules", templates=[("house", "rules apply to all of this text")],
                phrases={"House  Rules": "rules"})
    assert [(r["labels"], r["base_labels"], r["n_base"]) for r in rows] == [("house,rules", "rules", 1), ("rules", "rules", 1)]


def test_odd(spark, odd, nothing):
    rows = L.scan_licenses(odd).collect()
    assert sorted(map(str, (base_of(r) for r in rows))) == sorted(str(brute_base(t)) for _, t in ODD)
    assert all(r["labels"] == "" and r["score"] == 0.0 for r in rows)
    assert L.scan_licenses(nothing).count() == 0
    same = [(None, "Released under the MIT License.", 1), (None, "Released under the MIT License.", 1), (5, None, 1), (5, "mit license", 1)]
    rows = L.scan_licenses(spark.createDataFrame(same, "doc_id long, text string, labels long")).collect()
    assert sorted((str(r["doc_id"]), r["labels"], r["n_spans"]) for r in rows) == [("5", "", 0), ("5", "mit", 0), ("None", "mit", 1), ("None", "mit", 1)]
