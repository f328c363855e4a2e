"""Similarity join, repeated passages, components and fingerprints against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from parcelrisk.llm import jaccard_join
from parcelrisk.llm.components import connected_components
from parcelrisk.llm.fingerprints import PrefixHash, common_extension, edited_text, fingerprint_documents, likeness
from parcelrisk.llm.jaccard_join import Bands, jaccard_components, links, shingle_hashes, shingle_set
from parcelrisk.llm.queries import QUERIES
from parcelrisk.llm.substring_dedup import _sorted, remove_repeats, suffix_order, window_names

from .conftest import ODD, SF

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_sets(texts, n):
    out = {}
    for i, t in texts:
        w = _WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        k = min(n, len(w))
        out.setdefault(i, []).append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set())
    return out


def brute_components(texts, n=4, percent=85):
    sets = brute_sets(texts, n)
    top = {i: i for i in sets if i is not None}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in itertools.combinations(top, 2):
        for s, t in itertools.product(sets[a], sets[b]):
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {i: find(i) for i in top}, {(i, len(s)) for i, ss in sets.items() for s in ss}


def compare(df, texts, n=4, percent=85):
    rows = df.collect()
    found, sizes = brute_components(texts, n, percent)
    assert {(r["doc_id"], r["n_shingles"]) for r in rows} == sizes
    assert {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None} == found


def test_join_query(spark, texts):
    compare(QUERIES["op7_ngram_jaccard_join"](spark, SF), texts.items())


def near_copies(seed, size, count):
    """Copies with a few words changed, in chains, and unrelated texts of the same length."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, text = [], [rng.choice(vocabulary) for _ in range(size)]
    for _ in range(count):
        rows.append(" ".join(text))
        for _ in range(max(1, size // 40)):
            text = list(text)
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            text = [rng.choice(vocabulary) for _ in range(size)]
        if rng.random() < 0.3:
            text = text[:-1] if rng.random() < 0.5 else [*text, rng.choice(vocabulary)]
    return rows


@pytest.mark.parametrize("percent,n", [(85, 4), (80, 5)])
def test_join_of_near_copies(spark, percent, n):
    texts = [t for size in (3, 6, 9, 12, 20, 35, 60, 150, 400) for t in near_copies(size, size, 25)]
    random.Random(1).shuffle(texts)
    rows = list(enumerate(texts))
    compare(jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), n, percent), rows, n, percent)


def test_join_of_hot_passage(spark):
    """Many short texts share most of a passage, so that their signatures meet without their sets linking."""
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(30)]
    rows = [(i, " ".join([*passage, *(f"q{rng.randrange(10_000)}" for _ in range(rng.choice([2, 3, 5, 8])))])) for i in range(150)]
    compare(jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")), rows)


@pytest.mark.parametrize("crowd", [0, 1, 3])
def test_crowded_groups_lose_no_link(spark, crowd, monkeypatch):
    """Near copies in chains, around a passage that all share, all found by the second key."""
    monkeypatch.setattr(jaccard_join, "CROWD", crowd)
    monkeypatch.setattr(jaccard_join, "STAR_ROUNDS", 1 + crowd)
    rng = random.Random(crowd)
    texts = list(enumerate(near_copies(crowd, 90, 25) + near_copies(crowd + 9, 30, 20)))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [(i + 5000, passage + " " + " ".join(f"w{rng.randrange(40)}" for _ in range(rng.choice([3, 6, 9, 12, 40])))) for i in range(40)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    compare(jaccard_components(df, 3, 80), texts, 3, 80)


def test_a_shared_passage_makes_no_pairs(spark):
    """300 words that all documents share beside 80 of their own: none link, and the second key opens no pair."""
    passage = " ".join(f"p{i}" for i in range(300))
    for count in (50, 100):
        rows = [(i, passage + " " + " ".join(f"d{i}x{j}" for j in range(80))) for i in range(count)]
        texts = spark.createDataFrame(rows, "id long, text string")
        crowded = texts.select("id", texts["id"].alias("component"))
        assert jaccard_join.crowded_pairs(crowded, texts, 4, 85).count() == 0
    assert {r["component_id"] for r in jaccard_components(texts.withColumnRenamed("id", "doc_id")).collect()} == set(range(100))


def test_shared_sentences_make_few_pairs(spark, monkeypatch):
    """Around a passage, two of a dozen sentences: many sets have a second key in common, but hardly any that don't link
    become a pair; copies with a word changed at the end are found all the same."""
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(30))
    sentences = [" ".join(f"s{k}w{i}" for i in range(8)) for k in range(12)]
    rows = [(i, " ".join([passage, *rng.sample(sentences, 2), f"end{i}"])) for i in range(120)]
    rows += [(200 + i, rows[i][1] + f" {i}") for i in range(10)]
    texts = spark.createDataFrame(rows, "id long, text string")
    pairs = {(r["a"], r["b"]) for r in jaccard_join.crowded_pairs(texts.select("id", texts["id"].alias("component")), texts, 4, 85).collect()}
    sets = {i: shingle_set(t, 4) for i, t in rows}
    linked = {(a, b) for a in sets for b in sets if a < b and links(sets[a], sets[b], 85)}
    assert linked and linked <= pairs and len(pairs) < 2 * len(linked)
    monkeypatch.setattr(jaccard_join, "CROWD", 2)
    compare(jaccard_components(texts.withColumnRenamed("id", "doc_id")), rows)


def test_only_first_shingles_of_crowded_sets_become_rows(spark, monkeypatch):
    """Of sets in a crowd, no step writes a row for each shingle: only those that may be the first common one of a link."""
    written = {}

    def counting(df, name):
        out = stored(df, name)
        written[name] = max(written.get(name, 0), out.count())
        return out

    stored = jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", counting)
    rng = random.Random(6)
    texts = [(i, " ".join(rng.choice(["a", "b", "c", "d", "e", "f"]) for _ in range(300))) for i in range(60)]
    texts += [(100 + i, texts[i][1].replace("a b c", "a x c", 1)) for i in range(5)]
    sets = {i: shingle_set(t, 4) for i, t in texts}
    df = spark.createDataFrame([*texts, texts[0]], "id long, text string")
    pairs = {(r["a"], r["b"]) for r in jaccard_join.crowded_pairs(df.select("id", df["id"].alias("component")).distinct(), df, 4, 85).collect()}
    assert {(a, b) for a in sets for b in sets if a < b and links(sets[a], sets[b], 85)} <= pairs
    assert max(written.values()) <= 0.2 * sum(map(len, sets.values()))


def test_levels_follow_the_counts(spark, monkeypatch):
    """A shingle of more sets is of no lower level, one of a single set of level 0; parts of all tasks are added up."""
    monkeypatch.setattr(jaccard_join, "LEVEL_PARTS", 8)
    x = np.unique(np.random.default_rng(5).integers(0, 2 ** 63, 40, dtype=np.uint64))
    sets = spark.createDataFrame([(bytearray(x[:n].tobytes()),) for n in range(1, len(x) + 1)], "e binary").repartition(5)
    level = jaccard_join.shingle_levels(sets)[jaccard_join.slots_of(x)].astype(int)
    assert level[-1] == 0 and level[0] == int(8 * np.log2(len(x))) and (np.diff(level) <= 0).all()


def test_sketches_differ_by_no_more_than_the_sets():
    rng = np.random.default_rng(1)
    for size in (1, 5, 40, 700):
        x = np.unique(rng.integers(0, 2 ** 63, size, dtype=np.uint64) * np.uint64(2))
        y = np.unique(np.concatenate([x[size // 10:], rng.integers(0, 2 ** 63, size // 8, dtype=np.uint64)]))
        a, b = jaccard_join.sketches_of([x, y]).view(np.uint64)
        assert int(np.bitwise_count(a ^ b).sum()) <= len(np.setxor1d(x, y))
        assert not np.bitwise_count(a ^ jaccard_join.sketches_of([x[::-1]]).view(np.uint64)).any()


def test_a_stray_set_crowds_no_group(spark, monkeypatch):
    """Many copies in one component and a single set beside them have few pairs, and need no second key."""
    def fails(*_):
        raise AssertionError("no set is crowded")

    monkeypatch.setattr(jaccard_join, "CROWD", 4)
    monkeypatch.setattr(jaccard_join, "crowded_pairs", fails)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base, f"e{i}"])) for i in range(30)] + [(100, " ".join([*base[:50], *(f"z{i}" for i in range(8))]))]
    compare(jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_join_odd(odd, nothing):
    compare(jaccard_components(odd), ODD)
    assert jaccard_components(nothing).count() == 0


def test_signatures_of_linking_sets_meet():
    """Linking sets share as many signatures as the bands promise."""
    rng = random.Random(9)
    universe = np.unique(np.random.default_rng(2).integers(0, 2 ** 63, 5000, dtype=np.uint64))
    for percent in (80, 85):
        for listed in (10, 100_000_000):  # both kinds of index
            bands = Bands(percent, 1200).allocate(dict.fromkeys(range(1, 1200), listed))
            for size in (1, 2, 5, 7, 10, 13, 20, 40, 100, 300, 800):
                for _ in range(15):
                    a = rng.sample(list(universe), size)
                    drop = rng.randint(0, size * (100 - percent) // 100)
                    b = a[drop:] + rng.sample(list(universe), rng.randint(0, max(0, int(size * (100 - percent) / 100) - drop)))
                    x, y = (np.array(sorted(set(v)), np.uint64) for v in (a, b))
                    if not links(set(x.tolist()), set(y.tolist()), percent):
                        continue
                    number, sig = bands.signatures([x, y])
                    common = np.intersect1d(sig[number == 0], sig[number == 1])
                    by_band = np.bincount((common & np.uint64(255)).astype(int), minlength=len(bands.starts))
                    assert any(by_band[b] >= bands.needed(b, len(x) + len(y)) for b in np.flatnonzero(by_band))


def test_both_indexes_are_used():
    bands = Bands(85, 2000).allocate(dict.fromkeys(range(1, 2000), 1_000_000))
    assert bands.deletion.any() and not bands.deletion.all()


def test_shingle_hashes_tell_shingles_apart():
    for text in ("a b c d e", "a b", "", " A b\tC d a b c d a b c d"):
        assert len(shingle_hashes(text, 4)) == len(shingle_set(text, 4))
    assert shingle_hashes("A B", 4).tolist() == shingle_hashes("a b", 4).tolist()


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(64)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "long").collect()}
    top = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in range(400):
        for a, b in edges:
            if a != b:
                top[a] = top[b] = min(top[a], top[b])
    assert got == top


def test_small_limits_take_the_shuffle(spark, texts, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL_IDS", -1)
    compare(QUERIES["op7_ngram_jaccard_join"](spark, SF), texts.items())


def brute_removed(texts, length=50):
    first = {}
    data = [(i, (t or "").encode()) for i, t in texts]
    for i, d in data:
        if i is None:
            continue
        for j in range(len(d) - length + 1):
            w = d[j:j + length]
            if w not in first or i < first[w]:
                first[w] = i
    out = []
    for i, d in data:
        gone = np.zeros(len(d), bool)
        if i is not None:
            for j in range(len(d) - length + 1):
                if first[d[j:j + length]] < i:
                    gone[j:j + length] = True
        edge = np.concatenate([[False], gone])
        left = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((i, len(d), int(gone.sum()), int((~edge[:-1] & edge[1:]).sum()), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def test_repeats_query(spark, texts):
    got = QUERIES["op6_suffix_array_dedup"](spark, SF)
    assert sorted(map(tuple, got.collect()), key=str) == brute_removed(texts.items())


@pytest.mark.parametrize("length", [50, 20, 8])
def test_repeats_of_mixed_passages(spark, length):
    rng = random.Random(length)
    passages = ["".join(rng.choice("abc é") for _ in range(rng.randint(10, 160))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(passages)[rng.randrange(10):] + rng.choice("xyz") * rng.randint(0, 3) for _ in range(rng.randint(0, 6)))) for i in range(60)]
    rows += [(100 + i, "ab" * rng.randint(1, 200)) for i in range(6)] + [(5, rows[9][1]), (200, rows[3][1]), (201, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, remove_repeats(df, length).collect()), key=str) == brute_removed(rows, length)


def test_repeats_odd(odd, nothing):
    short = [(i, t[:3000] if t else t) for i, t in ODD]
    from pyspark.sql import functions as F
    df = odd.withColumn("text", F.substring("text", 1, 3000))
    assert sorted(map(tuple, remove_repeats(df).collect()), key=str) == brute_removed(short)
    kept = {r["doc_id"]: r["kept_text"] for r in remove_repeats(df, carry=("lang",), with_text=True).collect()}
    assert kept[0] is None and kept[1] == "" and kept[8] == ODD[9][1]
    assert remove_repeats(nothing).count() == 0


def test_suffix_order():
    rng = random.Random(1)
    for trial in range(200):
        n, length = rng.randint(1, 200), rng.choice([2, 3, 5, 7, 10, 20, 50])
        d = bytes(rng.choice(b"ab" if trial % 2 else b"abcdefgh") for _ in range(n))
        rank = suffix_order(np.frombuffer(d, np.uint8).astype(np.int64) + 1, length)
        prefixes = [d[i:i + length] for i in sorted(range(max(0, n - length + 1)), key=lambda i: rank[i])]
        assert prefixes == sorted(prefixes)


def test_keys_are_sorted_with_their_places():
    """Packed with the place or, where that is too long, as they are: equal keys come by place either way."""
    rng = np.random.default_rng(4)
    for top in (3, 1 << 40, 1 << 62):
        for n in (0, 1, 7, 5000):
            key = np.concatenate([rng.integers(0, top, n), rng.integers(0, 3, n)])
            order, ordered = _sorted(key)
            assert (order == np.argsort(key, kind="stable")).all() and (ordered == np.sort(key)).all()


def test_window_names_depend_on_the_window():
    d = np.random.default_rng(0).integers(97, 100, 400).astype(np.uint8)
    names = window_names(d, 50)
    assert [window_names(d[i:i + 50], 50)[0] for i in range(351)] == names.tolist()


def test_fingerprints_query(spark, texts):
    rows = {r["doc_id"]: r for r in QUERIES["op10_document_fingerprints"](spark, SF).collect()}
    ids = sorted(texts, reverse=True)
    assert sorted(rows) == sorted(texts)
    prints = {}
    for k, i in enumerate(ids):
        text, following = texts[i] or "", texts[ids[(k + 1) % len(ids)]] or ""
        edited = text[:len(text) - len(text) // 3] + following[:len(text) // 3]
        r = rows[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == PrefixHash(text).fingerprint() and r["edited_fingerprint"] == PrefixHash(edited).fingerprint()
        assert r["near_next"] == likeness(r["fingerprint"], rows[ids[(k + 1) % len(ids)]]["fingerprint"])
        assert r["common_next"] == next((j for j, (a, b) in enumerate(zip(text, following, strict=False)) if a != b), min(len(text), len(following)))
        assert prints.setdefault(r["fingerprint"], text) == text
        if len(text) > 600 and text != following:
            grams = [{x[j:j + 16] for j in range(len(x) - 15)} for x in (text, edited)]
            assert abs(r["near_edited"] - len(grams[0] & grams[1]) / len(grams[0] | grams[1])) < 0.25


def test_spans_and_extensions():
    a, b = PrefixHash("the same words, then others"), PrefixHash("x the same words, but no more")
    assert a.span(0, 16) == b.span(2, 16) and a.span(0, 18) != b.span(2, 18)
    assert common_extension(a, 0, b, 2) == 16
    assert common_extension(a, 4, a, 4) == a.n - 4 and common_extension(PrefixHash(""), 0, a, 0) == 0
    assert a.spans(5)[3] == a.span(3, 5)[0]


def test_fingerprints_odd(odd, nothing, spark):
    rows = fingerprint_documents(odd).collect()
    assert len(rows) == len(ODD) and {r["n_chars"] for r in rows if r["doc_id"] == 0} == {0}
    assert len({r["fingerprint"] for r in rows if r["n_chars"] == 0}) == 1
    assert next(r for r in rows if r["doc_id"] is None)["edited_sha256"] == hashlib.sha256(edited_text(ODD[6][1], ODD[10][1]).encode()).hexdigest()
    assert fingerprint_documents(nothing).count() == 0
    alone = fingerprint_documents(spark.createDataFrame([(3, "abcdef")], "doc_id long, text string")).first()
    assert alone["near_next"] == 1.0 and alone["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()
