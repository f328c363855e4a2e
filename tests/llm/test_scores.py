"""Quality rules, toxicity, language, language model and page text against brute force or held-out labels."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from parcelrisk.llm import langid, lm_automaton, quality_llr, template_extract, toxicity
from parcelrisk.llm.lm_automaton import score_corpus
from parcelrisk.llm.queries import QUERIES
from parcelrisk.llm.template_extract import page_tokens

from .conftest import ODD, SF

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


# -- quality rules ------------------------------------------------------------------------------------------------

def brute_base(text):
    text = text or ""
    words = _WORD.findall(text)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= set(range(i, i + 8))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def brute_grams(text):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in _WORD.findall(text or "")]

    def chain(a, b):
        return xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))

    return [signed(x) % quality_llr.BUCKETS for x in (*h, *(chain(a, b) for a, b in zip(h, h[1:], strict=False)))]


def check_quality(rows, texts, trusted):
    raw, target = Counter(), Counter()
    grams = {}
    for i, t in texts:
        grams.setdefault(t, brute_grams(t))
        raw.update(grams[t])
        if i in trusted:
            target.update(grams[t])
    n, m, b = sum(raw.values()), sum(target.values()), quality_llr.BUCKETS
    want = Counter()
    for i, t in texts:
        base = brute_base(t)
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        g = grams[t]
        llr = sum(math.log((target[x] + 1) / (m + b)) - math.log((raw[x] + 1) / (n + b)) for x in g) / len(g) if g and m else 0.0
        want[(i, *base, failed, not failed and llr >= quality_llr.THRESHOLD, round(llr, 4))] += 1
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"],
                   r["kept"], round(r["llr"], 4)) for r in rows)
    near = [(a, b_) for a, b_ in zip(sorted(got.elements(), key=str), sorted(want.elements(), key=str), strict=True)]
    for a, b_ in near:
        assert a[:-1] == b_[:-1] and abs(a[-1] - b_[-1]) < 2e-4


def test_quality_query(spark, texts):
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    check_quality(QUERIES["op1_quality_rules"](spark, SF).collect(), list(texts.items()), {r["doc_id"] for r in labels if r["quality"] == 1})


def test_quality_odd(odd, nothing, spark):
    ids = spark.createDataFrame([(2,), (2,), (None,)], "doc_id long")
    rows = quality_llr.score_quality(odd, ids)
    assert {"lang", "score", "_text"} <= set(rows.columns)
    check_quality(rows.collect(), ODD, {2})
    check_quality(quality_llr.score_quality(odd, ids.limit(0)).collect(), ODD, set())
    assert quality_llr.score_quality(nothing, ids).count() == 0


def test_quality_tells_labels_apart(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op1_quality_rules"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert np.mean([r["kept"] or r["base_failed"] for r in rows if r["quality"] == 1]) > 0.97
    assert np.mean([r["kept"] for r in rows if r["quality"] == 0]) < 0.1


def test_quality_runs_no_python(spark):
    plan = QUERIES["op1_quality_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# -- toxicity -----------------------------------------------------------------------------------------------------

def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op3_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (fold(r["doc_id"], 3) == 1) for r in rows)
    assert np.mean([r["predicted"] for r in held if r["toxic"]]) > 0.8
    assert np.mean([r["predicted"] for r in held if not r["toxic"]]) < 0.04
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def kernel(a, b):
    """All common subsequences of three characters within the span, by definition."""
    def weights(s):
        out = Counter()
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, min(len(s), i + toxicity.SPAN)):
                    out[s[i], s[j], s[k]] += toxicity.DECAY ** (k - i + 1)
        return out
    x, y = weights(a), weights(b)
    return sum(x[f] * y[f] for f in x)


def test_kernel_by_definition():
    strings = ["^idiot$", "^idixot$", "^plain$", "^iidiiott$", "abc"]
    _, phi = toxicity.explicit(strings)
    norms = []
    for s in strings:
        norms.append(math.sqrt(sum(w * w for j, k, w in toxicity._SKIPS for _ in range(max(0, len(s) - k)))))
    for i, a in enumerate(strings):
        for j, b in enumerate(strings):
            assert math.isclose(phi[i] @ phi[j], kernel(a, b) / norms[i] / norms[j], abs_tol=1e-9)


def toy_pairs():
    rng = np.random.default_rng(0)
    syllables = ["mo", "la", "ti", "so", "ren", "vik", "dal", "im", "ast", "ko", "pe", "ru"]
    words = [a + b + c for a in syllables for b in syllables for c in syllables]
    out = []
    for k in range(400):
        text = [str(w) for w in rng.choice(words, 30)]
        if k % 2:
            text[int(rng.integers(30))] = str(rng.choice(["bluckhead", "nitgrub"]))
        out.append((" ".join(text) + ".", k % 2))
    return out


def test_gaps_and_insertions():
    model = toxicity.train_toxicity(toy_pairs())
    clean = float(model.probabilities(["morendal lavik sodalim"])[0])
    for text in ("a bluckhead here", "blu-ckhead", "b.l.u.c.k.h.e.a.d", "n i t g r u b", "nitgruub", "bluckxhead"):
        assert model.probabilities([text])[0] > max(0.5, clean), text
    assert clean < 0.3


def test_toxicity_odd(odd, nothing):
    model = toxicity.train_toxicity(toy_pairs())
    rows = toxicity.score_toxicity(odd, model).collect()
    assert len(rows) == len(ODD) and len({r["score"] for r in rows if r["doc_id"] in (0, 1, 4)}) == 1
    assert {r["score"] for r in toxicity.score_toxicity(odd, None).collect()} == {0.0}
    assert toxicity.score_toxicity(nothing, model).count() == 0
    assert toxicity.train_toxicity([]) is None and toxicity.train_toxicity([("a b", 0)]) is None


def test_toxicity_learns_from_whole_texts(spark):
    pairs = toy_pairs()
    filler = " ".join(t for t, y in pairs if not y)[:30_000]
    pairs += [(f"{filler} zorgle", 1) for _ in range(40)]      # evidence only at the end of a long text
    pairs += [(f"{filler} frabjin", 0) for _ in range(40)]
    docs = spark.createDataFrame([(i, f"{t} x{'abcdefgh'[i % 8]}{'klmnopqr'[i // 8 % 8]}{'stuvwxyz'[i // 64]}q") for i, (t, _) in enumerate(pairs)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(pairs)], "doc_id long, toxic int")
    texts = toxicity.labelled_texts(docs, labels, "doc_id", "text", "toxic")
    whole, kept = {r["text"] for r in docs.collect()}, texts.collect()
    assert {r["text"] for r in kept} <= whole and len(kept) == len(pairs)
    shared, local = toxicity.SparkTexts(texts), toxicity.LocalTexts([(r["text"], r["label"]) for r in kept])
    assert shared.landmarks() == local.landmarks() != []
    assert dict(shared.first_clean(10**6)) == local.counts and "^frabjin$" in local.counts
    model = toxicity.train_toxicity(texts)
    for mine, theirs in zip(shared.best_of_all(model), local.best_of_all(model), strict=True):
        assert np.allclose(np.sort(mine), np.sort(theirs))


# -- language -----------------------------------------------------------------------------------------------------

def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op4_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in rows)
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows if r["held_out"]]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_gradients():
    net = langid.ByteConvNet(["a", "b", "c"], seed=1)
    for p in ("embed", "filters", "bias", "out", "out_bias"):
        setattr(net, p, getattr(net, p).astype(np.float64))
    rng = np.random.default_rng(0)
    windows, labels = rng.integers(0, 256, (6, 24)), np.array([0, 1, 2, 0, 1, 2])

    def loss():
        return -net.log_probs(windows)[np.arange(6), labels].mean()

    for p, g in zip((net.embed, net.filters, net.bias, net.out, net.out_bias), net.gradients(windows, labels), strict=True):
        for at in np.argwhere(np.abs(g) > 1e-3)[:8]:
            at = tuple(at)
            p[at] += 1e-6
            up = loss()
            p[at] -= 2e-6
            down = loss()
            p[at] += 1e-6
            assert math.isclose((up - down) / 2e-6, g[at], rel_tol=1e-3, abs_tol=1e-5)


def test_windows_hold_all_bytes():
    data = bytes(range(256)) * 3 + b"END"
    w = langid.to_windows(data)
    assert w.shape == (4, langid.WINDOW) and w.tobytes().rstrip(b"\0") == data.lower()
    assert langid.to_windows(b"").shape == (1, langid.WINDOW)


def test_numeric_signs_are_no_letters(spark):
    """Halves, squares, Roman numerals and circled numbers are undetermined; one letter makes a language."""
    df = spark.createDataFrame([(0, "½ ②"), (1, "² Ⅷ _ 7"), (2, "½ a"), (3, "漢"), (4, "१२३")], "doc_id long, text string")
    rows = langid.identify_language(df, langid.ByteConvNet(["en", "fr"])).collect()
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == {0, 1, 4}


def test_language_learns_from_whole_texts(spark):
    """All windows of a training text, its end included, each of them whole."""
    text = "é" * 700 + "ende"
    docs = spark.createDataFrame([(1, text, "fr"), (2, "½", "fr"), (3, None, "fr"), (4, "ok", None)], "doc_id long, text string, lang string")
    (label, windows), = langid.training_windows(docs, "doc_id", "text", "lang")
    assert label == "fr" and windows.shape == (-(-len(text.encode()) // langid.WINDOW), langid.WINDOW)
    assert bytes(windows.ravel()).rstrip(b"\0") == text.encode()


def test_language_odd(odd, nothing):
    rows = langid.identify_language(odd, langid.ByteConvNet(["en", "fr"])).collect()
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == {0, 1, 4} and len(rows) == len(ODD)
    assert {r["lang_pred"] for r in langid.identify_language(odd, None).collect()} == {"und"}
    assert langid.identify_language(nothing, None).count() == 0 and langid.train_langid(nothing) is None


# -- language model -----------------------------------------------------------------------------------------------

def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_lm(texts, states, held=2, folds=7, discount=0.75):
    train = [[*_WORD.findall(low(t)), None] for i, t in texts if fold(i, folds) != held]
    c = Counter(w for ws in train for w in ws)
    n, v = sum(c.values()), len(c)

    def key(w):
        h = 1 if w is None else signed(xxhash.xxh64_intdigest(w.encode()))
        return h

    top = sorted(c, key=lambda w: (-c[w], key(w)))[:states]
    frequent = set(top)
    other, other_v = n - sum(c[w] for w in top), v - len(top)
    size = len(top) + 1
    cls = lambda w: w if w in frequent else "OTHER"
    root = {cls_: (x + 1) / (n + size) for cls_, x in [*((w, c[w]) for w in top), ("OTHER", other)]}
    pairs, seen, arcs = Counter(), Counter(), Counter()
    for ws in train:
        for a, b in zip(["START", *map(cls, ws)], map(cls, ws), strict=False):
            pairs[a, b] += 1
    for (a, _), x in pairs.items():
        seen[a] += x
        arcs[a] += 1
    out = []
    for i, t in texts:
        ws = [*_WORD.findall(low(t)), None]
        base = sum(math.log10((c[w] + 1) / (n + 1 * (v + 1))) for w in ws)
        score, state = 0.0, "START"
        for w in ws:
            b = cls(w)
            left = discount * arcs[state] / seen[state] if seen[state] else 1.0
            p = left * root[b] + (max(pairs[state, b] - discount, 0) / seen[state] if seen[state] else 0)
            score += math.log10(p) + (math.log10((c[w] + 1) / (other + other_v + 1)) if b == "OTHER" else 0)
            state = b
        out.append((i, fold(i, folds) == held, len(ws), sum(c[w] > 0 for w in ws), n, base, score))
    return out


def check_lm(rows, texts, states):
    want = sorted(brute_lm(texts, states), key=lambda r: (str(r[0]), r[-1]))
    got = sorted(map(tuple, rows), key=lambda r: (str(r[0]), r[-1]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want, strict=True):
        assert math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-5, abs_tol=1e-3)


def test_lm_query(spark, texts):
    rows = QUERIES["op9_lm_scoring"](spark, SF).collect()
    check_lm(rows, list(texts.items()), None)    # every training word is a state
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_base_formula(spark):
    """Written out from the contract: log10((c + 1) / (N + 1 * (V + 1))) over the words and one end."""
    train = [i for i in range(100) if fold(i, 7) != 2][:2]
    held = next(i for i in range(100) if fold(i, 7) == 2)
    rows = {r["doc_id"]: r for r in score_corpus(spark.createDataFrame(
        [(train[0], "a b a"), (train[1], "B c"), (held, "a z")], "doc_id long, text string")).collect()}
    # training tokens: a 2, b 2, c 1, end 2; N = 7, V = 4
    assert math.isclose(rows[held]["base_score"], math.log10(3 / 12) + math.log10(1 / 12) + math.log10(3 / 12))
    assert math.isclose(rows[train[0]]["base_score"], 2 * math.log10(3 / 12) + 2 * math.log10(3 / 12))
    assert rows[held]["train_tokens"] == 7 and rows[held]["n_known"] == 2


@pytest.mark.parametrize("states", [1, 3, 50])
def test_lm_odd(odd, nothing, states):
    check_lm(score_corpus(odd, states=states).collect(), ODD, states)
    assert score_corpus(nothing).count() == 0


def test_lm_without_training_rows(spark):
    i = next(i for i in range(100) if fold(i, 7) == 2)
    r = score_corpus(spark.createDataFrame([(i, "a b")], "doc_id long, text string")).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0)


@pytest.mark.parametrize("states", [None, 20])
def test_lm_counts_are_dealt_to_buckets(spark, texts, states, monkeypatch):
    """Several buckets, very frequent histories, small chunks and chunks counted in several goes give the same scores."""
    for name, value in (("BUCKET_BYTES", 100_000), ("CHUNK_BYTES", 50_000), ("HEAVY", 40), ("HELD_TOKENS", 3_000)):
        monkeypatch.setattr(lm_automaton, name, value)
    some = list(texts.items())[:150]
    docs = spark.createDataFrame(some, "doc_id long, text string").repartition(3)
    check_lm(score_corpus(docs, states=states).collect(), some, states)


def test_lm_pairs_are_dealt_in_few_bytes(spark, texts):
    """A pair takes little more than the eight bytes of its second word (32 as a row of its own), and its counts' way back two
    numbers without keys."""
    rows, _ = lm_automaton.with_chunks(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", "text", 7, 2)
    heavy = np.array([lm_automaton.START, lm_automaton.OTHER], np.int64)
    dealt = lm_automaton._dealt_pairs(rows, None, heavy, 2)
    parts = [tuple(len(x) for x in r) for r in dealt.select("a", "n", "b").collect()]
    pairs = sum(b for _, _, b in parts) / 8
    assert sum(map(sum, parts)) < 14 * pairs and len(parts) < pairs / 100
    back = lm_automaton._added_up(dealt, heavy).filter("chunk is not null").collect()
    assert sum(len(r["c"]) for r in back) == 8 * pairs and sum(len(r["arcs"]) for r in back) < 8 * pairs


def test_lm_states_grow_with_the_corpus(spark, texts, odd):
    every, few = (sum(r["score"] for r in QUERIES["op9_lm_scoring"](spark, SF).collect() if r["held_out"]),
                  sum(r["score"] for r in score_corpus(spark.read.parquet(f"{SF}/documents.parquet"), states=20).collect() if r["held_out"]))
    assert every > few
    check_lm(score_corpus(odd).collect(), ODD, None)


# -- pages --------------------------------------------------------------------------------------------------------

def brute_article(html):
    """For the generated pages: what stands between <article> and its end."""
    from html import unescape
    body = html.partition("<article>")[2].partition("</article>")[0]
    if html.count("</article>") == 0:
        body = re.sub(r"</?[a-zA-Z]*$", "", body)
    body = re.sub(r"</?b>", "", body)
    return " ".join(unescape(re.sub(r"<[^>]*>", " ", body)).split())


def test_pages_query(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op8_html_extraction"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["url"] == pages[r["page_id"]]["url"] and r["n_chars"] == len(r["text"])
        assert r["text"] == brute_article(pages[r["page_id"]]["html"])


PAGE = """<html><head><title>T</title><style>p {{}}</style></head><body><header>Site <a href=/>home</a></header>
<div class="cookie-notice">We use cookies</div><div id=menu><a href=a>One</a> <a href=b>Two</a></div>
<div class="content"><h2>Title {0}</h2><p>First &amp; {0} <b>bo</b>ld<p>Second {0}<br>line &copy; &lt;x&gt;
<div class="comments"><p>Reader {0} says</p></div></div><form><input name=q>Search</form><div class="sidebar">More {0}</div>
<script>var x = "<p>no</p>";</script><!-- <p>gone</p> --><footer>Foot {0}</footer></body></html>"""


def test_pages_without_article(spark):
    rows = [(i, f"http://h{i % 2}.example/{i}", PAGE.format(i)) for i in range(8)]
    for r in template_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        i = r["page_id"]
        assert r["text"] == f"Title {i} First & {i} bold Second {i} line © <x>"


def test_pages_odd(spark):
    rows = [(1, None, None, "x"), (2, "no url", "", "x"), (3, "http://a.b/", "<p>one", "x"), (3, "http://a.b/", "<p>one", "x"),
            (4, "http://a.b/2", "<article><p>two</p", "x"), (None, "http://a.b/3", "just text &am", "x"), (5, "http://c.d", "<div>" * 3000 + "deep", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in template_extract.extract_main_text(df).collect()), key=str)
    assert len(got) == 7 and (1, "", 0) in got and (2, "", 0) in got and (4, "two", 3) in got
    assert got.count((3, "one", 3)) == 2 and (None, "just text &am", 13) in got and (5, "deep", 4) in got
    assert template_extract.extract_main_text(df.limit(0)).count() == 0


def test_classes_share_vectors():
    names = ("key", "parent", "tag", "boiler", "depth", "vector", "pages", "n", "text", "linked")
    tokens = [(1, -1, "body", False, 0, 7, 10, 10, 0, 0), (2, 1, "article", False, 1, 7, 10, 10, 10, 0), (3, 1, "nav", True, 1, 7, 10, 10, 90, 90),
              (4, 2, "p", False, 2, 8, 10, 31, 900, 0), (5, 1, "div", False, 1, 9, 6, 6, 500, 0)]
    template = template_extract.deduce_template([dict(zip(names, t, strict=True)) for t in tokens], 10)
    assert template == {1: False, 2: True, 3: False, 5: False}


def test_constant_text_of_an_article_goes():
    page = "<body><article><p>Sign up for our letter<div>Part {0} has<br>our words</div><p>All rights reserved</p></article></body>"
    pages = [page.format(i) for i in range(10)]
    names = ("key", "parent", "tag", "boiler", "depth", "n", "text", "linked")
    counted = {}
    for html in pages:
        for token in page_tokens(html):
            t = counted.setdefault(token[0], dict(zip(names, (*token[:5], 0, 0, 0), strict=True)) | {"pages": 0})
            t["pages"] += 1
            for name, v in zip(names[5:], token[5:8], strict=True):
                t[name] += v
    tokens = [t | {"vector": t["pages"]} for t in counted.values() if t["pages"] >= 5]
    assert [template_extract.main_text(p, template_extract.deduce_template(tokens, 10)) for p in pages] == [f"Part {i} has our words" for i in range(10)]
    # without one order, the tokens are no template and the texts stay
    kept = template_extract.main_text(pages[3], template_extract.deduce_template(tokens, 10, {10}))
    assert kept == "Sign up for our letter Part 3 has our words All rights reserved"


def test_constant_text_and_order_over_hosts(spark):
    one, two = "<p class=x>Notice one</p>", "<div class=y>Notice two</div>"
    page = "<html><body><article>{1}<h1>Head {0}</h1>{2}<p>Words {0}</p></article></body></html>"
    rows = [(i, f"http://same.example/{i}", page.format(i, one, two)) for i in range(8)]
    rows += [(100 + i, f"http://mixed.example/{i}", page.format(i, *((one, two) if i % 2 else (two, one)))) for i in range(8)]
    rows += [(200, "http://again.example/", page.format(0, one, two))] * 8
    got = template_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got if r["page_id"] < 100} == {i: f"Head {i} Words {i}" for i in range(8)}
    for r in got:
        if r["page_id"] >= 100:
            assert "Notice one" in r["text"] and "Notice two" in r["text"]


@pytest.mark.parametrize(("html", "text"), [
    ("<article><p>One<svg width=1/>two</p><math/><p>three</p></article>", "One two three"),
    ("<article><p>One</p><div><select><option>no</div><p>two</p><form><select></select></form></article>", "One two"),
    ("<article><p>One</p><div><object>no</div><p>two</p></article>", "One two"),
    ("<article><div class='entry-content ad-free'>One</div><section class=legal>two</section><div class=comments>no</div></article>", "One two")])
def test_nothing_else_is_dropped(html, text):
    assert template_extract.main_text(html, {}) == text


def test_names_only_break_ties(spark):
    page = ("<html><body><div class=content><div class=post-header><h1>Head {0}</h1></div><p>Words {0} are many and long here</p>"
            "<div class=related><a href=x>Link to {0}</a></div></div></body></html>")
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(8)]
    got = template_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: f"Head {i} Words {i} are many and long here" for i in range(8)}
