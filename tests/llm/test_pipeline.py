"""Each stage of the pipeline on what the one before it kept, against brute force."""

from collections import Counter

import corpus_pipeline as CP
import pytest

from parcelrisk.llm import quality_llr, toxicity

from .conftest import SF
from .test_join_dedup import brute_components, brute_removed
from .test_scores import brute_base, check_quality
from .test_tokens import check_packing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(CP.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_names_and_columns(stages):
    assert [n for n, _ in CP.STAGES] == ["toxicity", "quality rules", "n-gram jaccard join", "suffix-array dedup", "best-fit packing"]
    assert all(df.columns == COLUMNS for df in stages[:-1])


def test_toxic_documents_go(spark, stages):
    model = toxicity.train_toxicity(toxicity.labelled_texts(stages[0], spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "text", "toxic"))
    want = Counter(tuple(r) for r in stages[0].collect() if model is None or model.probabilities([r["text"] or ""])[0] < 0.7)
    assert rows(stages[1]) == want


def test_scored_rows_are_written_before_the_filter(spark):
    """Texts go to Python in the small batches of what is written in between, not in those of the stage's own write."""
    kept = CP.drop_toxic(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    assert "MapInArrow" not in kept._jdf.queryExecution().executedPlan().toString()


def test_poor_documents_go(spark, stages):
    before, kept = stages[1].collect(), {r["doc_id"] for r in stages[2].collect()}
    trusted = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r["quality"] == 1}
    scored = quality_llr.score_quality(stages[1], spark.createDataFrame([(i,) for i in trusted], "doc_id long")).collect()
    check_quality(scored, [(r["doc_id"], r["text"]) for r in before], trusted)
    assert kept == {r["doc_id"] for r in scored if r["kept"]}
    assert all(brute_base(r["text"])[0] >= 20 for r in stages[2].collect())
    assert rows(stages[2]) == Counter(tuple(r) for r in before if r["doc_id"] in kept)


def test_one_of_each_group_stays(stages):
    texts = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    found, _ = brute_components(texts, CP.NEAR_WORDS, CP.NEAR_PERCENT)
    assert rows(stages[3]) == Counter(tuple(r) for r in stages[2].collect() if found[r["doc_id"]] == r["doc_id"])


def test_repeats_are_cut(stages):
    import hashlib
    texts = [(r["doc_id"], r["text"]) for r in stages[3].collect()]
    want = {r[0]: r for r in brute_removed(texts)}
    for r in stages[4].collect():
        if r["text"].isascii():
            assert hashlib.sha256(r["text"].encode()).hexdigest() == want[r["doc_id"]][4]
        assert r["n_chars"] == len(r["text"])
    assert len(want) == stages[4].count()


def test_all_is_packed(stages):
    check_packing(stages[5].collect(), [(r["doc_id"], r["text"]) for r in stages[4].collect()], 4096)


def one_each(spark, rows):
    df = spark.createDataFrame([(i, t, lang, "s", 1) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return sorted(((r["doc_id"], r["text"], r["lang"]) for r in CP.one_of_each_group(spark, df, SF).collect()), key=str)


def test_an_id_with_two_texts_loses_neither(spark):
    a, b, c = ("a b c d e f g h", "one two three four five six", "p q r s t u v")
    assert one_each(spark, [(1, a, "x"), (1, b, "x"), (2, c, "x"), (3, c, "x")]) == sorted([(1, a, "x"), (1, b, "x"), (2, c, "x")], key=str)
    # a text of such an id that another document has too goes as that one's copy
    got = one_each(spark, [(5, a, "x"), (5, b, "x"), (7, a, "x"), (7, b, "y")])
    assert sorted(t for _, t, _ in got) == sorted([a, b])
    assert one_each(spark, [(4, a, "z"), (4, a, "y"), (4, a, "z")]) == [(4, a, "y")]


def test_the_quality_stage_keeps_its_plan_small(spark, stages):
    plan = CP.drop_poor(spark, stages[1], SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000


def test_stages_on_odd_rows(spark, odd, tmp_path):
    """Nulls, empty, long and repeated rows, stage by stage."""
    docs, counts = odd.select(*COLUMNS), []
    for i, (_, stage) in enumerate(CP.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        counts.append(docs.count())
    assert counts == [11, 0, 0, 0, 0]     # nothing toxic; all are too short, or repeat one word
    nothing_poor = odd.select(*COLUMNS)
    found = sorted((r["doc_id"] for r in CP.one_of_each_group(spark, nothing_poor, SF).collect()), key=str)
    assert found == sorted([0, 1, 2, 4, 5, None, 7, 8, 9], key=str)       # 3 is a copy of 2, and 7 comes twice
    cut = CP.cut_repeats(spark, nothing_poor, SF).collect()
    assert len(cut) == 11 and all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in cut)
    packed = CP.pack(spark, nothing_poor, SF).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(r["doc_id"] for r in nothing_poor.collect())
    empty = odd.select(*COLUMNS).limit(0)
    for _, stage in CP.STAGES:
        assert stage(spark, empty, SF).count() == 0
