"""Quality rules: counted signs of junk, then a log-likelihood ratio between trusted and raw text.

Words and word pairs are hashed into buckets. Two multinomials over the buckets are counted, one from the trusted
documents and one from all of them, and a document's mean log-ratio per n-gram decides, with a fixed threshold.
Everything is built from DataFrame functions; what a document needs is computed within its row, and the counts
are aggregated per task before they are shuffled. The driver sees one number per bucket.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelrisk.llm.common import text_or_empty

BUCKETS = 65_536
THRESHOLD = -0.1           # mean log-ratio per n-gram
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30    # of words in repeated windows
WINDOW = 8                 # words, a power of two
_SPACE = " \t\n\x0b\f\r"


def words(text: Column) -> Column:
    """Array of the words between ASCII white space."""
    trimmed = F.btrim(text, F.lit(_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t-\r]+"))


def _pairs(hashes: Column, gap: int) -> Column:
    """Hash of each element with the one ``gap`` places on."""
    n = F.greatest(F.size(hashes) - gap, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(1 + gap), n), lambda a, b: F.xxhash64(a, b))


def _ngrams(h1: str, h2: str) -> Column:
    """Buckets of all words and word pairs."""
    return F.transform(F.concat(h1, h2), lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))


def with_hashes(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds _text, _words and the hashes of words and pairs."""
    return (docs.withColumn("_text", text_or_empty(F.col(text_col)))
            .withColumn("_words", words(F.col("_text")))
            .withColumn("_h1", F.transform("_words", lambda w: F.xxhash64(w)))
            .withColumn("_h2", _pairs(F.col("_h1"), 1)))


def bucket_counts(docs: DataFrame, text_col: str) -> np.ndarray:
    """How often each bucket occurs in all texts; the driver gets BUCKETS rows at most."""
    counted = (with_hashes(docs.select(text_col), text_col).select(F.explode(_ngrams("_h1", "_h2")).alias("b"))
               .groupBy("b").count())
    out = np.zeros(BUCKETS)
    for r in counted.collect():
        out[r["b"]] = r["count"]
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Per bucket, with one added to each count; all 0 if there is no trusted text."""
    if not target.sum():
        return np.zeros(len(raw))
    return np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw)))


def _base(df: DataFrame) -> DataFrame:
    """Adds the counted signs to a frame from ``with_hashes``."""
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    df = (df.withColumn("n_words", F.size("_words").cast("long"))
          .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
          .withColumn("n_symbols", F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long"))
          .withColumn("_lines", lines)
          .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
          .withColumn("_h4", _pairs(F.col("_h2"), 2))
          .withColumn("_h8", _pairs(F.col("_h4"), 4)))
    # places of windows that occur again: sorted by hash, neighbours of equal hash
    placed = F.sort_array(F.transform("_h8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn("_sorted", F.when(F.size(F.array_distinct("_h8")) < F.size("_h8"), placed).otherwise(none))
    n = F.greatest(F.size("_sorted") - 1, F.lit(0))
    same = F.zip_with(F.slice("_sorted", F.lit(1), n), F.slice("_sorted", F.lit(2), n),
                      lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    df = df.withColumn("_at", F.sort_array(F.array_distinct(F.flatten(same))))
    steps = F.zip_with("_at", F.slice("_at", F.lit(2), F.greatest(F.size("_at") - 1, F.lit(0))),
                       lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    return df.withColumn("n_repeat_words", F.aggregate(steps, F.lit(0), lambda acc, x: acc + x).cast("long"))


def score_quality(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept.

    ``trusted_ids`` names the trusted documents by their ids. Null text has no words and so fails; a text without
    n-grams has ratio 0; without trusted documents every ratio is 0 and the counted signs decide. Repeated rows
    count as often as they occur; a column of ``docs`` named like one of the results is replaced; an empty table
    gives an empty one.
    """
    ids = trusted_ids.select(id_col).filter(F.col(id_col).isNotNull()).distinct().hint("merge")  # ids grow with the data
    raw = bucket_counts(docs, text_col)
    target = bucket_counts(docs.select(id_col, text_col).join(ids, id_col, "left_semi"), text_col)
    table = ",".join(f"{x:.6f}" for x in log_ratios(target, raw))
    ratios = F.split(F.lit(table), ",").cast("array<double>")  # BUCKETS numbers, whatever the input's size

    results = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"]
    own = [c for c in docs.columns if c not in results]
    df = _base(with_hashes(docs.select(*own), text_col)).withColumn("_grams", _ngrams("_h1", "_h2"))
    total = F.aggregate("_grams", F.lit(0.0), lambda acc, b: acc + ratios[b])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (df.withColumn("llr", F.when(F.size("_grams") > 0, total / F.size("_grams")).otherwise(F.lit(0.0)))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
            .select(*own, *results))


def quality_of_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rules over ``documents``, trusting those that ``labels`` marks as good."""
    return score_quality(docs, labels.filter(F.col("quality") == 1)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")
