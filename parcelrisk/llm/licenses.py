"""Licence scans by diagonal voting.

Spark joins the hashes of all rolling k-grams of words of all texts to the places where the licence templates have
them. A hit votes for the diagonal text place minus template place. Votes are counted by text, template and diagonal;
neighbouring diagonals of a template, which insertions and deletions tear apart, are merged; and where enough of a
template's k-grams have voted, the words of the span are compared with the template's. Only texts with such a span
are read again. Counted places of fixed phrases give labels as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelrisk.llm.common import blocks, map_rows, mix64, stored, text_or_empty, type_of

K = 4                      # words of a k-gram; a template has at least as many
VOTES = 0.3                # of a template's k-grams, for its span to be read
SHARE = 0.8                # of a template's words, in order within the span, for its label
SLACK = 8                  # diagonals up to a template's words / SLACK apart are neighbours, and those 2 apart at least
BLOCK_CHARS = 2_000_000
BATCH = 200_000            # rows handed on at once
KNOWN_WORDS = 500_000      # a cache; cleared when full

#: Phrases whose places are counted, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: (label, text): notices and paragraphs that licences tell projects to use.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
     documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
     rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
     persons to whom the Software is furnished to do so, subject to the following conditions:"""),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
     compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""),
    ("apache", """Unless required by applicable law or agreed to in writing, software distributed under the License is
     distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the
     License for the specific language governing permissions and limitations under the License."""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
     Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
     later version."""),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
     General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your
     option) any later version."""),
    ("agpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
     General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
     option) any later version."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
     the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
     conditions and the following disclaimer."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
     granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
     not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
]

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def license_words(text: str) -> list[bytes]:
    """Words of letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_WORDS).split()


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


@lru_cache(maxsize=1)
def _hashes() -> WordHashes:
    return WordHashes()


def gram_hashes(words: list[bytes], k: int = K) -> np.ndarray:
    """A 64-bit hash of each rolling k-gram, by its place."""
    h = np.fromiter(map(_hashes().__getitem__, words), np.uint64, len(words))
    out = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for j in range(k if len(out) else 0):
        out = mix64(out ^ h[j:j + len(out)]) + np.uint64(j + 1)
    return out.view(np.int64)


def phrase_places(words: list[bytes], phrases: list[tuple[list[bytes], str]]) -> list[tuple[int, str]]:
    """(place, label) of all phrases, found by their last words."""
    out = []
    for last in {p[-1] for p, _ in phrases}:
        at = -1
        for _ in range(words.count(last)):
            at = words.index(last, at + 1)
            out += [(at - len(p) + 1, label) for p, label in phrases if at >= len(p) - 1 and words[at - len(p) + 1:at + 1] == p]
    return out


def matched_words(template: np.ndarray, span: np.ndarray) -> int:
    """The longest common subsequence of two sequences of numbers."""
    best = np.zeros(len(span) + 1, np.int64)
    for x in template:
        step = best.copy()
        step[1:] = np.maximum(best[1:], best[:-1] + (span == x))
        best = np.maximum.accumulate(step)
    return int(best[-1])


def verified(words: list[bytes], spans: list[dict], templates: list[tuple[str, list[bytes]]], share: float) -> list[tuple]:
    """(label, start, stop, share) of the spans that hold enough of their template's words. Of spans of different labels that
    share half of the shorter one's words, only those that hold the most words of a template stay."""
    found = []
    for s in spans:
        label, own = templates[s["template"]]
        lo, hi = max(0, s["first"]), min(len(words), s["last"] + len(own))
        number = {w: i for i, w in enumerate(own)}
        n = matched_words(np.array([number[w] for w in own]), np.array([number.get(w, -1) for w in words[lo:hi]], np.int64))
        if n >= share * len(own):
            found.append((n, n / len(own), label, lo, hi))
    found.sort(key=lambda f: (-f[0], -f[1], f[2:]))
    kept: list[tuple] = []
    for f in found:
        if not any(k[2] != f[2] and (k[0], k[1]) > (f[0], f[1])
                   and 2 * (min(k[4], f[4]) - max(k[3], f[3])) > min(k[4] - k[3], f[4] - f[3]) for k in kept):
            kept.append(f)
    return [(label, lo, hi, part) for _, part, label, lo, hi in kept]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, key); the key is one of the row's id and text."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("text"))
    return rows.withColumn("key", F.xxhash64("id", "text"))


def _grams(rows: DataFrame, k: int) -> DataFrame:
    """(key, place, hash) of all k-grams of all texts."""
    def run(it: Iterator[tuple]) -> Iterator[dict]:
        for part in blocks(it, lambda r: len(r[1]), BLOCK_CHARS):
            grams = [gram_hashes(license_words(t), k) for _, t in part]
            lens = np.array([len(g) for g in grams])
            keys, h = np.repeat(np.array([r[0] for r in part], np.int64), lens), np.concatenate(grams)
            place = np.arange(len(h)) - np.repeat(np.cumsum(lens) - lens, lens)
            for i in range(0, len(h), BATCH):
                yield {"key": keys[i:i + BATCH], "place": place[i:i + BATCH].astype(np.int32), "hash": h[i:i + BATCH]}

    return map_rows(rows.select("key", "text"), run, "key long, place int, hash long")


def candidate_spans(rows: DataFrame, templates: list[tuple[str, list[bytes]]], k: int = K, votes: float = VOTES) -> DataFrame:
    """(key, template, first, last, votes): merged diagonals that enough of a template's k-grams vote for."""
    spark = rows.sparkSession
    places = [(int(h), t, i, len(w)) for t, (_, w) in enumerate(templates) for i, h in enumerate(gram_hashes(w, k).tolist())]
    known = F.broadcast(spark.createDataFrame(places, "hash long, template int, at int, words int"))   # as long as the templates
    hits = (_grams(rows, k).join(known, "hash")
            .groupBy("key", "template", "words", (F.col("place") - F.col("at")).alias("diagonal"))
            .agg(F.collect_set("at").alias("ats")))                    # at most a template's places
    along = Window.partitionBy("key", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > F.greatest(F.lit(2), F.floor(F.col("words") / SLACK))
    merged = hits.withColumn("cluster", F.sum(F.when(apart, 1).otherwise(0)).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return (merged.select("key", "template", "words", "cluster", "diagonal", F.explode("ats").alias("at"))
            .groupBy("key", "template", "words", "cluster")
            .agg(F.min("diagonal").alias("first"), F.max("diagonal").alias("last"), F.size(F.collect_set("at")).alias("votes"))
            .filter(F.col("votes") >= votes * (F.col("words") - (k - 1)))
            .select("key", "template", "first", "last", "votes"))


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None,
                  k: int = K, votes: float = VOTES, share: float = SHARE) -> DataFrame:
    """Columns id, key, label, start, stop (words from 0) and share for every verified span, written down.

    A template of fewer than ``k`` words is never found. Null and empty texts have no spans; a repeated row has its
    spans as often as it occurs; rows without an id have theirs too; other columns are ignored; an empty table gives
    an empty one.
    """
    known = [(label, license_words(text)) for label, text in (TEMPLATES if templates is None else templates)]
    rows = _keyed(docs, id_col, text_col)
    spans = stored(candidate_spans(rows, known, k, votes).groupBy("key")
                   .agg(F.collect_list(F.struct("template", "first", "last")).alias("spans")), "license-spans")

    def run(it: Iterator[tuple]) -> Iterator[dict]:
        for part in blocks(it, lambda r: len(r[2]), BLOCK_CHARS):
            found = [(doc, key, *v) for doc, key, text, s in part for v in verified(license_words(text), s, known, share)]
            yield dict(zip(("id", "key", "label", "start", "stop", "share"), zip(*found, strict=True) if found else ([],) * 6, strict=True))

    read = rows.join(spans, "key").select("id", "key", "text", "spans")   # Spark weighs the written spans before it sends them about
    return stored(map_rows(read, run, f"id {type_of(rows, 'id')}, key long, label string, start long, stop long, share double"), "licenses")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None, **how) -> DataFrame:
    """Columns id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_spans, for every row.

    ``n_base`` counts the places of ``phrases``, ``first_word`` and ``last_word`` are the smallest and largest of
    them (null if there is none). ``labels`` has the labels of phrases and of verified spans, ``base_labels`` those of
    phrases; distinct, sorted and joined by commas. ``score`` is the largest share of a template's words in a verified
    span, 1 where a phrase stands, 0 where nothing was found. Null and empty texts have no words; repeated rows each
    have their result; other columns are ignored; an empty table gives an empty one.
    """
    wanted = [(license_words(p), label) for p, label in (PHRASES if phrases is None else phrases).items()]
    rows = _keyed(docs, id_col, text_col)

    def run(it: Iterator[tuple]) -> Iterator[dict]:
        for part in blocks(it, lambda r: len(r[2]), BLOCK_CHARS):
            words = [license_words(r[2]) for r in part]
            places = [phrase_places(w, wanted) for w in words]
            yield {"id": [r[0] for r in part], "key": [r[1] for r in part], "n_words": [len(w) for w in words],
                   "n_base": [len(p) for p in places], "first_word": [min(p)[0] if p else None for p in places],
                   "last_word": [max(p)[0] if p else None for p in places], "base": [sorted({x for _, x in p}) for p in places]}

    base = map_rows(rows.select("id", "key", "text"), run, f"id {type_of(rows, 'id')}, key long, n_words long, n_base long, "
                    "first_word long, last_word long, base array<string>")
    spans = (license_spans(docs, id_col, text_col, **how).distinct().groupBy(F.col("id").alias("of"), "key")
             .agg(F.collect_set("label").alias("found"), F.max("share").alias("share"), F.count("*").alias("n_spans")))  # labels are few
    out = base.join(spans, (base["key"] == spans["key"]) & base["id"].eqNullSafe(spans["of"]), "left")
    none = F.array().cast("array<string>")
    return out.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("found", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"))
