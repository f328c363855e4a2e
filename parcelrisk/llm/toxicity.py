"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two strings is the sum over their common subsequences of three characters, within a span of at
most five, of a decay factor to the power of both spans, normalised by each string's own weight. An insult with
a gap or an inserted character so keeps most of its likeness to the plain one. Landmarks are words and word
pairs that go with the label in the training sentences. A string's Nyström features are its kernel values with the
landmarks times the inverse root of the landmarks' own kernel matrix, and a linear machine with the hinge loss
is trained on them. As the kernel is a product of explicit subsequence weights, the trained machine is folded
back into one weight per subsequence, which makes scoring a table look-up per subsequence.

Sentences are labelled through their documents: all of a clean one are clean, at least one of a toxic one is
toxic. So the machine is trained on the landmarks that toxic documents hold, along with copies that have characters
inserted, against the strings of clean documents.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelrisk.llm.common import blocks, fold, map_rows, mix64, stored, text_or_empty, type_of

DECAY = 0.6
SPAN = 5                     # characters that a subsequence may extend over
SLOTS = 1 << 20              # subsequences are told apart by their hash
LANDMARKS = 200
EVIDENCE = 10.0              # log-likelihood ratio of a landmark at least; chance gives few strings as much
TRAIN_TEXTS = 5000           # labelled documents learnt from at most, half of each label; their whole texts
CLEAN_STRINGS = 40_000       # of clean documents, fitted at once; which ones, all of them decide
HARD_ROUNDS, NEWTON_STEPS, PENALTY = 2, 25, 1e-4
KNOWN_STRINGS = 200_000      # scores kept per worker
STRING_CHARS = 24            # longer words are scored by overlapping parts
BLOCK_CHARS = 500_000        # of texts that a worker splits into strings at once
_SENTENCE = re.compile(r"[.!?\n]+")
#: Places of the second and third character after the first, and the weight.
_SKIPS = [(j, k, DECAY ** (k + 1)) for k in range(2, SPAN) for j in range(1, k)]


def strings_of(text: str) -> list[str]:
    """Lower-case words without signs, and runs of single characters ("i d i o t") as one word, between edge marks."""
    out, run = [], []
    for w in text.lower().split():
        if not w.isalpha():
            w = "".join(filter(str.isalpha, w))
        if len(w) == 1:
            run.append(w)
            continue
        if len(run) > 2:
            out.append(f"^{''.join(run)}$")
        run = []
        if len(w) > 2:
            out.append(f"^{w}$")
    if len(run) > 2:
        out.append(f"^{''.join(run)}$")
    return out


def parts_of(word: str) -> list[str]:
    step = STRING_CHARS - SPAN
    return [word] if len(word) <= STRING_CHARS else [word[i:i + STRING_CHARS] for i in range(0, len(word) - SPAN, step)]


def subsequences(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, slot, weight) of all subsequences of the strings; weights are normalised by string."""
    codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lens = np.array([len(s) for s in strings], np.int64)
    owner = np.repeat(np.arange(len(strings)), lens)
    left = np.repeat(np.cumsum(lens), lens) - np.arange(len(codes))  # characters up to the string's end
    found = []
    for j, k, weight in _SKIPS:
        at = np.flatnonzero(left > k)
        key = codes[at] * np.uint64(0x9E3779B97F4A7C15) ^ codes[at + j] * np.uint64(0xC2B2AE3D27D4EB4F) ^ codes[at + k] << np.uint64(40)
        found.append((owner[at], (mix64(key) % np.uint64(SLOTS)).astype(np.int64), np.full(len(at), weight)))
    own, slot, weight = (np.concatenate(x) for x in zip(*found, strict=True))
    norm = np.sqrt(np.bincount(own, weight ** 2, len(strings)))
    return own, slot, weight / norm[own]


class StringKernelMachine:
    """A trained machine, folded into a weight per slot; ``steep`` and ``centre`` turn its value into a probability."""

    def __init__(self, weights: np.ndarray, bias: float):
        used = np.flatnonzero(weights)
        self.slots, self.values, self.bias = used.astype(np.int32), weights[used].astype(np.float32), bias
        self.steep, self.centre = 1.0, 0.0
        self._table: np.ndarray | None = None
        self._known: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_table": None, "_known": {}}

    def values_of(self, strings: list[str]) -> np.ndarray:
        """The machine's value of each string; of its parts the largest one."""
        if not strings:
            return np.empty(0)
        if self._table is None:
            self._table = np.zeros(SLOTS, np.float32)
            self._table[self.slots] = self.values
        parts = [parts_of(s) for s in strings]
        own, slot, weight = subsequences([p for ps in parts for p in ps])
        n = np.array([len(p) for p in parts])
        value = np.bincount(own, weight * self._table[slot], n.sum()) + self.bias
        return np.maximum.reduceat(value, np.cumsum(n) - n)

    def best_of_texts(self, texts: list[str]) -> np.ndarray:
        """The largest value of any string of each text; of a text without strings, the bias."""
        words = [strings_of(t) for t in texts]
        if len(self._known) > KNOWN_STRINGS:
            self._known.clear()
        new = [w for w in {w for ws in words for w in ws} if w not in self._known]
        for i in range(0, len(new), 4_000):
            some = new[i:i + 4_000]
            self._known.update(zip(some, self.values_of(some).tolist(), strict=True))
        get = self._known.__getitem__
        return np.array([max(map(get, ws), default=self.bias) for ws in words])

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(-self.steep * (self.best_of_texts(texts) - self.centre), -50, 50)))


def spread(bags: list[set[str]]) -> Counter:
    """For each string, in how many groups of documents it occurs; near copies mostly share their smallest hashes, and so a group."""
    groups: dict[tuple, set[str]] = {}
    for ws in bags:
        if ws:
            groups.setdefault(tuple(sorted(zlib.crc32(w.encode()) for w in ws)[:2]), set()).update(ws)
    return Counter(w for ws in groups.values() for w in ws)


def choose_landmarks(toxic: list[set[str]], clean: list[set[str]], evidence: float = EVIDENCE) -> list[str]:
    """The strings that occur more often in toxic documents than clean ones let expect, by their log-likelihood ratio."""
    n, m = spread(toxic), spread(clean)
    expected = {w: (m[w] + 1) * len(toxic) / max(1, len(clean)) for w in n}
    ratio = {w: n[w] * np.log(n[w] / e) - (n[w] - e) for w, e in expected.items() if n[w] > 2 * e}
    return sorted((w for w in ratio if ratio[w] > evidence), key=lambda w: (-ratio[w], w))[:LANDMARKS]


def explicit(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The used slots, and the strings' weights in them."""
    own, slot, weight = subsequences(strings)
    used, col = np.unique(slot, return_inverse=True)
    out = np.zeros((len(strings), len(used)))
    np.add.at(out, (own, col), weight)
    return used, out


def with_insertions(word: str, rng: np.random.Generator) -> list[str]:
    """Copies with a letter put in, and with one letter doubled."""
    i, j = (int(rng.integers(2, max(3, len(word) - 1))) for _ in range(2))
    return [word[:i] + str(rng.choice(list("aeiounrstlxz"))) + word[i:], word[:j] + word[j - 1] + word[j:]]


def fit_machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """The linear machine of least regularised squared hinge loss, by Newton steps on the rows within the margin."""
    x = np.column_stack([x, np.ones(len(x))])
    v = np.zeros(x.shape[1])
    ridge = PENALTY * np.eye(len(v))
    ridge[-1, -1] = 1e-8
    for _ in range(NEWTON_STEPS):
        active = y * (x @ v) < 1
        xa = x[active]
        new = np.linalg.solve(ridge + (xa * cost[active, None]).T @ xa, xa.T @ (cost[active] * y[active]))
        if np.allclose(new, v, atol=1e-9):
            break
        v = new
    return v


def bag_of(text: str) -> set[str]:
    return {p for s in _SENTENCE.split(text) for w in strings_of(s) for p in parts_of(w)}


def _crc(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


class LocalTexts:
    """What is learnt from (text, label) pairs at hand."""

    def __init__(self, pairs: list[tuple[str, int]]):
        self.pairs = pairs
        bags = {y: [bag_of(t) for t, label in pairs if label == y] for y in (0, 1)}
        self.toxic, self.clean = [ws for ws in bags[1] if ws], bags[0]
        self.counts = Counter(w for ws in self.clean for w in ws)
        self.every = sorted(self.counts, key=lambda w: (_crc(w), w))

    def landmarks(self) -> list[str]:
        return choose_landmarks(self.toxic, self.clean) if self.toxic and self.clean else []

    def witnesses(self, marked: list[str]) -> dict[str, int]:
        """In how many toxic documents each string is."""
        return Counter(w for ws in self.toxic for w in ws & set(marked))

    def clean_among(self, strings: list[str]) -> set[str]:
        return {w for w in strings if w in self.counts}

    def first_clean(self, n: int) -> list[tuple[str, int]]:
        """Some strings of clean documents, in how many each is."""
        return [(w, self.counts[w]) for w in self.every[:n]]

    def nearest_clean(self, model: StringKernelMachine, n: int) -> list[tuple[str, int]]:
        """Those of the largest values, of all strings."""
        value = np.concatenate([model.values_of(self.every[i:i + 10_000]) for i in range(0, len(self.every), 10_000)])
        return [(self.every[i], self.counts[self.every[i]]) for i in np.sort(np.argsort(-value, kind="stable")[:n])]

    def best_of_all(self, model: StringKernelMachine) -> tuple[np.ndarray, np.ndarray]:
        """The value of each document's whole text, and the labels."""
        return model.best_of_texts([t for t, _ in self.pairs]), np.array([label for _, label in self.pairs])


class SparkTexts:
    """The same from a frame (text, label): strings are counted over whole texts, and only a bounded number of them and one
    value of each document come to the driver."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

        def run(it: Iterator[tuple]) -> Iterator[dict]:
            for text, label in it:
                ws = sorted(bag_of(text)) or [None]     # a document without strings is counted too
                crcs = [_crc(w or "") for w in ws]
                small = sorted(crcs)[:2]
                for i in range(0, len(ws), 100_000):
                    some = ws[i:i + 100_000]
                    yield {"label": [label] * len(some), "near": [small[0] << 31 ^ small[-1]] * len(some), "w": some,
                           "crc": crcs[i:i + 100_000], "head": [i + k == 0 for k in range(len(some))]}

        strings = stored(map_rows(rows, run, "label int, near long, w string, crc long, head boolean"), "toxic-strings")
        toxic, clean = F.col("label") == 1, F.col("label") == 0
        sizes = strings.filter("head").agg(F.count(F.when(toxic & F.col("w").isNotNull(), 1)), F.count(F.when(clean, 1))).first()
        self.toxic, self.clean = (int(x) for x in sizes)
        near = strings.filter("w is not null").groupBy("w", "crc", "label", "near").agg(F.count("*").alias("c"))
        self.counts = stored(near.groupBy("w", "crc").agg(
            F.sum(F.when(toxic, F.col("c")).otherwise(0)).alias("in_toxic"), F.sum(F.when(clean, F.col("c")).otherwise(0)).alias("in_clean"),
            F.count(F.when(toxic, 1)).alias("n"), F.count(F.when(clean, 1)).alias("m")), "toxic-counts")

    def landmarks(self) -> list[str]:
        """As choose_landmarks has them."""
        e = (F.col("m") + 1) * self.toxic / max(1, self.clean)
        ratio = F.col("n") * F.log(F.col("n") / F.col("e")) - (F.col("n") - F.col("e"))
        found = self.counts.filter("n > 0").withColumn("e", e).filter("n > 2 * e").withColumn("ratio", ratio).filter(F.col("ratio") > EVIDENCE)
        return [r["w"] for r in found.orderBy(F.desc("ratio"), "w").limit(LANDMARKS).collect()] if self.toxic and self.clean else []

    def witnesses(self, marked: list[str]) -> dict[str, int]:
        return {r["w"]: r["in_toxic"] for r in self.counts.filter(F.col("w").isin(marked)).collect() if r["in_toxic"]}

    def clean_among(self, strings: list[str]) -> set[str]:
        return {r["w"] for r in self.counts.filter(F.col("w").isin(strings) & (F.col("in_clean") > 0)).collect()}

    def first_clean(self, n: int) -> list[tuple[str, int]]:
        return [(r["w"], r["in_clean"]) for r in self.counts.filter("in_clean > 0").orderBy("crc", "w").limit(n).collect()]

    def nearest_clean(self, model: StringKernelMachine, n: int) -> list[tuple[str, int]]:
        machine = self.rows.sparkSession.sparkContext.broadcast(model)

        def run(it: Iterator[tuple]) -> Iterator[dict]:
            for part in blocks(it, lambda r: 1, 10_000):
                w, crc, c = (list(x) for x in zip(*part, strict=True))
                yield {"w": w, "crc": crc, "c": c, "value": machine.value.values_of(w)}

        found = map_rows(self.counts.filter("in_clean > 0").select("w", "crc", "in_clean"), run, "w string, crc long, c long, value double")
        best = found.orderBy(F.desc("value"), "crc", "w").limit(n).collect()
        return [(r["w"], r["c"]) for r in sorted(best, key=lambda r: (r["crc"], r["w"]))]

    def best_of_all(self, model: StringKernelMachine) -> tuple[np.ndarray, np.ndarray]:
        machine = self.rows.sparkSession.sparkContext.broadcast(model)

        def run(it: Iterator[tuple]) -> Iterator[dict]:
            for part in blocks(it, lambda r: len(r[0]), BLOCK_CHARS):
                yield {"value": machine.value.best_of_texts([r[0] for r in part]), "label": [r[1] for r in part]}

        found = sorted((r["value"], r["label"]) for r in map_rows(self.rows, run, "value double, label int").collect())
        return np.array([v for v, _ in found]), np.array([y for _, y in found])


def train_toxicity(pairs: list[tuple[str, int]] | DataFrame, seed: int = 5) -> StringKernelMachine | None:
    """The machine for (text, label) pairs, or a frame of them; None unless both labels occur and some string goes with label 1."""
    rng = np.random.default_rng(seed)
    texts = SparkTexts(pairs) if isinstance(pairs, DataFrame) else LocalTexts(pairs)
    landmarks = texts.landmarks()
    if not landmarks:
        return None
    slots, phi = explicit(landmarks)
    table = np.full(SLOTS, -1)
    table[slots] = np.arange(len(slots))
    values, vectors = np.linalg.eigh(phi @ phi.T)
    root = vectors @ np.diag(np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0)) @ vectors.T

    def features(strings: list[str]) -> np.ndarray:
        """Nyström features: kernel values with the landmarks, whitened."""
        out = [np.empty((0, len(landmarks)))]
        for i in range(0, len(strings), 4000):
            some = strings[i:i + 4000]
            own, slot, weight = subsequences(some)
            col = table[slot]
            hit = col >= 0
            x = np.bincount(own[hit] * len(slots) + col[hit], weight[hit], len(some) * len(slots)).reshape(len(some), -1)
            out.append(x @ phi.T @ root)
        return np.concatenate(out)

    witnesses = texts.witnesses(landmarks)   # what makes its documents toxic
    inserted = {w: with_insertions(w, rng) for w in sorted(witnesses)}
    known = texts.clean_among([x for xs in inserted.values() for x in xs])
    strings, cost = [], []
    for w, n in sorted(witnesses.items()):
        for x, share in ((w, 1.0), *((x, 0.1) for x in inserted[w] if x not in known)):
            strings.append(x)
            cost.append(share * np.sqrt(n))
    positive = features(strings)

    def fitted(clean: list[tuple[str, int]]) -> StringKernelMachine:
        negatives, counts = [w for w, _ in clean], [c for _, c in clean]
        x = np.concatenate([positive, features(negatives)])
        y = np.concatenate([np.ones(len(strings)), -np.ones(len(negatives))])
        machine = fit_machine(x, y, np.concatenate([np.array(cost), 0.3 * np.sqrt(counts)]))
        weights = np.zeros(SLOTS)
        weights[slots] = phi.T @ (root @ machine[:-1])
        return StringKernelMachine(weights, float(machine[-1]))

    model = fitted(texts.first_clean(CLEAN_STRINGS))
    for _ in range(HARD_ROUNDS):  # then the clean strings that come nearest, of all of them
        model = fitted(texts.nearest_clean(model, CLEAN_STRINGS))
    _calibrate(model, *texts.best_of_all(model))
    return model


def _calibrate(model: StringKernelMachine, s: np.ndarray, labels: np.ndarray) -> None:
    """A logistic curve through the training documents' values; a clean document's share weighs five times a toxic one's."""
    model._known.clear()
    w = np.where(labels == 1, 1 / max(1, (labels == 1).sum()), 5 / max(1, (labels == 0).sum()))
    order = np.argsort(s, kind="stable")
    loss = w[labels == 0].sum() + np.cumsum(np.where(labels == 1, w, -w)[order])  # with the cut just above each value
    loss[:-1][s[order][:-1] == s[order][1:]] = np.inf
    at = int(np.argmin(loss))
    cut = (s[order][at] + s[order][min(at + 1, len(s) - 1)]) / 2
    model.steep = float(6 / max(np.median(np.abs(s - cut)), 1e-3))
    model.centre = float(cut - np.log(0.7 / 0.3) / model.steep)  # 0.7 at the best cut


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(text, label) of at most TRAIN_TEXTS labelled documents, chosen by a hash, with all of their text."""
    marks = labels.select(F.col(id_col), F.col(label_col).cast("int").alias("_y")).filter(F.col("_y").isin(0, 1)).distinct()
    counts = {r["_y"]: r["count"] for r in marks.groupBy("_y").count().collect()}
    if not counts:
        return docs.sparkSession.createDataFrame([], "text string, label int")
    share = F.element_at(F.create_map(*[F.lit(x) for y, n in counts.items() for x in (y, min(1.0, TRAIN_TEXTS / 2 / n))]), F.col("_y"))
    h = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_000))
    picked = marks.withColumn("_h", h).filter(F.col("_h") < share * 1_000_000).orderBy("_h", "_y", id_col).limit(2 * TRAIN_TEXTS)
    rows = docs.select(id_col, text_col).filter(F.col(text_col).isNotNull()).join(F.broadcast(picked), id_col)  # bounded by the limit
    return stored(rows.select(F.col(text_col).cast("string").alias("text"), F.col("_y").alias("label")), "toxic-texts")


def score_toxicity(docs: DataFrame, model: StringKernelMachine | None, id_col: str = "doc_id", text_col: str = "text",
                   carry: tuple[str, ...] = (), threshold: float = 0.7, with_text: bool = False) -> DataFrame:
    """Columns id, those to carry, score (0 to 1) and predicted (1 from ``threshold`` on) for every row; ``with_text`` adds
    the text as _text, so that it needn't be carried beside the one that is scored.

    Null and empty texts get the score of a text without strings, and are empty in _text. Without a model every score is 0. Repeated rows
    and equal texts get equal scores; an empty table gives an empty one.
    """
    machine = docs.sparkSession.sparkContext.broadcast(model)
    names = [id_col, *carry]
    schema = ", ".join(f"{c} {type_of(docs, c)}" for c in names) + ", score double, predicted int" + ", _text string" * with_text

    def run(rows: Iterator[tuple]) -> Iterator[dict]:
        for part in blocks(rows, lambda r: len(r[-1]), BLOCK_CHARS):
            text = {"_text": [r[-1] for r in part]} if with_text else {}
            out = text | dict(zip(names, map(list, zip(*(r[:-1] for r in part), strict=True)), strict=True))
            m = machine.value
            p = m.probabilities([r[-1] for r in part]) if m else np.zeros(len(part))
            yield out | {"score": p.tolist(), "predicted": (p >= threshold).astype(int).tolist()}

    return map_rows(docs.select(*names, text_or_empty(F.col(text_col)).alias("_text")), run, schema)


def toxicity_of_documents(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Scores for all ``documents``, learnt from the labels of those whose fold isn't ``held``."""
    rows = docs.select("doc_id", "text", (fold(F.col("doc_id"), folds) == held).alias("held_out"))
    known = labels.filter(fold(F.col("doc_id"), folds) != held)
    model = train_toxicity(labelled_texts(docs, known, "doc_id", "text", "toxic"))
    return score_toxicity(rows, model, carry=("held_out",))
