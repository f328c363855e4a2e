"""Language identification by a small byte convolutional network, trained in numpy.

A window of bytes is embedded, convolved with filters of several widths, pooled by the maximum over the window
and classified by a softmax. A text is cut into windows of a fixed length, all of them are scored in batches,
and their log-probabilities are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelrisk.llm.common import blocks, fold, map_rows, text_or_empty, type_of

WINDOW = 256                 # bytes
WIDTHS = (2, 3, 4, 5)        # bytes that a filter sees
FILTERS = 10                 # of each width
EMBED = 8
TRAIN_TEXTS = 1500           # training documents of a language at most; all windows of their whole texts are learnt from
STEPS, BATCH, RATE = 900, 64, 4e-3
BLOCK_WINDOWS = 512          # scored at once
_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[65:91] += 32


class ByteConvNet:
    """Parameters and the forward and backward passes."""

    def __init__(self, classes: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = classes
        k, n = max(WIDTHS), len(WIDTHS) * FILTERS
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.mask = np.zeros((k * EMBED, n), np.float32)  # a filter of width w sees the first w bytes
        for i, w in enumerate(WIDTHS):
            self.mask[:w * EMBED, i * FILTERS:(i + 1) * FILTERS] = 1
        self.filters = (rng.normal(0, 0.3, self.mask.shape) * self.mask).astype(np.float32)
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.1, (n, len(classes))).astype(np.float32)
        self.out_bias = np.zeros(len(classes), np.float32)

    def _pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, length = windows.shape
        k = max(WIDTHS)
        x = self.embed[windows]                                             # n, length, EMBED
        views = np.lib.stride_tricks.sliding_window_view(x.reshape(n, -1), k * EMBED, axis=1)[:, ::EMBED]
        cols = np.ascontiguousarray(views).reshape(-1, k * EMBED)
        conv = (cols @ self.filters).reshape(n, length - k + 1, -1)
        return cols, conv, conv.max(axis=1)

    def log_probs(self, windows: np.ndarray) -> np.ndarray:
        logits = np.maximum(self._pooled(windows)[2] + self.bias, 0) @ self.out + self.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        n, length = windows.shape
        k = max(WIDTHS)
        cols, conv, pooled = self._pooled(windows)
        hidden = np.maximum(pooled + self.bias, 0)
        logits = hidden @ self.out + self.out_bias
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        d = e / e.sum(axis=1, keepdims=True)
        d[np.arange(n), labels] -= 1
        d /= n
        d_hidden = (d @ self.out.T) * (hidden > 0)
        best = conv.argmax(axis=1)                                          # n, filters
        rows = np.arange(n)[:, None] * (length - k + 1) + best
        seen = cols[rows]                                                   # n, filters, k * EMBED
        d_filters = np.einsum("nf,nfc->cf", d_hidden, seen) * self.mask
        d_cols = d_hidden[:, :, None] * self.filters.T[None]                # n, filters, k * EMBED
        d_embed = np.zeros_like(self.embed)
        for j in range(k):
            np.add.at(d_embed, windows[np.arange(n)[:, None], best + j], d_cols[:, :, j * EMBED:(j + 1) * EMBED])
        return [d_embed, d_filters, d_hidden.sum(axis=0), hidden.T @ d, d.sum(axis=0)]

    def train(self, windows: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = 11) -> ByteConvNet:
        """Adam on batches that hold all classes equally."""
        rng = np.random.default_rng(seed)
        params = [self.embed, self.filters, self.bias, self.out, self.out_bias]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        members = [np.flatnonzero(labels == c) for c in range(len(self.classes))]
        for t in range(1, steps + 1):
            pick = np.array([rng.choice(members[c]) for c in rng.integers(0, len(members), BATCH)])
            rate = RATE * (1 - 0.9 * t / steps)
            for p, g, a, b in zip(params, self.gradients(windows[pick], labels[pick]), m, v, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= (rate * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
        return self

    def predict_texts(self, texts: list[str]) -> list[tuple[str, float]]:
        """The likeliest class of each whole text and its probability."""
        held: list[np.ndarray] = []
        spans = [0]
        for t in texts:
            w = to_windows(t.encode("utf-8", "surrogatepass"))
            held.append(w)
            spans.append(spans[-1] + len(w))
        windows = np.concatenate(held)
        scores = np.concatenate([self.log_probs(windows[i:i + BLOCK_WINDOWS]) for i in range(0, len(windows), BLOCK_WINDOWS)])
        mean = np.add.reduceat(scores, spans[:-1], axis=0) / np.diff(spans)[:, None]
        p = np.exp(mean - mean.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        return [(self.classes[c], float(p[i, c])) for i, c in enumerate(best)]


def to_windows(data: bytes) -> np.ndarray:
    """All of ``data`` in rows of a fixed length, the last one filled up by bytes 0; an empty text is one row of 0."""
    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[:len(data)] = _UPPER[np.frombuffer(data, np.uint8)]
    return out.reshape(n, WINDOW)


def has_letter(text: str) -> bool:
    """Whether any character is a letter; numeric signs such as a half or a Roman numeral's are none."""
    return any(map(str.isalpha, text))


def training_windows(docs: DataFrame, id_col: str, text_col: str, label_col: str) -> list[tuple[str, np.ndarray]]:
    """(label, windows of the whole text) of at most TRAIN_TEXTS documents of each label, chosen by a hash. They are cut in tasks."""
    h = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1_000_000))
    rows = (docs.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text"), h.alias("h")))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not counts:
        return []
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, TRAIN_TEXTS / n))]), F.col("label"))
    picked = rows.filter(F.col("h") < share * 1_000_000).orderBy("h", "label", "text").limit(2 * TRAIN_TEXTS * len(counts))

    def run(it: Iterator[tuple]) -> Iterator[dict]:
        for part in blocks(it, lambda r: len(r[1]), 1_000_000):
            kept = [(y, to_windows(t.encode("utf-8", "surrogatepass")).tobytes()) for y, t in part if has_letter(t)]
            yield {"label": [y for y, _ in kept], "windows": [w for _, w in kept]}

    found = map_rows(picked.select("label", "text"), run, "label string, windows binary").collect()
    return [(r["label"], np.frombuffer(r["windows"], np.uint8).reshape(-1, WINDOW)) for r in found]


def train_langid(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> ByteConvNet | None:
    """A network for the labels of ``docs``; None if no row has a label and a letter."""
    pairs = training_windows(docs, id_col, text_col, label_col)
    if not pairs:
        return None
    classes = sorted({y for y, _ in pairs})
    labels = np.repeat([classes.index(y) for y, _ in pairs], [len(w) for _, w in pairs])
    return ByteConvNet(classes).train(np.concatenate([w for _, w in pairs]), labels)


def identify_language(docs: DataFrame, net: ByteConvNet | None, id_col: str = "doc_id", text_col: str = "text",
                      carry: tuple[str, ...] = ()) -> DataFrame:
    """Columns id, those to carry, lang_pred and score (0 to 1) for every row.

    ``und`` with score 0 if the text is null or has no letter, or if there was nothing to learn from. Repeated rows
    and equal texts get equal results; an empty table gives an empty one; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(net)
    names = [id_col, *carry]
    schema = ", ".join(f"{c} {type_of(docs, c)}" for c in names) + ", lang_pred string, score double"

    def run(rows: Iterator[tuple]) -> Iterator[dict]:
        for part in blocks(rows, lambda r: len(r[-1]), 1_000_000):
            out = dict(zip(names, map(list, zip(*(r[:-1] for r in part), strict=True)), strict=True))
            found: list[tuple[str, float]] = [("und", 0.0)] * len(part)
            lettered = [i for i, r in enumerate(part) if has_letter(r[-1])]
            if lettered and model.value:
                for i, x in zip(lettered, model.value.predict_texts([part[i][-1] for i in lettered]), strict=True):
                    found[i] = x
            yield out | {"lang_pred": [x for x, _ in found], "score": [s for _, s in found]}

    return map_rows(docs.select(*names, text_or_empty(F.col(text_col)).alias("_text")), run, schema)


def language_of_documents(docs: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """Predictions for all ``documents``, learnt from those whose fold isn't ``held``."""
    rows = docs.select("doc_id", "text", "lang", (fold(F.col("doc_id"), folds) == held).alias("held_out"))
    net = train_langid(rows.filter(~F.col("held_out")))
    return identify_language(rows, net, carry=("held_out",))
