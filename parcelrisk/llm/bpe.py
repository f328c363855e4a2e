"""BPE encoding by tree concatenation.

A text is cut in halves until the pieces are short, the pieces are encoded side by side, and neighbours are
joined bottom-up: around each join a growing window is encoded again until its tokens agree with the left
side's tokens at its start and the right side's at its end. Two facts make the result exact:

* A single space between two characters that aren't white space always starts a new pre-token, so no merge
  crosses it. Halves are cut there if there is such a place, and the window of such a join is the word on
  either side.
* A long pre-token has no such place. Its halves are cut anywhere. A sequence of BPE tokens is the encoding
  of its string if and only if each pair of neighbours encodes to itself, so once the window's first token is
  one of the left side's and its last one of the right side's, at the same places, all pairs of the joined
  sequence are known to be good.

Words are encoded once per worker and kept in a bounded table, because a corpus repeats them.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelrisk.llm.common import blocks, map_rows, text_or_empty, type_of

_TWO_SPACES = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?= \S)")
LEAF_CHARS = 65_536       # longer texts are halved at a safe space
UNSPLIT_CHARS = 256       # longer pre-tokens are halved anywhere
KNOWN_WORDS = 300_000     # words kept per worker
BLOCK_CHARS = 1_000_000   # text encoded at once


def byte_stand_ins() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """A byte-level BPE vocabulary file with exact joins."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks take the cores
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        chars = byte_stand_ins()
        added = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.added = list(added)
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in self.tok.get_vocab(with_added_tokens=True).items():
            self.bytes_of[i] = token.encode() if token in added else bytes(chars[c] for c in token)
        self.first: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}

    # -- one pre-token ----------------------------------------------------------------------------------------
    def _model_ids(self, piece: str) -> list[int]:
        return [t.id for t in self.tok.model.tokenize(piece)]

    def encode_unsplit(self, piece: str, leaf: int = UNSPLIT_CHARS) -> list[int]:
        """Ids of one pre-token, given as byte stand-ins, by halving it."""
        if len(piece) <= leaf:
            return self._model_ids(piece)
        mid = len(piece) // 2
        return self.join(piece, self.encode_unsplit(piece[:mid], leaf), self.encode_unsplit(piece[mid:], leaf), mid)

    def join(self, piece: str, left: list[int], right: list[int], mid: int) -> list[int]:
        """Ids of ``piece`` from those of its two parts, which meet at ``mid``."""
        n = 1
        while True:
            a, b = min(n, len(left)), min(n, len(right))
            start = mid - sum(len(self.bytes_of[i]) for i in left[len(left) - a:])
            end = mid + sum(len(self.bytes_of[i]) for i in right[:b])
            window = self._model_ids(piece[start:end])
            at_start = a == len(left) or (window and window[0] == left[-a])
            at_end = b == len(right) or (window and window[-1] == right[b - 1])
            if at_start and at_end:
                return left[:len(left) - a] + window + right[b:]
            n *= 2

    # -- words ------------------------------------------------------------------------------------------------
    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids, as little-endian bytes, of strings that start and end at safe places."""
        out: list[bytes | None] = [None] * len(words)
        short = []
        for i, w in enumerate(words):
            if len(w) <= UNSPLIT_CHARS or any(a in w for a in self.added):
                short.append(i)
            else:
                ids = [t for piece, _ in self.tok.pre_tokenizer.pre_tokenize_str(w) for t in self.encode_unsplit(piece)]
                out[i] = np.array(ids, "<u4").tobytes()
        for i, e in zip(short, self.tok.encode_batch_fast([words[i] for i in short], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, "<u4").tobytes()
        return out

    def _learn(self, table: dict[str, bytes], words: set[str], prefix: str) -> None:
        new = [w for w in words if w not in table]
        if new:
            table.update(zip(new, self._encode_words([prefix + w for w in new]), strict=True))

    @staticmethod
    def _safe_words(text: str) -> tuple[str, list[str]]:
        """The first word, and the words after single spaces."""
        if _TWO_SPACES.search(text) or text[:1].isspace() or text[-1:].isspace():
            head, *rest = _CUT.split(text)
            return head, [w[1:] for w in rest]
        head, *rest = text.split(" ")
        return head, rest

    def encode_leaves(self, leaves: list[str]) -> list[bytes]:
        parts = [self._safe_words(x) for x in leaves]
        if len(self.spaced) + len(self.first) > KNOWN_WORDS:
            self.spaced.clear()
            self.first.clear()
        self._learn(self.first, {h for h, _ in parts}, "")
        self._learn(self.spaced, {w for _, rest in parts for w in rest}, " ")
        get = self.spaced.__getitem__
        return [self.first[h] + b"".join(map(get, rest)) for h, rest in parts]

    # -- whole texts ------------------------------------------------------------------------------------------
    @staticmethod
    def _halve(text: str, leaf: int) -> list[str]:
        """Leaves of the tree, cut at safe spaces only; one with no such space stays whole."""
        if len(text) <= leaf:
            return [text]
        mid, reach = len(text) // 2, 64
        while True:
            lo = max(1, mid - reach)
            at = _CUT.search(text, lo, min(len(text), mid + reach))
            if at and 0 < at.start() < len(text):
                return [*ByteBpe._halve(text[:at.start()], leaf), *ByteBpe._halve(text[at.start():], leaf)]
            if lo == 1 and mid + reach >= len(text):
                return [text]
            reach *= 4

    @staticmethod
    def _safe(text: str, at: int) -> bool:
        """Whether ``at`` is the place of a single space between two other characters."""
        return at > 0 and _CUT.match(text, at) is not None

    def _join_texts(self, left: str, right: str, ids: tuple[bytes, bytes]) -> bytes:
        """Joins the ids of neighbouring leaves: the words at the join are encoded again, more of them each time."""
        n = 1
        while True:
            a = left.rsplit(" ", n)[1:] if left.count(" ") >= n else None
            b = right.split(" ", n + 1)
            tail = left if a is None else " " + " ".join(a)
            whole_right = len(b) <= n + 1
            head = right if whole_right else right[:len(right) - len(b[-1]) - 1]
            cut_ok = (a is None or self._safe(left, len(left) - len(tail))) and (whole_right or self._safe(right, len(head)))
            if cut_ok:
                window, x, y = self._encode_words([tail + head, tail, head])
                if window == x + y and ids[0].endswith(x) and ids[1].startswith(y):
                    return ids[0] + ids[1]
                if a is None and whole_right:
                    return window
            elif a is None and whole_right:
                return self._encode_words([left + right])[0]
            n *= 2

    def encode_batch(self, texts: list[str], leaf: int = LEAF_CHARS) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of whole texts."""
        trees = [self._halve(t, leaf) for t in texts]
        encoded = iter(self.encode_leaves([x for tree in trees for x in tree]))
        out = []
        for tree in trees:
            level = [(x, next(encoded)) for x in tree]
            while len(level) > 1:  # neighbours are joined pair by pair, level by level
                level = [(p[0][0] + p[1][0], self._join_texts(p[0][0], p[1][0], (p[0][1], p[1][1]))) if len(p) == 2
                         else p[0] for p in (level[i:i + 2] for i in range(0, len(level), 2))]
            out.append(level[0][1])
        return out

    def decode(self, ids: bytes) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteBpe:
    return ByteBpe(path)


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """Token ids and the decoded text of every row, as digests; ``with_ids`` adds ``ids`` and ``decoded`` themselves.

    Null text counts as empty: no tokens, and the digests of nothing. Repeated rows give repeated results, other
    columns are ignored, an empty table gives an empty one. One text is encoded in one task.
    """
    schema = f"{id_col} {type_of(docs, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(rows: Iterator[tuple]) -> Iterator[dict]:
        bpe = vocabulary(path)
        for part in blocks(rows, lambda r: len(r[1]), BLOCK_CHARS):
            ids = bpe.encode_batch([r[1] for r in part])
            decoded = [bpe.decode(x) for x in ids]
            out = {id_col: [r[0] for r in part], "n_tokens": [len(x) // 4 for x in ids],
                   "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                   "decoded_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in decoded]}
            if with_ids:
                out |= {"ids": [np.frombuffer(x, "<u4").tolist() for x in ids], "decoded": decoded}
            yield out

    rows = docs.select(F.col(id_col), text_or_empty(F.col(text_col)).alias("text"))
    return map_rows(rows, run, schema + (", ids array<int>, decoded string" if with_ids else ""))
