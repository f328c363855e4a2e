"""Document fingerprints from prefix polynomial hashes.

The prefix array S[i] = sum of c[j] * B^j mod p for j < i gives the hash of any span in two reads, so spans are
compared without looking at them and the longest common extension of two places is found by binary search. A
fingerprint holds the hash of the whole text and, for each of a number of bins, the smallest hash of the spans
of a fixed length that fall into it; the share of bins in which two fingerprints agree estimates the share of
spans that their texts have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelrisk.llm.common import map_rows, mix64, text_or_empty, type_of

MODULI = (2_147_483_647, 2_147_483_629)   # primes under 2^31, so products fit 62 bits
BASES = (911_382_323, 972_663_749)
SPAN = 16                  # code points of the spans that are compared
BINS = 128                 # one byte each
BUCKET_BYTES = 32 << 20    # text of neighbouring ids handled together

_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """B^i and B^-i for each modulus, at least ``n`` of them, by doubling."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        size = 1 << max(12, int(n).bit_length())
        _POWERS.clear()
        for p, base in zip(MODULI, BASES, strict=True):
            pair = []
            for b in (base, pow(base, -1, p)):
                out = np.ones(1, np.uint64)
                while len(out) < size:
                    out = np.concatenate([out, out * np.uint64(pow(b, len(out), p)) % np.uint64(p)])
                pair.append(out)
            _POWERS.append(tuple(pair))
    return _POWERS


class PrefixHash:
    """Prefix arrays of one text."""

    def __init__(self, text: str):
        self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        n = self.n = len(self.codes)
        self.prefix = []
        for p, (power, _) in zip(MODULI, _powers(n + 1), strict=True):
            s = np.zeros(n + 1, np.uint64)
            np.cumsum((self.codes + np.uint64(1)) * power[:n] % np.uint64(p), out=s[1:])
            self.prefix.append(s % np.uint64(p))

    def span(self, start: int, length: int) -> tuple[int, int]:
        """Equal for equal spans, whatever their places and texts."""
        return tuple((int(s[start + length]) - int(s[start])) % p * int(inverse[start]) % p
                     for s, p, (_, inverse) in zip(self.prefix, MODULI, _powers(self.n + 1), strict=True))

    def spans(self, length: int) -> np.ndarray:
        """Hashes of all spans of a length, by start."""
        s, p = self.prefix[0], np.uint64(MODULI[0])
        inverse = _powers(self.n + 1)[0][1]
        return (s[length:] + p - s[:len(s) - length]) % p * inverse[:len(s) - length] % p

    def fingerprint(self) -> str:
        low = np.full(BINS, 1 << 62, np.uint64)
        if self.n:
            h = mix64(self.spans(min(SPAN, self.n)))
            np.minimum.at(low, (h % np.uint64(BINS)).astype(np.int64), h >> np.uint64(8))
        sketch = np.where(low == 1 << 62, 0, low % np.uint64(255) + np.uint64(1)).astype(np.uint8)
        a, b = self.span(0, self.n)
        return f"{self.n:x}-{a:08x}{b:08x}-{sketch.tobytes().hex()}"


def common_extension(a: PrefixHash, i: int, b: PrefixHash, j: int) -> int:
    """How many code points from ``i`` in one text and ``j`` in the other are equal."""
    lo, hi = 0, min(a.n - i, b.n - j)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a.span(i, mid) == b.span(j, mid):
            lo = mid
        else:
            hi = mid - 1
    return lo


def likeness(a: str, b: str) -> float:
    """0 to 1; 1 for equal fingerprints. Corrected for bins that agree by chance."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(f.rpartition("-")[2]), np.uint8) for f in (a, b))
    either = int(((x > 0) | (y > 0)).sum())
    if not either:
        return 0.0
    agree = float(((x == y) & (x > 0)).sum()) / either
    return max(0.0, (agree - 1 / 255) / (1 - 1 / 255))


def edited_text(text: str, following: str) -> str:
    """The last third replaced by as much of the start of the following text."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k] if k else text


def _dealt(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows by ranges of ids, each range with a copy of the first document of the next one.

    Columns: id, text, bucket, extra (1 for such copies). Ranges come from quantiles of the ids, so any number of
    rows is dealt evenly; per range, one id is sent to the driver's side table.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("text"),
                       F.coalesce(F.col(id_col).cast("double"), F.lit(-1.7e308)).alias("key"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total // BUCKET_BYTES) + 1)
    cuts = sorted(set(rows.select("key").approxQuantile("key", [i / n for i in range(1, n)], 0.2 / n)))
    splits = [-float("inf"), *cuts, float("inf")]
    placed = Bucketizer(splits=splits, inputCol="key", outputCol="b").transform(rows) if len(splits) > 2 else rows.withColumn("b", F.lit(0.0))
    placed = placed.withColumn("bucket", F.col("b").cast("int")).drop("b")
    # the largest id of each range, which follows the smallest of the range above; the largest of all follows the smallest
    tops = sorted((r["bucket"], r["key"]) for r in placed.groupBy("bucket").agg(F.max("key").alias("key")).collect())
    if not tops:
        return placed.withColumn("extra", F.lit(0))
    to = [(key, tops[(i + 1) % len(tops)][0]) for i, (_, key) in enumerate(tops)]
    copies = F.broadcast(spark.createDataFrame(to, "key double, to int"))  # a row per range
    targets = F.when(F.col("to").isNull(), F.array(F.struct("bucket", F.lit(0).alias("extra")))).otherwise(
        F.array(F.struct("bucket", F.lit(0).alias("extra")), F.struct(F.col("to").alias("bucket"), F.lit(1).alias("extra"))))
    return (placed.join(copies, "key", "left").select("id", "text", "key", F.explode(targets).alias("t"))
            .select("id", "text", "key", "t.bucket", "t.extra").repartition(n, "bucket"))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    ``common_next`` is how far a text and the next one agree from their starts. Null text counts as empty (all
    empty texts have one fingerprint); a null id comes after all others; rows of one id are ordered by text; the
    only row of a table is its own next one; other columns are ignored; an empty table gives an empty one.
    """
    schema = (f"{id_col} {type_of(docs, id_col)}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double, common_next long")

    def run(rows: Iterator[tuple]) -> Iterator[dict]:
        out: dict[str, list] = {}
        held = None  # the document that waits for the next one

        def hashed(text: str) -> tuple[str, PrefixHash, str]:
            h = PrefixHash(text)
            return text, h, h.fingerprint()

        def emit(doc: object, own: tuple, following: tuple) -> None:
            edited = edited_text(own[0], following[0])
            print_ = own[2] if edited == own[0] else PrefixHash(edited).fingerprint()
            values = (doc, own[1].n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own[2], print_,
                      likeness(own[2], print_), likeness(own[2], following[2]), common_extension(own[1], 0, following[1], 0))
            for name, v in zip((x.split()[0] for x in schema.split(", ")), values, strict=True):
                out.setdefault(name, []).append(v)

        for doc, text, bucket, extra in rows:
            if held and held[2] == bucket:
                if held[3]:  # further rows of the id that was copied here
                    continue
                this = hashed(text)
                emit(held[0], held[1], this)
            else:
                this = hashed(text)
            held = (doc, this, bucket, extra)
            if len(out.get("n_chars", ())) >= 2000:
                yield out
                out = {}
        if out:
            yield out

    rows = _dealt(docs, id_col, text_col).sortWithinPartitions("bucket", "extra", F.desc("key"), F.desc_nulls_last("id"), "text")
    return map_rows(rows.select("id", "text", "bucket", "extra"), run, schema)
