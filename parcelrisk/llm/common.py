"""Helpers shared by the text operators."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from parcelrisk.session import stored  # noqa: F401  (the operators import it from here)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def concat_ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The indices of all ranges [start, start + len), one after the other."""
    lens = lens.astype(np.int64)
    ends = np.cumsum(lens)
    if not len(ends) or not ends[-1]:
        return np.empty(0, np.int64)
    return np.repeat(starts - (ends - lens), lens) + np.arange(ends[-1])


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit affects every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def crc32_fold(doc_id: object, n: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % n


def map_rows(df: DataFrame, fn, schema: str, at_once: int = 500) -> DataFrame:
    """``mapInArrow`` over plain values: ``fn`` takes an iterator of row tuples and yields dicts of column lists.

    No more than ``at_once`` rows of a batch are turned into Python values together, as their texts may be long.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (b.slice(i, at_once) for b in batches for i in range(0, b.num_rows, at_once))
        rows = (r for b in parts for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for out in fn(rows):
            yield pa.RecordBatch.from_pydict(out, arrow)

    return df.mapInArrow(run, schema)


def type_of(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


def blocks(rows: Iterator, size_of, limit: int) -> Iterator[list]:
    """Consecutive rows in lists of about ``limit`` units of ``size_of``."""
    held, total = [], 0
    for r in rows:
        held.append(r)
        total += size_of(r)
        if total >= limit:
            yield held
            held, total = [], 0
    if held:
        yield held
