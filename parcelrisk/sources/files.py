"""File sources: delivery CSVs, landed weather JSON, listings, cached tables
(S1, S2, S7, S8, S9, S19, S21)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELIVERY_SCHEMA = T.StructType([
    T.StructField("delivery_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("is_holiday", T.IntegerType()),
    T.StructField("zone", T.StringType()),
    T.StructField("zone_type", T.StringType()),
    T.StructField("recipient_id", T.StringType()),
    T.StructField("recipient_failure_rate", T.DoubleType()),
    T.StructField("num_previous_attempts", T.IntegerType()),
    T.StructField("driver_id", T.StringType()),
    T.StructField("driver_quality_score", T.DoubleType()),
    T.StructField("driver_delivery_load", T.IntegerType()),
    T.StructField("product_type", T.StringType()),
    T.StructField("requires_signature", T.IntegerType()),
    T.StructField("is_fragile", T.IntegerType()),
    T.StructField("is_bulky", T.IntegerType()),
    T.StructField("weight_kg", T.DoubleType()),
    T.StructField("weather_rain", T.DoubleType()),
    T.StructField("weather_wind_speed", T.DoubleType()),
    T.StructField("weather_temperature", T.DoubleType()),
    T.StructField("is_retry", T.IntegerType()),
    T.StructField("delivery_failed", T.IntegerType()),
])


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = DELIVERY_SCHEMA,
             infer: bool = False) -> DataFrame:
    """Header CSV scan. An explicit schema avoids an inference pass over the data;
    ``infer=True`` reproduces the reference's inferred read for ad-hoc files."""
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if infer or schema is None:
        r = r.option("inferSchema", True)
    else:
        r = r.schema(schema)
    return r.csv(path if isinstance(path, str) else list(path))


def first_readable(spark: SparkSession, candidates: Sequence[str],
                   reader: Callable[[SparkSession, str], DataFrame] | None = None) -> DataFrame:
    """Read the first candidate location that exists; the error lists every path searched."""
    reader = reader or (lambda s, p: read_csv(s, p))
    errors = []
    for p in candidates:
        try:
            return reader(spark, p)
        except AnalysisException as e:  # path does not exist
            errors.append(f"{p}: {e.getErrorClass() or 'not readable'}")
    raise FileNotFoundError("no readable input; searched:\n  " + "\n  ".join(errors))


def daily_packages_path(base: str, run_date: str, pattern: str = "today_packages_{date}.csv") -> str:
    """The day's landed file."""
    return f"{base.rstrip('/')}/{pattern.format(date=run_date)}"


def find_daily(spark: SparkSession, folders: Sequence[str], run_date: str, pattern: str = "today_packages_{date}.csv") -> str:
    """The path of the day's landed file in the first of the folders that has one (S21); of several there the smallest.

    The file system's listing decides; no file is opened. The error names every place that was searched.
    """
    searched = []
    for folder in folders:
        searched.append(daily_packages_path(folder, run_date, pattern))
        try:
            found = list_paths(spark, folder, pattern.format(date=run_date)).agg(F.min("path")).first()[0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            found = None
        if found:
            return found
    raise FileNotFoundError("no packages of the day; searched:\n  " + "\n  ".join(searched))


def read_daily(spark: SparkSession, path: str, schema: T.StructType = DELIVERY_SCHEMA) -> DataFrame:
    """A landed CSV by its own header: known columns get the contract's types, whatever their order and number.

    ``True`` and ``False`` in whole-number columns count as 1 and 0; what doesn't read as its type is NULL; unknown
    columns stay text.
    """
    raw = spark.read.option("header", True).csv(path)
    kinds = {f.name: f.dataType for f in schema.fields}

    def typed(c: str) -> Column:
        value = F.col(f"`{c}`")
        if c not in kinds:
            return value
        cast = value.try_cast(kinds[c])
        if isinstance(kinds[c], T.IntegerType):
            cast = F.when(F.lower(F.trim(value)) == "true", F.lit(1)).when(F.lower(F.trim(value)) == "false", F.lit(0)).otherwise(cast)
        return cast.alias(c)

    return raw.select(*map(typed, raw.columns))


def read_json_records(spark: SparkSession, path: str | Sequence[str], station_from_path: bool = True,
                      arrays: bool = True) -> DataFrame:
    """Landed weather records; all values read as text.

    ``arrays``: each file is one JSON array of records (as the weather service
    returns them); otherwise JSON lines. The station code comes from the file
    name ``<station>_*.json`` when asked (or from a ``station=`` folder by
    partition discovery), so several cities are one multi-file read (U2)
    rather than a union loop.
    """
    df = (spark.read.option("multiLine", arrays).option("primitivesAsString", True)
          .json(path if isinstance(path, str) else list(path)))
    if station_from_path and "station" not in df.columns:
        df = df.withColumn("station", F.regexp_extract(F.input_file_name(), r"([^/]+?)_[^/]*\.json$", 1))
    return df


def read_service_records(spark: SparkSession, path: str | Sequence[str],
                         station: str = r"([^/]+?)_[^/]*\.json$") -> DataFrame:
    """Replies of the weather service, one JSON array of records per file, in order of arrival.

    Columns station (from the file's path), file, pos (place in the array), the record's fields as text, and which of
    them the file has at all. Files of one station follow each other by path, so names begin with the
    period. A reply that is no array (an error message) or can't be read gives no rows; an empty array neither. A
    reply covers half a year at most, so a file is one row until its records are taken apart.
    """
    replies = (spark.read.option("recursiveFileLookup", True).text(path if isinstance(path, str) else list(path), wholetext=True)
               .select("value", F.col("_metadata.file_path").alias("file"))
               .filter(F.col("value").rlike(r"^\s*\["))
               .withColumn("station", F.regexp_extract("file", station, 1))
               .withColumn("records", F.from_json("value", "array<map<string,string>>")))
    fields = ("fecha", "fecobs", "prec", "velmedia", "tmed")

    def has(field: str) -> Column:
        return F.exists("records", lambda r: F.map_contains_key(r, field)).alias(f"has_{field}")

    return (replies.select("station", "file", *map(has, fields), F.posexplode("records").alias("pos", "r"))
            .select("station", "file", "pos", *[F.col("r")[c].alias(c) for c in fields], *[f"has_{c}" for c in fields]))


def list_paths(spark: SparkSession, base: str, glob: str = "*") -> DataFrame:
    """(path, modificationTime, length) under ``base`` matching ``glob`` - contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", True).load(base)
            .select("path", "modificationTime", "length"))


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).select("path").limit(1).collect()
        return True
    except AnalysisException:
        return False


def read_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read-through cache (S8): reuse the stored table, else build it, store it, read it back."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise  # a table that is there but can't be read isn't replaced
        build().write.parquet(path)
        return spark.read.parquet(path)
