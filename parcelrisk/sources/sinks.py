"""Sinks: dated snapshots, gold artefacts, history tables, reports, model
artefacts, run log (S4-S6, S10-S18, S20).

Snapshots and reports are partitioned by date; reruns of a day overwrite just that
day's partition (dynamic partition overwrite). History tables are partitioned by append and date: an
append is a batch that a manifest row commits, and readers prune partitions by date.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelrisk.operators.risk import HISTORY_SCHEMA

MODEL_METRICS_SCHEMA = ("run_date date, model_name string, roc_auc double, avg_precision double, "
                        "f1_optimal double, recall_fallo double, best_threshold double, run_id string")
DRIFT_ALERTS_SCHEMA = "alert_date date, feature_name string, psi_value double, severity string"
RUN_LOG_SCHEMA = "run_id string, stage string, key string, value string, ts timestamp"
MANIFEST_SCHEMA = "value string, n_rows long, committed_at timestamp"
HISTORY_TABLES = {
    "delivery_predictions": (HISTORY_SCHEMA + ", created_at timestamp", "run_date"),
    "model_metrics": (MODEL_METRICS_SCHEMA + ", created_at timestamp", "run_date"),
    "drift_alerts": (DRIFT_ALERTS_SCHEMA + ", created_at timestamp", "alert_date"),
}


def _dynamic(writer):
    return writer.option("partitionOverwriteMode", "dynamic")


def write_snapshot(df: DataFrame, base: str, run_date: str, fmt: str = "parquet") -> str:
    """One snapshot per day (bronze/silver): rerunning a day replaces only that day."""
    out = df.withColumn("run_date", F.to_date(F.lit(run_date)))
    _dynamic(out.write.mode("overwrite").partitionBy("run_date")).format(fmt).save(base)
    return base


def _stored_at(spark: SparkSession, table: str, base: str) -> bool:
    """Whether there is such a table and it is kept in that folder."""
    if not spark.catalog.tableExists(table):
        return False
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").collect()
    return any(r["data_type"].rstrip("/").endswith(base.rstrip("/")) for r in rows)


def _manifest(base: str) -> str:
    return f"{base.rstrip('/')}_manifest"


def read_manifest(spark: SparkSession, base: str, write_id: str | None = None) -> DataFrame:
    """(value, n_rows, committed_at, write_id) of the committed appends, a row per partition value; of one only with ``write_id``."""
    path = _manifest(base) + (f"/write_id={write_id}" if write_id else "")
    try:
        found = spark.read.schema(MANIFEST_SCHEMA if write_id else f"{MANIFEST_SCHEMA}, write_id string").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], MANIFEST_SCHEMA if write_id else f"{MANIFEST_SCHEMA}, write_id string")
    return found.withColumn("write_id", F.lit(write_id)) if write_id else found


def _register(spark: SparkSession, base: str, partition_col: str, batch_id: str, values: list[str]) -> None:
    """Shows the partitions of one append in the history table that is kept in ``base``, if there is one."""
    name = base.rstrip("/").rpartition("/")[2]
    if name not in HISTORY_TABLES or not _stored_at(spark, name, base):
        return
    for i in range(0, len(values), 500):
        parts = " ".join(f"PARTITION (write_id = '{batch_id}', {partition_col} = '{v}')" for v in values[i:i + 500])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")


def append_counted(df: DataFrame, base: str, partition_col: str, batch_id: str | None = None) -> int:
    """Append rows as one committed batch and return how many landed.

    The rows of a batch get a folder of their own, ``write_id=<batch>/<partition_col>=<value>``. Their counts by
    partition value, read back from that folder alone, are written to the manifest beside the table, which commits the
    batch, and its partitions are added to the table by name: nothing lists or opens what earlier batches wrote. A batch
    whose id is committed already is not written again; one that broke off before its commit is written anew. Rows
    without a partition value land in Hive's default partition and are counted, but not shown in the table.
    """
    spark = df.sparkSession
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id or "new"):
        raise ValueError(f"not a batch id: {batch_id!r}")
    batch = f"b_{batch_id or uuid.uuid4().hex}"    # no folder's name reads as a number or a date
    rows = read_manifest(spark, base, batch).drop("write_id").collect() if batch_id else []   # a row per partition value of the batch
    if not rows:
        folder = f"{base.rstrip('/')}/write_id={batch}"
        stamped = df.withColumn("created_at", F.lit(_dt.datetime.now()))
        (stamped.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition_col).parquet(folder))
        landed = spark.read.schema(stamped.schema).parquet(folder)
        counts = landed.groupBy(F.col(partition_col).cast("string").alias("value")).agg(F.count("*").alias("n_rows")).collect()
        rows = counts or [(None, 0)]
        now = _dt.datetime.now()
        (spark.createDataFrame([(v, n, now) for v, n in rows], MANIFEST_SCHEMA).coalesce(1)
         .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{_manifest(base)}/write_id={batch}"))
    _register(spark, base, partition_col, batch, sorted(r[0] for r in rows if r[0] is not None))
    return sum(r[1] for r in rows)


def read_history(spark: SparkSession, base: str) -> DataFrame:
    """The committed rows below ``base``, without the bookkeeping columns; rows of a batch that broke off aren't shown."""
    committed = read_manifest(spark, base).select("write_id").distinct()
    rows = spark.read.parquet(base)
    return rows.join(committed, "write_id", "left_semi").drop("write_id", "created_at")


def ensure_history_tables(spark: SparkSession, base: str) -> None:
    """Create the three history tables if absent (idempotent DDL)."""
    for name, (schema, part) in HISTORY_TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}, write_id string) USING parquet "
                  f"PARTITIONED BY (write_id, {part}) LOCATION '{base.rstrip('/')}/{name}'")


def append_predictions(history_rows: DataFrame, base: str, backfill: bool = False, batch_id: str | None = None) -> int:
    """Append prediction history rows (see ``operators.risk.prediction_history``), once per ``batch_id``.

    A daily run holds one run_date, so every task writes one file. A backfill
    spanning many dates is first range-partitioned on (run_date, delivery_id):
    each task then holds a contiguous run of dates (few files per task) and a
    very large date is still split over several tasks by the id suffix.
    """
    if backfill:
        history_rows = history_rows.repartitionByRange("run_date", "delivery_id")
    return append_counted(history_rows, f"{base}/delivery_predictions", "run_date", batch_id)


def append_model_metrics(spark: SparkSession, base: str, metrics: dict, model_name: str,
                         run_id: str = "", run_date: str | None = None) -> int:
    """One row, once per ``run_id`` if there is one; missing metrics default to 0 and the threshold to 0.5."""
    def num(k, default):
        v = metrics.get(k, default)
        return float(default if v is None else v)
    row = (run_date or _dt.date.today().isoformat(), model_name, num("roc_auc", 0), num("avg_precision", 0),
           num("f1_optimal", 0), num("recall_fallo", 0), num("best_threshold", 0.5), run_id)
    df = spark.createDataFrame([row], "run_date string, model_name string, roc_auc double, "
                                      "avg_precision double, f1_optimal double, recall_fallo double, "
                                      "best_threshold double, run_id string")
    df = df.withColumn("run_date", F.to_date("run_date"))
    return append_counted(df, f"{base}/model_metrics", "run_date", run_id or None)


def append_drift_alerts(alert_rows: DataFrame, base: str, batch_id: str | None = None) -> int:
    """Only non-OK rows arrive here (``operators.drift.drift_alert_rows``), once per ``batch_id``; none -> nothing written."""
    if alert_rows.isEmpty():
        return 0
    return append_counted(alert_rows, f"{base}/drift_alerts", "alert_date", batch_id)


def write_daily_reports(scored: DataFrame, base: str, run_date: str) -> None:
    """All predictions and the HIGH+MEDIUM subset, each partitioned by run date."""
    out = scored.withColumn("run_date", F.to_date(F.lit(run_date)))
    _dynamic(out.write.mode("overwrite").partitionBy("run_date")).parquet(f"{base}/predictions")
    risky = out.filter(F.col("risk_level").isin("HIGH", "MEDIUM"))
    _dynamic(risky.write.mode("overwrite").partitionBy("run_date")).parquet(f"{base}/high_risk")


def write_table(df: DataFrame, path: str, csv: bool = False) -> None:
    """Small report tables (model comparison S14, scaler stats S6, enriched data S18)."""
    df.write.mode("overwrite").parquet(path)
    if csv:
        df.write.mode("overwrite").option("header", True).csv(path + "_csv")


def save_model(model: PipelineModel, base: str, name: str, metadata: dict) -> str:
    """A versioned copy plus the ``best_model`` alias, each with a one-row metadata table."""
    spark = SparkSession.getActiveSession()
    saved_at = _dt.datetime.now().strftime("%Y%m%d_%H%M%S")
    meta = {**metadata, "model_name": name, "saved_at": saved_at}
    for d in (f"{base}/versions/{name}_{saved_at}", f"{base}/best_model"):
        model.write().overwrite().save(f"{d}/pipeline")
        spark.createDataFrame([(json.dumps(meta, default=str),)], "meta string").write.mode(
            "overwrite").parquet(f"{d}/metadata")
    return f"{base}/best_model"


def load_model(path: str) -> tuple[PipelineModel, dict]:
    spark = SparkSession.getActiveSession()
    meta = json.loads(spark.read.parquet(f"{path}/metadata").first()["meta"])
    return PipelineModel.load(f"{path}/pipeline"), meta


def append_manual_delivery(rows: DataFrame, base: str) -> int:
    """Append manual deliveries; returns the table's row count afterwards."""
    rows.write.mode("append").parquet(base)
    return rows.sparkSession.read.parquet(base).count()


def log_run(spark: SparkSession, base: str, run_id: str, stage: str, values: dict) -> None:
    """key/value parameters and metrics of one stage."""
    now = _dt.datetime.now()
    rows = [(run_id, stage, str(k), str(v), now) for k, v in values.items()]
    if rows:
        spark.createDataFrame(rows, RUN_LOG_SCHEMA).write.mode("append").parquet(f"{base}/run_log")
