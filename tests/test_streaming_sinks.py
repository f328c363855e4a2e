import datetime
import os
import pathlib
import tempfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from parcelrisk.functions.scorecard import rule_probability
from parcelrisk.operators import risk as RK
from parcelrisk.sources import files as FS
from parcelrisk.sources import sinks as S
from parcelrisk.streaming.incremental import read_scored, start_incremental_scoring
from conftest import SF_SMALL


def _day(spark, date):
    from parcelrisk.plans.fixtures import deliveries
    d = deliveries(spark, SF_SMALL, with_ingest_order=False)
    return d.withColumn("date", F.to_date(F.lit(date)))


def test_incremental_scoring_exactly_once(spark):
    base = tempfile.mkdtemp(prefix="pr-stream-")
    land = f"{base}/landing"
    day1 = _day(spark, "2024-03-01")
    n = day1.count()
    day1.coalesce(1).write.option("header", True).csv(f"{land}/d1")

    def scorer(b):
        return RK.band(b, rule_probability())

    def run():
        q = start_incremental_scoring(spark, f"{land}/*", f"{base}/out", f"{base}/ckpt", scorer)
        q.awaitTermination()

    run()
    assert read_scored(spark, f"{base}/out").count() == n
    run()                                     # nothing new: no duplicates
    assert read_scored(spark, f"{base}/out").count() == n
    _day(spark, "2024-03-02").coalesce(1).write.option("header", True).csv(f"{land}/d2")
    run()                                     # only the new file is processed
    out = read_scored(spark, f"{base}/out")
    assert out.count() == 2 * n
    assert {str(r["run_date"]) for r in out.select("run_date").distinct().collect()} == {"2024-03-01", "2024-03-02"}


def test_snapshot_overwrites_only_its_day(spark):
    base = tempfile.mkdtemp(prefix="pr-snap-")
    df = spark.range(5).withColumnRenamed("id", "x")
    S.write_snapshot(df, base, "2024-01-01")
    S.write_snapshot(df, base, "2024-01-02")
    S.write_snapshot(df.limit(2), base, "2024-01-01")
    got = {str(r["run_date"]): r["count"] for r in spark.read.parquet(base).groupBy("run_date").count().collect()}
    assert got == {"2024-01-01": 2, "2024-01-02": 5}


def test_history_append_counts_rows(spark):
    base = tempfile.mkdtemp(prefix="pr-hist-")
    scored = spark.createDataFrame([("a", 0.7, "HIGH", "REAGENDAR_SMS"), ("b", 0.1, "LOW", "ENTREGA_NORMAL")],
                                   "delivery_id string, prob_fallo double, risk_level string, action string")
    hist = RK.prediction_history(scored, "2024-01-05", "madrid", "lr_20240101")
    assert S.append_predictions(hist, base) == 2
    missing = RK.prediction_history(scored.drop("action"), "2024-01-05", "madrid")
    assert missing.count() == 0
    assert S.append_model_metrics(spark, base, {"roc_auc": 0.7}, "lr", "run1", "2024-01-05") == 1
    r = spark.read.parquet(f"{base}/model_metrics").first()
    assert r["best_threshold"] == 0.5 and r["avg_precision"] == 0.0


def _history(spark, date, ids="ab"):
    scored = spark.createDataFrame([(i, 0.7, "HIGH", "REAGENDAR_SMS") for i in ids],
                                   "delivery_id string, prob_fallo double, risk_level string, action string")
    return RK.prediction_history(scored, date, "madrid", "lr_20240101")


def test_a_batch_is_appended_once(spark):
    base = tempfile.mkdtemp(prefix="pr-batch-")
    table = f"{base}/delivery_predictions"
    assert S.append_predictions(_history(spark, "2024-01-05"), base, batch_id="0105") == 2
    assert S.append_predictions(_history(spark, "2024-01-05", "abc"), base, batch_id="0105") == 2   # a replay
    assert S.append_predictions(_history(spark, "2024-01-05", "abc"), base, batch_id="0106") == 3
    assert S.append_predictions(_history(spark, "2024-01-06"), base) == 2                           # batches without an id
    assert S.append_predictions(_history(spark, "2024-01-06"), base) == 2
    assert S.read_history(spark, table).count() == 9
    got = sorted((r["value"], r["n_rows"]) for r in S.read_manifest(spark, table).collect())
    assert got == [("2024-01-05", 2), ("2024-01-05", 3), ("2024-01-06", 2), ("2024-01-06", 2)]
    assert "write_id" not in S.read_history(spark, table).columns
    with pytest.raises(ValueError, match="batch id"):
        S.append_predictions(_history(spark, "2024-01-05"), base, batch_id="a/b")


def test_a_batch_that_broke_off_is_not_shown_and_is_written_anew(spark):
    base = tempfile.mkdtemp(prefix="pr-broken-")
    table = f"{base}/delivery_predictions"
    S.append_predictions(_history(spark, "2024-01-05"), base, batch_id="one")
    # rows of two days without a commit, as of a driver that was lost
    for d in ("2024-01-06", "2024-01-07"):
        _history(spark, d).withColumn("created_at", F.current_timestamp()).write.mode("append").partitionBy("run_date").parquet(f"{table}/write_id=b_two")
    assert S.read_history(spark, table).count() == 2
    assert S.append_predictions(_history(spark, "2024-01-06", "xyz"), base, batch_id="two") == 3
    assert sorted(str(r["run_date"]) for r in S.read_history(spark, table).collect()) == ["2024-01-05"] * 2 + ["2024-01-06"] * 3


def test_an_empty_batch_is_committed_too(spark):
    base = tempfile.mkdtemp(prefix="pr-empty-")
    table = f"{base}/delivery_predictions"
    assert S.append_predictions(_history(spark, "2024-01-05").limit(0), base, batch_id="none") == 0
    assert S.append_predictions(_history(spark, "2024-01-05"), base, batch_id="none") == 0
    assert [(r["value"], r["n_rows"]) for r in S.read_manifest(spark, table).collect()] == [(None, 0)]


def test_an_append_opens_only_its_own_files(spark, monkeypatch):
    """What is read back lies in the batch's folder; the table gets its partitions by name."""
    base = tempfile.mkdtemp(prefix="pr-own-")
    S.append_predictions(_history(spark, "2024-01-05"), base, batch_id="old")
    read, said = [], []
    from pyspark.sql.readwriter import DataFrameReader
    parquet, sql = DataFrameReader.parquet, type(spark).sql
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *p, **k: read.extend(p) or parquet(self, *p, **k))
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: said.append(q) or sql(self, q, *a, **k))
    monkeypatch.setattr(S, "_stored_at", lambda *a: True)
    spark.sql("DROP TABLE IF EXISTS delivery_predictions")
    S.ensure_history_tables(spark, base)
    S.append_predictions(_history(spark, "2024-01-06"), base, batch_id="new")
    table = spark.table("delivery_predictions")
    assert read and all("write_id=b_new" in p for p in read)
    assert not any("RECOVER" in q or "MSCK" in q for q in said) and any("ADD IF NOT EXISTS PARTITION (write_id = 'b_new'" in q for q in said)
    assert table.count() == 2 and {str(r["run_date"]) for r in table.collect()} == {"2024-01-06"}   # the older batch was never shown
    S.append_predictions(_history(spark, "2024-01-05"), base, batch_id="old")                         # a replay shows it
    assert spark.table("delivery_predictions").count() == 4
    spark.sql("DROP TABLE delivery_predictions")


def test_first_readable_falls_back_and_lists_paths(spark):
    base = tempfile.mkdtemp(prefix="pr-src-")
    spark.createDataFrame([("a", 1)], "delivery_id string, hour int").write.option("header", True).csv(f"{base}/b")
    df = FS.first_readable(spark, [f"{base}/missing", f"{base}/b"], reader=lambda s, p: FS.read_csv(s, p, infer=True))
    assert df.count() == 1
    with pytest.raises(FileNotFoundError) as e:
        FS.first_readable(spark, [f"{base}/x", f"{base}/y"])
    assert f"{base}/x" in str(e.value) and f"{base}/y" in str(e.value)


def test_read_or_build_caches(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="pr-cache-"), "w")
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)
    assert FS.read_or_build(spark, path, build).count() == 3
    assert FS.read_or_build(spark, path, build).count() == 3
    assert len(calls) == 1


def test_json_records_station_from_file_name(spark):
    base = tempfile.mkdtemp(prefix="pr-json-")
    with open(f"{base}/3195_2024h1.json", "w") as f:
        f.write('[{"fecha": "2024-01-01", "prec": "1,2", "tmed": "5,0"}, {"fecobs": "2024-01-02T00:00", "prec": "Ip"}]')
    from parcelrisk.operators.weather import daily_climate_records
    recs = daily_climate_records(FS.read_json_records(spark, f"{base}/*.json"))
    got = sorted((r["station"], r["fecha"]) for r in recs.collect())
    assert got == [("3195", "2024-01-01"), ("3195", "2024-01-02")]


def test_history_ddl_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="pr-ddl-")
    S.ensure_history_tables(spark, base)
    S.ensure_history_tables(spark, base)
    cols = {r.col_name for r in spark.sql("DESCRIBE TABLE delivery_predictions").collect()}
    assert {"run_date", "delivery_id", "prob_fallo", "model_version", "created_at"} <= cols


def test_listing_and_enriched_sink(spark):
    base = tempfile.mkdtemp(prefix="pr-list-")
    spark.range(3).write.parquet(f"{base}/enriched")
    S.write_table(spark.range(2), f"{base}/report", csv=True)
    paths = [r["path"] for r in FS.list_paths(spark, base, "*.parquet").collect()]
    assert paths and all(p.endswith(".parquet") for p in paths)
    assert spark.read.option("header", True).csv(f"{base}/report_csv").count() == 2


def test_rows_are_dealt_before_they_are_scored(spark):
    """What the scorer adds isn't shuffled, and few files per date are written all the same."""
    base = tempfile.mkdtemp(prefix="pr-stream-")
    for day in range(1, 7):
        _day(spark, f"2024-03-0{day}").coalesce(1).write.option("header", True).csv(f"{base}/landing/d{day}")
    seen = []

    def scorer(b):
        seen.append(b._jdf.queryExecution().logical().toString())
        return RK.band(b, rule_probability())

    start_incremental_scoring(spark, f"{base}/landing/*", f"{base}/out", f"{base}/ckpt", scorer).awaitTermination()
    assert seen and all("RepartitionByExpression" in plan for plan in seen)
    for day in range(1, 7):
        assert 1 <= len(list(pathlib.Path(base).glob(f"out/batch_id=*/run_date=2024-03-0{day}/*.parquet"))) <= 2


def test_deliveries_land_compressed(spark, tmp_path):
    """The stream reads them all the same, each once."""
    from parcelrisk.plans import catalog
    spark.createDataFrame([(k, 10 * k, 1 + k % 2, 1, 5.0 + k, 100.0 * k, 0.05, 0.02, "R" if k % 3 else "N", datetime.date(1996, 1, 1 + k % 3)) for k in range(1, 21)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_shipdate date").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, k, f"{1 + k % 5}-X") for k in range(1, 21)], "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 10.0), (2, 500.0)], "s_suppkey long, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    folders = set(pathlib.Path(catalog.ensure_checkpoint_dir(spark)).glob("parcelrisk-stream-*"))
    out = catalog.QUERIES["incremental_scoring"](spark, str(tmp_path))
    assert sorted(r["delivery_id"] for r in out.collect()) == sorted(f"dlv_{k}_1" for k in range(1, 21))
    (new,) = set(pathlib.Path(catalog.ensure_checkpoint_dir(spark)).glob("parcelrisk-stream-*")) - folders
    landed = list(new.glob("landing/part-*"))
    assert landed and all(f.name.endswith(".csv.gz") for f in landed)
