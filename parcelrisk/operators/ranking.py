"""Exact row numbers over a total order without a single-task window.

``row_number() OVER (ORDER BY ...)`` with no partition moves every row into
one task. Here the rows are range-partitioned on the sort key (sampled
bounds, so ranges are balanced and a key never straddles two ranges), sorted
inside each range, numbered locally, and shifted by the row counts of the
preceding ranges - one small (#ranges rows) prefix sum. Ranks inside groups
subtract each group's first global position, found with a partial
aggregation, so a group holding a third of the rows is never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelrisk.session import cut_lineage


def global_row_number(df: DataFrame, order: list[Column], name: str = "rank",
                      partition_by=(), num_ranges: int | None = None) -> DataFrame:
    """Adds ``name`` = 1-based position in ``order`` (within ``partition_by`` groups).

    ``order`` must be a total order (end it with a unique key) for the result
    to be deterministic.
    """
    keys = [F.col(c).asc() for c in partition_by] + list(order)
    n = num_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id()))
    # monotonically_increasing_id = (partition index << 33) + record number in the partition
    r = r.withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    # The range bounds are sampled from the input, whose row order inside upstream
    # shuffle partitions is not fixed; numbering and range sizes must come from the
    # same materialisation, so it is written once to the shared checkpoint folder.
    r = cut_lineage(r.drop("_mid"))
    sizes = r.groupBy("_pid").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # <= n rows
    offs = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    g = r.join(F.broadcast(offs), "_pid").withColumn("_g", F.col("_off") + F.col("_local") + 1)
    if partition_by:
        starts = g.groupBy(*partition_by).agg(F.min("_g").alias("_start"))
        g = g.join(starts, list(partition_by)).withColumn("_g", F.col("_g") - F.col("_start") + 1)
        g = g.drop("_start")
    return g.withColumnRenamed("_g", name).drop("_pid", "_local", "_off")
