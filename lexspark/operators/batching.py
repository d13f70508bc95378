"""Consecutive slices in input order, without a single-partition window over the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BIN = 65_536


def global_rank(df: DataFrame, order: str = "ord", name: str = "rank", bin_width: int = BIN) -> DataFrame:
    """0-based rank by a non-null integer column. Rows are ranked within bins of bin_width values; only the counts per bin
    (one row per bin_width values) pass through a window without partitioning. Ties rank in arbitrary order."""
    b = F.expr(f"floor({order} / {bin_width})")
    counts = df.groupBy(b.alias("_bin")).agg(F.count("*").alias("_n"))
    before = counts.select("_bin", (F.sum("_n").over(Window.orderBy("_bin")) - F.col("_n")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_bin").orderBy(order)) - 1
    return df.withColumn("_bin", b).withColumn("_in", within).join(before, "_bin").withColumn(name, F.col("_before") + F.col("_in")).drop("_bin", "_in", "_before")


def batches(df: DataFrame, batch_size: int, order: str = "ord") -> DataFrame:
    """Adds batch, 0-based; the last batch may be short."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    return global_rank(df, order, "_rank").withColumn("batch", F.expr(f"cast(_rank div {batch_size} as int)")).drop("_rank")


def batch_sizes(batched: DataFrame) -> DataFrame:
    """Batch k of N and its size."""
    sizes = batched.groupBy("batch").agg(F.count("*").alias("size"))
    n = sizes.agg(F.count("*").alias("batches"))
    return sizes.crossJoin(F.broadcast(n)).select((F.col("batch") + 1).alias("k"), "batches", "size")  # n is one row
