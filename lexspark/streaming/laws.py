"""The law expressions over a stream, and windowed fetch success with late data (extensions)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.operators.laws import process_documents
from lexspark.schema import RAW_DOCUMENT


def stream_laws(spark: SparkSession, folder: str) -> DataFrame:
    """Laws from raw documents that arrive as Parquet files; stateless, so any output mode but complete works."""
    return process_documents(spark.readStream.schema(RAW_DOCUMENT).parquet(folder))


def windowed_success(results: DataFrame, window: str = "1 hour", lateness: str = "2 days") -> DataFrame:
    """Attempts and successes per window of fetched_at, batch or stream; a result delivered twice counts once, and as a
    success if any delivery says so. Deliveries of one attempt share its fetched_at, so they meet, in whatever order
    they come."""
    ok = F.coalesce(F.col("success"), F.lit(False))
    timed = results.withWatermark("fetched_at", lateness).where("fetched_at IS NOT NULL")
    once = timed.groupBy("fetched_at", "ord", "url").agg(F.bool_or(ok).alias("ok"))
    return (
        once.groupBy(F.window("fetched_at", window).alias("w"))
        .agg(F.count("*").alias("attempts"), F.count_if("ok").alias("successful"))
        .select(F.col("w.start").alias("window_start"), "attempts", "successful")
    )
