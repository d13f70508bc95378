"""Statistics as aggregates. Every join key is pre-aggregated, so a hot law number costs one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.functions import law as L


def _rate(k, n):
    return F.bround(k / n * 100, 2)


def corpus_stats(laws: DataFrame) -> DataFrame:
    """A1: one row, none when there are no laws."""
    y = F.when(L.truthy(F.col("year")), L.to_int(F.col("year")))
    dated = F.count_if(L.truthy(F.col("date")))
    lo, hi = F.min(y), F.max(y)
    return laws.agg(
        F.count("*").alias("total_laws"),
        dated.alias("laws_with_dates"),
        (F.count("*") - dated).alias("laws_without_dates"),
        _rate(dated, F.nullif(F.count("*"), F.lit(0))).alias("date_coverage_percent"),
        F.when((lo != 0) & (hi != 0), F.concat(lo.cast("string"), F.lit("-"), hi.cast("string"))).otherwise("N/A").alias("year_range"),
        lo.alias("earliest_year"),
        hi.alias("latest_year"),
    ).where("total_laws > 0")


def decade_histogram(laws: DataFrame) -> DataFrame:
    """Laws with date and year by decade, ascending."""
    ok = L.truthy(F.col("date")) & L.truthy(F.col("year"))
    return laws.where(ok).groupBy(L.decade(F.col("year")).alias("decade")).agg(F.count("*").alias("n_laws")).orderBy("decade")


def year_counts(laws: DataFrame) -> DataFrame:
    """Laws per year text, with the place of first sight."""
    return laws.where(L.truthy(F.col("year"))).groupBy("year").agg(F.count("*").alias("total"), F.min("ord").alias("first_ord"))


def urn_validation(laws: DataFrame) -> DataFrame:
    """A2: one row; rate 0 when there are no laws."""
    ok = L.is_valid_urn(F.col("urn"))
    n, good = F.count("*"), F.count_if(ok)
    return laws.agg(
        n.alias("total_laws"),
        good.alias("valid_urns"),
        (n - good).alias("invalid_urns"),
        F.count_if(ok & L.is_placeholder(F.col("urn"))).alias("placeholder_dates"),
        F.coalesce(_rate(good, F.nullif(n, F.lit(0))), F.lit(0.0)).alias("success_rate"),
    )


def validation_errors(laws: DataFrame) -> DataFrame:
    """A3: one row per placeholder or invalid law."""
    urn, ok = F.col("urn"), L.is_valid_urn(F.col("urn"))
    head = F.concat(F.lit("Lei "), F.coalesce("number", F.lit("None")))
    message = (
        F.when(urn.isNull(), F.concat(head, F.lit(": Validation error: urn is missing")))
        .when(~ok, F.concat(head, F.lit(": Invalid URN format: "), urn))
        .when(L.is_placeholder(urn), F.concat(head, F.lit(": Using placeholder date (no date found)")))
    )
    return laws.select("ord", message.alias("message")).where(F.col("message").isNotNull())


def _ok(c: str = "success"):
    return F.coalesce(F.col(c), F.lit(False))


def fetch_summary(results: DataFrame) -> DataFrame:
    """A4; a NULL success counts as failed."""
    n, good = F.count("*"), F.count_if(_ok())
    return results.agg(
        n.alias("total_fetch_attempts"),
        good.alias("successful_fetches"),
        (n - good).alias("failed_fetches"),
        F.coalesce(_rate(good, F.nullif(n, F.lit(0))), F.lit(0.0)).alias("success_rate"),
    )


def fetch_timing(results: DataFrame) -> DataFrame:
    """A5 in exact decimals, so the sum doesn't depend on order; a NULL time counts as 0, the mean is over all rows."""
    total = F.coalesce(F.sum(F.col("fetch_time").cast("decimal(18,3)")), F.lit(0).cast("decimal(28,3)"))
    mean = F.bround(total.cast("double") / F.nullif(F.count("*"), F.lit(0)), 2)
    return results.agg(total.cast("double").alias("total_fetch_time"), F.coalesce(mean, F.lit(0.0)).alias("average_fetch_time"))


def fetch_failures(results: DataFrame) -> DataFrame:
    """A6."""
    return results.where(~_ok()).select("ord", "url", "law_number", F.col("error_message").alias("error"))


def batch_success(results: DataFrame) -> DataFrame:
    """A10."""
    return results.groupBy("batch").agg(F.count_if(_ok()).alias("successful"), F.count("*").alias("total"))


def first_laws(laws: DataFrame) -> DataFrame:
    """J1's build side: the first law of each number in input order."""
    return laws.where(L.truthy(F.col("number"))).groupBy(F.col("number").alias("law_number")).agg(F.min_by("year", "ord").alias("year"))


def year_success(laws: DataFrame, results: DataFrame) -> DataFrame:
    """A7 + A8 via J1/J2: per year of laws, all laws and the successful fetches credited to the first law of the number."""
    hits = results.where(_ok() & L.truthy(F.col("law_number"))).groupBy("law_number").agg(F.count("*").alias("_n"))
    credited = hits.join(first_laws(laws), "law_number").where(L.truthy(F.col("year"))).groupBy("year").agg(F.sum("_n").alias("successful"))
    totals = year_counts(laws).select("year", "total")
    return totals.join(credited, "year", "left").select("year", "total", F.coalesce("successful", F.lit(0)).alias("successful"))


def final_result(laws: DataFrame, results: DataFrame) -> DataFrame:
    """The rate is that of valid identifiers, not that of fetches."""
    v = urn_validation(laws).select(F.col("total_laws").alias("laws_processed"), "success_rate")
    f = fetch_summary(results).select(F.col("successful_fetches").alias("documents_fetched"))
    return v.crossJoin(F.broadcast(f)).select("laws_processed", "documents_fetched", "success_rate")  # one row each
