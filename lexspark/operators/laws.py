"""Selection, extraction and filtering of laws."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.functions import law as L


def _info(docs: DataFrame) -> DataFrame:
    return docs.where(L.is_law(F.col("filename"))).select("ord", "filename", "filedata", L.law_info(F.col("filename"), F.col("filedata")).alias("_i"))


def process_documents(docs: DataFrame) -> DataFrame:
    """L1: raw documents to laws. Narrow: no shuffle. NULL filedata counts as empty."""
    docs = docs.withColumn("filedata", F.coalesce("filedata", F.lit("")))
    return _info(docs).where(F.col("_i").isNotNull()).select(
        "ord", "filename", "_i.number", "_i.date", "_i.year",
        L.title(F.col("filename"), F.col("filedata")).alias("title"),
        L.construct_urn(F.col("_i.number"), F.col("_i.date")).alias("urn"),
        F.col("filedata").alias("original_content"),
    )


def rejects(docs: DataFrame) -> DataFrame:
    """L1's other side: documents named like a law from which no number came."""
    # Whether a number is found depends on the file name alone, so the contents are never read.
    return docs.where(L.is_law(F.col("filename")) & L.filename_number(F.col("filename")).isNull()).select("ord", "filename")


def laws_from_urls(urls: DataFrame) -> DataFrame:
    """Lines to laws; blank, comment and unparsable lines drop out."""
    return urls.select("ord", L.url_law(F.col("url")).alias("_l")).where(F.col("_l").isNotNull()).select("ord", "_l.*")


def filter_laws(laws: DataFrame, require_date: bool = False, min_year: int | None = None, max_year: int | None = None, strict: bool = True) -> DataFrame:
    """L2-L4. strict: an unparsable year is an error once a bound is set; else it and years outside 1800..2100 drop out.
    A bound of 0 or None is no bound."""
    year = F.col("year")
    if require_date:
        laws = laws.where(L.truthy(F.col("date")))
    if not (min_year or max_year):
        return laws
    n = L.to_int(year)
    if strict:
        n = F.when(L.truthy(year) & n.isNull(), F.raise_error(F.concat(F.lit("unparsable year: "), year)).cast("int")).otherwise(n)
        laws = laws.where(L.truthy(year))
    else:
        laws = laws.where(L.is_valid_year(year))
    if min_year:
        laws = laws.where(n >= min_year)
    return laws.where(n <= max_year) if max_year else laws


def first_n(df: DataFrame, n: int | None, order: str = "ord") -> DataFrame:
    """The first n rows in input order (a top-k, never a full sort); 0 or None is no limit, a negative n an error."""
    if n is not None and n < 0:
        raise ValueError("max_documents must not be negative")
    return df.orderBy(order).limit(n) if n else df


def export_rows(laws: DataFrame) -> DataFrame:
    """The exported columns, url derived, content left out."""
    return laws.select("ord", "filename", "number", "date", "year", "title", "urn", L.construct_url(F.col("urn")).alias("url"))


def urns(laws: DataFrame) -> DataFrame:
    """L7."""
    return laws.select("ord", "urn")


def urls(laws: DataFrame) -> DataFrame:
    """L7."""
    return laws.select("ord", L.construct_url(F.col("urn")).alias("url"))


def sorted_numbers(laws: DataFrame) -> DataFrame:
    """Numbers sorted as texts, repeated ones next to each other by input order."""
    return laws.select("number", "ord").orderBy("number", "ord")


def retry_set(failed_before: DataFrame, failed_now: DataFrame) -> DataFrame:
    """J4 (extension): addresses that failed before and no longer do. Distinct, so one row per address."""
    return failed_before.select("url").distinct().join(failed_now.select("url").distinct(), "url", "left_anti")


def same_numbers(a: DataFrame, b: DataFrame) -> DataFrame:
    """Numbers that only one of two law sets has; empty if the sets agree."""
    x, y = a.select("number").distinct(), b.select("number").distinct()
    return x.exceptAll(y).select("number", F.lit("left").alias("side")).unionByName(y.exceptAll(x).select("number", F.lit("right").alias("side")))
