"""JSON corpora, URL lists, Parquet tables and frames made elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.operators.laws import laws_from_urls
from lexspark.schema import LAW_DOCUMENT, RAW_DOCUMENT, require_columns

_DOCS = "array<struct<filename:string,filedata:string>>"


def _path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array of {filename, filedata}; ord is the place in the array. A file that isn't such an array, or a
    record that lacks a key, fails the query instead of becoming NULLs. One array is one row until it is exploded, so
    this is for interchange files; a corpus belongs in JSON lines or Parquet."""
    if not _path_exists(spark, path):
        raise FileNotFoundError(f"documents file not found: {path}")
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", _DOCS).alias("docs"))
    whole = whole.select(F.when(F.col("docs").isNull(), F.raise_error(F.lit("not a JSON array of documents")).cast(_DOCS)).otherwise(F.col("docs")).alias("docs"))
    rows = whole.select(F.posexplode("docs").alias("ord", "d")).select(F.col("ord").cast("long").alias("ord"), "d.filename", "d.filedata")
    missing = F.col("filename").isNull() | F.col("filedata").isNull()
    text = F.when(missing, F.raise_error(F.concat(F.lit("document without filename or filedata at "), F.col("ord"))).cast("string"))
    return rows.withColumns({c: text.otherwise(F.col(c)) for c in ("filename", "filedata")})


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Splittable form of S1: one {ord, filename, filedata} a line."""
    return spark.read.schema(RAW_DOCUMENT).json(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """S1 by the name of the path: Parquet (.parquet, or a folder of it), JSON lines (.jsonl, .ndjson) or a JSON array."""
    if not _path_exists(spark, path):
        raise FileNotFoundError(f"documents file not found: {path}")
    name = path.rstrip("/")
    if name.endswith((".jsonl", ".ndjson")):
        return read_json_lines(spark, path)
    if name.endswith(".json"):
        return read_json_array(spark, path)
    return spark.read.parquet(path)


def read_url_lines(spark: SparkSession, path: str) -> DataFrame:
    """The raw lines of S2 with their place in the file. A missing file fails at once. monotonically_increasing_id keeps
    file order within and across splits of one file; of several files in a folder it keeps each one's order, not theirs."""
    if not _path_exists(spark, path):
        raise FileNotFoundError(f"URLs file not found: {path}")
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("ord"), F.col("value").alias("url"))


def read_urls_file(spark: SparkSession, path: str) -> DataFrame:
    """S2."""
    return laws_from_urls(read_url_lines(spark, path))


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A Parquet table of a data folder."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def document_check(df: DataFrame) -> DataFrame:
    """S7 over all rows, as one row: how many there are and how many lack a key."""
    require_columns(df, RAW_DOCUMENT, "documents")
    return df.agg(F.count("*").alias("rows"), F.count_if(F.col("filename").isNull()).alias("no_filename"), F.count_if(F.col("filedata").isNull()).alias("no_filedata"))


def check_documents(df: DataFrame) -> dict[str, int]:
    """S7 as figures."""
    return document_check(df).first().asDict()


def require_documents(df: DataFrame) -> DataFrame:
    """S7 as a gate: df itself, or ValueError where any row lacks a key."""
    bad = check_documents(df)
    if bad["no_filename"] or bad["no_filedata"]:
        raise ValueError(f"documents without filename: {bad['no_filename']}, without filedata: {bad['no_filedata']}, of {bad['rows']}")
    return df


def check_laws(df: DataFrame) -> DataFrame:
    """S3: a frame of laws made elsewhere."""
    return require_columns(df, LAW_DOCUMENT, "laws")
