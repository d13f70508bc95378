"""K1-K7: distributed writers, and ordered single files on request.

Everything goes to the file system that the path names, so that a cluster's executors and driver write to one place. The
single-file writers stream rows through toLocalIterator in order: the driver holds one partition at a time. Lists inside
the JSON reports hold the first SAMPLE entries and say how many there are; the whole lists are folders of JSON lines.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from lexspark.operators import reports as R
from lexspark.operators.laws import export_rows, urls

EXPORT = ["filename", "number", "date", "year", "title", "urn", "url"]
PROCESSED = ["filename", "number", "date", "year", "title", "urn", "original_content"]


SAMPLE = 1_000


class _File:
    """A text file on the file system of its path."""

    def __init__(self, spark: SparkSession, path: str):
        self._to = _fs(spark, path).create(_path(spark, path), True)
        self._held: list[str] = []
        self._size = 0

    def write(self, text: str) -> None:
        self._held.append(text)
        self._size += len(text)
        if self._size > 1_000_000:
            self._send()

    def _send(self) -> None:
        self._to.write(bytearray("".join(self._held).encode("utf-8")))
        self._held, self._size = [], 0

    def __enter__(self) -> _File:
        return self

    def __exit__(self, *_) -> None:
        self._send()
        self._to.close()


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    """A file or folder, if it is there."""
    _fs(spark, path).delete(_path(spark, path), True)


def _array(spark: SparkSession, path: str, rows: Iterable[dict]) -> int:
    n = 0
    with _File(spark, path) as f:
        for n, r in enumerate(rows, 1):
            body = "\n".join("  " + x for x in json.dumps(r, ensure_ascii=False, indent=2).split("\n"))
            f.write(("[\n" if n == 1 else ",\n") + body)
        f.write("\n]" if n else "[]")
    return n


def _ordered(df: DataFrame, columns: list[str]) -> Iterable[dict]:
    return (r.asDict() for r in df.orderBy("ord").select(*columns).toLocalIterator(prefetchPartitions=True))


def export_json(laws: DataFrame, path: str) -> int:
    """K1: one JSON array in input order; nulls stay."""
    return _array(laws.sparkSession, path, _ordered(export_rows(laws), EXPORT))


def export_processed(laws: DataFrame, path: str) -> int:
    """K5: with content, without url."""
    return _array(laws.sparkSession, path, _ordered(laws, PROCESSED))


def export_urls(laws: DataFrame, path: str) -> int:
    """K2: one URL a line."""
    n = 0
    with _File(laws.sparkSession, path) as f:
        for r in _ordered(urls(laws), ["url"]):
            f.write(f"{r['url']}\n")
            n += 1
    return n


def write_json_lines(df: DataFrame, path: str) -> None:
    """K1 at scale: JSON lines with nulls kept."""
    df.write.option("ignoreNullFields", "false").mode("overwrite").json(path)


def write_url_lines(laws: DataFrame, path: str) -> None:
    """K2 at scale."""
    urls(laws).select("url").write.mode("overwrite").text(path)


def _first(df: DataFrame, *columns: str) -> list[dict]:
    """The first SAMPLE rows in input order."""
    return [r.asDict() for r in df.orderBy("ord").limit(SAMPLE).select(*columns).collect()]


def fetch_report(laws: DataFrame, results: DataFrame) -> dict:
    """K3: A4-A8 nested; failures are the first ones, years are texts of a few characters and few."""
    failures = R.fetch_failures(results)
    years = R.year_success(laws, results).orderBy("year").limit(100 * SAMPLE).collect()
    summary = R.fetch_summary(results).first().asDict()
    return {
        "summary": {"total_laws_processed": laws.count()} | summary,
        "timing": R.fetch_timing(results).first().asDict(),
        "failures": _first(failures, "url", "law_number", "error"),
        "failures_total": summary["failed_fetches"],
        "year_statistics": {r.year: {"total": r.total, "successful": r.successful} for r in years},
        "file_statistics": {},
    }


def validation_report(laws: DataFrame) -> dict:
    """K4: A2 and the first of A3."""
    errors = R.validation_errors(laws)
    return R.urn_validation(laws).first().asDict() | {"validation_errors": [r["message"] for r in _first(errors, "message")], "validation_errors_total": errors.count()}


def save_reports(laws: DataFrame, results: DataFrame, folder: str, single_files: bool = False) -> dict[str, str]:
    """K3-K7 into folder. Lists that grow with the laws are folders of part files (processed_laws, failures,
    validation_errors, failed_urls), which stale ones give way to; failed_urls is there only if a fetch failed.
    single_files: processed_laws.json and failed_urls.txt as ordered single files too."""
    spark = laws.sparkSession
    make_folder(spark, folder)
    at = lambda name: f"{folder.rstrip('/')}/{name}"
    report = fetch_report(laws, results)
    for name, x in (("fetch_report.json", report), ("validation_report.json", validation_report(laws))):
        with _File(spark, at(name)) as f:
            f.write(json.dumps(x, ensure_ascii=False, indent=2))
    failures = R.fetch_failures(results)
    write_json_lines(laws.select("ord", *PROCESSED), at("processed_laws"))
    write_json_lines(failures, at("failures"))
    write_json_lines(R.validation_errors(laws), at("validation_errors"))
    results.write.mode("overwrite").option("header", True).csv(at("fetch_results.csv"))
    for name in ("failed_urls", "failed_urls.txt", "processed_laws.json"):
        remove(spark, at(name))
    if report["failures_total"]:
        failures.where("url IS NOT NULL").select("url").write.text(at("failed_urls"))
    if single_files:
        export_processed(laws, at("processed_laws.json"))
        if report["failures_total"]:
            with _File(spark, at("failed_urls.txt")) as f:
                for r in _ordered(failures, ["url"]):
                    f.write(f"{r['url']}\n")
    return {"folder": folder}
