"""A run from any input to its reports."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexspark.operators import laws as O
from lexspark.operators import reports as R
from lexspark.operators.fetch import FetchConfig, OfflineClient, fetch
from lexspark.plans.processor import LawProcessor
from lexspark.session import written
from lexspark.sinks.writers import make_folder, save_reports
from lexspark.sources.readers import check_laws, read_url_lines

log = logging.getLogger("lexspark")


class LawRun:
    """Give at most one of input_file (see read_documents), documents (a frame of raw documents), laws (a frame),
    processor (a LawProcessor that has processed its documents) or urls_file. Where several could apply the order is laws,
    urls_file, processor, documents, input_file."""

    def __init__(self, spark: SparkSession, input_file: str | None = None, laws: DataFrame | None = None, documents: DataFrame | None = None, urls_file: str | None = None, processor: LawProcessor | None = None, output_dir: str = "./fetched_documents", config: FetchConfig = FetchConfig(), make_client: Callable[[], object] | None = OfflineClient, single_files: bool = False):
        given = [x for x in (input_file, laws, documents, urls_file, processor) if x is not None]
        if len(given) > 1:
            raise ValueError("Please provide exactly one input method: input_file, laws, documents, processor, or urls_file")
        for name, frame in (("laws", laws), ("documents", documents)):
            if frame is not None and not isinstance(frame, DataFrame):
                raise ValueError(f"'{name}' parameter must be a DataFrame")
        if processor is not None and not (hasattr(processor, "laws") and hasattr(processor, "filter_laws_by_criteria")):
            raise ValueError("'processor' must be a LawProcessor or compatible")
        if urls_file is not None and not isinstance(urls_file, str):
            raise ValueError("'urls_file' must be a string path")
        if config.batch_size < 1:
            raise ValueError("batch_size must be at least 1")
        self.spark, self.output_dir, self.config, self.make_client, self.single_files = spark, output_dir.rstrip("/"), config, make_client, single_files
        self.input_file, self._laws, self.documents, self.urls_file, self.processor = input_file, laws, documents, urls_file, processor

    def laws(self, require_date: bool = True, min_year: int | None = None, max_year: int | None = None) -> DataFrame:
        """Strict year filter where documents were processed, tolerant one where laws came from elsewhere."""
        if self._laws is not None:
            return O.filter_laws(check_laws(self._laws), require_date, min_year, max_year, strict=False)
        if self.urls_file:
            lines = read_url_lines(self.spark, self.urls_file)
            found = O.laws_from_urls(lines)
            asked = lines.where("trim(url) <> ''").count()
            log.info("%d of %d lines with text are addresses of laws", found.count(), asked)
            return O.filter_laws(found, require_date, min_year, max_year, strict=False)
        if self.processor is not None:
            if self.processor.laws is None or self.processor.laws.isEmpty():
                raise ValueError("the processor has no processed laws; call process_documents() first")
            return self.processor.filter_laws_by_criteria(min_year=min_year, max_year=max_year, require_date=require_date)
        if self.documents is None and not self.input_file:
            raise ValueError("No valid input method provided")
        made = LawProcessor(self.spark, self.input_file if self.documents is None else self.documents)
        made.process_documents()
        return made.filter_laws_by_criteria(min_year=min_year, max_year=max_year, require_date=require_date)

    def run(self, require_date: bool = True, min_year: int | None = None, max_year: int | None = None, max_documents: int | None = None) -> dict:
        """O1. All laws are fetched once any identifier is valid; otherwise none."""
        began = time.time()
        if self.make_client is None:
            raise ValueError("no fetch client is set up")
        for name in ("documents", "logs", "metadata"):
            make_folder(self.spark, f"{self.output_dir}/{name}")
        laws = written(O.first_n(self.laws(require_date, min_year, max_year), max_documents), "laws")
        valid = R.urn_validation(laws).first()
        log.info("%d laws, %d with a valid identifier", valid["total_laws"], valid["valid_urns"])
        target = laws if valid["valid_urns"] else laws.limit(0)
        results = fetch(target, self.config, self.make_client)
        save_reports(laws, results, f"{self.output_dir}/metadata", self.single_files)
        final = R.final_result(laws, results).first().asDict()
        log.info("%d documents fetched; reports in %s/metadata", final["documents_fetched"], self.output_dir)
        return {"total_runtime_seconds": round(time.time() - began, 2)} | final | {"output_directory": self.output_dir}
