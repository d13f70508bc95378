"""The corpus side of a run as one object: documents to laws, their statistics, filters, lists and exports."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from lexspark.operators import laws as O
from lexspark.operators import reports as R
from lexspark.session import written
from lexspark.sinks import writers as W
from lexspark.sources.readers import read_documents, require_documents

log = logging.getLogger("lexspark")


class LawProcessor:
    """documents: a path (see read_documents) or a frame of raw documents. laws is None until process_documents() ran."""

    def __init__(self, spark: SparkSession, documents: str | DataFrame):
        self.spark, self.documents = spark, documents
        self.laws: DataFrame | None = None

    def process_documents(self, check_input: bool = False) -> DataFrame:
        """L1, written once and reused. check_input: documents that lack a key are an error."""
        docs = read_documents(self.spark, self.documents) if isinstance(self.documents, str) else self.documents
        docs = require_documents(docs) if check_input else docs
        self.laws = written(O.process_documents(docs), "laws")
        log.info("%d laws processed; %d documents named like a law have no number", self.laws.count(), O.rejects(docs).count())
        return self.laws

    def _done(self) -> DataFrame:
        if self.laws is None:
            raise ValueError("no processed laws; call process_documents() first")
        return self.laws

    def filter_laws_by_criteria(self, min_year: int | None = None, max_year: int | None = None, require_date: bool = False) -> DataFrame:
        """L3."""
        return O.filter_laws(self._done(), require_date, min_year, max_year)

    def get_statistics(self) -> dict:
        """A1; empty when there are no laws."""
        row = R.corpus_stats(self._done()).first()
        return row.asDict() if row else {}

    def get_urns(self, laws: DataFrame | None = None) -> DataFrame:
        """L7; of all processed laws by default."""
        return O.urns(self._done() if laws is None else laws)

    def get_urls(self, laws: DataFrame | None = None) -> DataFrame:
        """L7; of all processed laws by default."""
        return O.urls(self._done() if laws is None else laws)

    def export(self, folder: str, laws: DataFrame | None = None, single_files: bool = False) -> None:
        """K1 and K2 into folder: laws and urls as part files; single_files: laws.json and urls.txt, in order, instead."""
        laws = self._done() if laws is None else laws
        W.make_folder(self.spark, folder)
        if single_files:
            W.export_json(laws, f"{folder}/laws.json")
            W.export_urls(laws, f"{folder}/urls.txt")
        else:
            W.write_json_lines(O.export_rows(laws), f"{folder}/laws")
            W.write_url_lines(laws, f"{folder}/urls")
