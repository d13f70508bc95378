"""python -m lexspark: a run from documents or addresses to reports, on the session that spark-submit provides or a local one.

    python -m lexspark --input docs.json --output out --min-year 2000 --max-documents 20
    python -m lexspark --input corpus.parquet --output out --export-only
    python -m lexspark --urls failed_urls.txt --output out --min-year 0 --max-documents 0
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import functions as F

from lexspark.functions import law as L
from lexspark.operators.fetch import FetchConfig
from lexspark.operators.laws import first_n
from lexspark.plans.processor import LawProcessor
from lexspark.plans.run import LawRun


def _export(spark, a: argparse.Namespace) -> dict:
    """Documents to lists of their laws, without fetching."""
    p = LawProcessor(spark, a.input)
    p.process_documents(check_input=True)
    laws = p.filter_laws_by_criteria(a.min_year, a.max_year, require_date=not a.undated)
    p.export(a.output, laws, a.single_files)
    shown = first_n(laws, 10).select(L.display(F.col("number"), F.col("title")).alias("line")).collect()
    return {"statistics": p.get_statistics(), "sample": [r.line for r in shown], "output_directory": a.output}


def main(argv: list[str] | None = None, spark=None) -> dict:
    p = argparse.ArgumentParser(prog="lexspark", description=__doc__.split("\n")[0])
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--input", help="documents: a JSON array (.json), JSON lines (.jsonl) or Parquet")
    source.add_argument("--urls", help="text file of addresses")
    p.add_argument("--output", default="./fetched_documents")
    p.add_argument("--export-only", action="store_true", help="write laws and addresses of --input, fetch nothing")
    p.add_argument("--min-year", type=int, help="2000 by default in a run that fetches; 0 is no bound")
    p.add_argument("--max-year", type=int)
    p.add_argument("--max-documents", type=int, default=20, help="of a run that fetches; 0 is no limit")
    p.add_argument("--undated", action="store_true", help="take laws without a date too")
    p.add_argument("--batch-size", type=int, default=5)
    p.add_argument("--delay", type=float, default=10.0, help="seconds between batches")
    p.add_argument("--request-delay", type=float, default=2.0, help="seconds between requests of a batch")
    p.add_argument("--timeout", type=float, default=30.0, help="seconds a request may take")
    p.add_argument("--single-files", action="store_true", help="ordered single files too, for small results")
    p.add_argument("--log-file", help="log there as well as to the console")
    a = p.parse_args(argv)
    if a.export_only and not a.input:
        p.error("--export-only needs --input")
    handlers = [logging.StreamHandler()] + ([logging.FileHandler(a.log_file, encoding="utf-8")] if a.log_file else [])
    log = logging.getLogger("lexspark")
    log.setLevel(logging.INFO)
    for h in handlers:
        h.setFormatter(logging.Formatter("%(asctime)s - %(name)s - %(levelname)s - %(message)s"))
        log.addHandler(h)
    try:
        if spark is None:
            from pyspark.sql import SparkSession

            from lexspark.session import local_session

            spark = SparkSession.getActiveSession() or local_session()
        if a.export_only:
            result = _export(spark, a)
        else:
            config = FetchConfig(batch_size=a.batch_size, delay_between_batches=a.delay, delay_between_requests=a.request_delay, request_timeout=a.timeout)
            run = LawRun(spark, input_file=a.input, urls_file=a.urls, output_dir=a.output, config=config, single_files=a.single_files)
            result = run.run(not a.undated, 2000 if a.min_year is None else a.min_year, a.max_year, a.max_documents)
    finally:
        for h in handlers:
            log.removeHandler(h)
            h.close()
    print(json.dumps(result, ensure_ascii=False))
    return result


if __name__ == "__main__":
    main()
