"""The engine's own queries and, beside each, the SQL that must give the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.functions import law as L
from lexspark.operators import batching as B
from lexspark.operators import fetch as E
from lexspark.operators import laws as O
from lexspark.operators import reports as R
from lexspark.session import shared_dir
from lexspark.sinks import writers as W
from lexspark.sources import readers as S
from lexspark.sources.readers import table
from lexspark.streaming.laws import windowed_success


def _raw(s, d) -> DataFrame:
    return table(s, d, "raw_documents")


def _laws(s, d) -> DataFrame:
    return O.process_documents(_raw(s, d))


def _stored(s, d) -> DataFrame:
    return table(s, d, "law_documents")


def _urls(s, d) -> DataFrame:
    return table(s, d, "law_urls")


def _url_laws(s, d) -> DataFrame:
    return O.laws_from_urls(_urls(s, d))


def _results(s, d) -> DataFrame:
    return table(s, d, "fetch_results")


def _filename_date(s, d):
    return _raw(s, d).select("ord", L.filename_date(F.col("filename")).alias("i")).where("i is not null").select("ord", "i.*")


def _content_date(s, d):
    return _raw(s, d).select("ord", L.content_date(F.col("filedata")).alias("i")).where("i is not null").select("ord", "i.*")


def _info(s, d):
    return _raw(s, d).where(L.is_law(F.col("filename"))).select("ord", L.law_info(F.col("filename"), F.col("filedata")).alias("i")).where("i is not null").select("ord", "i.*")


def _extract_title(s, d):
    return _raw(s, d).select("ord", L.title(F.col("filename"), F.col("filedata")).alias("title"))


def _urn_url(s, d):
    return _stored(s, d).select("ord", L.construct_urn(F.col("number"), F.col("date")).alias("urn")).withColumn("url", L.construct_url(F.col("urn")))


def _no_content(df):
    return df.drop("original_content")


def _batches(s, d):
    return B.batches(_url_laws(s, d).select("ord", "number"), 10)


def _retry(s, d):
    r = _results(s, d).where(~F.coalesce("success", F.lit(False))).where("url is not null")
    return O.retry_set(r.where("batch % 2 = 0"), r.where("batch % 2 = 1"))


def _folder(s, name: str) -> str:
    return f"{shared_dir(s)}/{name}-{uuid.uuid4().hex}"


def _url_round_trip(s, d):
    """The addresses of all laws as a list of lines, read again."""
    path = _folder(s, "urls")
    W.write_url_lines(_laws(s, d), path)
    return S.read_urls_file(s, path).select("number", "date", "year", "title", "urn")


def _json_round_trip(s, d):
    """K1: the export as JSON lines, read again."""
    path = _folder(s, "export")
    rows = O.export_rows(_laws(s, d))
    W.write_json_lines(rows, path)
    return s.read.schema(rows.schema).json(path)


def _documents_round_trip(s, d):
    """The documents as JSON lines, read again."""
    path = _folder(s, "documents")
    W.write_json_lines(_raw(s, d), path)
    return S.read_json_lines(s, path)


def _report_round_trip(s, d):
    """K6 and K7: results and failed addresses as files, read again and counted."""
    path = _folder(s, "reports")
    results = _results(s, d).drop("fetched_at")
    results.write.option("header", True).csv(path + "/results")
    R.fetch_failures(results).where("url IS NOT NULL").select("url").write.text(path + "/failed")
    failed = s.read.text(path + "/failed").agg(F.count("*").alias("failed_urls"))
    back = s.read.option("header", True).schema(results.schema).csv(path + "/results")
    return R.fetch_summary(back).crossJoin(F.broadcast(failed))  # one row each


def _offline(s, d):
    quick = E.FetchConfig(batch_size=100, delay_between_batches=0, delay_between_requests=0, retry_delay=0, partitions=8)
    return E.fetch(_url_laws(s, d), quick).select("ord", "batch", "url", "law_number", "success", "error_message")


QUERIES = {
    "law_filter": lambda s, d: _raw(s, d).where(L.is_law(F.col("filename"))).select("ord", "filename"),
    "law_filter_text": lambda s, d: table(s, d, "documents").where(L.is_law(F.col("text"))).select("doc_id"),
    "extract_filename_date": _filename_date,
    "extract_content_date": _content_date,
    "extract_info": _info,
    "construct_urn_url": _urn_url,
    "parse_urn_url": _url_laws,
    "extract_title": _extract_title,
    "process_laws": _laws,
    "rejected_docs": lambda s, d: O.rejects(_raw(s, d)),
    "filter_dated": lambda s, d: _no_content(O.filter_laws(_stored(s, d), require_date=True)),
    "filter_years_strict": lambda s, d: _no_content(O.filter_laws(_stored(s, d), min_year=1990, max_year=2010)),
    "filter_years_tolerant": lambda s, d: O.filter_laws(_url_laws(s, d), min_year=2000, max_year=2020, strict=False).select("ord", "number", "year"),
    "first_n": lambda s, d: O.first_n(O.filter_laws(_stored(s, d), require_date=True, min_year=2000), 20).select("ord", "number", "year"),
    "export_projection": lambda s, d: O.export_rows(_laws(s, d)),
    "urls_list": lambda s, d: O.urls(_stored(s, d)),
    "urns_list": lambda s, d: O.urns(_stored(s, d)),
    "sorted_numbers": lambda s, d: O.sorted_numbers(_stored(s, d)),
    "input_check": lambda s, d: S.document_check(_raw(s, d)),
    "url_round_trip": _url_round_trip,
    "json_round_trip": _json_round_trip,
    "documents_round_trip": _documents_round_trip,
    "report_round_trip": _report_round_trip,
    "title_keyword": lambda s, d: _stored(s, d).where(L.title_has(F.col("title"), "imposto")).select("ord", "title"),
    "display_sample": lambda s, d: O.first_n(_stored(s, d), 10).select("ord", L.display(F.col("number"), F.col("title")).alias("line")),
    "corpus_stats": lambda s, d: R.corpus_stats(_laws(s, d)),
    "decade_histogram": lambda s, d: R.decade_histogram(_laws(s, d)),
    "year_counts": lambda s, d: R.year_counts(_laws(s, d)),
    "urn_validation": lambda s, d: R.urn_validation(_url_laws(s, d)),
    "validation_errors": lambda s, d: R.validation_errors(_url_laws(s, d)),
    "batches": _batches,
    "batch_sizes": lambda s, d: B.batch_sizes(_batches(s, d)),
    "batch_success": lambda s, d: R.batch_success(_results(s, d)),
    "fetch_summary": lambda s, d: R.fetch_summary(_results(s, d)),
    "fetch_timing": lambda s, d: R.fetch_timing(_results(s, d)),
    "fetch_failures": lambda s, d: R.fetch_failures(_results(s, d)),
    "year_success": lambda s, d: R.year_success(_stored(s, d), _results(s, d)),
    "final_result": lambda s, d: R.final_result(_stored(s, d), _results(s, d)),
    "retry_set": _retry,
    "mode_parity": lambda s, d: O.same_numbers(_stored(s, d), _url_laws(s, d)),
    "sample_law_count": lambda s, d: O.first_n(_raw(s, d).select("ord", "filename"), 10).agg(F.count_if(L.is_law(F.col("filename"))).alias("laws_in_sample")),
    "windowed_success": lambda s, d: windowed_success(_results(s, d)),
    "offline_fetch": _offline,
}

# ---- the same in SQL. Patterns and values are written out here once more, for RE2, so that a slip in the engine's own
# shows as a difference. Flags are an argument there ('i'), and replacement of all matches needs 'g'.


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


# Fixed values.
_BLANK = r"[\t\n\v\f\r \x1C-\x1F\x{85}\p{Z}]"
_DAY = rf"(\p{{Nd}}{{1,2}})[°ºª]?{_BLANK}*de{_BLANK}*([\p{{L}}\p{{N}}_]+){_BLANK}*de{_BLANK}*(\p{{Nd}}{{4}})"
_P1 = _q(rf"le[iı] n[º°]{_BLANK}*([\d.]+),{_BLANK}*de{_BLANK}*{_DAY}")
_P2, _PC = _q(rf"le[iı] n[º°]{_BLANK}*([\d.]+)"), _q(_DAY)
_PA, _PB = _q(rf"le[iı] n[º°]{_BLANK}*[\d.]+[^\\n]*"), _q(r"le[iı] [^\\n]{20,100}")
_PU = _q(r"urn:lex:br:federal:(lei|lei\.complementar|decreto\.lei):([\d-]+);(\p{Nd}+)")
_WS = _q(f"^{_BLANK}+|{_BLANK}+$")
_MONTHS = "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro".split()
_MONTH = "CASE lower({}) " + " ".join(f"WHEN '{m}' THEN '{i:02}'" for i, m in enumerate(_MONTHS, 1)) + " ELSE '01' END"
_IS_LAW = "(contains(lower({0}), 'lei')" + "".join(f" AND NOT contains(lower({{0}}), '{x}')" for x in ("decreto", "portaria", "medida", "instrução", "resolução")) + ")"


def _date(t: str, p: str, i: int) -> str:
    g = lambda k: f"regexp_extract({t}, {p}, {k}, 'i')"
    return f"{g(i + 2)} || '-' || {_MONTH.format(g(i + 1))} || '-' || lpad({g(i)}, 2, '0')"


def _int(c: str) -> str:
    return f"try_cast(translate(regexp_replace({c}, {_WS}, '', 'g'), '０１２３４５６７８９', '0123456789') AS INTEGER)"


_HEAD = f"substring(filedata, 1, 1000)"
_M1, _M2, _MC = f"regexp_matches(filename, {_P1}, 'i')", f"regexp_matches(filename, {_P2}, 'i')", f"regexp_matches({_HEAD}, {_PC}, 'i')"
_INFO = f"""
    CASE WHEN {_M1} THEN replace(regexp_extract(filename, {_P1}, 1, 'i'), '.', '') ELSE replace(regexp_extract(filename, {_P2}, 1, 'i'), '.', '') END AS number,
    CASE WHEN {_M1} THEN {_date("filename", _P1, 2)} WHEN {_MC} THEN {_date(_HEAD, _PC, 1)} END AS date,
    CASE WHEN {_M1} THEN regexp_extract(filename, {_P1}, 4, 'i') WHEN {_MC} THEN regexp_extract({_HEAD}, {_PC}, 3, 'i') END AS year"""
_T200 = f"substring(filedata, 1, 200)"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, {_WS}, '', 'g')"


_TITLES = f"""
    SELECT ord, {_strip("CASE WHEN length(f) > length(b) AND length(f) < 200 THEN f ELSE b END")} AS title FROM (
      SELECT ord, replace(filename, '.txt', '') AS b, {_strip(f"CASE WHEN regexp_matches({_T200}, {_PA}, 'i') THEN regexp_extract({_T200}, {_PA}, 0, 'i') WHEN regexp_matches({_T200}, {_PB}, 'i') THEN regexp_extract({_T200}, {_PB}, 0, 'i') END")} AS f
      FROM raw_documents)"""
_URN = f"'urn:lex:br:federal:lei:' || coalesce(nullif(date, ''), '1900-01-01') || ';' || number"
_CTE = f"""info AS (SELECT ord, filename, filedata, {_INFO} FROM raw_documents WHERE {_IS_LAW.format("filename")} AND {_M2}),
  titles AS ({_TITLES}),
  laws AS (SELECT i.ord, filename, number, date, year, title, {_URN} AS urn, filedata AS original_content FROM info i JOIN titles t ON i.ord = t.ord),
  parts AS (SELECT ord, split_part(regexp_replace(url, {_WS}, '', 'g'), 'urn=', 2) AS urn FROM law_urls),
  url_laws AS (SELECT ord, 'Lei ' || n || ' from URL' AS filename, n AS number, d AS date, split_part(d, '-', 1) AS year, t || ' nº ' || n AS title, urn, '' AS original_content FROM (
    SELECT ord, urn, regexp_extract(urn, {_PU}, 3) AS n, nullif(regexp_extract(urn, {_PU}, 2), '1900-01-01') AS d,
      CASE regexp_extract(urn, {_PU}, 1) WHEN 'lei' THEN 'Lei' WHEN 'lei.complementar' THEN 'Lei Complementar' WHEN 'decreto.lei' THEN 'Decreto Lei' END AS t FROM parts WHERE regexp_matches(urn, {_PU}))),
  stored AS (SELECT * FROM law_documents)"""
_VALID = "coalesce(" + " OR ".join(f"starts_with(urn, 'urn:lex:br:federal:{x}:')" for x in ("lei", "lei.complementar", "decreto.lei")) + ", false)"
_OK = "coalesce(success, false)"


def _w(select: str) -> str:
    return f"WITH {_CTE} {select}"


_TRUE = "({0} IS NOT NULL AND {0} <> '')"
_STATS = f"""SELECT count(*) AS total_laws, count_if({_TRUE.format("date")}) AS laws_with_dates, count(*) - count_if({_TRUE.format("date")}) AS laws_without_dates,
  round_even(count_if({_TRUE.format("date")}) / nullif(count(*), 0) * 100, 2) AS date_coverage_percent,
  CASE WHEN min({_int("year")}) <> 0 AND max({_int("year")}) <> 0 THEN min({_int("year")}) || '-' || max({_int("year")}) ELSE 'N/A' END AS year_range,
  min({_int("year")}) AS earliest_year, max({_int("year")}) AS latest_year FROM laws HAVING count(*) > 0"""
_VALIDATION = f"""SELECT count(*) AS total_laws, count_if({_VALID}) AS valid_urns, count(*) - count_if({_VALID}) AS invalid_urns,
  count_if({_VALID} AND contains(urn, '1900-01-01')) AS placeholder_dates, coalesce(round_even(count_if({_VALID}) / nullif(count(*), 0) * 100, 2), 0) AS success_rate FROM {{}}"""
_SUMMARY = f"""SELECT count(*) AS total_fetch_attempts, count_if({_OK}) AS successful_fetches, count(*) - count_if({_OK}) AS failed_fetches,
  coalesce(round_even(count_if({_OK}) / nullif(count(*), 0) * 100, 2), 0) AS success_rate FROM fetch_results"""
_BATCHES = "SELECT ord, number, CAST((row_number() OVER (ORDER BY ord) - 1) // 10 AS INTEGER) AS batch FROM url_laws"
_SHORT = "ord, filename, number, date, year, title, urn"

ORACLE = {
    "law_filter": f"SELECT ord, filename FROM raw_documents WHERE {_IS_LAW.format('filename')}",
    "law_filter_text": f"SELECT doc_id FROM documents WHERE {_IS_LAW.format('text')}",
    "extract_filename_date": f"SELECT ord, number, date, year FROM (SELECT ord, {_INFO} FROM raw_documents WHERE {_M1})",
    "extract_content_date": f"SELECT ord, {_date(_HEAD, _PC, 1)} AS date, regexp_extract({_HEAD}, {_PC}, 3, 'i') AS year FROM raw_documents WHERE {_MC}",
    "extract_info": _w("SELECT ord, number, date, year FROM info"),
    "construct_urn_url": f"SELECT ord, {_URN} AS urn, 'https://normas.leg.br/?urn=' || {_URN} AS url FROM law_documents",
    "parse_urn_url": _w("SELECT * FROM url_laws"),
    "extract_title": _TITLES,
    "process_laws": _w("SELECT * FROM laws"),
    "rejected_docs": f"SELECT ord, filename FROM raw_documents WHERE {_IS_LAW.format('filename')} AND NOT {_M2}",
    "filter_dated": f"SELECT {_SHORT} FROM law_documents WHERE {_TRUE.format('date')}",
    "filter_years_strict": f"SELECT {_SHORT} FROM law_documents WHERE {_int('year')} BETWEEN 1990 AND 2010",
    "filter_years_tolerant": _w(f"SELECT ord, number, year FROM url_laws WHERE {_int('year')} BETWEEN 2000 AND 2020"),
    "first_n": f"SELECT ord, number, year FROM law_documents WHERE {_TRUE.format('date')} AND {_int('year')} >= 2000 ORDER BY ord LIMIT 20",
    "export_projection": _w(f"SELECT {_SHORT}, 'https://normas.leg.br/?urn=' || urn AS url FROM laws"),
    "urls_list": f"SELECT ord, 'https://normas.leg.br/?urn=' || urn AS url FROM law_documents",
    "urns_list": "SELECT ord, urn FROM law_documents",
    "sorted_numbers": "SELECT number, ord FROM law_documents",
    "input_check": "SELECT count(*) AS rows, count_if(filename IS NULL) AS no_filename, count_if(filedata IS NULL) AS no_filedata FROM raw_documents",
    "url_round_trip": _w(f"SELECT regexp_extract(urn, {_PU}, 3) AS number, date, split_part(date, '-', 1) AS year, 'Lei nº ' || regexp_extract(urn, {_PU}, 3) AS title, urn FROM laws WHERE regexp_matches(urn, {_PU})"),
    "json_round_trip": _w(f"SELECT {_SHORT}, 'https://normas.leg.br/?urn=' || urn AS url FROM laws"),
    "documents_round_trip": "SELECT ord, filename, filedata FROM raw_documents",
    "report_round_trip": f"SELECT s.*, f.failed_urls FROM ({_SUMMARY}) s, (SELECT count(*) AS failed_urls FROM fetch_results WHERE NOT {_OK} AND url IS NOT NULL) f",
    "offline_fetch": _w(f"""SELECT b.ord, b.batch, u.url, b.number AS law_number, ok AS success, CASE WHEN NOT ok THEN 'offline: not available' END AS error_message FROM (
      SELECT ord, number, CAST((row_number() OVER (ORDER BY ord) - 1) // 100 AS INTEGER) AS batch FROM url_laws) b
      JOIN (SELECT ord, url, CAST('0x' || substring(md5(url), 1, 8) AS BIGINT) % 100 >= 20 AS ok FROM (SELECT ord, 'https://normas.leg.br/?urn=' || urn AS url FROM url_laws)) u ON b.ord = u.ord"""),
    "title_keyword": "SELECT ord, title FROM law_documents WHERE contains(lower(title), 'imposto')",
    "display_sample": "SELECT ord, CASE WHEN length(number) < 6 THEN lpad(number, 6, ' ') ELSE number END || ' | ' || substring(title, 1, 60) || '...' AS line FROM law_documents ORDER BY ord LIMIT 10",
    "corpus_stats": _w(_STATS),
    "decade_histogram": _w(f"SELECT CAST({_int('year')} // 10 * 10 AS INTEGER) AS decade, count(*) AS n_laws FROM laws WHERE {_TRUE.format('date')} AND {_TRUE.format('year')} GROUP BY 1"),
    "year_counts": _w(f"SELECT year, count(*) AS total, min(ord) AS first_ord FROM laws WHERE {_TRUE.format('year')} GROUP BY year"),
    "urn_validation": _w(_VALIDATION.format("url_laws")),
    "validation_errors": _w(f"SELECT ord, 'Lei ' || number || CASE WHEN NOT {_VALID} THEN ': Invalid URN format: ' || urn ELSE ': Using placeholder date (no date found)' END AS message FROM url_laws WHERE NOT {_VALID} OR contains(urn, '1900-01-01')"),
    "batches": _w(_BATCHES),
    "batch_sizes": _w(f"SELECT batch + 1 AS k, count(*) OVER () AS batches, count(*) AS size FROM ({_BATCHES}) GROUP BY batch"),
    "batch_success": f"SELECT batch, count_if({_OK}) AS successful, count(*) AS total FROM fetch_results GROUP BY batch",
    "fetch_summary": _SUMMARY,
    "fetch_timing": "SELECT CAST(coalesce(sum(CAST(fetch_time AS DECIMAL(18,3))), 0) AS DOUBLE) AS total_fetch_time, coalesce(round_even(CAST(sum(CAST(fetch_time AS DECIMAL(18,3))) AS DOUBLE) / count(*), 2), 0) AS average_fetch_time FROM fetch_results",
    "fetch_failures": f"SELECT ord, url, law_number, error_message AS error FROM fetch_results WHERE NOT {_OK}",
    "year_success": f"""WITH first AS (SELECT number, arg_min(coalesce(year, ''), ord) AS year FROM law_documents WHERE {_TRUE.format("number")} GROUP BY number),
      hits AS (SELECT f.year, count(*) AS n FROM fetch_results r JOIN first f ON r.law_number = f.number WHERE {_OK} GROUP BY f.year)
      SELECT t.year, t.total, coalesce(CAST(n AS BIGINT), 0) AS successful FROM (SELECT year, count(*) AS total FROM law_documents WHERE {_TRUE.format("year")} GROUP BY year) t LEFT JOIN hits h ON t.year = h.year""",
    "final_result": f"SELECT v.total_laws AS laws_processed, s.successful_fetches AS documents_fetched, v.success_rate FROM ({_VALIDATION.format('law_documents')}) v, ({_SUMMARY}) s",
    "retry_set": f"SELECT DISTINCT url FROM fetch_results WHERE NOT {_OK} AND url IS NOT NULL AND batch % 2 = 0 EXCEPT SELECT url FROM fetch_results WHERE NOT {_OK} AND batch % 2 = 1",
    "mode_parity": _w("SELECT number, 'left' AS side FROM (SELECT number FROM stored EXCEPT SELECT number FROM url_laws) UNION ALL SELECT number, 'right' AS side FROM (SELECT number FROM url_laws EXCEPT SELECT number FROM stored)"),
    "sample_law_count": f"SELECT count_if({_IS_LAW.format('filename')}) AS laws_in_sample FROM (SELECT * FROM raw_documents ORDER BY ord LIMIT 10)",
    "windowed_success": f"SELECT date_trunc('hour', fetched_at) AS window_start, count(*) AS attempts, count_if({_OK}) AS successful FROM (SELECT ord, url, fetched_at, bool_or(coalesce(success, false)) AS success FROM fetch_results GROUP BY ord, url, fetched_at) GROUP BY 1",
}
