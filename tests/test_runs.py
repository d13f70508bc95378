import json
import os

import pytest
from pyspark.sql import functions as F

from lexspark.operators.fetch import FetchConfig
from lexspark.operators.laws import process_documents
from lexspark.plans.processor import LawProcessor
from lexspark.plans.run import LawRun
from lexspark.schema import RAW_DOCUMENT
from lexspark.sinks import writers as W
from lexspark.sources import readers as S

DOCS = [
    {"filename": "Lei nº 1, de 2 de maio de 1990.txt", "filedata": "Execução fiscal"},
    {"filename": "Portaria 7.txt", "filedata": "x"},
    {"filename": "Lei nº 2, de 2 de maio de 2005.txt", "filedata": ""},
    {"filename": "Lei nº 3.txt", "filedata": "sem data"},
]
QUICK = FetchConfig(batch_size=2, delay_between_batches=0, delay_between_requests=0, retry_delay=0)


@pytest.fixture
def corpus(tmp_path):
    p = tmp_path / "docs.json"
    p.write_text(json.dumps(DOCS, ensure_ascii=False), encoding="utf-8")
    return str(p)


def test_json_source_keeps_order(spark, corpus):
    got = S.read_json_array(spark, corpus).orderBy("ord").collect()
    assert [r.filename for r in got] == [d["filename"] for d in DOCS]
    assert S.check_documents(S.read_json_array(spark, corpus)) == {"rows": 4, "no_filename": 0, "no_filedata": 0}


@pytest.mark.parametrize("text", ["{", '[{"filename": "a"}]', '{"a": 1}'])
def test_bad_json_fails(spark, tmp_path, text):
    p = tmp_path / "bad.json"
    p.write_text(text)
    with pytest.raises(Exception):  # noqa: B017
        S.read_json_array(spark, str(p)).collect()


def test_missing_files(spark):
    with pytest.raises(FileNotFoundError):
        S.read_json_array(spark, "/nowhere/x.json")
    with pytest.raises(FileNotFoundError):
        S.read_urls_file(spark, "/nowhere/x.txt")


def test_exports_round_trip(spark, corpus, tmp_path):
    laws = process_documents(S.read_json_array(spark, corpus))
    out = str(tmp_path / "laws.json")
    assert W.export_json(laws, out) == 3
    got = json.load(open(out, encoding="utf-8"))
    assert [x["number"] for x in got] == ["1", "2", "3"] and got[2]["date"] is None and "original_content" not in got[0]
    urls = str(tmp_path / "urls.txt")
    assert W.export_urls(laws, urls) == 3
    back = S.read_urls_file(spark, urls).orderBy("ord").collect()
    assert [(r.number, r.date) for r in back] == [("1", "1990-05-02"), ("2", "2005-05-02"), ("3", None)]
    assert W.export_json(laws.limit(0), out) == 0 and json.load(open(out)) == []
    W.write_json_lines(laws, str(tmp_path / "lines"))
    W.write_url_lines(laws, str(tmp_path / "u"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 3


def test_run_writes_reports(spark, corpus, tmp_path):
    out = str(tmp_path / "out")
    r = LawRun(spark, input_file=corpus, output_dir=out, config=QUICK, single_files=True).run(require_date=True)
    assert r["laws_processed"] == 2 and r["success_rate"] == 100.0 and 0 <= r["documents_fetched"] <= 2
    meta = os.path.join(out, "metadata")
    report = json.load(open(os.path.join(meta, "fetch_report.json"), encoding="utf-8"))
    assert report["summary"]["total_laws_processed"] == 2 and set(report["year_statistics"]) == {"1990", "2005"} and report["file_statistics"] == {}
    assert json.load(open(os.path.join(meta, "processed_laws.json"), encoding="utf-8"))[0]["original_content"] == "Execução fiscal"
    assert spark.read.json(os.path.join(meta, "processed_laws")).count() == 2 and {"documents", "logs", "metadata"} <= set(os.listdir(out))
    assert report["failures_total"] == report["summary"]["failed_fetches"] == spark.read.schema("url string").json(os.path.join(meta, "failures")).count()
    failed = os.path.join(meta, "failed_urls.txt")
    assert os.path.exists(failed) == (report["summary"]["failed_fetches"] > 0)


def test_modes_agree(spark, corpus, tmp_path):
    docs = S.read_json_array(spark, corpus)
    laws = process_documents(docs)
    urls = str(tmp_path / "u.txt")
    W.export_urls(laws, urls)
    numbers = [sorted(r.number for r in LawRun(spark, config=QUICK, **x).laws(require_date=False).collect()) for x in ({"input_file": corpus}, {"documents": docs}, {"laws": laws}, {"urls_file": urls})]
    assert numbers == [["1", "2", "3"]] * 4
    assert LawRun(spark, laws=laws, config=QUICK, output_dir=str(tmp_path / "o")).run(require_date=False, max_documents=1)["laws_processed"] == 1


def test_input_checks(spark, corpus):
    with pytest.raises(ValueError, match="exactly one"):
        LawRun(spark, input_file=corpus, urls_file="x")
    with pytest.raises(ValueError):
        LawRun(spark, laws=[None])
    with pytest.raises(ValueError):
        LawRun(spark, urls_file=3)
    with pytest.raises(ValueError, match="No valid input"):
        LawRun(spark, input_file="").laws()
    with pytest.raises(ValueError, match="lacks column"):
        LawRun(spark, laws=spark.range(1)).laws()


def test_stream(spark, tmp_path):
    from lexspark.streaming.laws import stream_laws

    src = str(tmp_path / "in")
    spark.createDataFrame([(i, d["filename"], d["filedata"]) for i, d in enumerate(DOCS)], RAW_DOCUMENT).write.parquet(src)
    q = stream_laws(spark, src).writeStream.format("memory").queryName("laws_stream").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
        assert spark.table("laws_stream").count() == 3
    finally:
        q.stop()


def test_command_line(spark, corpus, tmp_path, capsys):
    from lexspark.__main__ import main

    r = main(["--input", corpus, "--output", str(tmp_path / "o"), "--min-year", "2000", "--delay", "0", "--request-delay", "0", "--log-file", str(tmp_path / "log")], spark)
    assert r["laws_processed"] == 1 and json.loads(capsys.readouterr().out.strip().split("\n")[-1]) == r
    assert "2 with a valid identifier" in (tmp_path / "log").read_text() or "1 with a valid identifier" in (tmp_path / "log").read_text()
    with pytest.raises(SystemExit):
        main(["--output", "x"], spark)
    with pytest.raises(SystemExit):
        main(["--urls", "x", "--export-only"], spark)


def test_export_only(spark, corpus, tmp_path):
    from lexspark.__main__ import main

    out = str(tmp_path / "o")
    r = main(["--input", corpus, "--output", out, "--export-only", "--single-files"], spark)
    assert r["statistics"]["total_laws"] == 3 and len(r["sample"]) == 2
    assert [x["number"] for x in json.load(open(os.path.join(out, "laws.json"), encoding="utf-8"))] == ["1", "2"]
    main(["--input", corpus, "--output", out, "--export-only", "--undated"], spark)
    assert spark.read.json(os.path.join(out, "laws")).count() == 3 == spark.read.text(os.path.join(out, "urls")).count()


def test_processor(spark, corpus, tmp_path):
    p = LawProcessor(spark, corpus)
    for f in (p.get_statistics, p.get_urns, LawRun(spark, processor=p).laws):
        with pytest.raises(ValueError, match="no processed laws"):
            f()
    p.process_documents(check_input=True)
    assert LawRun(spark, processor=p).laws(require_date=False).count() == 3 == p.get_urns().count() == p.get_urls().count()
    assert p.filter_laws_by_criteria(min_year=2000).count() == 1
    empty = LawProcessor(spark, spark.createDataFrame([], RAW_DOCUMENT))
    empty.process_documents()
    assert empty.get_statistics() == {}
    with pytest.raises(ValueError, match="no processed laws"):
        LawRun(spark, processor=empty).run()
    with pytest.raises(ValueError, match="compatible"):
        LawRun(spark, processor="x")
    with pytest.raises(ValueError, match="fetch client"):
        LawRun(spark, processor=p, make_client=None).run()


def test_documents_by_kind_and_gate(spark, corpus, tmp_path):
    docs = S.read_json_array(spark, corpus)
    docs.write.parquet(str(tmp_path / "d.parquet"))
    docs.coalesce(1).write.json(str(tmp_path / "d.jsonl"))
    for name in ("d.parquet", "d.jsonl", "docs.json"):
        assert S.require_documents(S.read_documents(spark, str(tmp_path / name))).count() == 4
    with pytest.raises(FileNotFoundError):
        S.read_documents(spark, "/nowhere/x.parquet")
    holes = spark.createDataFrame([(0, "a", None), (1, None, "b")], "ord long, filename string, filedata string")
    with pytest.raises(ValueError, match="without filename: 1, without filedata: 1, of 2"):
        S.require_documents(spark.createDataFrame(holes.rdd, RAW_DOCUMENT))


def test_lists_in_reports_are_bounded(spark, corpus, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "SAMPLE", 1)
    laws = process_documents(S.read_json_array(spark, corpus))
    laws = laws.withColumn("urn", F.lit("x"))
    v = W.validation_report(laws)
    assert len(v["validation_errors"]) == 1 and v["validation_errors_total"] == 3


def test_windows_take_any_success(spark):
    import datetime as dt

    from lexspark.streaming.laws import windowed_success

    t = dt.datetime(2024, 1, 1, 10, 30)
    rows = [(1, "u", False, t), (1, "u", True, t), (2, "v", None, t), (3, "w", True, None)]
    got = windowed_success(spark.createDataFrame(rows, "ord long, url string, success boolean, fetched_at timestamp")).collect()
    assert [(r.attempts, r.successful) for r in got] == [(2, 1)]


def test_windows_over_a_stream(spark, tmp_path):
    import datetime as dt

    from lexspark.streaming.laws import windowed_success

    schema = "ord long, url string, success boolean, fetched_at timestamp"
    at = lambda h, m: dt.datetime(2024, 1, 1 + h // 24, h % 24, m)
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "u", False, at(10, 30)), (2, "v", None, at(10, 40)), (3, "w", True, at(11, 0))], schema).coalesce(1).write.parquet(src)
    stream = windowed_success(spark.readStream.schema(schema).parquet(src), lateness="2 hours")
    q = stream.writeStream.format("memory").queryName("windows").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
        # The second delivery of the first attempt is late, but within what is waited for.
        spark.createDataFrame([(1, "u", True, at(10, 30)), (4, "x", True, at(40, 0))], schema).coalesce(1).write.mode("append").parquet(src)
        q.processAllAvailable()
        spark.createDataFrame([(5, "y", True, at(44, 0))], schema).coalesce(1).write.mode("append").parquet(src)
        q.processAllAvailable()
        got = {r.window_start: (r.attempts, r.successful) for r in spark.table("windows").collect()}
        assert got[at(10, 0)] == (2, 1) and got[at(11, 0)] == (1, 1)
    finally:
        q.stop()
