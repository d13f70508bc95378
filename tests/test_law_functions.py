import pytest
from pyspark.sql import functions as F

from lexspark.functions import law as L
from lexspark.operators import laws as O

CASES = [
    ("Lei n° 10.406, de 10 de janeiro de 2002 - Código Civil.txt", "", ("10406", "2002-01-10", "2002")),
    ("Lei n° 8.112, de 11 de dezembro de 1990.txt", "", ("8112", "1990-12-11", "1990")),
    ("Lei nº 1, de 1º de março de 2001.txt", "", ("1", "2001-03-01", "2001")),
    ("Lei nº 2, de 1 de MARÇO de 2001.txt", "", ("2", "2001-03-01", "2001")),
    ("Lei nº 5, de 5 de foo de 2001.txt", "", ("5", "2001-01-05", "2001")),
    ("Lei nº 6, de 31 de fevereiro de 2002.txt", "", ("6", "2002-02-31", "2002")),
    ("Lei nº 1.301.txt", "em 31 de dezembro de 1973", ("1301", "1973-12-31", "1973")),
    ("Lei nº 9.430 de 27 de dezembro de 1996.txt", "x", ("9430", None, None)),
    ("Lei nº 77.txt", "sem data", ("77", None, None)),
    ("Lei nº 78.txt", "a" * 1000 + " 3 de maio de 1990", ("78", None, None)),
    ("Lei nº 79.txt", "a" * 980 + " 3 de maio de 1990", ("79", "1990-05-03", "1990")),
    ("Lei nº ..txt", "", ("", None, None)),
    ("Lei nº 8, de 3 de maio de 1990.txt", "", ("8", "1990-05-03", "1990")),
    ("Lei Complementar nº 123.txt", "x", None),
    ("Código Eleitoral.txt", "", None),
    ("Lei no 9.430.txt", "", None),
]


@pytest.mark.parametrize("filename,content,want", CASES)
def test_extraction(spark, filename, content, want):
    d = spark.createDataFrame([(1, filename, content)], "ord long, filename string, filedata string")
    got = O.process_documents(d).collect()
    assert [(r.number, r.date, r.year) for r in got] == ([] if want is None else [want])
    rejected = O.rejects(d).count()
    assert rejected == (want is None)


def test_predicate(spark):
    names = ["Decreto-Lei nº 5.452.txt", "Portaria 1 da lei.txt", "LEI 1", "Instrução da lei", "Resolução lei", "Medida lei", None, ""]
    d = spark.createDataFrame([(x,) for x in names], "f string")
    assert [r[0] for r in d.select(L.is_law(F.col("f"))).collect()] == [False, False, True, False, False, False, False, False]


TITLES = [
    ("Lei nº 8.txt", "", "Lei nº 8"),
    ("Lei nº 8.txt", "Lei nº 8, de X", "Lei nº 8, de X"),
    ("Lei nº 8.txt", "Lei nº 8, de junho", "Lei nº 8, de ju"),
    ("Lei nº 8.txt", "Lei nº 8\nABCD", "Lei nº 8\nABCD"),
    ("Lei nº 8.txt.txt", "", "Lei nº 8"),
    ("Lei nº 8 e mais texto.txt", "Lei nº 8", "Lei nº 8 e mais texto"),
    ("a.txt", "Lei de abertura geral do teste", "Lei de abertura geral do teste"),
]


@pytest.mark.parametrize("filename,content,want", TITLES)
def test_titles(spark, filename, content, want):
    d = spark.createDataFrame([(filename, content)], "f string, c string")
    assert d.select(L.title(F.col("f"), F.col("c"))).first()[0] == want


BASE = "https://normas.leg.br/?urn=urn:lex:br:federal:"
URLS = [
    (BASE + "lei:2020-01-01;12345", ("12345", "2020-01-01", "2020", "Lei nº 12345")),
    (BASE + "decreto.lei:1943-05-01;5452", ("5452", "1943-05-01", "1943", "Decreto Lei nº 5452")),
    (BASE + "lei.complementar:2001-05-29;109", ("109", "2001-05-29", "2001", "Lei Complementar nº 109")),
    (BASE + "lei:1900-01-01;77", ("77", None, None, "Lei nº 77")),
    (BASE + "lei:---;5", ("5", "---", "", "Lei nº 5")),
    ("  " + BASE + "lei:2020-01-01;1 texto ", ("1", "2020-01-01", "2020", "Lei nº 1")),
    (BASE + "lei:invalid-date;123", None),
    (BASE + "lei:2020-01-01;invalid", None),
    ("completely:malformed:urn", None),
    ("# comment", None),
    ("   ", None),
    (None, None),
]


@pytest.mark.parametrize("url,want", URLS)
def test_urls(spark, url, want):
    d = spark.createDataFrame([(1, url)], "ord long, url string")
    got = O.laws_from_urls(d).collect()
    assert [(r.number, r.date, r.year, r.title) for r in got] == ([] if want is None else [want])
    if want:
        assert got[0].filename == f"Lei {want[0]} from URL" and got[0].original_content == ""
        assert got[0].urn == url.strip().split("urn=")[1]


def test_years_and_urns(spark):
    d = spark.createDataFrame([("1799",), ("1800",), ("2100",), ("2101",), ("x",), ("",), (None,), ("２０２０",)], "y string")
    assert [r[0] for r in d.select(L.is_valid_year(F.col("y"))).collect()] == [False, True, True, False, False, False, False, True]
    assert d.select(L.decade(F.col("y"))).collect()[1][0] == 1800
    u = spark.createDataFrame([("urn:lex:br:federal:lei:x",), ("urn:lex:br:federal:portaria:x",), (None,)], "u string")
    assert [r[0] for r in u.select(L.is_valid_urn(F.col("u"))).collect()] == [True, False, False]
