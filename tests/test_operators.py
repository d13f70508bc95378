import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lexspark.operators import batching as B
from lexspark.operators import fetch as E
from lexspark.operators import laws as O
from lexspark.operators import reports as R
from lexspark.schema import FETCH_RESULT, LAW_DOCUMENT


def laws(spark, rows):
    """rows: (number, date, year[, urn])"""
    full = [(i, "f", r[0], r[1], r[2], "t", r[3] if len(r) > 3 else f"urn:lex:br:federal:lei:{r[1] or '1900-01-01'};{r[0]}", "c") for i, r in enumerate(rows)]
    return spark.createDataFrame(full, LAW_DOCUMENT)


def results(spark, rows):
    return spark.createDataFrame([(i, 0, "u", n, ok, t, e) for i, (n, ok, t, e) in enumerate(rows)], FETCH_RESULT)


def test_filters(spark):
    d = laws(spark, [("123", "2020-01-01", "2020"), ("456", "2021-01-01", "2021"), ("7", None, None)])
    assert O.filter_laws(d, require_date=True).count() == 2
    assert [r.number for r in O.filter_laws(d, min_year=2021).collect()] == ["456"]
    assert [r.number for r in O.filter_laws(d, True, max_year=2020).collect()] == ["123"]
    assert O.filter_laws(d, min_year=0).count() == 3
    bad = laws(spark, [("1", None, "invalid_year"), ("2", None, ""), ("3", None, None), ("4", "x", "3000")])
    assert O.filter_laws(bad, min_year=2021, strict=False).count() == 0
    with pytest.raises(Exception, match="unparsable year"):
        O.filter_laws(bad, min_year=2021).collect()


def test_first_n(spark):
    d = laws(spark, [(str(i), None, None) for i in range(9)])
    assert [r.number for r in O.first_n(d, 3).orderBy("ord").collect()] == ["0", "1", "2"]
    assert O.first_n(d, 0).count() == O.first_n(d, None).count() == 9
    with pytest.raises(ValueError):
        O.first_n(d, -1)


@pytest.mark.parametrize("n,size", [(0, 3), (1, 1), (9, 3), (10, 3), (5, 100)])
def test_batches_against_slices(spark, n, size):
    rng = random.Random(n)
    ords = rng.sample(range(1000), n)
    d = spark.createDataFrame([(x,) for x in ords], "ord long")
    got = {r.ord: r.batch for r in B.batches(d, size).collect()}
    assert got == {x: i // size for i, x in enumerate(sorted(ords))}
    ranked = B.global_rank(d, bin_width=7).collect()
    assert {r.ord: r["rank"] for r in ranked} == {x: i for i, x in enumerate(sorted(ords))}
    if n:
        sizes = B.batch_sizes(B.batches(d, size)).collect()
        assert sum(r["size"] for r in sizes) == n and {r.batches for r in sizes} == {-(-n // size)}


def test_batches_need_a_size(spark):
    with pytest.raises(ValueError):
        B.batches(spark.range(3).withColumnRenamed("id", "ord"), 0)


def test_stats(spark):
    assert R.corpus_stats(laws(spark, [])).count() == 0
    r = R.corpus_stats(laws(spark, [("1", "1990-01-01", "1990"), ("2", "2001-01-01", "2001"), ("3", None, None)])).first()
    assert (r.total_laws, r.laws_with_dates, r.laws_without_dates, r.date_coverage_percent, r.year_range) == (3, 2, 1, 66.67, "1990-2001")
    assert R.corpus_stats(laws(spark, [("1", None, None)])).first().year_range == "N/A"
    h = R.decade_histogram(laws(spark, [("1", "x", "1999"), ("2", "x", "1990"), ("3", "x", "2001"), ("4", None, "2001")])).collect()
    assert [(x.decade, x.n_laws) for x in h] == [(1990, 2), (2000, 1)]


def test_validation(spark):
    d = laws(spark, [("1", "2000-01-01", "2000"), ("2", None, None), ("3", None, None, "urn:x"), ("4", None, None, None)])
    r = R.urn_validation(d).first()
    assert (r.total_laws, r.valid_urns, r.invalid_urns, r.placeholder_dates, r.success_rate) == (4, 2, 2, 1, 50.0)
    m = [x.message for x in R.validation_errors(d).orderBy("ord").collect()]
    assert m[0] == "Lei 2: Using placeholder date (no date found)" and m[1] == "Lei 3: Invalid URN format: urn:x" and len(m) == 3
    assert R.urn_validation(laws(spark, [])).first().success_rate == 0


def test_fetch_reports(spark):
    d = laws(spark, [("1", None, None), ("1", "2001-01-01", "2001"), ("2", "2002-01-01", "2002"), ("3", "2002-01-01", "2002")])
    f = results(spark, [("1", True, 1.0, None), ("2", True, 2.0, None), ("2", True, None, None), ("9", True, 1.0, None), ("3", False, 0.5, "e"), (None, None, 0.0, None)])
    s = R.fetch_summary(f).first()
    assert (s.total_fetch_attempts, s.successful_fetches, s.failed_fetches, s.success_rate) == (6, 4, 2, 66.67)
    t = R.fetch_timing(f).first()
    assert (t.total_fetch_time, t.average_fetch_time) == (4.5, 0.75)
    # Number 1 is credited to its first law, which has no year.
    assert sorted(map(tuple, R.year_success(d, f).collect())) == [("2001", 1, 0), ("2002", 2, 2)]
    assert R.fetch_failures(f).count() == 2
    e = R.fetch_summary(results(spark, [])).first()
    assert e.total_fetch_attempts == 0 and e.success_rate == 0
    assert tuple(R.fetch_timing(results(spark, [])).first()) == (0.0, 0.0)


def test_numbers_sort_as_texts(spark):
    d = laws(spark, [("9", None, None), ("10", None, None), ("9", None, None)])
    assert [tuple(r) for r in O.sorted_numbers(d).collect()] == [("10", 1), ("9", 0), ("9", 2)]


def test_sets(spark):
    u = lambda *x: spark.createDataFrame([(a,) for a in x], "url string")
    assert sorted(r.url for r in O.retry_set(u("a", "b", "b", "c"), u("a")).collect()) == ["b", "c"]
    a, b = laws(spark, [("1", None, None), ("2", None, None)]), laws(spark, [("2", None, None), ("2", None, None), ("3", None, None)])
    assert {tuple(r) for r in O.same_numbers(a, b).collect()} == {("1", "left"), ("3", "right")}


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # as a client of the user's own would have to be


class Broken:
    def fetch(self, url):
        if url.endswith("3"):
            raise OSError("down")
        return True, None

    def close(self):
        pass


QUICK = dict(delay_between_batches=0, delay_between_requests=0, retry_delay=0)


@pytest.mark.parametrize("drop", [False, True])
def test_fetch_isolates_requests(spark, drop):
    d = laws(spark, [(str(i), "2000-01-01", "2000") for i in range(6)])
    got = E.fetch(d, E.FetchConfig(batch_size=2, drop_failed_batches=drop, **QUICK), Broken).orderBy("ord").collect()
    assert [(r.ord, r.success) for r in got] == ([(i, i != 3) for i in range(6)] if not drop else [(i, True) for i in (0, 1, 4, 5)])
    assert [r.batch for r in got] == [r.ord // 2 for r in got]
    assert drop or got[3].error_message == "OSError: down" and got[2].success


class Shaky:
    def __init__(self):
        self.calls = []

    def fetch(self, url):
        self.calls.append(url)
        if self.calls.count(url) < 3:
            raise OSError("shaky")
        return True, None


def test_requests_are_repeated_and_batches_are_whole():
    client, config = Shaky(), E.FetchConfig(batch_size=2, retry_attempts=3, **QUICK)
    rows = [(i, str(i), f"u{i}", i // 2) for i in range(5)]
    got = list(E._fetch_rows(client, iter(rows), config))
    assert [[r[0] for r in b] for b in got] == [[0, 1], [2, 3], [4]] and all(r[4] for b in got for r in b)
    assert len(client.calls) == 15
    once = list(E._fetch_rows(Shaky(), iter(rows), E.FetchConfig(retry_attempts=1, drop_failed_batches=True, **QUICK)))
    assert once == [[], [], []] and list(E._fetch_rows(Shaky(), iter([]), config)) == [[]]


def test_waits(monkeypatch):
    waits = []
    monkeypatch.setattr(E.time, "sleep", waits.append)
    rows = [(i, str(i), f"u{i}", i // 2) for i in range(4)]
    list(E._fetch_rows(E.OfflineClient(0), iter(rows), E.FetchConfig(partitions=3)))
    assert waits == [6.0, 15.0, 6.0]
    waits.clear()
    list(E._fetch_rows(E.OfflineClient(100), iter(rows[:1]), E.FetchConfig(retry_attempts=4)))
    assert waits == [1.0, 2.0, 4.0]


def test_no_client(spark):
    with pytest.raises(ValueError, match="no fetch client"):
        E.fetch(laws(spark, []), make_client=None)


def test_offline_client_is_deterministic(spark):
    d = laws(spark, [(str(i), "2000-01-01", "2000") for i in range(20)])
    c = E.FetchConfig(batch_size=5, partitions=3, **QUICK)
    a, b = (E.fetch(d, c).select("ord", "success").orderBy("ord").collect() for _ in range(2))
    assert a == b and len(a) == 20
    assert E.fetch(d.limit(0), c).count() == 0


def test_export_has_no_content(spark):
    r = O.export_rows(laws(spark, [("1", None, None)])).first()
    assert r.url == "https://normas.leg.br/?urn=urn:lex:br:federal:lei:1900-01-01;1" and "original_content" not in r.asDict()
    assert F is not None
