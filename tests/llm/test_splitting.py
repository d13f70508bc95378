import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexspark.llm.splitting import split_oversized, split_text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .\n", max_size=600), st.integers(5, 80), st.integers(0, 39))
def test_pieces(text, size, overlap):
    overlap = min(overlap, (size - 1) // 2)
    p = split_text(text, size, overlap)
    assert p[0][0] == 0 and p[-1][1] == len(text)
    assert all(0 <= b - a <= size for a, b in p)
    assert all(q[0] == a[1] - overlap and q[1] > a[1] for a, q in zip(p, p[1:]))


def test_cuts_at_the_topic_boundary():
    a = "O imposto incide sobre a renda do contribuinte. " * 6
    b = "A vacina protege o paciente contra doenças graves. " * 6
    (x, y), *_ = split_text(a + b, 400)
    assert (x, y) == (0, len(a))


TOPICS = ["O imposto incide sobre a renda do contribuinte e a alíquota sobe.", "A vacina protege o paciente contra doenças graves no hospital.", "O atleta venceu o campeonato no estádio diante da torcida."]


def test_a_deep_valley_beats_a_heading():
    a, b = (TOPICS[0] + " ") * 5, (TOPICS[1] + " ") * 5
    text = a + b[: len(TOPICS[1]) * 2 + 2] + "\nArt. 9 " + b + b
    assert split_text(text, 600)[0] == (0, len(a))  # not at the article, which lies within one topic


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(8, 16), min_size=3, max_size=8))
def test_planted_topics_are_found(lengths):
    parts = [(TOPICS[i % 3] + " ") * n for i, n in enumerate(lengths)]
    text, ends, at = "".join(parts), set(), 0
    for p in parts:
        at += len(p)
        ends.add(at)
    for a, b in split_text(text, 1200)[:-1]:
        inside = [e for e in ends if a + 600 <= e <= a + 1200]
        assert not inside or b in ends


def test_words_have_valleys_too():
    a, b = "imposto renda contribuinte " * 12, "vacina hospital paciente " * 12
    assert split_text(a + b, 500)[0] == (0, len(a))


def test_length_alone_changes_nothing():
    text = "".join((TOPICS[i % 3] + " ") * 12 for i in range(9))
    few, many = split_text(text, 1000), split_text(text * 6, 1000)
    assert many[: len(few) - 2] == few[:-2]


def test_prefers_articles_and_falls_back():
    text = "Art. 1º " + "palavra " * 20 + ".\n\nArt. 2º " + "outra coisa " * 20
    assert text[split_text(text, 250)[1][0] :].startswith("Art. 2º")
    assert split_text("x" * 10, 4, 1) == [(0, 4), (3, 7), (6, 10)]
    with pytest.raises(ValueError):
        split_text("abc", 4, 2)


def test_operator(spark):
    rows = [("t", "f", 1, "x" * 10, 1), ("t", "f", 1, "x" * 10, 1), ("t", "f", 2, "", 1), ("t", "f", 3, None, 1), ("t", "g", 4, "y" * 99, 1), ("t", "f", None, "abcd", 1), (None, None, 5, "z" * 50, 1)]
    d = spark.createDataFrame(rows, "src string, fld string, ord long, text string, piece_no int")
    got = split_oversized(d, {("t", "f"): (4, 1)})
    assert got.columns == ["src", "fld", "ord", "piece_no", "start_pos", "end_pos", "piece"]
    by = {}
    for r in got.collect():
        by.setdefault(r.ord, []).append(r.piece)
    assert sorted(by[1]) == ["xxxx"] * 6 and by[2] == [""] and by[None] == ["abcd"] and len(by[4][0]) == 99 and len(by[5][0]) == 50 and 3 not in by
    assert split_oversized(d.limit(0), {("t", "f"): (4, 1)}).count() == 0
