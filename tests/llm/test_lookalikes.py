import pytest

from lexspark.llm.lookalikes import consistent_form

CASES = [
    ("Lei ｎº １２.３４５", "Lei nº 12.345"),
    ("𝐚𝐛𝐫𝐢𝐥 𝖽𝖾 𝚗", "abril de n"),
    ("certiﬁcar Ⅷ", "certificar VIII"),
    ("março", "março"),
    ("fe​verei\xadro⁠", "fevereiro"),
    ("a b c　d", "a b c d"),
    ("Lеi dе mаіо", "Lei de maio"),  # Cyrillic letters in words
    ("parcelar о imposto", "parcelar o imposto"),  # a Cyrillic letter on its own
    ("contrıbuinte ɑtrɑso voɡal", "contribuinte atraso vogal"),
    ("СAPÍTULО", "CAPÍTULO"),
    ("artigo ١٢ da lei", "artigo 12 da lei"),
    # Ordinary: no change.
    ("Lei nº 1, § 2º, 3ª, 4°, m², │ “aspas” – … ‘x’", None),
    ("a medição com coeficiente λ, Vălenor, Nordåvel", None),
    ("Стороны рассматривают, о чём и а также с 12 мая", None),
    ("附件8，总额为：１% 。　次", "附件8，总额为：1% 。　次"),
    ("委員会は「異議はない。」と述べ？", None),
    ("क्‍ष می‌شود", None),
    ("", None),
    ("plain ascii", None),
]


@pytest.mark.parametrize("text,want", CASES)
def test_forms(spark, text, want):
    d = spark.createDataFrame([("s", "f", 1, text, "x")], "src string, fld string, ord long, text string, form string")
    r = consistent_form(d).first()
    assert r.form == (text if want is None else want)
    assert r.is_case == (want is not None and want != text)
    again = spark.createDataFrame([("s", "f", 1, r.form)], "src string, fld string, ord long, text string")
    assert consistent_form(again).first().form == r.form


def test_edges(spark):
    d = spark.createDataFrame([("s", "f", 1, None), (None, None, None, "ａ"), ("s", "f", 2, "ａ"), ("s", "f", 2, "ａ"), ("s", "f", 3, "é" * 200_000 + "ａ")], "src string, fld string, ord long, text string")
    got = consistent_form(d).collect()
    assert len(got) == 5 and [r.form for r in got if r.ord == 1] == [None] and not [r for r in got if r.ord == 1][0].is_case
    assert consistent_form(d, only_cases=True).count() == 4
    assert consistent_form(d.limit(0)).count() == 0


def test_parts_are_bounded_by_bytes(monkeypatch):
    import pyarrow as pa

    from lexspark.llm import lookalikes as X

    monkeypatch.setattr(X, "PART_BYTES", 10)
    b = pa.RecordBatch.from_pydict({"ord": [1, 2, 3, 4, 5], "text": ["aaaa", "bbbb", None, "c" * 30, "d"]})
    assert [p.column("ord").to_pylist() for p in X._parts(b)] == [[1, 2, 3], [4], [5]]
    assert list(X._parts(b.slice(0, 0))) == []
