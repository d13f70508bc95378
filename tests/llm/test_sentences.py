import pytest

from lexspark.llm.sentences import CUT, GUARD, sentence_units

CASES = {
    "abbreviations": ("Vide ac. n. 80520/1976, rel. Des. S. U. Vandrássi, j. 4.6.1997, quanto ao tema. Outra frase.", ["Vide", "Outra"]),
    "company at the end": ("É da Vălenor S.A. Segundo o parecer, cabe. A empresa X S.A. deverá pagar.", ["É da", "Segundo", "A empresa"]),
    "junior": ("Vencido o vogal Taborim Jr. Ficam ressalvadas.", ["Vencido", "Ficam"]),
    "etc": ("Peças etc. quando couber. Mapas etc. O índice subiu.", ["Peças", "Mapas", "O índice"]),
    "lower-case start": ("Lei de 1987. o que se decidiu vale.", ["Lei", "o que"]),
    "label": ("Art. 12. Segundo o parecer.\nParágrafo único. o que vale.", ["Art. 12", "Parágrafo"]),
    "item number": ("O item 8.2.4. do anexo vale. Fim.", ["O item", "Fim"]),
    "decimals": ("O valor é R$ 1.234,56. Depois 3.14 vale.", ["O valor", "Depois"]),
    "quoted": ("Disse: “É livre. Nada obsta.”, regra válida. Disse o perito: “Não convém.” A sessão abriu.", ["Disse: “É", "Disse o", "A sessão"]),
    "straight quotes": ('Indagou "Quem responde? O gestor?" e concluiu. Fim.', ["Indagou", "Fim"]),
    "brackets": ("(Esta ressalva consta da ata 1.684.) A sessão abriu.", ["(Esta", "A sessão"]),
    "omission": ("O texto (“(...) o prazo ... será revisto”) foi mantido. Fim.", ["O texto", "Fim"]),
    "ellipsis": ("Se o saldo bastar... caberá plantar. Foi mantida... É vedado.", ["Se o", "Foi", "É vedado"]),
    "glued": ("Previsto no anexo.Na fiscalização houve 5.Os autos seguem. Deu-se em 2005?!É certo.", ["Previsto", "Na", "Os autos", "Deu-se", "É certo"]),
    "lines": ("São exigidos:\nI - prazo;\nII - relação; e\na) prova.", ["São", "I -", "II -", "a)"]),
    "crlf": ("DAS SANÇÕES\r\nArt. 1º Vale.\r\n\r\nSala.", ["DAS", "Art. 1º", "Sala"]),
    "wrapped": ("As despesas com a bolsa de iniciação científica correrão à conta da dotação,\nno montante de R$ 2. Será\npublicado o ato:\na) que regula\no tema; e\nb) outro.", ["As", "Será", "a)", "b)"]),
    "inline items": ("São requisitos: I - idade mínima; II - prova. Fim.", ["São", "Fim"]),
    "chinese": ("附件8总额为767.536元。代表表示：“没有异议。请通过。”，随后通过。是否适用？", ["附件", "代表", "是否"]),
    "japanese": ("委員会は「異議はない。承認する。」と述べた。次に進む！", ["委員", "次に"]),
    "thai": ("อัตราร้อยละ1.359ไม่ใช้กับมาตรการ ให้แจ้งบทเฉพาะกาล", ["อัตรา", "ให้แจ้ง"]),
    "hindi": ("डॉ. 2वें सत्र में प्रस्तुत किया गया। दर 7.185 प्रतिशत लागू नहीं होगी।", ["डॉ.", "दर"]),
    "arabic": ("قدم د. سليمور الوثيقة رقم 77.676. هل يستمر القرار؟ نعم.", ["قدم", "هل", "نعم"]),
    "russian": ("Стороны рассматривают до 6 мая 1984 г. в порядке. Согласно ст. 146 п. 1 срок.", ["Стороны", "Согласно"]),
    "german": ("Bis zum 14. Mai 1982. Es heißt: „Nichts steht. Es bleibt dabei.“, sodass es gilt. Ende.", ["Bis", "Es heißt", "Ende"]),
    "url": ("Ver https://a.b/c.D?x=1.Y agora. Fim.", ["Ver", "Fim"]),
    "no terminator": ("sem fim", ["sem"]),
    "empty": ("", []),
    "blank": (" \n\t ", []),
    "null": (None, []),
    "placeholders": (f"a{GUARD}b. C{CUT}d.", ["a" + GUARD, "C" + CUT]),
}


@pytest.mark.parametrize("name", CASES)
def test_units(spark, name):
    text, want = CASES[name]
    d = spark.createDataFrame([(1, text, "x", "y")], "ord long, text string, unit string, _t string")
    got = sentence_units(d, "text", ["ord"]).orderBy("start_pos").collect()
    assert len(got) == len(want), [r.unit for r in got]
    for r, w in zip(got, want):
        assert r.unit.startswith(w), [x.unit for x in got]
        assert len(r.unit) and text[r.start_pos : r.start_pos + 1] == r.unit[0]


def test_long_repeated_and_empty(spark):
    long = "Uma frase curta aqui. " * 5000
    d = spark.createDataFrame([(1, long), (1, long), (None, "Ab cd")], "ord long, text string")
    got = sentence_units(d, "text", ["ord"]).groupBy("ord").count().collect()
    assert {r.ord: r["count"] for r in got} == {1: 10000, None: 1}
    assert sentence_units(d.limit(0), "text", ["ord"]).count() == 0
    with pytest.raises(ValueError):
        sentence_units(d.withColumnRenamed("ord", "unit"), "text", ["unit"])


def units(spark, *texts):
    d = spark.createDataFrame(list(enumerate(texts)), "ord long, text string")
    out = [[] for _ in texts]
    for r in sentence_units(d, "text", ["ord"]).orderBy("ord", "start_pos").collect():
        assert texts[r.ord][r.start_pos :].startswith(r.unit)
        out[r.ord].append(r.unit)
    return out


@pytest.mark.parametrize("open_,close", ["“”", "«»", "()", '""', "„“", "「」"])
def test_quotes_of_any_length(spark, open_, close):
    for n in (2, 60, 2000):
        speech = " ".join(["Nada obsta ao ato."] * n)
        assert [len(x) for x in units(spark, f"Disse o perito: {open_}{speech} Fim da fala{close}, e concluiu. A sessão abriu.")] == [2]


def test_addresses_and_lines_of_any_length(spark):
    far = "https://a.b/" + "c.D/" * 200 + "x"
    items = "São: I - " + "prazo " * 60 + ";\nII - prova. Fim.\n"
    wrapped = "As despesas com a bolsa correrão à conta\nda dotação própria e de outras. Será\npublicado o ato\nque regula o tema."
    got = units(spark, f"Ver {far} agora. Fim.", wrapped, wrapped + "\n\n" + "Uma linha muito longa " * 12 + "acaba.", items + wrapped)
    assert len(got[0]) == 2 and len(got[1]) == 2 and len(got[2]) == 3 and len(got[3]) == 4


def test_a_bracket_of_a_label_closes_nothing(spark):
    assert [x[:4] for x in units(spark, "Vale a regra geral. b) prova. Fim.")[0]] == ["Vale", "b) p", "Fim."]


def test_words_of_any_length_may_be_abbreviations():
    from lexspark.llm import sentences as S

    assert S._LONG_WORD > max(len(w) for w in S._forms(S._WORDS).split("|") if w.islower())


def test_long_texts_take_time_in_proportion(spark):
    import time

    one = "Ｏ índice fixado “é livre. Nada obsta.” para R$ 1.234,56 e art. 5 vale. Outra frase curta segue aqui. " * 10
    parts = spark.createDataFrame([(i, one) for i in range(400)], "ord long, text string").coalesce(1).cache()
    whole = spark.createDataFrame([(0, one * 400)], "ord long, text string").coalesce(1).cache()
    took = []
    for d in (parts, whole, parts, whole):
        n, began = d.count(), time.time()
        assert sentence_units(d, "text", ["ord"]).count() == 400 * 20
        took.append(time.time() - began)
    assert min(took[1], took[3]) < 2.5 * min(took[0], took[2]) + 1


def test_odd_texts_neither_overflow_nor_take_forever(spark):
    n = 20_000
    odd = ["(" + "." * n + ") Fim.", "“" + "Nada obsta. " * n + "”, fim. Outra.", "http://a/" + "b.c" * n + " x. Fim.", "“( " * n, "”) " * n, ' "' * n, "「" + "是。" * n + "」。", "กขค " * n, "a\n" * n, "Â" * n]
    open_ = "“".encode().decode("cp1252")
    close = "”".encode().decode("latin-1")
    got = units(spark, *odd, open_ + "nada obsta. " * n + close + ", fim. Outra.")
    assert [len(x) for x in got[:3]] == [2, 2, 2] and len(got[6]) == 1 and len(got[7]) == n and len(got[10]) == 2
