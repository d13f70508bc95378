import pytest

from lexspark.llm import encoding as E

CLEAN = [
    "A dedução de despesas médicas não é automática; a declaração será revista.",
    "São exigidos: prova de que o crédito tributário foi constituído de ofício.",
    "Lei nº 10.406, de 10 de março de 2002. § 1º A habilitação é pública.",
    "O órgão responsável observará o percentual. À Agência compete a fiscalização.",
    "DAS DISPOSIÇÕES GERAIS. DA ORGANIZAÇÃO E DO ÂMBITO. CAPÍTULO único.",
    "A empresa Vălenor S.A. e a Cia. Nordåvel disseram: “não há atraso”.",
]
TEXT = "A dedução de despesas médicas não é automática. São exigidos: prova de ofício e § 1º."
CHAINS = {
    "utf8": lambda t: t.encode().decode("cp1252", "ignore"),
    "latin1": lambda t: t.encode().decode("latin-1"),
    "cp437": lambda t: t.encode().decode("cp437"),
    "mac": lambda t: t.encode().decode("mac_roman"),
    "twice": lambda t: t.encode().decode("cp1252").encode().decode("cp1252"),
    "cp850": lambda t: t.encode("cp1252").decode("cp850"),
    "to cp1252": lambda t: t.encode("cp850").decode("latin-1"),
    "cp1250": lambda t: t.encode("cp1252").decode("cp1250"),
}
SCHEMA = "src string, fld string, ord long, text string, chain string"


def corpus(spark, extra):
    rows = [("t", "f", i, t, "x") for i, t in enumerate(CLEAN * 60)]
    return spark.createDataFrame(rows + [("t", "f", 10_000 + i, t, "x") for i, t in enumerate(extra)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def found(spark):
    d = corpus(spark, [f(TEXT) for f in CHAINS.values()])
    return {r.ord: r for r in E.find_garbled(d).collect()}


@pytest.mark.parametrize("name", CHAINS)
def test_found_and_restored(found, name):
    r = found[10_000 + list(CHAINS).index(name)]
    assert r.restored and r.posterior > 0.5
    if name not in ("utf8", "to cp1252", "cp1250"):  # those lose or share characters
        assert r.text == TEXT


def test_clean_text_is_left_alone(found):
    assert all(k >= 10_000 for k in found)


def test_edge_cases(spark):
    d = corpus(spark, [None, "", "ascii only", "perdido � aqui", "é", TEXT.encode().decode("latin-1"), TEXT.encode().decode("latin-1")])
    got = {r.ord: r for r in E.find_garbled(d).collect()}
    assert set(got) == {10_003, 10_005, 10_006} and not got[10_003].restored
    assert got[10_005].text == got[10_006].text == TEXT
    assert E.find_garbled(d.limit(0)).count() == 0


def test_long_runs(spark):
    russian = "Стороны рассматривают протокол заседания"
    d = corpus(spark, [russian, russian.encode().decode("latin-1")])
    got = {r.ord: r.text for r in E.find_garbled(d).collect()}
    assert got == {10_001: russian}


def test_pools_without_a_name(spark):
    wrong = TEXT.encode().decode("latin-1")
    rows = [(s, f, i, t, "x") for i, t in enumerate(CLEAN * 30 + [wrong]) for s, f in ((None, "f"), ("t", None), (None, None))]
    d = spark.createDataFrame(rows, SCHEMA)
    got = E.find_garbled(d).collect()
    assert {(r.src, r.fld, r.ord) for r in got} == {(None, "f", 180), ("t", None, 180), (None, None, 180)} and {r.text for r in got} == {TEXT}
    assert E.without_garbled(d, E.learn(d), "ord").count() == 180 * 3


def test_length_alone_changes_nothing(spark):
    words = ["Ïðåäñåäàòåëü", "Ïðèâåò", "çàñåäàíèå", "äîãîâîð"]  # cp1251 read as cp1252
    clean = [w.encode("cp1252").decode("cp1251") for w in words]
    d = corpus(spark, clean * 200 + words + [" ".join(words + [""]) * 8])
    got = {r.ord - 10_000: r.text for r in E.find_garbled(d).collect()}
    assert got == dict(enumerate(clean, 800)) | {804: " ".join(clean + [""]) * 8}


def test_unseen_scripts_in_stretches(spark):
    greek = "τα μέρη εξετάζουν το πρωτόκολλο"
    d = corpus(spark, [greek.encode().decode("latin-1"), greek.encode().decode("cp850")])
    assert [r.text for r in E.find_garbled(d).collect()] == [greek] * 2


def test_lookalikes_are_no_misreading(spark):
    d = corpus(spark, ["SwјрmРіGkРѕQ de teste"])
    assert E.find_garbled(d).count() == 0


def test_chance_is_no_misreading(spark):
    d = corpus(spark, ["\u0430\u0455\u0455\u0456m que a \u0441\u043en\u0441\u0435\u0455\u0455\u00e3\u043e", "sal\u00e1\u00ad\u00adrios", "restitui\u0131\u00e7\u00e3o"] * 3)
    assert E.find_garbled(d).count() == 0


def test_atoms():
    twice = "çã".encode().decode("cp1252").encode().decode("cp1252")
    assert "".join(E.atoms(twice)) == twice and len(E.atoms(twice)) == 2 and E.atoms("éà") == ["é", "à"]
    assert E.units_of("a", "Ã§Ã£", "o") == [("a", "Ã§", "U "), ("U ", "Ã£", "o")]
    assert E.units_of("", "中", "") == [("", "中", "")]
    assert E.fit([]).bad == {}


def test_the_table_is_bounded_by_alphabets():
    import pyarrow as pa

    def size(n):
        texts = pa.array([f"palavra{chr(97 + i % 26)}ção número {i} Стороны{chr(0x430 + i % 32)}{chr(0x430 + i // 32 % 32)}" for i in range(n)])
        batch = pa.RecordBatch.from_arrays([pa.array(["p"] * n), texts], names=["pool", "text"])
        return next(E._count_units(iter([batch]))).num_rows

    assert size(20_000) == size(40_000)


def test_planted_garbling_is_found_and_restored(spark):
    """Precision and recall by chain, on clean rows of its own garbled here."""
    import random

    rng = random.Random(8)
    words = sorted({w for t in CLEAN[:5] for w in t.split()})
    rows = [("t", "f", i, " ".join(rng.choices(words, k=25)), "x") for i in range(1500)]
    made = {}
    for j, (name, f) in enumerate(sorted(CHAINS.items())):
        for i in range(40):
            t = " ".join(rng.choices(words, k=25))
            try:
                wrong = f(t)
            except UnicodeError:  # not every byte has a character there
                continue
            if wrong != t:
                made[10_000 + j * 100 + i] = (name, t)
                rows.append(("t", "f", 10_000 + j * 100 + i, wrong, "x"))
    got = {r.ord: r for r in E.find_garbled(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert set(got) == set(made)
    for name in CHAINS:
        ours = [(got[k].text, t) for k, (n, t) in made.items() if n == name]
        if name not in ("utf8", "to cp1252"):  # those lose characters or have none for some
            assert sum(a == b for a, b in ours) >= 0.9 * len(ours), name
