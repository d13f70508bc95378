import random

import numpy as np

from lexspark.llm.subjects import document_subjects, latent

D = "doc_id long, text string, source string, law_number string, share double"
WORDS = {"tax": ["imposto", "alíquota", "tributo", "isenção"], "health": ["vacina", "hospital", "paciente", "insulina"], "sport": ["atleta", "campeonato", "torcida", "estádio"]}
FRAMES = ["O relatório sobre {} deverá indicar critérios.", "Durante a transição, {} continuará em vigor.", "As despesas com {} correrão à conta própria.", "Compete ao órgão rever {} no prazo fixado."]
PLAIN = ["Esta norma passa a valer hoje.", "Caberá recurso no prazo legal."]


def make(n):
    rng = random.Random(5)
    rows, truth = [], {}
    for i in range(n):
        areas = rng.sample(sorted(WORDS), rng.choice([1, 1, 2]))
        s = [rng.choice(FRAMES).format(rng.choice(WORDS[a])) for a in areas for _ in range(6)] + rng.choices(PLAIN, k=3)
        rng.shuffle(s)
        rows.append((i, " ".join(s), rng.choice(["x", "y", None]), rng.choice(["1", None]), 0.0))
        truth[i] = set(areas)
    return rows, truth


def tables(spark, rows):
    rng = random.Random(6)
    # The examples lack the last two words of each area.
    ex = [(j, f.format(w), a) for a, ws in WORDS.items() for w in ws[:2] for j, f in enumerate(FRAMES)] + [(9, None, "tax"), (9, "x", None), (9, "y", "unknown")]
    rng.shuffle(ex)
    return spark.createDataFrame(rows, D), spark.createDataFrame([(a,) for a in [*WORDS, None]], "subject string"), spark.createDataFrame(ex, "example_id long, text string, subject string")


def test_unseen_words_are_learned(spark):
    rows, truth = make(600)
    rows += [(10_000, None, None, None, 0.0), (10_001, "  ", "x", "1", 0.0), (10_002, " ".join(PLAIN * 4), "x", "1", 0.0), (10_003, rows[0][1], None, None, 0.0)]
    docs, subjects, examples = tables(spark, rows)
    got = {}
    for r in document_subjects(docs.repartition(3), subjects, examples).collect():
        assert r.share >= 0.25
        got.setdefault(r.doc_id, set()).add(r.subject)
    assert sum(got.get(i) == t for i, t in truth.items()) >= 0.97 * len(truth)
    assert not {10_000, 10_001, 10_002} & set(got)
    assert got[10_003] == got[0]


def test_empty(spark):
    docs, subjects, examples = tables(spark, [])
    assert document_subjects(docs, subjects, examples).count() == 0
    full = tables(spark, make(5)[0])[0]
    assert document_subjects(full, subjects.limit(0), examples).count() == 0
    assert document_subjects(full, subjects, examples.limit(0)).count() == 0


def test_accuracies_are_learned():
    rng = np.random.default_rng(1)
    z = rng.integers(0, 4, 20_000)
    def vote(acc, silent, silent0):
        v = np.where(rng.random(len(z)) < acc, z, rng.integers(1, 4, len(z)))
        return np.where(rng.random(len(z)) < np.where(z == 0, silent0, silent), 0, np.maximum(v, 1))
    votes = np.stack([vote(0.95, 0.1, 0.97), vote(0.9, 0.2, 0.95), vote(0.6, 0.2, 0.9), vote(0.0, 0.1, 0.1)], axis=1)
    pattern, n = np.unique(votes, axis=0, return_counts=True)
    q, right = latent(pattern, n.astype(float), 3)
    assert right[0] > right[1] > right[2] > right[3] and right[3] < 0.45
    at = {tuple(p): a for p, a in zip(pattern, q.argmax(axis=1))}
    assert np.mean([at[tuple(v)] == a for v, a in zip(votes, z)]) > 0.93
