import random
import re

import pytest

from lexspark.llm import neardup as N


def jaccard(a, b, w):
    f = lambda t: (lambda x: {tuple(x[i : i + w]) for i in range(len(x) - w + 1)})(re.findall(r"[^\W_]+", t.lower()))
    x, y = f(a), f(b)
    return 1.0 if a == b else len(x & y) / len(x | y) if x | y else 0.0


def make(n, seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    texts = []
    while len(texts) < n:
        base = [rng.choice(vocab) for _ in range(rng.randint(40, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            t = list(base)
            for _ in range(rng.randint(0, 4)):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            texts.append(" ".join(t))
    return texts[:n]


def test_masks_cover():
    import itertools

    block = (1 << N.BITS) - 1
    for i, j in itertools.combinations(range(N.COORDINATES), 2):
        assert any(not m >> (N.BITS * i) & block and not m >> (N.BITS * j) & block for m in N.masks())
    assert len(N.masks()) == 7 and all(bin(m).count("1") == 4 * N.BITS for m in N.masks())


def test_parameters_follow_the_similarity():
    assert [N.blocks_for(s) for s in (0.4, 0.6, 0.8, 1.0)] == [32, 7, 3, 1]
    assert N.limit_for(1.0) == 0 and N.limit_for(0.8) < N.limit_for(0.6) < N.limit_for(0.4) < N.CHECK_BITS


def test_nothing_is_broadcast(spark):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(make(30, 2))], "id long, text string")
    members, links = N.near_duplicates(d, 3, 0.6)
    for df in (members, links, N.all_pairs(members, links), N.groups(members, links)):
        text = df._jdf.queryExecution().toString()
        assert "SortMergeJoin" in text and "Broadcast" not in text


def test_hot_buckets_and_classes_are_cut(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:k] + [f"x{rng.random()}"] + base[k:]) for k in (30,) * 60] + ["the very same text"] * 40
    d = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    want = None
    for size in (2_000, 7):
        monkeypatch.setattr(N, "BUCKET_ROWS", size)
        got = [(r.ord_a, r.ord_b) for r in N.all_pairs(*N.near_duplicates(d, 3, 0.6)).collect()]
        assert len(got) == len(set(got)) == 60 * 59 // 2 + 40 * 39 // 2
        want = want or sorted(got)
        assert sorted(got) == want


@pytest.mark.parametrize("words,similarity", [(3, 0.6), (5, 0.8), (3, 0.4)])
def test_against_brute_force(spark, words, similarity):
    texts = make(300, 1) + ["um dois", "um dois", "", "", "A b c d e f", "a B c. d e F"]
    d = spark.createDataFrame([(i, t, 0, 0) for i, t in enumerate(texts)], "id long, text string, rep int, k0 int").repartition(4)
    members, links = N.near_duplicates(d, words, similarity)
    got = {(r.ord_a, r.ord_b) for r in N.all_pairs(members, links).collect()}
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if jaccard(texts[i], texts[j], words) >= similarity}
    assert not got - want
    assert len(want - got) <= 0.02 * len(want)
    if similarity == 0.4:
        every = {(r.ord_a, r.ord_b) for r in N.all_pairs(*N.near_duplicates(d, words, similarity, thin=False)).collect()}
        assert got <= every <= want
    # Groups are the components of those pairs.
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in got:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    groups = {r.id: r.group for r in N.groups(members, links).collect()}
    assert groups == {i: root(i) for i in range(len(texts))}


def test_edges(spark):
    d = spark.createDataFrame([(1, None), (2, "a b c d"), (2, "a b c d"), (3, "a b c d")], "id long, text string")
    m, k = N.near_duplicates(d, 3, 0.6)
    assert [tuple(r) for r in N.all_pairs(m, k).collect()] == [(2, 3)]
    m, k = N.near_duplicates(d.limit(0), 3, 0.6)
    assert N.all_pairs(m, k).count() == 0 and N.groups(m, k).count() == 0


def test_chain_settles(spark):
    links = spark.createDataFrame([(i, i + 1, 1.0) for i in range(40)], "a long, b long, similarity double")
    members = spark.createDataFrame([(i, i, 1) for i in range(41)] + [(99, 99, 1)], "id long, rep long, copies long")
    got = {r.id: (r.group, r.links) for r in N.groups(members, links).collect()}
    assert all(got[i][0] == 0 for i in range(41)) and got[99] == (99, 0) and got[0][1] == 1 and got[5][1] == 2
