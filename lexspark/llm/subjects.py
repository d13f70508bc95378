r"""Problem 8: the subject areas of each document.

Method: labelling functions under a latent model that learns their accuracies. The unit is a sentence. Five functions
vote an area or abstain:

- lexicon: words and word pairs typical of one area in the labelled examples;
- corpus lexicon: words and word pairs typical of one area in the documents, given the areas the first lexicon sees in
  them; this finds wording that the examples lack;
- section: the area most voted by the corpus lexicon in the other sentences of the paragraph;
- address: the area most common among the other documents filed under the same law (the address they are reached by);
- source: the area most common in the document's source.

How often each pattern of votes occurs is counted over all sentences; EM over those counts learns each function's
accuracy and how often it abstains, with a latent class for sentences of no area, and gives every pattern its posterior
over areas. A sentence takes its most probable area or none; a document has the areas that at least QUARTER of its
sentences with any area have.

Scale. Two passes over the texts in Arrow partitions. Features are counted by hashes of 60 bits or so, each with the area
it is seen in, summed up in the tasks and then by a shuffle; what is rare (MIN_SEEN) or impure is dropped there, and the
driver gets the survivors only, at most LEXICON weights of them (features times areas, those seen most; a bound on the
model like the size of a vocabulary). Vote patterns have at most 11^5 values and are summed in the executors too, so a hot source or
law costs one row per partition. Between the second pass and the result only one small row per document travels.

Edge cases: NULL, empty and blank texts and texts of procedure only have no row; an area needs to be in `subjects`;
NULL law numbers and sources make their functions abstain; exact ties go to the area that comes first by name; copies get
equal areas; without examples or documents the result is empty. The labelled set is small by nature; of more than
MAX_EXAMPLES rows an equal number for each area is drawn by hash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexspark.session import written

PLACES, QUARTER, MAX_EXAMPLES, LEXICON = 2**20, 0.25, 20_000, 2**24
#: Features that a task holds before it adds them up.
HELD = 4_000_000
MIN_SEEN, MIN_PURITY, MIN_SUM, MIN_SHARE = 8, 0.4, 0.9, 0.1
BLOCK_CHARS = 300_000
_TOKEN = re.compile(r"\w+|[.!?…。！？](?=[\s”’»\")\x00]|$)|\n\s*\n|\x00")
_END, _PARAGRAPH, _DOCUMENT = -1, -2, -3


class _Ids(dict):
    """Ids of tokens, worked out once each."""

    def __missing__(self, w: str) -> int:
        c = w[0]
        if c == "\x00":
            i = _DOCUMENT
        elif c == "\n":
            i = _PARAGRAPH
        elif c in ".!?…。！？":
            i = _END
        else:
            i = 0 if c.isdigit() else zlib.crc32(w.encode()) or 1
        self[w] = i
        return i


class _Block:
    """Documents taken together. feature: hashed words and pairs of neighbours within a sentence, all figures being alike;
    at: the sentence of each; paragraph, document: of each sentence. n documents in all."""

    def __init__(self, texts: list[str], ids: _Ids):
        if len(ids) > 500_000:
            ids.clear()
        words = _TOKEN.findall("\x00".join(t.replace("\x00", " ") if "\x00" in t else t for t in texts).lower())
        i = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        stop = i < 0
        sentence = np.cumsum(stop)
        ends = i[stop]
        self.n = len(texts)
        self.document = np.concatenate(([0], np.cumsum(ends == _DOCUMENT)))
        self.paragraph = np.concatenate(([0], np.cumsum(ends < _END)))
        u = i.astype(np.uint64)
        word = ~stop
        pair = word[:-1] & word[1:]
        one = u[word] * np.uint64(0x9E3779B97F4A7C15)
        two = u[:-1][pair] * np.uint64(0xC2B2AE3D27D4EB4F) + u[1:][pair] * np.uint64(0x165667B19E3779F9)
        self.feature = np.concatenate((one, two))
        self.feature ^= self.feature >> np.uint64(29)
        self.at = np.concatenate((sentence[word], sentence[:-1][pair]))

    @property
    def sentences(self) -> int:
        return len(self.document)


def _blocks(texts: list[str | None], ids: _Ids) -> Iterator[tuple[list[int], _Block]]:
    """(places in texts, block) over the texts that hold anything."""
    held, size = [], 0
    for i, t in enumerate(texts):
        if t and not t.isspace():
            held.append(i)
            size += len(t)
        if held and (size > BLOCK_CHARS or i == len(texts) - 1):
            yield held, _Block([texts[j] for j in held], ids)
            held, size = [], 0
    if held:
        yield held, _Block([texts[j] for j in held], ids)


def _place(features: np.ndarray) -> np.ndarray:
    return (features & np.uint64(PLACES - 1)).astype(np.int64)


class Lexicon:
    """Weights of features by area. bits: how many low bits of a feature its keys lack."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bits: int = 0):
        order = np.argsort(keys)
        self.keys, self.weights, self.bits = keys[order], weights[order].astype(np.float32), bits

    def prepare(self) -> None:
        """Once per task: which places hold a key at all."""
        self.held = np.zeros(PLACES, bool)
        self.held[_place(self.keys >> np.uint64(self.bits))] = True

    def find(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which features have weights, and the rows of these."""
        if not len(self.keys):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        hit = np.flatnonzero(self.held[_place(features >> np.uint64(self.bits))])
        keys = features[hit] >> np.uint64(self.bits) << np.uint64(self.bits)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        same = self.keys[at] == keys
        return hit[same], at[same]

    def votes(self, features: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        """0 (abstains) or 1 + area for each of n sentences."""
        hit, row = self.find(features)
        if not len(hit):
            return np.zeros(n, np.int64)
        at = sentence[hit]
        score = np.stack([np.bincount(at, self.weights[row, a], n) for a in range(self.weights.shape[1])], axis=1)
        best = score.argmax(axis=1)
        return np.where(score[np.arange(n), best] >= MIN_SUM, best + 1, 0)


def _log_odds(purity: np.ndarray) -> np.ndarray:
    k = purity.shape[1]
    return np.where(purity > 1.5 / k, np.log(purity * k), 0.0)


def _example_lexicon(counts: np.ndarray, keys: np.ndarray, min_purity: float) -> Lexicon:
    """The log odds against even shares, for features that are pure enough. There are few examples: what was seen once
    counts too, but for less, so that it takes two such features to vote."""
    total, k = counts.sum(axis=1), counts.shape[1]
    share = counts.sum(axis=0) / max(counts.sum(), 1e-9)
    even = counts / np.maximum(share, 1e-9) / k  # as if all areas were equally common
    purity = (even + 0.1) / (even.sum(axis=1, keepdims=True) + 0.1 * k)
    keep = (total >= 1) & (even.max(axis=1) >= min_purity * even.sum(axis=1))
    return Lexicon(keys[keep], _log_odds(purity[keep]) * (total / (total + 1))[keep, None])


def _seed(examples: list[tuple[str, int]], k: int) -> Lexicon:
    counts: dict[int, np.ndarray] = {}
    ids = _Ids()
    for text, area in examples:
        for f in np.unique(_Block([text], ids).feature).tolist():
            counts.setdefault(f, np.zeros(k))[area] += 1
    if not counts:
        return Lexicon(np.empty(0, np.uint64), np.empty((0, k)))
    return _example_lexicon(np.array(list(counts.values())), np.array(list(counts), np.uint64), 0.75)


def _added(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their weights."""
    got = pa.table({"k": keys, "w": weights}).group_by("k", use_threads=False).aggregate([("w", "sum")])
    return got.column("k").to_numpy(), got.column("w_sum").to_numpy()


def _count(seed: Lexicon, k: int):
    """Sums (f, a, w), by feature and area, of the area shares that the first lexicon sees in each document. A document in
    which it sees hardly any (a passing mention, or wording it lacks) counts as one of every area in equal parts: area k.
    Feature 0 has the sums over all features."""
    bits = k.bit_length()
    low = np.uint64(2**bits - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed.prepare()
        ids = _Ids()
        held, n_held, all_ = [], 0, np.zeros(k + 1)

        def settle() -> list:
            return [_added(np.concatenate([x for x, _ in held]), np.concatenate([w for _, w in held]))] if held else []

        for batch in batches:
            for _, x in _blocks(batch.column(0).to_pylist(), ids):
                v = seed.votes(x.feature, x.at, x.sentences)
                seen = np.bincount(x.document * (k + 1) + v, minlength=x.n * (k + 1)).reshape(x.n, k + 1)
                n, seen = seen.sum(axis=1), seen[:, 1:]
                enough = seen.max(axis=1) >= np.maximum(1, MIN_SHARE * n)
                share = np.zeros((x.n, k + 1))
                share[:, :k] = np.where(enough[:, None], seen / np.maximum(seen.sum(axis=1, keepdims=True), 1), 0)
                share[:, k] = ~enough
                feature, document = x.feature & ~low, x.document[x.at]
                for a in np.flatnonzero(share.any(axis=0)):
                    hit = np.flatnonzero((share[:, a] > 0)[document])
                    w = share[document[hit], a]
                    held.append((feature[hit] | np.uint64(a), w))
                    all_[a] += w.sum()
                    n_held += len(hit)
                if n_held > HELD:
                    held = settle()
                    n_held = len(held[0][0]) // 2  # so that much the same isn't sorted over and over
        for keys, w in settle():
            for i in range(0, len(keys), 500_000):
                key = keys[i : i + 500_000]
                yield pa.RecordBatch.from_arrays([pa.array((key & ~low).view(np.int64)), pa.array((key & low).astype(np.int32)), pa.array(w[i : i + 500_000])], names=["f", "a", "w"])
        some = np.flatnonzero(all_)
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(some), np.int64)), pa.array(some.astype(np.int32)), pa.array(all_[some])], names=["f", "a", "w"])

    return run


def _corpus_lexicon(docs: DataFrame, seed: Lexicon, k: int) -> Lexicon:
    """The log odds against even shares, for features that are pure enough even at the lower end of what their count
    allows. Sums and tests run in the executors."""
    sums = docs.select("text").mapInArrow(_count(seed, k), "f long, a int, w double").groupBy("f")
    sums = sums.agg(F.sum("w").alias("n"), *[F.sum(F.when(F.col("a") == a, F.col("w")).when(F.col("a") == k, F.col("w") / k).otherwise(0.0)).alias(f"a{a}") for a in range(k)])
    sums = written(sums.where((F.col("n") >= MIN_SEEN) | (F.col("f") == 0)), "features")
    total = sums.where("f = 0").first()
    if total is None:
        return Lexicon(np.empty(0, np.uint64), np.empty((0, k)))
    even = [F.col(f"a{a}") / max(total[f"a{a}"] / max(total.n, 1e-9), 1e-9) / k for a in range(k)]  # as if all areas were equally common
    purity = [(e + 0.1) / (sum(even[1:], even[0]) + 0.1 * k) for e in even]
    best = F.greatest(*purity)
    pure = sums.where("f <> 0").select("f", "n", F.array(*purity).alias("p"), best.alias("best"))
    pure = pure.where(F.col("best") - F.sqrt(F.col("best") * (1 - F.col("best")) / F.col("n")) >= MIN_PURITY)
    table = pure.orderBy(F.desc("n"), "f").limit(LEXICON // k).select("f", "p").toArrow()
    weights = np.array(table.column("p").to_pylist(), float).reshape(-1, k)
    return Lexicon(table.column("f").to_numpy().view(np.uint64), _log_odds(weights), k.bit_length())


def _votes(seed: Lexicon, corpus: Lexicon, k: int):
    """One row per document: a code of (lexicon, corpus lexicon, section) votes for each sentence that any of them votes
    on, the number of the other sentences being left out, and the document's most voted area."""
    base = k + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed.prepare()
        corpus.prepare()
        ids = _Ids()
        for batch in batches:
            docs, laws, sources, texts = (c.to_pylist() for c in batch.columns)
            codes, tops = [[] for _ in texts], [0] * len(texts)
            for places, x in _blocks(texts, ids):
                a, b = seed.votes(x.feature, x.at, x.sentences), corpus.votes(x.feature, x.at, x.sentences)
                tally = np.bincount(x.paragraph * base + b, minlength=(int(x.paragraph[-1]) + 1) * base).reshape(-1, base)
                near = tally[x.paragraph]
                near[np.arange(x.sentences), b] -= 1  # the other sentences
                near[:, 0] = 0
                code = (a * base + b) * base + near.argmax(axis=1)
                seen = np.bincount(x.document * base + b, minlength=x.n * base).reshape(x.n, base)
                seen[:, 0] = 0
                top = np.where(seen.any(axis=1), seen.argmax(axis=1), 0).tolist()
                each = np.split(code, np.searchsorted(x.document, np.arange(1, x.n)))
                for i, t, c in zip(places, top, each):
                    tops[i], codes[i] = t, c[c > 0].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(laws, pa.string()), pa.array(sources, pa.string()), pa.array(codes, pa.list_(pa.int32())), pa.array(tops, pa.int32())], names=["doc_id", "law", "source", "codes", "top"])

    return run


def latent(patterns: np.ndarray, n: np.ndarray, k: int, lexical: int = 3, iterations: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns (rows; 0 abstains) seen n times: (posterior over none and k areas, accuracy of each
    function). The first `lexical` functions may abstain more where there is no area."""
    j = patterns.shape[1]
    prior = np.full(k + 1, 0.6 / k)
    prior[0] = 0.4
    silent, silent0 = np.full(j, 0.2), np.where(np.arange(j) < lexical, 0.9, 0.2)
    right = np.where(np.arange(j) < 2, 0.9, 0.4)
    areas = np.arange(1, k + 1)
    for _ in range(iterations):
        logp = np.tile(np.log(prior), (len(patterns), 1))
        for f in range(j):
            v = patterns[:, f]
            hit = v[:, None] == areas[None]
            p = np.where(hit, right[f], (1 - right[f]) / max(k - 1, 1)) * (1 - silent[f])
            p0 = np.full(len(v), (1 - silent0[f]) / k)
            p[v == 0], p0[v == 0] = silent[f], silent0[f]
            logp[:, 0] += np.log(p0)
            logp[:, 1:] += np.log(p)
        q = np.exp(logp - logp.max(axis=1, keepdims=True))
        q /= q.sum(axis=1, keepdims=True)
        w = q * n[:, None]
        prior = (w.sum(axis=0) + 1) / (n.sum() + k + 1)
        some, none = w[:, 1:].sum(axis=1), w[:, 0]
        for f in range(j):
            v = patterns[:, f]
            voted = v > 0
            good = w[voted][np.arange(voted.sum()), v[voted]].sum()
            right[f] = np.clip((good + 1) / (some[voted].sum() + 2), 1 / k, 0.999)
            silent[f] = np.clip((some[~voted].sum() + 1) / (some.sum() + 2), 1e-3, 1 - 1e-3)
            silent0[f] = np.clip((none[~voted].sum() + 1) / (none.sum() + 2), 1e-3, 1 - 1e-3)
    return q, right


def _most(df: DataFrame, key: str, name: str) -> DataFrame:
    """For each key the two areas that most documents vote for, as structs (m: documents, negative; top: area)."""
    by = df.where(F.col(key).isNotNull() & (F.col("top") > 0)).groupBy(key, "top").agg(F.count("*").alias("n"))
    ranked = by.groupBy(key).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "top"))).alias("r"))  # at most one per area
    return ranked.select(key, F.get("r", F.lit(0)).alias(f"{name}1"), F.get("r", F.lit(1)).alias(f"{name}2"))


def _vote(name: str, but_own: bool):
    """The area voted most; but_own: among the other documents, ties going to the area that comes first."""
    first, second = F.col(f"{name}1"), F.col(f"{name}2")
    best = first["top"]
    if but_own:
        own = F.col("top") == first["top"]
        best = F.when(own & second.isNotNull() & (F.struct(second["m"], second["top"]) < F.struct(first["m"] + 1, first["top"])), second["top"])
        best = best.when(own & (first["m"] == -1), F.lit(0)).otherwise(first["top"])
    return F.coalesce(best, F.lit(0))


def document_subjects(documents: DataFrame, subjects: DataFrame, examples: DataFrame) -> DataFrame:
    """doc_id, subject, share, sentences of documents (doc_id, text, source, law_number), given subjects (subject) and
    examples (text, subject)."""
    spark = documents.sparkSession
    names = [r.subject for r in subjects.where("subject IS NOT NULL").select("subject").distinct().orderBy("subject").limit(1001).collect()]
    if len(names) > 1000:
        raise ValueError("subjects is meant to be a short list")
    result = "doc_id long, subject string, share double, sentences long"
    k = len(names)
    if k < 2:
        return spark.createDataFrame([], result)
    at = {s: i for i, s in enumerate(names)}
    known = examples.where("text IS NOT NULL").join(F.broadcast(spark.createDataFrame([(s,) for s in names], "subject string")), "subject", "left_semi")  # at most 1,000 names
    turn = F.row_number().over(Window.partitionBy("subject").orderBy(F.xxhash64("text"), "text"))
    labelled = known.select("text", "subject", turn.alias("i")).where(F.col("i") <= max(1, MAX_EXAMPLES // k)).select("text", "subject").collect()
    seed = _seed([(r.text, at[r.subject]) for r in labelled], k)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("law_number").cast("string").alias("law"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    corpus = _corpus_lexicon(docs, seed, k)
    voted = written(docs.mapInArrow(_votes(seed, corpus, k), "doc_id long, law string, source string, codes array<int>, top int"), "votes")
    rows = voted.where("size(codes) > 0")
    rows = rows.join(_most(voted, "law", "laws"), "law", "left").join(_most(voted, "source", "sources"), "source", "left")
    base = k + 1
    code = (F.col("code").cast("long") * base + F.col("address")) * base + F.col("origin")
    rows = rows.select("doc_id", "codes", _vote("laws", True).alias("address"), _vote("sources", False).alias("origin"))
    each = rows.select("doc_id", F.explode("codes").alias("code"), "address", "origin").select("doc_id", code.alias("pattern"))
    each = written(each.groupBy("doc_id", "pattern").agg(F.count("*").alias("n")), "patterns")
    seen = each.groupBy("pattern").agg(F.sum("n").alias("n")).toArrow()
    pattern, n = seen.column("pattern").to_numpy(), seen.column("n").to_numpy().astype(float)
    if not len(pattern):
        return spark.createDataFrame([], result)
    votes = np.stack([pattern // base**p % base for p in (4, 3, 2, 1, 0)], axis=1)
    q, _ = latent(votes, n, k)
    area = q.argmax(axis=1)
    some = area > 0
    label = spark.createDataFrame(pa.table({"pattern": pattern[some], "area": area[some].astype(np.int64)}))
    name = F.element_at(F.array(*[F.lit(s) for s in names]), F.col("area").cast("int"))
    # At most 11^5 patterns by construction, a few thousand in practice; the engine picks the join.
    hits = each.join(label, "pattern").groupBy("doc_id", "area").agg(F.sum("n").alias("sentences"))
    hits = hits.groupBy("doc_id").agg(F.sum("sentences").alias("all"), F.collect_list(F.struct("area", "sentences")).alias("by"))
    hits = hits.select("doc_id", "all", F.inline("by"))
    return hits.where(F.col("sentences") >= QUARTER * F.col("all")).select("doc_id", name.alias("subject"), (F.col("sentences") / F.col("all")).alias("share"), "sentences")
