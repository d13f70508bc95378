r"""Problem 3: near-duplicates by covering locality-sensitive hashing.

Method. A text's set of shingles (runs of WORDS consecutive words) is sketched by min-wise hashes: blocks of seven
coordinates of nine bits each, one block a 64-bit word. Over the seven coordinates lie seven bit masks, the lines' complements of
the projective plane of order two: mask v keeps coordinate m when the bits v and m have in common are odd in number.
Any two coordinates lie on one line, so whenever two sketches differ in at most two coordinates of a block, some mask
hides every difference, and sketch & mask is equal: the pair collides in that table for certain, at any size of the
collection. (Differences in three coordinates on a line are hidden as well.) Blocks are independent, and how many there
are follows from the similarity asked for: as many as make all of them miss a pair just at that similarity at most once
in 90 times (7 at 0.6, 3 at 0.8, 32 at 0.4); a more similar pair is missed far less often (at 0.7 with 7 blocks once in
3,800).

Plan. Texts with equal shingle sets collapse into one class first, so copies never meet in a bucket. Only classes are
hashed. Buckets of one class are dropped, then every bucket is joined with itself by a sort-merge join that is asked for,
as no estimate knows how many rows a class has in buckets. A bucket of more than BUCKET_ROWS classes is cut into blocks
of that size, and each pair of blocks is a cell with a key of its own: no task holds a hot bucket, and no pair is lost.
Within the join pairs are thinned by size (exact) and by 126 one-bit min-wise hashes, whose limit follows from the
similarity too (a pair at the similarity fails once in 10,000 times; thin=False leaves that out). What remains is checked
exactly: shingle sets travel as sorted 32-bit hashes of the documents that are in a pair, and intersections are counted
on them (two different shingles of one pair of sets are taken for equal about once in 70,000 pairs of usual size).
Shuffles have as many tasks as their rows need.

Edge cases: a NULL text belongs to no class and no pair; texts with fewer than WORDS words have no shingles and pair only
with identical texts; repeated rows pair with each other (an id given twice is one document); an empty table gives an
empty result; ties don't matter, as the threshold is inclusive.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.session import drop, tasks_for, written

WORDS, SIMILARITY = 5, 0.8
COORDINATES, BITS, CHECK_BITS = 7, 9, 126
#: Chance that all blocks, or that the check bits, miss a pair just at the similarity asked for.
MISSED, THINNED = 0.011, 1e-4
#: Classes in a block of a hot bucket, documents in a block of a hot class; rows of a shuffle's task.
BUCKET_ROWS, TASK_ROWS = 2_000, 1_000_000
_WORD = re.compile(r"[^\W_]+")


def blocks_for(similarity: float) -> int:
    """How many blocks miss a pair of that similarity with a chance of at most MISSED."""
    s, q = similarity, 1 - similarity
    hidden = s**7 + 7 * s**6 * q + 21 * s**5 * q**2 + 7 * s**4 * q**3  # none, one, two, or three on a line differ
    return 1 if hidden >= 1 else max(1, math.ceil(math.log(MISSED) / math.log1p(-hidden)))


def limit_for(similarity: float) -> int:
    """The least number of differing check bits that a pair of that similarity exceeds with a chance of at most THINNED."""
    p, tail, k = (1 - similarity) / 2, 1.0, -1
    while tail > THINNED and k < CHECK_BITS:
        k += 1
        tail -= math.comb(CHECK_BITS, k) * p**k * (1 - p) ** (CHECK_BITS - k)
    return k


def masks() -> list[int]:
    """The seven masks of a block, as signed 64-bit words."""
    out = []
    for v in range(1, COORDINATES + 1):
        keep = [bin(v & m).count("1") % 2 for m in range(1, COORDINATES + 1)]
        out.append(sum(((1 << BITS) - 1) << (BITS * i) for i, k in enumerate(keep) if k))
    return out


def _shingles(text: str, words: int, cache: dict[str, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    found = _WORD.findall(text.lower())
    if len(found) < words:
        return np.empty(0, np.uint64)
    if len(cache) > 500_000:
        cache.clear()
    for w in set(found).difference(cache):
        cache[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))
    n = len(h) - words + 1
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(words):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
            out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def _parameters(blocks: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    k = blocks * COORDINATES + CHECK_BITS
    return rng.integers(0, 2**32, k, np.uint32) | np.uint32(1), rng.integers(0, 2**32, k, np.uint32)


def _minima(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = None
    x = (h ^ (h >> np.uint64(32))).astype(np.uint32)
    for i in range(0, len(x), 1024):
        m = (x[i : i + 1024, None] * a + b).min(axis=0)
        low = m if low is None else np.minimum(low, m)
    low *= np.uint32(0x9E3779B1)
    return low ^ (low >> np.uint32(15))


def _sketch(words: int, blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _parameters(blocks)
        cache: dict[str, int] = {}
        place = np.uint64(1) << (np.uint64(BITS) * np.arange(COORDINATES, dtype=np.uint64))
        half = np.uint64(1) << np.arange(CHECK_BITS // 2, dtype=np.uint64)
        for batch in batches:
            rows = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text is None:
                    continue
                h = _shingles(text, words, cache)
                if len(h):
                    key = xxhash.xxh3_128_intdigest(h.tobytes())
                    low = _minima(h, a, b)
                    sym = (low[: blocks * COORDINATES] & np.uint32(2**BITS - 1)).astype(np.uint64).reshape(blocks, COORDINATES)
                    sk = (sym * place).sum(axis=1).astype(np.int64).tolist()
                    bit = ((low[blocks * COORDINATES :] >> np.uint32(20)) & np.uint32(1)).astype(np.uint64).reshape(2, -1)
                    c0, c1 = (bit * half).sum(axis=1).astype(np.int64).tolist()
                else:
                    key, sk, c0, c1 = xxhash.xxh3_128_intdigest(b"text" + text.encode("utf-8", "surrogatepass")), None, None, None
                k0, k1 = key >> 64, key & (2**64 - 1)
                rows.append((i, k0 - 2**63, k1 - 2**63, len(h), sk, c0, c1))
            if rows:
                t = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*rows), t)], names=["id", "k0", "k1", "n", "sk", "c0", "c1"])

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, int] = {}
        for batch in batches:
            ids, out = batch.column(0), []
            for text in batch.column(1).to_pylist():
                h = _shingles(text, words, cache)
                out.append(np.unique((h ^ (h >> np.uint64(32))).astype(np.uint32)).tobytes())
            yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.binary())], names=["id", "set"])

    return run


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, sims = [], []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32)
                both = np.concatenate((x, y))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                s = common / (len(x) + len(y) - common)
                if s >= similarity:
                    keep.append(i)
                    sims.append(s)
            got = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([got.column(0), got.column(1), pa.array(sims, pa.float64())], names=["a", "b", "similarity"])

    return run


def _cells(df: DataFrame, rows: str, ident: str) -> DataFrame:
    """df with `own`, the block of a row in its group of `rows` rows, and one row for each `cell`, a pair of blocks, that
    the row belongs to. Groups of at most BUCKET_ROWS rows are one block and one cell."""
    blocks = F.ceil(F.col(rows) / BUCKET_ROWS)
    df = df.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64(ident), F.col("blocks")))
    cell = lambda j: F.least("own", j) * F.col("blocks") + F.greatest("own", j)
    return df.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), cell)))


def _once(l: str, r: str, ident: str):
    """Of two rows of a cell: whether they are to be taken together here and in this order."""
    a, b = (lambda c: F.col(f"{l}.{c}")), (lambda c: F.col(f"{r}.{c}"))
    diagonal = (a("own") == b("own")) & (a("cell") == a("own") * (a("blocks") + 1)) & (a(ident) < b(ident))
    # That blocks are equal goes without saying; said, both sides read the same columns and are shuffled once for both.
    return (a("blocks") == b("blocks")) & ((a("own") < b("own")) | diagonal)


def near_duplicates(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, blocks: int | None = None, thin: bool = True) -> tuple[DataFrame, DataFrame]:
    """(membership, links) of docs (id, text): one row (id, rep, copies) per document, rep being the smallest id whose
    shingle set equals its own and copies how many documents share it, and one row (a, b, similarity), a < b, per pair of
    representatives at or above similarity."""
    if not 0 < similarity <= 1:
        raise ValueError("similarity must be above 0 and at most 1")
    spark, blocks = docs.sparkSession, blocks or blocks_for(similarity)
    docs = docs.select(F.col("id").cast("long").alias("id"), F.col("text"))
    sk = written(docs.mapInArrow(_sketch(words, blocks), "id long, k0 long, k1 long, n int, sk array<long>, c0 long, c1 long"), "sketches")
    classes = sk.groupBy("k0", "k1").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), *[F.any_value(c).alias(c) for c in ("n", "sk", "c0", "c1")])
    classes = written(classes, "classes")
    members = sk.select("id", "k0", "k1").join(classes.select("k0", "k1", "rep", "copies").hint("merge"), ["k0", "k1"]).select("id", "rep", "copies").distinct()
    tables = F.array(*[F.xxhash64(F.col("sk")[b].bitwiseAND(F.lit(m)), F.lit(b * COORDINATES + i)) for b in range(blocks) for i, m in enumerate(masks())])
    rows = classes.where("n > 0").select("rep", "n", "c0", "c1", F.explode(tables).alias("key"))
    tasks = tasks_for(spark, classes.count() * blocks * COORDINATES, TASK_ROWS)
    shared = rows.select("key").repartition(tasks, "key").groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    rows = _cells(rows.repartition(tasks, "key").join(shared.hint("merge"), "key"), "c", "rep").select("key", "cell", "own", "blocks", "rep", "n", "c0", "c1")
    rows = rows.repartition(tasks, "key", "cell")
    distance = F.bit_count(F.col("l.c0").bitwiseXOR(F.col("r.c0"))) + F.bit_count(F.col("l.c1").bitwiseXOR(F.col("r.c1")))
    near = F.least("l.n", "r.n") >= F.greatest("l.n", "r.n") * F.lit(similarity)
    if thin:
        near &= distance <= limit_for(similarity)
    same = (F.col("l.key") == F.col("r.key")) & (F.col("l.cell") == F.col("r.cell"))
    found = rows.alias("l").join(rows.alias("r").hint("merge"), same & _once("l", "r", "rep") & near)
    pairs = written(found.select(F.least("l.rep", "r.rep").alias("a"), F.greatest("l.rep", "r.rep").alias("b")).distinct(), "candidates")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = docs.where("text IS NOT NULL").join(wanted.hint("merge"), "id", "left_semi").mapInArrow(_sets(words), "id long, set binary")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")).hint("merge"), "a")
    both = both.join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")).hint("merge"), "b")
    links = both.select("a", "b", "x", "y").mapInArrow(_verify(similarity), "a long, b long, similarity double").dropDuplicates(["a", "b"])  # an id may be given twice
    return members, links


def all_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """Every pair (ord_a, ord_b), ord_a < ord_b, of documents: linked classes and copies within a class, written out.
    That is quadratic in the copies of a class, as the form asks for; classes of many copies are spread over tasks. groups()
    is the form for large collections."""
    m = _cells(members.where("copies > 1"), "copies", "id")
    same = (F.col("l.rep") == F.col("r.rep")) & (F.col("l.cell") == F.col("r.cell"))
    within = m.alias("l").join(m.alias("r").hint("merge"), same & _once("l", "r", "id")).select(F.col("l.id").alias("x"), F.col("r.id").alias("y"))
    blocks = F.ceil(F.col("copies") / BUCKET_ROWS)
    part = members.select("rep", "id", F.pmod(F.xxhash64("id"), blocks).alias("part"))
    large = members.where(F.col("copies") > BUCKET_ROWS).select("rep", blocks.alias("parts")).distinct()

    def expand(df: DataFrame, rep: str, to: str) -> DataFrame:
        """A row for each member of the class in column rep; a large class is met part by part."""
        df = df.join(large.select(F.col("rep").alias(rep), "parts").hint("merge"), rep, "left")
        df = df.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
        return df.join(part.select(F.col("rep").alias(rep), F.col("id").alias(to), "part").hint("merge"), [rep, "part"]).drop("part", rep)

    across = expand(expand(links.select("a", "b"), "a", "x"), "b", "y")
    return within.unionByName(across).select(F.least("x", "y").alias("ord_a"), F.greatest("x", "y").alias("ord_b"))


def groups(members: DataFrame, links: DataFrame, rounds: int = 50) -> DataFrame:
    """One row (id, group, links) per document: group is the smallest id reachable over links, links the number of its
    class's links to other classes. Labels spread along links and are then looked up once more, so that rounds grow with
    the logarithm of the longest chain; each round is written to the shared folder, and the round before it deleted."""
    edges = written(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    label = written(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    for _ in range(rounds):
        seen = edges.join(label.select(F.col("a").alias("b"), "label").hint("merge"), "b").groupBy("a").agg(F.min("label").alias("m"))
        low = label.join(seen.hint("merge"), "a").select("a", F.least("label", "m").alias("m"), F.col("label").alias("was"))
        jump = low.join(low.select(F.col("a").alias("m"), F.col("m").alias("far")).hint("merge"), "m", "left")
        new = written(jump.select("a", F.least("m", F.coalesce("far", "m")).alias("label"), "was"), "labels")
        drop(label)
        label = new
        if new.where("label <> was").isEmpty():
            break
    else:
        raise RuntimeError("labels didn't settle")
    degree = edges.groupBy("a").agg(F.count("*").alias("links"))
    found = label.select("a", "label").join(degree.hint("merge"), "a")
    return members.join(found.hint("merge"), members.rep == found.a, "left").select("id", F.coalesce("label", "rep").alias("group"), F.coalesce("links", F.lit(0)).alias("links"))
