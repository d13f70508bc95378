r"""Problem 1: cutting oversized texts at natural boundaries.

Method: lexical-cohesion segmentation. At every possible cut the word counts of the BLOCK words before and after are
compared (cosine); where cohesion falls, a topic ends. A cut's depth is how far its similarity lies below the peaks on
either side, however far off these are. From where a piece starts, the natural boundaries (article or heading, paragraph,
line, sentence) in the window that would fill it between MIN_FILL and the limit are looked at, and the deepest valley
among them wins. The kind of boundary adds to the depth, a little for each step (STEP), so that of valleys of much the
same depth the one at an article is taken, and a flat text is cut at its strongest boundary; the later one wins a tie. A
window without a natural boundary is cut at the deepest valley between its words, one without any (an unbroken run) at
the limit. Each further piece starts exactly `overlap` characters before the end of the one before.

Only oversized texts reach Python; the rest pass through the JVM as one piece. One narrow stage, no shuffle; work is
linear in the text.

Guarantees: pieces are at most max_size code points; without the overlaps they join to the text as stored. Edge cases:
NULL gives no piece; an empty text one empty piece; a field without limit one piece; equal rows equal pieces; an overlap
of half the limit or more is an error, as pieces might then not advance.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK, MIN_FILL, STEP = 60, 0.5, 0.02
_WORD = re.compile(r"[^\W\d_]{3,}")
_HEAD = r"(?:Art\.|ART\.|§|CAPÍTULO|TÍTULO|SEÇÃO|Seção|ANEXO|Anexo|Parágrafo|PARÁGRAFO)"
# Strength, pattern; a cut lies behind a match, so that white space stays with the piece before.
_KINDS = [
    (5, re.compile(rf"\n\s*(?={_HEAD}[\s\d])")),
    (4, re.compile(r"\r?\n[ \t]*\r?\n\s*(?=\S)")),
    (3, re.compile(r"\r?\n(?=[^\r\n])")),
    (2, re.compile(r"(?<=[^\W\d_]{2}[.!?…;:])[”’»\")\]]*\s+(?=[^\sa-zà-öø-ÿ])|(?<=[。！？।؟])(?![”’」』）])")),
    (1, re.compile(r"\s+(?=\S)")),
]


def cuts(text: str) -> list[tuple[int, int]]:
    """(position, strength) of every possible cut, by position."""
    found: dict[int, int] = {}
    for strength, pattern in _KINDS:
        for m in pattern.finditer(text):
            if 0 < m.end() < len(text):
                found.setdefault(m.end(), strength)
    return sorted(found.items())


def _similarity(words: list[str], i: int) -> float:
    a, b = Counter(words[max(0, i - BLOCK) : i]), Counter(words[i : i + BLOCK])
    if not a or not b:
        return 0.0
    dot = sum(n * b[w] for w, n in a.items())
    return dot / math.sqrt(sum(n * n for n in a.values()) * sum(n * n for n in b.values()))


class _Words:
    """The words of a text, for the similarity of what stands before and after a place."""

    def __init__(self, text: str):
        found = list(_WORD.finditer(text))
        self.words, self.starts = [m.group().lower() for m in found], [m.start() for m in found]

    def depths(self, at: list[int]) -> list[float]:
        """Depth of the cohesion valley at each position (ascending). Peaks are climbed to as long as the similarity
        doesn't fall, which takes one pass in each direction."""
        sims = [_similarity(self.words, bisect_left(self.starts, p)) for p in at]
        left, right = sims[:], sims[:]
        for k in range(1, len(sims)):
            if sims[k - 1] >= sims[k]:
                left[k] = left[k - 1]
        for k in range(len(sims) - 2, -1, -1):
            if sims[k + 1] >= sims[k]:
                right[k] = right[k + 1]
        return [a - s + b - s for s, a, b in zip(sims, left, right)]


def split_text(text: str, max_size: int, overlap: int = 0) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a text."""
    if max_size < 1 or not 0 <= overlap * 2 < max(max_size, 1):
        raise ValueError("max_size must be positive and overlap less than half of it")
    if len(text) <= max_size:
        return [(0, len(text))]
    places, words = cuts(text), _Words(text)
    natural = [p for p, s in places if s > 1]
    depth = dict(zip(natural, words.depths(natural)))
    pieces, start, first = [], 0, 0
    while len(text) - start > max_size:
        last = start + max_size
        # A cut must leave something new behind the overlap.
        least = max(start + int(max_size * MIN_FILL), (pieces[-1][1] if pieces else 0) + 1)
        while first < len(places) and places[first][0] < least:
            first += 1
        k, window = first, []
        while k < len(places) and places[k][0] <= last:
            window.append(places[k])
            k += 1
        best = max(((round(depth[p] + STEP * s, 9), p) for p, s in window if s > 1), default=None)
        if best is None and window:
            at = [p for p, _ in window]
            best = max(zip((round(d, 9) for d in words.depths(at)), at))
        end = best[1] if best else last
        pieces.append((start, end))
        start = end - overlap
    pieces.append((start, len(text)))
    return pieces


def _split(limits: dict[tuple[str, str], tuple[int, int]]):
    names = ["src", "fld", "ord", "piece_no", "start_pos", "end_pos", "piece"]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for src, fld, ord_, text in zip(*(c.to_pylist() for c in batch.columns)):
                rows = [(src, fld, ord_, i, a, b, text[a:b]) for i, (a, b) in enumerate(split_text(text, *limits[src, fld]))]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)

    return run


def split_oversized(values: DataFrame, limits: dict[tuple[str, str], tuple[int, int]]) -> DataFrame:
    """Pieces (src, fld, ord, piece_no, start_pos, end_pos, piece) of values (src, fld, ord, text); limits holds (max_size,
    overlap) by (src, fld), a few fields."""
    values = values.where("text IS NOT NULL").select("src", "fld", F.col("ord").cast("long").alias("ord"), "text")
    size = F.char_length("text").cast("long")
    most = F.lit(None).cast("long")
    for (src, fld), (max_size, _) in limits.items():
        most = F.when((F.col("src") == src) & (F.col("fld") == fld), F.lit(max_size).cast("long")).otherwise(most)
    large = F.coalesce(size > most, F.lit(False))
    zero = F.lit(0).cast("long")
    whole = values.where(~large).select("src", "fld", "ord", zero.alias("piece_no"), zero.alias("start_pos"), size.alias("end_pos"), F.col("text").alias("piece"))
    cut = values.where(large).mapInArrow(_split(limits), "src string, fld string, ord long, piece_no long, start_pos long, end_pos long, piece string")
    return whole.unionAll(cut)


def read_limits(size_limits: DataFrame, purpose: str = "split") -> dict[tuple[str, str], tuple[int, int]]:
    """limits from a table of one row per field, of which there may be at most 1,000."""
    rows = size_limits.where((F.col("purpose") == purpose) & F.col("max_size").isNotNull()).limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("size_limits is meant to hold one row per field")
    return {(r.src, r.fld): (r.max_size, r.overlap or 0) for r in rows}
