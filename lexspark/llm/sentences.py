r"""Problem 4: sentence units, all in SQL expressions.

Method: protect, split, restore. A private-use placeholder (GUARD) is put behind every terminator that doesn't end a unit
(decimals and item numbers, URLs, initials, abbreviations, labels, terminators inside quotes and brackets); terminators
of each script that carry no guard get a second placeholder (CUT); the text is split at CUT and the guards are taken
out again. Positions are sums of restored lengths, so they count code points of the text as stored.

Quotes, brackets and addresses are followed from where they open, each terminator inside from the one before (\G), so that
they may be of any length and every character is looked at a bounded number of times. Every row is handled by itself: one
narrow stage, no shuffle, no Python. Work is linear in the text, but for running sums of positions, which are made in
blocks of as many units as there are blocks (a step copies an array of that length).

Results in edge cases: NULL, empty and blank texts have no units; a text without terminators is one unit per line; equal
rows give equal units; private-use characters that equal a placeholder count as ordinary characters and come back as
stored.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.encoding import misread
from lexspark.llm.lookalikes import SAME_LOOK, SINGLE

GUARD, CUT, OTHER = "", "", "￼"

# Abbreviations in common use in Portuguese, Spanish, English, French, German, Russian, Arabic and Hindi texts.
# Forms with a capital first letter and all in capitals follow by rule.
_WORDS = "art arts nn inc incs pp fl fls seç sec proc rel ac cf núm num aprox doc docs párr párrs al ex obs ref séc tel alín ст тыс"
_TITLES = "Sr Sra Srs Dr Dra Drs Exma Exmo Min Des Prof Inst Cia Av Mr Mrs Ms Messrs Mme St Abs Nr Bd"
_LETTERS = r"n N p P j J v V M i z g п П د डॉ v\.g p\.ex"
# Those that end a unit unless a lower-case word follows, and those that are abbreviations only before a figure.
_COMPANY, _ENDING = "Jr Ltda Inc Co Corp", "etc usw руб"
_PATTERNS = r"min г Г \p{Lu}\.\p{Lu} i\.\s?e e\.\s?g z\.\s?B d\.\s?h"
_FIGURE = "no para par cap tít sect ch núms"
# In text all in capitals the next word tells instead of its case: conjunctions, genitives and auxiliary verbs go on.
_ON = "e ou nem y and or de da do das dos del of que that quando then deverá caberá poderá shall"


def _forms(words: str, lower: bool = True) -> str:
    return "|".join(dict.fromkeys(f for w in words.split() for f in ([w] if lower else []) + [w[0].upper() + w[1:], w.upper()]))


NEVER = "|".join((_forms(_WORDS), _forms(_TITLES, False), *_LETTERS.split()))
MAY_END = "|".join((_forms(_ENDING), _forms(_COMPANY, False), *_PATTERNS.split()))
BEFORE_FIGURE, GOES_ON = _forms(_FIGURE), "|".join(w.upper() for w in _ON.split())
#: No abbreviation ends in that many small letters, so that longer words needn't be looked up.
_LONG_WORD = 1 + max(len(re.search(r"[^\W\d_A-Z]*$", w)[0]) for w in f"{NEVER}|{MAY_END}|{BEFORE_FIGURE}".split("|"))

# Terminators: those of Latin text, those of other scripts that take a space, those that take none.
_ASCII, _SPACED, _CJK = ".!?", "…؟।॥۔։።", "。！？｡"
_LABEL = r"[IVXLCDM]{1,7}\s?[-–—]\s|(?:\p{L}|\d{1,3})[\u200b-\u200d]?\)\s|[•▪●]\s"

def _unix(t: Column) -> Column:
    t = F.regexp_replace(F.regexp_replace(t, "\r\n", " \n"), "\r", "\n")
    return F.regexp_replace(t, "[\x0b\x0c\x85\u2028\u2029]", "\n")


def _unwrap(t: Column) -> Column:
    """Text broken at a fixed width: a line break becomes a space, but for blank lines and those before list items. Items
    run on inside a line may also stand behind a break; the item before them tells."""
    t = F.regexp_replace(t, r"([:;] [IVX]{1,4} [-–] [^\n]*+)\n(?=[IVX]{1,4} [-–] )", "$1 ")
    return F.regexp_replace(t, rf"\n(?<=\S[ ]?\n)(?=[ ]?\S)(?![ ]?(?:{_LABEL}))", " ")


#: A line that breaks within a sentence (looked for by its end, as a search for one character is the fastest); a line
#: longer than text is set.
_BROKEN, _UNBROKEN = r"\n(?<=[\p{Ll}\p{Nd},؀-ۿऀ-ॣ][ ]?\n)(?!\p{Ll}\))[\p{Ll}؀-ۿऀ-ॣ]", r"(?:^|\n)[^\n]{126}"


def _is_wrapped(t: Column) -> Column:
    """More lines break within a sentence than run long."""
    return t.rlike(_BROKEN) & (F.regexp_count(t, F.lit(_BROKEN)) > F.regexp_count(t, F.lit(_UNBROKEN)))


_MARKS, _CLOSING = "()«»“-‟「-』", "”»」』)"


def _inside(opens: str, stops: str, closes: str, terms: str, but: str) -> str:
    """The way to the next terminator (terms, unless `but` follows) in a passage that begins at `opens` and runs, without
    a character of stops, up to one of closes."""
    skip = rf"[^{stops}{terms}]*+"
    return rf"(?:{opens}(?=[^{stops}]*+{closes})|\G(?!\A)){skip}(?:[{terms}](?={but}){skip})*+[{terms}](?!{but})"


# From a quotation mark or bracket on, whatever the next one on the line closes is inside, but for the bracket of a label
# such as a).
_CLOSES = rf"[{_CLOSING}](?<!\s(?:\p{{L}}|\p{{Nd}}{{1,3}}|[IVXivx]{{1,5}})\))"
_LATIN_INSIDE = _inside(f"[{_MARKS}]", "\\n" + _MARKS, _CLOSES, ".!?", r"[^\s\p{Lu}]|\z")
_OTHER_INSIDE = _inside(f"[{_MARKS}]", "\\n" + _MARKS, _CLOSES, _SPACED + _CJK, f"[{_CLOSING}]")
_STRAIGHT_INSIDE = _inside(r'(?<=[\s(])"', r'"\n', r'"[\s,;.:)]', ".!?", '"')
_GERMAN_INSIDE = _inside("„", r"„“\n", "“", ".!?", "“")


def _before(words: str) -> str:
    """One look-behind for each length of word, as each of these is tried at one place only."""
    by: dict[int, list[str]] = {}
    for w in words.split("|"):
        by.setdefault(len(w.replace("\\", "")), []).append(w)
    return "(?:" + "|".join(rf"(?<=(?:^|[^\p{{L}}\p{{M}}])(?:{'|'.join(x)})\.)" for x in by.values()) + ")"


def _dots() -> str:
    """Dots that don't end a unit."""
    lower = r"(?=\s+\p{Ll})"
    caps = rf"(?=\s+(?:{GOES_ON})\s)(?<=\p{{Lu}}\.)"
    return (
        rf"\.(?=[\s)])(?<!\p{{Ll}}{{{_LONG_WORD}}}\.)(?:"
        rf"{_before(NEVER)}(?!\n)"
        rf"|(?=\s?\p{{Nd}}){_before(BEFORE_FIGURE)}"
        rf"|(?<=(?:{MAY_END})\.)(?:{lower}|{caps})"
        r"|(?<=\s\p{Lu}\.)(?<!(?:inciso|anexo|item|classe|ANEXO|INCISO|Anexo)\s\p{Lu}\.)(?=\s\p{L})"  # initials
        rf"|(?<=[^\d.,]\d{{1,2}}\.\d{{1,2}}(?:\.\d{{1,2}})?(?:\.\d{{1,2}})?\.){lower}"  # item numbers
        r"|(?<=(?:^|\n|[.!?:;]\s)[ ]?(?:Art|ART)\.\s?\d{1,5}[ºo°]?\.)"  # labels
        r"|(?<=(?:Parágrafo|PARÁGRAFO)\s(?:único|ÚNICO)\.)"
        r"|(?<=(?:^|\n)[ ]?\d{1,3}\.)"
        r"|(?<=\(\.\.\.)(?=\))"
        rf"|(?<=\.\.\.)(?:{lower}|(?=\s(?:{GOES_ON})\s))"
        r"|(?<=\d\.)(?=\s(?:Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember)\s)"  # German dates
        r")"
    )


def _ends(terms: str) -> str:
    cjk = rf"|[{_CJK}]++(?![{GUARD}”’」』）)])|[{_CJK}]++[”’」』）]++(?=\s)" if terms != _ASCII else ""
    after = (
        rf"(?!{GUARD})(?:(?=\s)|[)\]]++(?=\s|\p{{Lu}})|[”’\"»“]++(?=\s+[^\p{{Ll}}\s])(?!\s+(?:E|AND|Y)\s)"
        rf"|(?=[)\]”\"»“«¿¡(\p{{Lu}}])(?<=(?:\p{{L}}\p{{L}}|[\p{{Nd}}%º²λ)”])[{terms}]{{1,4}})[)\]”\"»]*+(?=[“«¿¡(]?\p{{Lu}}[\p{{Ll}}\p{{Lu}} ]))"
    )
    # White space behind an end is taken with it, so that units begin where pieces do. A class comes first, as a search
    # for one character is the fastest.
    if terms == _ASCII:
        return rf"[\n{terms}](?:(?<=\n)|(?<!\n)[{terms}]*+{after})\s*+"
    return rf"(?:\n|[{terms}]++{after}{cjk})\s*+"


# Any but the usual characters, in few ranges.
_ODD = "[\r\x0b\x0c\x80-\xa0\u0131-\u200f\u2026-\u202f\u2040-\U0010ffff]"
_o, _x = (lambda: F.col("_o")), (lambda: F.col("_x"))

# Quotation marks as they look in text decoded with a wrong encoding; the opening ones tell that there are any.
_OPEN, _CLOSE = misread("“"), misread("”")
_QUOTES = "(?:" + "|".join(map(re.escape, _CLOSE)) + ")"


_USUAL = [x for x in _OPEN if not re.search(_ODD, x)]
_THAI = "ก-ຮក-ឳ"


def _seldom(t: Column) -> Column:
    """Whether a text has misread quotation marks, or a script that parts sentences by spaces."""
    odd = "|".join(re.escape(x) for x in _OPEN if x not in _USUAL)
    return reduce(or_, (t.contains(x) for x in _USUAL), _o() & t.rlike(f"[{_THAI}]|{odd}"))


_ANY_OPEN = "|".join(map(re.escape, _OPEN))
_MISREAD_INSIDE = (
    rf"(?:(?:{_ANY_OPEN})(?=(?:(?!{_ANY_OPEN}|{_QUOTES})[^\n])*+{_QUOTES})|\G(?!\A))(?:(?!{_QUOTES})[^\n.!?])*+[.!?]++(?!{_QUOTES})"
)
_URL = r"(?:https?://|www\.|\G(?!\A))[^\s.!?]*+[.!?](?=\S)"


def _guard_seldom(t: Column) -> Column:
    """Terminators within German or misread quotation marks and in addresses."""
    for pattern in (_GERMAN_INSIDE, _MISREAD_INSIDE, _URL):
        t = F.regexp_replace(t, pattern, "$0" + GUARD)
    return t


def _cut_seldom(t: Column) -> Column:
    t = F.regexp_replace(t, rf"[.!?]++(?!{GUARD}){_QUOTES}\s++(?=[^\p{{Ll}}\s])", "$0" + CUT)
    return F.regexp_replace(t, r"(?<=[฀-໿ក-៿\p{Nd}”)])[  ​]+(?=[“(]?[฀-໿ក-៿])", "$0" + CUT)


# For finding boundaries, odd spaces count as spaces and look-alike letters in Latin words as the letters they look like,
# one for one, so that places stay. Texts with words of another script keep that script's letters.
_SPACES = "               　"
_FOLD = SINGLE | SAME_LOOK | dict.fromkeys(_SPACES, " ")
_NEEDS_FOLD = rf"[{_SPACES}ıɑɡＡ-ｚ０-９\x{{1d400}}-\x{{1d7ff}}]|[A-Za-z][Ͱ-ӿԁ]|[Ͱ-ӿԁ][a-z]"


def _fold(t: Column) -> Column:
    spaces = F.translate(t, _SPACES, " " * len(_SPACES))
    return F.when(t.rlike(r"[Ͱ-Ͽ]{4}|[Ѐ-ӿ]{4}"), spaces).otherwise(F.translate(t, "".join(_FOLD), "".join(_FOLD.values())))


# (test, change): a change is made where its test holds; None: everywhere. _o tells whether a text has any but the usual
# characters, _x whether it has terminators of other scripts, so that most texts are searched for three characters only.
_STEPS = [
    (lambda t: _o() & t.rlike("[\r\x0b\x0c\x85  ]"), _unix),
    (_is_wrapped, _unwrap),
    (lambda t: _x(), lambda t: F.regexp_replace(t, _OTHER_INSIDE, "$0" + GUARD)),
    (lambda t: t.contains(")") | t.contains("”") | t.contains("»") | _o(), lambda t: F.regexp_replace(t, _LATIN_INSIDE, "$0" + GUARD)),
    (lambda t: t.contains('"'), lambda t: F.regexp_replace(t, _STRAIGHT_INSIDE, "$0" + GUARD)),
    (lambda t: F.col("_q") | t.contains("„") | t.contains("://") | t.contains("www."), _guard_seldom),
    (None, lambda t: F.regexp_replace(t, _dots(), "$0" + GUARD)),
    (lambda t: _x() & t.contains("…"), lambda t: F.regexp_replace(t, r"…(?=\s\p{Ll})", "$0" + GUARD)),
    (None, lambda t: F.when(_x(), F.regexp_replace(t, _ends(_ASCII + _SPACED), "$0" + CUT)).otherwise(F.regexp_replace(t, _ends(_ASCII), "$0" + CUT))),
    (lambda t: F.col("_q"), _cut_seldom),
]

_BLANKS = " \t\n\r\x0b\x0c\x85\xa0                　﻿"


def _sums(xs: Column, of, start: Column) -> Column:
    """struct<n, at>: the sum of xs and start, and what it was before each of xs."""
    empty = F.struct(start.cast("bigint").alias("n"), F.array().cast("array<bigint>").alias("at"))
    return F.aggregate(xs, empty, lambda acc, x: F.struct((acc["n"] + of(x)).alias("n"), F.concat(acc["at"], F.array(acc["n"])).alias("at")))


def _in_blocks(lengths: Column) -> Column:
    """Sums of the lengths within blocks of the square root of their number."""
    size = F.greatest(F.ceil(F.sqrt(F.size(lengths))).cast("int"), F.lit(64))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / size).cast("int")), lambda i: F.slice(lengths, i * size + 1, size))
    return F.transform(blocks, lambda b: _sums(b, lambda x: x, F.lit(0)))


def _over_blocks(blocks: Column, first: Column) -> Column:
    """Where each piece begins, from the sums within blocks."""
    shift = lambda b, by: F.transform(b["at"], lambda x: x + by)
    return F.flatten(F.zip_with(blocks, _sums(blocks, lambda b: b["n"], first)["at"], shift))


_CHUNK = 512


def sentence_units(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row per unit: the columns of keep, unit_no, start_pos and unit (as stored, trailing white space cut off). keep
    may hold any column but those three; other columns are never read."""
    clash = {"unit_no", "start_pos", "unit"} & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} clash with the result's; rename them")
    t, s, a = F.col("_t"), F.col("_s"), F.col("_a")
    ks = [f"_k{i}" for i in range(len(keep))]
    held = s.rlike(f"[{GUARD}{CUT}]")
    work = df.select(*[F.col(c).alias(k) for c, k in zip(keep, ks)], F.col(text).alias("_s"))
    work = work.withColumn("_o", s.rlike(_ODD))
    work = work.withColumn("_x", _o() & s.rlike(f"[{_SPACED}{_CJK}]")).withColumn("_q", _seldom(s)).withColumn("_f", _o() & (held | s.rlike(_NEEDS_FOLD)))
    work = work.withColumn("_t", F.when(F.col("_f"), F.translate(_fold(s), GUARD + CUT, OTHER * 2)).otherwise(s))
    for i, (test, change) in enumerate(_STEPS):  # each a projection of its own, so that no step is worked out twice
        if i == 2:  # lines are told by now: units of a text in which breaks changed come from the text as stored
            work = work.withColumn("_f", F.col("_f") | (t != s))
        work = work.withColumn("_t", change(t) if test is None else F.when(test(t), change(t)).otherwise(t))
    work = work.withColumn("_t", F.ltrim(F.replace(t, F.lit(GUARD), F.lit("")), F.lit(_BLANKS)))
    lead = (F.char_length(s) - F.char_length(F.replace(t, F.lit(CUT), F.lit("")))).cast("bigint")
    work = work.withColumn("_p", F.split(t, CUT)).withColumn("_l", F.transform("_p", lambda x: F.char_length(x).cast("bigint"))).withColumn("_b", lead)
    work = work.withColumn("_i", _in_blocks(F.col("_l"))).withColumn("_a", _over_blocks(F.col("_i"), F.col("_b"))).withColumn("_c", F.when(F.col("_f"), F.regexp_extract_all(s, F.lit(rf"(?s).{{1,{_CHUNK}}}"), F.lit(0))))

    def unit(x: Column, at: Column) -> Column:
        """A piece, or what is stored in its place: from the chunks that hold it, as a search from the start of the text
        for each unit would take the square of its length."""
        bare = F.rtrim(x, F.lit(_BLANKS))
        n, k = F.char_length(bare), F.floor(at / _CHUNK).cast("int")
        # Named twice, so that the optimizer doesn't put the making of the chunks in here, to be done for each unit.
        chunks = F.slice("_c", k + 1, F.least(F.floor((at + n) / _CHUNK).cast("int"), F.size("_c") - 1) - k + 1)
        kept = F.substring(F.array_join(chunks, ""), (at - k * _CHUNK + 1).cast("int"), n)
        return F.struct(at.alias("start_pos"), F.when(F.col("_f"), kept).otherwise(bare).alias("unit"))

    work = work.withColumn("_a", F.filter(F.zip_with("_p", a, unit), lambda u: u["unit"] != ""))
    # The outer form, as the plain one makes the optimizer infer a filter on the array, which it would work out from
    # the text once more for every reference.
    work = work.select(*ks, F.posexplode_outer(a).alias("_n", "_u")).where(F.col("_u").isNotNull())
    return work.select(*[F.col(k).alias(c) for c, k in zip(keep, ks)], F.col("_n").cast("bigint").alias("unit_no"), "_u.start_pos", "_u.unit")
