r"""Problem 5: one consistent form for text that looks alike.

Method: DuckDB runs inside the Arrow partitions. Its SQL composes letters with their accents (nfc_normalize), folds
compatibility forms and look-alike letters (translate, replace) and drops or replaces invisible characters and odd
spaces (regular expressions). A value without any suspicious character, as nearly all are, passes after one search.

Letters of another script are folded only within Latin text: in a word that also holds Latin letters, or in a word made
of look-alikes alone whose neighbours are Latin. Symbols and passages of another script stay as they are, joiners within
Arabic and Indic words and ideographic spaces between ideographs too.

A value is a case when its consistent form differs from it. NULL stays NULL and is no case; empty values stay empty; equal
values get equal forms, and a form is its own form. Rows are handled one by one, without a shuffle;
DuckDB gets PART_BYTES of text at a time, or one value.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text that DuckDB is given at once; its memory is many times that.
PART_BYTES = 8_000_000

# Characters that stay though compatibility folding would change them.
ORDINARY = "ªº²³¹"
INVISIBLE = r"\x{00AD}\x{034F}\x{061C}\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{2066}-\x{2069}\x{FE00}-\x{FE0F}\x{FEFF}"
SPACES = r"\x{00A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}"
JOINING = r"\p{Arabic}\p{Devanagari}\p{Bengali}\p{Gurmukhi}\p{Gujarati}\p{Tamil}\p{Telugu}\p{Kannada}\p{Malayalam}\p{Sinhala}"
IDEOGRAPHS = r"\p{Han}\p{Hiragana}\p{Katakana}\x{3001}-\x{3011}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF1F}"
LATIN_ODD = {"ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʟ": "l", "ʀ": "r", "ɴ": "n", "ɪ": "i", "ʏ": "y", "ʙ": "b", "ʜ": "h", "ǀ": "l"}
SAME_LOOK = {
    # Cyrillic
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ӏ": "l", "ү": "y", "г": "r", "т": "t", "к": "k", "м": "m", "п": "n", "ь": "b",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Ѵ": "V", "Ԁ": "D", "Ғ": "F", "Ӏ": "I",
    # Greek
    "α": "a", "ο": "o", "ν": "v", "υ": "u", "ι": "i", "ρ": "p", "κ": "k", "τ": "t", "χ": "x", "γ": "y", "η": "n", "ω": "w", "ϲ": "c", "ϳ": "j", "ε": "e",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    # Armenian
    "օ": "o", "ս": "u", "հ": "h", "ց": "g", "ո": "n", "զ": "q", "ա": "w", "Օ": "O", "Ս": "U", "Տ": "S", "Լ": "L",
}
#: Of these a word of its own may consist and still stand for Latin text; the rest count only beside Latin letters.
ALONE = "".join(c for c in SAME_LOOK if c not in "гткмпьακτχγηιρωε")
_DIGITS = (0x0660, 0x06F0, 0x0966, 0x09E6, 0x0E50, 0x07C0)
_DIGIT_LETTERS = (r"\p{Arabic}", r"\p{Arabic}", r"\p{Devanagari}", r"\p{Bengali}", r"\p{Thai}", r"\p{Nko}")


def _styled() -> dict[str, str]:
    """By rule: letters and numbers whose compatibility form is ASCII letters and digits, and half-width kana."""
    out = {}
    for a, b in ((0x00A0, 0x2FFF), (0xA700, 0xABFF), (0xFB00, 0xFB06), (0xFF00, 0xFFDC), (0x1D400, 0x1D7FF), (0x1F100, 0x1F1FF)):
        for i in range(a, b + 1):
            c = chr(i)
            if c in ORDINARY or unicodedata.category(c)[0] not in "LN":
                continue
            k = unicodedata.normalize("NFKC", c)
            if k != c and (k.isascii() and k.isalnum() or 0xFF66 <= i <= 0xFF9D):
                out[c] = k
    return out


_STYLED = _styled()
_ONE = {c: k for c, k in _STYLED.items() if len(k) == 1} | LATIN_ODD
SINGLE = _ONE
_MANY = {c: k for c, k in _STYLED.items() if len(k) > 1}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _class(chars) -> str:
    """A character class of the fewest ranges."""
    codes, out = sorted(map(ord, chars)), []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" if a < b else f"\\x{{{a:X}}}" for a, b in out)


def _sql() -> str:
    """src, fld, ord, text, form of the table batch. Each step is a table expression of its own."""
    latin, mark = r"A-Za-z\x{00C0}-\x{024F}\x{1E00}-\x{1EFF}", r"\x{0300}-\x{036F}"
    foreign, alone, others = _class(SAME_LOOK), _class(ALONE), r"\p{Cyrillic}\p{Greek}\p{Armenian}"
    own_digits = ["".join(chr(a + i) for i in range(10)) for a in _DIGITS]
    suspicious = f"[{_class(_STYLED)}{_class(LATIN_ODD)}{INVISIBLE}{SPACES}{mark}{foreign}{_class(''.join(own_digits))}]"

    def sub(x: str, pattern: str, to: str) -> str:
        return f"regexp_replace({x}, {_q(pattern)}, {_q(to)}, 'g')"

    # Joiners and ideographic spaces that belong to a script wait behind private-use characters.
    wait, back = "", "‌‍　"
    kept = sub(sub(sub("text", f"([{JOINING}])‌", "\\1" + wait[0]), f"([{JOINING}])‍", "\\1" + wait[1]), f"([{IDEOGRAPHS}])　([{IDEOGRAPHS}])", "\\1" + wait[2] + "\\2")
    plain = f"translate({sub(sub(kept, f'[{INVISIBLE}]+', ''), f'[{SPACES}]', ' ')}, {_q(''.join(_ONE))}, {_q(''.join(_ONE.values()))})"
    joined = "a"
    for c, k in _MANY.items():
        joined = f"replace({joined}, {_q(c)}, {_q(k)})"
    word = r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}]+"
    to_latin = f"translate(w, {_q(''.join(SAME_LOOK))}, {_q(''.join(SAME_LOOK.values()))})"
    has_latin = lambda e: f"regexp_matches({e}, '[{latin}]')"
    is_foreign = lambda e: f"regexp_matches(regexp_replace({e}, '[{alone}]+', '', 'g'), '[{others}]')"
    before, after = "coalesce(ws[i - 2], '')", "coalesce(ws[i + 2], '')"
    fold = f"""CASE WHEN NOT regexp_matches(w, '[{foreign}]') THEN w WHEN {has_latin("w")} THEN {to_latin}
        WHEN regexp_full_match(w, '[{alone}]+') AND ({has_latin(before)} OR {has_latin(after)}) AND NOT {is_foreign(before)} AND NOT {is_foreign(after)} THEN {to_latin} ELSE w END"""
    last = "d"
    for own, letters in zip(own_digits, _DIGIT_LETTERS):  # RE2 counts digits among a script, so its letters are looked for without them
        bare = f"regexp_replace(d, '[{_class(own)}]+', '', 'g')"
        last = f"translate({last}, CASE WHEN NOT regexp_matches({bare}, '[{letters}]') THEN {_q(own)} ELSE '' END, '0123456789')"
    return f"""
    WITH t0 AS (SELECT *, coalesce(regexp_matches(text, {_q(suspicious)}), false) AS s FROM batch),
    t1 AS (SELECT *, CASE WHEN s THEN {plain} END AS a FROM t0),
    t2 AS (SELECT *, nfc_normalize(CASE WHEN s AND regexp_matches(a, '[{_class(_MANY)}]') THEN {joined} ELSE a END) AS c FROM t1),
    t3 AS (SELECT *, CASE WHEN s AND regexp_matches(c, '[{foreign}]') THEN regexp_extract_all(c, {_q(word)}) END AS ws FROM t2),
    t4 AS (SELECT *, CASE WHEN ws IS NOT NULL THEN array_to_string(list_transform(ws, lambda w, i: {fold}), '') ELSE c END AS d FROM t3)
    SELECT src, fld, ord, text, CASE WHEN s THEN translate({last}, {_q(wait)}, {_q(back)}) ELSE text END AS form FROM t4"""


SQL = _sql()


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """batch in parts of at most PART_BYTES of text, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
    first, size = 0, 0
    for i, n in enumerate(sizes):
        if i > first and size + n > PART_BYTES:
            yield batch.slice(first, i - first)
            first, size = i, 0
        size += n
    if first < len(sizes):
        yield batch.slice(first)


def _run(only_cases: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "512MB", "temp_directory": ""})
        query = f"SELECT src, fld, ord, coalesce(form IS DISTINCT FROM text, false) AS is_case, form, text FROM ({SQL})"
        query += " WHERE form IS DISTINCT FROM text" if only_cases else ""
        for b in (part for batch in batches for part in _parts(batch)):
            con.register("batch", pa.Table.from_batches([b]))
            got = con.sql(query).to_arrow_table()
            con.unregister("batch")
            yield from got.cast(pa.schema([("src", pa.string()), ("fld", pa.string()), ("ord", pa.int64()), ("is_case", pa.bool_()), ("form", pa.string()), ("text", pa.string())])).to_batches()
        con.close()

    return run


def consistent_form(values: DataFrame, only_cases: bool = False) -> DataFrame:
    """src, fld, ord, is_case, form, text of values (src, fld, ord, text); only_cases: just the values that change."""
    v = values.select("src", "fld", F.col("ord").cast("long").alias("ord"), "text")
    return v.mapInArrow(_run(only_cases), "src string, fld string, ord long, is_case boolean, form string, text string")
