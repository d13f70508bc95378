r"""Law extraction as pure ``Column -> Column`` expressions.

Patterns name their classes (``\p{L}``, ``\p{Nd}`` ...) rather than ``\w`` or ``\d``, so that they mean the same with
Unicode text in Java and in RE2. "Matched" is always tested with ``rlike``, as an empty group isn't a missing match.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal the published pipeline's for equal results.
MONTHS = {
    "janeiro": "01", "fevereiro": "02", "março": "03", "abril": "04", "maio": "05", "junho": "06",
    "julho": "07", "agosto": "08", "setembro": "09", "outubro": "10", "novembro": "11", "dezembro": "12",
}
DOCUMENT_TYPES = {"lei": "Lei", "lei.complementar": "Lei Complementar", "decreto.lei": "Decreto Lei"}
EXCLUDED_TYPES = ("decreto", "portaria", "medida", "instrução", "resolução")
URN_PREFIX = "urn:lex:br:federal:"
VALID_URN_PREFIXES = tuple(f"{URN_PREFIX}{t}:" for t in ("lei", "decreto.lei", "lei.complementar"))
URL_PREFIX = "https://normas.leg.br/?urn="
PLACEHOLDER_DATE = "1900-01-01"
MIN_YEAR, MAX_YEAR = 1800, 2100
DATE_WINDOW, TITLE_WINDOW = 1000, 200

# White space as Python's str methods and regex see it.
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
_DAY_MONTH_YEAR = rf"(\p{{Nd}}{{1,2}})[ºª°]?{WS}*de{WS}*({WORD}+){WS}*de{WS}*(\p{{Nd}}{{4}})"
_NUMBER = rf"Le[iı] n[°º]{WS}*([0-9.]+)"
NUMBER_DATE = rf"{_NUMBER},{WS}*de{WS}*{_DAY_MONTH_YEAR}"
NUMBER_ONLY = _NUMBER
CONTENT_DATE = _DAY_MONTH_YEAR
TITLE_NUMBERED = rf"Le[iı] n[°º]{WS}*[0-9.]+[^\\n]*"
TITLE_GENERIC = r"(Le[iı] [^\\n]{20,100})"
URN_PARTS = r"urn:lex:br:federal:\b(lei|lei\.complementar|decreto\.lei)\b:([0-9-]+);(\p{Nd}+)"
ANY_CASE = "(?iu)"
FULLWIDTH_DIGITS = "０１２３４５６７８９"


def _map(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def _look_up(d: dict[str, str], key: Column, default: str | None = None) -> Column:
    got = F.try_element_at(_map(d), key)
    return got if default is None else F.coalesce(got, F.lit(default))


def strip(c: Column) -> Column:
    """Python's strip(): every Unicode white space, not only blanks."""
    return F.regexp_replace(c, rf"^{WS}+|{WS}+$", "")


def truthy(c: Column) -> Column:
    """Python's truth of a string: neither NULL nor empty; never NULL itself."""
    return c.isNotNull() & (c != "")


def to_int(c: Column) -> Column:
    """int() of a text; NULL where Python would raise. Full-width digits count."""
    return F.translate(strip(c), FULLWIDTH_DIGITS, "0123456789").try_cast("int")


def is_law(filename: Column) -> Column:
    """X1. NULL counts as no law."""
    low = F.lower(filename)
    return F.coalesce(low.contains("lei") & ~reduce(or_, (low.contains(x) for x in EXCLUDED_TYPES)), F.lit(False))


def _date_struct(text: Column, pattern: str, first: int) -> Column:
    # One search for the whole match; the groups come from that short span.
    span = F.regexp_extract(text, ANY_CASE + pattern, 0)
    part = lambda i: F.regexp_extract(span, ANY_CASE + pattern, i)
    year = part(first + 2)
    month = _look_up(MONTHS, F.lower(part(first + 1)), "01")
    return F.struct(F.concat_ws("-", year, month, F.lpad(part(first), 2, "0")).alias("date"), year.alias("year"))


def filename_date(filename: Column) -> Column:
    """struct(number, date, year) or NULL."""
    span = F.regexp_extract(filename, ANY_CASE + NUMBER_DATE, 0)
    d = _date_struct(filename, NUMBER_DATE, 2)
    number = F.replace(F.regexp_extract(span, ANY_CASE + NUMBER_DATE, 1), F.lit("."), F.lit(""))
    return F.when(filename.rlike(ANY_CASE + NUMBER_DATE), F.struct(number.alias("number"), d["date"].alias("date"), d["year"].alias("year")))


def filename_number(filename: Column) -> Column:
    """The number alone, or NULL; may be empty ("Lei nº ..")."""
    got = F.replace(F.regexp_extract(filename, ANY_CASE + NUMBER_ONLY, 1), F.lit("."), F.lit(""))
    return F.when(filename.rlike(ANY_CASE + NUMBER_ONLY), got)


def content_date(content: Column) -> Column:
    """struct(date, year) of the first date in the first 1000 code points, or NULL."""
    head = F.substring(content, 1, DATE_WINDOW)
    return F.when(head.rlike(ANY_CASE + CONTENT_DATE), _date_struct(head, CONTENT_DATE, 1))


def law_info(filename: Column, content: Column) -> Column:
    """struct(number, date, year); NULL when no number is found."""
    full, number = filename_date(filename), filename_number(filename)
    d = content_date(content)
    return F.when(full.isNotNull(), full).when(
        number.isNotNull(), F.struct(number.alias("number"), d["date"].alias("date"), d["year"].alias("year"))
    )


def construct_urn(number: Column, date: Column) -> Column:
    """X7."""
    return F.concat(F.lit(URN_PREFIX + "lei:"), F.coalesce(F.nullif(date, F.lit("")), F.lit(PLACEHOLDER_DATE)), F.lit(";"), number)


def construct_url(urn: Column) -> Column:
    """X9."""
    return F.concat(F.lit(URL_PREFIX), urn)


def title(filename: Column, content: Column) -> Column:
    """X10. The two classes exclude the backslash and the letter n, as the published titles do."""
    base = F.replace(filename, F.lit(".txt"), F.lit(""))
    head = F.substring(content, 1, TITLE_WINDOW)
    a, b = ANY_CASE + TITLE_NUMBERED, ANY_CASE + TITLE_GENERIC
    found = strip(F.when(head.rlike(a), F.regexp_extract(head, a, 0)).when(head.rlike(b), F.regexp_extract(head, b, 0)))
    better = (F.char_length(found) > F.char_length(base)) & (F.char_length(found) < 200)
    return strip(F.when(better, found).otherwise(base))


def url_law(url: Column) -> Column:
    """struct(filename, number, date, year, title, urn, original_content), or NULL for a line that is no law."""
    urn = F.get(F.split(strip(url), "urn="), F.lit(1))
    part = lambda i: F.regexp_extract(urn, URN_PARTS, i)
    date = F.nullif(part(2), F.lit(PLACEHOLDER_DATE))
    number = part(3)
    return F.when(
        F.coalesce(urn.rlike(URN_PARTS), F.lit(False)),
        F.struct(
            F.concat(F.lit("Lei "), number, F.lit(" from URL")).alias("filename"),
            number.alias("number"),
            date.alias("date"),
            F.get(F.split(date, "-"), F.lit(0)).alias("year"),
            F.concat(_look_up(DOCUMENT_TYPES, part(1)), F.lit(" nº "), number).alias("title"),
            urn.alias("urn"),
            F.lit("").alias("original_content"),
        ),
    )


def is_valid_year(year: Column) -> Column:
    """X11; never NULL."""
    return F.coalesce(to_int(year).between(MIN_YEAR, MAX_YEAR), F.lit(False))


def is_valid_urn(urn: Column) -> Column:
    """X12; never NULL."""
    return F.coalesce(reduce(or_, (urn.startswith(p) for p in VALID_URN_PREFIXES)), F.lit(False))


def is_placeholder(urn: Column) -> Column:
    """X13; never NULL."""
    return F.coalesce(urn.contains(PLACEHOLDER_DATE), F.lit(False))


def decade(year: Column) -> Column:
    """X14."""
    return (F.floor(to_int(year) / 10) * 10).cast("int")


def title_has(c: Column, keyword: str) -> Column:
    """X15."""
    return F.coalesce(F.lower(c).contains(keyword.lower()), F.lit(False))


def display(number: Column, text: Column, width: int = 60) -> Column:
    """Number right-aligned in six, then the first width code points and an ellipsis."""
    return F.concat(F.format_string("%6s", number), F.lit(" | "), F.substring(text, 1, width), F.lit("..."))
