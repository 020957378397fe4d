"""Text, dates and numbers as Column expressions; Python only where no built-in exists (NFKD, HTML entities)."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers of printed documents.
DOCUMENT_NUMBER = r"\b(\d{1,2}/\d{1,6})\b"

#: German month names (fixed values).
MONTHS = "januar februar märz april mai juni juli august september oktober november dezember".split()


def clean_text(s: Column) -> Column:
    """NBSP variants become blanks, soft hyphens go, white space collapses; null is empty."""
    spaced = F.translate(F.coalesce(s, F.lit("")), "\u00a0\u202f\u00ad", "  ")
    return F.trim(F.regexp_replace(spaced, r"(?U)\s+", " "))


def iso_date(s: Column) -> Column:
    """``25.03.2025`` as a date; empty and malformed are null."""
    return F.try_to_timestamp(F.trim(s), F.lit("d.M.yyyy")).cast("date")


def german_date(s: Column) -> Column:
    """The first ``03.03.2025`` in a text, else the first ``3. März 2025``, as a date."""
    named = r"(\d{1,2})\.\s*(?i:(" + "|".join(MONTHS) + r"))\s+(\d{4})"
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.regexp_extract(s, named, 2)))
    words = F.when(
        month > 0,
        F.try_to_timestamp(
            F.concat_ws(".", F.regexp_extract(s, named, 1), month.cast("string"), F.regexp_extract(s, named, 3)),
            F.lit("d.M.yyyy"),
        ).cast("date"),
    )
    numeric = iso_date(F.nullif(F.regexp_extract(s, r"\d{1,2}\.\d{1,2}\.\d{4}", 0), F.lit("")))
    return F.coalesce(numeric, words)


@F.pandas_udf(T.StringType())
def nfkd_ascii(s: pd.Series) -> pd.Series:
    """Compatibility decomposition without what is not ASCII; Spark has no such function."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())


@F.pandas_udf(T.StringType())
def unescape_html(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else html.unescape(x))


#: How German letters are spelled in ASCII (fixed values).
GERMAN_ASCII = {"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss", "ı": "i"}
#: Parts of titles that are no part of a name (fixed values).
TITLES = ("dr", "prof", "med", "jur", "rer", "nat", "phil", "h.c", "dipl", "ing", "mdb")


def normalize_name(s: Column) -> Column:
    """Lower-case ASCII without accents, titles and punctuation; null is empty."""
    low = F.lower(F.coalesce(s, F.lit("")))
    for letter, spelled in GERMAN_ASCII.items():
        low = F.replace(low, F.lit(letter), F.lit(spelled))
    titles = r"\b(?:" + "|".join(t.replace(".", r"\.") for t in TITLES) + r")\b\.?"
    plain = F.regexp_replace(F.regexp_replace(nfkd_ascii(low), titles, " "), "[^a-z ]+", " ")
    return F.trim(F.regexp_replace(plain, " +", " "))


def first_token(s: Column) -> Column:
    return F.split(s, " ")[0]


def last_tokens(s: Column, n: int) -> Column:
    """The last ``n`` words; all if there are fewer."""
    return F.array_join(F.slice(F.split(s, " "), -F.least(F.lit(n), F.size(F.split(s, " "))), F.lit(n)), " ")


def mapped(key: Column, values: Mapping[str, str], otherwise: Column | None = None) -> Column:
    """A literal dictionary's value of ``key``; else ``otherwise``, or null."""
    table = F.create_map(*(F.lit(x) for pair in values.items() for x in pair))
    found = F.try_element_at(table, key)
    return found if otherwise is None else F.coalesce(found, otherwise)


def document_numbers(s: Column) -> Column:
    """All document numbers of a text, in order (X11)."""
    return F.regexp_extract_all(s, F.lit(DOCUMENT_NUMBER), F.lit(1))


def decimal_comma(s: Column) -> Column:
    """``3,5`` as a double; empty and malformed are null."""
    return F.replace(s, F.lit(","), F.lit(".")).try_cast("double")


def leading_int(s: Column) -> Column:
    """The number that a text begins with (O4); null without one, where a plain cast would fail."""
    return F.nullif(F.regexp_extract(s, r"^\s*(\d+)", 1), F.lit("")).try_cast("int")


def first_page(pages: Column) -> Column:
    """``12-14`` gives 12."""
    return leading_int(F.split(pages, "-")[0])


def page_range(first: Column, last: Column) -> Column:
    """``12-14``, or ``12`` where there is no other end."""
    return F.when(last.isNull() | (first == last), first.cast("string")).otherwise(F.concat_ws("-", first, last))


def strip_tags(s: Column) -> Column:
    """Scripts, styles and tags go, white space collapses (X21, before entities)."""
    body = F.regexp_replace(s, r"(?s)<(script|style)[^>]*>.*?</(script|style)>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(body, r"<[^>]+>", " "), r"\s+", " "))


#: Abbreviations that a sentence does not end with (fixed values).
ABBREVIATIONS = ("Dr", "Prof", "Nr", "Art", "Abs", "bzw", "ca", "d. h", "z. B", "u. a", "St", "Mio", "Mrd")


def sentences(s: Column, abbreviations: Sequence[str] = ABBREVIATIONS) -> Column:
    """Cut after ``.!?:`` and white space before a capital or a quote, not after an abbreviation."""
    not_after = "".join(rf"(?<!\b{a.replace('.', chr(92) + '.')}\.)" for a in abbreviations)
    return F.filter(F.split(s, rf"(?<=[.!?:]){not_after}\s+(?=[\p{{Lu}}\d„\"(–-])"), lambda x: F.length(x) > 0)


def words(s: Column, longer_than: int = 0) -> Column:
    """Distinct lower-case words."""
    found = F.regexp_extract_all(F.lower(s), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.array_distinct(F.filter(found, lambda x: F.length(x) > longer_than))


def overlap_ratio(a: Column, b: Column) -> Column:
    """Shared elements over the smaller set, at least 1."""
    return F.size(F.array_intersect(a, b)) / F.greatest(F.lit(1), F.least(F.size(a), F.size(b)))


def period_of(day: Column, starts: Sequence[tuple[str, int]]) -> Column:
    """Number of the period with the latest start at or before ``day``."""
    out = F.lit(None).cast("int")
    for start, number in sorted(starts):
        out = F.when(day >= F.lit(start).cast("date"), F.lit(number)).otherwise(out)
    return out


def longest_prefix(s: Column, entries: Sequence[str]) -> Column:
    """The longest entry that ``s`` starts with."""
    out = F.lit(None).cast("string")
    for e in sorted(entries, key=len):
        out = F.when(F.startswith(s, F.lit(e)), F.lit(e)).otherwise(out)
    return out


def unix_day(seconds: Column) -> Column:
    """The UTC day of an epoch second."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))


def document_id(*parts: Column) -> Column:
    """A citable id: the parts joined by slashes."""
    return F.concat_ws("/", *parts)
