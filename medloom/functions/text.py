"""Scalar operators over text as Column expressions: normalisers, extractors and name builders.

Null in gives null out unless said otherwise. Regular expressions use Unicode classes where the text may hold more
than ASCII; whitespace always includes the no-break space.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from medloom import lexicon
from medloom.functions.columns import SPACE, bound, squeeze

# The patterns of numbers, forms, strengths, reasons and dates down to DATES.
MONTH = "(" + "|".join(m.capitalize() for m in lexicon.MONTHS) + ")"
GSR = r"(?i)G\.?\s*S\.?\s*R\.?\s*(\d+)\s*\(?\s*E\s*\)?"
SO = r"(?i)S\.?\s*O\.?\s*(\d+)\s*\(?\s*E\s*\)?"
FORM = (
    r"(?i)\b(tablet|capsule|syrup|suspension|injection|cream|ointment|gel|drops?|lotion|powder|solution|inhaler|spray|patch|suppository|respules|oral\s+liquid|"
    r"dry\s+syrup|infusion|emulsion|eye\s+drops?|ear\s+drops?|nasal\s+drops?)\b"
)
_AMOUNT = r"\d+(?:\.\d+)?\s*(?:mg|g|mcg|ml|iu)\b"
STRENGTH = rf"(?i)({_AMOUNT}(?:\s*/\s*{_AMOUNT})?)|(\d+(?:\.\d+)?\s*%)"
REASONS = (
    r"(?is)(?:reason|ground|basis|because|whereas|in\s+the\s+interest\s+of\s+public\s+health)[:\s]+(.{20,500}?)(?:\.\s|$)",
    r"(?is)(?:no\s+therapeutic\s+justification|risk\s+to\s+human|irrational|unsafe|hazardous|likely\s+to\s+involve\s+risk).{0,300}?(?:\.\s|$)",
)
#: patterns of dates with the positions of day, month and year, in the order they are tried
DATES = (
    (r"(\d{1,2})[/\-](\d{1,2})[/\-](\d{4})", 1, 2, 3, "d/M/yyyy"),
    (r"(\d{1,2})\.(\d{1,2})\.(\d{4})", 1, 2, 3, "d/M/yyyy"),
    (rf"(?i){MONTH}\s+(\d{{1,2}}),?\s+(\d{{4}})", 2, 1, 3, "d/MMMM/yyyy"),
    (rf"(?i)(\d{{1,2}})\s+{MONTH},?\s+(\d{{4}})", 1, 2, 3, "d/MMMM/yyyy"),
    (rf"(?i)(\d{{1,2}})(?:st|nd|rd|th)\s+{MONTH},?\s+(\d{{4}})", 1, 2, 3, "d/MMMM/yyyy"),
)


def found(text: Column, pattern: str, group: int = 0) -> Column:
    """A group of the first match; null without one."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def strip(text: Column) -> Column:
    """Outer whitespace dropped."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def title(text: Column) -> Column:
    """The first letter of every run of letters in upper case, the others in lower case."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{M}]+|[^\p{L}\p{M}]+"), F.lit(0)), lambda w: F.initcap(w)), "")


def normalize_name(name: Column) -> Column:
    """F1. Single blanks, trailing . , ; : gone, words capitalised; words of up to five Roman digits stay in capitals."""
    words = F.split(F.regexp_replace(squeeze(name), "[.,;:]+$", ""), " ")
    return F.array_join(F.transform(words, lambda w: F.when(F.upper(w).rlike("^[IVXLCDM]{1,5}$"), F.upper(w)).otherwise(F.initcap(w))), " ")


def normalize_form(form: Column) -> Column:
    """F2. The stored dosage form of a written one; unknown forms in title case; null for blanks."""
    known = F.create_map(*[F.lit(x) for pair in lexicon.FORMS.items() for x in pair])
    key = F.regexp_replace(F.lower(strip(form)), "[s.]+$", "")
    return F.when(strip(form) != "", F.coalesce(F.element_at(known, key), F.element_at(known, F.concat(key, F.lit("s"))), title(strip(form))))


def normalize_strength(strength: Column) -> Column:
    """F3. Single blanks, and one between a digit and its unit; null for blanks."""
    return F.regexp_replace(F.nullif(squeeze(strength), F.lit("")), r"(?i)([0-9])(mg|ml|g|mcg|iu|%)", "$1 $2")


def normalize_number(number: Column) -> Column:
    """F4. Single blanks and a tight '(E)'; null for blanks."""
    return F.regexp_replace(F.nullif(squeeze(number), F.lit("")), r" *\( *E *\)", "(E)")


def normalize_brands(brands: Column) -> Column:
    """Names of F1 without the blank ones."""
    return F.transform(F.filter(brands, lambda b: strip(b) != ""), normalize_name)


def file_name(text: Column) -> Column:
    """F6. Letters, digits, _ and - only; runs of other characters as one _; none outside."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9_-]", "_"), "_+", "_"), "^_+|_+$", "")


def safe_file_name(text: Column, most: int = 200) -> Column:
    """F7. Characters that file systems refuse, and whitespace, as _; cut to ``most`` characters."""
    return F.substring(F.regexp_replace(F.regexp_replace(text, r"[<>:\x22/\\|?*]", "_"), SPACE + "+", "_"), 1, most)


def comparable_url(url: Column) -> Column:
    """F8. Scheme and authority in lower case and the path without its last /; query and fragment dropped."""
    scheme, host, path = F.lower(found(url, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1)), F.lower(found(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), found(url, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.concat(scheme, F.lit("://"), host, F.regexp_replace(F.coalesce(path, F.lit("")), "/+$", ""))


def url_host(url: Column) -> Column:
    """F9. The authority of an absolute URL, as written."""
    return found(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def split_sources(sources: Column) -> Column:
    """F10. Parts of a comma list, outer blanks dropped, blank ones left out."""
    return F.filter(F.transform(F.split(sources, ","), strip), lambda s: s != "")


def merge_sources(lists: Column) -> Column:
    """F11. An array of comma lists as one list: distinct without regard to case, first spelling and order kept."""
    every = F.flatten(F.transform(F.filter(lists, lambda s: s.isNotNull()), split_sources))
    first = bound(F.transform(every, F.lower), lambda low: F.filter(every, lambda s, i: F.array_position(low, F.lower(s)) == i + 1))
    return F.array_join(first, ", ")


def extract_number(text: Column) -> Column:
    """X1. The first G.S.R. number in standard form, else the first S.O. number."""
    return F.coalesce(F.concat(F.lit("G.S.R. "), found(text, GSR, 1), F.lit("(E)")), F.concat(F.lit("S.O. "), found(text, SO, 1), F.lit("(E)")))


def _as_date(day: Column, month: Column, year: Column, form: str) -> Column:
    return F.try_to_timestamp(F.concat_ws("/", day, F.initcap(month), year), F.lit(form)).cast("date")


def extract_date(text: Column, any_ordinal: bool = False) -> Column:
    """X2. By pattern, not by place: the first match of the first pattern that gives a date.

    Ordinals count in small letters only ('10th', not '10TH'), unless ``any_ordinal``.
    """
    one = lambda p, d, m, y, f: _as_date(F.regexp_extract(text, p, d), F.regexp_extract(text, p, m), F.regexp_extract(text, p, y), f)
    fits = lambda p: text.rlike(p) if any_ordinal or "st|nd" not in p else F.regexp_extract(text, p, 0).rlike("[0-9](?:st|nd|rd|th)")
    return F.coalesce(*[F.when(fits(p), one(p, d, m, y, f)) for p, d, m, y, f in DATES])


def parse_date(text: Column) -> Column:
    """X3. A whole text in one of eight formats, else a day, month and year with - . or / anywhere in it."""
    t = squeeze(text)
    forms = ("yyyy-M-d", "d-M-yyyy", "d.M.yyyy", "d/M/yyyy", "MMMM d, yyyy", "d MMMM yyyy", "MMM d, yyyy", "d MMM yyyy")
    inside = r"(\d{1,2})[-./](\d{1,2})[-./](\d{4})"
    parts = [F.regexp_extract(t, inside, i) for i in (1, 2, 3)]
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)).cast("date") for f in forms], F.when(t.rlike(inside), _as_date(*parts, "d/M/yyyy")))


def parse_number_and_date(text: Column) -> Column:
    """X4. struct<number, date> of a text such as 'GSR NO. 578(E) Dated 23.07.1983'."""
    t = squeeze(text)
    number = lambda series, p: F.concat(F.lit(series), found(t, p.replace(r"(\d+)", r"(?:NO\.?)?\s*(\d+)"), 1), F.lit("(E)"))
    return F.struct(F.coalesce(number("G.S.R. ", GSR), number("S.O. ", SO)).alias("number"), extract_date(t, any_ordinal=True).alias("date"))


def extract_form(text: Column) -> Column:
    """X5. The leftmost dosage form word, in title case."""
    return title(strip(found(text, FORM)))


def extract_strength(text: Column) -> Column:
    """X6. The leftmost amount with at most one '/' part, or percentage."""
    return strip(found(text, STRENGTH))


def extract_reason(text: Column, most: int = 500) -> Column:
    """X7. From a word that introduces a ground to the end of its sentence, single blanks, cut to ``most`` characters."""
    return F.substring(squeeze(F.coalesce(*[F.regexp_substr(text, F.lit(p)) for p in REASONS])), 1, most)


def split_combination(name: Column) -> Column:
    """X8. struct<is_fdc, ingredients>: parts between +, & and ' and '; one part is no combination; blanks have none."""
    parts = F.filter(F.transform(F.split(name, rf"\+|&|(?i)(?<={SPACE})and(?={SPACE})"), lambda p: F.regexp_replace(strip(p), "^[,.-]+|[,.-]+$", "")), lambda p: strip(p) != "")
    empty = F.array().cast("array<string>")
    return F.struct(F.coalesce(F.size(parts) > 1, F.lit(False)).alias("is_fdc"), F.when(F.size(parts) > 1, parts).when(strip(name) != "", F.array(strip(name))).otherwise(empty).alias("ingredients"))


def number_of_file(path: Column) -> Column:
    """X9. 'x/G_S_R_578_E.pdf' or 'GSR_578.pdf' -> 'G.S.R. 578(E)'."""
    stem = F.regexp_replace(F.regexp_replace(path, "^.*/", ""), r"\.[^.]*$", "")
    gsr, so = found(stem, r"(?i)^G_?S_?R_(?:No_)?(\d+)", 1), found(stem, r"(?i)^S_?O_(?:No_)?(\d+)", 1)
    return F.coalesce(F.concat(F.lit("G.S.R. "), gsr, F.lit("(E)")), F.concat(F.lit("S.O. "), so, F.lit("(E)")))


def any_of(text: Column, terms: list[str]) -> Column:
    """Whether a text holds one of the terms, without regard to case; false for null."""
    return F.coalesce(reduce(lambda a, b: a | b, [F.contains(F.lower(text), F.lit(t)) for t in terms]), F.lit(False))


def hits(text: Column, terms: list[str]) -> Column:
    """How many of the terms a text holds, without regard to case; 0 for null."""
    return F.coalesce(reduce(lambda a, b: a + b, [F.contains(F.lower(text), F.lit(t)).cast("int") for t in terms]), F.lit(0))
