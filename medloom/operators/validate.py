"""Rules that tell records from junk, as Columns: keyword filters, page signals, validation with reasons."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom import lexicon
from medloom.functions.text import any_of, hits, strip

_ARCHIVE = r"^(?:" + "|".join(lexicon.MONTHS) + r")\s*\([0-9]+\)$"


def is_ban_related(text: Column) -> Column:
    """P1. Holds a strong or weak term and no excluded one; terms count anywhere, also inside words."""
    return ~any_of(text, lexicon.EXCLUDED) & (any_of(text, lexicon.BAN_STRONG) | any_of(text, lexicon.BAN_WEAK))


def is_drug_document(pages: Column, terms: list[str], first: int = 3) -> Column:
    """P2. One of the terms in the first pages of an array of pages."""
    return F.exists(F.slice(pages, 1, first), lambda p: any_of(p, terms))


def is_drug_page(text: Column) -> Column:
    """P3. At least two positive signals, and no more negative than positive ones."""
    positive = hits(text, lexicon.PAGE_POSITIVE)
    return (positive >= lexicon.PAGE_MIN_POSITIVE) & (hits(text, lexicon.PAGE_NEGATIVE) <= positive)


_OFFICE = r"\b(?:" + "|".join(lexicon.OFFICE_WORDS) + r")\b"


#: Whatever one of the rules on names may object to; most names pass by this one pattern.
_SUSPECT = (
    r"^.{0,2}$|^[0-9\s.,%]+$|\.\w{2,6}$|" + _ARCHIVE + "|^(?:" + "|".join(re.escape(t) for t in lexicon.NOT_NAMES) + ")$|" + "|".join(re.escape(t) for t in lexicon.JUNK_PARTS) + "|" + _OFFICE
)


def _first_part(name: Column, terms: list[str]) -> Column:
    """The first term of the list that the name holds anywhere."""
    return F.coalesce(*[F.when(F.contains(name, F.lit(t)), F.lit(t)) for t in terms])


def _first_word(name: Column) -> Column:
    """The first office word of the list that the name holds as a whole word; one pattern decides whether to look for it."""
    return F.when(name.rlike(_OFFICE), F.coalesce(*[F.when(name.rlike(rf"\b{w}\b"), F.lit(w)) for w in lexicon.OFFICE_WORDS]))


def errors(name: Column, date: Column, as_of: Column) -> Column:
    """P4. What is wrong with a record, in the order of the rules; empty if nothing is."""
    low = F.lower(strip(name))
    quoted = F.concat(F.lit("'"), name, F.lit("'"))
    part, word = _first_part(low, lexicon.JUNK_PARTS), _first_word(low)
    named = [
        F.when(low.isin(lexicon.NOT_NAMES), F.concat(F.lit("generic_name is blacklisted: "), quoted)),
        F.when(low.rlike(r"\.\w{2,4}$") & low.rlike(r"[/:]|www\."), F.concat(F.lit("generic_name looks like a URL: "), quoted)),
        F.when(low.rlike(r"^[\w\-]+\.\w{2,6}$"), F.concat(F.lit("generic_name looks like a domain: "), quoted)),
        F.when(F.char_length(low) < 3, F.concat(F.lit("generic_name too short: "), quoted)),
        F.when(low.rlike(r"^[0-9\s.,%]+$"), F.concat(F.lit("generic_name is numeric: "), quoted)),
        F.when(part.isNotNull(), F.concat(F.lit("generic_name contains junk substring '"), part, F.lit("': "), quoted)),
        F.when(word.isNotNull(), F.concat(F.lit("generic_name contains administrative/navigation keyword '"), word, F.lit("': "), quoted)),
        F.when(low.rlike(_ARCHIVE), F.concat(F.lit("generic_name matches archive label pattern: "), quoted)),
    ]
    empty = F.coalesce(low == "", F.lit(True))
    late = F.when(date > as_of, F.array(F.concat(F.lit("notification_date is in the future: "), date.cast("string")))).otherwise(F.array().cast("array<string>"))
    wrong = F.when(empty, F.array(F.lit("generic_name is empty"))).when(low.rlike(_SUSPECT), F.filter(F.array(*named), lambda e: e.isNotNull())).otherwise(F.array().cast("array<string>"))
    return F.concat(wrong, late)


def warnings(form: Column, number: Column) -> Column:
    """P4. What is unusual about a record: an unknown dosage form, a number of no known series."""
    key = F.lower(strip(form))
    known = key.isin(list(lexicon.FORMS)) | F.regexp_replace(key, "s+$", "").isin(list(lexicon.FORMS))
    serial = number.rlike(r"(?i)G\.?S\.?R\.?\s*[0-9]+") | number.rlike(r"(?i)S\.?O\.?\s*[0-9]+")
    found = F.array(
        F.when((form != "") & ~known, F.concat(F.lit("Unrecognised dosage_form: '"), form, F.lit("'"))),
        F.when((number != "") & ~serial, F.concat(F.lit("notification_number does not match G.S.R./S.O. pattern: '"), number, F.lit("'"))),
    )
    return F.filter(found, lambda w: w.isNotNull())


def validated(rows: DataFrame, as_of: Column) -> DataFrame:
    """Adds ``errors, warnings, is_valid`` to records with generic_name, dosage_form, notification_number and notification_date."""
    checked = rows.withColumn("errors", errors(F.col("generic_name"), F.col("notification_date"), as_of))
    return checked.withColumn("warnings", warnings(F.col("dosage_form"), F.col("notification_number"))).withColumn("is_valid", F.size("errors") == 0)


def is_junk(name: Column) -> Column:
    """P5. A stored name that is no medicine; null and blank names are junk."""
    low = F.lower(strip(name))
    bad = (
        low.isin(lexicon.NOT_NAMES)
        | low.rlike(r"^[\w\-]+\.\w{2,6}$")
        | any_of(low, lexicon.JUNK_PARTS)
        | any_of(low, lexicon.JUNK_SITES)
        | (F.char_length(low) < 3)
        | low.rlike(r"^[0-9\s.,%]+$")
        | low.rlike(_OFFICE)
        | low.rlike(_ARCHIVE)
    )
    return F.coalesce(bad, F.lit(True))


def route(source: Column) -> Column:
    """R1. The table a record belongs to by its source, first rule first; null for none."""
    return F.coalesce(*[F.when(any_of(source, words), F.lit(target)) for target, words in lexicon.ROUTES])
