"""Entries of a notification's text: numbered rows, combination lines, paragraphs, and how they are put together.

Everything happens inside a document's row as arrays, so the three strategies and their conditions cost no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom import lexicon, scale
from medloom.functions.columns import bound, squeeze
from medloom.functions.text import extract_date, extract_form, extract_number, extract_reason, extract_strength, split_combination, strip

# Placeholders, and the patterns of numbered rows, combination lines, sentences and names.
NO_ENTRIES, UNREADABLE = "[NO ENTRIES FOUND]", "[UNREADABLE PDF]"
NUMBERED = r"(?m)^\s*(\d{1,4})\s*[.\)]\s*(.+)"
COMBINED = r"(?m)^.*?\b\w+\s*\+\s*\w+.*$"
SENTENCE, CAPITALISED = r"[.;\n]", r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)\b"


def _without(text: Column, part: Column) -> Column:
    """All occurrences of a part gone, whatever their case.

    Only where some are written in another case than the part, a pattern of the row's own has to be compiled.
    """
    gone = F.replace(text, part, F.lit(""))
    left = F.contains(F.lower(gone), F.lower(part))
    alike = F.char_length(F.replace(F.lower(text), F.lower(part), F.lit(""))) == F.char_length(gone)
    return F.when(part.isNull() | (part == ""), text).when(~left & alike, strip(gone)).otherwise(strip(F.regexp_replace(text, F.concat(F.lit(r"(?i)\Q"), part, F.lit(r"\E")), F.lit(""))))


def _entries(lines: Column, serial: bool) -> Column:
    """array<entry> of lines. Each step is a transform of its own, so that form and strength are extracted once a line."""
    parts = F.transform(lines, lambda x: F.struct(x.alias("line"), extract_form(x).alias("form"), extract_strength(x).alias("strength")))
    cut = F.transform(parts, lambda p: F.struct(p["line"].alias("line"), p["form"].alias("form"), p["strength"].alias("strength"), _without(p["line"], p["form"]).alias("rest")))

    def entry(p: Column) -> Column:
        name = strip(F.regexp_replace(_without(p["rest"], p["strength"]), r"[()\[\]{}]", ""))
        if serial:
            name = F.regexp_replace(name, r"^\d+\s*[.\)]\s*", "")
        name = F.regexp_replace(squeeze(name), "[.,;:-]+$", "")
        return F.struct(name.alias("generic_name"), p["form"].alias("dosage_form"), p["strength"].alias("strength"), p["line"].alias("raw_text"))

    return F.transform(cut, entry)


def numbered_rows(text: Column) -> Column:
    """T1. array<entry> of the lines that begin with a number and . or )."""
    lines = F.filter(F.transform(F.regexp_extract_all(text, F.lit(NUMBERED), F.lit(2)), strip), lambda x: F.char_length(x) >= 3)
    return F.filter(_entries(lines, False), lambda e: e["generic_name"] != "")


def combination_lines(text: Column) -> Column:
    """T2. array<entry> of the lines with a + between two words."""
    lines = F.filter(F.transform(F.regexp_extract_all(text, F.lit(COMBINED), F.lit(0)), strip), lambda x: F.char_length(x) >= 5)
    return F.filter(_entries(lines, True), lambda e: F.contains(e["generic_name"], F.lit("+")))


def paragraph_names(text: Column) -> Column:
    """T3. array<entry> of the capitalised words of all sentences, but for plain ones."""
    sentences = F.filter(F.transform(F.split(text, SENTENCE), strip), lambda s: F.char_length(s) >= 10)
    names = lambda s: F.filter(
        F.regexp_extract_all(s, F.lit(CAPITALISED), F.lit(1)), lambda n: (F.char_length(n) >= 4) & ~n.isin(lexicon.PLAIN_CAPITALS)
    )
    each = F.transform(sentences, lambda s: F.struct(extract_form(s).alias("form"), extract_strength(s).alias("strength"), F.substring(s, 1, 500).alias("raw"), names(s).alias("names")))
    entry = lambda x, n: F.struct(n.alias("generic_name"), x["form"].alias("dosage_form"), x["strength"].alias("strength"), x["raw"].alias("raw_text"))
    return F.flatten(F.transform(F.filter(each, lambda x: F.size(x["names"]) > 0), lambda x: F.transform(x["names"], lambda n: entry(x, n))))


def entries(documents: DataFrame) -> DataFrame:
    """T4/T5. ``doc_id, pos``, the entry, its status, and number, date and reason of the document (``doc_id, text``).

    Numbered rows and those combinations they don't hold; only without both, paragraph names, which need review; only
    without any, one placeholder. A null text gives the placeholder of an unreadable file.
    """
    # the document's own values are found before its entries are exploded, once a document
    rows = scale.spread(documents.select("doc_id", "text")).select(
        "doc_id", "text", numbered_rows(F.col("text")).alias("t1"), combination_lines(F.col("text")).alias("t2"),
        extract_number(F.col("text")).alias("notification_number"), extract_date(F.col("text")).alias("notification_date"), extract_reason(F.col("text")).alias("ban_reason"),
    )
    seen = F.transform("t1", lambda e: F.lower(e["generic_name"]))
    both = F.concat("t1", bound(seen, lambda names: F.filter("t2", lambda e: ~F.array_contains(names, F.lower(e["generic_name"])))))
    rows = rows.withColumn("sure", both).withColumn("guessed", F.when(F.size("sure") == 0, paragraph_names(F.col("text"))).otherwise(F.array().cast(rows.schema["t1"].dataType)))
    nothing = F.struct(F.when(F.col("text").isNull(), F.lit(UNREADABLE)).otherwise(F.lit(NO_ENTRIES)).alias("generic_name"), F.lit(None).cast("string").alias("dosage_form"), F.lit(None).cast("string").alias("strength"), F.substring("text", 1, 2000).alias("raw_text"))
    listed = F.when(F.size("sure") > 0, F.col("sure")).when(F.size("guessed") > 0, F.col("guessed")).otherwise(F.array(nothing))
    status = F.when(F.size("sure") > 0, F.lit("ok")).otherwise(F.lit("needs_review"))
    rows = rows.select("doc_id", status.alias("parsing_status"), "notification_number", "notification_date", "ban_reason", F.posexplode(listed).alias("pos", "e"))
    reason = F.when(~F.col("e.generic_name").isin(NO_ENTRIES, UNREADABLE), F.col("ban_reason"))
    return rows.select("doc_id", "pos", "e.*", "parsing_status", "notification_number", "notification_date", reason.alias("ban_reason"))


def routed_entries(parsed: DataFrame) -> DataFrame:
    """T6/R3. Entries with ``is_fdc, ingredients, route``: keep, review, or failed for placeholders."""
    parts = split_combination(F.col("generic_name"))
    route = F.when(F.col("generic_name").isin(NO_ENTRIES, UNREADABLE), "failed").when(F.col("parsing_status") == "needs_review", "review").otherwise("keep")
    return parsed.withColumn("is_fdc", parts["is_fdc"]).withColumn("ingredients", parts["ingredients"]).withColumn("route", route)
