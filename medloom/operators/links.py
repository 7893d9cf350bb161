"""Entries and links of parsed pages: table and list sources, link discovery, ranking, first-URL caches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom import lexicon
from medloom.functions.text import any_of, parse_number_and_date, strip
from medloom.operators.dedup import first_of
from medloom.operators.validate import is_ban_related
from medloom.sources.html import absolute_url


def table_entries(pages: DataFrame, first_table: bool, headers: list[str], name_cell: int = 1, note_cell: int = 2, least: int = 3) -> DataFrame:
    """S1/S2/S4. ``url, pos, generic_name, number, date`` of table rows with enough cells, without headers and empty names.

    pages: ``url, page``. A row is a header if its first cell holds 'sr' or its name cell one of ``headers``.
    """
    rows = pages.select("url", F.posexplode("page.rows").alias("pos", "r")).select("url", "pos", "r.*")
    rows = rows.filter(F.col("table") == 0) if first_table else rows
    cell = lambda i: F.coalesce(F.get("cells", F.lit(i)), F.lit(""))
    rows = rows.filter((F.size("cells") >= least) & ~F.contains(F.lower(cell(0)), F.lit("sr")) & ~any_of(cell(name_cell), headers))
    name, note = F.regexp_replace(strip(cell(name_cell)), r"\.+$", ""), parse_number_and_date(cell(note_cell))
    return rows.select("url", "pos", name.alias("generic_name"), note["number"].alias("number"), note["date"].alias("date")).filter("generic_name <> ''")


def list_entries(pages: DataFrame, least: int, separators: str = "-–—", prefixes: list[str] = ()) -> DataFrame:
    """S3/S4. ``url, pos, generic_name, number, date`` of list items of at least ``least`` characters: the name stands before the first separator."""
    items = pages.select("url", F.posexplode("page.items").alias("pos", "i")).select("url", "pos", F.col("i.text").alias("text")).filter(F.char_length("text") >= least)
    name = strip(F.get(F.split("text", f"[{separators}]"), F.lit(0)))
    name = strip(F.regexp_replace(name, r"^[0-9]+[.)]\s*", ""))
    name = reduce(lambda n, p: strip(F.regexp_replace(n, rf"(?i)^{p}:?\s*", "")), prefixes, name)
    note = parse_number_and_date(F.col("text"))
    return items.select("url", "pos", F.regexp_replace(name, r"\.+$", "").alias("generic_name"), note["number"].alias("number"), note["date"].alias("date")).filter("generic_name <> ''")


def or_else(primary: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """S3/S4/J8. The primary rows, and the fallback rows of the keys that have none."""
    return primary.unionByName(fallback.join(primary.select(key).distinct(), key, "left_anti"))


def links(pages: DataFrame) -> DataFrame:
    """S5. ``url, pos, target, href, text, title`` and the link's surroundings; target is absolute."""
    rows = pages.select("url", F.explode("page.links").alias("l")).select("url", "l.*")
    return rows.withColumn("target", absolute_url(F.col("url"), F.col("href")))


def is_pdf_link(href: Column) -> Column:
    """S5. Ends in .pdf or names pdf anywhere."""
    return F.contains(F.lower(href), F.lit("pdf"))


def is_document_link(href: Column) -> Column:
    """S6. A PDF or a download address."""
    low = F.lower(href)
    return low.endswith(".pdf") | F.contains(low, F.lit("download_file")) | F.contains(low, F.lit("jsp?num_id="))


def numbered_links(found: DataFrame) -> DataFrame:
    """S6. Document links in whose row, item or own text a number is found; adds ``number, date, label``."""
    own = F.concat_ws(" ", "text", "title", "href")
    note = parse_number_and_date(F.coalesce("row_text", "item_text", own))
    rows = found.filter(is_document_link(F.col("href"))).withColumn("number", note["number"]).withColumn("date", note["date"])
    return rows.withColumn("label", F.coalesce(F.nullif(F.col("text"), F.lit("")), F.col("title"))).filter(F.col("number").isNotNull())


def url_cache(found: DataFrame, order: list[str]) -> DataFrame:
    """S7/A8. The first target of every number."""
    return first_of(found, ["number"], "target", order)


def ban_links(found: DataFrame, order: list[str], surroundings: bool = False) -> DataFrame:
    """S8/S9. Distinct targets of ban-related links with the place of the first, in order."""
    text = F.concat_ws(" ", "text", "parent_text", "href") if surroundings else F.concat_ws(" ", "text", "href")
    kept = found.filter(is_ban_related(text))
    return kept.groupBy("target").agg(F.min(F.struct(*order)).alias("at")).select("target", "at.*")


def alert_score(text: Column) -> Column:
    """S10. Keyword hits, with extra weight for the telling ones."""
    low = F.lower(text)
    base = reduce(lambda a, b: a + b, [F.contains(low, F.lit(w)).cast("int") for w in lexicon.ALERT_WORDS])
    return base + 3 * any_of(low, ["nsq", "recall", "substandard"]).cast("int") + 4 * any_of(low, ["not of standard quality"]).cast("int") + 2 * any_of(low, ["drug"]).cast("int")


def best_link(found: DataFrame, score: Column) -> DataFrame:
    """S10/O5. Per page the target of the highest score, the first of equals; page-internal and mail links and the page itself left out."""
    kept = found.filter(~F.lower(F.col("href")).rlike(r"^(#|mailto:|tel:|javascript:)") & (F.col("target") != F.col("url"))).withColumn("score", score).filter("score > 0")
    return kept.groupBy("url").agg(F.max_by(F.struct("target", "score"), F.struct("score", -F.col("pos"))).alias("b")).select("url", "b.*")
