"""Queries of the page sources. Pages are made of the tables' rows, so that SQL knows what must be read from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom import lexicon
from medloom.operators import links
from medloom.queries.text_ops import sql_extract_date, sql_strip
from medloom.sources.html import pages
from medloom.tables import table


def _escaped(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _note() -> Column:
    return F.concat(F.lit("GSR NO. "), F.col("id"), F.lit("(E) Dated "), F.coalesce(F.date_format("notification_date", "dd.MM.yyyy"), F.lit("")))


def _table_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A page per row: its table with header, a nested mark-up in the name, then a second table without header."""
    rows = table(spark, folder, "unofficial_medicines")
    first = F.concat(
        F.lit("<h1>List</h1><table><tr><th>Sr</th><th>Drugs Name</th><th>Notification</th></tr><tr><td>1</td><td> <b>"), _escaped(F.col("generic_name")),
        F.lit("</b></td><td>"), _note(), F.lit("</td></tr><tr><td>2</td><td></td><td>x</td></tr></table>"),
    )
    second = F.concat(F.lit("<table><tr><td>7</td><td>"), _escaped(F.coalesce("dosage_form", F.lit(""))), F.lit("</td><td></td></tr></table>"))
    return pages(rows.select(F.col("id").cast("string").alias("url"), F.concat(first, second).alias("html")), F.col("html")).select("url", "page")


def ref_s1_first_table(spark: SparkSession, folder: str) -> DataFrame:
    return links.table_entries(_table_pages(spark, folder), True, ["drugs name"]).select("url", "generic_name", "number", "date")


def ref_s2_all_tables(spark: SparkSession, folder: str) -> DataFrame:
    return links.table_entries(_table_pages(spark, folder), False, ["drugs name", "drug name"]).select("url", "generic_name", "number", "date")


def _list_pages(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "ayush_fssai_medicines")
    html = F.when(F.col("id") % 5 == 0, F.lit("<p>nothing listed</p>")).otherwise(
        F.concat(F.lit("<ol><li>1. Prohibition of "), _escaped(F.regexp_replace("generic_name", "[-–—:]", " ")), F.lit(" - vide "), _note(), F.lit("</li><li>short</li></ol>"))
    )
    fallback = F.concat(F.lit("<table><tr><td>1</td><td>"), F.lit("substance "), F.col("id"), F.lit("</td><td>x</td></tr></table>"))
    return pages(rows.select(F.col("id").cast("string").alias("url"), F.concat(html, fallback).alias("html")), F.col("html")).select("url", "page")


def ref_s3_list_or_table(spark: SparkSession, folder: str) -> DataFrame:
    read = _list_pages(spark, folder)
    found = links.list_entries(read, 10, prefixes=["advisory", "notification", "prohibition of", "warning on", "alert", "prohibition of"])
    return links.or_else(found, links.table_entries(read, False, ["name"], least=2), "url").select("url", "generic_name", "number", "date")


def ref_s4_table_or_list(spark: SparkSession, folder: str) -> DataFrame:
    read = _list_pages(spark, folder)
    tabled = links.table_entries(read, False, ["botanical", "ingredient", "additive"], least=2)
    return links.or_else(tabled, links.list_entries(read, 4, "-–—:"), "url").select("url", "generic_name")


def _link_pages(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "banned_medicines").filter("source_url is not null")
    html = F.concat(
        F.lit('<a href="#top">Top</a><a href="mailto:x@y.example">Drug alerts</a><table><tr><td>GSR NO. '), F.col("id"), F.lit('(E)</td><td><a title="t" href="/files/'), F.col("id"),
        F.lit('.PDF">Order <i>of</i> ban</a></td></tr></table><ul><li>S.O. '), F.col("id"), F.lit('(E) <a href="../get/download_file?x=1">banned drug list</a></li></ul><a href="alerts">Drug recall alert</a><a href="about">About us</a>'),
    )
    return links.links(pages(rows.select("source_url", html.alias("html")).withColumnRenamed("source_url", "url"), F.col("html")))


def ref_s5_pdf_links(spark: SparkSession, folder: str) -> DataFrame:
    found = _link_pages(spark, folder)
    return found.filter(links.is_pdf_link(F.col("href"))).select("url", "target", "text", "title")


def ref_s6_numbered_links(spark: SparkSession, folder: str) -> DataFrame:
    return links.numbered_links(_link_pages(spark, folder)).select("url", "pos", "number", "label")


def ref_s7_url_cache(spark: SparkSession, folder: str) -> DataFrame:
    return links.url_cache(links.numbered_links(_link_pages(spark, folder)), ["url", "pos"])


def ref_s8_ban_links(spark: SparkSession, folder: str) -> DataFrame:
    return links.ban_links(_link_pages(spark, folder), ["url", "pos"]).select("target", "pos")


def ref_s9_ban_links_around(spark: SparkSession, folder: str) -> DataFrame:
    return links.ban_links(_link_pages(spark, folder), ["url", "pos"], surroundings=True).select("target", "pos")


def ref_s10_best_link(spark: SparkSession, folder: str) -> DataFrame:
    found = _link_pages(spark, folder)
    return links.best_link(found, links.alert_score(F.concat_ws(" ", "text", "href")))


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("ref_")}

_NAME = rf"regexp_replace({sql_strip('generic_name')}, '\.+$', '')"
_DATED = "'GSR NO. ' || id || '(E) Dated ' || coalesce(strftime(notification_date, '%d.%m.%Y'), '')"
_ROW = f"CAST(id AS VARCHAR) AS url, {_NAME} AS generic_name, 'G.S.R. ' || id || '(E)' AS number, {sql_extract_date(_DATED)} AS date FROM unofficial_medicines WHERE {_NAME} <> '' AND NOT contains(lower(generic_name), 'drugs name')"
_BASE = "regexp_extract(source_url, '^(https?://[^/]+)', 1)"
_PAGES = "SELECT DISTINCT source_url, id FROM banned_medicines WHERE source_url IS NOT NULL"
_ITEM = rf"""regexp_replace({sql_strip("regexp_replace(generic_name, '[-–—:]', ' ', 'g')")}, '\.+$', '')"""
_WORDS = "[" + ", ".join(f"'{w}'" for w in lexicon.ALERT_WORDS) + "]"
_LINK = "lower('Drug recall alert alerts')"
_SCORE = f"""CAST(len(list_filter({_WORDS}, lambda w: contains({_LINK}, w))) + CASE WHEN regexp_matches({_LINK}, 'nsq|recall|substandard') THEN 3 ELSE 0 END
    + CASE WHEN contains({_LINK}, 'not of standard quality') THEN 4 ELSE 0 END + CASE WHEN contains({_LINK}, 'drug') THEN 2 ELSE 0 END AS INTEGER)"""

SQL = {
    "ref_s1_first_table": f"SELECT {_ROW}",
    "ref_s2_all_tables": rf"SELECT {_ROW} UNION ALL SELECT CAST(id AS VARCHAR), regexp_replace({sql_strip('dosage_form')}, '\.+$', ''), NULL, NULL FROM unofficial_medicines WHERE regexp_replace({sql_strip('dosage_form')}, '\.+$', '') <> ''",
    "ref_s3_list_or_table": f"""
        SELECT CAST(id AS VARCHAR) AS url, CASE WHEN id % 5 = 0 THEN 'substance ' || id ELSE {_ITEM} END AS generic_name, CASE WHEN id % 5 > 0 THEN 'G.S.R. ' || id || '(E)' END AS number,
          CASE WHEN id % 5 > 0 THEN {sql_extract_date(_DATED)} END AS date FROM ayush_fssai_medicines""",
    "ref_s4_table_or_list": "SELECT CAST(id AS VARCHAR) AS url, 'substance ' || id AS generic_name FROM ayush_fssai_medicines",
    "ref_s9_ban_links_around": f"""
        SELECT DISTINCT target, pos FROM (SELECT {_BASE} AS b, source_url FROM banned_medicines WHERE source_url IS NOT NULL),
          LATERAL (VALUES (source_url || '#top', 0), ('mailto:x@y.example', 1), (b || '/get/download_file?x=1', 3), (b || '/n/alerts', 4), (b || '/n/about', 5)) t(target, pos)""",
    "ref_s5_pdf_links": f"SELECT source_url AS url, {_BASE} || '/files/' || id || '.PDF' AS target, 'Orderofban' AS text, 't' AS title FROM banned_medicines WHERE source_url IS NOT NULL",
    "ref_s6_numbered_links": """
        SELECT source_url AS url, 2 AS pos, 'G.S.R. ' || id || '(E)' AS number, 'Orderofban' AS label FROM banned_medicines WHERE source_url IS NOT NULL
        UNION ALL SELECT source_url, 3, 'S.O. ' || id || '(E)', 'banned drug list' FROM banned_medicines WHERE source_url IS NOT NULL""",
    "ref_s7_url_cache": f"""
        SELECT 'G.S.R. ' || id || '(E)' AS number, {_BASE} || '/files/' || id || '.PDF' AS target FROM banned_medicines WHERE source_url IS NOT NULL
        UNION ALL SELECT 'S.O. ' || id || '(E)', {_BASE} || '/get/download_file?x=1' FROM banned_medicines WHERE source_url IS NOT NULL""",
    "ref_s8_ban_links": f"SELECT DISTINCT {_BASE} || '/get/download_file?x=1' AS target, 3 AS pos FROM banned_medicines WHERE source_url IS NOT NULL",
    "ref_s10_best_link": f"SELECT source_url AS url, {_BASE} || '/n/alerts' AS target, {_SCORE} AS score FROM banned_medicines WHERE source_url IS NOT NULL GROUP BY ALL",
}
