"""Queries of whole pipelines over the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom import lexicon
from medloom.functions.text import normalize_number
from medloom.operators import extract
from medloom.plans import curation
from medloom.queries import records, text_ops
from medloom.queries.records import AS_OF
from medloom.tables import table


def ref_e1_medicines(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", F.col("url").alias("source_url"))
    made = curation.process_notices(documents, F.lit(AS_OF).cast("date"), written=False).medicines
    return made.select("doc_id", "generic_name", "dosage_form", "strength", "notification_number", "notification_date", "is_fdc", F.array_join("ingredients", " | ").alias("ingredients"))


def ref_e1_status(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", F.col("url").alias("source_url"))
    return curation.process_notices(documents, F.lit(AS_OF).cast("date"), written=False).status


def ref_e3_reviews(spark: SparkSession, folder: str) -> DataFrame:
    listings = {n: table(spark, folder, n) for n in ("unofficial_medicines", "ayush_fssai_medicines")}
    items, _ = curation.cross_reference(table(spark, folder, "banned_medicines"), listings)
    return items.groupBy("issue_type", F.regexp_extract("description", "^(.*?):", 1).alias("reason")).agg(F.count("*").alias("n_items"))


def ref_e4_unofficial(spark: SparkSession, folder: str) -> DataFrame:
    entries = table(spark, folder, "unofficial_medicines").withColumn("seq", F.col("id")).withColumn("source", F.concat(F.lit("healthmaster "), F.coalesce("source_pdf", F.lit(""))))
    return curation.route_listings(entries, F.lit(AS_OF).cast("date"))["unofficial_medicines"].select("id", "generic_name", "dosage_form", "strength", "notification_number", "source")


def ref_e2_to_acquire(spark: SparkSession, folder: str) -> DataFrame:
    number = normalize_number(F.col("notification_number")).alias("number")
    official = table(spark, folder, "notifications_processed").select(number, F.col("notification_date").alias("date"), F.col("source_url").alias("target"), F.col("id").alias("seq"))
    listings = table(spark, folder, "unofficial_medicines").select(number, F.col("notification_date").alias("date"), F.col("generic_name").alias("drug"), F.col("source_pdf").alias("source"), F.col("id").alias("seq"))
    cache = table(spark, folder, "banned_medicines").filter("source_url is not null").select(number, "source_url", "id").filter("number is not null").groupBy("number").agg(F.min_by("source_url", "id").alias("target"))
    return curation.acquire(curation.discover(official, listings), cache)


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("ref_")}

_REASONS = "CASE outcome WHEN 'missing_number' THEN ' has no notification number' WHEN 'number_not_found' THEN ' names a number without official rows' ELSE ' matches no official row of its number' END"
SQL = {
    "ref_e2_to_acquire": f"""
        WITH r AS ({records.SQL['ref_a5_roadmap']}), c AS ({records.SQL['ref_a8_first_url']})
        SELECT r.number, notification_date, coalesce(nullif(r.source_url, ''), c.source_url) AS url, CASE WHEN coalesce(nullif(r.source_url, ''), c.source_url) IS NULL THEN 'missing' ELSE 'pending' END AS download_status
        FROM r LEFT JOIN c ON r.number = c.number""",
    "ref_e3_reviews": "SELECT issue_type, reason, count(*) AS n_items FROM ("
    + " UNION ALL ".join(
        f"SELECT CASE WHEN outcome = 'missing_number' THEN 'missing_notification_number' ELSE 'unlinked_record' END AS issue_type, 'Record of {n}' || {_REASONS} AS reason FROM ({records.SQL[f'ref_{j}_cross_reference']}) WHERE outcome <> 'linked'"
        for n, j in (("unofficial_medicines", "j1"), ("ayush_fssai_medicines", "j2"))
    )
    + ") GROUP BY 1, 2",
}


def _sql_valid(rows: str) -> str:
    """P4 of the rows of a CTE with id, generic_name, dosage_form, notification_number and notification_date."""
    return records.SQL["ref_p4_validate"].replace(f"WITH {records._SQL_NAMES}", f"WITH n AS (SELECT id, generic_name, dosage_form, notification_number, notification_date FROM {rows})")


_FAILED = f"generic_name IN ('{extract.NO_ENTRIES}', '{extract.UNREADABLE}')"
_NORMAL = f"{text_ops.sql_name('generic_name')} AS generic_name, {text_ops.sql_form('dosage_form')} AS dosage_form, {text_ops.sql_strength('strength')} AS strength, {text_ops.sql_number('notification_number')} AS notification_number, notification_date"
SQL["ref_e1_status"] = f"SELECT doc_id, CASE WHEN bool_or({_FAILED}) THEN 'failed' ELSE 'parsed' END AS parsing_status FROM ({text_ops.SQL['ref_t4_entries']}) GROUP BY 1"
SQL["ref_e1_medicines"] = f"""
    WITH t AS ({text_ops.SQL['ref_t4_entries']}), banned_medicines AS (SELECT row_number() OVER () AS id, * FROM t), x AS ({text_ops.SQL['ref_x8_split_combination']}),
    e AS (SELECT id, doc_id, pos, parsing_status, {_FAILED} AS failed, {_NORMAL} FROM banned_medicines), v AS ({_sql_valid('e')})
    SELECT doc_id, generic_name, dosage_form, strength, notification_number, notification_date, is_fdc, ingredients FROM e JOIN x USING (id) JOIN v USING (id)
    WHERE parsing_status = 'ok' AND NOT failed AND is_valid QUALIFY row_number() OVER (PARTITION BY doc_id, lower(generic_name) ORDER BY pos) = 1"""
SQL["ref_e4_unofficial"] = f"""
    WITH e AS (SELECT id, 'healthmaster ' || coalesce(source_pdf, '') AS source, {_NORMAL} FROM unofficial_medicines), v AS ({_sql_valid('e')}),
    b AS (SELECT e.*, {text_ops.sql_strip('lower(generic_name)')} AS k FROM e JOIN v USING (id) WHERE is_valid),
    f AS (SELECT k, lower({text_ops.sql_strip('source')}) AS l, arg_min({text_ops.sql_strip('source')}, id) AS s, min(id) AS o FROM b GROUP BY ALL),
    j AS (SELECT k, string_agg(s, ', ' ORDER BY o) AS j FROM f GROUP BY 1), c AS (SELECT k, count(*) AS n FROM b GROUP BY 1),
    d AS (SELECT b.* EXCLUDE (source), CASE WHEN n = 1 THEN source ELSE j END AS source FROM (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY k ORDER BY id) = 1) b JOIN j USING (k) JOIN c USING (k))
    SELECT id, generic_name, dosage_form, strength, notification_number, source FROM d WHERE {records._sql_any('source', lexicon.ROUTES[0][1])}"""
