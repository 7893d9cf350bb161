"""The pipelines: notices to records, listings to tables, cross-reference, statistics.

Each takes and gives DataFrames. What several outputs share is materialized once, so no page or document is read twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom import scale
from medloom.functions.text import normalize_brands, normalize_form, normalize_name, normalize_number, normalize_strength
from medloom.operators import dedup, extract, merge, validate, xref


def normalized(rows: DataFrame) -> DataFrame:
    """F5. Name, form, strength, number and brand names of every record in standard form; ingredients as they are."""
    put = {"generic_name": normalize_name, "dosage_form": normalize_form, "strength": normalize_strength, "notification_number": normalize_number, "brand_names": normalize_brands}
    return rows.withColumns({c: f(F.col(c)) for c, f in put.items() if c in rows.columns})


@dataclass
class Notices:
    """Outputs of process_notices."""

    medicines: DataFrame
    reviews: DataFrame
    status: DataFrame


def process_notices(documents: DataFrame, as_of: Column, written: bool = True) -> Notices:
    """E1. Documents (``doc_id, text, source_url``) to medicines, review items and a parsing status per document.

    Entries are extracted, routed, normalised and validated; valid ones are deduplicated by name within their document.
    Sure entries are stored, doubtful ones reviewed, unreadable documents failed. The checked entries are written once
    for all three outputs, unless only one of them is wanted and ``written`` is off: it then reads no more than it needs.
    """
    parsed = extract.routed_entries(extract.entries(documents.select("doc_id", "text")))
    rows = normalized(parsed.withColumn("raw_name", F.col("generic_name")))
    checked = validate.validated(rows, as_of).join(documents.select("doc_id", "source_url"), "doc_id", "left")
    checked = scale.materialize(checked) if written else checked
    keep = checked.filter("route = 'keep' and is_valid")
    medicines = dedup.first_wins(keep, F.struct("doc_id", F.lower("generic_name")), "pos").drop("errors", "warnings", "is_valid", "route", "raw_name", "parsing_status")
    issue = F.when(F.col("route") == "failed", "scanned_pdf").when((F.col("route") == "review") | ~F.col("is_valid"), "validation_failed")
    reviews = checked.withColumn("issue_type", issue).filter("issue_type is not null").select(
        "doc_id", "pos", "notification_number", "issue_type", F.concat_ws(": ", F.col("raw_name"), F.array_join("errors", "; ")).alias("description"), "raw_text", "notification_date", "source_url"
    )
    status = checked.groupBy("doc_id").agg(F.max(F.col("route") == "failed").alias("f")).select("doc_id", F.when(F.col("f"), "failed").otherwise("parsed").alias("parsing_status"))
    return Notices(medicines, reviews, status)


def route_listings(entries: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """E4. Entries of listings (``generic_name, source, seq`` and more) normalised, validated, deduplicated and split by target table."""
    checked = validate.validated(normalized(entries), as_of).filter("is_valid").drop("errors", "warnings", "is_valid")
    routed = scale.materialize(dedup.deduplicated(checked, "generic_name", "source", "seq").withColumn("target", validate.route(F.col("source"))))
    return {t: routed.filter(F.col("target") == t).drop("target") for t in ("unofficial_medicines", "ayush_fssai_medicines")}


def cross_reference(official: DataFrame, listings: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """E3. Review items of all unlinked listing rows, and the summary per listing."""
    items, outcomes = None, None
    for name, rows in listings.items():
        found = scale.materialize(xref.cross_referenced(rows, official))
        part = xref.review_items(found, rows, f"Record of {name}")
        items = part if items is None else items.unionByName(part)
        named = found.withColumn("listing", F.lit(name))
        outcomes = named if outcomes is None else outcomes.unionByName(named)
    return items, xref.link_summary(outcomes, ["listing"])


def discover(official_links: DataFrame, listings: DataFrame) -> DataFrame:
    """E2. The roadmap of numbered links (``number, date, target, seq``) and listing rows (``number, date, drug, source, seq``)."""
    return dedup.roadmap(official_links.withColumnRenamed("target", "url"), listings)


def acquire(roadmap: DataFrame, cache: DataFrame) -> DataFrame:
    """E2. Where to get each notification: its own address, else the cached one; ``missing`` without either."""
    rows = roadmap.join(cache.select("number", F.col("target").alias("cached")), "number", "left")
    url = F.coalesce(F.nullif("source_url", F.lit("")), F.col("cached"))
    return rows.select("number", "notification_date", url.alias("url"), F.when(url.isNull(), "missing").otherwise("pending").alias("download_status"))


def upsert_medicines(target: DataFrame, medicines: DataFrame, order: str, now: Column, listing: bool = False) -> DataFrame:
    """M1 with the key of official records, or of listings."""
    keys = merge.LISTING_KEY if listing else merge.MEDICINE_KEY
    values = [c for c in medicines.columns if c in target.columns and c not in (*keys, "id", "date_added", "last_updated")]
    defaults = {"is_fdc": F.lit(False), "brand_names": F.array().cast("array<string>"), "ingredients": F.array().cast("array<string>")}
    return merge.upsert(target, medicines, keys, values, order, now, {k: v for k, v in defaults.items() if k in values})
