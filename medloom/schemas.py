"""Schemas of the curated tables, and tables as snapshots in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medloom.operators.merge import Snapshots

_LISTING = (
    "id bigint, generic_name string, brand_names array<string>, dosage_form string, strength string, notification_number string, notification_date date, ban_reason string, "
    "source_pdf string, date_added timestamp, last_updated timestamp"
)

#: Columns of the tables.
TABLES = {
    "banned_medicines": _LISTING.replace(", date_added", ", is_fdc boolean, ingredients array<string>, source_url string, date_added"),
    "unofficial_medicines": _LISTING,
    "ayush_fssai_medicines": _LISTING,
    "source_documents": "id bigint, file_name string, source_url string, notification_number string, notification_date date, processing_status string, notes string, date_added timestamp, last_updated timestamp",
    "notifications_processed": (
        "id bigint, notification_number string, notification_date date, source_url string, pdf_path string, download_status string, parsing_status string, error_message string, last_attempt timestamp, "
        "date_added timestamp, last_updated timestamp"
    ),
    "manual_review_queue": (
        "id bigint, notification_number string, issue_type string, description string, raw_text string, notification_date date, source_url string, status string, date_added timestamp, last_updated timestamp"
    ),
}


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name])


def store(spark: SparkSession, folder: str, name: str) -> Snapshots:
    return Snapshots(spark, f"{folder.rstrip('/')}/{name}")


def create_tables(spark: SparkSession, folder: str) -> None:
    """K7. Tables that don't exist yet, empty."""
    for name in TABLES:
        where = store(spark, folder, name)
        if where.read() is None:
            where.write(empty(spark, name))


def drop_tables(spark: SparkSession, folder: str, names: list[str] | None = None) -> None:
    """K7. The named tables, or all, with their history."""
    for name in names or TABLES:
        store(spark, folder, name).drop()


def truncate(spark: SparkSession, folder: str, names: list[str]) -> dict[str, int]:
    """M7. Tables without their rows; how many each had."""
    held = {}
    for name in names:
        where = store(spark, folder, name)
        rows = where.read()
        held[name] = rows.count() if rows is not None else 0
        where.write(empty(spark, name))
    return held


def current(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """S16. The table's current rows; none before the first write."""
    rows = store(spark, folder, name).read()
    return rows if rows is not None else empty(spark, name)
