"""Linking of listings to the official record by number, then by name or ingredient set, with the reason for failures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.functions.text import normalize_number, strip


def _name(c: str):  # noqa: ANN202
    return F.lower(strip(F.col(c)))


def cross_referenced(listing: DataFrame, official: DataFrame) -> DataFrame:
    """J1/J2. ``id, outcome`` of listing rows (``id, generic_name, notification_number``).

    official: ``generic_name, ingredients, notification_number``. Outcomes: missing_number, number_not_found, linked (an
    official row of the number has the name, or its ingredient set equals the listing's parts between +), no_match.
    The official side is reduced to its distinct numbers and pairs; both joins are equi-joins, so no list is built and
    a hot number costs no more than its distinct pairs.
    """
    rows = listing.select("id", "generic_name", normalize_number(F.col("notification_number")).alias("number"))
    parts = F.array_sort(F.array_distinct(F.transform(F.split("generic_name", r"\+"), lambda p: F.lower(strip(p)))))
    rows = rows.select("id", "number", _name("generic_name").alias("n"), F.concat_ws("\u0001", parts).alias("s"))
    ingredients = F.when(F.size("ingredients") > 0, F.array_sort(F.array_distinct(F.transform("ingredients", lambda p: F.lower(strip(p)))))).otherwise(F.array(_name("generic_name")))
    known = official.select(normalize_number(F.col("notification_number")).alias("number"), _name("generic_name").alias("n"), F.concat_ws("\u0001", ingredients).alias("s")).filter(F.col("number").isNotNull())
    numbers = known.select("number", F.lit(True).alias("known")).distinct()
    pairs = known.select("number", F.explode(F.array(F.concat(F.lit("n"), F.col("n")), F.concat(F.lit("s"), F.col("s")))).alias("k")).distinct()
    asked = rows.filter(F.col("number").isNotNull()).select("id", "number", F.explode(F.array(F.concat(F.lit("n"), F.col("n")), F.concat(F.lit("s"), F.col("s")))).alias("k"))
    linked = asked.join(pairs, ["number", "k"], "left_semi").select("id", F.lit(True).alias("linked")).distinct()
    met = rows.select("id", "number").join(numbers, "number", "left").join(linked, "id", "left")
    outcome = F.when(F.col("number").isNull(), "missing_number").when(F.col("known").isNull(), "number_not_found").when(F.col("linked"), "linked").otherwise("no_match")
    return met.select("id", outcome.alias("outcome"))


def link_summary(outcomes: DataFrame, by: list[str]) -> DataFrame:
    """A6. Total, linked and unlinked rows."""
    linked = F.col("outcome") == "linked"
    return outcomes.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(linked).alias("linked"), F.count_if(~linked).alias("unlinked"))


def review_items(outcomes: DataFrame, listing: DataFrame, title: str) -> DataFrame:
    """Review items of unlinked rows: issue type and description."""
    rows = outcomes.filter("outcome <> 'linked'").join(listing.select("id", "generic_name", "notification_number", "notification_date"), "id")
    kind = F.when(F.col("outcome") == "missing_number", "missing_notification_number").otherwise("unlinked_record")
    text = (
        F.when(F.col("outcome") == "missing_number", F.lit(f"{title} has no notification number: "))
        .when(F.col("outcome") == "number_not_found", F.lit(f"{title} names a number without official rows: "))
        .otherwise(F.lit(f"{title} matches no official row of its number: "))
    )
    return rows.select(
        "id", F.nullif(F.col("notification_number"), F.lit("")).alias("notification_number"), kind.alias("issue_type"), F.concat(text, F.coalesce("generic_name", F.lit(""))).alias("description"),
        F.lit(None).cast("string").alias("raw_text"), "notification_date", F.lit(None).cast("string").alias("source_url"),
    )
