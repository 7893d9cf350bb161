"""First-wins deduplication and order-sensitive aggregates, without collecting a group's rows in one place.

What depends on order takes an explicit ordering column. Aggregates are declared so that Spark combines them before the
shuffle; lists are collected only after equal items have been reduced to their first occurrence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.functions.text import split_sources, strip


def first_wins(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """A1. The whole first row of every key; null keys are one key."""
    whole = F.struct(*rows.columns)
    return rows.groupBy(key.alias("__key")).agg(F.min_by(whole, F.col(order)).alias("r")).select("r.*")


def merged_lists(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """A2. ``keys..., merged``: comma lists of a group as one, distinct without regard to case, first spelling and order.

    A group of one row keeps its list as it is. Rows without a list add nothing; a group without any has null.
    """
    parts = rows.select(*keys, F.col(order).alias("o"), F.posexplode(split_sources(F.col(value))).alias("p", "s"))
    firsts = parts.groupBy(*keys, F.lower("s").alias("k")).agg(F.min(F.struct("o", "p", "s")).alias("f"))
    joined = firsts.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("f")), lambda f: f["s"]), ", ").alias("joined"))
    groups = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.max(value).alias("only"))
    same = [F.col(f"g.{k}").eqNullSafe(F.col(f"j.{k}")) for k in keys]
    both = groups.alias("g").join(joined.alias("j"), same, "left")
    return both.select(*[f"g.{k}" for k in keys], F.when(F.col("n") == 1, F.col("only")).otherwise(F.col("joined")).alias("merged"))


def deduplicated(rows: DataFrame, name: str, source: str, order: str) -> DataFrame:
    """A1 + A2. First row per name (case and outer blanks aside), with the sources of all its rows merged."""
    keyed = rows.withColumn("__name", F.lower(strip(F.col(name))))
    kept = first_wins(keyed, F.col("__name"), order)
    sources = merged_lists(keyed, ["__name"], source, order).withColumnRenamed("__name", "__n")
    return kept.join(sources, F.col("__name").eqNullSafe(F.col("__n"))).withColumn(source, F.col("merged")).drop("__name", "__n", "merged")


def first_of(rows: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """A8. The value of the first row that has one."""
    return rows.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.min_by(value, F.struct(*order)).alias(value))


def last_of(rows: DataFrame, keys: list[str], values: list[str], order: str) -> DataFrame:
    """A10. For each value column the last value that is not null."""
    known = lambda v: F.max_by(v, F.when(F.col(v).isNotNull(), F.col(order)))
    return rows.groupBy(*keys).agg(*[known(v).alias(v) for v in values])


def ordered_distinct(rows: DataFrame, value: str, order: list[str]) -> DataFrame:
    """A9/U2. Distinct values with the place of their first occurrence."""
    return rows.groupBy(value).agg(F.min(F.struct(*order)).alias("at")).select(value, "at.*")


def collected_distinct(rows: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """``keys..., values``: a group's distinct values in the order of their first occurrence; null values left out."""
    firsts = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(F.struct(*order)).alias("at"))
    return firsts.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", value))), lambda x: x[value]).alias("values"))


def roadmap(official: DataFrame, listings: DataFrame) -> DataFrame:
    """A5/J10. One row per number of official (``number, date, url, seq``) and listed (``number, date, drug, source, seq``) rows.

    Of several official rows the last counts. The date is the official one, else the first that a listing has; drugs
    and sources are distinct, with regard to case, in order. Rows without a number take no part. Sorted by number.
    """
    known = official.filter(F.col("number").isNotNull()).groupBy("number").agg(F.max_by(F.struct("date", "url"), "seq").alias("o"))
    rows = listings.filter(F.col("number").isNotNull())
    dates = rows.groupBy("number").agg(F.min_by("date", F.when(F.col("date").isNotNull(), F.col("seq"))).alias("d"))
    drugs = collected_distinct(rows, ["number"], "drug", ["seq"]).withColumnRenamed("values", "drugs")
    sources = collected_distinct(rows, ["number"], "source", ["seq"]).withColumnRenamed("values", "sources")
    every = known.join(dates, "number", "full").join(drugs, "number", "left").join(sources, "number", "left")
    empty = F.array().cast("array<string>")
    return every.select(
        "number", F.coalesce("o.date", "d").alias("notification_date"), F.coalesce("o.url", F.lit("")).alias("source_url"),
        F.coalesce("drugs", empty).alias("drugs"), F.coalesce("sources", empty).alias("sources"),
    ).orderBy("number")


def statistics(official: DataFrame, unofficial: DataFrame, ayush_fssai: DataFrame, documents: DataFrame, processed: DataFrame, reviews: DataFrame) -> DataFrame:
    """A4. The ten figures of the tables in one row; each table is counted in one pass."""
    one = lambda df, **counts: df.agg(*[c.alias(n) for n, c in counts.items()])
    every = F.count("*")
    parts = [
        one(official, total_banned_medicines=every, fdc_count=F.count_if("is_fdc"), single_ingredient_count=every - F.count_if("is_fdc")),
        one(unofficial, total_unofficial_medicines=every), one(ayush_fssai, total_ayush_fssai_medicines=every), one(documents, total_source_documents=every),
        one(processed, total_processed_notifications=every, downloaded_notifications=F.count_if(F.col("download_status") == "downloaded"), parsed_notifications=F.count_if(F.col("parsing_status") == "parsed")),
        one(reviews, pending_manual_reviews=F.count_if(F.col("status") == "pending")),
    ]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.crossJoin(p)  # one row each
    names = ["total_banned_medicines", "total_unofficial_medicines", "total_ayush_fssai_medicines", "total_source_documents", "total_processed_notifications", "downloaded_notifications", "parsed_notifications", "pending_manual_reviews", "fdc_count", "single_ingredient_count"]
    return whole.select(*names)
