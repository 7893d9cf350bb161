"""Queries of the training-data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom import scale
from medloom.functions.columns import SPACE, squeeze
from medloom.llm import canonical, consensus, leakage, linkage, mixture, setjoin, textstats
from medloom.tables import table

#: What is written where a reason is missing, as letters and digits in lower case.
STAND_INS = (
    "", "na", "nil", "null", "none", "nan", "unknown", "notavailable", "notstated", "notgiven", "notknown", "notspecified", "notrecorded", "notapplicable",
    "nonerecorded", "nonegiven", "nonestated", "reasonnotgiven", "reasonnotstated", "reasonunknown", "noreason", "noreasongiven", "tobeupdated", "tobeadded", "pending", "tbd", "tba",
)


def _keyed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    rows = table(spark, folder, name)
    return rows.select(canonical.record_key(rows).alias("key"), "id")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    found = None
    for name in ("banned_medicines", "unofficial_medicines"):
        part = canonical.copies(_keyed(spark, folder, name)).select(F.lit(name).alias("table_name"), "first_id", "id")
        found = part if found is None else found.unionAll(part)
    return found


def p1_copy_counts(spark: SparkSession, folder: str) -> DataFrame:
    """One record per set of copies of either table, with its fields and the number of copies."""
    found = None
    for name in ("banned_medicines", "unofficial_medicines"):
        rows = table(spark, folder, name).select(F.col("id").alias("first_id"), "generic_name", "notification_number")
        part = canonical.representatives(_keyed(spark, folder, name)).join(rows, "first_id").select(F.lit(name).alias("table_name"), "first_id", "n_copies", "generic_name", "notification_number")
        found = part if found is None else found.unionAll(part)
    return found


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "banned_medicines")
    repeats = scale.materialize(canonical.copies(rows.select(canonical.record_key(rows).alias("key"), "id")))
    sets = repeats.unionAll(repeats.select("first_id", F.col("first_id").alias("id")).distinct())
    records = sets.join(rows.select("id", "source_pdf", "notification_date", "ban_reason", "last_updated"), "id")
    reason = squeeze(F.col("ban_reason"))
    letters = F.regexp_replace(F.lower(F.col("ban_reason")), r"[^\p{L}\p{M}\p{N}]+", "")
    link = F.lower(F.regexp_replace(F.col("source_pdf"), SPACE + "+", ""))
    host = F.regexp_extract(link, r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@?#]*@)?(?:www\.)?([^/:?#]+)", 1)
    trust = scale.materialize(
        table(spark, folder, "source_ranks").filter(F.col("host").isNotNull() & F.col("trust_rank").isNotNull()).groupBy(F.lower(F.trim("host")).alias("host")).agg(F.min("trust_rank").alias("trust_rank"))
    )
    ranked = scale.lookup_join(records.withColumn("host", host), trust, ["host"])
    dated = F.col("notification_date").isNotNull() & (F.col("last_updated").isNull() | (F.col("notification_date") <= F.to_date("last_updated")))
    named = lambda field, value, merit: F.struct(F.lit(field).alias("field_name"), value.alias("v"), merit.cast("bigint").alias("merit"))
    candidates = F.array(
        named("ban_reason", F.when(~letters.isin(*STAND_INS), reason), F.char_length(reason)),
        named("notification_date", F.when(dated, F.col("notification_date").cast("string")), F.lit(0)),
        named("source_pdf", F.nullif(link, F.lit("")), -F.coalesce(F.col("trust_rank"), F.lit((1 << 31) - 1))),
    )
    listed = ranked.select("first_id", "id", F.coalesce(F.unix_micros(F.col("last_updated").cast("timestamp")), F.lit(-(1 << 62))).alias("updated"), F.inline(candidates))
    best = consensus.survivors(listed, ["first_id", "field_name"], "v", [F.col("merit"), F.col("updated"), -F.col("id")], ["id"])
    return best.select("first_id", "field_name", F.col("id").alias("from_id"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    forms = table(spark, folder, "dosage_forms").select(F.col("form_id").alias("ref_id"), F.col("form_name").alias("name"))
    rows = None
    for name in ("banned_medicines", "unofficial_medicines"):
        part = table(spark, folder, name).select(F.lit(name).alias("table_name"), "id", "dosage_form")
        rows = part if rows is None else rows.unionAll(part)
    return setjoin.map_to_list(rows, ["table_name", "id"], "dosage_form", forms).withColumnRenamed("ref_id", "form_id")


def _links(spark: SparkSession, folder: str) -> linkage.Links:
    left = table(spark, folder, "banned_medicines").select("id", F.col("generic_name").alias("name"), "ingredients", F.col("notification_number").alias("number"))
    right = table(spark, folder, "unofficial_medicines").select("id", F.col("generic_name").alias("name"), F.col("notification_number").alias("number"))
    return linkage.link(left, right)


def p7_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Every matched row once: the entity it belongs to, the confidence, and the number of rows it is linked to."""
    side = F.when(F.col("side") == "left", "banned_medicines").otherwise("unofficial_medicines")
    return _links(spark, folder).members().select("entity_id", side.alias("table_name"), "id", F.round("confidence", 6).alias("confidence"), "links")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return _links(spark, folder).expand().select(F.col("left_id").alias("banned_id"), F.col("right_id").alias("unofficial_id"))


def p8_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """The cases with the share of the item and of its slots."""
    return leakage.leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return p8_leaks(spark, folder).select("item_id", "doc_id")


def _mix(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    documents = table(spark, folder, "documents").select("doc_id", mixture.source_key(F.col("source")).alias("source_key"), "text")
    targets = table(spark, folder, "mix_targets")
    return mixture.mixture(mixture.token_counts(documents, ["doc_id", "source_key"]), targets)


def p9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return _mix(spark, folder)[0]


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    return _mix(spark, folder)[1]


def p10_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return textstats.outlier_scores(table(spark, folder, "documents"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return textstats.not_prose(table(spark, folder, "documents"), table(spark, folder, "doc_labels"))


QUERIES = {
    "p1_found": p1_found, "p1_copy_counts": p1_copy_counts, "p2_found": p2_found, "p5_found": p5_found, "p7_found": p7_found, "p7_matches": p7_matches,
    "p8_found": p8_found, "p8_leaks": p8_leaks, "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p10_found": p10_found, "p10_statistics": p10_statistics,
}
