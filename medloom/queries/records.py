"""Queries of the record operators - filters, deduplication, joins, merges, routing, order - and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medloom import lexicon
from medloom.functions.text import any_of, normalize_number, safe_file_name, strip, url_host
from medloom.operators import dedup, merge, validate, xref
from medloom.queries.text_ops import sql_number, sql_strip
from medloom.sources.files import EXPORT_10, EXPORT_13, export_rows
from medloom.tables import table

AS_OF = "2024-06-30"
NOW = "2025-01-01 00:00:00"
#: Ingredients that P10's rows must all have.
WANTED = ("Dembrundirquel",)
_OUT = {"unofficial_medicines": "unofficial", "ayush_fssai_medicines": "ayush_fssai"}


def _quoted(terms: list[str]) -> str:
    return ", ".join(f"'{t}'" for t in terms)


def _sql_any(c: str, terms: list[str]) -> str:
    return f"coalesce(len(list_filter([{_quoted(terms)}], lambda t: contains(lower({c}), t))) > 0, false)"


def _sql_hits(c: str, terms: list[str]) -> str:
    return f"coalesce(len(list_filter([{_quoted(terms)}], lambda t: contains(lower({c}), t))), 0)"


def _sql_word(c: str) -> str:
    return rf"list_filter([{_quoted(lexicon.OFFICE_WORDS)}], lambda t: regexp_matches({c}, '\b' || t || '\b'))"


# ---- filters


def ref_p1_keyword_filter(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").filter(validate.is_ban_related(F.concat_ws(" ", "source", "text"))).select("doc_id")


def ref_p3_page_signals(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.coalesce(validate.is_drug_page(F.col("text")), F.lit(False)).alias("is_drug_page"))


def _names(spark: SparkSession, folder: str) -> DataFrame:
    """Names as they come, and by id such as a careless extraction leaves behind."""
    odd = F.when(F.col("id") % 7 == 0, F.lit("About us")).when(F.col("id") % 7 == 1, F.col("source_pdf")).when(F.col("id") % 7 == 2, F.col("strength")).when(F.col("id") % 7 == 3, F.lit("January (72)")).when(F.col("id") % 7 == 4, F.lit(" Annexure"))
    return table(spark, folder, "banned_medicines").select(
        "id", F.coalesce(F.when(F.col("id") % 3 == 0, odd), F.col("generic_name")).alias("generic_name"), "dosage_form", "notification_number", "notification_date"
    )


_SQL_NAMES = """n AS (SELECT id, coalesce(CASE WHEN id % 3 = 0 THEN CASE id % 7 WHEN 0 THEN 'About us' WHEN 1 THEN source_pdf WHEN 2 THEN strength WHEN 3 THEN 'January (72)' WHEN 4 THEN ' Annexure' END END, generic_name) AS generic_name,
    dosage_form, notification_number, notification_date FROM banned_medicines)"""


def ref_p4_validate(spark: SparkSession, folder: str) -> DataFrame:
    checked = validate.validated(_names(spark, folder), F.lit(AS_OF).cast("date"))
    return checked.select("id", F.array_join("errors", " ; ").alias("errors"), F.array_join("warnings", " ; ").alias("warnings"), "is_valid")


def ref_p5_junk(spark: SparkSession, folder: str) -> DataFrame:
    return _names(spark, folder).select("id", validate.is_junk(F.col("generic_name")).alias("is_junk"))


def ref_p6_not_names(spark: SparkSession, folder: str) -> DataFrame:
    return _names(spark, folder).filter(F.lower(strip(F.col("generic_name"))).isin(lexicon.NOT_NAMES)).select("id", "generic_name")


def ref_p7_equality(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "notifications_processed").filter((F.col("download_status") == "downloaded") & F.col("error_message").eqNullSafe(None)).select("id", "notification_number", "parsing_status")


def ref_p9_like_split(spark: SparkSession, folder: str) -> DataFrame:
    _, moved = merge.split_by(table(spark, folder, "banned_medicines"), (F.col("source_pdf").like("%drugwatch%") | F.col("source_pdf").like("%medlist%")) & ~F.col("source_pdf").like("%old-%"))
    return moved.select("id", "source_pdf")


def ref_p10_contains(spark: SparkSession, folder: str) -> DataFrame:
    """Containment: rows whose ingredients hold all of a wanted set."""
    rows = table(spark, folder, "banned_medicines")
    return rows.filter(F.size(F.array_except(F.array(*map(F.lit, WANTED)), "ingredients")) == 0).select("id", F.size("ingredients").alias("n_ingredients"))


def ref_p11_not_seen(spark: SparkSession, folder: str) -> DataFrame:
    seen = table(spark, folder, "notifications_processed").filter("source_url is not null").select("source_url")
    return table(spark, folder, "banned_medicines").filter("source_url is not null").join(seen, "source_url", "left_anti").select("id", "source_url")


def ref_p12_to_fetch(spark: SparkSession, folder: str) -> DataFrame:
    """All that isn't downloaded into a file that is there; the valid files are those whose name says what they are."""
    rows = table(spark, folder, "notifications_processed").withColumn("file_valid", F.coalesce(F.lower("pdf_path").endswith(".pdf"), F.lit(False)))
    return merge.to_fetch(rows, F.col("file_valid")).select("id", "notification_number")


# ---- deduplication and aggregates


def ref_a1_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "banned_medicines").select("id", "generic_name", "dosage_form", "source_pdf")
    return dedup.first_wins(rows, F.lower(strip(F.col("generic_name"))), "id")


def ref_a2_merged_sources(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("notification_number", "source", "doc_id")
    return dedup.merged_lists(rows, ["notification_number"], "source", "doc_id")


def ref_a2_deduplicated(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "banned_medicines").select("id", "generic_name", url_host(F.col("source_url")).alias("source"))
    return dedup.deduplicated(rows, "generic_name", "source", "id")


def ref_a3_counts(spark: SparkSession, folder: str) -> DataFrame:
    found = None
    for name in ("banned_medicines", "unofficial_medicines", "ayush_fssai_medicines", "notifications_processed"):
        part = table(spark, folder, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        found = part if found is None else found.unionAll(part)
    return found


def ref_a4_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """The ten figures; documents are the source documents, failed parses wait for review."""
    named = {n: table(spark, folder, n) for n in ("banned_medicines", "unofficial_medicines", "ayush_fssai_medicines", "notifications_processed")}
    reviews = named["notifications_processed"].select(F.when(F.col("parsing_status") == "failed", "pending").alias("status"))
    return dedup.statistics(named["banned_medicines"], named["unofficial_medicines"], named["ayush_fssai_medicines"], table(spark, folder, "documents"), named["notifications_processed"], reviews)


def ref_a5_roadmap(spark: SparkSession, folder: str) -> DataFrame:
    number = normalize_number(F.col("notification_number")).alias("number")
    official = table(spark, folder, "notifications_processed").select(number, F.col("notification_date").alias("date"), F.col("source_url").alias("url"), F.col("id").alias("seq"))
    listings = table(spark, folder, "unofficial_medicines").select(number, F.col("notification_date").alias("date"), F.col("generic_name").alias("drug"), F.col("source_pdf").alias("source"), F.col("id").alias("seq"))
    found = dedup.roadmap(official, listings)
    return found.select("number", "notification_date", "source_url", F.array_join("drugs", " | ").alias("drugs"), F.array_join("sources", " | ").alias("sources"))


def ref_a8_first_url(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "banned_medicines").select(normalize_number(F.col("notification_number")).alias("number"), "source_url", "id").filter("number is not null")
    return dedup.first_of(rows, ["number"], "source_url", ["id"])


def ref_a9_ordered_distinct(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").filter("url is not null").select("url", F.unix_micros(F.col("fetched_at").cast("timestamp")).alias("first_us"), "doc_id")
    return dedup.ordered_distinct(rows, "url", ["first_us", "doc_id"])


def ref_a10_last_known(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "banned_medicines").select(normalize_number(F.col("notification_number")).alias("number"), "notification_date", "source_url", "id")
    return dedup.last_of(rows, ["number"], ["notification_date", "source_url"], "id")


def ref_a11_junk_counts(spark: SparkSession, folder: str) -> DataFrame:
    found = None
    for name in ("banned_medicines", "unofficial_medicines", "ayush_fssai_medicines"):
        part = table(spark, folder, name).select(F.lit(name).alias("table_name"), validate.is_junk(F.col("generic_name")).alias("junk"))
        found = part if found is None else found.unionAll(part)
    return found.groupBy("table_name").agg(F.count("*").alias("total"), F.count_if("junk").alias("junk"), F.count_if(~F.col("junk")).alias("clean"))


def ref_a12_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "notifications_processed").groupBy("download_status", "parsing_status").agg(F.count("*").alias("n"), F.count_if(F.col("error_message").isNotNull()).alias("n_errors"))


# ---- joins


def _crossed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    listing = table(spark, folder, name).select("id", "generic_name", "notification_number")
    return xref.cross_referenced(listing, table(spark, folder, "banned_medicines").select("generic_name", "ingredients", "notification_number"))


def ref_j1_cross_reference(spark: SparkSession, folder: str) -> DataFrame:
    return _crossed(spark, folder, "unofficial_medicines")


def ref_j2_cross_reference(spark: SparkSession, folder: str) -> DataFrame:
    return _crossed(spark, folder, "ayush_fssai_medicines")


def ref_a6_link_summary(spark: SparkSession, folder: str) -> DataFrame:
    both = [_crossed(spark, folder, n).withColumn("listing", F.lit(a)) for n, a in _OUT.items()]
    return xref.link_summary(both[0].unionByName(both[1]), ["listing"])


def ref_j7_url_or_cache(spark: SparkSession, folder: str) -> DataFrame:
    cache = ref_a8_first_url(spark, folder).withColumnRenamed("source_url", "cached")
    rows = table(spark, folder, "notifications_processed").select("id", normalize_number(F.col("notification_number")).alias("number"), "source_url")
    return rows.join(cache, "number", "left").select("id", F.coalesce(F.nullif("source_url", F.lit("")), F.col("cached")).alias("url"))


def ref_j9_without_download(spark: SparkSession, folder: str) -> DataFrame:
    done = table(spark, folder, "notifications_processed").filter("download_status = 'downloaded'").select(normalize_number(F.col("notification_number")).alias("number"))
    return table(spark, folder, "banned_medicines").select("id", normalize_number(F.col("notification_number")).alias("number")).join(done, "number", "left_anti")


# ---- merges


def _medicines(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return table(spark, folder, name).select("id", *merge.MEDICINE_KEY, "notification_date", "ban_reason", "source_pdf", "date_added", "last_updated")


def _first_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    return dedup.first_wins(rows, F.struct(*keys), "id")


def ref_m1_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The official rows of even ids, one a key, after a batch of all rows."""
    rows = _medicines(spark, folder, "banned_medicines")
    target = _first_rows(rows.filter("id % 2 = 0"), merge.MEDICINE_KEY)
    out = merge.upsert(target, rows.withColumn("seq", F.col("id")), merge.MEDICINE_KEY, ["notification_date", "ban_reason", "source_pdf"], "seq", F.lit(NOW).cast("timestamp"))
    return out.select(*merge.MEDICINE_KEY, "notification_date", "ban_reason", "source_pdf", "outcome")


def ref_m2_notification_upsert(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "notifications_processed").withColumn("date_added", F.col("last_attempt")).withColumn("last_updated", F.col("last_attempt"))
    values = ["download_status", "parsing_status", "error_message", "pdf_path"]
    batch = rows.select(normalize_number(F.col("notification_number")).alias("notification_number"), *values, F.col("id").alias("seq")).filter("seq % 2 = 1")
    out = merge.upsert(rows.filter("id % 2 = 0").select("id", "notification_number", *values, "date_added", "last_updated"), batch, ["notification_number"], values, "seq", F.lit(NOW).cast("timestamp"), {"download_status": F.lit("pending"), "parsing_status": F.lit("pending")})
    return out.select("notification_number", *values, "outcome")


def ref_m3_review_queue(spark: SparkSession, folder: str) -> DataFrame:
    """A queue made of every 4th unlinked listing row, then all of them again."""
    listing = table(spark, folder, "unofficial_medicines").select("id", "generic_name", "notification_number", "notification_date")
    items = xref.review_items(_crossed(spark, folder, "unofficial_medicines"), listing, "Listing")
    old = items.filter("id % 4 = 0 and notification_number is not null").drop("id").dropDuplicates(["notification_number", "issue_type"])
    queue = old.select(F.monotonically_increasing_id().alias("id"), *old.columns, F.lit("pending").alias("status"), F.lit(NOW).cast("timestamp").alias("date_added"), F.lit(NOW).cast("timestamp").alias("last_updated"))
    out = merge.queue_reviews(queue, items.withColumnRenamed("id", "seq"), "seq", F.lit(NOW).cast("timestamp"))
    return out.select("notification_number", "issue_type", "description", "status")


def ref_m5_set_status(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "notifications_processed").select("id", F.col("download_status").alias("status"), F.col("error_message").alias("notes"))
    changes = rows.filter("id % 5 = 0").select("id", F.lit("reviewed").alias("status"), F.when(F.col("id") % 2 == 0, "seen").otherwise("").alias("notes"))
    return merge.set_status(rows, "id", changes)


def ref_m6_delete_junk(spark: SparkSession, folder: str) -> DataFrame:
    return merge.without(_names(spark, folder), validate.is_junk(F.col("generic_name"))).select("id", "generic_name")


def ref_m8_split_tables(spark: SparkSession, folder: str) -> DataFrame:
    stays, moves = merge.split_by(table(spark, folder, "banned_medicines"), F.col("source_pdf").like("%medlist%"))
    return stays.groupBy().agg(F.count("*").alias("n")).withColumn("part", F.lit("stays")).unionByName(moves.groupBy().agg(F.count("*").alias("n")).withColumn("part", F.lit("moves")))


def ref_m9_backfill(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "unofficial_medicines").select("id", "dosage_form")
    return merge.backfilled(rows, {"is_fdc": F.lit(False), "source_url": F.lit(""), "dosage_form": F.lit("unknown")})


# ---- routing, order, sets, exports


def ref_r1_route(spark: SparkSession, folder: str) -> DataFrame:
    source = F.when(F.col("id") % 4 == 0, F.lit("https://www.ayush.example/x")).when(F.col("id") % 4 == 1, F.lit("TheHealthMaster, fssai")).otherwise(F.col("source_pdf"))
    return table(spark, folder, "unofficial_medicines").select("id", validate.route(source).alias("target"))


def ref_r2_validity(spark: SparkSession, folder: str) -> DataFrame:
    return validate.validated(_names(spark, folder), F.lit(AS_OF).cast("date")).groupBy("is_valid").agg(F.count("*").alias("n"), F.sum(F.size("errors")).alias("n_errors"))


def ref_r4_download_outcome(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "notifications_processed")
    issue = F.when(F.col("source_url").isNull(), "missing_pdf").when(any_of(F.col("error_message"), ["shorter than", "not a pdf"]), "corrupted_pdf").when(F.col("error_message").isNotNull(), "download_failed")
    return rows.select("id", issue.alias("issue_type"))


def ref_o1_by_name(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "banned_medicines").select("id", "generic_name").orderBy("generic_name", "id")


def ref_o2_of_number(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "banned_medicines").select("id", "generic_name", normalize_number(F.col("notification_number")).alias("number"))
    return rows.filter("number = 'G.S.R. 417(E)'").orderBy("generic_name", "id")


def ref_o5_latest_per_number(spark: SparkSession, folder: str) -> DataFrame:
    """As an aggregate that combines before the shuffle: a number of many rows is no task of its own."""
    rows = table(spark, folder, "banned_medicines").select("id", "last_updated", normalize_number(F.col("notification_number")).alias("number")).filter("number is not null")
    return rows.groupBy("number").agg(F.max_by("id", F.struct("last_updated", -F.col("id"))).alias("id"))


def ref_o6_until_successes(spark: SparkSession, folder: str) -> DataFrame:
    """Attempts in order of ids until 50 downloads: a running count by parts, cut where it reaches the limit."""
    from medloom.scale import with_offsets

    rows = table(spark, folder, "notifications_processed").select("id", "download_status")
    counted = with_offsets(rows.withColumn("g", F.lit(0)), ["g"], ["id"], (F.col("download_status") == "downloaded").cast("bigint"), bucket=F.floor(F.col("id") / 64))
    return counted.filter("start < 50").select("id", "download_status", F.col("start").alias("successes_before"))


def ref_o9_first_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.array_join(F.slice(F.split("text", "\n"), 1, 3), " / ").alias("head"))


def ref_u1_union_all(spark: SparkSession, folder: str) -> DataFrame:
    found = None
    for i, name in enumerate(("banned_medicines", "unofficial_medicines", "ayush_fssai_medicines")):
        part = table(spark, folder, name).select(F.lit(i).alias("source_ord"), "id", "generic_name")
        found = part if found is None else found.unionByName(part)
    return found


def ref_u3_same_sets(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "banned_medicines").filter("ingredients is not null and generic_name is not null")
    sets = lambda c: F.array_sort(F.array_distinct(F.transform(c, lambda x: F.lower(strip(x)))))
    return rows.select("id", (sets(F.split("generic_name", r"\+")) == sets(F.col("ingredients"))).alias("same"))


def ref_u4_difference(spark: SparkSession, folder: str) -> DataFrame:
    key = lambda n: table(spark, folder, n).select(normalize_number(F.col("notification_number")).alias("number")).filter("number is not null").distinct()
    return key("unofficial_medicines").exceptAll(key("banned_medicines"))


def ref_k1_export(spark: SparkSession, folder: str) -> DataFrame:
    return export_rows(table(spark, folder, "unofficial_medicines"), EXPORT_10)


def ref_k2_export(spark: SparkSession, folder: str) -> DataFrame:
    return export_rows(table(spark, folder, "banned_medicines"), EXPORT_13)


def ref_k6_file_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").filter("url is not null").select("doc_id", F.concat(safe_file_name(F.col("url")), F.lit(".pdf")).alias("file_name"))


# ---- the rest of the inventory


def ref_p2_document_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Blank lines part the pages of a text here; a product word must stand on one of the first three."""
    rows = table(spark, folder, "documents").filter("text is not null")
    return rows.select("doc_id", validate.is_drug_document(F.split("text", "\n\n"), ["tablet", "recall", "batch", "licence"]).alias("is_drug_document"))


def ref_p8_delete_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "unofficial_medicines").select("id", "generic_name")
    bad = rows.filter("length(generic_name) > 60").select("id")
    return rows.join(bad, "id", "left_anti")


def ref_f13_record(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "banned_medicines").drop("id", "date_added", "last_updated", "is_fdc").withColumns({c: F.array_join(c, ", ") for c in ("brand_names", "ingredients")})


def ref_k3_backup(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "notifications_processed")
    return rows.select(F.to_json(F.struct("id", "notification_number", "notification_date", "download_status"), {"ignoreNullFields": "false"}).alias("line"))


def ref_j8_only_combinations(spark: SparkSession, folder: str) -> DataFrame:
    """Multi-ingredient official names of a notification that no listing of it has."""
    key = lambda n: table(spark, folder, n).select(normalize_number(F.col("notification_number")).alias("number"), F.lower(strip(F.col("generic_name"))).alias("name"))
    return key("banned_medicines").filter("contains(name, '+') and number is not null").distinct().join(key("unofficial_medicines"), ["number", "name"], "left_anti")


def ref_a7_grouped(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "ayush_fssai_medicines").select(normalize_number(F.col("notification_number")).alias("number"), "generic_name", "id")
    return dedup.collected_distinct(rows.filter("number is not null"), ["number"], "generic_name", ["id"]).select("number", F.array_join("values", " | ").alias("names"))


def ref_m4_source_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Files named by the official rows, the later half upserted over the earlier."""
    rows = table(spark, folder, "banned_medicines").filter("source_pdf is not null").select("id", F.col("source_pdf").alias("file_name"), "source_url", "notification_date", "date_added", "last_updated")
    target = dedup.first_wins(rows.filter("id % 2 = 0"), F.col("file_name"), "id")
    out = merge.upsert(target, rows.filter("id % 2 = 1").withColumn("seq", F.col("id")), ["file_name"], ["source_url", "notification_date"], "seq", F.lit(NOW).cast("timestamp"))
    return out.select("file_name", "source_url", "notification_date", "outcome")


def ref_m12_health(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql("SELECT 1 AS one")


def ref_o3_by_id(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "ayush_fssai_medicines").select("id", "generic_name").orderBy("id")


def ref_o4_sorted_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "notifications_processed").select(normalize_number(F.col("notification_number")).alias("number")).filter("number is not null").distinct().orderBy("number")


def ref_o7_processed_first(spark: SparkSession, folder: str) -> DataFrame:
    """The first 25 notifications that have a file, by a running count in parts; those without don't count."""
    from medloom.scale import with_offsets

    rows = table(spark, folder, "notifications_processed").select("id", F.col("pdf_path").isNotNull().cast("bigint").alias("has"))
    counted = with_offsets(rows.withColumn("g", F.lit(0)), ["g"], ["id"], F.col("has"), bucket=F.floor(F.col("id") / 64))
    return counted.filter("has = 1 and start < 25").select("id")


def ref_o8_first(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "unofficial_medicines").filter("dosage_form = 'Tablet'").groupBy().agg(F.min_by("generic_name", "id").alias("name"), F.min("id").alias("id"))


def ref_u2_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("source", "lang").distinct()


def ref_c6_pending(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "notifications_processed").filter("parsing_status = 'pending'").select("id", "notification_number", "download_status")


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("ref_")}

_LOW = sql_strip("lower(generic_name)")
_DOMAIN = r"regexp_full_match(x, '[\w\-]+\.\w{2,6}')"
_ARCHIVE = rf"regexp_full_match(x, '(?:{'|'.join(lexicon.MONTHS)})\s*\([0-9]+\)')"
_JUNK = f"""x IN ({_quoted(lexicon.NOT_NAMES)}) OR {_DOMAIN} OR {_sql_any('x', lexicon.JUNK_PARTS)} OR {_sql_any('x', lexicon.JUNK_SITES)} OR length(x) < 3
    OR regexp_full_match(x, '[0-9\\s.,%]+') OR len({_sql_word('x')}) > 0 OR {_ARCHIVE}"""
_KEYED = "n.notification_number IS NOT DISTINCT FROM"
_MKEY = ", ".join(merge.MEDICINE_KEY)
_SAME = " AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in merge.MEDICINE_KEY)


def _sql_crossed(name: str) -> str:
    return rf"""
        WITH o AS (SELECT {sql_number('notification_number')} AS number, {sql_strip('lower(generic_name)')} AS n,
            CASE WHEN len(ingredients) > 0 THEN list_sort(list_distinct(list_transform(ingredients, lambda x: {sql_strip('lower(x)')}))) ELSE [{sql_strip('lower(generic_name)')}] END AS s FROM banned_medicines),
        l AS (SELECT id, {sql_number('notification_number')} AS number, {sql_strip('lower(generic_name)')} AS n,
            list_sort(list_distinct(list_transform(string_split(generic_name, '+'), lambda x: {sql_strip('lower(x)')}))) AS s FROM {name})
        SELECT id, CASE WHEN number IS NULL THEN 'missing_number' WHEN number NOT IN (SELECT number FROM o WHERE number IS NOT NULL) THEN 'number_not_found'
            WHEN EXISTS (SELECT 1 FROM o WHERE o.number = l.number AND o.n = l.n) OR EXISTS (SELECT 1 FROM o WHERE o.number = l.number AND o.s = l.s) THEN 'linked' ELSE 'no_match' END AS outcome FROM l"""


def _sql_last(c: str, order: str = "id", where: str = "IS NOT NULL") -> str:
    return f"arg_max({c}, {order}) FILTER (WHERE {c} {where})"


def _sql_export(columns: list[str], name: str) -> str:
    parts = []
    for c in columns:
        if c in ("brand_names", "ingredients"):
            parts.append(f"coalesce(array_to_string({c}, ', '), '') AS {c}")
        elif c == "is_fdc":
            parts.append("CASE WHEN is_fdc THEN 'True' WHEN NOT is_fdc THEN 'False' ELSE '' END AS is_fdc")
        else:
            whole = f"make_timestamp(epoch_us({c}))"
            stamp = f"strftime({whole}, '%Y-%m-%d %H:%M:%S') || CASE WHEN epoch_us({c}) % 1000000 = 0 THEN '' ELSE strftime({whole}, '.%f') END || '+00:00'"
            parts.append(f"coalesce({stamp if c == 'date_added' else f'CAST({c} AS VARCHAR)'}, '') AS {c}")
    return f"SELECT {', '.join(parts)} FROM {name}"


_M1 = f"""
    WITH r AS (SELECT id, {_MKEY}, notification_date, ban_reason, source_pdf FROM banned_medicines),
    t AS (SELECT * FROM r WHERE id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY {_MKEY} ORDER BY id) = 1),
    s AS (SELECT {_MKEY}, {_sql_last('notification_date')} AS notification_date, {_sql_last('ban_reason')} AS ban_reason, {_sql_last('source_pdf')} AS source_pdf FROM r GROUP BY ALL),
    m AS (SELECT t.id AS tid, s.f AS f, {', '.join(f't.{k} AS t_{k}, s.{k} AS s_{k}' for k in [*merge.MEDICINE_KEY, 'notification_date', 'ban_reason', 'source_pdf'])} FROM t FULL JOIN (SELECT *, 1 AS f FROM s) s ON {_SAME})
    SELECT {', '.join(f'CASE WHEN tid IS NULL THEN s_{k} ELSE t_{k} END AS {k}' for k in merge.MEDICINE_KEY)}, coalesce(s_notification_date, t_notification_date) AS notification_date,
      coalesce(s_ban_reason, t_ban_reason) AS ban_reason, coalesce(s_source_pdf, t_source_pdf) AS source_pdf, CASE WHEN tid IS NULL THEN 'inserted' WHEN f IS NOT NULL THEN 'updated' ELSE 'kept' END AS outcome FROM m"""
_M2V = ["download_status", "parsing_status", "error_message", "pdf_path"]
_M2 = f"""
    WITH t AS (SELECT * FROM notifications_processed WHERE id % 2 = 0),
    s AS (SELECT {sql_number('notification_number')} AS number, {', '.join(f'{_sql_last(v)} AS {v}' for v in _M2V)}, 1 AS f FROM notifications_processed WHERE id % 2 = 1 GROUP BY 1),
    m AS (SELECT t.id AS tid, t.notification_number AS tn, s.number AS sn, s.f AS f, {', '.join(f't.{v} AS t_{v}, s.{v} AS s_{v}' for v in _M2V)} FROM t FULL JOIN s ON t.notification_number IS NOT DISTINCT FROM s.number)
    SELECT CASE WHEN tid IS NULL THEN sn ELSE tn END AS notification_number, {', '.join(f"coalesce(s_{v}, t_{v}{', ' + chr(39) + 'pending' + chr(39) if 'status' in v else ''}) AS {v}" for v in _M2V)},
      CASE WHEN tid IS NULL THEN 'inserted' WHEN f IS NOT NULL THEN 'updated' ELSE 'kept' END AS outcome FROM m"""
_M3 = f"""
    WITH c AS ({_sql_crossed('unofficial_medicines')}),
    i AS (SELECT c.id, nullif(u.notification_number, '') AS notification_number, CASE WHEN outcome = 'missing_number' THEN 'missing_notification_number' ELSE 'unlinked_record' END AS issue_type,
      CASE outcome WHEN 'missing_number' THEN 'Listing has no notification number: ' WHEN 'number_not_found' THEN 'Listing names a number without official rows: ' ELSE 'Listing matches no official row of its number: ' END || coalesce(generic_name, '') AS description
      FROM c JOIN unofficial_medicines u ON c.id = u.id WHERE outcome <> 'linked')
    SELECT notification_number, issue_type, arg_max(description, id) AS description, 'pending' AS status FROM i GROUP BY notification_number, issue_type"""

SQL = {
    "ref_p1_keyword_filter": f"WITH t AS (SELECT doc_id, concat_ws(' ', source, text) AS body FROM documents) SELECT doc_id FROM t WHERE NOT {_sql_any('body', lexicon.EXCLUDED)} AND ({_sql_any('body', lexicon.BAN_STRONG)} OR {_sql_any('body', lexicon.BAN_WEAK)})",
    "ref_p3_page_signals": f"SELECT doc_id, {_sql_hits('text', lexicon.PAGE_POSITIVE)} >= 2 AND {_sql_hits('text', lexicon.PAGE_NEGATIVE)} <= {_sql_hits('text', lexicon.PAGE_POSITIVE)} AS is_drug_page FROM documents",
    "ref_p4_validate": rf"""
        WITH {_SQL_NAMES}, y AS (SELECT *, {_LOW} AS x, '''' || generic_name || '''' AS q, {sql_strip('lower(dosage_form)')} AS k FROM n),
        z AS (SELECT *, list_filter([
          CASE WHEN x IN ({_quoted(lexicon.NOT_NAMES)}) THEN 'generic_name is blacklisted: ' || q END,
          CASE WHEN regexp_matches(x, '\.\w{{2,4}}$') AND regexp_matches(x, '[/:]|www\.') THEN 'generic_name looks like a URL: ' || q END,
          CASE WHEN {_DOMAIN} THEN 'generic_name looks like a domain: ' || q END,
          CASE WHEN length(x) < 3 THEN 'generic_name too short: ' || q END,
          CASE WHEN regexp_full_match(x, '[0-9\s.,%]+') THEN 'generic_name is numeric: ' || q END,
          'generic_name contains junk substring ''' || list_filter([{_quoted(lexicon.JUNK_PARTS)}], lambda t: contains(x, t))[1] || ''': ' || q,
          'generic_name contains administrative/navigation keyword ''' || {_sql_word('x')}[1] || ''': ' || q,
          CASE WHEN {_ARCHIVE} THEN 'generic_name matches archive label pattern: ' || q END], lambda e: e IS NOT NULL) AS named FROM y)
        SELECT id, array_to_string(list_concat(CASE WHEN coalesce(x = '', true) THEN ['generic_name is empty'] ELSE named END,
            CASE WHEN notification_date > DATE '{AS_OF}' THEN ['notification_date is in the future: ' || CAST(notification_date AS VARCHAR)] ELSE [] END), ' ; ') AS errors,
          array_to_string(list_filter([CASE WHEN dosage_form <> '' AND NOT (k IN ({_quoted(list(lexicon.FORMS))}) OR regexp_replace(k, 's+$', '') IN ({_quoted(list(lexicon.FORMS))})) THEN 'Unrecognised dosage_form: ''' || dosage_form || '''' END,
            CASE WHEN notification_number <> '' AND NOT (regexp_matches(notification_number, 'G\.?S\.?R\.?\s*[0-9]+', 'i') OR regexp_matches(notification_number, 'S\.?O\.?\s*[0-9]+', 'i'))
              THEN 'notification_number does not match G.S.R./S.O. pattern: ''' || notification_number || '''' END], lambda e: e IS NOT NULL), ' ; ') AS warnings,
          coalesce(x <> '', false) AND len(named) = 0 AND coalesce(notification_date <= DATE '{AS_OF}', true) AS is_valid FROM z""",
    "ref_p5_junk": f"WITH {_SQL_NAMES}, y AS (SELECT id, {_LOW} AS x FROM n) SELECT id, coalesce({_JUNK}, true) AS is_junk FROM y",
    "ref_p6_not_names": f"WITH {_SQL_NAMES} SELECT id, generic_name FROM n WHERE {_LOW} IN ({_quoted(lexicon.NOT_NAMES)})",
    "ref_p7_equality": "SELECT id, notification_number, parsing_status FROM notifications_processed WHERE download_status = 'downloaded' AND error_message IS NULL",
    "ref_p9_like_split": "SELECT id, source_pdf FROM banned_medicines WHERE (source_pdf LIKE '%drugwatch%' OR source_pdf LIKE '%medlist%') AND NOT source_pdf LIKE '%old-%'",
    "ref_p10_contains": "SELECT id, CAST(len(ingredients) AS INTEGER) AS n_ingredients FROM banned_medicines WHERE list_has_all(ingredients, [" + ", ".join(f"'{w}'" for w in WANTED) + "])",
    "ref_p11_not_seen": "SELECT id, source_url FROM banned_medicines WHERE source_url IS NOT NULL AND source_url NOT IN (SELECT source_url FROM notifications_processed WHERE source_url IS NOT NULL)",
    "ref_p12_to_fetch": "SELECT id, notification_number FROM notifications_processed WHERE NOT coalesce(download_status = 'downloaded' AND lower(pdf_path) LIKE '%.pdf', false)",
    "ref_a1_first_wins": f"SELECT id, generic_name, dosage_form, source_pdf FROM banned_medicines QUALIFY row_number() OVER (PARTITION BY {_LOW} ORDER BY id) = 1",
    "ref_a2_merged_sources": f"""
        WITH p AS (SELECT notification_number, doc_id, source, unnest(list_filter(list_transform(string_split(source, ','), lambda s: {sql_strip('s')}), lambda s: s <> '')) AS s, 1 AS p FROM documents),
        f AS (SELECT notification_number, lower(s) AS k, arg_min(s, doc_id) AS s, min(doc_id) AS o FROM p GROUP BY ALL),
        j AS (SELECT notification_number, string_agg(s, ', ' ORDER BY o) AS j FROM f GROUP BY 1),
        g AS (SELECT notification_number, count(*) AS n, max(source) AS only_one FROM documents GROUP BY 1)
        SELECT g.notification_number, CASE WHEN n = 1 THEN only_one ELSE j END AS merged FROM g LEFT JOIN j ON g.notification_number IS NOT DISTINCT FROM j.notification_number""",
    "ref_a2_deduplicated": f"""
        WITH b AS (SELECT id, generic_name, nullif(regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '') AS source, {_LOW} AS k FROM banned_medicines),
        f AS (SELECT k, lower(source) AS l, arg_min(source, id) AS s, min(id) AS o FROM b WHERE source IS NOT NULL GROUP BY ALL),
        j AS (SELECT k, string_agg(s, ', ' ORDER BY o) AS j FROM f GROUP BY 1)
        SELECT id, generic_name, j AS source FROM (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY k ORDER BY id) = 1) b LEFT JOIN j ON b.k IS NOT DISTINCT FROM j.k""",
    "ref_a3_counts": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in ("banned_medicines", "unofficial_medicines", "ayush_fssai_medicines", "notifications_processed")),
    "ref_a4_statistics": """
        SELECT b.n AS total_banned_medicines, (SELECT count(*) FROM unofficial_medicines) AS total_unofficial_medicines, (SELECT count(*) FROM ayush_fssai_medicines) AS total_ayush_fssai_medicines,
          (SELECT count(*) FROM documents) AS total_source_documents, p.n AS total_processed_notifications, d AS downloaded_notifications, g AS parsed_notifications, w AS pending_manual_reviews,
          f AS fdc_count, b.n - f AS single_ingredient_count
        FROM (SELECT count(*) AS n, count(*) FILTER (WHERE is_fdc) AS f FROM banned_medicines) b,
          (SELECT count(*) AS n, count(*) FILTER (WHERE download_status = 'downloaded') AS d, count(*) FILTER (WHERE parsing_status = 'parsed') AS g, count(*) FILTER (WHERE parsing_status = 'failed') AS w FROM notifications_processed) p""",
    "ref_a5_roadmap": f"""
        WITH o AS (SELECT {sql_number('notification_number')} AS number, notification_date AS date, source_url AS url, id FROM notifications_processed),
        k AS (SELECT number, date, url FROM o WHERE number IS NOT NULL QUALIFY row_number() OVER (PARTITION BY number ORDER BY id DESC) = 1),
        l AS (SELECT {sql_number('notification_number')} AS number, notification_date AS date, generic_name AS drug, source_pdf AS source, id FROM unofficial_medicines),
        d AS (SELECT number, arg_min(date, id) FILTER (WHERE date IS NOT NULL) AS d FROM l WHERE number IS NOT NULL GROUP BY 1),
        g AS (SELECT number, string_agg(drug, ' | ' ORDER BY o) AS drugs FROM (SELECT number, drug, min(id) AS o FROM l WHERE number IS NOT NULL AND drug IS NOT NULL GROUP BY ALL) GROUP BY 1),
        s AS (SELECT number, string_agg(source, ' | ' ORDER BY o) AS sources FROM (SELECT number, source, min(id) AS o FROM l WHERE number IS NOT NULL AND source IS NOT NULL GROUP BY ALL) GROUP BY 1)
        SELECT coalesce(k.number, d.number) AS number, coalesce(k.date, d) AS notification_date, coalesce(url, '') AS source_url, coalesce(drugs, '') AS drugs, coalesce(sources, '') AS sources
        FROM k FULL JOIN d ON k.number = d.number LEFT JOIN g ON coalesce(k.number, d.number) = g.number LEFT JOIN s ON coalesce(k.number, d.number) = s.number""",
    "ref_a8_first_url": f"SELECT {sql_number('notification_number')} AS number, arg_min(source_url, id) FILTER (WHERE source_url IS NOT NULL) AS source_url FROM banned_medicines GROUP BY 1 HAVING number IS NOT NULL AND source_url IS NOT NULL",
    "ref_a9_ordered_distinct": "SELECT url, epoch_us(min(fetched_at)) AS first_us, arg_min(doc_id, (fetched_at, doc_id)) AS doc_id FROM documents WHERE url IS NOT NULL GROUP BY 1",
    "ref_a10_last_known": f"SELECT {sql_number('notification_number')} AS number, {_sql_last('notification_date')} AS notification_date, {_sql_last('source_url')} AS source_url FROM banned_medicines GROUP BY 1",
    "ref_a11_junk_counts": "WITH y AS (" + " UNION ALL ".join(f"SELECT '{n}' AS table_name, {_LOW} AS x FROM {n}" for n in ("banned_medicines", "unofficial_medicines", "ayush_fssai_medicines"))
    + f"), j AS (SELECT table_name, coalesce({_JUNK}, true) AS junk FROM y) SELECT table_name, count(*) AS total, count(*) FILTER (WHERE junk) AS junk, count(*) FILTER (WHERE NOT junk) AS clean FROM j GROUP BY 1",
    "ref_a12_outcomes": "SELECT download_status, parsing_status, count(*) AS n, count(error_message) AS n_errors FROM notifications_processed GROUP BY ALL",
    "ref_j1_cross_reference": _sql_crossed("unofficial_medicines"),
    "ref_j2_cross_reference": _sql_crossed("ayush_fssai_medicines"),
    "ref_a6_link_summary": " UNION ALL ".join(f"SELECT '{a}' AS listing, count(*) AS total, count(*) FILTER (WHERE outcome = 'linked') AS linked, count(*) FILTER (WHERE outcome <> 'linked') AS unlinked FROM ({_sql_crossed(n)})" for n, a in _OUT.items()),
    "ref_j7_url_or_cache": f"""
        WITH c AS (SELECT {sql_number('notification_number')} AS number, arg_min(source_url, id) FILTER (WHERE source_url IS NOT NULL) AS cached FROM banned_medicines GROUP BY 1)
        SELECT id, coalesce(nullif(source_url, ''), cached) AS url FROM notifications_processed p LEFT JOIN c ON {sql_number('p.notification_number')} = c.number""",
    "ref_j9_without_download": f"""
        SELECT id, {sql_number('notification_number')} AS number FROM banned_medicines b WHERE NOT EXISTS (SELECT 1 FROM notifications_processed p WHERE download_status = 'downloaded'
          AND {sql_number('p.notification_number')} = {sql_number('b.notification_number')})""",
    "ref_m1_upsert": _M1,
    "ref_m2_notification_upsert": _M2,
    "ref_m3_review_queue": _M3,
    "ref_m5_set_status": "SELECT id, CASE WHEN id % 5 = 0 THEN 'reviewed' ELSE download_status END AS status, CASE WHEN id % 10 = 0 THEN 'seen' ELSE error_message END AS notes FROM notifications_processed",
    "ref_m6_delete_junk": f"WITH {_SQL_NAMES}, y AS (SELECT id, generic_name, {_LOW} AS x FROM n) SELECT id, generic_name FROM y WHERE NOT coalesce({_JUNK}, true)",
    "ref_m8_split_tables": "SELECT CASE WHEN coalesce(source_pdf LIKE '%medlist%', false) THEN 'moves' ELSE 'stays' END AS part, count(*) AS n FROM banned_medicines GROUP BY 1",
    "ref_m9_backfill": "SELECT id, coalesce(dosage_form, 'unknown') AS dosage_form, false AS is_fdc, '' AS source_url FROM unofficial_medicines",
    "ref_r1_route": f"""
        WITH s AS (SELECT id, CASE id % 4 WHEN 0 THEN 'https://www.ayush.example/x' WHEN 1 THEN 'TheHealthMaster, fssai' ELSE source_pdf END AS s FROM unofficial_medicines)
        SELECT id, CASE WHEN {_sql_any('s', lexicon.ROUTES[0][1])} THEN 'unofficial_medicines' WHEN {_sql_any('s', lexicon.ROUTES[1][1])} THEN 'ayush_fssai_medicines' END AS target FROM s""",
    "ref_r4_download_outcome": f"SELECT id, CASE WHEN source_url IS NULL THEN 'missing_pdf' WHEN {_sql_any('error_message', ['shorter than', 'not a pdf'])} THEN 'corrupted_pdf' WHEN error_message IS NOT NULL THEN 'download_failed' END AS issue_type FROM notifications_processed",
    "ref_o1_by_name": "SELECT id, generic_name FROM banned_medicines ORDER BY generic_name, id",
    "ref_o2_of_number": f"SELECT id, generic_name, {sql_number('notification_number')} AS number FROM banned_medicines WHERE number = 'G.S.R. 417(E)' ORDER BY generic_name, id",
    "ref_o5_latest_per_number": f"SELECT {sql_number('notification_number')} AS number, id FROM banned_medicines WHERE number IS NOT NULL QUALIFY row_number() OVER (PARTITION BY number ORDER BY last_updated DESC, id) = 1",
    "ref_o6_until_successes": """
        WITH c AS (SELECT id, download_status, coalesce(sum(CASE WHEN download_status = 'downloaded' THEN 1 ELSE 0 END) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM notifications_processed)
        SELECT id, download_status, CAST(b AS BIGINT) AS successes_before FROM c WHERE b < 50""",
    "ref_o9_first_lines": "SELECT doc_id, array_to_string(string_split(text, chr(10))[1:3], ' / ') AS head FROM documents",
    "ref_u1_union_all": " UNION ALL ".join(f"SELECT {i} AS source_ord, id, generic_name FROM {n}" for i, n in enumerate(("banned_medicines", "unofficial_medicines", "ayush_fssai_medicines"))),
    "ref_u3_same_sets": f"""
        SELECT id, list_sort(list_distinct(list_transform(string_split(generic_name, '+'), lambda x: {sql_strip('lower(x)')}))) = list_sort(list_distinct(list_transform(ingredients, lambda x: {sql_strip('lower(x)')}))) AS same
        FROM banned_medicines WHERE ingredients IS NOT NULL AND generic_name IS NOT NULL""",
    "ref_u4_difference": f"SELECT DISTINCT {sql_number('notification_number')} AS number FROM unofficial_medicines WHERE number IS NOT NULL EXCEPT SELECT {sql_number('notification_number')} FROM banned_medicines",
    "ref_k1_export": _sql_export(EXPORT_10, "unofficial_medicines"),
    "ref_k2_export": _sql_export(EXPORT_13, "banned_medicines"),
    "ref_k6_file_names": r"SELECT doc_id, substring(regexp_replace(regexp_replace(url, '[<>:\x22/\\|?*]', '_', 'g'), '\s+', '_', 'g'), 1, 200) || '.pdf' AS file_name FROM documents WHERE url IS NOT NULL",
}
SQL["ref_r2_validity"] = f"SELECT is_valid, count(*) AS n, CAST(sum(CASE WHEN errors = '' THEN 0 ELSE len(string_split(errors, ' ; ')) END) AS BIGINT) AS n_errors FROM ({SQL['ref_p4_validate']}) GROUP BY 1"
SQL |= {
    "ref_p2_document_filter": f"SELECT doc_id, len(list_filter(string_split(text, chr(10) || chr(10))[1:3], lambda p: {_sql_any('p', ['tablet', 'recall', 'batch', 'licence'])})) > 0 AS is_drug_document FROM documents WHERE text IS NOT NULL",
    "ref_p8_delete_ids": "SELECT id, generic_name FROM unofficial_medicines WHERE NOT coalesce(length(generic_name) > 60, false)",
    "ref_f13_record": """
        SELECT generic_name, array_to_string(brand_names, ', ') AS brand_names, dosage_form, strength, notification_number, notification_date, ban_reason, source_pdf, array_to_string(ingredients, ', ') AS ingredients, source_url
        FROM banned_medicines""",
    "ref_k3_backup": "SELECT CAST(to_json({'id': id, 'notification_number': notification_number, 'notification_date': notification_date, 'download_status': download_status}) AS VARCHAR) AS line FROM notifications_processed",
    "ref_j8_only_combinations": f"""
        WITH o AS (SELECT DISTINCT {sql_number('notification_number')} AS number, {_LOW} AS name FROM banned_medicines), l AS (SELECT {sql_number('notification_number')} AS number, {_LOW} AS name FROM unofficial_medicines)
        SELECT number, name FROM o WHERE contains(name, '+') AND number IS NOT NULL AND NOT EXISTS (SELECT 1 FROM l WHERE l.number = o.number AND l.name = o.name)""",
    "ref_a7_grouped": f"""
        SELECT number, string_agg(generic_name, ' | ' ORDER BY o) AS names FROM (SELECT {sql_number('notification_number')} AS number, generic_name, min(id) AS o FROM ayush_fssai_medicines WHERE generic_name IS NOT NULL GROUP BY ALL)
        WHERE number IS NOT NULL GROUP BY 1""",
    "ref_m4_source_documents": f"""
        WITH r AS (SELECT id, source_pdf AS file_name, source_url, notification_date FROM banned_medicines WHERE source_pdf IS NOT NULL),
        t AS (SELECT * FROM r WHERE id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY id) = 1),
        s AS (SELECT file_name, {_sql_last('source_url')} AS source_url, {_sql_last('notification_date')} AS notification_date FROM r WHERE id % 2 = 1 GROUP BY 1)
        SELECT coalesce(t.file_name, s.file_name) AS file_name, coalesce(s.source_url, t.source_url) AS source_url, coalesce(s.notification_date, t.notification_date) AS notification_date,
          CASE WHEN t.file_name IS NULL THEN 'inserted' WHEN s.file_name IS NOT NULL THEN 'updated' ELSE 'kept' END AS outcome FROM t FULL JOIN s ON t.file_name = s.file_name""",
    "ref_m12_health": "SELECT 1 AS one",
    "ref_o3_by_id": "SELECT id, generic_name FROM ayush_fssai_medicines ORDER BY id",
    "ref_o4_sorted_numbers": f"SELECT DISTINCT {sql_number('notification_number')} AS number FROM notifications_processed WHERE number IS NOT NULL ORDER BY 1",
    "ref_o7_processed_first": "SELECT id FROM notifications_processed WHERE pdf_path IS NOT NULL ORDER BY id LIMIT 25",
    "ref_o8_first": "SELECT arg_min(generic_name, id) AS name, min(id) AS id FROM unofficial_medicines WHERE dosage_form = 'Tablet'",
    "ref_u2_distinct": "SELECT DISTINCT source, lang FROM documents",
    "ref_c6_pending": "SELECT id, notification_number, download_status FROM notifications_processed WHERE parsing_status = 'pending'",
}
