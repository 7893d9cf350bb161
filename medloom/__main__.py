"""Command line over a folder of curated tables.

    python -m medloom --tables DIR create
    python -m medloom --tables DIR discover --links PARQUET         numbered links (number, date, target, seq) and listed numbers into the road map
    python -m medloom --tables DIR acquire [--limit N] [--force]    what of the road map has to be fetched, into notifications_processed
    python -m medloom --tables DIR update --links PARQUET --documents PARQUET [--limit N]    discover, acquire, process, cross-reference
    python -m medloom --tables DIR process --documents PARQUET      documents (doc_id, text, source_url) into official records and reviews
    python -m medloom --tables DIR listings --entries PARQUET       listing entries (generic_name, source, seq, ...) into their tables
    python -m medloom --tables DIR cross-reference                  review items for listing rows without official record
    python -m medloom --tables DIR nuke --yes [--table NAME ...]    the tables without their rows
    python -m medloom --tables DIR statistics | cleanup [--apply] | export --out DIR | backup --out DIR

--dry-run shows what a stage would write and writes nothing. Fetching pages is left to other tools: they hand over
HTML or text as tables.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom import schemas
from medloom.operators import dedup, merge, validate
from medloom.plans import curation
from medloom.sources import files

LISTINGS = ("unofficial_medicines", "ayush_fssai_medicines")
MEDICINES = ("banned_medicines", *LISTINGS)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser("medloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--tables", required=True)
    parser.add_argument("--dry-run", action="store_true")
    stages = parser.add_subparsers(dest="stage", required=True)
    stages.add_parser("create")
    for name, wanted in (("discover", ["links"]), ("acquire", []), ("update", ["links", "documents"]), ("process", ["documents"])):
        stage = stages.add_parser(name)
        for w in wanted:
            stage.add_argument(f"--{w}", required=True)
        if name in ("acquire", "update"):
            stage.add_argument("--limit", type=int)
            stage.add_argument("--force", action="store_true")
    nuke = stages.add_parser("nuke")
    nuke.add_argument("--yes", action="store_true", required=True)
    nuke.add_argument("--table", action="append", choices=list(schemas.TABLES))
    stages.add_parser("listings").add_argument("--entries", required=True)
    stages.add_parser("cross-reference")
    stages.add_parser("statistics")
    stages.add_parser("cleanup").add_argument("--apply", action="store_true")
    for name in ("export", "backup"):
        stages.add_parser(name).add_argument("--out", required=True)
    return parser


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName("medloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    now, today = F.current_timestamp(), F.current_date()
    read = lambda name: schemas.current(spark, args.tables, name)

    def write(name: str, rows: DataFrame) -> None:
        if args.dry_run:
            print(name, rows.count())
        else:
            schemas.store(spark, args.tables, name).write(rows)

    def review(items: DataFrame) -> None:
        write("manual_review_queue", merge.queue_reviews(read("manual_review_queue"), items.withColumn("seq", F.monotonically_increasing_id()), "seq", now))

    roadmap = f"{args.tables.rstrip('/')}/roadmap"
    stages = ["discover", "acquire", "process", "cross-reference"] if args.stage == "update" else [args.stage]
    if "discover" in stages:
        listed = None
        for i, name in enumerate(LISTINGS):
            part = read(name).select(F.col("notification_number").alias("number"), F.col("notification_date").alias("date"), F.col("generic_name").alias("drug"), F.col("source_pdf").alias("source"), F.struct(F.lit(i), F.col("id")).alias("seq"))
            listed = part if listed is None else listed.unionByName(part)
        found = curation.discover(spark.read.parquet(args.links), listed)
        if args.dry_run:
            print("roadmap", found.count())
        else:
            found.write.mode("overwrite").parquet(roadmap)
    if "acquire" in stages:
        known = read("notifications_processed")
        cache = known.filter("source_url is not null").groupBy(F.col("notification_number").alias("number")).agg(F.min_by("source_url", "id").alias("target"))
        wanted = curation.acquire(spark.read.parquet(roadmap), cache).select(F.col("number").alias("notification_number"), "notification_date", F.col("url").alias("source_url"), "download_status")
        held = known.select("notification_number", F.col("download_status").alias("held"), "pdf_path").join(wanted, "notification_number", "right")
        rows = merge.to_fetch(held.withColumn("download_status", F.coalesce("held", "download_status")), F.col("pdf_path").isNotNull(), args.force)
        rows = wanted.join(rows.select("notification_number"), "notification_number", "left_semi")
        if args.limit is not None:
            rows = rows.orderBy("notification_number").limit(args.limit)
        made = merge.upsert(known, rows.withColumn("seq", F.col("notification_number")), ["notification_number"], ["notification_date", "source_url", "download_status"], "seq", now).drop("outcome")
        write("notifications_processed", made.unionByName(schemas.empty(spark, "notifications_processed"), allowMissingColumns=True))
    if args.stage == "create":
        schemas.create_tables(spark, args.tables)
    if "process" in stages:
        made = curation.process_notices(spark.read.parquet(args.documents), today)
        rows = made.medicines.withColumn("seq", F.struct("doc_id", "pos"))
        write("banned_medicines", curation.upsert_medicines(read("banned_medicines"), rows, "seq", now).drop("outcome").unionByName(schemas.empty(spark, "banned_medicines"), allowMissingColumns=True))
        review(made.reviews)
    if args.stage == "listings":
        for name, rows in curation.route_listings(spark.read.parquet(args.entries), today).items():
            write(name, curation.upsert_medicines(read(name), rows, "seq", now, listing=True).drop("outcome").unionByName(schemas.empty(spark, name), allowMissingColumns=True))
    if "cross-reference" in stages:
        items, summary = curation.cross_reference(read("banned_medicines"), {n: read(n) for n in LISTINGS})
        review(items.drop("id"))
        summary.show()
    if args.stage == "nuke":
        names = args.table or list(schemas.TABLES)
        held = {n: read(n).count() for n in names} if args.dry_run else schemas.truncate(spark, args.tables, names)
        for name, n in held.items():
            print(name, n)
    elif args.stage == "statistics":
        named = [read(n) for n in ("banned_medicines", *LISTINGS, "source_documents", "notifications_processed", "manual_review_queue")]
        for name, n in dedup.statistics(*named).first().asDict().items():
            print(name, n)
    elif args.stage == "cleanup":
        for name in MEDICINES:
            junk = validate.is_junk(F.col("generic_name"))
            print(name, read(name).filter(junk).count())
            if args.apply and not args.dry_run:
                write(name, merge.without(read(name), junk))
    elif args.stage == "export":
        for name in MEDICINES:
            files.write_csv(read(name), f"{args.out}/{name}", files.EXPORT_13 if name == "banned_medicines" else files.EXPORT_10)
    elif args.stage == "backup":
        for name in schemas.TABLES:
            files.backup(read(name), f"{args.out}/{name}")


if __name__ == "__main__":
    main()
