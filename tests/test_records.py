import datetime as dt

import pytest
from pyspark.sql import functions as F

from medloom.operators import dedup, extract, links, merge, validate, xref
from medloom.plans import curation
from medloom.queries import records
from medloom.sources import files
from medloom.sources.html import pages, read_page

NOTICE = """MINISTRY OF HEALTH
G.S.R. 578(E) dated 10/09/2018. On the basis of the recommendation of the board it is held that there is no justification for such Fixed Dose Combinations. Now

1. Aceclofenac + Paracetamol (Tablet) 100mg/500mg
2. Dextropropoxyphene Injection
3. Nimesulide + Cetirizine tablet
"""


def test_html_tree():
    page = read_page('<table><tr><td> a <b>b</b></td><td>c<script>x</script></td></tr></table><ul><li>one<li>two</ul><a href="x.pdf" title=" t ">L</a><a>no</a>')
    assert page["rows"] == [{"table": 0, "row": 0, "cells": ["ab", "c"]}]
    assert [i["text"] for i in page["items"]] == ["onetwo", "two"]
    assert [(x["href"], x["text"], x["title"]) for x in page["links"]] == [("x.pdf", "L", "t")]
    assert read_page(None) == {"rows": [], "items": [], "links": []}


def test_table_source(spark):
    html = "<table><tr><th>Sr</th><th>Drugs Name</th><th>No</th></tr><tr><td>1</td><td>Amidopyrine.</td><td>GSR NO. 578(E) Dated 23.07.1983</td></tr><tr><td>2</td><td></td><td>x</td></tr></table>"
    rows = pages(spark.createDataFrame([("u", html), ("v", None)], "url string, html string"), F.col("html"))
    got = links.table_entries(rows, True, ["drugs name"]).collect()
    assert [(r["generic_name"], r["number"], r["date"]) for r in got] == [("Amidopyrine", "G.S.R. 578(E)", dt.date(1983, 7, 23))]


def test_entries_of_a_notice(spark):
    rows = extract.entries(spark.createDataFrame([(1, NOTICE), (2, ""), (3, None), (4, "Phenformin was found unsafe in all trials; nothing else")], "doc_id long, text string"))
    got = {(r["doc_id"], r["pos"]): r for r in rows.collect()}
    assert [(got[1, i]["generic_name"], got[1, i]["dosage_form"], got[1, i]["strength"]) for i in range(3)] == [("Aceclofenac + Paracetamol", "Tablet", "100mg/500mg"), ("Dextropropoxyphene", "Injection", None), ("Nimesulide + Cetirizine", "Tablet", None)]
    assert got[1, 0]["notification_number"] == "G.S.R. 578(E)" and got[1, 0]["notification_date"] == dt.date(2018, 9, 10) and got[1, 0]["ban_reason"].startswith("basis of the recommendation")
    assert got[2, 0]["generic_name"] == extract.NO_ENTRIES and got[3, 0]["generic_name"] == extract.UNREADABLE
    assert got[4, 0]["generic_name"] == "Phenformin" and got[4, 0]["parsing_status"] == "needs_review"
    assert {r["doc_id"]: r["route"] for r in extract.routed_entries(rows).collect()} == {1: "keep", 2: "failed", 3: "failed", 4: "review"}


@pytest.mark.parametrize("name", ["", "   ", None, "January", "Total Queries", "Fact Check", "Till", "Labour Department", "Login", "nchmr.com", "http://example.com/drug", "AB", "12345", "Who Is Who", "Blood Bank Licence", "January (72)"])
def test_invalid_names(spark, name):
    rows = spark.createDataFrame([(name, None, None, None)], "generic_name string, dosage_form string, notification_number string, notification_date date")
    assert not validate.validated(rows, F.lit("2024-01-01").cast("date")).first()["is_valid"]


def test_valid_names_and_warnings(spark):
    rows = spark.createDataFrame([("Paracetamol", "Nebulizer", "XYZ-999", dt.date(2020, 1, 1)), ("Amoxicillin 500mg + Clavulanic Acid 125mg", "Tablets", "GSR 1", dt.date(2030, 1, 1))], "generic_name string, dosage_form string, notification_number string, notification_date date")
    a, b = validate.validated(rows, F.lit("2024-01-01").cast("date")).collect()
    assert a["is_valid"] and len(a["warnings"]) == 2
    assert not b["is_valid"] and b["errors"] == ["notification_date is in the future: 2030-01-01"] and not b["warnings"]


def test_deduplication_keeps_first_and_all_sources(spark):
    rows = spark.createDataFrame([(1, "Drug A", "x.in"), (2, " drug a", "y.in"), (3, "Drug A", "X.in"), (4, None, "z.in"), (5, None, None)], "seq long, name string, source string")
    got = {r["name"]: (r["seq"], r["source"]) for r in dedup.deduplicated(rows, "name", "source", "seq").collect()}
    assert got == {"Drug A": (1, "x.in, y.in"), None: (4, "z.in")}


def test_upsert_folds_the_batch_and_is_idempotent(spark):
    kind = "id long, generic_name string, dosage_form string, strength string, notification_number string, ban_reason string, is_fdc boolean, date_added timestamp, last_updated timestamp"
    t0 = dt.datetime(2020, 1, 1)
    target = spark.createDataFrame([(1, "A", None, None, None, "old", True, t0, t0)], kind)
    batch = spark.createDataFrame([("A", None, None, None, None, False, 1), ("B", "T", None, "n", "x", None, 2), ("B", "T", None, "n", None, True, 3)], "generic_name string, dosage_form string, strength string, notification_number string, ban_reason string, is_fdc boolean, seq int")
    now = F.lit("2021-01-01").cast("timestamp")
    once = merge.upsert(target, batch, merge.MEDICINE_KEY, ["ban_reason", "is_fdc"], "seq", now, {"is_fdc": F.lit(False)})
    got = {r["generic_name"]: (r["ban_reason"], r["is_fdc"], r["outcome"]) for r in once.collect()}
    assert got == {"A": ("old", False, "updated"), "B": ("x", True, "inserted")}
    again = merge.upsert(once.drop("outcome"), batch, merge.MEDICINE_KEY, ["ban_reason", "is_fdc"], "seq", now)
    assert sorted((r["id"], r["generic_name"], r["ban_reason"], r["is_fdc"]) for r in again.collect()) == sorted((r["id"], r["generic_name"], r["ban_reason"], r["is_fdc"]) for r in once.collect())


def test_review_queue(spark):
    cols = "id long, notification_number string, issue_type string, description string, raw_text string, notification_date date, source_url string, status string, date_added timestamp, last_updated timestamp"
    t0 = dt.datetime(2020, 1, 1)
    queue = spark.createDataFrame([(1, None, "t", "first", None, dt.date(2001, 1, 1), "u", "pending", t0, t0), (2, "n", "t", "done", None, None, None, "resolved", t0, t0)], cols)
    items = spark.createDataFrame([(None, "t", "second", "", None, "v", 1), (None, "t", "", "raw", None, "w", 2), ("n", "t", "new", None, None, None, 3)], "notification_number string, issue_type string, description string, raw_text string, notification_date date, source_url string, seq int")
    got = sorted((str(r["notification_number"]), r["status"], r["description"], r["raw_text"], r["source_url"]) for r in merge.queue_reviews(queue, items, "seq", F.lit("2021-01-01").cast("timestamp")).collect())
    assert got == [("None", "pending", "second", "raw", "u"), ("n", "pending", "new", None, None), ("n", "resolved", "done", None, None)]


def test_cross_reference(spark):
    official = spark.createDataFrame([("Paracetamol + Ibuprofen", ["Paracetamol", "Ibuprofen"], "G.S.R. 1(E)"), ("Solo", [], "G.S.R. 2(E)")], "generic_name string, ingredients array<string>, notification_number string")
    listing = spark.createDataFrame([(1, "ibuprofen + Paracetamol", "G.S.R. 1 (E)"), (2, "Paracetamol and Ibuprofen", "G.S.R. 1(E)"), (3, "SOLO ", "G.S.R. 2(E)"), (4, "x", ""), (5, "x", None), (6, "x", "G.S.R. 9(E)"), (7, None, "G.S.R. 2(E)")], "id long, generic_name string, notification_number string")
    got = {r["id"]: r["outcome"] for r in xref.cross_referenced(listing, official).collect()}
    assert got == {1: "linked", 2: "no_match", 3: "linked", 4: "missing_number", 5: "missing_number", 6: "number_not_found", 7: "no_match"}


def test_snapshots(spark, tmp_path):
    store = merge.Snapshots(spark, f"file://{tmp_path}/t")
    assert store.read() is None
    store.write(spark.range(3))
    store.write(store.read().filter("id > 0"))
    assert sorted(r[0] for r in store.read().collect()) == [1, 2]


def test_streaming_upserts(spark, tmp_path):
    from medloom.streaming.upserts import upsert_stream

    kind = "generic_name string, dosage_form string, strength string, notification_number string, ban_reason string, seq int"
    folder = f"{tmp_path}/in"
    spark.createDataFrame([("A", None, None, None, "x", 1), ("A", None, None, None, None, 2)], kind).write.parquet(folder)
    store = merge.Snapshots(spark, f"file://{tmp_path}/t")
    empty = spark.createDataFrame([], "id long, generic_name string, dosage_form string, strength string, notification_number string, ban_reason string, date_added timestamp, last_updated timestamp")
    run = lambda: upsert_stream(spark.readStream.schema(kind).parquet(folder), store, empty, merge.MEDICINE_KEY, ["ban_reason"], "seq", f"{tmp_path}/c").awaitTermination()
    run()
    spark.createDataFrame([("A", None, None, None, "y", 1), ("B", None, None, None, None, 2)], kind).write.mode("append").parquet(folder)
    run()
    assert sorted((r["generic_name"], r["ban_reason"]) for r in store.read().collect()) == [("A", "y"), ("B", None)]


def test_exports_and_json(spark, tmp_path):
    rows = spark.createDataFrame([(2, ["a", "b"], True, None), (1, None, False, "x, \"y\"")], "id long, brand_names array<string>, is_fdc boolean, ban_reason string")
    got = {r["id"]: (r["brand_names"], r["is_fdc"], r["ban_reason"], r["strength"]) for r in files.export_rows(rows, ["id", "brand_names", "is_fdc", "ban_reason", "strength"]).collect()}
    assert got == {"2": ("a, b", "True", "", ""), "1": ("", "False", 'x, "y"', "")}
    files.write_csv(rows, f"{tmp_path}/csv", ["id", "ban_reason"], one_file=True)
    assert sum(1 for p in (tmp_path / "csv").glob("*.csv")) == 1
    files.backup(rows, f"{tmp_path}/json")
    assert spark.read.json(f"{tmp_path}/json").count() == 2
    (tmp_path / "r.json").write_text('[{"a": 1, "b": "x"}, {"a": 2, "b": null}]')
    assert files.read_json_array(spark, f"{tmp_path}/r.json", "a int, b string").count() == 2
    assert files.read_json_array(spark, f"{tmp_path}/none.json", "a int, b string").count() == 0


def test_pdf_magic(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "b.pdf").write_bytes(b"<html>")
    assert sorted((r["path"][-5:], r["is_pdf"]) for r in files.read_pdfs(spark, str(tmp_path)).collect()) == [("a.pdf", True), ("b.pdf", False)]


def test_notice_pipeline(spark):
    made = curation.process_notices(spark.createDataFrame([(1, NOTICE, "u"), (2, None, "v"), (3, "", None)], "doc_id long, text string, source_url string"), F.lit("2024-01-01").cast("date"))
    assert sorted(r["generic_name"] for r in made.medicines.collect()) == ["Aceclofenac + Paracetamol", "Dextropropoxyphene", "Nimesulide + Cetirizine"]
    assert {r["doc_id"]: r["parsing_status"] for r in made.status.collect()} == {1: "parsed", 2: "failed", 3: "failed"}
    assert {r["issue_type"] for r in made.reviews.collect()} == {"scanned_pdf"}


def test_listing_pipeline(spark):
    rows = spark.createDataFrame([(1, " drug  A", "tabs", "5mg", "GSR 1", None, "vaayath.com"), (2, "Drug a", None, None, None, None, "ayush.gov.in"), (3, "Herb x", None, None, None, None, "fssai.gov.in"), (4, "Login", None, None, None, None, "vaayath.com"), (5, "Other", None, None, None, None, "else.org")], "seq long, generic_name string, dosage_form string, strength string, notification_number string, notification_date date, source string")
    got = curation.route_listings(rows, F.lit("2024-01-01").cast("date"))
    assert [(r["generic_name"], r["source"]) for r in got["unofficial_medicines"].collect()] == [("Drug A", "vaayath.com, ayush.gov.in")]
    assert [r["generic_name"] for r in got["ayush_fssai_medicines"].collect()] == ["Herb X"]


def test_upsert_query_takes_all_rows(spark, data):
    values = ["notification_date", "ban_reason", "source_pdf"]
    last, even = {}, set()
    for r in sorted(spark.read.parquet(f"{data}/banned_medicines.parquet").collect(), key=lambda r: r["id"]):
        key = tuple(r[k] for k in merge.MEDICINE_KEY)
        if r["id"] % 2 == 0:
            even.add(key)
        row = last.setdefault(key, dict.fromkeys(values))
        row.update({v: r[v] for v in values if r[v] is not None})
    rows = records.QUERIES["ref_m1_upsert"](spark, data).collect()
    got = {tuple(r[k] for k in merge.MEDICINE_KEY): ({v: r[v] for v in values}, r["outcome"]) for r in rows}
    assert got == {k: (x, "updated" if k in even else "inserted") for k, x in last.items()} and len(rows) == len(last)
