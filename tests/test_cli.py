from medloom import schemas
from medloom.__main__ import main


def test_stages_end_to_end(spark, tmp_path, capsys):
    tables = f"file://{tmp_path}/tables"
    run = lambda *a: main(["--tables", tables, *a], spark)
    run("create")
    text = "G.S.R. 5(E) dated 10/09/2018\n1. Alphadoxin + Bexaril Tablet 5mg\n2. Corvadine\n3. Login\n"
    spark.createDataFrame([(1, text, "u"), (2, None, "v")], "doc_id long, text string, source_url string").write.parquet(f"{tmp_path}/docs")
    entries = [("alphadoxin + bexaril", "vaayath.example", 1, "G.S.R. 5(E)"), ("Herb", "ayush.example", 2, None), ("Corvadine", "vaayath.example", 3, "G.S.R. 9(E)")]
    kind = "generic_name string, source string, seq long, notification_number string"
    rows = spark.createDataFrame(entries, kind)
    for c, t in (("dosage_form", "string"), ("strength", "string"), ("notification_date", "date"), ("brand_names", "array<string>")):
        rows = rows.selectExpr("*", f"cast(null as {t}) as {c}")
    rows.write.parquet(f"{tmp_path}/entries")
    for _ in range(2):  # again changes nothing but times
        run("process", "--documents", f"{tmp_path}/docs")
        run("listings", "--entries", f"{tmp_path}/entries")
        run("cross-reference")
    read = lambda n: schemas.current(spark, tables, n)
    assert sorted(r["generic_name"] for r in read("banned_medicines").collect()) == ["Alphadoxin + Bexaril", "Corvadine"]
    assert len({r["id"] for r in read("banned_medicines").collect()}) == 2
    assert [r["generic_name"] for r in read("ayush_fssai_medicines").collect()] == ["Herb"]
    kinds = sorted(r["issue_type"] for r in read("manual_review_queue").collect())
    assert kinds == ["missing_notification_number", "scanned_pdf", "unlinked_record", "validation_failed"]
    run("cleanup", "--apply")
    run("statistics")
    assert "total_banned_medicines 2" in capsys.readouterr().out
    run("export", "--out", f"{tmp_path}/csv")
    run("backup", "--out", f"{tmp_path}/json")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv/banned_medicines").count() == 2
    assert schemas.truncate(spark, tables, ["unofficial_medicines"]) == {"unofficial_medicines": 2} and read("unofficial_medicines").count() == 0
    schemas.drop_tables(spark, tables)
    assert not list((tmp_path / "tables").glob("*"))


def test_update_limit_and_nuke(spark, tmp_path, capsys):
    tables = f"file://{tmp_path}/tables"
    run = lambda *a: main(["--tables", tables, *a], spark)
    run("create")
    links = [("G.S.R. 5(E)", "2018-09-10", "https://x.example/5.pdf", 1), ("G.S.R. 7(E)", None, "https://x.example/7.pdf", 2), ("S.O. 9(E)", None, None, 3)]
    spark.createDataFrame(links, "number string, date string, target string, seq long").selectExpr("number", "cast(date as date) as date", "target", "seq").write.parquet(f"{tmp_path}/links")
    spark.createDataFrame([(1, "G.S.R. 5(E) dated 10/09/2018\n1. Alphadoxin Tablet 5mg\n", "u")], "doc_id long, text string, source_url string").write.parquet(f"{tmp_path}/docs")
    read = lambda n: {r["notification_number"]: r.asDict().get("download_status") for r in schemas.current(spark, tables, n).collect()}
    run("discover", "--links", f"{tmp_path}/links")
    run("acquire", "--limit", "1")
    assert read("notifications_processed") == {"G.S.R. 5(E)": "pending"}
    for _ in range(2):
        run("update", "--links", f"{tmp_path}/links", "--documents", f"{tmp_path}/docs")
    assert read("notifications_processed") == {"G.S.R. 5(E)": "pending", "G.S.R. 7(E)": "pending", "S.O. 9(E)": "missing"}
    assert set(read("banned_medicines")) == {"G.S.R. 5(E)"}
    run("--dry-run", "nuke", "--yes")
    assert len(read("banned_medicines")) == 1
    run("nuke", "--yes")
    assert "banned_medicines 1" in capsys.readouterr().out and not read("banned_medicines") and not read("notifications_processed")
