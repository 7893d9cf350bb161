"""Packed fields, units and orphan references: edge cases, skew, and brute force over whole test tables."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from medloom import scale
from medloom.operators import multivalue, orphans, units

# ---- packed fields


PACKED = (
    [
        ("A + B", ["A", "B"]), ("A,B;C|D/E&F", ["A", "B", "C", "D", "E", "F"]), ("A, B and C", ["A", "B", "C"]), ("A, B, AND C.", ["A", "B", "C"]), ("A with B plus C", ["A", "B", "C"]),
        ('"Oxide, heavy" + B', ["Oxide, heavy", "B"]), ("“Oxide, heavy” & B", ["Oxide, heavy", "B"]), ("'Oxide, heavy', B", ["Oxide, heavy", "B"]), ('"A","B"', ["A", "B"]),
        ("A (x/y) + B", ["A (x/y)", "B"]), ("A [x, (y; z)] ; B", ["A [x, (y; z)]", "B"]), ("A\tB\nC", ["A", "B", "C"]), ("A and B", ["A", "B"]), ("A , , B,", ["A", "B"]), ("; A;; B", ["A", "B"]),
        ("A ＋ B", ["A", "B"]), ("A  b c + D", ["A b c", "D"]), ("child's drops, B", ["child's drops", "B"]), ("A (x + B", ["A (x", "B"]), ("X-Plus, Y", ["X-Plus", "Y"]),
        ("A", None), ("A (x/y)", None), ('"Oxide, heavy"', None), ("Brand-Plus", None), ("and", None), ("A and", None), ("", None), ("  ", None), (None, None), ("+", None), ("A +", None), (". , .", None),
    ]
)


def test_packed_text(spark):
    rows = spark.createDataFrame([(i, g) for i, (g, _) in enumerate(PACKED)], "id long, f string")
    got = collections.defaultdict(list)
    for r in multivalue.split_fields(rows, "id", ["f"]).orderBy("id", "pos").collect():
        assert r["pos"] == len(got[r["id"]])
        got[r["id"]].append(r["val"])
    assert [(g, got.get(i)) for i, (g, _) in enumerate(PACKED)] == PACKED


def test_packed_arrays(spark):
    rows = spark.createDataFrame(
        [(1, ["A", "B + C", None, "", "D"], "x", "e"), (2, ["A", "B"], "x", "e"), (3, [], "x", "e"), (4, None, "a;b", "e"), (4, None, "a;b", "e"), (5, [None], None, "e")], "id long, l array<string>, f string, pos string"
    )
    got = collections.Counter((r["id"], r["field_name"], r["pos"], r["val"]) for r in multivalue.split_fields(rows, "id", ["l", "f"]).collect())
    assert got == {(1, "l", 0, "A"): 1, (1, "l", 1, "B"): 1, (1, "l", 2, "C"): 1, (1, "l", 3, "D"): 1, (4, "f", 0, "a"): 2, (4, "f", 1, "b"): 2}


def test_packed_long_text_and_empty_table(spark):
    long_ = " + ".join(f"name {i}" for i in range(5_000))
    assert multivalue.split_fields(spark.createDataFrame([(1, long_)], "id long, f string"), "id", ["f"]).count() == 5_000
    assert multivalue.split_fields(spark.createDataFrame([], "id long, f string, l array<string>"), "id", ["f", "l"]).count() == 0


def test_packed_without_broadcast(spark):
    rows = spark.createDataFrame([(i, "a + b" if i % 3 else "a; b, c") for i in range(300)], "id long, f string")
    assert sorted(multivalue.split_fields(rows, "id", ["f"], limit=0).collect()) == sorted(multivalue.split_fields(rows, "id", ["f"]).collect())


# ---- units


STRENGTHS = (
    [
        ("500 mg", None, [(500_000, "mcg")]), ("0,5 mg", None, [(500, "mcg")]), ("1,000 mg", None, [(1_000_000, "mcg")]), (".5 g", None, [(500_000, "mcg")]), ("25-Mg", None, [(25_000, "mcg")]),
        ("mg 1,000", None, [(1_000_000, "mcg")]), ("500/20/75 mg", None, [(500_000, "mcg"), (20_000, "mcg"), (75_000, "mcg")]), ("100mg, 0.5 g", None, [(100_000, "mcg"), (500_000, "mcg")]),
        ("5 mg/5 ml", None, [(1_000, "mcg/ml")]), ("mg 500per 10millilitre", None, [(50_000, "mcg/ml")]), ("2 g in 100mL", None, [(20_000, "mcg/ml")]), ("5000mg/ltr", None, [(5_000, "mcg/ml")]),
        ("250 mg/kg", None, [(250, "mcg/g")]), ("5 mg per gram", None, [(5_000, "mcg/g")]), ("5 ppm", None, [(5, "mcg/g")]), ("5 parts per million", None, [(5, "mcg/g")]),
        ("0.1 %", None, [(1_000, "mcg/ml")]), ("2 % (w/w)", None, [(20_000, "mcg/g")]), ("2 percent w/v", None, [(20_000, "mcg/ml")]), ("2% v/v", None, []),
        ("1 lakh IU", None, [(100_000, "iu")]), ("1.5 million I.U.", None, [(1_500_000, "iu")]), ("1MIU", None, [(1_000_000, "iu")]), ("40 units per ml", None, [(40, "iu/ml")]), ("400I.U.", None, [(400, "iu")]),
        ("10 µg", None, [(10, "mcg")]), ("10 μg", None, [(10, "mcg")]), ("50", "(strength given in mg) x", [(50_000, "mcg")]), ("2.", "Amounts stated in grams throughout.", [(2_000_000, "mcg")]),
        ("20", "[unit: µg] G.S.R. 5(E)", [(20, "mcg")]), ("50", "no word of it", []), ("50", None, []), ("as directed", "mg", []), ("", "mg", []), (None, "mg", []), ("?", None, []),
        ("10 mg/20 mg", None, [(10_000, "mcg"), (20_000, "mcg")]), ("5 mg/0 ml", None, []),
    ]
)


def test_quantities(spark):
    rows = spark.createDataFrame([(i, s, r, "x") for i, (s, r, _) in enumerate(STRENGTHS)], "id long, strength string, reason string, unit string")
    got = collections.defaultdict(list)
    for r in units.quantities(rows, ["id"], F.col("strength"), F.col("reason")).orderBy("id", "pos").collect():
        assert r["pos"] == len(got[r["id"]])
        got[r["id"]].append((r["amount"], r["unit"]))
    assert [(*x[:2], got.get(i, [])) for i, x in enumerate(STRENGTHS)] == STRENGTHS


def test_quantities_default_repeats_and_empty(spark):
    rows = spark.createDataFrame([(1, "5", None), (1, "5", None)], "id long, strength string, reason string")
    assert [(r["amount"], r["unit"]) for r in units.quantities(rows, ["id"], F.col("strength"), F.col("reason"), F.lit("mg")).collect()] == [(5_000, "mcg")] * 2
    assert units.quantities(rows.limit(0), ["id"], F.col("strength"), F.col("reason")).count() == 0
    long_ = spark.createDataFrame([(1, " + ".join(["5 mg"] * 3_000), None)], "id long, strength string, reason string")
    assert units.quantities(long_, ["id"], F.col("strength"), F.col("reason")).count() == 3_000


# ---- orphan references


def refs(spark, rows):
    return spark.createDataFrame(rows, "table_name string, id long, key string, time long, period_ym string, since string")


def test_orphan_states(spark):
    parents = spark.createDataFrame([("a", 10, True), ("a", 5, True), ("b", None, False), ("c", None, True), ("d", 1, True), ("d", None, False), (None, 1, True)], "key string, since long, live boolean")
    asked = [("t", 1, "a", 7, "p", ""), ("t", 2, "a", 4, "p", ""), ("t", 3, "b", 1, "p", ""), ("t", 4, "zz", 1, None, ""), ("t", 5, "c", 1, "p", ""), ("t", 6, None, 1, "p", ""), ("u", 1, "a", None, "p", ""), ("t", 7, "d", 9, "p", ""), ("t", 8, "", 1, "p", ""), ("t", 3, "b", 1, "p", "")]
    got = collections.Counter((r[0], r[1], r[3]) for r in orphans.orphans(refs(spark, asked), parents).collect())
    assert got == {("t", 2, "late"): 1, ("t", 3, "deleted"): 2, ("t", 4, "missing"): 1, ("t", 8, "missing"): 1}


def test_orphans_empty_sides(spark):
    parents = spark.createDataFrame([], "key string, since long, live boolean")
    assert [r["orphan_state"] for r in orphans.orphans(refs(spark, [("t", 1, "a", 1, "p", "")]), parents).collect()] == ["missing"]
    assert orphans.orphans(refs(spark, []), parents).count() == 0


def test_orphans_with_a_hot_key_and_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(orphans, "RANGE_KEYS", 16)
    parents = [(f"k{i:04d}", i, i % 3 > 0) for i in range(0, 400, 2)]
    asked = [("t", i, "k0100" if i % 3 == 0 else f"k{(i * 7) % 400:04d}", 150, "p", "") for i in range(3_000)]
    known = {k: (s, v) for k, s, v in parents}
    want = {}
    for _, i, k, t, _, _ in asked:
        s = known.get(k)
        state = "missing" if s is None else "deleted" if not s[1] else "late" if s[0] > t else None
        if state:
            want[i] = state
    found = orphans.orphans(refs(spark, asked), spark.createDataFrame(parents, "key string, since long, live boolean"), spread=6)
    assert {r["id"]: r["orphan_state"] for r in found.collect()} == want


def test_orphans_of_the_tables(spark, data):
    from medloom.queries.curation import p3_found

    def key(n):
        m = re.match(r"^(gsr|so|cir(?:c|cular)?)(?:no)?0*(\d+)e?$", re.sub("[^a-z0-9]", "", (n or "").lower()))
        return m and m[1][0] + m[2]

    rows = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{data}/{t}.parquet").select(*c).collect()]
    live, gone = {}, {key(r[0]) for r in rows("removed_medicines", "notification_number")}
    for n, t in rows("banned_medicines", "notification_number", "date_added"):
        live[key(n)] = min(t, live.get(key(n), t))
    want = {}
    for name, time in (("unofficial_medicines", "date_added"), ("ayush_fssai_medicines", "date_added"), ("notifications_processed", "last_attempt")):
        for i, n, t in rows(name, "id", "notification_number", time):
            k = key(n)
            if k and k in live and live[k] > t:
                want[name, i] = ("late", t.strftime("%Y-%m"))
            elif k and k not in live:
                want[name, i] = ("deleted" if k in gone else "missing", t.strftime("%Y-%m"))
    assert {(r[0], r[1]): (r[3], r[2]) for r in p3_found(spark, data).collect()} == want and want


# ---- scale helpers


def test_lookup_join_ways_agree(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 50}") for i in range(900)], "id long, k string")
    table = scale.materialize(spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(40)]], "k string, v int"))
    for how in ("left", "inner", "left_anti"):
        small, large = (sorted(map(str, scale.lookup_join(rows, table, ["k"], how, limit=n).collect())) for n in (1 << 20, 0))
        assert small == large and small


def test_lookup_tables_are_measured_as_broadcast(spark):
    numbers = scale.materialize(spark.range(530_000).select(F.xxhash64("id").alias("key")))
    assert scale.relation_size(numbers, ["key"]) == 50_331_648  # the data size that Spark reports once it is broadcast
    assert scale.relation_size(numbers.limit(0), ["key"]) == 0
    named = scale.materialize(spark.range(1_000).select(F.col("id").cast("string").alias("name"), F.lit(None).cast("array<string>").alias("x")))
    assert 16 * 2_048 + 1_000 * (16 + 24 + 16) < scale.relation_size(named, ["name"]) < 200_000
    joined = lambda rows, limit: scale.lookup_join(rows, numbers, ["key"], "left_semi", limit=limit)
    rows = spark.range(0, 1_000_000, 1_000).select(F.xxhash64("id").alias("key"))
    assert "__salt" in joined(rows, scale.BROADCAST_BYTES)._jdf.queryExecution().toString()  # 5 MB of numbers, 50 MB of table
    assert [joined(rows, n).count() for n in (scale.BROADCAST_BYTES, 1 << 30)] == [530, 530]


def test_offsets_are_running_sums(spark):
    rows = [("a" if i % 3 else "b", i, i % 5) for i in range(500)]
    got = scale.with_offsets(spark.createDataFrame(rows, "g string, i long, n long"), ["g"], ["i"], F.col("n"), bucket=F.floor(F.col("i") / 50)).collect()
    run = collections.Counter()
    for g, i, n in sorted(rows, key=lambda r: r[1]):
        assert next(r["start"] for r in got if r["i"] == i) == run[g]
        run[g] += n


def test_shared_folder_comes_from_the_session(spark):
    class Conf:
        def get(self, name, default=None):
            return {"spark.checkpoint.dir": "hdfs://x/shared/"}.get(name, default)

    class Session:
        conf = Conf()

    assert scale.shared_dir(Session()) == "hdfs://x/shared"
    Session.conf = type("None_", (), {"get": lambda self, name, default=None: default})()
    Session.sparkContext = type("Context", (), {"master": "spark://x", "applicationId": "y"})()
    with pytest.raises(ValueError):
        scale.shared_dir(Session())


def test_entry_points(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names)
    assert {"p3_found", "p4_found", "p6_found"} <= set(names)
    assert entry.entry.__doc__
