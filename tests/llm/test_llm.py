"""Operators for training data: edge cases, skew, and brute force where SQL can't say what must come out."""

import collections
import datetime as dt
import difflib
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from medloom.llm import canonical, consensus, leakage, linkage, mixture, queries, setjoin, textkind, textstats

# ---- duplicates hidden by formatting


RECORD = "id long, generic_name string, dosage_form string, strength string, notification_number string, key string"


def keyed(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], RECORD)
    return df.select(canonical.record_key(df).alias("key"), "id")


def test_copies_agree_apart_from_formatting(spark):
    base = ("A-b Oxide + C", "Eye Drops", "0.5 mg / 5 ml", "G.S.R. 5(E)")
    same = [base, ("c, a B  OXIDE.", "EYE-DROPS ", "0.5MG/5ml", "gsr 0005"), ('"C" and A b oxide', "eyedrops", "0.5 mg/5-ml.", "GSR-5(E)")]
    other = [("A-b Oxide + D", *base[1:]), (base[0], "Ear Drops", *base[2:]), (*base[:2], "5 mg / 5 ml", base[3]), (*base[:2], "0.55 mg ml", base[3]), (*base[:3], "S.O. 5(E)"), (base[0], None, *base[2:]), (base[0] + " tablets", *base[1:])]
    rows = [(i, *r) for i, r in enumerate([*same, *other])]
    assert sorted(tuple(r) for r in canonical.copies(keyed(spark, rows)).collect()) == [(0, 1), (0, 2)]
    assert sorted(r["n_copies"] for r in canonical.representatives(keyed(spark, rows)).collect()) == [1] * 7 + [3]


def test_copies_of_nulls_and_blanks_agree(spark):
    rows = [(1, None, None, None, None), (2, "  ", "", None, " "), (3, "x", None, None, None)]
    assert [tuple(r) for r in canonical.copies(keyed(spark, rows)).collect()] == [(1, 2)]


@pytest.mark.parametrize(("a", "b", "same"), [("1,000 mg", "1000mg", True), ("25/5 mg", "2/55 mg", False), ("5 %", "5", False), ("0.5 mg", "05 mg", False), ("2 mg.", "2-MG", True), ("10 mg", "10 mcg", False)])
def test_strength_keys(spark, a, b, same):
    x, y = (r[0] for r in spark.createDataFrame([(0, a), (1, b)], "i int, s string").orderBy("i").select(canonical.canonical_strength(F.col("s"))).collect())
    assert (x == y) == same


def test_copies_of_empty_table_and_long_keys(spark):
    assert canonical.copies(keyed(spark, []).limit(0)).count() == 0
    long_ = "word " * 50_000
    assert canonical.copies(spark.createDataFrame([(long_, 5), (long_, 3), (long_ + "x", 4)], "key string, id long")).collect() == [(3, 5)]


@pytest.mark.parametrize("seed", range(3))
def test_copies_across_partitions_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(300)}", i) for i in rng.sample(range(10_000), 2_000)]
    first, count = {}, collections.Counter(k for k, _ in rows)
    for k, i in rows:
        first[k] = min(i, first.get(k, i))
    df = spark.createDataFrame([*rows, (None, -1), (None, -2)], "key string, id long").repartition(5)
    assert {tuple(r) for r in canonical.copies(df).collect()} == {(first[k], i) for k, i in rows if i != first[k]}
    assert {tuple(r) for r in canonical.representatives(df).collect()} == {(first[k], n) for k, n in count.items()}


def test_copy_counts_of_both_tables(spark, data):
    want = {}
    for name in ("banned_medicines", "unofficial_medicines"):
        ids = collections.defaultdict(list)
        for r in queries._keyed(spark, data, name).collect():
            ids[r["key"]].append(r["id"])
        want |= {(name, min(x)): len(x) for x in ids.values()}
    rows = queries.QUERIES["p1_copy_counts"](spark, data).collect()
    assert {(r["table_name"], r["first_id"]): r["n_copies"] for r in rows} == want and len(rows) == len(want)


# ---- consensus


def test_alignment_is_longest(spark):
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abc") for _ in range(rng.randrange(9))] for _ in range(2))
        best = max((n for n in range(len(a) + 1) for c in itertools.combinations(range(len(a)), n) if _inside([a[i] for i in c], b)), default=0)
        pairs = consensus.align(a, b)
        assert len(pairs) == best and all(a[i] == b[j] for i, j in pairs) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))


def _inside(part, whole):
    rest = iter(whole)
    return all(x in rest for x in part)


def test_votes():
    # one column each: the preferred value stands against two others, and falls to all of them
    assert consensus.survivor(["a x", "b x", "b x y"]) == 0
    assert consensus.survivor(["2019-05-01", "2018-05-01", "2018-06-01", "2018-07-01", "2018-08-01"]) == 1  # plain preference says 0
    assert consensus.consensus([["a", "b"], ["a", "c"], ["a", "c"]], [2.0, 1.0, 1.5]) == ["a", "c"]
    assert consensus.consensus([["a", "b", "c"], ["a"]], [1.0, 0.55]) == ["a", "b", "c"]
    assert consensus.survivor(["may cause liver injury at the usual dose", "may cause liver injury", "may cause"]) == 0


@pytest.mark.parametrize("voters", [2, 3, 62])
def test_survivors_against_brute_force(spark, monkeypatch, voters):
    monkeypatch.setattr(consensus, "VOTERS", voters)
    rng = random.Random(3)
    rows = [(g, rng.choice([None, *"abcdefgh"]) and f"text {rng.randrange(40)} of {rng.choice('abc')}", rng.randrange(5), i) for i, g in enumerate(rng.choice([1, 1, 1, 2, 3, 4]) for _ in range(400))]
    df = spark.createDataFrame([*rows, (9, None, 1, 999)], "g long, v string, merit long, id long")
    got = {r["g"]: r["id"] for r in consensus.survivors(df, ["g"], "v", [F.col("merit"), -F.col("id")], ["id"]).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        best = {}
        for h, v, m, i in rows:
            if h == g and v is not None:
                best[v] = max((m, -i), best.get(v, (-1, 0)))
        texts = sorted(best, key=best.get, reverse=True)
        want[g] = -best[texts[consensus.survivor(texts)]][1]
    assert got == want


def test_values_without_weight_change_no_vote():
    rng = random.Random(8)
    for _ in range(20):
        texts = list({f"{rng.randrange(9)} of {rng.choice('abc')} and {rng.randrange(99)}": 0 for _ in range(150)})
        tokens = [consensus._TOKEN.findall(t) for t in texts]
        assert consensus.consensus(tokens[: consensus.VOTERS], [consensus.RATIO**i for i in range(len(texts))]) == consensus.consensus(tokens, [consensus.RATIO**i for i in range(len(texts))])


def test_survivors_are_copies_of_their_set(spark, data):
    kept = {(r["first_id"], r["field_name"]): r["from_id"] for r in queries.p2_found(spark, data).collect()}
    members = collections.defaultdict(set)
    for r in queries.p1_found(spark, data).filter("table_name = 'banned_medicines'").collect():
        members[r["first_id"]] |= {r["first_id"], r["id"]}
    assert {k[1] for k in kept} == {"source_pdf", "notification_date", "ban_reason"} and all(v in members[k[0]] for k, v in kept.items())


def test_survivors_of_nothing(spark):
    assert consensus.survivors(spark.createDataFrame([], "g long, v string, m long, id long"), ["g"], "v", [F.col("m")], ["id"]).count() == 0


# ---- set similarity


def test_similarity_join_against_brute_force(spark):
    rng = random.Random(5)
    names = ["tablet", "capsule", "eye drops", "ear drops", "oral solution", "oral suspension", "gel", "cream"]

    def noisy(s):
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(s))
            s = s[:i] + rng.choice(["", s[i] * 2, rng.choice("abcxyz ")]) + s[i + 1 :]
        return " ".join(s.split())

    values = sorted({noisy(rng.choice(names)) for _ in range(400)} | {"zzz", ""})

    def tokens(s):
        out = collections.Counter(s.replace(" ", ""))
        for w in s.split():
            p = f"^{w}$"
            out.update(p[i : i + 2] for i in range(len(p) - 1))
        return {(t, i) for t, n in out.items() for i in range(n)}

    want = {}
    for v in values:
        best = max(((len(tokens(v) & tokens(n)) / max(1, len(tokens(v) | tokens(n))), -i) for i, n in enumerate(names)), default=None)
        if best and best[0] >= setjoin.THRESHOLD:
            want[v] = (-best[1], round(best[0], 9))
    got = setjoin.similarity_join(spark.createDataFrame([(v,) for v in values] + [(None,)], "v string"), spark.createDataFrame(list(enumerate(names)), "ref_id long, name string"))
    assert {r["v"]: (r["ref_id"], round(r["similarity"], 9)) for r in got.collect()} == want


def test_map_to_list(spark):
    refs = spark.createDataFrame([(1, "Tablet"), (2, "Eye Drops"), (3, "Ear Drops"), (4, "Oral Suspension"), (5, None)], "ref_id long, name string")
    written = ["Tablet", "TABLETS", "tbalet", "drops, eye", "Eye Drops 10 ml bottle", "batch 12", "carton", "-", "", "  ", None, "tabs", "tblt", "susp.", "ophthalmic drps", "drops", "HSN 30"]
    rows = spark.createDataFrame([(i, v, 7) for i, v in enumerate(written)], "id long, f string, ref_id int")
    got = {r["id"]: r["ref_id"] for r in setjoin.map_to_list(rows.drop("ref_id"), ["id"], "f", refs).collect()}
    assert got.pop(15) in (2, 3)  # half of either name
    assert got == {1: 1, 2: 1, 3: 2, 4: 2, 5: 0, 6: 0, 7: 0, 11: 1, 12: 1, 13: 4, 14: 2, 16: 0}
    assert setjoin.map_to_list(rows.limit(0), ["id"], "f", refs).count() == setjoin.map_to_list(rows, ["id"], "f", refs.limit(0)).filter("ref_id <> 0").count() == 0


def test_short_names(spark):
    refs = spark.createDataFrame([(1, "eye drops"), (2, "ear drops"), (3, "ointment"), (4, "one two three four")], "ref_id long, name string")
    got = {(r["ref_id"], r["name"]) for r in setjoin.short_names(refs).collect()}
    assert {(1, "eye drops"), (1, "eye drps"), (1, "ophthalmic drops"), (1, "eye"), (2, "otic"), (3, "oint"), (3, "ointments"), (3, "ontmnt"), (4, "one two three four"), (4, "thr")} <= got
    assert not any(n in ("drops", "dro", "o") for _, n in got) and len({n for _, n in got}) == len(got)


def test_forms_without_synonyms(spark, data):
    """Nine in ten rows get the same answer from the rules alone."""
    forms = spark.read.parquet(f"{data}/dosage_forms.parquet").selectExpr("form_id as ref_id", "form_name as name")
    rows = spark.read.parquet(f"{data}/banned_medicines.parquet").select("id", "dosage_form")
    plain = {r["id"]: r["ref_id"] for r in setjoin.map_to_list(rows, ["id"], "dosage_form", forms, synonyms={}).collect()}
    full = {r["id"]: r["ref_id"] for r in setjoin.map_to_list(rows, ["id"], "dosage_form", forms).collect()}
    assert plain.keys() == full.keys() and sum(plain[i] == full[i] for i in plain) >= 0.9 * len(plain)


# ---- linkage


SIDE = "id long, name string, number string"
#: other official records, so that there is something to tell apart and to calibrate on
OTHERS = [(1_000 + i, " + ".join(f"{a}{b}{c}ine" for a, b, c in zip(x[::3], x[1::3], x[2::3])), f"S.O. {20_000 + 137 * i}(E)") for i, x in enumerate([random.Random(i).choices(["bru", "kol", "mey", "san", "tir", "vop", "zul", "wex"], k=3 * (1 + i % 3)) for i in range(80)])]


def linked(spark, left, right, **how):
    found = linkage.link(spark.createDataFrame([*left, *OTHERS], SIDE), spark.createDataFrame(right, SIDE), **how)
    return {(r["left_id"], r["right_id"]): r["confidence"] for r in found.expand().collect()}, found


def test_links(spark):
    left = [
        (1, "Alphadoxin + Bexaril Sodium + Corvadine + Dulmaxen", "G.S.R. 417(E)"), (2, "bexaril, alphadoxin; CORVADINE and Dulmaxen", "GSR 417"), (3, "Alphadoxin", "S.O. 12(E)"), (4, "Alphadoxin", "S.O. 99(E)"),
        (5, "Fenoquilast", "G.S.R. 30842(E)"), (6, "Gorvixane", None), (7, None, "S.O. 12(E)"), (8, "", "S.O. 12(E)"), (9, "Hexulide", "Circular No. 5"),
    ]
    right = [
        (101, "FDC of Alphadoksin, Bexaril Sod., Corvadine & Dulmaxen", "gsr 417(e)"), (102, "Alphadoxin + Bexaril + Corvadine", "G.S.R. 417(E)"), (103, "Alphadoxin", None), (104, "Alphadoxin tablets", "SO 12"),
        (105, "Fenoqilast", "G.S.R. 30342(E)"), (106, "Fenoquilast", None), (108, "Gorvixane [Brand]", ""), (109, None, "S.O. 12(E)"), (110, "Zzyzx", "S.O. 12(E)"), (112, "Hexulide + Zork", "Circular No. 5"), (104, "Alphadoxin tablets", "SO 12"),
    ]
    found = linkage.link(spark.createDataFrame([*left, *OTHERS], SIDE), spark.createDataFrame(right, SIDE))
    got = collections.Counter((r["left_id"], r["right_id"]) for r in found.expand().collect())
    assert got == {(1, 101): 1, (2, 101): 1, (1, 102): 1, (2, 102): 1, (3, 104): 2, (5, 105): 1, (5, 106): 1, (6, 108): 1}
    links = collections.Counter()
    for (a, b), n in got.items():
        links["left", a] += n
        links["right", b] += n
    assert {(r["side"], r["id"]): r["links"] * (1 + (r["id"] == 104)) for r in found.members().collect()} == links


def test_ingredients_are_read(spark):
    left = spark.createDataFrame([(1, "Combipack", ["Alphadoxin", "Bexaril"], "S.O. 41(E)"), (2, "Corvadine", None, "S.O. 7(E)"), (3, None, ["Dulmaxen and Fenoquilast"], "S.O. 9(E)")], "id long, name string, ingredients array<string>, number string")
    right = spark.createDataFrame([(101, "Dulmaxen + Fenoquilast", "SO 9"), (102, "Corvadine", "SO 7"), (103, "Combipack, Alphadoxin, Bexaril", "SO 41")], SIDE)
    assert {(r["left_id"], r["right_id"]) for r in linkage.link(left, right).expand().collect()} == {(3, 101), (2, 102), (1, 103)}


@pytest.mark.parametrize("long_", [2, 6])
def test_search_against_brute_force(spark, monkeypatch, long_):
    monkeypatch.setattr(linkage, "LONG", long_)
    rng = random.Random(11)
    entities = sorted({("+".join(sorted(rng.sample("abcdefgh", rng.randrange(1, 6)))), rng.choice([None, "G:12", "G:13", "G:21", "G:129", "S:12", "S:7"])) for _ in range(80)}, key=str)
    index = linkage.Index.of(spark.createDataFrame(entities, "s string, num string"))
    total, length = len(entities), sum(len(s.split("+")) + 1 for s, _ in entities) / len(entities)
    stems_, nums = collections.Counter(w for s, _ in entities for w in s.split("+")), collections.Counter(n for _, n in entities if n)
    variants = {r["n"]: set(r["v"] or []) for r in spark.createDataFrame([(n,) for n in [*nums, "G:99"]], "n string").select("n", linkage.number_variants(F.col("n")).alias("v")).collect()}
    idf = lambda n: math.log(1 + (total - n + 0.5) / (n + 0.5))
    asked = sorted({(s, n) for s, n in rng.sample(entities, 30)} | {("+".join(sorted(rng.sample("abcdefghxy", rng.randrange(1, 5)))), rng.choice([None, "G:12", "G:99", "S:7"])) for _ in range(40)}, key=str)
    hidden = {k for k in asked[::5] if k in entities}

    def score(q, e):
        (qs, qnum), (s, num) = q, e
        a, b = set(qs.split("+")), set(s.split("+"))
        known = q in entities and q not in hidden
        agreed = 0 if num is None or qnum is None else 1 if num == qnum else 0.5 if not known and a <= b and len(b) <= len(a) + 1 and variants[num] & variants[qnum] else 0
        return (linkage.K1 + 1) / (1 + linkage.K1 * (1 - linkage.B + linkage.B * (len(b) + 1) / length)) * (sum(idf(stems_[w]) for w in a & b) + (agreed and agreed * idf(nums[num])))

    rows = [(i, s, n, None) for i, (s, n) in enumerate(asked)]
    queries_ = spark.createDataFrame(rows, "qid long, qs string, qnum string, none string").select("qid", "qs", "qnum", F.when(F.col("qid").isin([i for i, q in enumerate(asked) if q in hidden]), linkage._id(F.col("qs"), F.col("qnum"))).alias("hidden"))
    got = {r["qid"]: [x for x in (r["score"], r["score2"]) if x is not None] for r in index.search(index.weigh(queries_)).collect()}
    for i, q in enumerate(asked):
        want = sorted((score(q, e) for e in entities if not (q in hidden and e == q) and score(q, e) > 0), reverse=True)[:2]
        exact = [w for w in want if w >= want[0] / 2]
        assert got.get(i, [])[: len(exact)] == pytest.approx(exact), q


def test_confidence_tells_matches_apart(spark):
    left = [(1, "Alphadoxin + Bexaril", "S.O. 41(E)"), (2, "Alphadoxin + Bexaril + Corvadine", "S.O. 41(E)"), (3, "Fenoquilast", "G.S.R. 30842(E)"), (4, "Gorvixane", "G.S.R. 51976(E)")]
    right = [(101, "Alphadoxin + Bexaril", "S.O. 41(E)"), (103, "Fenoquilast", "G.S.R. 30842(E)"), (104, "Gorvixane", "G.S.R. 51971(E)")]
    got, _ = linked(spark, left, right)
    assert set(got) == {(1, 101), (3, 103), (4, 104)} and len({round(c, 6) for c in got.values()}) == 3 and got[3, 103] > got[4, 104]


def test_matches_must_be_mutual(spark):
    # the listing that fits entity 2 best fits entity 1 better, so whatever else is nearest to 2 is not what 2 is nearest to
    left = [(1, "Alphadoxin + Bexaril", "S.O. 41(E)"), (2, "Alphadoxin + Corvadine", "G.S.R. 977(E)"), (3, "Dulmaxen", "S.O. 5(E)")]
    near = spark.createDataFrame([(1, 0.9, 2, 0.8), (2, 0.7, 1, 0.1), (3, 0.5, None, None), (3, 0.4, 1, 0.3)], "eid long, coverage double, eid2 long, coverage2 double")
    assert sorted(r["eid"] for r in linkage.mutual_entities(near).collect()) == [1, 3]
    assert linked(spark, left, [(101, "Alphadoxin + Bexaril", "S.O. 41(E)")])[0].keys() == {(1, 101)}


def test_calibration(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = np.c_[np.ones(4_000), rng.uniform(0, 0.5, 4_000), rng.uniform(0, 1, (4_000, 3))]
    y = rng.uniform(size=4_000) < 1 / (1 + np.exp(-(x @ np.array([-6.0, 2.0, 4.0, 5.0, 1.0]))))
    weights = linkage.calibrate(x[:2_000], y[:2_000])
    assert linkage.calibration_error(weights, x[2_000:], y[2_000:]) < 0.05 < linkage.calibration_error(np.zeros(5), x[2_000:], y[2_000:])


def test_calibration_on_outcomes_of_the_data(spark, data):
    found = queries._links(spark, data)
    confidence = [r[0] for r in found.pairs.select("confidence").collect()]
    assert found.error < 0.1 and len({round(c, 4) for c in confidence}) > 10


def test_exact_set_goes_before_one_ingredient_more(spark):
    left = [(1, "Alphadoxin + Bexaril + Corvadine", "S.O. 41(E)"), (2, "Alphadoxin + Bexaril + Corvadine + Dulmaxen", "S.O. 97(E)")]
    assert linked(spark, left, [(101, "Alphadoxin + Bexaril + Corvadine", "SO 41")])[0].keys() == {(1, 101)}


def test_links_of_empty_tables_and_many_ingredients(spark):
    empty, some = spark.createDataFrame([], SIDE), spark.createDataFrame([(1, "Alphadoxin", "S.O. 1(E)")], SIDE)
    assert linkage.link(empty, some).expand().count() == linkage.link(some, empty).expand().count() == linkage.link(empty, empty).expand().count() == 0
    many = " + ".join("qwrtp"[i % 5] + "aeio"[i // 5 % 4] + "lmn"[i // 20] + "oxin" for i in range(30))
    assert linked(spark, [(1, many, "S.O. 1(E)"), (2, "Alphadoxin", "S.O. 1(E)")], [(101, many.upper(), "SO 1"), (102, "Alphadoxin", "SO 1")])[0].keys() == {(1, 101), (2, 102)}


def test_number_variants(spark):
    rng = random.Random(2)
    numbers = sorted({f"G:{rng.randrange(1, 3000)}" for _ in range(120)} | {"G:12", "G:21", "S:12", "G:123", "G:132"})
    rows = [(r["n"], set(r["v"] or [])) for r in spark.createDataFrame([(n,) for n in numbers], "n string").select("n", linkage.number_variants(F.col("n")).alias("v")).collect()]

    def near(a, b):
        x, y = a[2:], b[2:]
        if a[0] != b[0] or a == b:
            return False
        if len(x) == len(y):
            d = [i for i in range(len(x)) if x[i] != y[i]]
            return len(d) == 1 or len(d) == 2 and d[1] == d[0] + 1 and x[d[0]] == y[d[1]] and x[d[1]] == y[d[0]]
        x, y = sorted((x, y), key=len)
        return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))

    for (a, v), (b, w) in itertools.combinations(rows, 2):
        if len(a) > 3 and len(b) > 3 and near(a, b):
            assert v & w, (a, b)


# ---- leaks


VOCABULARY = [a + b for a in ("ka", "lo", "mi", "ru", "se", "ta", "vo", "xe") for b in ("dar", "fin", "gol", "hem", "jik", "lun", "mop", "nar", "pes", "rix")]


def passage(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def test_leaks_against_brute_force(spark):
    rng = random.Random(7)
    items = [(i, passage(rng, rng.randrange(30, 80))) for i in range(25)]
    documents, want = [], set()
    for d in range(150):
        words = passage(rng, rng.randrange(20, 120))
        if rng.random() < 0.6:
            i, item = rng.choice(items)
            part = rng.choice([0.15, 0.6, 1.0])
            n = max(1, int(len(item) * part))
            at = rng.randrange(len(item) - n + 1)
            copy = [w if rng.random() > 0.05 else "changed" for w in item[at : at + n]]
            words[10:10] = copy
            match = difflib.SequenceMatcher(None, item, words, autojunk=False)
            if sum(b.size for b in match.get_matching_blocks() if b.size > 2) >= 0.5 * len(item):
                want.add((i, d))
        text = " ".join(w.upper() if rng.random() < 0.1 else w for w in words)
        documents.append((d, text.replace(" ", ",\n" if d % 3 == 0 else "  "), "x"))
    documents += [(900, None, "x"), (901, "", "x"), (902, " \n", "x")]
    got = leakage.leaks(spark.createDataFrame(documents, "doc_id long, text string, item_id string"), spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(99, None), (98, "")], "item_id long, text string"), item_words=500)
    rows = got.collect()
    assert {(r["item_id"], r["doc_id"]) for r in rows} == want and want
    assert all(r["share"] >= leakage.SHARE for r in rows)


def test_leaks_see_through_layout_and_changed_slots():
    text = "The clerk in Norbury counted 12 sealed boxes of Alphadoxin before noon. Later the nurse in Norbury weighed 30 mg of Corvadine again and wrote the figures into a brown ledger by the door."
    index = leakage.Index([(1, text)])
    assert index.find(text)[0][:2] == (1, 1.0)
    assert index.find("<p>x</p> " + text.upper().replace(" ", "\n> ").replace("LEDGER", "LED-\n> GER"))[0][1] > 0.9
    changed = text.replace("Norbury", "Easton").replace("12", "77")
    (_, share, slots), = index.find(changed)
    assert share > 0.9 and slots > 0.6
    assert not index.find("The clerk in Norbury counted 12 sealed boxes of something else entirely and nothing more was said about it.")
    assert not index.find("") and not leakage.Index([]).find(text)


def test_leaks_of_renamed_items():
    text = "The clerk in Norbury counted 12 sealed boxes of Alphadoxin before noon. Later the nurse in Norbury weighed 12 mg of Corvadine again and wrote the figures into a brown ledger by the door."
    index = leakage.Index([(1, text)])
    renamed = text.replace("Norbury", "Zulkopo").replace("Alphadoxin", "Wexivan").replace("Corvadine", "Mupalin")
    (_, share, slots), = index.find(renamed)
    assert share > 0.9 and slots == 1.0
    assert index.find(renamed.lower())[0][2] == 1.0
    alike, mixed = text.replace("12", "17"), text.replace("12 sealed", "17 sealed").replace("12 mg", "29 mg")
    assert index.find(alike)[0][2] == 1.0 > index.find(mixed)[0][2]  # two figures for one
    assert index.find(alike)[0][1] >= index.find(mixed)[0][1]


@pytest.mark.parametrize("n", range(1, 30))
def test_leaks_of_items_of_every_length(n):
    rng = random.Random(n)
    item, around = passage(rng, n), ["qu" + w for w in passage(rng, 60)]
    index = leakage.Index([(1, " ".join(item)), (2, " ".join("zz" + w for w in item))])
    assert [r[:2] for r in index.find(" ".join(around[:30] + item + around[30:]))] == [(1, 1.0)]
    assert not index.find(" ".join(around))
    figures = leakage.Index([(1, " ".join(str(1_000 + 37 * i) for i in range(n)))])
    assert [r[0] for r in figures.find(" ".join(["x", *(str(1_000 + 37 * i) for i in range(n)), "y"]))] == [1]


def test_leaks_of_stock_phrases(monkeypatch):
    rng = random.Random(4)
    stock = passage(rng, 12)
    items = [(i, " ".join(stock + passage(rng, 40))) for i in range(60)]
    text = " ".join([*stock * 5, *items[7][1].split(), *stock * 3])
    whole = sorted(leakage.Index(items).find(text))
    monkeypatch.setattr(leakage, "MEETINGS", 50)
    assert sorted(leakage.Index(items).find(text)) == whole and [r[0] for r in whole] == [7]


def test_leaks_weigh_dense_candidates_only(monkeypatch):
    rng = random.Random(5)
    passage = lambda rng, n: [rng.choice(VOCABULARY) + rng.choice(VOCABULARY) for _ in range(n)]
    stock = passage(rng, 12)
    items = [(i, " ".join(stock + passage(rng, 40))) for i in range(60)]
    index, weighed = leakage.Index(items), []
    assert "_known" not in vars(index)  # broadcast: executors make their own
    stretch = leakage.Index._stretch
    monkeypatch.setattr(leakage.Index, "_stretch", lambda self, n, codes, shifts: weighed.append(n) or stretch(self, n, codes, shifts))
    texts = [" ".join(passage(rng, 30) + stock + items[k][1].split()[:size] + ["unseen", "17"] + stock) for k, size in ((7, 52), (9, 30), (11, 12), (13, 45))]
    found = [sorted(index.find(t)) for t in texts]
    assert [[r[0] for r in f] for f in found] == [[7], [9], [], [13]] and len(weighed) < 10  # of 720 that share the stock phrase, which is too short
    monkeypatch.setattr(leakage, "MEETINGS", 50)
    assert [sorted(index.find(t)) for t in texts] == found
    monkeypatch.setattr(leakage, "KEPT", 0)
    assert [sorted(index.find(t)) for t in texts] == found


def test_leaks_in_long_tags():
    text = " ".join(passage(random.Random(1), 40))
    assert leakage.Index([(1, text)]).find(text.replace(" ", " <a href='" + "x" * 900 + "'> ", 20))[0][1] == 1.0


# ---- mixing


def test_mixture(spark):
    rng = random.Random(4)
    docs = [(i, rng.choice(["a"] * 8 + ["b", "c", "none"]), rng.randrange(0, 400)) for i in range(3_000)]
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("C ", 0.2, 2), ("missing", 0.1, 5)], "source string, target_share double, max_repeats int")
    df = spark.createDataFrame([*docs, (9_999, None, 50)], "doc_id long, source_key string, n_tokens long")
    mixed, report = mixture.mixture(df, targets, block_tokens=512)
    size, most = {d: n for d, _, n in docs}, {"a": 1, "b": 3, "c": 2}
    rows, slots, uses = mixed.collect(), collections.Counter(), collections.defaultdict(list)
    for r in rows:
        assert r["n_tokens"] == r["to_token"] - r["from_token"] > 0 and r["from_token"] >= 0 and r["to_token"] <= size[r["doc_id"]]
        slots[r["slot"], r["source"]] += r["n_tokens"]
        uses[r["source"], r["doc_id"], r["pass"]] += range(r["from_token"], r["to_token"])
    assert sorted(s for s, _ in slots) == list(range(len(slots)))  # every slot is filled, by one source
    part = collections.Counter(s for (_, s), n in slots.items() if n != 512)
    assert all(n <= 512 for n in slots.values()) and all(part[s] <= most[s] for s in part)
    assert all(p < most[s] and len(t) == len(set(t)) for (s, _, p), t in uses.items())
    shares = {r["source"]: r for r in report.collect()}
    for s, t in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert abs(shares[s]["actual_share"] - t) < 0.02
    assert shares["missing"]["used_tokens"] == 0 and shares["missing"]["available_tokens"] == 0
    assert min(shares[s]["used_tokens"] / (shares[s]["available_tokens"] * most[s]) for s in most) > 0 and max(shares[s]["used_tokens"] / (shares[s]["available_tokens"] * most[s]) for s in most) > 0.93
    order = sorted(mixed.collect(), key=lambda r: r["slot"])
    half = collections.Counter()
    for r in order[: len(order) // 2]:
        half[r["source"]] += r["n_tokens"]
    assert abs(half["a"] / sum(half.values()) - 0.5) < 0.04


def test_shares_of_small_mixtures(spark, data):
    mixed, report = queries._mix(spark, data)
    rows = {r["source"]: r for r in report.collect()}
    whole = sum(r["target_share"] for r in rows.values() if r["available_tokens"])
    assert all(abs(r["actual_share"] - r["target_share"] / whole) < 0.005 for r in rows.values() if r["available_tokens"])
    assert mixed.select("slot").distinct().count() == mixed.agg(F.max("slot")).first()[0] + 1


def test_mixture_of_nothing(spark):
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    mixed, report = mixture.mixture(spark.createDataFrame([(1, "a", 0), (2, "b", 9)], "doc_id long, source_key string, n_tokens long"), targets)
    assert mixed.count() == 0 and report.collect()[0]["actual_share"] == 0
    mixed, report = mixture.mixture(spark.createDataFrame([(1, "a", 5)], "doc_id long, source_key string, n_tokens long"), targets.limit(0))
    assert mixed.count() == report.count() == 0


def test_points_and_sources(spark):
    assert [round(r[0], 6) for r in spark.range(5).select(mixture.van_der_corput(F.col("id"))).collect()] == [0, 0.5, 0.25, 0.75, 0.125]
    assert [r[0] for r in spark.createDataFrame([(" State-Portal",), ("state  portal",), ("",), (None,)], "s string").select(mixture.source_key(F.col("s"))).collect()] == ["state_portal", "state_portal", None, None]


def test_token_counts(spark):
    import os

    if not os.path.exists(mixture.VOCABULARY):
        pytest.skip("no vocabulary here")
    rows = spark.createDataFrame([(1, "Hello world"), (2, ""), (3, None), (4, "<|endoftext|>"), (5, "word " * 20_000)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in mixture.token_counts(rows, ["doc_id"]).collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] > 1 and got[5] >= 20_000


# ---- statistics and kinds


def test_tails_against_brute_force(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["en"] * 9 + ["hi"]), rng.choice("ab"), float(rng.choice([0, 0, 0, rng.randrange(60)]))) for _ in range(1_500)]
    got = {(r["lang"], r["stat"], r["value"]): (r["low"], r["high"]) for r in textstats.tails(spark.createDataFrame(rows, "lang string, stat string, value double")).collect()}
    for k in set(rows):
        same = [v for lang, s, v in rows if (lang, s) == k[:2]]
        assert got[k] == pytest.approx((sum(v <= k[2] for v in same) / len(same), sum(v >= k[2] for v in same) / len(same)))
    assert len(got) == len(set(rows))


def test_statistics(spark):
    rows = spark.createDataFrame([(1, "The cat sat. \nIt ran!\nno end", "EN "), (2, "", None), (3, None, "en"), (4, " \n", "en-IN"), (5, "word " * 100_000, "en")], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in textstats.statistics(rows).collect()}
    assert set(got) == {1, 2, 4, 5}
    assert got[1]["n_words"] == 7 and got[1]["lang"] == "en" and got[1]["ended_lines"] == pytest.approx(2 / 3, abs=1e-4) and got[1]["common_words"] == pytest.approx(3 / 7, abs=1e-4)
    assert got[2]["n_words"] == 0 and got[2]["lang"] == "und" and got[4]["lang"] == "en" and got[5]["n_words"] == 100_000


PROSE = "The clerk went to the office and was told that it had been closed for the day.\nShe wrote a letter to the board, which they did not answer until the end of the year."
KINDS = {
    PROSE: "prose",
    "1. Alpha\n2. Beta and Gamma\n3. Delta": "list", "- Alpha 5 mg\n- Beta\n- Gamma": "list", "Alpha; Beta; Gamma; Delta; Epsilon": "list", "Alpha\nBeta\nGamma\nDelta": "list", "Alpha, gel .... 12\nBeta, gel .... 13": "list",
    "a,b,c\n1,2,3\n4,5,6\n7,8,9": "table", "a\tb\tc\n1\t2\t3": "table", "|a|b|\n|---|---|\n|1|2|\n|3|4|": "table", "<table><tr><td>a</td><td>b</td></tr>\n<tr><td>c</td></tr></table>": "table", "Name     Form     Date\nAlpha    Gel      2020\nBeta     Cream    2021": "table",
    "Login | Home | Search | FAQ | Contact": "junk", "Home\nLogin\nHelp": "junk", "page not found\n" * 8: "junk", "var a=b();if(c){d();}": "junk", "#$%^ &*( )_+ {}{} <>": "junk", "63352b448a7781cba82f259a0b842e0cf4f6709f06f0ec98a1567ac43a176cda": "junk",
    "buy cheap now " * 12: "junk", "": "junk", " \n ": "junk", "Page 1 of 3\nPage 2 of 3 .... 7": "junk",
}


def test_shapes():
    rows = {t: dict(zip(textkind.SHAPE, textkind.shape(t))) for t in KINDS}
    assert all(r["flowing_lines"] == 1 for t, r in rows.items() if KINDS[t] == "prose")
    assert all(r["regular_lines"] > 0.6 for t, r in rows.items() if KINDS[t] == "table")
    assert all(r["n_lines"] == 0 for t, r in rows.items() if not t.strip())
    assert textkind.shape("- a b\n- c d")[textkind.SHAPE.index("marked_lines")] == 1.0
    assert textkind.shape("word " * 300_000)[textkind.SHAPE.index("distinct_words")] == 0.0


def labelled(spark, copies=0, lang="en"):
    """Documents of all kinds in variants, and their labels."""
    rng = random.Random(9)
    words = ["".join(rng.choice(["bra", "kul", "mef", "sin", "tor", "vax"]) for _ in range(3)) for _ in range(200)]
    base = [t for t in KINDS if t.strip()]
    rows = []
    for i in range(400):
        t = base[i % len(base)]
        rows.append((i, t.replace("Alpha", rng.choice(words)).replace("Beta", rng.choice(words)).replace("clerk", rng.choice(words)) + ("\n" + t if rng.random() < 0.5 else ""), lang, KINDS[t]))
    rows += [(1_000 + i, rows[1][1], lang, rows[1][3]) for i in range(copies)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, kind string")
    return df.drop("kind"), df.select("doc_id", "kind"), {r[0]: r[3] for r in rows}


@pytest.mark.parametrize("copies", [0, 200])
def test_not_prose_of_documents_not_labelled(spark, copies):
    documents, labels, kinds = labelled(spark, copies)
    more = spark.createDataFrame([(9_001, None, "en"), (9_002, " \n", "en"), (9_003, "", None)], documents.schema)
    got = {r["doc_id"]: r["kind"] for r in textstats.not_prose(documents.unionAll(more), labels.filter("doc_id % 2 = 0 or doc_id >= 1000"), 300).collect()}
    assert got.pop(9_002) == got.pop(9_003) == "junk" and 9_001 not in got
    odd = [i for i in kinds if i % 2]
    assert sum(got.get(i, "prose") == kinds[i] for i in odd) >= 0.9 * len(odd)
    if copies:
        assert all(got.get(i, "prose") == kinds[i] for i in kinds if i >= 1_000)


def test_scores_decide(spark, monkeypatch):
    documents, labels, kinds = labelled(spark)
    monkeypatch.setattr(textstats, "tails", lambda rows: rows.distinct().select("lang", "stat", "value", F.lit(1.0).alias("low"), F.lit(1.0).alias("high")))
    assert {r["kind"] for r in textstats.not_prose(documents, labels).collect()} <= {"list", "table", "junk"}
    constant = {r["doc_id"]: r["kind"] for r in textstats.not_prose(documents, labels).collect()}
    assert sum(constant.get(i, "prose") == k for i, k in kinds.items()) < 0.6 * len(kinds)


def test_not_prose_of_nothing_and_no_labels(spark):
    documents, labels, kinds = labelled(spark)
    assert textstats.not_prose(documents.limit(0), labels).count() == 0
    found = {r["doc_id"]: r["kind"] for r in textstats.not_prose(documents, labels.limit(0)).collect()}
    assert not any(i in found for i, k in kinds.items() if k == "prose")


def test_kinds_against_labels_left_out(spark, data):
    """Two thirds of the labels are learnt from, the last third decides."""
    import os

    folder = os.path.join(os.path.dirname(data), "sf0.1")
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    documents, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/doc_labels.parquet")
    found = textstats.not_prose(documents, labels.filter("doc_id % 3 > 0")).withColumnRenamed("kind", "found")
    rows = labels.filter("doc_id % 3 = 0").join(found, "doc_id", "left").select("kind", F.coalesce("found", F.lit("prose")).alias("found")).collect()
    assert sum(r["kind"] == r["found"] for r in rows) >= 0.9 * len(rows)  # some labels are wrong
