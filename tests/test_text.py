import datetime as dt

import pytest
from pyspark.sql import functions as F

from medloom.functions import numbers, text


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("  paracetamol  ", "Paracetamol"), ("ACECLOFENAC", "Aceclofenac"), ("some   drug  name", "Some Drug Name"), ("Paracetamol.", "Paracetamol"), ("Ibuprofen,", "Ibuprofen"), ("", ""), (None, None),
        ("factor viii", "Factor VIII"), ("mild mix", "MILD MIX"), ("Ashwagandha leaves (Withania somnifera) leaf extract", "Ashwagandha Leaves (withania Somnifera) Leaf Extract"),
    ],
)
def test_names(spark, given, expected):
    assert one(spark, given, text.normalize_name) == expected


@pytest.mark.parametrize(
    ("given", "expected"),
    [("tab", "Tablet"), ("Tabs.", "Tablet"), ("cap", "Capsule"), ("inj", "Injection"), ("eye drops", "Eye Drops"), ("nebulizer", "Nebulizer"), ("eye-mist", "Eye-Mist"), ("", None), ("  ", None), (None, None)],
)
def test_forms(spark, given, expected):
    assert one(spark, given, text.normalize_form) == expected


@pytest.mark.parametrize(("given", "expected"), [("500mg", "500 mg"), ("500 mg", "500 mg"), (" 5mg/5ml ", "5 mg/5 ml"), ("", None), (None, None)])
def test_strengths(spark, given, expected):
    assert one(spark, given, text.normalize_strength) == expected


@pytest.mark.parametrize(("given", "expected"), [("G.S.R. 578 (E)", "G.S.R. 578(E)"), ("G.S.R.  578  ( E )", "G.S.R. 578(E)"), (None, None)])
def test_numbers(spark, given, expected):
    assert one(spark, given, text.normalize_number) == expected


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("G.S.R. 578(E)", "G:578"), ("gsr-0578 ( e )", "G:578"), ("GSR NO 578 (E)", "G:578"), ("S. O. 1432 (E).", "S:1432"), ("Cir. No. 42", "C:42"), ("CIR/42", "C:42"), ("Circular No: 42", "C:42"),
        ("no number", None), ("", None), ("  ", None), (None, None),
    ],
)
def test_number_keys(spark, given, expected):
    assert one(spark, given, numbers.number_key) == expected


def test_sortable_keys_sort_by_value(spark):
    keys = [one(spark, f"S.O. {n}(E)", numbers.sortable_key) for n in (9, 10, 100, 10**17, 10**19)]
    assert keys == sorted(keys)


@pytest.mark.parametrize(
    ("given", "number", "date"),
    [
        ("GSR NO. 999 (E) Dated 01-10-1983", "G.S.R. 999(E)", dt.date(1983, 10, 1)), ("S.O. 123 (E) Dated January 15, 2020", "S.O. 123(E)", dt.date(2020, 1, 15)),
        ("G.S.R. 1(E) dated 10TH January, 2018", "G.S.R. 1(E)", dt.date(2018, 1, 10)), ("GSR 578(E) Dated 31.02.1983", "G.S.R. 578(E)", None), ("", None, None), (None, None, None),
    ],
)
def test_number_and_date(spark, given, number, date):
    got = one(spark, given, text.parse_number_and_date)
    assert (got["number"], got["date"]) == (number, date)


@pytest.mark.parametrize(
    ("given", "expected"),
    [("dated 10/09/2018 x", dt.date(2018, 9, 10)), ("on 5 March 2019", dt.date(2019, 3, 5)), ("no date", None), ("31/02/2019 then 5 March 2019", dt.date(2019, 3, 5)), ("10th March 2019", dt.date(2019, 3, 10)), ("10TH March 2019", None), (None, None)],
)
def test_dates(spark, given, expected):
    assert one(spark, given, text.extract_date) == expected


@pytest.mark.parametrize(("given", "expected"), [("2019-03-05", dt.date(2019, 3, 5)), ("Mar 5, 2019", dt.date(2019, 3, 5)), ("vide 5.3.2019 x", dt.date(2019, 3, 5)), ("x", None), ("", None), (None, None)])
def test_date_formats(spark, given, expected):
    assert one(spark, given, text.parse_date) == expected


@pytest.mark.parametrize(
    ("given", "fdc", "parts"),
    [
        ("Alprazolam + Propranolol", True, ["Alprazolam", "Propranolol"]), ("Amoxicillin & Clavulanate Potassium", True, ["Amoxicillin", "Clavulanate Potassium"]),
        ("Paracetamol and Ibuprofen", True, ["Paracetamol", "Ibuprofen"]), ("Gatifloxacin", False, ["Gatifloxacin"]), ("", False, []), (None, False, []),
    ],
)
def test_combinations(spark, given, fdc, parts):
    got = one(spark, given, text.split_combination)
    assert (got["is_fdc"], got["ingredients"]) == (fdc, parts)


def test_merged_sources(spark):
    rows = spark.createDataFrame([(["a.in, B.in", "b.in,c.in", None, ""],)], "x array<string>")
    assert rows.select(text.merge_sources(F.col("x"))).first()[0] == "a.in, B.in, c.in"


@pytest.mark.parametrize(
    ("given", "expected"), [("HTTP://Host:80/a/b/?q=1", "http://host:80/a/b"), ("https://h", "https://h"), ("no url", None), (None, None)]
)
def test_urls(spark, given, expected):
    assert one(spark, given, text.comparable_url) == expected


@pytest.mark.parametrize(("given", "expected"), [("/d/G_S_R_578_E.pdf", "G.S.R. 578(E)"), ("SO_12.pdf", "S.O. 12(E)"), ("doc.pdf", None), (None, None)])
def test_file_numbers(spark, given, expected):
    assert one(spark, given, text.number_of_file) == expected
