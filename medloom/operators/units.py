"""Quantities in different units and scales, brought to common units by SQL expressions alone.

A strength is cut into quantities by one pattern; number, scale word, unit and denominator are extracted, the unit
is looked up in an alias table, and factor and offset give the amount. A number without a unit takes the last unit
of its field, else the unit named in the accompanying text, else the source's default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.functions.columns import squeeze

#: Unit as written -> dimension, factor to the common unit, offset. Base units are mcg, iu, ml and g.
UNITS = {
    "mcg": ("mass", 1.0, 0.0), "microgram": ("mass", 1.0, 0.0), "micrograms": ("mass", 1.0, 0.0), "ug": ("mass", 1.0, 0.0),
    "mg": ("mass", 1e3, 0.0), "mgs": ("mass", 1e3, 0.0), "milligram": ("mass", 1e3, 0.0), "milligrams": ("mass", 1e3, 0.0), "milligramme": ("mass", 1e3, 0.0),
    "g": ("mass", 1e6, 0.0), "gm": ("mass", 1e6, 0.0), "gms": ("mass", 1e6, 0.0), "gram": ("mass", 1e6, 0.0), "grams": ("mass", 1e6, 0.0), "gramme": ("mass", 1e6, 0.0),
    "kg": ("mass", 1e9, 0.0), "kilogram": ("mass", 1e9, 0.0), "kilograms": ("mass", 1e9, 0.0),
    "ng": ("mass", 1e-3, 0.0), "nanogram": ("mass", 1e-3, 0.0), "nanograms": ("mass", 1e-3, 0.0),
    "iu": ("iu", 1.0, 0.0), "unit": ("iu", 1.0, 0.0), "units": ("iu", 1.0, 0.0), "miu": ("iu", 1e6, 0.0),
    "%": ("percent", 1e4, 0.0), "ppm": ("fraction", 1.0, 0.0),
}
VOLUMES = {"ml": 1.0, "mls": 1.0, "millilitre": 1.0, "millilitres": 1.0, "milliliter": 1.0, "cc": 1.0, "l": 1e3, "ltr": 1e3, "litre": 1e3, "litres": 1e3, "liter": 1e3}
WEIGHTS = {"g": 1.0, "gm": 1.0, "gram": 1.0, "kg": 1e3, "kilogram": 1e3}
SCALES = {"lakh": 1e5, "lakhs": 1e5, "lac": 1e5, "lacs": 1e5, "million": 1e6, "crore": 1e7, "thousand": 1e3}

_NUMBER = r"[0-9]+(?:\.[0-9]+)?|\.[0-9]+"
_any = lambda names: "|".join(sorted((n for n in names if n != "%"), key=lambda n: (-len(n), n)))
_UNIT = rf"(?:{_any(UNITS)})\b|%"
#: unit before, number, scale word, unit after, w/w or w/v, amount of volume, volume unit, weight unit
QUANTITY = (
    rf"(?:\b({_any(UNITS)})\.? )?({_NUMBER}) ?-? ?(?:({_any(SCALES)}) )?({_UNIT})?\.?(?: ?\(?(w ?/ ?w|w ?/ ?v|v ?/ ?v)\b\)?)?"
    rf"(?: ?(?:/|per\b|in\b) ?(?:({_NUMBER}) ?-? ?)?({_any(VOLUMES)})\b| ?(?:/|per\b) ?({_any(WEIGHTS)})\b)?"
)
#: a unit named in running text; a lone g counts only after a word that introduces it
TEXT_UNIT = r"\b(micrograms?|milligrams?|nanograms?|grams?|mcg|ug|mg|mgs|gms?|iu|international units)\b|(?:\bin|\bare|\bunit:|\bquantities) (g)\b"
_BARE = r"^[0-9.,/+& -]+$"


def plain(text: Column) -> Column:
    """Lower case, single blanks, one spelling of micro, IU, percent and ppm, and decimal points in numbers."""
    t = F.translate(F.lower(squeeze(text)), "µμ", "uu")
    t = F.regexp_replace(t, r"(?<![a-z])i\. ?u\.?", "iu")
    t = F.regexp_replace(t, r"international units?", "iu")
    t = F.regexp_replace(t, r"parts per million", "ppm")
    t = F.regexp_replace(t, r"per ?cent\b", "%")
    t = F.regexp_replace(t, r"(?<![0-9.,])([1-9][0-9]{0,2}),([0-9]{3}),([0-9]{3})(?![0-9])", "$1$2$3")
    t = F.regexp_replace(t, r"(?<![0-9.,])([1-9][0-9]{0,2}),([0-9]{3})(?![0-9])", "$1$2")
    return F.regexp_replace(t, r"([0-9]),([0-9])", "$1.$2")


def unit_table(spark: SparkSession) -> DataFrame:
    """The alias table; its size is fixed by UNITS."""
    return spark.createDataFrame([(a, *v) for a, v in UNITS.items()], "alias string, dimension string, factor double, `offset` double")


def _lookup(names: dict[str, float], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), key)


def quantities(rows: DataFrame, keep: list[str], strength: Column, text: Column, default: Column | None = None) -> DataFrame:
    """``keep..., pos, amount, unit``: one row per quantity of the strength, in the order written.

    unit is mcg, mcg/ml, mcg/g, iu or iu/ml; a percentage is weight per volume unless it says w/w. ``default`` is the
    source's unit for bare numbers, none by default. Null, blank and wordy strengths, and numbers whose unit stays
    unknown, give no row. Amounts are rounded to whole units.
    """
    part = lambda i, groups=F.col("q"): F.nullif(F.get(groups, F.lit(i - 1)), F.lit(""))
    found = rows.filter(strength.rlike("[0-9]")).select(*keep, plain(strength).alias("s"), text.alias("t"))
    # the pattern is gone through once a quantity; its groups come out together
    groups = lambda q: F.split(F.regexp_replace(q, QUANTITY, "\u0001".join(f"${i}" for i in range(1, 9))), "\u0001")
    found = found.withColumn("qs", F.transform(F.regexp_extract_all("s", F.lit(QUANTITY), F.lit(0)), groups)).filter(F.size("qs") > 0)
    last = F.element_at("qs", -1)
    found = found.withColumn("last_unit", F.coalesce(part(4, last), part(1, last)))
    named = F.lower(F.translate("t", "µμ", "uu"))
    in_text = F.regexp_replace(F.coalesce(F.nullif(F.regexp_extract(named, TEXT_UNIT, 1), F.lit("")), F.nullif(F.regexp_extract(named, TEXT_UNIT, 2), F.lit(""))), "international units", "iu")
    bare = F.when(F.col("s").rlike(_BARE), F.coalesce(in_text, default if default is not None else F.lit(None).cast("string")))
    found = found.withColumn("spare_unit", F.coalesce("last_unit", bare)).select(*keep, "spare_unit", F.posexplode("qs").alias("at", "q"))
    found = found.withColumn("alias", F.coalesce(part(4), part(1), "spare_unit"))
    read = found.join(F.broadcast(unit_table(rows.sparkSession)), "alias").select(
        *keep, "at", "dimension", "factor", "offset",
        part(2).cast("double").alias("n"), F.coalesce(_lookup(SCALES, part(3)), F.lit(1.0)).alias("scale"), F.regexp_replace(part(5), " ", "").alias("basis"),
        F.coalesce(part(6).cast("double"), F.lit(1.0)).alias("per"), _lookup(VOLUMES, part(7)).alias("ml"), _lookup(WEIGHTS, part(8)).alias("g"),
    )
    base = F.col("n") * F.col("scale") * F.col("factor") + F.col("offset")
    unit = (
        F.when((F.col("dimension") == "percent") & (F.coalesce("basis", F.lit("w/v")) == "w/v"), F.lit("mcg/ml"))
        .when((F.col("dimension") == "percent") & (F.col("basis") == "w/w"), F.lit("mcg/g"))
        .when(F.col("dimension") == "fraction", F.lit("mcg/g"))
        .when((F.col("dimension") == "mass") & F.col("ml").isNotNull(), F.lit("mcg/ml"))
        .when((F.col("dimension") == "mass") & F.col("g").isNotNull(), F.lit("mcg/g"))
        .when(F.col("dimension") == "mass", F.lit("mcg"))
        .when((F.col("dimension") == "iu") & F.col("ml").isNotNull(), F.lit("iu/ml"))
        .when((F.col("dimension") == "iu") & F.col("g").isNull(), F.lit("iu"))
    )
    out = read.withColumn("unit", unit).filter(F.col("unit").isNotNull() & ((F.col("per") > 0) | F.col("ml").isNull()))
    amount = F.when(F.col("dimension").isin("mass", "iu"), base / F.coalesce(F.col("per") * F.col("ml"), F.col("g"), F.lit(1.0))).otherwise(base)
    return out.select(*keep, F.col("at").alias("pos"), F.round(amount).cast("bigint").alias("amount"), "unit")
