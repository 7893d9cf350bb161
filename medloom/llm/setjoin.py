"""Free-typed values mapped to a canonical list: set-similarity join with prefix, length and positional filters.

A value is the set of its letters and of the letter pairs of its words, so typing errors change few tokens and the
order of words none. Abbreviations are made from the list by rule, as further names of its entries. Tokens are ordered by global rarity; only the rare prefix that two sets of sufficient Jaccard
similarity must share is joined, candidates are thinned by length and position, verified exactly, and the best is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom import scale
from medloom.functions.columns import SPACE, bound, squeeze

#: Least Jaccard similarity of a match: one wrong, missing, doubled or swapped letter in a word of five is 0.57.
THRESHOLD = 0.55

#: Other words for a word of a form's name.
SYNONYMS = {
    "eye": ("ophthalmic",), "ear": ("otic",), "nasal": ("nose", "intranasal"), "mouthwash": ("mouth wash", "mouth rinse"), "inhaler": ("inhalation",), "injection": ("injectable",),
    "nebuliser": ("nebulizer",), "syrup": ("sirup",),
}

#: Shortest abbreviation; words of a name up to which all of them are abbreviated together.
SHORTEST, PRODUCT = 3, 3

#: Words that describe a form's make, route or package and don't decide which form it is.
MODIFIERS = (
    "bottle", "bottles", "tube", "tubes", "vial", "vials", "ampoule", "film", "coated", "uncoated", "chewable", "dispersible", "effervescent", "hard", "soft",
    "gelatin", "gelatine", "dry", "topical", "skin", "vanishing", "throat", "vaginal", "rectal", "metered", "dose", "mdi", "im", "iv", "for", "use", "the", "of", "medicated",
    "ml", "g", "gm", "mg", "l",
)


def normal_form(value: Column) -> Column:
    """Letters in lower case, words in single blanks; sizes, initials' stops and modifiers gone."""
    t = F.regexp_replace(F.lower(value), r"\b(?:i\.m|i\.v)\b\.?", " ")
    t = F.regexp_replace(t, r"[^\p{L}\p{M}]+", " ")
    t = F.regexp_replace(t, r"\b(?:" + "|".join(MODIFIERS) + r")\b", " ")
    return squeeze(t)


def short_forms(word: Column, synonyms: dict[str, tuple[str, ...]] = SYNONYMS) -> Column:
    """What a word may be written as: itself, in the other number, its beginnings, its consonants, its synonyms."""
    n = F.length(word)
    number = F.when(word.endswith("s"), F.substring(word, F.lit(1), n - 1)).otherwise(F.concat(word, F.lit("s")))
    starts = F.when(n > SHORTEST, F.transform(F.sequence(F.lit(SHORTEST), n - 1), lambda i: F.substring(word, F.lit(1), i))).otherwise(F.array().cast("array<string>"))
    bones = F.concat(F.substring(word, F.lit(1), F.lit(1)), F.regexp_replace(F.substring(word, F.lit(2), n), "[aeiou]", ""))
    others = F.array().cast("array<string>")
    for known, names in synonyms.items():
        others = F.when(word == known, F.array(*map(F.lit, names))).otherwise(others)
    return F.array_distinct(F.filter(F.concat(F.array(word, number, bones), starts, others), lambda x: F.length(x) >= F.least(F.lit(SHORTEST), n)))


def short_names(references: DataFrame, synonyms: dict[str, tuple[str, ...]] = SYNONYMS) -> DataFrame:
    """``ref_id, name``: the names (in normal form) and their abbreviations by rule: every word in its short forms, and any word alone that only one reference has.

    An abbreviation that stands for several references stands for none.
    """
    named = references.filter(F.col("name") != "").select("ref_id", "name").distinct()
    words = F.split("name", " ")
    whole = F.aggregate(words, F.array(F.lit("")), lambda acc, w: F.flatten(F.transform(acc, lambda a: F.transform(short_forms(w, synonyms), lambda o: F.concat(a, F.lit(" "), o)))))
    every = named.filter(F.size(words) <= PRODUCT).select("ref_id", F.explode(whole).alias("name")).select("ref_id", F.trim("name").alias("name"))
    each = named.select("ref_id", F.explode(words).alias("word")).distinct()
    telling = each.groupBy("word").agg(F.min("ref_id").alias("ref_id"), F.max("ref_id").alias("other")).filter("ref_id = other")
    alone = telling.select("ref_id", F.explode(short_forms(F.col("word"), synonyms)).alias("name"))
    made = every.unionAll(alone).groupBy("name").agg(F.min("ref_id").alias("ref_id"), F.max("ref_id").alias("other")).filter("ref_id = other").select("ref_id", "name")
    return named.unionAll(made.join(named.select("name"), "name", "left_anti").select("ref_id", "name"))


def letter_tokens(value: Column) -> Column:
    """Letters and padded letter pairs of all words, each with its number of occurrence: a set that counts repeats."""
    words = F.filter(F.split(value, " "), lambda w: w != "")
    letters = F.filter(F.split(F.regexp_replace(value, " ", ""), ""), lambda c: c != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("^"), w, F.lit("$")))
    pairs = F.flatten(F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substring(w, i, F.lit(2)))))
    return bound(F.array_sort(F.concat(letters, pairs)), lambda every: F.transform(every, lambda t, i: F.concat(t, F.lit("#"), (i - F.array_position(every, t)).cast("string"))))


def similarity_join(values: DataFrame, references: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``v, ref_id, similarity``: for each value the reference of the highest Jaccard similarity, at least ``threshold``.

    values: distinct ``v``; references: ``ref_id, name`` with any number of names each. Ties fall to the smaller
    ref_id. Values without letters match nothing. Both sides are tokenised by letter_tokens.
    """
    # references are few and values distinct, but neither is broadcast unless Spark measures it small
    left = values.filter(F.col("v").isNotNull()).select(F.lit(0).alias("side"), F.lit(None).cast("bigint").alias("ref_id"), "v")
    right = references.filter(F.col("name").isNotNull()).select(F.lit(1).alias("side"), "ref_id", F.col("name").alias("v")).distinct()
    # filtered by the value, not by its tokens: a filter on tokens would be pushed down and tokenise every row
    sets = scale.materialize(left.unionAll(right).filter(F.col("v") != "").withColumn("tokens", letter_tokens(F.col("v"))))
    exploded = sets.select("side", "ref_id", "v", F.explode("tokens").alias("token"))
    frequency = exploded.groupBy("token").agg(F.count("*").alias("df"))
    ordered = (
        scale.lookup_join(exploded, scale.materialize(frequency), ["token"])
        .groupBy("side", "ref_id", "v")
        .agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("s"))
        .select("side", "ref_id", "v", F.transform("s", lambda x: x["token"]).alias("tokens"), F.size("s").alias("n"))
    )
    ordered = scale.materialize(ordered)
    prefix = F.slice("tokens", F.lit(1), F.col("n") - F.ceil(F.col("n") * F.lit(threshold)).cast("int") + 1)
    heads = ordered.select("side", "ref_id", "v", "tokens", "n", F.posexplode(prefix).alias("pos", "token"))
    a = heads.filter("side = 0").select(F.col("v"), F.col("tokens").alias("ta"), F.col("n").alias("na"), F.col("pos").alias("pa"), "token")
    b = heads.filter("side = 1").select("ref_id", F.col("tokens").alias("tb"), F.col("n").alias("nb"), F.col("pos").alias("pb"), "token")
    least = F.lit(threshold / (1 + threshold)) * (F.col("na") + F.col("nb"))
    fits = (F.col("nb") >= F.col("na") * threshold) & (F.col("na") >= F.col("nb") * threshold)
    # with this token met at these positions, no more than it and what follows can be shared, nor fewer rare ones before
    near = F.least(F.col("pa"), F.col("pb")) + 1 + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) - 1 >= least - 1e-9
    pairs = a.join(b, "token").filter(fits & near).select("v", "ref_id", "ta", "tb", "na", "nb").distinct()
    shared = F.size(F.array_intersect("ta", "tb"))
    scored = pairs.withColumn("similarity", shared / (F.col("na") + F.col("nb") - shared)).filter(F.col("similarity") >= threshold - 1e-12)
    best = scored.groupBy("v").agg(F.max(F.struct("similarity", (-F.col("ref_id")).alias("m"))).alias("x"))
    return best.select("v", (-F.col("x.m")).alias("ref_id"), F.col("x.similarity").alias("similarity"))


def map_to_list(rows: DataFrame, keep: list[str], value: str, references: DataFrame, threshold: float = THRESHOLD, synonyms: dict[str, tuple[str, ...]] = SYNONYMS) -> DataFrame:
    """``keep..., ref_id``: every row whose value is neither blank nor exactly a reference's name; 0 where none fits.

    references: ``ref_id, name``. Values are reduced to distinct normal forms before the join, and rows get their answer
    back however often a value repeats.
    """
    exact = scale.materialize(references.filter(F.col("name").isNotNull()).select(F.col("name").alias(value), F.lit(True).alias("exact")).distinct())
    typed = scale.lookup_join(rows.filter(~F.col(value).rlike(r"^[\s\u00a0]*$")), exact, [value]).filter("exact is null").select(*keep, normal_form(F.col(value)).alias("v"))
    names = scale.materialize(short_names(references.select("ref_id", normal_form(F.col("name")).alias("name")), synonyms))
    found = scale.materialize(similarity_join(scale.materialize(typed.select("v").distinct()), names, threshold))
    return scale.lookup_join(typed, found.select("v", "ref_id"), ["v"]).select(*keep, F.coalesce("ref_id", F.lit(0)).alias("ref_id"))
