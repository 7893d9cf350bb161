"""Several values packed in one field: delimiter skeletons, one splitting rule per skeleton, positional extraction.

Ordinary characters are masked, so that millions of texts share a few thousand skeletons such as ``a, a & a``.
Each distinct skeleton is resolved once into the positions of its values (quotes and brackets protect what they
hold); the rules are joined back, broadcast if they measure small, and values are cut out by position.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom import scale
from medloom.functions.columns import SPACE, bound

#: Characters and words that stand between two values, and pairs that protect what is between them.
DELIMITERS = "+＋&/|;,\t\n\r"
JOINERS = ("and", "with", "plus")
PAIRS = {'"': '"', "“": "”", "'": "'", "(": ")", "[": "]"}

_BLANK = r"[ \x0b\x0c\u0085\u00a0\u1680\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]"
_SPECIAL = r"+\uff0b&/|;,\t\n\r\x22\u201c\u201d'()\[\]"
_WORD = rf"[^{_SPECIAL}{_BLANK[1:-1]}\u0001]+"
_JOIN = rf"(?i)(?<={SPACE})(?:{'|'.join(JOINERS)})(?={SPACE})"
_TOKEN = rf"(?i)(?<={SPACE})(?:{'|'.join(JOINERS)})(?={SPACE})|{_WORD}(?:{_BLANK}+(?!(?:{'|'.join(JOINERS)}){SPACE}){_WORD})*|{_BLANK}+|[{_SPECIAL}\u0001]"
_CANDIDATE = rf"[+\uff0b&/|;,\t\n\r]|{_JOIN}"
_EDGE = "\"\u201c\u201d'.,;: \t\n\x0b\x0c\r"


def plain_blanks(text: Column) -> Column:
    """Runs of blanks as one; tabs and line ends, which may part values, stay."""
    return F.regexp_replace(text, _BLANK + "+", " ")


def skeleton(text: Column) -> Column:
    """One character per token of a text with plain blanks: 'a' for words, \\u0001 for a joining word, else the character itself."""
    return F.regexp_replace(F.regexp_replace(text, _JOIN, "\u0001"), rf"{_WORD}(?: {_WORD})*", "a")


def spans(shape: str) -> list[tuple[int, int]]:
    """Token positions (first, one past last) of the values of a skeleton."""
    edge = set(DELIMITERS) | {"\u0001", " "}
    found, start, i = [], 0, 0
    while i <= len(shape):
        c = shape[i] if i < len(shape) else ","
        if c in PAIRS and (c in "([" or i == 0 or shape[i - 1] in edge or shape[i - 1] in "(["):
            i = _closed(shape, i, c, edge) + 1
            continue
        if i == len(shape) or c == "\u0001" or c in DELIMITERS:
            if "a" in shape[start:i]:
                found.append((start, i))
            start = i + 1
        i += 1
    return found


def _closed(shape: str, i: int, c: str, edge: set[str]) -> int:
    """Where the pair opened at i closes; i itself if it never does."""
    depth = 0
    for j in range(i + 1, len(shape)):
        if c in "([":
            if shape[j] == c:
                depth += 1
            elif shape[j] == PAIRS[c]:
                if not depth:
                    return j
                depth -= 1
        elif shape[j] == PAIRS[c] and (j + 1 == len(shape) or shape[j + 1] in edge or shape[j + 1] in ")]a"):
            return j
    return i


def _resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rules = [spans(s) for s in batch["skeleton"]]
        yield pd.DataFrame({"skeleton": batch["skeleton"], "starts": [[a + 1 for a, _ in r] for r in rules], "lengths": [[b - a for a, b in r] for r in rules]})


def splitting_rules(skeletons: DataFrame) -> DataFrame:
    """Rules of distinct skeletons: ``skeleton, starts, lengths`` (1-based token positions)."""
    return skeletons.select("skeleton").distinct().mapInPandas(_resolve, "skeleton string, starts array<int>, lengths array<int>")


def clean(value: Column) -> Column:
    """Whitespace runs as one blank; outer blanks, quotes and . , ; : removed; case kept. For texts with plain blanks."""
    flat = F.translate(value, "\t\n\r", "   ")  # only what quotes and brackets held
    return F.btrim(F.when(F.contains(flat, F.lit("  ")), F.regexp_replace(flat, " +", " ")).otherwise(flat), F.lit(_EDGE))


def extract(text: Column, starts: Column, lengths: Column) -> Column:
    """The values of a text by the positions of its rule, cleaned; empty places are none."""
    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    cut = bound(tokens, lambda t: F.zip_with(starts, lengths, lambda a, n: clean(F.array_join(F.slice(t, a, n), ""))))
    return F.filter(cut, lambda v: v != "")


def split_fields(rows: DataFrame, key: str, fields: list[str], limit: int = scale.BROADCAST_BYTES) -> DataFrame:
    """``key, field_name, pos, val``: all values of each field that packs two or more into one string.

    A field is a string or an array of strings; in an array one packed element makes all its values come out, and
    pos counts through the whole array. Null and blank fields and elements hold no value; a repeated row comes out
    repeatedly. Texts of any length are split whole.
    """
    kinds = dict(rows.dtypes)
    asked = [F.struct(F.lit(f).alias("f"), (F.col(f"`{f}`") if kinds[f].startswith("array") else F.array(f"`{f}`")).alias("v")) for f in fields]
    row = F.monotonically_increasing_id()
    listed = rows.select(F.col(f"`{key}`").alias("k"), row.alias("r"), F.explode(F.filter(F.array(*asked), lambda s: F.exists(s["v"], lambda e: e.rlike(_CANDIDATE)))).alias("s"))
    # skeletons are found once and written beside the texts, as both the rules and the cut ask for them
    elements = listed.select("k", "r", F.col("s.f").alias("f"), F.size("s.v").alias("n"), F.posexplode("s.v").alias("o", "e")).filter(F.col("e").isNotNull())
    elements = scale.materialize(elements.select("k", "r", "f", "n", "o", plain_blanks(F.col("e")).alias("e")).withColumn("skeleton", skeleton(F.col("e"))))
    rules = scale.materialize(splitting_rules(elements))
    # one element needs no regrouping; arrays of more are put together again after the join
    single, several = elements.filter("n = 1").select("k", "f", "e", "skeleton"), elements.filter("n > 1").select("k", "r", "f", "o", "e", "skeleton")
    values = extract(F.col("e"), F.col("starts"), F.col("lengths"))
    cut = lambda df: scale.lookup_join(df, rules, ["skeleton"], limit=limit).withColumn("vs", values)
    alone = cut(single).filter(F.size("vs") > 1).select("k", "f", "vs")
    grouped = (
        cut(several)
        .groupBy("k", "r", "f")
        .agg(F.array_sort(F.collect_list(F.struct("o", "vs"))).alias("l"), F.max(F.size("vs")).alias("most"))
        .filter(F.col("most") > 1)
        .select("k", "f", F.flatten(F.transform("l", lambda x: x["vs"])).alias("vs"))
    )
    return alone.unionAll(grouped).select(F.col("k").alias(key), F.col("f").alias("field_name"), F.posexplode("vs").alias("pos", "val"))
