"""Best representative of each duplicate group: token-level consensus by progressive alignment and weighted votes.

The values of a group are aligned one after the other, heaviest first, to a growing profile of token columns; each
value votes with its weight for its token, or with a part of it for a gap, in every column; the winning tokens are the
consensus, and the existing value closest to it survives, the preferred of equally close ones.

Equal values of a group vote once, as their best copy. A value's weight falls by RATIO with every place in the order of
preference: the preferred value outvotes any two others, but not all of them where they agree. Gaps weigh GAP, so that
what one value has more is not lost to the many that lack it. The weight is zero from the place on where it is below
half a unit in the last place of the first one's (VOTERS), which no sum of votes can tell from nothing. So a group of
any size is decided by its VOTERS preferred values, found by a limit per group that is applied before the shuffle; all
other values still compete for being closest, each where it lies.
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medloom import scale

#: Weight of a value over the one before it in the order of preference, and of a vote for a gap.
RATIO, GAP = 0.55, 0.8
#: Values that have a weight at all.
VOTERS = math.ceil(53 / -math.log2(RATIO))

_TOKEN = re.compile(r"\w+|[^\w\s]")


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of positions of a longest common subsequence, by bit-parallel dynamic programming."""
    n = len(a)
    places: dict[str, int] = {}
    for i, t in enumerate(a):
        places[t] = places.get(t, 0) | 1 << i
    full = (1 << n) - 1
    v, rows = full, []
    for t in b:
        u = v & places.get(t, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    pairs, i, j = [], n - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if a[i] == b[j]:
            pairs.append((i, j))
            i, j = i - 1, j - 1
        elif rows[j] >> i & 1:  # a[i] adds nothing to what b[: j + 1] has in common with a[:i]
            i -= 1
        else:
            j -= 1
    return pairs[::-1]


def consensus(values: list[list[str]], weights: list[float], gap: float = GAP) -> list[str]:
    """Winning tokens of the profile to which the values are aligned in the given order. Ties fall to what was there first, tokens before gaps."""
    columns: list[dict[str | None, float]] = []
    total = 0.0
    for tokens, weight in zip(values, weights):
        leading = [max((t for t in c if t is not None), key=c.get) for c in columns]
        pairs = align(leading, tokens)
        merged, i, j = [], 0, 0
        for ci, tj in [*pairs, (len(columns), len(tokens))]:
            # what stands between two agreeing places is paired in order: it differs, but means the same place
            free, new = columns[i:ci], tokens[j:tj]
            for c, t in zip(free, new):
                c[t] = c.get(t, 0.0) + weight
            for c in free[len(new) :]:
                c[None] = c.get(None, 0.0) + gap * weight
            merged.extend(free)
            merged.extend({t: weight, None: gap * total} for t in new[len(free) :])
            if ci < len(columns):
                c = columns[ci]
                c[tokens[tj]] = c.get(tokens[tj], 0.0) + weight
                merged.append(c)
            i, j = ci + 1, tj + 1
        columns, total = merged, total + weight
    winners = (max(c, key=lambda t: (c[t], t is not None)) for c in columns)
    return [t for t in winners if t is not None]


def agreed(texts: list[str]) -> list[str]:
    """Consensus of texts in order of preference; of one text its own tokens."""
    return consensus([_TOKEN.findall(t) for t in texts[:VOTERS]], [RATIO**i for i in range(len(texts))])


def closeness(tokens: list[str], text: str) -> float:
    """Share of the tokens of both that a longest common subsequence holds; 1 for equal ones."""
    mine = _TOKEN.findall(text)
    return 1.0 if mine == tokens else 2 * len(align(tokens, mine)) / max(1, len(tokens) + len(mine))


def survivor(texts: list[str]) -> int:
    """Position of the text closest to the consensus of texts given in order of preference."""
    tokens = agreed(texts)
    near = [closeness(tokens, t) for t in texts]
    return near.index(max(near))


def _choose(groups: pd.Series) -> pd.Series:
    return pd.Series([0 if g is None else survivor(list(g)) for g in groups], dtype="int32")


def _agree(groups: pd.Series) -> pd.Series:
    return pd.Series([agreed(list(g)) for g in groups])


def _near(tokens: pd.Series, texts: pd.Series) -> pd.Series:
    return pd.Series([closeness(list(a), t) for a, t in zip(tokens, texts)], dtype="float64")


def survivors(values: DataFrame, group: list[str], value: str, order: list[Column], keep: list[str]) -> DataFrame:
    """One row per group: ``group..., keep...`` of the value that survives.

    ``order`` ranks values, the preferred first, by Columns that sort descending; together they must be total, or ties
    fall to the greatest ``value``. Null values don't take part; a group without values gives no row.
    """
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    known = values.filter(F.col(value).isNotNull()).select(*group, F.col(value).alias("v"), rank.alias("rank"), F.struct(*keep).alias("kept"))
    best = known.groupBy(*group, "v").agg(F.max(F.struct("rank", "kept")).alias("top")).select(*group, "v", "top.rank", "top.kept")
    best = scale.materialize(best)
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("rank"), F.desc("v")))
    leading = best.withColumn("place", place).filter(F.col("place") <= VOTERS + 1)
    lists = scale.materialize(leading.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("place", "v", "kept"))).alias("l")))

    # groups that are whole in their list are decided there
    whole = lists.filter(F.size("l") <= VOTERS)
    at = F.pandas_udf(_choose, "int")(F.when(F.size("l") > 1, F.transform("l", lambda x: x["v"])))
    small = whole.withColumn("at", at).select(*group, F.element_at("l", F.col("at") + 1)["kept"].alias("kept"))
    # of the others each value is measured against the consensus where it lies
    large = lists.filter(F.size("l") > VOTERS).select(*group, F.pandas_udf(_agree, "array<string>")(F.transform("l", lambda x: x["v"])).alias("tokens"))
    large = scale.materialize(large)
    measured = scale.lookup_join(best, large, group, "inner").withColumn("near", F.pandas_udf(_near, "double")("tokens", "v"))
    chosen = measured.groupBy(*group).agg(F.max(F.struct("near", "rank", "v", "kept")).alias("x")).select(*group, F.col("x.kept").alias("kept"))
    return small.unionAll(chosen).select(*group, "kept.*")
