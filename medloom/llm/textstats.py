"""Per-document text statistics, their exact ranks within each language, and scores from tail probabilities.

Equal values are counted before any shuffle. The distinct values are range-partitioned and sorted by language,
statistic and value; every partition runs through its values once, and offsets per partition turn positions into
exact global ranks. Both tails of the empirical distribution are combined over the statistics as Fisher's sum: plainly
in outlier_scores, and with weights in kind_scores, where each kind of text has a score of its own and the highest says
what a text is. Statistics are ratios in steps and counts with few digits (a part of their definition), so the table of
ranks is bounded by statistics, steps and languages, not by documents; no text is moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medloom import scale
from medloom.functions.columns import SPACE
from medloom.llm.textkind import FUNCTION_WORDS, SHAPE, shape

STATISTICS = ("n_words", "mean_word_length", "symbol_ratio", "ended_lines", "common_words")

KINDS = ("prose", "list", "table", "junk")
#: Labelled documents that the weights of the kinds are fitted on, at most.
LABELS = 3_000
#: What is supposed before any label is seen: kind, tail, statistic, weight.
SUPPOSED = (
    ("prose", "high", "flowing_lines", 1.0), ("prose", "high", "common_words", 0.5),
    ("list", "low", "flowing_lines", 0.5), ("list", "high", "short_lines", 0.5), ("list", "high", "marked_lines", 0.5), ("list", "low", "words_a_line", 0.3),
    ("table", "high", "regular_lines", 1.0), ("table", "high", "digit_ratio", 0.5),
    ("junk", "high", "odd_words", 0.3), ("junk", "high", "navigation_words", 0.5), ("junk", "high", "long_tokens", 0.5), ("junk", "low", "distinct_lines", 0.5),
    ("junk", "low", "common_words", 0.3), ("junk", "high", "symbol_ratio", 0.3),
)


def language_key(lang: Column) -> Column:
    """'EN ', 'en-IN' -> 'en'; null and blank -> 'und'."""
    return F.coalesce(F.nullif(F.lower(F.regexp_extract(lang, "([A-Za-z]+)", 1)), F.lit("")), F.lit("und"))


def statistics(documents: DataFrame) -> DataFrame:
    """``doc_id, lang`` and STATISTICS of every document (``doc_id, text, lang``) whose text is not null.

    A text without words has zeros. Ratios are rounded to four places, so that equal values can be counted together.
    """
    flat = F.trim(F.regexp_replace("text", SPACE + "+", " "))
    rows = documents.filter(F.col("text").isNotNull()).select("doc_id", language_key(F.col("lang")).alias("lang"), "text", flat.alias("flat"))
    words = F.filter(F.split("flat", " "), lambda w: w != "")
    rows = rows.withColumn("words", words).withColumn("n", F.size("words")).withColumn("ink", F.length("flat") - F.greatest(F.col("n") - 1, F.lit(0)))
    ratio = lambda a, b: F.when(b > 0, F.round(a / b, 4)).otherwise(F.lit(0.0))
    symbols = F.length(F.regexp_replace("flat", r"[\p{L}\p{M}\p{N} ]+", ""))
    lines = F.regexp_count("text", F.lit(r"(?m)^.*\S.*$"))
    ended = F.regexp_count("text", F.lit("(?m)[.!?।…;:][\"')\\]”’]*[ \\t\\r]*$"))
    common = F.size(F.filter("words", lambda w: F.lower(w).isin(*sorted(FUNCTION_WORDS))))
    return rows.select(
        "doc_id", "lang",
        F.col("n").cast("double").alias("n_words"), ratio(F.col("ink"), F.col("n")).alias("mean_word_length"), ratio(symbols, F.col("ink")).alias("symbol_ratio"),
        ratio(ended, lines).alias("ended_lines"), ratio(common, F.col("n")).alias("common_words"),
    )


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part, group, total = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not len(batch):
            continue
        key = batch["lang"] + "\u0001" + batch["stat"].astype(str)
        upto = batch.groupby(key, sort=False)["n"].cumsum()
        if key.iloc[0] == group:
            upto = upto + total * (key == group)
        group, total = key.iloc[-1], int(upto.iloc[-1])
        yield pd.DataFrame({"part": part, "lang": batch["lang"], "stat": batch["stat"], "value": batch["value"], "n": batch["n"], "upto": upto}).astype({"part": "int32"})


def tails(values: DataFrame) -> DataFrame:
    """``lang, stat, value, low, high``: share of a language's documents with at most, and with at least, this value. Exact."""
    counts = values.groupBy("lang", "stat", "value").agg(F.count("*").alias("n"))
    ordered = counts.repartitionByRange(scale.partitions(values.sparkSession), "lang", "stat", "value").sortWithinPartitions("lang", "stat", "value")
    kind = dict(values.dtypes)["stat"]
    run = scale.materialize(ordered.mapInPandas(_running, f"part int, lang string, stat {kind}, value double, n bigint, upto bigint"))
    parts = run.groupBy("lang", "stat", "part").agg(F.sum("n").alias("held"))  # a row per partition and group that meet
    before = Window.partitionBy("lang", "stat").orderBy("part")
    offsets = parts.select("lang", "stat", "part", (F.sum("held").over(before) - F.col("held")).alias("offset"), F.sum("held").over(Window.partitionBy("lang", "stat")).alias("total"))
    ranked = scale.lookup_join(run, scale.materialize(offsets), ["lang", "stat", "part"])
    upto = F.col("offset") + F.col("upto")
    return ranked.select("lang", "stat", "value", (upto / F.col("total")).alias("low"), ((F.col("total") - upto + F.col("n")) / F.col("total")).alias("high"))


def outlier_scores(documents: DataFrame) -> DataFrame:
    """``doc_id, lang``, STATISTICS and ``outlier_score`` of every document with a text. Repeated doc_ids are scored as one."""
    stats = scale.materialize(statistics(documents))
    long_ = stats.select("doc_id", "lang", F.inline(F.array(*[F.struct(F.lit(s).alias("stat"), F.col(s).alias("value")) for s in STATISTICS])))
    both = scale.lookup_join(long_, scale.materialize(tails(long_)), ["lang", "stat", "value"])
    tail = F.least(F.lit(1.0), 2 * F.least("low", "high"))
    scores = both.groupBy("doc_id").agg(F.round(F.sum(-F.log(tail)), 6).alias("outlier_score"))
    return stats.join(scores, "doc_id")


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = [shape(t) for t in batch["text"].to_pylist()]
        columns = np.array(held, dtype="float64").reshape(len(held), len(SHAPE)).T
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["lang"], *(pa.array(c) for c in columns)], names=["doc_id", "lang", *SHAPE])


def shapes(documents: DataFrame) -> DataFrame:
    """``doc_id, lang`` and SHAPE of every document whose text is not null; texts are read once, whole, and not moved."""
    rows = documents.filter(F.col("text").isNotNull()).select("doc_id", language_key(F.col("lang")).alias("lang"), "text")
    return rows.mapInArrow(_shapes, "doc_id bigint, lang string, " + ", ".join(f"{s} double" for s in SHAPE))


def _long(rows: DataFrame, keep: list[str]) -> DataFrame:
    return rows.select(*keep, F.inline(F.array(*[F.struct(F.lit(i).alias("stat"), F.col(s).alias("value")) for i, s in enumerate(SHAPE)])))


def prior() -> np.ndarray:
    """What is supposed of the kinds before any label is seen: a constant, low tails, high tails x KINDS."""
    weights = np.zeros((1 + 2 * len(SHAPE), len(KINDS)))
    weights[0, 0] = 2.0
    for kind, tail, name, weight in SUPPOSED:
        weights[1 + SHAPE.index(name) + (len(SHAPE) if tail == "high" else 0), KINDS.index(kind)] = weight
    return weights


def fit_kinds(tails_: np.ndarray, kinds: np.ndarray, ridge: float = 2.0) -> np.ndarray:
    """Weights of a multinomial logistic regression of kinds on -log tails (low ones, then high ones), drawn to the prior."""
    x = np.c_[np.ones(len(tails_)), tails_]
    p, k, start = x.shape[1], len(KINDS), prior()
    w, wanted, shrink = start.copy(), np.eye(k)[kinds], np.r_[0.1, np.full(p - 1, ridge)]

    def loss(w: np.ndarray) -> float:
        z = x @ w
        top = z.max(1, keepdims=True)
        return float((np.log(np.exp(z - top).sum(1)) + top[:, 0] - z[np.arange(len(kinds)), kinds]).sum() + 0.5 * (shrink[:, None] * (w - start) ** 2).sum())

    for _ in range(40):
        z = x @ w
        share = np.exp(z - z.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        slope = x.T @ (share - wanted) + shrink[:, None] * (w - start)
        bend = np.kron(np.eye(k), np.diag(shrink))
        for a in range(k):
            for b in range(k):
                bend[a * p : (a + 1) * p, b * p : (b + 1) * p] += x.T @ (x * (share[:, a] * ((a == b) - share[:, b]))[:, None])
        step, size, now = np.linalg.solve(bend, slope.T.ravel()).reshape(k, p).T, 1.0, loss(w)
        while size > 1e-3 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if abs(size * step).max() < 1e-5:
            break
    return w


def kind_scores(documents: DataFrame, labels: DataFrame, sample: int = LABELS) -> DataFrame:
    """``doc_id`` and a score for each of KINDS: the tail probabilities of its SHAPE in its language, combined.

    Ranks are those of the distinct shapes of a language, so copies of a text count once however many there are. A
    score is a weighted Fisher sum of both tails of all statistics; the weights are fitted on at most ``sample``
    labelled documents, drawn by hash (``doc_id, kind``; documents whose labels disagree are left out). Without labels
    what is supposed beforehand decides. Every document with a text is scored.
    """
    held = scale.materialize(shapes(documents))
    ranks = scale.materialize(tails(_long(held.select("lang", *SHAPE).distinct(), ["lang"])).withColumn("low", -F.log("low")).withColumn("high", -F.log("high")))

    known = labels.filter(F.col("kind").isin(*KINDS)).groupBy("doc_id").agg(F.min("kind").alias("kind"), F.max("kind").alias("other")).filter("kind = other")
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id", "kind")
    seen = scale.materialize(_long(held.join(F.broadcast(known), "doc_id"), ["doc_id", "kind", "lang"]))  # at most `sample` labels
    seen = scale.lookup_join(seen, ranks, ["lang", "stat", "value"]).groupBy("doc_id", "kind").agg(F.sort_array(F.collect_list(F.struct("stat", "low", "high"))).alias("t")).collect()
    x = np.array([[e["low"] for e in r["t"][: len(SHAPE)]] + [e["high"] for e in r["t"][: len(SHAPE)]] for r in seen], dtype="float64").reshape(-1, 2 * len(SHAPE))
    weights = fit_kinds(x, np.array([KINDS.index(r["kind"]) for r in seen], dtype=int))

    shares = documents.sparkSession.createDataFrame(
        [(i, *(float(v) for k in range(len(KINDS)) for v in (weights[1 + i, k], weights[1 + len(SHAPE) + i, k]))) for i in range(len(SHAPE))],
        "stat int, " + ", ".join(f"low_{k} double, high_{k} double" for k in KINDS),
    )
    parts = ranks.join(F.broadcast(shares), "stat").select("lang", "stat", "value", *[(F.col("low") * F.col(f"low_{k}") + F.col("high") * F.col(f"high_{k}")).alias(k) for k in KINDS])
    both = scale.lookup_join(_long(held, ["doc_id", "lang"]), scale.materialize(parts), ["lang", "stat", "value"])
    return both.groupBy("doc_id").agg(*[(F.round(F.sum(k) + F.lit(float(weights[0, i])), 9)).alias(k) for i, k in enumerate(KINDS)])


def not_prose(documents: DataFrame, labels: DataFrame, sample: int = LABELS) -> DataFrame:
    """``doc_id, kind``: documents that kind_scores takes for list, table or junk; of equal scores the first of KINDS.

    Null texts are no case; empty and blank ones are junk. Repeated doc_ids are scored as one.
    """
    scores = kind_scores(documents, labels, sample)
    best = F.greatest(*KINDS)
    kind = F.when(F.col(KINDS[0]) == best, KINDS[0])
    for k in KINDS[1:]:
        kind = kind.when(F.col(k) == best, k)
    blank = documents.filter(F.col("text").isNotNull() & ~F.col("text").rlike(r"[^\s\u0085\u00a0]")).select("doc_id", F.lit("junk").alias("kind"))
    return scores.select("doc_id", kind.alias("kind")).filter(F.col("kind") != "prose").join(blank, "doc_id", "left_anti").unionAll(blank.distinct())
