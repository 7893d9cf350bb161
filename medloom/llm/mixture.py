"""Mixing sources to target weights: a low-discrepancy schedule of slots joined with shuffled blocks of equal tokens.

Slot i of the schedule goes to the source into whose part of the unit interval the van der Corput point of i falls, so
every stretch of the mixture has close to the target shares. Documents of a source are shuffled by a hash, laid end to
end and cut into blocks of equal tokens, documents being cut where a block ends; the slots of a source are numbered,
and number r takes block r modulo the blocks, in pass r div the blocks. The mixture ends before the first slot whose
source has no pass left, so every slot is filled. Sources, slots and tokens are numbered by prefix sums over parts,
never in one task.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medloom import scale
from medloom.functions.columns import squeeze

#: Public vocabulary the tokens are counted with, and its splitting pattern (a fixed value of that tokenizer).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Tokens of a block at most, and the slots wanted: mixtures of fewer than SLOTS such blocks take smaller ones, down to
#: LEAST_TOKENS, as shares can be met to about a slot only. Slots or documents that one task numbers; digits of a point.
BLOCK_TOKENS, SLOTS, LEAST_TOKENS, CHUNK, BITS = 512, 2_048, 16, 1 << 16, 52


def source_key(source: Column) -> Column:
    """'State-Portal ', 'state portal' -> 'state_portal'; null for blanks."""
    return F.nullif(F.regexp_replace(F.lower(squeeze(source)), r"[\s_-]+", "_"), F.lit(""))


def _counter(ranks) -> Callable:  # noqa: ANN001
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        made = getattr(tiktoken, "_medloom", None)  # building it costs more than a batch; workers live for many tasks
        if made is None:
            pairs = (line.split() for line in ranks.value.splitlines() if line)
            made = tiktoken._medloom = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})
        for batch in batches:
            sizes = [len(made.encode_ordinary(t)) if t else 0 for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in batch.schema.names if n != "text"), pa.array(sizes, pa.int64())], names=[*(n for n in batch.schema.names if n != "text"), "n_tokens"])

    return count


def token_counts(documents: DataFrame, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """``keep..., n_tokens`` of the ``text`` of every document, read whole; 0 for null and empty texts."""
    with open(vocabulary, "rb") as f:
        ranks = documents.sparkSession.sparkContext.broadcast(f.read())
    kinds = dict(documents.dtypes)
    return documents.select(*keep, "text").mapInArrow(_counter(ranks), ", ".join(f"{k} {kinds[k]}" for k in keep) + ", n_tokens bigint")


def van_der_corput(i: Column) -> Column:
    """The binary digits of i mirrored at the point: 1, 2, 3, 4 -> 1/2, 1/4, 3/4, 1/8."""
    return F.conv(F.reverse(F.lpad(F.bin(i), BITS, "0")), 2, 10).cast("double") / F.lit(float(1 << BITS))


def mixture(documents: DataFrame, targets: DataFrame, block_tokens: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The mixture ``slot, source, pass, doc_id, from_token, to_token, n_tokens`` and the report, one row per source of ``targets``.

    A slot holds ``block_tokens`` tokens, but for a source's last block, in one or several pieces of documents: the
    tokens from_token to to_token (exclusive, counted from 0) of doc_id.

    documents: ``doc_id, source_key, n_tokens``; targets: ``source, target_share, max_repeats``, a short list that is
    read on the driver. The size is the largest at which every source that has text can hold its share of it without
    a document being used more than max_repeats times. Sources without target take no part; a target without text
    gets nothing and its share is missing from the total. The report has the tokens and documents at hand and used,
    the passes, and the share reached. Documents without tokens aren't used. Nothing to mix: no rows, shares of 0.
    """
    spark = documents.sparkSession
    wanted = targets.filter((F.col("target_share") > 0) & (F.col("max_repeats") > 0) & F.col("source").isNotNull())
    wanted = wanted.groupBy(source_key(F.col("source")).alias("source")).agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    asked = sorted(wanted.collect(), key=lambda r: r["source"])
    names = [r["source"] for r in asked]
    rows = scale.materialize(documents.filter((F.col("n_tokens") > 0) & F.col("source_key").isin(names)).select("doc_id", F.col("source_key").alias("source"), "n_tokens"))
    held = {r["source"]: (r["t"], r["d"]) for r in rows.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("d")).collect()}  # a row per target
    present = [r for r in asked if r["source"] in held]
    weight = sum(r["target_share"] for r in present)
    size = min((r["max_repeats"] * held[r["source"]][0] / (r["target_share"] / weight) for r in present), default=0.0)

    if block_tokens is None:
        block_tokens = max(LEAST_TOKENS, min(BLOCK_TOKENS, 1 << max(0, int(size / SLOTS).bit_length() - 1)))

    # shuffled documents of a source in blocks of equal tokens; parts of the hash range bound what one task sums
    parts = max(64, -(-sum(d for _, d in held.values()) // CHUNK))
    shuffled = rows.withColumn("h", F.xxhash64("doc_id")).withColumn("h", F.shiftrightunsigned("h", 1))
    place = scale.with_offsets(shuffled, ["source"], ["h", "doc_id"], F.col("n_tokens"), bucket=F.floor(F.col("h") / F.lit(float(1 << 63)) * parts))
    end = F.col("start") + F.col("n_tokens")
    cut = place.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block_tokens), F.floor((end - 1) / block_tokens))))
    first, last = F.greatest(F.col("start"), F.col("block") * block_tokens), F.least(end, (F.col("block") + 1) * block_tokens)
    blocks = cut.select("source", "doc_id", "block", (first - F.col("start")).alias("from_token"), (last - F.col("start")).alias("to_token"), (last - first).alias("n_tokens"))
    n_blocks = {s: max(1, -(-t // block_tokens)) for s, (t, _) in held.items()}

    # slots: van der Corput points through cumulative weights, numbered within their source by chunks
    edges, upto = [], 0.0
    for r in present:
        upto += r["target_share"] / weight
        edges.append(upto)
    slots = spark.range(int(size // block_tokens)).withColumnRenamed("id", "slot").withColumn("u", van_der_corput(F.col("slot")))
    which = F.size(F.filter(F.array(*[F.lit(e) for e in edges[:-1]]) if len(edges) > 1 else F.array().cast("array<double>"), lambda e: e <= F.col("u")))
    known = spark.createDataFrame([(i, r["source"], n_blocks[r["source"]], r["max_repeats"]) for i, r in enumerate(present)], "which int, source string, blocks bigint, max_repeats int")
    slots = slots.withColumn("which", which.cast("int")).join(F.broadcast(known), "which")  # as many rows as targets
    chunk = (F.col("slot") / CHUNK).cast("bigint")
    counts = slots.groupBy("source", chunk.alias("chunk")).agg(F.count("*").alias("n"))
    counts = counts.withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    ranked = slots.withColumn("chunk", chunk).withColumn("r", F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot")) - 1)
    ranked = ranked.join(counts, ["source", "chunk"]).withColumn("rank", F.col("base") + F.col("r"))
    turns = scale.materialize(ranked.select("slot", "source", F.floor(F.col("rank") / F.col("blocks")).cast("int").alias("pass"), (F.col("rank") % F.col("blocks")).alias("block"), "max_repeats"))
    ends = turns.filter(F.col("pass") >= F.col("max_repeats")).agg(F.min("slot")).first()[0]
    filled = turns if ends is None else turns.filter(F.col("slot") < ends)
    mixed = filled.select("slot", "source", "pass", "block").join(blocks, ["source", "block"]).select("slot", "source", "pass", "doc_id", "from_token", "to_token", "n_tokens")

    used = mixed.groupBy("source").agg(F.sum("n_tokens").alias("used_tokens"), F.countDistinct("doc_id").alias("used_documents"), (F.max("pass") + 1).alias("passes"))
    listed = spark.createDataFrame(
        [(r["source"], float(r["target_share"]), r["max_repeats"], *held.get(r["source"], (0, 0))) for r in asked],
        "source string, target_share double, max_repeats int, available_tokens bigint, available_documents bigint",
    )
    report = listed.join(used, "source", "left").fillna(0, ["used_tokens", "used_documents", "passes"])
    whole = F.sum("used_tokens").over(Window.partitionBy())  # as many rows as targets
    report = report.withColumn("actual_share", F.when(whole > 0, F.col("used_tokens") / whole).otherwise(F.lit(0.0)))
    return mixed, report
