"""Duplicates hidden by formatting: external sort of canonical records, then one scan over adjacent runs.

Records are reduced to a canonical key in which case, whitespace, punctuation and the order of ingredients are gone.
All records are range-partitioned by (key, id) and sorted with spilling, so a key that holds a third of the rows is
cut over many partitions. Each partition is scanned once as a stream, comparing full neighbouring keys; runs that go
on across partitions are joined by the partitions' first and last keys, one row a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medloom import scale
from medloom.functions.columns import SPACE, letters_only
from medloom.functions.names import BREAK, separated
from medloom.functions.numbers import number_key

_BLANK_TEXT = "^" + SPACE + "*$"


def canonical_name(name: Column) -> Column:
    """Ingredients in code-point order, each its letters and digits in lower case; null for null and blank names."""
    items = F.filter(F.transform(F.split(separated(name), BREAK), letters_only), lambda p: p != "")
    return F.when(~name.rlike(_BLANK_TEXT), F.array_join(F.array_sort(items), "+"))


def canonical_text(text: Column) -> Column:
    """Letters, marks and digits in lower case; null for null and blank texts."""
    return F.when(~text.rlike(_BLANK_TEXT), letters_only(text))


def canonical_strength(text: Column) -> Column:
    """As canonical_text, but decimal signs between digits, percent signs and borders between numbers stay."""
    t = F.lower(text)
    t = F.regexp_replace(t, r"(?<![0-9.,])([1-9][0-9]{0,2}),([0-9]{3})(?![0-9])", "$1$2")
    t = F.regexp_replace(t, r"[.,](?![0-9])|(?<![0-9]),", " ")
    t = F.regexp_replace(t, r"[^\p{L}\p{M}\p{N}%.,]+", " ")
    return F.when(~text.rlike(_BLANK_TEXT), F.regexp_replace(F.trim(t), r"(?<![0-9]) | (?![0-9.])", ""))


def canonical_number(number: Column) -> Column:
    """Series and integer; a text that states no number is kept as canonical text."""
    return F.coalesce(number_key(number), canonical_text(number))


def record_key(rows: DataFrame) -> Column:
    """The canonical key of a record with generic_name, dosage_form, strength and notification_number; nulls agree."""
    parts = [canonical_name(F.col("generic_name")), canonical_text(F.col("dosage_form")), canonical_strength(F.col("strength")), canonical_number(F.col("notification_number"))]
    return F.concat_ws("\u0001", *[F.coalesce(F.concat(F.lit("="), p), F.lit("")) for p in parts])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal keys. kind 0: a row that repeats its run's first; 1: end of a run, with its count; 2: the borders."""
    part = TaskContext.get().partitionId()
    last_key, first_id, count, head = None, None, 0, True
    lo_key, lo_first = None, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys, ids = batch["key"], np.asarray(batch["id"])
        new = np.ones(n, dtype=bool)
        new[1:] = np.asarray(pc.not_equal(keys[1:], keys[:-1]).cast(pa.uint8())) != 0
        first = keys[0].as_py()
        if last_key is not None and first == last_key:
            new[0] = False
        if lo_key is None:
            lo_key, lo_first = first, int(ids[0])
        starts = np.flatnonzero(new)
        origin = np.empty(n, dtype="int64")
        run = np.cumsum(new) - 1
        origin[run >= 0] = ids[starts[run[run >= 0]]] if len(starts) else 0
        origin[run < 0] = first_id if first_id is not None else 0
        # ends of runs that close inside this batch
        sizes = np.diff(np.r_[0, starts, n]) if len(starts) else np.array([n])
        done_first, done_count = [], []
        carried = count + int(sizes[0]) if (not len(starts) or starts[0] > 0) else count
        heads = []
        if len(starts):
            if last_key is not None:
                done_first.append(first_id), done_count.append(carried), heads.append(head)
                head = False
            lengths = np.diff(np.r_[starts, n])
            done_first += ids[starts[:-1]].tolist()
            done_count += lengths[:-1].tolist()
            heads += [head and i == 0 for i in range(len(starts) - 1)]
            if len(starts) > 1:
                head = False
            first_id, count = int(ids[starts[-1]]), int(lengths[-1])
        else:
            count = carried
        last_key = keys[n - 1].as_py()
        again = ~new
        yield _rows(part, 0, origin[again], ids[again], origin[again] == lo_first)
        if done_first:
            yield _rows(part, 1, np.array(done_first, dtype="int64"), np.array(done_count, dtype="int64"), np.array(heads, dtype=bool))
    if last_key is not None:
        yield _rows(part, 1, np.array([first_id]), np.array([count]), np.array([head]))
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "kind": [2], "first_id": [lo_first], "value": [first_id], "head": [head], "lo": [lo_key], "hi": [last_key]},
            schema=_SCHEMA,
        )


_SCHEMA = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("first_id", pa.int64()), ("value", pa.int64()), ("head", pa.bool_()), ("lo", pa.string()), ("hi", pa.string())])


def _rows(part: int, kind: int, first: np.ndarray, value: np.ndarray, head: np.ndarray) -> pa.RecordBatch:
    n = len(first)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, part, "int32")), pa.array(np.full(n, kind, "int32")), pa.array(first, pa.int64()), pa.array(value, pa.int64()), pa.array(head, pa.bool_()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())],
        schema=_SCHEMA,
    )


def _runs(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The scan's rows, and for each partition whose first run began earlier the id it began with."""
    spark = keyed.sparkSession
    keyed = scale.materialize(keyed.select("key", "id"))  # written once, as finding the ranges reads it as well
    ordered = keyed.repartitionByRange(scale.partitions(spark), "key", "id").sortWithinPartitions("key", "id")
    scanned = scale.materialize(ordered.mapInArrow(_scan, "part int, kind int, first_id bigint, value bigint, head boolean, lo string, hi string"))
    # keys are compared in full where they lie; the driver gets the answers, one row a partition
    before = F.lag("hi").over(Window.orderBy("part"))
    borders = scanned.filter("kind = 2").select("part", "value", (F.col("lo") == F.col("hi")).alias("single"), F.coalesce(before == F.col("lo"), F.lit(False)).alias("goes_on"), "first_id")
    carried, last = [], None
    for b in borders.orderBy("part").collect():
        origin = last if b["goes_on"] else None
        if origin is not None:
            carried.append((b["part"], origin))
        # a partition that is one run passes on what it got
        last = origin if origin is not None and b["single"] else b["value"]
    return scanned, spark.createDataFrame(carried, "part int, origin bigint")


def copies(keyed: DataFrame) -> DataFrame:
    """``first_id, id``: every record (``key, id``) whose key an earlier id has; first_id is the smallest id of the key.

    Keys are compared in full. Null keys agree with nothing and give no row. Ids must be unique; equal ids would each
    count as a record. No rows, or no repeated key: an empty result.
    """
    scanned, carried = _runs(keyed.filter(F.col("key").isNotNull()))
    repeats = scanned.filter("kind = 0").select("part", "first_id", F.col("value").alias("id"), "head")
    # the row that opens a partition in the middle of a run is a repeat as well
    opening = scanned.filter("kind = 2").select("part", "first_id", F.col("first_id").alias("id"), F.lit(True).alias("head"))
    joined = repeats.unionAll(opening).join(F.broadcast(carried), "part", "left")
    return joined.select(F.when(F.col("head"), F.coalesce("origin", "first_id")).otherwise(F.col("first_id")).alias("first_id"), "id").filter("id != first_id")


def representatives(keyed: DataFrame) -> DataFrame:
    """``first_id, n_copies``: one record per distinct key and the exact number of records that have it."""
    scanned, carried = _runs(keyed.filter(F.col("key").isNotNull()))
    runs = scanned.filter("kind = 1").join(F.broadcast(carried), "part", "left")
    whole = runs.select(F.when(F.col("head"), F.coalesce("origin", "first_id")).otherwise(F.col("first_id")).alias("first_id"), F.col("value").alias("n_copies"))
    return whole.groupBy("first_id").agg(F.sum("n_copies").alias("n_copies"))
