"""References to records that do not exist: sorted parent arrays per key range, probed by binary search.

Distinct parents are range-partitioned; each range becomes one row that holds its keys as a sorted array. References
get the number of their range, meet its array in the same partition and are looked up a whole Arrow batch at a time.
Ranges that get more than their share of the references are repeated and their references spread over the copies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom import scale

#: Parents in one sorted array, at most about so many: it bounds the memory of a range and, inversely, the rows of bounds.
RANGE_KEYS = 1 << 14

_PARENTS = "rid int, lo string, keys array<string>, since array<bigint>, live array<boolean>"


def _as_bytes(keys: pa.Array) -> np.ndarray:
    """Keys as an array that numpy can search; order is that of the UTF-8 bytes, as Spark sorts text.

    Arrays of fixed width are faster, but don't tell a NUL at the end from none; keys with NULs and long keys are objects.
    """
    values = [k.encode() for k in keys.to_pylist()]
    fixed = max(map(len, values), default=0) <= 256 and not any(b"\0" in v for v in values)
    return np.array(values, dtype="S") if fixed else np.array(values, dtype=object)


def _search(sorted_keys: np.ndarray, probe: np.ndarray, side: str = "left") -> np.ndarray:
    if sorted_keys.dtype != probe.dtype and object in (sorted_keys.dtype, probe.dtype):
        sorted_keys, probe = sorted_keys.astype(object), probe.astype(object)
    return np.searchsorted(sorted_keys, probe, side)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(list(batches))
    if table.num_rows:
        keys = table["key"].combine_chunks()
        yield pa.RecordBatch.from_pydict(
            {"rid": pa.array([TaskContext.get().partitionId()], pa.int32()), "lo": [keys[0].as_py()], "keys": [keys.to_pylist()], "since": [table["since"].to_pylist()], "live": [table["live"].to_pylist()]},
            schema=pa.schema([("rid", pa.int32()), ("lo", pa.string()), ("keys", pa.list_(pa.string())), ("since", pa.list_(pa.int64())), ("live", pa.list_(pa.bool_()))]),
        )


def sorted_ranges(parents: DataFrame) -> DataFrame:
    """Distinct parents (``key, since, live``) as one row per key range."""
    ranges = max(1, -(-parents.count() // RANGE_KEYS))
    return parents.repartitionByRange(ranges, "key").sortWithinPartitions("key").mapInArrow(_pack, _PARENTS)


def _assigner(rids: list[int], lows: list[str]) -> Callable:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, ids = _as_bytes(pa.array(lows, pa.string())), np.array(rids, dtype="int32")
        for batch in batches:
            if batch.num_rows:
                at = np.maximum(_search(low, _as_bytes(batch["key"]), "right") - 1, 0)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids[at])], names=[*batch.schema.names, "rid"])

    return assign


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, keys, since, live = None, None, None, None
    for batch in batches:
        place = np.asarray(batch["rid"])
        salt = np.asarray(batch["salt"])
        holds = np.asarray(batch["keys"].is_valid())
        cuts = np.flatnonzero(np.r_[True, holds[1:] | holds[:-1] | (place[1:] != place[:-1]) | (salt[1:] != salt[:-1])]) if batch.num_rows else []
        for a, b in zip(cuts, [*cuts[1:], batch.num_rows]):
            if holds[a]:
                now = (place[a], salt[a])
                keys = _as_bytes(batch["keys"][a].values)
                since = np.array([np.iinfo("int64").min if s is None else s for s in batch["since"][a].as_py()], dtype="int64")
                live = np.array(batch["live"][a].as_py(), dtype=bool)
                continue
            piece = batch.slice(a, b - a)
            if now != (place[a], salt[a]):
                keys = np.array([], dtype="S1")
            probe = _as_bytes(piece["key"])
            at = _search(keys, probe)
            inside = np.minimum(at, max(0, len(keys) - 1))
            hit = (at < len(keys)) & (keys[inside] == probe) if len(keys) else np.zeros(len(probe), bool)
            time = np.array([np.iinfo("int64").max if t is None else t for t in piece["time"].to_pylist()], dtype="int64")
            state = np.full(len(probe), "missing", dtype=object)
            if len(keys):
                state[hit & ~live[inside]] = "deleted"
                state[hit & live[inside]] = None
                state[hit & live[inside] & (since[inside] > time)] = "late"
            keep = pa.array([s is not None for s in state])
            out = pa.RecordBatch.from_arrays([piece["table_name"], piece["id"], piece["period_ym"], pa.array(state.tolist(), pa.string())], names=["table_name", "id", "period_ym", "orphan_state"])
            yield out.filter(keep)


def orphans(references: DataFrame, parents: DataFrame, spread: int | None = None) -> DataFrame:
    """``table_name, id, period_ym, orphan_state`` of the references whose key has no parent, or got one only later.

    references: ``table_name, id, key, time, period_ym`` (time in microseconds); parents: ``key, since, live``,
    any number of rows a key. State ``late``: the earliest live parent came after the reference's time; ``deleted``:
    only parents that are not live; ``missing``: none. References without a key are no case. Without a time a
    reference can't be late. Repeated references come out repeatedly; with no parents all are missing.
    """
    distinct = scale.materialize(
        parents.filter(F.col("key").isNotNull()).groupBy("key").agg(F.min(F.when(F.col("live"), F.col("since"))).alias("since"), F.max("live").alias("live"))
    )
    ranges = scale.materialize(sorted_ranges(distinct))
    bounds = sorted(ranges.select("lo", "rid").collect(), key=lambda r: r["lo"].encode()) or [("", 0)]
    asked = references.filter(F.col("key").isNotNull()).select("table_name", F.col("id").cast("bigint"), "key", F.col("time").cast("bigint"), "period_ym")
    assign = _assigner([r[1] for r in bounds], [r[0] for r in bounds])
    placed = scale.materialize(asked.mapInArrow(assign, "table_name string, id bigint, key string, time bigint, period_ym string, rid int"))
    per_range = placed.groupBy("rid").count().collect()
    slots = spread or scale.partitions(references.sparkSession)
    fair = max(1, sum(r["count"] for r in per_range) // max(1, slots))
    copies = {r["rid"]: max(1, -(-r["count"] // fair)) for r in per_range}
    table = references.sparkSession.createDataFrame([(k, n) for k, n in copies.items()] or [(0, 1)], "rid int, copies int")
    nothing = lambda kind: F.lit(None).cast(kind)
    left = ranges.join(F.broadcast(table), "rid").select(
        "rid", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"), F.lit(0).alias("side"), "keys", "since", "live",
        nothing("string").alias("table_name"), nothing("bigint").alias("id"), nothing("string").alias("key"), nothing("bigint").alias("time"), nothing("string").alias("period_ym"),
    )
    right = placed.join(F.broadcast(table), "rid").select(
        "rid", F.pmod(F.xxhash64("id", "table_name"), F.col("copies")).cast("int").alias("salt"), F.lit(1).alias("side"),
        nothing("array<string>").alias("keys"), nothing("array<bigint>").alias("since"), nothing("array<boolean>").alias("live"),
        "table_name", "id", "key", "time", "period_ym",
    )
    met = left.unionAll(right).repartition(slots, "rid", "salt").sortWithinPartitions("rid", "salt", "side")
    return met.mapInArrow(_probe, "table_name string, id bigint, period_ym string, orphan_state string")
