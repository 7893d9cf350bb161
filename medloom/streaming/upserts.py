"""Continuous use of the merges: micro-batches of records into a snapshot table.

The engine this one stands in for has no streams; its only incremental state is its tables. A stream therefore upserts
every micro-batch with the batch operator, in order and once: the batch number is written with the snapshot, and a
batch that comes again after a failure is skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from medloom.operators.merge import Snapshots, upsert


def upsert_stream(records: DataFrame, table: Snapshots, empty: DataFrame, keys: list[str], values: list[str], order: str, checkpoint: str, now: Column | None = None) -> StreamingQuery:
    """Start upserting a streaming DataFrame into ``table``; ``empty`` has the table's columns and no rows."""

    def apply(batch: DataFrame, number: int) -> None:
        current = table.read()
        if current is not None and "__batch" in current.columns and (current.agg(F.max("__batch")).first()[0] or -1) >= number:
            return
        target = current.drop("__batch") if current is not None else empty
        table.write(upsert(target, batch, keys, values, order, now if now is not None else F.current_timestamp()).drop("outcome").withColumn("__batch", F.lit(number)))

    return records.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
