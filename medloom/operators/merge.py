"""Upserts as set operations: a batch is folded per key, met with its target, and written as a new snapshot.

Keys match null-safely. Within a batch later rows win, attribute by attribute, and null never overwrites; empty arrays
and false do. Nothing is looked up row by row, so conflicts can't arise.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MEDICINE_KEY = ["generic_name", "dosage_form", "strength", "notification_number"]
LISTING_KEY = MEDICINE_KEY[:3]


def fold(batch: DataFrame, keys: list[str], values: list[str], order: str, first: list[str] = (), truthy: list[str] = ()) -> DataFrame:
    """One row per key: of each value the last that is not null; of ``first`` the first; of ``truthy`` the last non-empty."""
    last = [F.max_by(v, F.when(F.col(v).isNotNull(), F.col(order))).alias(v) for v in values]
    full = [F.max_by(v, F.when(F.col(v) != "", F.col(order))).alias(v) for v in truthy]
    kept = [F.min_by(v, F.col(order)).alias(v) for v in first]
    return batch.groupBy(*keys).agg(*last, *full, *kept)


def _met(target: DataFrame, folded: DataFrame, keys: list[str]) -> DataFrame:
    t = target.withColumn("__old", F.lit(True)).alias("t")
    s = folded.withColumn("__new", F.lit(True)).alias("s")
    return t.join(s, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys], "full")


def _next_ids(rows: DataFrame, fresh: Column, start: int) -> DataFrame:
    """Ids for fresh rows after ``start``: unique and increasing by partition, without a global sort."""
    return rows.withColumn("id", F.when(fresh, F.lit(start + 1) + F.monotonically_increasing_id()).otherwise(F.col("id")))


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], values: list[str], order: str, now: Column, defaults: dict[str, Column] | None = None) -> DataFrame:
    """M1/M2/M4. The target after the batch, with ``outcome``: kept, updated or inserted.

    target: ``id``, keys, values, ``date_added, last_updated``; batch: keys, values and ``order``. A matched row takes
    every non-null value and a new last_updated; others are inserted with ``defaults`` for missing values.
    """
    defaults = defaults or {}
    start = target.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    met = _met(target, fold(batch, keys, values, order), keys)
    fresh, touched = F.col("__old").isNull(), F.col("__new").isNotNull()
    rows = met.select(
        F.col("t.id").alias("id"),
        *[F.when(fresh, F.col(f"s.{k}")).otherwise(F.col(f"t.{k}")).alias(k) for k in keys],
        *[F.coalesce(F.col(f"s.{v}"), F.col(f"t.{v}"), F.when(fresh, defaults.get(v, F.lit(None)))).alias(v) for v in values],
        F.coalesce("t.date_added", now).alias("date_added"), F.when(touched, now).otherwise(F.col("t.last_updated")).alias("last_updated"),
        F.when(fresh, "inserted").when(touched, "updated").otherwise("kept").alias("outcome"),
    )
    return _next_ids(rows, F.col("outcome") == "inserted", start)


def queue_reviews(queue: DataFrame, items: DataFrame, order: str, now: Column) -> DataFrame:
    """M3. The review queue after new items (``notification_number, issue_type, description, raw_text, notification_date, source_url``).

    Pending items of the same number and type are one: description and raw_text become the last non-empty ones, date
    and url stay the first. Items that aren't pending are never touched.
    """
    keys = ["notification_number", "issue_type"]
    start = queue.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    folded = fold(items, keys, [], order, first=["notification_date", "source_url"], truthy=["description", "raw_text"])
    met = _met(queue.filter("status = 'pending'"), folded, keys)
    fresh, touched = F.col("__old").isNull(), F.col("__new").isNotNull()
    rows = met.select(
        F.col("t.id").alias("id"), *[F.when(fresh, F.col(f"s.{k}")).otherwise(F.col(f"t.{k}")).alias(k) for k in keys],
        *[F.coalesce(F.col(f"s.{v}"), F.col(f"t.{v}")).alias(v) for v in ("description", "raw_text")],
        *[F.when(fresh, F.col(f"s.{v}")).otherwise(F.col(f"t.{v}")).alias(v) for v in ("notification_date", "source_url")],
        F.lit("pending").alias("status"), F.coalesce("t.date_added", now).alias("date_added"), F.when(touched, now).otherwise(F.col("t.last_updated")).alias("last_updated"),
        fresh.alias("__fresh"),
    )
    rows = _next_ids(rows, F.col("__fresh"), start).drop("__fresh")
    return rows.unionByName(queue.filter("status <> 'pending'"), allowMissingColumns=True)


def set_status(rows: DataFrame, key: str, changes: DataFrame) -> DataFrame:
    """M5. New ``status`` and, where they aren't empty, ``notes`` for the rows that ``changes`` name; unique by key."""
    new = changes.select(F.col(key).alias("__k"), F.col("status").alias("__status"), F.col("notes").alias("__notes"))
    met = rows.join(new, F.col(key) == F.col("__k"), "left")
    met = met.withColumn("status", F.coalesce("__status", "status")).withColumn("notes", F.coalesce(F.nullif("__notes", F.lit("")), F.col("notes")))
    return met.drop("__k", "__status", "__notes")


def without(rows: DataFrame, bad: Column) -> DataFrame:
    """M6/P8. Rows but those of a predicate; rows for which it is null stay."""
    return rows.filter(~F.coalesce(bad, F.lit(False)))


def split_by(rows: DataFrame, moves: Column) -> tuple[DataFrame, DataFrame]:
    """M8. Rows that stay and rows that move to another table."""
    goes = F.coalesce(moves, F.lit(False))
    return rows.filter(~goes), rows.filter(goes)


def backfilled(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """M9. Missing columns added; present ones filled where null."""
    for name, value in columns.items():
        rows = rows.withColumn(name, F.coalesce(F.col(name), value) if name in rows.columns else value)
    return rows


class Snapshots:
    """M10. A table as directories of Parquet with a pointer to the current one; readers see the old or the new, never a part.

    One writer at a time. The pointer is a file in the Hadoop file system of the path, replaced by rename.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _current(self) -> str | None:
        names = sorted(s.getPath().getName() for s in self._fs.globStatus(self._path(f"{self.path}/current-*")) or [])
        return names[-1].split("-", 2)[2] if names else None

    def read(self) -> DataFrame | None:
        """The current snapshot; None before the first write."""
        name = self._current()
        return self.spark.read.parquet(f"{self.path}/data-{name}") if name else None

    def write(self, rows: DataFrame) -> None:
        """Make these rows the table. They may be computed from the snapshot they replace."""
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/data-{name}")
        marks = self._fs.globStatus(self._path(f"{self.path}/current-*")) or []
        turn = 1 + max((int(s.getPath().getName().split("-")[1]) for s in marks), default=0)
        self._fs.create(self._path(f"{self.path}/current-{turn:012d}-{name}")).close()
        for s in marks:
            self._fs.delete(s.getPath(), False)

    def drop(self) -> None:
        """M7/K7. The table and all its snapshots gone."""
        self._fs.delete(self._path(self.path), True)


def to_fetch(rows: DataFrame, file_valid: Column, force: bool = False) -> DataFrame:
    """P12. Rows whose file has to be fetched: all of them by ``force``, else those not downloaded into a valid file."""
    return rows if force else rows.filter(~F.coalesce((F.col("download_status") == "downloaded") & file_valid, F.lit(False)))
