"""What every distributed operator needs: cut lineage, bounded broadcasts, salted joins, prefix sums.

Nothing here collects rows that grow with the data. What reaches the driver is one row per partition,
per hot key (at most ``1 / share`` of them) or per fixed-size bucket.
"""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Largest lookup side that is broadcast, in bytes of its hash table (measured, never guessed).
BROADCAST_BYTES = 32 << 20

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. A temporary one only where it is unset and all is local."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_dirs:
        path = tempfile.mkdtemp(prefix="medloom-")
        atexit.register(shutil.rmtree, path, True)
        _local_dirs[context.applicationId] = path
    return "file://" + _local_dirs[context.applicationId]


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and read them back: lineage is cut, lost executors cost nothing.

    Unlike checkpoint() it computes the rows once, and readers prune columns. The table goes when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/medloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def drop(*tables: DataFrame) -> None:
    """Delete materialized tables whose last reader is done. Other tables stay."""
    for table in tables:
        path = getattr(table, "_written_to", None)
        if path is not None:
            where = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Let shuffle files go that finished steps have left: Spark deletes them once the driver has collected what refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle that must not be coalesced, from the session's own setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where a small file would keep few of them busy; tables of as many partitions stay as they are."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def _row_width(kinds: list[tuple[str, str]]) -> Column:
    """Bytes of a row of these columns as Spark lays it out: a word each and the values of any length, those of nested ones as text."""
    width = F.lit(8 + 8 * len(kinds))
    for name, kind in kinds:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.ceil(F.octet_length(c) / 8) * 8, F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 48
    return width


def relation_size(table: DataFrame, keys: list[str]) -> int:
    """Bytes that a table takes once it is broadcast for a join on its keys, on the driver and on every executor: rows, keys and slots.

    Counted by one pass over an already materialized table. Many short rows take several times their values: 1.6 million
    numbers are 13 MB, their hash table has 134 MB.
    """
    kinds = dict(table.dtypes)
    rows, values, held = table.agg(
        F.count("*"), F.coalesce(F.sum(_row_width(table.dtypes).cast("bigint")), F.lit(0)), F.coalesce(F.sum(_row_width([(k, kinds[k]) for k in keys]).cast("bigint")), F.lit(0))
    ).first()
    power = lambda n: 1 << (n - 1).bit_length() if n else 0
    slots = 16 * power(2 * rows)
    if len(keys) == 1 and kinds[keys[0]] in ("bigint", "int", "smallint", "tinyint"):  # the key is its own slot; all rows in one page that doubles
        return slots + power(8 * rows + int(values))
    return slots + 16 * rows + int(values) + int(held)


def hot_keys(df: DataFrame, keys: list[str], share: float = 0.01) -> DataFrame:
    """Keys that hold more than ``share`` of the rows: at most 1 / share of them, counted exactly."""
    counts = df.groupBy(*keys).count()
    total = df.count()
    return counts.filter(F.col("count") > F.lit(max(1.0, share * total))).drop("count")


def lookup_join(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left", limit: int = BROADCAST_BYTES, salts: int = 32) -> DataFrame:
    """Join rows of any skew with a table that is unique in ``keys`` and already materialized.

    The table's hash table is measured. Up to ``limit`` bytes it is broadcast. Beyond, both sides are shuffled; rows of hot
    keys are spread over ``salts`` partitions and only those keys' table rows are repeated.
    """
    if relation_size(table, keys) <= limit:
        return rows.join(F.broadcast(table), keys, how)
    return salted_join(rows, table, keys, how, salts)


def salted_join(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left", salts: int = 32) -> DataFrame:
    """The shuffled form of lookup_join."""
    hot = F.broadcast(hot_keys(rows, keys).withColumn("__hot", F.lit(True)))  # at most 1 / share rows
    # the salt is a function of the row, so a task that runs again puts its rows where they were
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(salts)).cast("int")
    spread = rows.withColumn("__salt", salt).join(hot, keys, "left").withColumn("__salt", F.when(F.col("__hot"), F.col("__salt")).otherwise(0)).drop("__hot")
    copies = (
        table.join(hot, keys, "left")
        .withColumn("__salt", F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
        .drop("__hot")
    )
    return spread.join(copies, [*keys, "__salt"], how).drop("__salt")


def with_offsets(df: DataFrame, group: list[str], order: list[str], size: Column, buckets: int = 64, bucket: Column | None = None) -> DataFrame:
    """Add ``start``: the sum of ``size`` over the rows before this one in its group, in the order of bucket, then ``order``.

    A group may hold any share of the rows: it is cut into ``buckets`` parts, only the parts' totals are scanned in
    one place (groups x buckets rows), and rows are summed within their part.
    """
    part = bucket if bucket is not None else F.pmod(F.xxhash64(*order), F.lit(buckets))
    rows = df.withColumn("__part", part.cast("int")).withColumn("__size", size.cast("bigint"))
    totals = rows.groupBy(*group, "__part").agg(F.sum("__size").alias("__total"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__base", F.coalesce(F.sum("__total").over(before), F.lit(0))).drop("__total")
    within = Window.partitionBy(*group, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("__in", F.coalesce(F.sum("__size").over(within), F.lit(0)))
        .join(totals, [*group, "__part"])
        .withColumn("start", F.col("__base") + F.col("__in"))
        .drop("__part", "__size", "__in", "__base")
    )
