"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is configured a temporary one is set, on one machine only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found if ":/" in found else f"file://{os.path.abspath(found)}"


#: Folders made so far, in order.
_made: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    _made.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def mark() -> int:
    """How many folders there are so far, for clean()."""
    return len(_made)


def clean(spark: SparkSession, since: int = 0, kept: DataFrame | None = None) -> None:
    """Deletes what operators stored since a mark, but for a stored table.

    Operators' results read their intermediate tables, models and archives when they run; call this once results
    are written.
    """
    names = {f.rpartition("/")[0].rpartition("/")[2] for f in kept.inputFiles()} if kept is not None else set()
    for path in list(_made[since:]):
        if path.rpartition("/")[2] not in names:
            remove(path, spark)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: its rows are fixed and outlive lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(df_or_path: DataFrame | str, spark: SparkSession) -> None:
    """Deletes a stored table that nothing reads any more."""
    paths = [df_or_path] if isinstance(df_or_path, str) else {f.rpartition("/")[0] for f in df_or_path.inputFiles()}
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        _made[:] = [m for m in _made if m.rpartition("/")[2] != p.getName()]


#: A stored table of ids is broadcast up to so many rows, else joined by a shuffle.
BOUND = 1 << 18


def bounded(stored_ids: DataFrame) -> DataFrame:
    """A stored table of a few numbers a row, marked for a broadcast if it is small enough."""
    return F.broadcast(stored_ids) if stored_ids.count() <= BOUND else stored_ids


#: Bytes of text for each shard of what is counted over a corpus, and partitions that shards are dealt to at most.
SHARD, PARTITIONS = 1 << 25, 1 << 14


def shards_for(docs: DataFrame, text_col: str = "text") -> int:
    """Shards that keep what one of them holds of a bounded size: by all bytes of text, and as many as shuffle partitions at least."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD))


def dealt(df: DataFrame, shards: int) -> DataFrame:
    """df[shard, ...] with each shard's rows together, one shard after another."""
    return df.repartition(min(shards, PARTITIONS), "shard").sortWithinPartitions("shard")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lets Spark send at most so many rows at once to Python, where rows are whole texts.

    Spark reads this when a query runs, so the session keeps the setting: operators on texts lower it for good.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with `position`, the row's place from 0 in the order of the given columns, over all rows.

    Rows are dealt out by range, so no task gets more than its share, and written once, so that a
    lost executor can't change the places. Only one count per partition meets in one task.
    """
    mid = F.monotonically_increasing_id()
    dealt = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.shiftright(mid, 33), "_local": mid.bitwiseAND((1 << 33) - 1)}),
        name,
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    # one row per partition: always small enough to broadcast
    return dealt.join(F.broadcast(starts), "_part").withColumn("position", F.col("_start") + F.col("_local")).drop("_part", "_local", "_start")


#: crc32 of a short ASCII string in an oracle, before the last inversion: eight shifts for each byte.
CRC32 = """list_reduce(
  list_concat([4294967295::BIGINT], list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END))"""
