"""Evidence of new rows only: what is already in the output is left out, run after run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


#: The output's partition column where it is dealt to buckets.
BUCKET = "_bucket"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


def done_in_touched_buckets(batch: DataFrame, output: str, key: str, buckets: int) -> DataFrame:
    """Rows of a bucketed output in the buckets that a batch's keys fall in; others are not read. The driver gets bucket numbers only."""
    touched = [r[0] for r in batch.select(bucket_of(key, buckets)).distinct().collect()]
    return batch.sparkSession.read.parquet(output).filter(F.col(BUCKET).isin(touched))


def new_rows(source: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of the source whose key isn't done."""
    return source.join(done.select(key).distinct(), key, "left_anti")


def incremental_evidence(
    spark: SparkSession, source: str, schema: StructType, output: str, checkpoint: str, key: str, job: Callable[[DataFrame], DataFrame], buckets: int = 0
) -> StreamingQuery:
    """Runs job once over the files that came to the source folder since the last run and appends its rows.

    The checkpoint remembers files and the output's own keys drop rows given again, in this run or an earlier one,
    so no state grows. Of a key that is given twice in one run the row that comes first in the order of all columns
    counts.

    With buckets the output is partitioned by the key's hash (column `_bucket`), and a run reads the keys of those
    buckets alone that its own keys fall in, so a small run's cost doesn't follow the output. The job must keep the
    key, and an output keeps its number of buckets.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(output)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    rest = [n for n in schema.names if n != key]

    def append(batch: DataFrame, _: int) -> None:
        one = batch.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(key, "_row.*").select(*schema.names) if rest else batch.distinct()
        if fs.exists(path):
            done = done_in_touched_buckets(one, output, key, buckets) if buckets else spark.read.parquet(output)
            one = new_rows(one, done, key)
        if buckets:
            job(one).withColumn(BUCKET, bucket_of(key, buckets)).repartition(BUCKET).write.mode("append").partitionBy(BUCKET).parquet(output)
        else:
            job(one).write.mode("append").parquet(output)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
