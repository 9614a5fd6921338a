"""Rows that mean much work for few bytes, dealt to enough tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys to as many partitions as a shuffle has.

    Spark reads a file of 128 MB as one task, however long its rows keep a core busy. The number is stated, so that
    adaptive execution doesn't put small partitions together again.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
