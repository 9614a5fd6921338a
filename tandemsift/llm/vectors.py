"""Vectors of a table as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_STEP = 20


def usable(df: DataFrame, vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """vec_id, vector (doubles) of the rows without null or non-finite components, and their dimension.

    The dimension is the most frequent length (of two, the longer); vectors of another one, null vectors and rows
    without an id are left out. Of rows that repeat an id the least vector counts.
    """
    v = F.col("vector")
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))
    lengths = rows.groupBy(F.size(v).alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = lengths["dim"] if lengths else 0
    return rows.filter(F.size(v) == dim).groupBy("vec_id").agg(F.min("vector").alias("vector")), dim


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def numbers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def merged_top(found: DataFrame, k: int, kind: str) -> DataFrame:
    """found[query_id, ids, scores] (the best of parts) -> query_id, rank, vec_id, score: the k best, ties to smaller ids.

    Parts are merged row by row: a query with many parts is sorted, not gathered.
    """
    pairs = found.select("query_id", F.explode(F.arrays_zip(F.col("ids"), F.col("scores"))).alias("pair"))
    own = Window.partitionBy("query_id").orderBy(F.desc("pair.scores"), "pair.ids")
    best = pairs.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("pair.ids").alias("vec_id"), F.col("pair.scores").cast(kind).alias("score"))
