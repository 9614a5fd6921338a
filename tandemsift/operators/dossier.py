"""Paged documents of the calls of each locus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .intervals import running_before

#: Calls of a page.
PAGE = 1000


def candidate_dossier(calls: DataFrame, keys: list[str], source: list[str], page: int = PAGE) -> DataFrame:
    """keys, page (from 0) and dossier: a JSON document of at most `page` calls, with their number and source columns in order.

    The first of the source columns is a whole number that tiles the running place, so a locus of any number of calls
    is many rows of many tasks. Nulls in it come first, as they sort; calls that repeat each keep a place; a null key is a
    key of its own, as structs compare.
    """
    rows = calls.select(F.struct(*keys).alias("_key"), *source).withColumn("_at", F.coalesce(F.col(source[0]).cast("long"), F.lit(-(1 << 62))))
    placed = running_before(rows, ["_key"], "_at", ["_at", *source[1:]], F.lit(1), "sum")
    paged = placed.groupBy("_key", F.floor(F.col("_before") / page).alias("page")).agg(F.array_sort(F.collect_list(F.struct("_before", *source))).alias("_calls"))
    listed = F.transform("_calls", lambda c: F.struct(*[c[n].alias(n) for n in source]))
    return paged.select("_key.*", "page", F.to_json(F.struct(F.size("_calls").cast("long").alias("calls"), F.col("page").alias("page"), listed.alias("sources"))).alias("dossier"))
