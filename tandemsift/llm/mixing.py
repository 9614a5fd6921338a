"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: The random offset of a source is one of so many steps of a unit: sums with document places stay exact.
STEPS = 1 << 20
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Targets of sources: sizes[source, source_size] -> source, source_size, target.

    Weights repeat over the sources in code point order, null last. All targets together are
    `share` times all sizes; a target stops at `most` times its source's size and the excess goes to
    the other sources by weight, again and again until none is above. Each round is one aggregate
    over the sources; the driver holds three sums only.
    """
    ordered = common.ranked(sizes.withColumn("_last", F.col("source").isNull()), ["_last", "source"], "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    ordered = ordered.withColumn("_weight", weight)
    cap = F.col("source_size") * F.lit(float(most))
    total = ordered.agg(F.sum("source_size")).first()[0] or 0
    level, settled = 0.0, -1
    while True:
        full = cap <= F.lit(level) * F.col("_weight") if settled >= 0 else F.lit(False)
        count, held, free = ordered.agg(
            F.count_if(full),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0.0)),
        ).first()
        if count == settled or not free:
            break
        settled, level = count, (share * total - held) / free
    return ordered.select("source", "source_size", F.least(cap, F.lit(level) * F.col("_weight")).alias("target"))


def sized(docs: DataFrame) -> DataFrame:
    """docs with `size`, the number of words of its text (null: 0)."""
    return docs.withColumn("size", common.word_count(F.col("text")))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = "mix",
) -> DataFrame:
    """docs[doc_id, source, size, ...] with source_size, target, copies and taken.

    Systematic sampling: all words of a source are wanted target / source_size times, which is each
    document's expected number of copies. Documents stand in the order of size, id and the rest of
    the row; the prefix sums of their expected copies, plus one random offset for the source, cross
    as many integers over a document as it has copies. As neighbours are of one size, each source's
    words come near its target. The offset is a hash of source and seed, so reruns agree.

    Documents of size 0 have copies but take no words; a null source is a source of its own; rows
    that repeat an id are documents of their own; an empty table gives none. Further columns stay;
    those named above are replaced.
    """
    docs = docs.drop("source_size", "target", "copies", "taken", "position")
    others = [c for c in docs.columns if c not in ("source", "size", "doc_id")]
    keyed = docs.withColumns({"_last": F.col("source").isNull(), "_tie": F.xxhash64("doc_id", *others)})
    rows = common.ranked(keyed, ["_last", "source", "size", "doc_id", "_tie"], "mix")
    sources = common.stored(
        rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("position").alias("_first")), "sizes"
    )
    targets = source_targets(sources.drop("_first"), weights, share, most).drop("source_size")
    mark = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), mark)), 1, 5), 16, 10).cast("double") / STEPS
    per_source = (
        sources.withColumn("_offset", offset)
        .join(targets.withColumnRenamed("source", "_t"), F.col("source").eqNullSafe(F.col("_t")))
        .drop("_t")
        .withColumnRenamed("source", "_s")
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    place = F.col("position") - F.col("_first")
    upto = lambda n: F.floor(n * rate + F.col("_offset"))
    return (
        rows.join(per_source, F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("copies", upto(place + 1) - upto(place))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select(*docs.columns, "source_size", "target", "copies", "taken")
    )


def emitted(mixed: DataFrame) -> DataFrame:
    """One row for each copy of a mixed document."""
    return mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).drop("_copy")


def query(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sizes = common.stored(sized(docs).drop("text"), "sized")  # else words are counted again to find the ranges
    return mix(sizes).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM d GROUP BY source
), r AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0::DOUBLE) AS held,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0::DOUBLE) AS free,
         sum(source_size) OVER ()::DOUBLE AS total
  FROM s WINDOW before AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT *, (1.5::DOUBLE * total - held) / free AS level FROM r
), t AS (
  SELECT source, source_size, least(cap, (SELECT max(level) FROM l WHERE level * w <= cap) * w) AS target FROM l
), o AS (
  SELECT *, ('0x' || substr(md5('mix' || CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END), 1, 5))::INT / 1048576.0::DOUBLE AS u FROM t
), p AS (
  SELECT d.doc_id, d.size, o.source_size, o.target, o.u,
         CASE WHEN o.source_size > 0 THEN o.target / o.source_size ELSE 0::DOUBLE END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1 AS place
  FROM d JOIN o ON d.source IS NOT DISTINCT FROM o.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       ((floor((place + 1) * rate + u) - floor(place * rate + u)) * size)::BIGINT AS taken
FROM p
"""
