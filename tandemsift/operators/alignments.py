"""CIGAR strings as arrays of operations: positions, blocks, projections of reference positions onto reads.

An alignment's CIGAR is worked through within its own row, in one pass that carries the offsets along; rows are
exploded only where operations or blocks are the result. Positions of operations, and projections and anchors of pairs, are
worked out in Arrow batches, in which each distinct CIGAR is parsed once. Nothing here is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import cigars

KEY = ["read_id", "ordinal"]
#: Which operations move along the reference, and along the query.
REFERENCE, QUERY, MATCH = ("M", "D", "N", "=", "X"), ("M", "I", "S", "=", "X"), ("M", "=", "X")


def with_ops(alignments: DataFrame) -> DataFrame:
    """alignments with `_ops`, the array of (op, op_len) of its CIGAR; rows whose CIGAR isn't valid are left out."""
    parts = F.regexp_extract_all("cigar", F.lit("[0-9]+[MIDNSHP=X]"), F.lit(0))
    valid = alignments.withColumn("_parts", parts).filter((F.array_join("_parts", "") == F.col("cigar")) & (F.col("cigar") != ""))
    ops = F.transform("_parts", lambda p: F.struct(F.right(p, F.lit(1)).alias("op"), F.substring(p, F.lit(1), F.length(p) - 1).cast("int").alias("op_len")))
    return valid.withColumn("_ops", ops).drop("_parts")


def walked(state: dict[str, Column], step: Callable[[Column, Column, Column], dict[str, Column]]) -> Column:
    """The state after all operations: `step` gives new values from the state so far, the operation and its length.

    The state also has the offsets `ref` and `query` at which an operation starts, and its place `at`.
    """
    moved = lambda x, ops: F.when(x["op"].isin(*ops), x["op_len"]).otherwise(0)
    fields = lambda values: [c.alias(n) for n, c in values.items()]
    start = F.struct(F.lit(0).cast("long").alias("ref"), F.lit(0).cast("long").alias("query"), F.lit(0).alias("at"), *fields(state))

    def merge(a: Column, x: Column) -> Column:
        return F.struct((a["ref"] + moved(x, REFERENCE)).alias("ref"), (a["query"] + moved(x, QUERY)).alias("query"), (a["at"] + 1).alias("at"), *fields({n: a[n] for n in state} | step(a, x["op"], x["op_len"])))

    return F.aggregate("_ops", start, merge)


def total(op: str) -> Column:
    """Bases of all operations of a kind."""
    return F.aggregate("_ops", F.lit(0).cast("long"), lambda a, x: a + F.when(x["op"] == op, x["op_len"]).otherwise(0))


def cigar_ops(alignments: DataFrame) -> DataFrame:
    """One row for each operation of a valid CIGAR: op_index, op, op_len. Others give no rows."""
    return with_ops(alignments).select("*", F.posexplode("_ops").alias("op_index", "_op")).select("*", "_op.*").drop("_op", "_ops")


def cigar_positions(alignments: DataFrame) -> DataFrame:
    """One row for each operation of a valid CIGAR with the reference and query offsets at which it starts, in Arrow batches. Others give no rows."""
    added = {"op_index": "int", "op": "string", "op_len": "int", "ref_offset": "bigint", "query_offset": "bigint"}
    rows = alignments.drop(*added)
    names = rows.columns

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = cigars.Parsed(batch.column(names.index("cigar")))
            valid = np.flatnonzero(parsed.valid)
            counts = parsed.count[parsed.of[valid]]
            index = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            at = np.repeat(parsed.first[parsed.of[valid]], counts) + index
            ops = pa.DictionaryArray.from_arrays(pa.array(parsed.op[at].astype(np.int32)), pa.array([chr(c) for c in range(128)])).cast(pa.string())
            own = batch.take(pa.array(np.repeat(valid, counts)))
            values = [pa.array(index.astype(np.int32)), ops, pa.array(parsed.size[at].astype(np.int32)), pa.array(parsed.ref[at]), pa.array(parsed.query[at])]
            yield pa.RecordBatch.from_arrays([*own.columns, *values], [*names, *added])

    schema = StructType([*rows.schema.fields, *StructType.fromDDL(", ".join(f"{c} {kind}" for c, kind in added.items())).fields])
    return rows.mapInArrow(found, schema).withColumn("op_ref_start", F.col("ref_start") + F.col("ref_offset"))


def with_positions(alignments: DataFrame) -> DataFrame:
    """alignments with `_at`, the array of operations with the offsets at which they start (op, op_len, ref, query)."""
    kind = "array<struct<op:string,op_len:int,ref:bigint,query:bigint>>"
    more = lambda a, op, n: {"all": F.concat(a["all"], F.array(F.struct(op.alias("op"), n.alias("op_len"), a["ref"].alias("ref"), a["query"].alias("query"))))}
    return with_ops(alignments).withColumn("_at", walked({"all": F.array().cast(kind)}, more)["all"]).drop("_ops")


def splice_blocks(alignments: DataFrame) -> DataFrame:
    """Reference blocks between skips; deletions stay inside a block."""
    kind = "array<struct<s:bigint,e:bigint>>"
    none = F.lit(None).cast("long")

    def step(a: Column, op: Column, n: Column) -> dict[str, Column]:
        inside, skip = op.isin("M", "D", "=", "X"), op == "N"
        closed = F.when(skip & a["s"].isNotNull(), F.concat(a["blocks"], F.array(F.struct(a["s"].alias("s"), a["e"].alias("e"))))).otherwise(a["blocks"])
        return {"blocks": closed, "s": F.when(skip, none).when(inside, F.coalesce(a["s"], a["ref"])).otherwise(a["s"]), "e": F.when(inside, a["ref"] + n).otherwise(a["e"])}

    rows = with_ops(alignments).select(*KEY, "chrom", "ref_start", walked({"blocks": F.array().cast(kind), "s": none, "e": none}, step).alias("w"))
    last = F.when(F.col("w.s").isNotNull(), F.array(F.struct(F.col("w.s").alias("s"), F.col("w.e").alias("e")))).otherwise(F.array().cast(kind))
    found = rows.select(*KEY, "chrom", "ref_start", F.posexplode(F.concat("w.blocks", last)).alias("block_index", "b"))
    return found.select(*KEY, "chrom", (F.col("ref_start") + F.col("b.s")).alias("block_start"), (F.col("ref_start") + F.col("b.e")).alias("block_end"), "block_index")


def padded(blocks: DataFrame, padding: int = 500) -> DataFrame:
    return blocks.withColumns({"padded_start": F.greatest(F.lit(0), F.col("block_start") - padding), "padded_end": F.col("block_end") + padding})


def features(alignments: DataFrame, low_mapq: int = 10) -> DataFrame:
    """Skips, bases by kind, clips by side of the read, QC status and flags of each alignment.

    A clip may stand behind a hard clip.
    """
    soft = F.filter("_ops", lambda x: x["op"] != "H")
    side = lambda i: F.when(F.try_element_at(soft, F.lit(i))["op"] == "S", F.try_element_at(soft, F.lit(i))["op_len"]).otherwise(0).cast("long")
    found = with_ops(alignments).select(
        *KEY, "chrom", "alignment_class", "strand", "mapq", F.size(F.filter("_ops", lambda x: x["op"] == "N")).cast("long").alias("splice_junctions"), total("N").alias("intron_bp"), total("I").alias("insertion_bp"),
        total("D").alias("deletion_bp"), side(1).alias("clip_left_bp"), F.when(F.size(soft) > 1, side(-1)).otherwise(F.lit(0).cast("long")).alias("clip_right_bp"),
    )
    chimeric = F.col("alignment_class") == "supplementary"
    low = F.col("mapq") < low_mapq
    flags = F.array_compact(
        F.array(
            F.when(F.col("alignment_class") == "secondary", "SECONDARY"),
            F.when(chimeric, "SUPPLEMENTARY"),
            F.when(low, f"LOW_MAPQ_LT_{low_mapq}"),
            F.when(F.col("splice_junctions") > 0, "SPLICED"),
            F.when((F.col("clip_left_bp") > 0) | (F.col("clip_right_bp") > 0), "SOFTCLIPPED"),
            F.when(chimeric, "CHIMERIC_CANDIDATE"),
        )
    )
    warn = F.col("alignment_class").isin("secondary", "supplementary") | low
    return found.withColumns({"chimeric": chimeric, "qc_status": F.when(warn, "WARN").otherwise("PASS"), "flags": F.array_join(flags, ";")})


def project_boundary(alignments: DataFrame, boundary: str) -> DataFrame:
    """The query offset of a reference position, with how it was found; null outside the alignment.

    The first operation that holds the position decides; a position at an operation's start is that of the
    query so far.
    """
    at = F.col(boundary) - F.col("ref_start")
    none = F.lit(None).cast("struct<q:bigint,status:string>")

    def step(a: Column, op: Column, n: Column) -> dict[str, Column]:
        way = lambda q, status: F.struct(q.cast("long").alias("q"), F.lit(status).alias("status"))
        inside = (a["ref"] < at) & (at <= a["ref"] + n)
        here = (
            F.when(at == a["ref"], way(a["query"], "PROJECTED_AT_OPERATION_BOUNDARY"))
            .when(op.isin(*MATCH) & inside, way(a["query"] + at - a["ref"], "PROJECTED_WITHIN_MATCHLIKE"))
            .when((op == "D") & inside, way(a["query"], "PROJECTED_WITHIN_DELETION"))
            .when((op == "N") & inside, way(a["query"], "PROJECTED_WITHIN_REFERENCE_SKIP"))
        )
        return {"way": F.coalesce(a["way"], here)}

    rows = with_ops(alignments).select(*KEY, boundary, "ref_start", walked({"way": none}, step).alias("w"))
    before, way = at < 0, F.col("w.way")
    at_end = way.isNull() & (at == F.col("w.ref"))
    status = F.when(before, "BOUNDARY_BEFORE_ALIGNMENT").when(way.isNotNull(), way["status"]).when(at_end, "PROJECTED_AT_ALIGNMENT_END").otherwise("BOUNDARY_AFTER_ALIGNMENT")
    query = F.when(~before, F.coalesce(way["q"], F.when(at_end, F.col("w.query"))))
    return rows.select(*KEY, boundary, query.alias("query_position"), status.alias("status"))


def measured(pairs: DataFrame, names: tuple[str, str], measure: Callable[[cigars.Parsed, np.ndarray, np.ndarray], tuple]) -> DataFrame:
    """pairs[KEY, target_region_id, cigar, ref_start, start_pos, end_pos] -> two numbers for each that has a valid CIGAR, in Arrow batches.

    `measure` gets the CIGARs, the rows and their places (a column each), and gives which rows to keep (None for all), both numbers and which of them are null.
    """
    own, places = [*KEY, "target_region_id"], ("ref_start", "start_pos", "end_pos")
    rows = pairs.select(*own, "cigar", *[F.col(c).cast("long").alias(c) for c in places]).dropna(subset=list(places))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = cigars.Parsed(batch.column(3))
            valid = np.flatnonzero(parsed.valid)
            keep, low, high, none = measure(parsed, valid, np.stack([batch.column(i).to_numpy() for i in (4, 5, 6)], axis=1)[valid])
            columns = [x.take(pa.array(valid)) for x in batch.columns[:3]] + [pa.array(v, mask=none) for v in (low, high)]
            out = pa.RecordBatch.from_arrays(columns, [*own, *names])
            yield out if keep is None else out.filter(pa.array(keep))

    return rows.mapInArrow(found, StructType([*[rows.schema[c] for c in own], *[StructField(n, LongType()) for n in names]]))


def project_interval(pairs: DataFrame) -> DataFrame:
    """pairs[alignment columns, start_pos, end_pos] -> query span of the aligned and inserted pieces in the interval."""

    def measure(parsed: cigars.Parsed, rows: np.ndarray, places: np.ndarray) -> tuple:
        low, high = places[:, 1] - places[:, 0], places[:, 2] - places[:, 0]
        start, end = np.full(len(rows), np.iinfo(np.int64).max), np.full(len(rows), -1)
        for has, at in parsed.each(rows):
            op, size, ref, query, lo, hi = parsed.op[at], parsed.size[at], parsed.ref[at], parsed.query[at], low[has], high[has]
            match = cigars.IS_MATCH[op] & (ref < hi) & (ref + size > lo) & (lo < hi)
            put = (op == ord("I")) & (lo <= ref) & (ref <= hi)
            first = np.where(match, query - ref + np.maximum(ref, lo), query)
            last = np.where(match, query - ref + np.minimum(ref + size, hi), query + size)
            start[has] = np.where(match | put, np.minimum(start[has], first), start[has])
            end[has] = np.where(match | put, np.maximum(end[has], last), end[has])
        return None, start, end, end < 0

    return measured(pairs, ("query_start", "query_end"), measure)


def orient(start, end, length, reverse, hard_left):
    """Query interval in raw read coordinates: hard clips are added, reverse alignments are turned."""
    low, high = start + hard_left, end + hard_left
    return F.when(reverse, length - high).otherwise(low), F.when(reverse, length - low).otherwise(high)


def anchor_bases(pairs: DataFrame, window: int = 100) -> DataFrame:
    """Aligned bases within the windows left and right of a target, for alignments that have any aligned bases."""

    def measure(parsed: cigars.Parsed, rows: np.ndarray, places: np.ndarray) -> tuple:
        start, end = places[:, 1], places[:, 2]
        sides = [(np.maximum(0, start - window), start), (end, end + window)]
        told, aligned = [np.zeros(len(rows), np.int64) for _ in sides], np.zeros(len(rows), bool)
        for has, at in parsed.each(rows):
            match, r0 = cigars.IS_MATCH[parsed.op[at]], places[has, 0] + parsed.ref[at]
            aligned[has] |= match
            for n, (low, high) in zip(told, sides):
                n[has] += np.where(match, np.maximum(0, np.minimum(r0 + parsed.size[at], high[has]) - np.maximum(r0, low[has])), 0)
        return aligned, *told, None

    return measured(pairs, ("left_anchor_bp", "right_anchor_bp"), measure)
