"""From blocks and targets to each read's ranked targets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import distance, overlap
from ..sources.scratch import new_folder
from . import ranked
from .intervals import interval_join, met_once
from .spread import spread

TARGET = ["target_source", "target_region_id"]
#: Which alignment class counts more.
CLASS = {"primary": 3, "supplementary": 2, "secondary": 1}


def named_once(targets: DataFrame, names: list[str] = TARGET) -> bool:
    """Whether each target has one row."""
    return targets.groupBy(*names).count().filter("count > 1").isEmpty()


def alignment_target_candidates(blocks: DataFrame, targets: DataFrame, within: int = 49) -> DataFrame:
    """Per alignment and target: overlap over all blocks, least distance, blocks that support it, basis.

    An alignment's blocks have an index each. Pairs stay where the join puts them; only where a target's name is given
    more than once, its rows are put together by a shuffle.
    """
    spans, loci = blocks.select("read_id", "ordinal", "chrom", "block_start", "block_end"), targets.select(*TARGET, "chrom", "start_pos", "end_pos")
    key, block, target = ["read_id", "ordinal"], ("chrom", "block_start", "block_end"), ("chrom", "start_pos", "end_pos")
    pairs = met_once(spans, key, loci, block, target, within)
    ends = (F.col("start_pos"), F.col("end_pos"))
    rest = lambda f: F.transform("_rest", lambda x: f(x["block_start"], x["block_end"], *ends))
    one, two, second = F.col("_rest").isNull(), F.size("_rest") == 1, F.get("_rest", F.lit(0))
    other = lambda f: f(second["block_start"], second["block_end"], *ends)
    found = pairs.select(
        *key, *TARGET,
        F.when(one, F.col("overlap_bp")).when(two, F.col("overlap_bp") + other(overlap)).otherwise(F.col("overlap_bp") + F.aggregate(rest(overlap), F.lit(0).cast("long"), lambda s, x: s + x)).alias("target_overlap_bp"),
        F.when(one, F.col("distance_bp")).when(two, F.least("distance_bp", other(distance))).otherwise(F.least("distance_bp", F.array_min(rest(distance)))).alias("target_distance_bp"),
        F.when(one, F.lit(1)).otherwise(F.size("_rest") + 1).cast("long").alias("supporting_block_count"),
    )
    if not named_once(loci):
        found = found.groupBy(*key, *TARGET).agg(F.sum("target_overlap_bp").alias("target_overlap_bp"), F.min("target_distance_bp").alias("target_distance_bp"), F.sum("supporting_block_count").alias("supporting_block_count"))
    return found.withColumn("candidate_basis", F.when(F.col("target_overlap_bp") > 0, "EXACT_OVERLAP").otherwise("PROXIMAL"))


def best_block(blocks: DataFrame, targets: DataFrame, within: int = 49) -> DataFrame:
    """Per alignment and target the block that overlaps most, then is nearest, longest, first; no pair is shuffled unless a target's name is given again."""
    block, key = ("chrom", "block_start", "block_end"), ["read_id", "ordinal"]
    pairs = met_once(blocks, key, targets.select("target_region_id", "chrom", "start_pos", "end_pos"), block, ("chrom", "start_pos", "end_pos"), within, ("block_index",))

    def of(s: Column, e: Column, index: Column, covered: Column, apart: Column) -> Column:
        return F.struct(covered.alias("overlap_bp"), (-apart).alias("nearness"), (e - s).alias("bp"), (-index).alias("place"))

    ends = (F.col("start_pos"), F.col("end_pos"))
    other = lambda x: of(x["block_start"], x["block_end"], x["block_index"], overlap(x["block_start"], x["block_end"], *ends), distance(x["block_start"], x["block_end"], *ends))
    own = of(*[F.col(c) for c in ("block_start", "block_end", "block_index", "overlap_bp", "distance_bp")])
    met = pairs.select(*key, "target_region_id", "block_index", "overlap_bp", "distance_bp", F.when(F.col("_rest").isNotNull(), F.array_max(F.concat(F.array(own), F.transform("_rest", other)))).alias("b"), own.alias("own"))
    if not named_once(targets, ["target_region_id"]):
        met = met.groupBy(*key, "target_region_id").agg(F.max(F.coalesce("b", "own")).alias("b")).withColumns({c: F.lit(None).cast("long") for c in ("block_index", "overlap_bp", "distance_bp")})
    one = F.col("b").isNull()
    pick = lambda plain, c: F.when(one, F.col(plain)).otherwise(c).alias(plain)
    return met.select(*key, "target_region_id", pick("block_index", -F.col("b.place")), pick("overlap_bp", F.col("b.overlap_bp")), pick("distance_bp", -F.col("b.nearness")))


def overlapping_blocks(blocks: DataFrame, targets: DataFrame) -> DataFrame:
    """Per alignment and target how many blocks overlap it, and whether these are more than one."""
    key = ["read_id", "ordinal", "target_region_id"]
    pairs = met_once(blocks, key[:2], targets.select("target_region_id", "chrom", "start_pos", "end_pos"), ("chrom", "block_start", "block_end"), ("chrom", "start_pos", "end_pos"), 0, ("block_index",))
    n = F.when(F.col("_rest").isNull(), F.lit(1)).otherwise(F.size("_rest") + 1).cast("long")
    met = pairs.select(*key, n.alias("overlapping_blocks"))
    if not named_once(targets, key[2:]):
        met = met.groupBy(*key).agg(F.sum("overlapping_blocks").alias("overlapping_blocks"))
    return met.withColumn("multi_block", F.col("overlapping_blocks") > 1)


def flanking(blocks: DataFrame, targets: DataFrame, good: Callable[[Column, Column], Column], within: int = 150) -> DataFrame:
    """Per alignment and target with a block beside it: whether good blocks lie before it (l) and after it (r), and how many others were refused."""
    key = ["read_id", "ordinal", "target_region_id"]
    pairs = met_once(blocks, key[:2], targets.select("target_region_id", "chrom", "start_pos", "end_pos"), ("chrom", "block_start", "block_end"), ("chrom", "start_pos", "end_pos"), within, ("block_index",))
    t0, t1 = F.col("start_pos"), F.col("end_pos")
    beside = lambda s, e: overlap(s, e, t0, t1) == 0
    told = {
        "near": beside,
        "l": lambda s, e: beside(s, e) & (e <= t0) & good(s, e),
        "r": lambda s, e: beside(s, e) & (s >= t1) & good(s, e),
    }
    own = (F.col("block_start"), F.col("block_end"))
    one = F.col("_rest").isNull()
    any_other = lambda f: F.exists("_rest", lambda x: f(x["block_start"], x["block_end"]))
    found = {n: f(*own) | F.when(one, F.lit(False)).otherwise(any_other(f)) for n, f in told.items()}
    bad = lambda s, e: (beside(s, e) & ~good(s, e)).cast("long")
    refused = bad(*own) + F.when(one, F.lit(0)).otherwise(F.aggregate("_rest", F.lit(0).cast("long"), lambda n, x: n + bad(x["block_start"], x["block_end"])))
    met = pairs.select(*key, *[c.alias(n) for n, c in found.items()], refused.alias("refused")).filter("near").drop("near")
    if not named_once(targets, key[2:]):
        met = met.groupBy(*key).agg(F.bool_or("l").alias("l"), F.bool_or("r").alias("r"), F.sum("refused").alias("refused"))
    return met


def shaped(df: DataFrame, keys: list[str], span: tuple[str, str, str], name: str) -> DataFrame:
    """Per keys the set `_spans` of their intervals, and as `name` its shape: two independent 64-bit hashes of the set."""
    spans = df.dropna(subset=list(span)).groupBy(*keys).agg(F.sort_array(F.collect_set(F.struct(*[F.col(c) for c in span]))).alias("_spans"))
    return spans.withColumn(name, F.struct(F.xxhash64("_spans").alias("h"), F.xxhash64(F.lit("other"), "_spans").alias("i")))


def candidate_shapes(blocks: DataFrame, targets: DataFrame, within: int = 49) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The pairs of alignment_target_candidates by shape: alignments with theirs, targets with theirs, pairs of shapes.

    Alignments with the same blocks meet the same targets, and targets with the same span the same alignments, so that
    what only counts them pairs shapes. There are no more of these than rows, and no more than places they can lie at.
    """
    aligned, named = shaped(blocks, ["read_id", "ordinal"], ("chrom", "block_start", "block_end"), "_a"), shaped(targets, TARGET, ("chrom", "start_pos", "end_pos"), "_t")
    a = aligned.select("_a", "_spans").dropDuplicates(["_a"]).select("_a", F.explode("_spans").alias("s")).select("_a", "s.*")
    t = named.select("_t", "_spans").dropDuplicates(["_t"]).select("_t", F.explode("_spans").alias("s")).select("_t", "s.*")
    pairs = interval_join(a, t, ("chrom", "block_start", "block_end"), ("chrom", "start_pos", "end_pos"), within=within)
    return aligned.drop("_spans"), named.drop("_spans"), pairs.groupBy("_a", "_t").agg((F.max("overlap_bp") > 0).alias("exact"))


def hashed(rows: DataFrame, fields: list[str], name: str) -> DataFrame:
    """Per read `name`, an array of the sums of two independent 64-bit hashes of its rows' fields, in any order.

    Nothing is collected for a read, so its rows, which come together already, aren't sorted or shuffled for it.
    """
    sums = []
    for h in (F.xxhash64(*fields), F.xxhash64(F.lit("other"), *fields)):
        sums += [F.sum(h.bitwiseAND(F.lit((1 << 32) - 1))), F.sum(F.shiftrightunsigned(h, 32))]  # halves, whose sums don't overflow
    named = [f"_s{i}" for i in range(len(sums))]
    return rows.groupBy("read_id").agg(*[c.alias(n) for n, c in zip(named, sums, strict=True)]).select("read_id", F.array(*named).alias(name))


def shapes_of_reads(blocks: DataFrame, alignments: DataFrame | None = None) -> DataFrame:
    """Per read its shape `_shape`, `_shape2`: two hashes of its blocks, and if given of its alignments' classes, qualities and strands."""
    shapes, block = F.col("_blocks"), ["chrom", "block_start", "block_end"]
    rows = hashed(blocks.dropna(subset=block), ["ordinal", *block], "_blocks")
    if alignments is not None:
        rows = rows.join(hashed(alignments, ["ordinal", "alignment_class", "mapq", "strand"], "_own").withColumnRenamed("read_id", "_read"), F.col("read_id").eqNullSafe(F.col("_read")))
        shapes = F.concat("_blocks", "_own")
    return rows.select("read_id", F.xxhash64(shapes).alias("_shape"), F.xxhash64(F.lit("other"), shapes).alias("_shape2"))


def kept(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back: worked out once, and Spark knows how small it is."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def only(rows: DataFrame, least: DataFrame) -> DataFrame:
    """Rows of the reads `_least`. A semi join, which goes before the numbering of a read's rows."""
    return rows.join(least.select("_least"), rows["read_id"].eqNullSafe(least["_least"]), "left_semi")


def shapes_met(blocks: DataFrame, targets: DataFrame, within: int = 49) -> DataFrame:
    """Each shape of reads with each span of targets that it meets, once: nothing that copies of reads or targets add to, and no shuffle of pairs.

    A row has the shape, its least read and `_reads` alike, the span with its `_targets` and `_disease` ones, how many of the
    read's alignments meet it (`_count`), how many overlap it (`_exact`), and `_near`, the least of all by which candidates
    are put in order: the overlap below zero, or without one the distance. Of targets each must have one row. The blocks of one
    read of each shape are written to the shared folder, so that counting bins and joining don't go over all blocks again.
    """
    key, block, target = ["read_id", "_shape", "_shape2", "_reads", "_named"], ("chrom", "block_start", "block_end"), ("chrom", "start_pos", "end_pos")
    least = shapes_of_reads(blocks).groupBy("_shape", "_shape2").agg(F.min(F.struct("read_id")).alias("_r"), F.count("*").alias("_reads"), F.count("read_id").alias("_named"))
    least = least.select(F.col("_r.read_id").alias("_least"), *key[1:])
    least = kept(least, "shapes")
    own = only(blocks, least).select("read_id", "ordinal", *block).join(least, F.col("read_id").eqNullSafe(F.col("_least"))).select(*key, "ordinal", *block)
    own = kept(own, "blocks")
    spans = targets.groupBy(*target).agg(F.count("*").alias("_targets"), F.count_if(F.col("target_source") == "DISEASE").alias("_disease"))
    pairs = met_once(own, key, spans, block, target, within, ("ordinal",))
    ends = (F.col("start_pos"), F.col("end_pos"))
    near = lambda covered, apart: F.when(covered > 0, -covered).otherwise(apart)
    second = F.get("_rest", F.lit(0))
    covered, apart, also, other = F.col("overlap_bp"), F.col("distance_bp"), overlap(second["block_start"], second["block_end"], *ends), distance(second["block_start"], second["block_end"], *ends)
    one, alike = F.col("_rest").isNull(), second["ordinal"].eqNullSafe(F.col("ordinal"))
    two = F.size("_rest") == 1
    bit = lambda c: (c > 0).cast("long")
    every = F.concat(F.array(F.struct("block_start", "block_end", "ordinal")), "_rest")

    def of(ordinal: Column) -> Column:
        mine = F.filter(every, lambda x: x["ordinal"].eqNullSafe(ordinal))
        measure = lambda f: F.transform(mine, lambda x: f(x["block_start"], x["block_end"], *ends))
        return near(F.aggregate(measure(overlap), F.lit(0).cast("long"), lambda s, x: s + x), F.array_min(measure(distance)))

    # nearly always one block meets, or two, which plain columns tell
    met = pairs.withColumn("_each", F.when(~one & ~two, F.transform(F.array_distinct(F.transform(every, lambda x: x["ordinal"])), of)))
    told = {
        "_count": F.when(one, F.lit(1)).when(two, F.when(alike, 1).otherwise(2)).otherwise(F.size("_each")).cast("long"),
        "_exact": F.when(one, bit(covered)).when(two, F.when(alike, bit(covered + also)).otherwise(bit(covered) + bit(also))).otherwise(F.size(F.filter("_each", lambda v: v < 0))).cast("long"),
        "_near": F.when(one, near(covered, apart)).when(two, F.when(alike, near(covered + also, F.least(apart, other))).otherwise(F.least(near(covered, apart), near(also, other)))).otherwise(F.array_min("_each")).cast("long"),
    }
    return met.select(*key, *target, "_targets", "_disease", *[c.alias(n) for n, c in told.items()])


def candidate_counts(blocks: DataFrame, targets: DataFrame) -> DataFrame:
    """Per read with any: candidates, those with an overlap, those of disease targets. Reads of one shape are counted once."""
    if not named_once(targets):
        return candidate_counts_by_shapes(blocks, targets)
    count, exact = F.col("_count"), F.col("_exact")
    per = shapes_met(blocks, targets).groupBy("_shape", "_shape2").agg(F.sum(count * F.col("_targets")).alias("n"), F.sum(exact * F.col("_targets")).alias("exact"), F.sum(count * F.col("_disease")).alias("disease"))
    return shapes_of_reads(blocks).join(per, ["_shape", "_shape2"]).drop("_shape", "_shape2")


def candidate_counts_by_shapes(blocks: DataFrame, targets: DataFrame) -> DataFrame:
    """candidate_counts for targets whose names are given more than once: pairs of shapes are shuffled."""
    aligned, named, pairs = candidate_shapes(blocks, targets)
    alike = named.groupBy("_t").agg(F.count("*").alias("_n"), F.count_if(F.col("target_source") == "DISEASE").alias("_d"))
    per = pairs.join(alike, "_t").groupBy("_a").agg(F.sum("_n").alias("n"), F.sum(F.when(F.col("exact"), F.col("_n")).otherwise(0)).alias("exact"), F.sum("_d").alias("disease"))
    return aligned.join(per, "_a").groupBy("read_id").agg(*[F.sum(c).alias(c) for c in ("n", "exact", "disease")])


def region_counts(blocks: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target and basis: candidates and distinct reads. Reads of one shape count as one, times their number."""
    if not named_once(targets):
        return region_counts_by_shapes(blocks, targets)
    exact, near = F.col("_exact"), F.col("_count") - F.col("_exact")
    sums = [F.sum(f(c)).alias(f"{name}_{k}") for name, c in (("EXACT", exact), ("PROXIMAL", near)) for k, f in (("c", lambda c: c * F.col("_reads")), ("r", lambda c: F.when(c > 0, F.col("_named")).otherwise(0)))]
    per = shapes_met(blocks, targets).groupBy("chrom", "start_pos", "end_pos").agg(*sums)
    bases = F.array(*[F.struct(F.lit(n).alias("basis"), F.col(f"{n}_c").alias("candidates"), F.col(f"{n}_r").alias("reads")) for n in ("EXACT", "PROXIMAL")])
    counted = per.select("chrom", "start_pos", "end_pos", F.explode(bases).alias("b")).select("chrom", "start_pos", "end_pos", "b.*").filter("candidates > 0")
    return targets.select(*TARGET, "chrom", "start_pos", "end_pos").join(counted, ["chrom", "start_pos", "end_pos"]).select(*TARGET, "basis", "candidates", "reads")


def region_summary(blocks: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target: candidates, distinct reads, candidates with an overlap, and the read of the best one, ties to the least read.

    The best overlaps most, or without any overlap is nearest. Reads of one shape and targets of one span count as one, times their number.
    """
    span = ["chrom", "start_pos", "end_pos"]
    if not named_once(targets):
        pairs = alignment_target_candidates(blocks, targets)
        best = F.min_by("read_id", F.struct(-F.col("target_overlap_bp"), "target_distance_bp", F.isnull("read_id"), "read_id", "ordinal"))
        return pairs.groupBy(*TARGET).agg(F.count("*").alias("candidates"), F.count_distinct("read_id").alias("reads"), F.count_if(F.col("target_overlap_bp") > 0).alias("exact"), best.alias("best_read"))
    sums = [F.sum(F.col("_count") * F.col("_reads")).alias("candidates"), F.sum("_named").alias("reads"), F.sum(F.col("_exact") * F.col("_reads")).alias("exact")]
    # first by how near, of which there are few, so that the best is the least of one number
    near = shapes_met(blocks, targets).groupBy(*span, "_near").agg(*sums, F.min("read_id").alias("_first"))
    per = near.groupBy(*span).agg(*[F.sum(c).alias(c) for c in ("candidates", "reads", "exact")], F.min_by("_first", "_near").alias("best_read"))
    return targets.select(*TARGET, *span).join(per, span).select(*TARGET, "candidates", "reads", "exact", "best_read")


def region_counts_by_shapes(blocks: DataFrame, targets: DataFrame) -> DataFrame:
    """region_counts for targets whose names are given more than once: pairs of shapes are shuffled."""
    aligned, named, pairs = candidate_shapes(blocks, targets)
    based = pairs.select("_a", "_t", F.when(F.col("exact"), "EXACT").otherwise("PROXIMAL").alias("basis"))
    shapes = aligned.groupBy("_a").agg(F.count("*").alias("_n"))
    candidates = based.join(shapes, "_a").groupBy("_t", "basis").agg(F.sum("_n").alias("candidates"))
    sets = aligned.filter("read_id IS NOT NULL").groupBy("read_id").agg(F.sort_array(F.collect_set("_a")).alias("_set")).groupBy("_set").agg(F.count("*").alias("_reads"))
    keyed = sets.withColumn("_r", F.struct(F.xxhash64("_set").alias("h"), F.xxhash64(F.lit("other"), "_set").alias("i")))
    met = keyed.select("_r", "_reads", F.explode("_set").alias("_a")).join(based, "_a")
    reads = met.groupBy("_r", "_t", "basis").agg(F.first("_reads").alias("_reads")).groupBy("_t", "basis").agg(F.sum("_reads").alias("reads"))
    counted = candidates.join(reads, ["_t", "basis"], "left").withColumn("reads", F.coalesce("reads", F.lit(0).cast("long")))
    return named.join(counted, "_t").select(*TARGET, "basis", "candidates", "reads")


def reads_alike(blocks: DataFrame, alignments: DataFrame) -> DataFrame:
    """One row for reads with the same blocks and alignments: `_ids` of at most ranked.ALIKE of them, and `_all`, one's blocks with their alignments' fields, as ranked() takes them."""
    shapes = shapes_of_reads(blocks, alignments)
    parts = shapes.groupBy("_shape", "_shape2").agg(F.ceil(F.count("*") / ranked.ALIKE).alias("_parts"))
    dealt = shapes.join(parts, ["_shape", "_shape2"]).withColumn("_part", F.pmod(F.xxhash64("read_id"), F.col("_parts")))
    groups = dealt.groupBy("_shape", "_shape2", "_part").agg(F.collect_list(F.struct("read_id")).alias("_ids"), F.min(F.struct("read_id")).alias("_r")).select("_ids", F.col("_r.read_id").alias("_least"))
    groups = kept(groups, "reads")
    spans = only(blocks, groups).select("read_id", "ordinal", "chrom", *[F.col(c).cast("long").alias(c) for c in ("block_start", "block_end")]).dropna(subset=["chrom", "block_start", "block_end"])
    own = only(alignments, groups).groupBy("read_id", "ordinal").agg(F.first(F.struct("alignment_class", "mapq", "strand")).alias("_own"))
    told = F.struct("ordinal", "_own.alignment_class", "_own.mapq", "_own.strand", "chrom", "block_start", "block_end")
    rows = spans.join(own, ["read_id", "ordinal"]).groupBy("read_id").agg(F.sort_array(F.collect_list(told)).alias("_all"))
    return rows.join(groups, F.col("read_id").eqNullSafe(F.col("_least"))).select("_ids", "_all")


def candidates_in_batches(blocks: DataFrame, targets: DataFrame, alignments: DataFrame, within: int, ranks: bool) -> DataFrame | None:
    """read_target_candidates, and with `ranks` assignment_rank, where the catalog is small enough to go with each task; else None.

    Reads are worked out in Arrow batches beside the catalog's spans, so that no pair is shuffled or joined by Spark.
    """
    loci = targets.select(*TARGET, "chrom", "start_pos", "end_pos").withColumns({c: F.col(c).cast("long") for c in ("start_pos", "end_pos")})
    if loci.count() > ranked.LOCI or not named_once(loci):
        return None
    rows = reads_alike(blocks, alignments)
    found = ranked.expanded(ranked.ranked(spread(rows, "_ids"), loci, within, CLASS, ranks), loci)
    basis = F.when(F.col("target_overlap_bp") > 0, "EXACT_OVERLAP").otherwise("PROXIMAL").alias("candidate_basis")
    columns = ["read_id", *TARGET, "ordinal", "alignment_class", "class_priority", "mapq", "strand", "target_overlap_bp", "target_distance_bp", basis, "supporting_alignment_count", *[f"{c}_support" for c in CLASS]]
    return found.select(*columns, *([F.col("_rank").alias("assignment_rank"), "read_candidate_target_count"] if ranks else []))


def ranked_targets(blocks: DataFrame, targets: DataFrame, alignments: DataFrame, within: int = 49) -> DataFrame:
    """assignment_rank of read_target_candidates; where the catalog is small enough without a shuffle of pairs."""
    found = candidates_in_batches(blocks, targets, alignments, within, ranks=True)
    return assignment_rank(read_target_candidates(blocks, targets, alignments, within)) if found is None else found


def read_target_candidates(blocks: DataFrame, targets: DataFrame, alignments: DataFrame, within: int = 49) -> DataFrame:
    """Per read and target the best alignment by overlap, distance, class and quality; ties to the lowest ordinal.

    A catalog small enough goes with each task (candidates_in_batches). Else a read's blocks meet a target as one, with their
    alignments' class and quality, so that pairs stay where the join puts them. Targets whose names are given more than once
    go the way of best_of_candidates.
    """
    found = candidates_in_batches(blocks, targets, alignments, within, ranks=False)
    if found is not None:
        return found
    own = alignments.groupBy("read_id", "ordinal").agg(F.first(F.struct("alignment_class", "mapq", "strand")).alias("_own"))
    spans = blocks.select("read_id", "ordinal", "chrom", "block_start", "block_end").join(own, ["read_id", "ordinal"]).select("read_id", "ordinal", "chrom", "block_start", "block_end", "_own.*")
    loci = targets.select(*TARGET, "chrom", "start_pos", "end_pos")
    if not named_once(loci):
        return best_of_candidates(alignment_target_candidates(blocks, targets, within), alignments)
    told = ("ordinal", "alignment_class", "mapq", "strand")
    pairs = met_once(spans, ["read_id"], loci, ("chrom", "block_start", "block_end"), ("chrom", "start_pos", "end_pos"), within, told)
    priority = lambda kind: F.coalesce(*[F.when(kind == c, F.lit(p)) for c, p in CLASS.items()], F.lit(0))
    ends = (F.col("start_pos"), F.col("end_pos"))

    def of(x: Callable[[str], Column], covered: Column, apart: Column) -> Column:
        """An alignment's fields, in the order that the best one is the greatest by."""
        return F.struct(
            (covered > 0).cast("int").alias("exact"), covered.alias("target_overlap_bp"), (-apart).alias("nearness"), priority(x("alignment_class")).alias("class_priority"), x("mapq").alias("mapq"),
            (-x("ordinal")).alias("place"), x("alignment_class").alias("alignment_class"), x("strand").alias("strand"),
        )

    own_span = F.struct("block_start", "block_end", *told)

    def each(all_: Column) -> Column:
        """Of all blocks that meet the target, their alignments."""

        def alike(ordinal: Column) -> Column:
            mine = F.filter(all_, lambda x: x["ordinal"] == ordinal)
            measure = lambda f: F.transform(mine, lambda x: f(x["block_start"], x["block_end"], *ends))
            return of(lambda c: F.element_at(mine, 1)[c], F.aggregate(measure(overlap), F.lit(0).cast("long"), lambda s, x: s + x), F.array_min(measure(distance)))

        return F.transform(F.array_distinct(F.transform(all_, lambda x: x["ordinal"])), alike)

    # nearly always one block meets, or two of one alignment: plain columns tell
    second = F.get("_rest", F.lit(0))
    alone = F.col("_rest").isNull() | ((F.size("_rest") == 1) & (second["ordinal"] == F.col("ordinal")))
    met = pairs.withColumn("_b", F.when(~alone, each(F.concat(F.array(own_span), "_rest"))))
    with_second = lambda c, f, merged: F.when(F.col("_rest").isNull(), F.col(c)).otherwise(merged(F.col(c), f(second["block_start"], second["block_end"], *ends)))
    met = met.withColumns({"overlap_bp": with_second("overlap_bp", overlap, lambda a, b: a + b), "distance_bp": with_second("distance_bp", distance, F.least)})
    met = met.select("*", F.array_max("_b").alias("b"), *[F.array_max(F.transform("_b", lambda x: x["alignment_class"] == c)).alias(f"_{c}") for c in CLASS])
    one, kind = F.col("_b").isNull(), F.col("alignment_class")
    pick = lambda plain, name: F.when(one, plain).otherwise(F.col("b")[name])
    apart, covered = F.when(one, F.col("distance_bp")).otherwise(-F.col("b.nearness")), pick(F.col("overlap_bp"), "target_overlap_bp")
    return met.select(
        "read_id", *TARGET, F.when(one, F.col("ordinal")).otherwise(-F.col("b.place")).alias("ordinal"), pick(kind, "alignment_class").alias("alignment_class"), pick(priority(kind), "class_priority").alias("class_priority"),
        pick(F.col("mapq"), "mapq").alias("mapq"), pick(F.col("strand"), "strand").alias("strand"), covered.alias("target_overlap_bp"), apart.alias("target_distance_bp"),
        F.when(covered > 0, "EXACT_OVERLAP").otherwise("PROXIMAL").alias("candidate_basis"), F.when(one, F.lit(1)).otherwise(F.size("_b")).cast("long").alias("supporting_alignment_count"),
        *[F.when(one, kind == c).otherwise(F.col(f"_{c}")).alias(f"{c}_support") for c in CLASS],
    )


def best_of_candidates(candidates: DataFrame, alignments: DataFrame) -> DataFrame:
    """Per read and target the best alignment by overlap, distance, class and quality; ties to the lowest ordinal.

    The way for targets whose name is given more than once: pairs are shuffled. A read's alignments, which are few, are
    brought to its candidates as one array.
    """
    own = F.collect_list(F.struct("ordinal", "alignment_class", "mapq", "strand"))
    rows = candidates.join(alignments.groupBy("read_id").agg(own.alias("_all")), "read_id")
    rows = rows.withColumn("_a", F.get(F.filter("_all", lambda x: x["ordinal"] == F.col("ordinal")), F.lit(0))).filter(F.col("_a").isNotNull())
    rows = rows.select(*candidates.columns, "_a.alignment_class", "_a.mapq", "_a.strand")
    priority = F.coalesce(*[F.when(F.col("alignment_class") == c, F.lit(p)) for c, p in CLASS.items()], F.lit(0))
    rows = rows.withColumn("class_priority", priority)
    order = F.struct((F.col("target_overlap_bp") > 0).cast("int"), "target_overlap_bp", -F.col("target_distance_bp"), "class_priority", "mapq", -F.col("ordinal"))
    best = F.max_by(F.struct("ordinal", "alignment_class", "class_priority", "mapq", "strand", "target_overlap_bp", "target_distance_bp", "candidate_basis"), order).alias("b")
    has = lambda c: F.bool_or(F.col("alignment_class") == c).alias(f"{c}_support")
    found = rows.groupBy("read_id", *TARGET).agg(best, F.count("*").alias("supporting_alignment_count"), *[has(c) for c in CLASS])
    return found.select("read_id", *TARGET, "b.*", "supporting_alignment_count", *[f"{c}_support" for c in CLASS])


def assignment_rank(read_candidates: DataFrame) -> DataFrame:
    """Rank of each target of a read, best first, and how many there are; ties by source and id."""
    order = [
        F.desc((F.col("target_overlap_bp") > 0).cast("int")), F.desc("target_overlap_bp"), F.asc("target_distance_bp"), F.desc("class_priority"), F.desc("mapq"), *TARGET,
    ]
    read = Window.partitionBy("read_id")
    return read_candidates.withColumns({"assignment_rank": F.row_number().over(read.orderBy(*order)), "read_candidate_target_count": F.count("*").over(read)})
