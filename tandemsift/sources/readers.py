"""Readers of the pipeline's text formats: rows that parse, and rows that don't with the reason."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Texts that stand for no value.
MISSING = (".", "", "NA", "None", "null", "nan")


def read_tsv_contract(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A tab-separated table (plain or gzip) whose header must be the schema's names in order; missing marks are null.

    A cell that doesn't parse fails the read; contract.read_contract gives such cells as rejects, with their places.
    """
    header = spark.read.text(path).limit(1).first()
    if header is None or header[0].split("\t") != schema.names:
        raise ValueError(f"header of {path} isn't that of the contract")
    text = spark.read.option("sep", "\t").option("header", True).option("quote", "").schema(", ".join(f"`{n}` string" for n in schema.names)).csv(path)

    def cell(f):
        value = F.when(~F.col(f.name).isin(*MISSING), F.col(f.name))
        typed = value.try_cast(f.dataType)
        return F.when(value.isNotNull() & typed.isNull(), F.raise_error(F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), value))).otherwise(typed).alias(f.name)

    return text.select(*[cell(f) for f in schema.fields])


def read_bed_targets(spark: SparkSession, path: str, contigs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """8-column targets and the rows rejected: not numeric, out of their contig, or a repeated (source, id)."""
    names = ["chrom", "start", "end", "target_region_id", "target_source", "region_type", "analysis_mode", "representative_locus_id"]
    rows = spark.read.option("sep", "\t").schema(", ".join(f"{n} string" for n in names)).csv(path)
    typed = rows.withColumns({"start": F.col("start").try_cast("long"), "end": F.col("end").try_cast("long")})
    ids = typed.groupBy("target_source", "target_region_id").agg(F.count("*").alias("_n"))
    joined = typed.join(contigs, "chrom", "left").join(ids, ["target_source", "target_region_id"], "left")
    reason = (
        F.when(F.col("start").isNull() | F.col("end").isNull(), "NOT_NUMERIC")
        .when((F.col("start") < 0) | (F.col("end") <= F.col("start")) | F.col("length").isNull() | (F.col("end") > F.col("length")), "OUT_OF_BOUNDS")
        .when(F.col("_n") > 1, "REPEATED_ID")
    )
    marked = joined.withColumn("reason", reason)
    return marked.filter("reason IS NULL").select(*names), marked.filter("reason IS NOT NULL").select(*names, "reason")


def let(value, use):
    """use(value), with value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def first_of_each(entries):
    """A map of the entries (k, v), the first of a repeated key counting, as public files may repeat keys."""
    kept = lambda es, keys: F.filter(es, lambda e, i: F.array_position(keys, e["k"]) == i + 1)
    return let(entries, lambda es: let(F.transform(es, lambda x: x["k"]), lambda keys: F.map_from_entries(kept(es, keys))))


def tags_of(columns, first: int):
    """The map of name:type:value tags behind so many fixed columns; of a repeated name the first counts."""
    rest = F.filter(F.slice(columns, first + 1, F.greatest(F.lit(0), F.size(columns) - first)), lambda t: F.regexp_like(t, F.lit("^[A-Za-z][A-Za-z0-9]:[AifZHB]:")))
    return first_of_each(F.transform(rest, lambda t: F.struct(F.substring(t, 1, 2).alias("k"), F.substring(t, F.lit(6), F.length(t)).alias("v"))))


def fields_of(lines: DataFrame) -> DataFrame:
    """lines with `_c`, the fields of a line of tab-separated text.

    A generator's result stands where it was made: a filter that names a field isn't moved before the split, which would
    then be worked out again for each name.
    """
    return lines.select("*", F.explode(F.array(F.split("value", "\t", -1))).alias("_c"))


def sam_alignments(lines: DataFrame) -> DataFrame:
    """lines[value] of SAM text -> one row for each record: flags by bit, class, position, CIGAR, tags."""
    lines, c = fields_of(lines), F.col("_c")
    flag = F.get(c, F.lit(1)).cast("int")
    bit = lambda b: flag.bitwiseAND(b) != 0
    kind = F.when(bit(4), "unmapped").when(bit(256), "secondary").when(bit(2048), "supplementary").otherwise("primary")
    rows = lines.filter(~F.startswith("value", F.lit("@")) & (F.size(c) >= 11))
    return rows.select(
        F.get(c, F.lit(0)).alias("read_id"), flag.alias("sam_flag"), kind.alias("alignment_class"), F.when(bit(16), "-").otherwise("+").alias("strand"), F.get(c, F.lit(2)).alias("chrom"),
        (F.get(c, F.lit(3)).cast("long") - 1).alias("ref_start"), F.get(c, F.lit(4)).cast("int").alias("mapq"), F.get(c, F.lit(5)).alias("cigar"), F.get(c, F.lit(9)).alias("seq"), tags_of(c, 11).alias("tags"),
    )


def paf_alignments(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """lines[value] of pairwise alignment text -> typed rows with identity, coverage and score, and the rejects."""
    lines, c = fields_of(lines), F.col("_c")
    text = lambda i: F.get(c, F.lit(i))
    whole = lambda i: text(i).try_cast("long")
    tags = tags_of(c, 12)
    names = ["query_name", "query_length", "query_start", "query_end", "strand", "target_name", "target_length", "target_start", "target_end", "residue_matches", "alignment_block_length", "mapq"]
    rows = lines.select("value", F.size(c).alias("_n"), *[(text(i) if i in (0, 4, 5) else whole(i)).alias(n) for i, n in enumerate(names)], tags.alias("tags"))
    span = lambda s, e, n: (F.col(s) >= 0) & (F.col(e) > F.col(s)) & (F.col(e) <= F.col(n))
    good = (F.col("_n") >= 12) & F.col("strand").isin("+", "-") & span("query_start", "query_end", "query_length") & span("target_start", "target_end", "target_length")
    good = F.coalesce(good & F.col("residue_matches").isNotNull() & F.col("mapq").isNotNull() & (F.col("alignment_block_length") > 0), F.lit(False))
    score = F.coalesce(F.try_element_at("tags", F.lit("AS")).try_cast("long"), F.col("residue_matches"))
    derived = {
        "identity": F.col("residue_matches") / F.col("alignment_block_length"),
        "query_coverage": (F.col("query_end") - F.col("query_start")) / F.col("query_length"),
        "score": score,
    }
    marked = rows.withColumn("_ok", good)
    return marked.filter("_ok").withColumns(derived).drop("value", "_n", "_ok"), marked.filter("NOT _ok").select("value")


def gtf_features(lines: DataFrame) -> DataFrame:
    """lines[value] of GTF text -> features with 0-based half-open coordinates and attributes as a map.

    Attributes may be quoted or not; of one that is given more than once, as `tag`, the map has the first and
    `repeated` all of them in order.
    """
    c = F.split("value", "\t", -1)
    text = lambda i: F.get(c, F.lit(i))
    start, end = text(3).try_cast("long"), text(4).try_cast("long")
    keys, values = (F.regexp_extract_all(text(8), F.lit('([A-Za-z0-9_.]+) +"?([^";]*)"?'), F.lit(i)) for i in (1, 2))
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    again = F.filter(F.array_distinct(keys), lambda k: F.size(F.filter(keys, lambda x: x == k)) > 1)
    repeated = F.map_from_entries(F.transform(again, lambda k: F.struct(k.alias("k"), F.transform(F.filter(pairs, lambda p: p["k"] == k), lambda p: p["v"]).alias("v"))))
    rows = lines.filter(~F.startswith("value", F.lit("#")) & (F.size(c) == 9) & (start >= 1) & (end >= start))
    return rows.select(text(0).alias("chrom"), text(2).alias("feature"), (start - 1).alias("start"), end.alias("end"), text(6).alias("strand"), first_of_each(pairs).alias("attributes"), repeated.alias("repeated"))


def gtf_features_counted(lines: DataFrame) -> tuple[DataFrame, Observation]:
    """gtf_features(lines) and the counts of the same pass: lines, comments, malformed, invalid and features.

    Malformed lines have other than nine fields, invalid ones no span of whole numbers from 1 on. The counts are there
    once the rows were written or collected: the text is read once.
    """
    seen, c = Observation(), F.split("value", "\t", -1)
    comment, nine = F.startswith("value", F.lit("#")), F.size(c) == 9
    start, end = (F.get(c, F.lit(i)).try_cast("long") for i in (3, 4))
    spans = F.coalesce((start >= 1) & (end >= start), F.lit(False))
    kinds = {"comments": comment, "malformed": ~comment & ~nine, "invalid": ~comment & nine & ~spans, "features": ~comment & nine & spans}
    counted = lines.observe(seen, F.count(F.lit(1)).alias("lines"), *[F.count_if(F.coalesce(k, F.lit(False))).alias(n) for n, k in kinds.items()])
    return gtf_features(counted), seen


def pivot_key_values(records: DataFrame, keys: list[str]) -> DataFrame:
    """record_index, key, value triples -> one row for each index with the known keys as columns."""
    return records.groupBy("record_index").pivot("key", keys).agg(F.min("value"))


def fetch_tiles(intervals: DataFrame, tiles: DataFrame, tile_bp: int) -> DataFrame:
    """intervals[contig, start, end, ...] with `sequence`, from reference tiles[contig, tile_no, seq]."""
    keyed = intervals.withColumn("_id", F.xxhash64("contig", "start", "end")).select("contig", "start", "end", "_id").distinct()
    wanted = keyed.withColumn("tile_no", F.explode(F.sequence(F.floor(F.col("start") / tile_bp), F.floor((F.col("end") - 1) / tile_bp))))
    joined = wanted.join(tiles, ["contig", "tile_no"]).groupBy("contig", "start", "end").agg(F.array_sort(F.collect_list(F.struct("tile_no", "seq"))).alias("parts"))
    whole = F.array_join(F.transform("parts", lambda p: p["seq"]), "")
    cut = joined.select("contig", "start", "end", F.substring(whole, (F.col("start") % tile_bp + 1).cast("int"), (F.col("end") - F.col("start")).cast("int")).alias("sequence"))
    return intervals.join(cut, ["contig", "start", "end"])
