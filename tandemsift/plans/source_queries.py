"""Queries of readers and metric tables, on text made of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from ..sources import contract, package, readers
from ..sources.scratch import new_folder
from ..streaming import incremental
from .common import register

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)


@query(
    "read_sam_alignments", "alignments",
    """SELECT 'R' || read_id AS read_id, ordinal::VARCHAR AS hit, alignment_class, strand, chrom, ref_start, mapq, cigar FROM alignments""",
)
def _(alignments):
    flag = F.when(F.col("alignment_class") == "secondary", 256).when(F.col("alignment_class") == "supplementary", 2048).otherwise(0) + F.when(F.col("strand") == "-", 16).otherwise(0)
    line = F.concat_ws("\t", F.concat(F.lit("R"), "read_id"), flag, "chrom", F.col("ref_start") + 1, "mapq", "cigar", F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"), F.lit("*"), F.concat(F.lit("HI:i:"), "ordinal"))
    found = readers.sam_alignments(alignments.select(line.alias("value")))
    return found.select("read_id", F.col("tags")["HI"].alias("hit"), "alignment_class", "strand", "chrom", "ref_start", "mapq", "cigar")


@query(
    "read_paf_alignments", "paf_rows",
    """SELECT query_name, target_name, round(residue_matches / 100.0::DOUBLE, 6) AS identity, round((query_end - query_start) / 120.0::DOUBLE, 6) AS query_coverage, CASE WHEN ordinal % 2 = 0 THEN ordinal * 10 ELSE residue_matches END::BIGINT AS score FROM paf_rows WHERE ordinal % 7 <> 0""",
)
def _(paf):
    fixed = ["query_name", "query_length", "query_start", "query_end", F.when(F.col("ordinal") % 7 == 0, "?").otherwise(F.col("strand")), "target_name", "target_length", "target_start", "target_end", "residue_matches", "alignment_block_length", "mapq"]
    score = F.when(F.col("ordinal") % 2 == 0, F.concat(F.lit("AS:i:"), F.col("ordinal") * 10)).otherwise(F.lit("tp:A:P"))
    rows, _rejects = readers.paf_alignments(paf.select(F.concat_ws("\t", *fixed, score).alias("value")))
    return rows.select("query_name", "target_name", F.round("identity", 6).alias("identity"), F.round("query_coverage", 6).alias("query_coverage"), "score")


@query("read_gtf_features", "gtf_rows", "SELECT chrom, feature, (start_1based - 1)::BIGINT AS start, end_1based::BIGINT AS stop, strand, transcript_id FROM gtf_rows")
def _(gtf):
    attributes = F.concat(F.lit('gene_id "g"; transcript_id "'), "transcript_id", F.lit('";'))
    line = F.concat_ws("\t", "chrom", F.lit("src"), "feature", "start_1based", "end_1based", F.lit("."), "strand", F.lit("."), attributes)
    rows = readers.gtf_features(gtf.select(line.alias("value")))
    return rows.select("chrom", "feature", "start", F.col("end").alias("stop"), "strand", F.col("attributes")["transcript_id"].alias("transcript_id"))


@query(
    "pivot_key_value_records", "part",
    "SELECT p_partkey AS record_index, p_brand AS brand, CASE WHEN p_partkey % 3 > 0 THEN p_type END AS type FROM part",
)
def _(part):
    pairs = F.array(F.struct(F.lit("brand").alias("key"), F.col("p_brand").alias("value")), F.struct(F.when(F.col("p_partkey") % 3 > 0, "type").otherwise("other").alias("key"), F.col("p_type").alias("value")))
    return readers.pivot_key_values(part.select(F.col("p_partkey").alias("record_index"), F.explode(pairs).alias("r")).select("record_index", "r.*"), ["brand", "type"])


@query(
    "reference_tile_fetch", "targets",
    """SELECT target_region_id, array_to_string(list_transform(range(start_pos, end_pos), lambda p: substr(translate(md5(chrom || ':' || (p // 32)), '0123456789abcdef', 'ACGTACGTACGTACGT'), (p % 32 + 1)::INT, 1)), '') AS sequence FROM targets""",
)
def _(targets):
    """Reference bases of every target from tiles of 32 bases."""
    places = targets.select("chrom", F.explode(F.sequence(F.floor(F.col("start_pos") / 32), F.floor((F.col("end_pos") - 1) / 32))).alias("tile_no")).distinct()
    tiles = places.select(F.col("chrom").alias("contig"), "tile_no", F.translate(F.md5(F.concat_ws(":", "chrom", "tile_no")), "0123456789abcdef", "ACGTACGTACGTACGT").alias("seq"))
    intervals = targets.select("target_region_id", F.col("chrom").alias("contig"), F.col("start_pos").alias("start"), F.col("end_pos").alias("end"))
    return readers.fetch_tiles(intervals, tiles, 32).select("target_region_id", "sequence")


@query(
    "metric_table", "orders",
    """SELECT 'status::' || o_orderstatus AS metric, count(*) AS value FROM orders GROUP BY 1 UNION ALL SELECT 'priority::' || o_orderpriority, count(*) FROM orders GROUP BY 1 UNION ALL SELECT 'orders', count(*) FROM orders""",
)
def _(orders):
    """Counts by category as one long table, from one pass over the rows."""
    keys = F.array(F.concat(F.lit("status::"), "o_orderstatus"), F.concat(F.lit("priority::"), "o_orderpriority"), F.lit("orders"))
    return orders.select(F.explode(keys).alias("metric")).groupBy("metric").agg(F.count("*").alias("value"))


@query(
    "read_tsv_contract", "orders",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice::DOUBLE END AS price FROM orders""",
)
def _(orders):
    """Orders written as tab-separated text with marks for missing values, and read back under a contract."""
    folder = new_folder(orders.sparkSession, "contract")
    missing = lambda every, mark, c: F.when(F.col("o_orderkey") % every == 0, mark).otherwise(F.col(c).cast("string"))
    orders.select(F.col("o_orderkey").alias("id"), missing(5, ".", "o_orderstatus").alias("status"), missing(7, "NA", "o_totalprice").alias("price")).write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(folder)
    return readers.read_tsv_contract(orders.sparkSession, folder, StructType().add("id", LongType()).add("status", StringType()).add("price", DoubleType()))


@query(
    "read_tsv_contract_rejects", "orders",
    """WITH k AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 13 = 0 THEN 'Z' WHEN o_orderkey % 5 = 0 THEN '.' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 7 = 0 THEN 'NA' WHEN o_orderkey % 11 = 0 THEN '12,5' WHEN o_orderkey % 19 = 0 THEN '-1' END AS mark, o_totalprice::DOUBLE AS price FROM orders),
      r AS (SELECT k, 'status' AS col, 'NOT_IN_ENUM' AS reason, status AS value FROM k WHERE status = 'Z' UNION ALL SELECT k, 'price', CASE mark WHEN '-1' THEN 'BELOW_LEAST' ELSE 'NOT_NUMBER' END, mark FROM k WHERE mark IN ('-1', '12,5') UNION ALL SELECT k, 'id', 'BELOW_LEAST', k::VARCHAR FROM k WHERE k < 1)
      SELECT k AS id, status, CASE WHEN mark IS NULL THEN price END AS price, NULL AS col, NULL AS reason, NULL AS value FROM k WHERE k NOT IN (SELECT k FROM r) UNION ALL SELECT NULL, NULL, NULL, col, reason, value FROM r""",
)
def _(orders):
    """Orders written as tab-separated text with damaged cells: the rows that keep the contract and every cell that doesn't."""
    spark, k = orders.sparkSession, F.col("o_orderkey")
    status = F.when(k % 13 == 0, "Z").when(k % 5 == 0, ".").otherwise(F.col("o_orderstatus"))
    price = F.when(k % 7 == 0, "NA").when(k % 11 == 0, "12,5").when(k % 19 == 0, "-1").otherwise(F.col("o_totalprice").cast("string"))
    orders.select(k.alias("id"), status.alias("status"), price.alias("price")).write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(folder := new_folder(spark, "contract"))
    fields = [contract.Field("id", "integer", required=True, least=1), contract.Field("status", values=("F", "O", "P", "."), required=True), contract.Field("price", "number", least=0)]
    rows, rejects = contract.read_contract(spark, folder, fields)
    return rows.unionByName(rejects.select(F.col("column").alias("col"), "reason", "value"), allowMissingColumns=True)


@query(
    "read_gtf_features_counters", "gtf_rows",
    """WITH k AS (SELECT start_1based % 7 = 0 AS comment, start_1based % 5 = 0 AS short, start_1based % 3 = 0 AS odd FROM gtf_rows)
      SELECT unnest(['lines', 'comments', 'malformed', 'invalid', 'features']) AS metric, unnest([count(*), count(*) FILTER (comment), count(*) FILTER (NOT comment AND short), count(*) FILTER (NOT comment AND NOT short AND odd), count(*) FILTER (NOT comment AND NOT short AND NOT odd)]) AS value FROM k""",
)
def _(gtf):
    """Features written as GTF lines, some of them comments, short or without a span, and the counts of the pass that reads them."""
    spark, k = gtf.sparkSession, F.col("start_1based")
    start = F.when(k % 3 == 0, F.when(k % 2 == 0, "x").otherwise("0")).otherwise(k.cast("string"))
    fields = F.concat_ws("\t", "chrom", F.lit("src"), "feature", start, F.col("end_1based").cast("string"), F.lit("."), "strand", F.lit("."))
    line = F.when(k % 7 == 0, F.concat(F.lit("#"), fields)).when(k % 5 == 0, fields).otherwise(F.concat(fields, F.lit('\ttranscript_id "'), "transcript_id", F.lit('";')))
    gtf.select(line.alias("value")).write.text(lines := new_folder(spark, "gtf"))
    rows, seen = readers.gtf_features_counted(spark.read.text(lines))
    rows.write.parquet(new_folder(spark, "features"))
    return spark.createDataFrame(list(seen.get.items()), "metric string, value long")


@query(
    "read_bed_targets", "targets",
    """WITH k AS (SELECT *, CAST(substr(target_region_id, 2) AS INT) AS k FROM targets), b AS (SELECT chrom, CASE WHEN k % 17 = 0 THEN 'T0' ELSE target_region_id END AS target_region_id, target_source, CASE WHEN k % 11 > 0 THEN start_pos END AS start, CASE WHEN k % 13 = 0 THEN 99999 ELSE end_pos END AS stop FROM k),
      n AS (SELECT *, count(*) OVER (PARTITION BY target_source, target_region_id) AS n FROM b)
      SELECT chrom, target_region_id, target_source, start::BIGINT AS start, stop::BIGINT AS stop, CASE WHEN start IS NULL THEN 'NOT_NUMERIC' WHEN stop > 30000 THEN 'OUT_OF_BOUNDS' WHEN n > 1 THEN 'REPEATED_ID' END AS reason FROM n""",
)
def _(targets):
    """Targets written as BED lines, some of them damaged: what is taken and what is rejected, and why."""
    spark, k = targets.sparkSession, F.substring("target_region_id", 2, 20).cast("int")
    lines = targets.select(
        "chrom", F.when(k % 11 == 0, "x").otherwise(F.col("start_pos").cast("string")), F.when(k % 13 == 0, 99999).otherwise(F.col("end_pos")), F.when(k % 17 == 0, "T0").otherwise(F.col("target_region_id")), "target_source",
        F.lit("TR"), F.lit("scan"), F.concat(F.lit("L"), k),
    )
    lines.toDF(*"abcdefgh").write.option("sep", "\t").csv(folder := new_folder(spark, "bed"))
    contigs = targets.select("chrom").distinct().withColumn("length", F.lit(30000).cast("long"))
    good, bad = readers.read_bed_targets(spark, folder, contigs)
    rows = good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad)
    return rows.select("chrom", "target_region_id", "target_source", "start", F.col("end").alias("stop"), "reason")


PACKAGED = "segments targets reads"


@query("write_result_package", PACKAGED, "SELECT 'segments' AS \"table\", count(*) AS rows, 32 AS broken FROM segments UNION ALL SELECT 'targets', count(*), 32 FROM targets UNION ALL SELECT 'reads', count(*), 32 FROM reads".replace("32", "0::BIGINT"))
def _(segments, targets, reads):
    """The manifest of a published package, and how many of its tables don't agree with it."""
    folder = new_folder(segments.sparkSession, "package")
    manifest = package.write_result_package({"segments": segments, "targets": targets, "reads": reads}, folder)
    broken = package.manifest_integrity(segments.sparkSession, folder).groupBy(F.col("table").alias("_t")).agg(F.count("*").alias("broken"))
    return manifest.join(broken, F.col("table") == F.col("_t"), "left").select("table", "rows", F.coalesce("broken", F.lit(0)).alias("broken"))


@query(
    "manifest_integrity", PACKAGED,
    """SELECT 'segments' AS "table", count(*) AS rows, count(*) FILTER (read_id % 7 > 0) AS found_rows FROM segments UNION ALL SELECT 'targets', count(*), count(*) FROM targets""",
)
def _(segments, targets, reads):
    """A package of which one table has lost rows and another has other values after publishing."""
    spark, folder = segments.sparkSession, new_folder(segments.sparkSession, "package")
    package.write_result_package({"segments": segments, "targets": targets, "reads": reads}, folder)
    segments.filter("read_id % 7 > 0").write.mode("overwrite").parquet(f"{folder}/segments")
    targets.withColumn("end_pos", F.col("end_pos") + 1).write.mode("overwrite").parquet(f"{folder}/targets")
    return package.manifest_integrity(spark, folder).select("table", "rows", "found_rows")


@query(
    "incremental_evidence_runs", "events",
    "SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users FROM events WHERE event_id % 3 = 0 OR event_id % 2 = 0 GROUP BY event_type",
)
def _(events):
    """Two runs over a folder to which files come, the later ones with rows given before; one run without any."""
    spark, base = events.sparkSession, new_folder(events.sparkSession, "incremental")
    rows = events.select("event_id", "user_id", "event_type")

    def run():
        incremental.incremental_evidence(spark, f"{base}/in", rows.schema, f"{base}/out", f"{base}/checkpoint", "event_id", lambda df: df.withColumn("done", F.lit(True))).awaitTermination()

    rows.filter("event_id % 3 = 0").write.parquet(f"{base}/in")
    run()
    again = rows.filter("event_id % 2 = 0")
    again.unionByName(again.filter("event_id % 10 = 0")).write.mode("append").parquet(f"{base}/in")
    run()
    run()
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count("*").alias("events"), F.count_distinct("user_id").alias("users"))


@query(
    "manifest_integrity_files", PACKAGED,
    """SELECT 'segments' AS "table", 'MISSING' AS reason, count(*) AS rows FROM segments UNION ALL SELECT 'targets', 'SIZE', count(*) FROM targets UNION ALL SELECT 'reads', 'ADDED', count(*) FROM reads""",
)
def _(segments, targets, reads):
    """A package of which one table has lost a file, one has a file cut short and one has a file that isn't listed."""
    spark, folder = segments.sparkSession, new_folder(segments.sparkSession, "package")
    manifest = package.write_result_package({"segments": segments, "targets": targets, "reads": reads}, folder)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    first = {t: min(f for (f,) in spark.read.json(f"{folder}/files").filter(F.col("table") == t).select("file").collect()) for t in ("segments", "targets")}
    fs.delete(hadoop(f"{folder}/segments/{first['segments']}"), False)
    for damaged in (f"targets/{first['targets']}", "reads/part-other.parquet"):
        out = fs.create(hadoop(f"{folder}/{damaged}"), True)
        out.write(bytearray(b"PAR1"))
        out.close()
    return package.file_integrity(spark, folder).join(manifest, "table").select("table", "reason", "rows")


@query(
    "incremental_evidence_buckets", "events",
    "SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users FROM events WHERE event_id % 3 = 0 OR event_id % 2 = 0 GROUP BY event_type",
)
def _(events):
    """Two runs whose output is dealt to buckets by key, the second with rows given before."""
    spark, base = events.sparkSession, new_folder(events.sparkSession, "incremental")
    rows = events.select("event_id", "user_id", "event_type")
    for part in ("event_id % 3 = 0", "event_id % 2 = 0"):
        rows.filter(part).write.mode("append").parquet(f"{base}/in")
        incremental.incremental_evidence(spark, f"{base}/in", rows.schema, f"{base}/out", f"{base}/checkpoint", "event_id", lambda df: df, buckets=16).awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count("*").alias("events"), F.count_distinct("user_id").alias("users"))


@query(
    "package_parity_by_digest", "lineitem",
    """WITH a AS (SELECT l_orderkey, l_partkey, l_quantity FROM lineitem), b AS (SELECT l_orderkey, l_partkey, l_quantity + (l_partkey % 997 = 5)::INT AS l_quantity FROM lineitem UNION ALL SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_orderkey % 1009 = 7)
      SELECT 'ONLY_A' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'ONLY_B', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
)
def _(lineitem):
    """Two runs compared by a tree of digests, here one with damaged and repeated values."""
    a = lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    b = a.withColumn("l_quantity", F.col("l_quantity") + (F.col("l_partkey") % 997 == 5).cast("int")).unionByName(a.filter("l_orderkey % 1009 = 7"))
    return package.differing_rows(a, b)
