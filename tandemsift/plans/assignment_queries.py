"""Queries of alignment structure and of the assignment of reads to targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alignments as al
from ..operators import assignment as asg
from ..operators import intervals as iv
from .common import register

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)
OPS = """WITH l AS (SELECT *, regexp_extract_all(cigar, '[0-9]+[MIDNSHP=X]') AS parts FROM alignments),
    u AS (SELECT read_id, ordinal, chrom, ref_start, alignment_class, strand, mapq, parts, unnest(range(len(parts)))::INT AS op_index FROM l),
    o AS (SELECT * EXCLUDE (parts), right(parts[op_index + 1], 1) AS op, regexp_extract(parts[op_index + 1], '^[0-9]+')::INT AS op_len FROM u),
    p AS (SELECT *, coalesce(sum(CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN op_len ELSE 0 END) OVER w, 0)::BIGINT AS ref_offset,
      coalesce(sum(CASE WHEN op IN ('M', 'I', 'S', '=', 'X') THEN op_len ELSE 0 END) OVER w, 0)::BIGINT AS query_offset,
      coalesce(sum((op = 'N')::INT) OVER w, 0)::BIGINT AS skips FROM o WINDOW w AS (PARTITION BY read_id, ordinal ORDER BY op_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
BLOCKS = OPS + """,
    k AS (SELECT read_id, ordinal, chrom, skips, min(ref_start + ref_offset) AS block_start, max(ref_start + ref_offset + op_len) AS block_end FROM p WHERE op IN ('M', 'D', '=', 'X') GROUP BY ALL),
    kb AS (SELECT read_id, ordinal, chrom, block_start::BIGINT AS block_start, block_end::BIGINT AS block_end, (row_number() OVER (PARTITION BY read_id, ordinal ORDER BY block_start) - 1)::INT AS block_index FROM k)"""  # fmt: skip
#: Targets that lie wholly in an alignment's first 40 reference bases, one contig at a time.
PAIRED = "SELECT a.*, t.target_region_id, t.start_pos, t.end_pos FROM alignments a JOIN targets t ON a.chrom = t.chrom AND t.start_pos >= a.ref_start AND t.end_pos <= a.ref_start + 55"


def paired(alignments, targets):
    spans = alignments.withColumn("span_end", F.col("ref_start") + 55)
    joined = iv.interval_join(spans, targets, ("chrom", "ref_start", "span_end"), ("chrom", "start_pos", "end_pos"))
    return joined.filter("start_pos >= ref_start AND end_pos <= span_end").select("read_id", "ordinal", "ref_start", "cigar", "target_region_id", "start_pos", "end_pos")


@query("cigar_ops", "alignments", OPS + " SELECT read_id, ordinal, op_index, op, op_len FROM o")
def _(alignments):
    return al.cigar_ops(alignments).select("read_id", "ordinal", "op_index", "op", "op_len")


@query("cigar_positions", "alignments", OPS + " SELECT read_id, ordinal, op_index, op, ref_offset, query_offset FROM p")
def _(alignments):
    return al.cigar_positions(alignments.select("read_id", "ordinal", "ref_start", "cigar")).select("read_id", "ordinal", "op_index", "op", "ref_offset", "query_offset")


@query(
    "alignment_features", "alignments",
    OPS + """ SELECT read_id, ordinal, count(*) FILTER (op = 'N') AS splice_junctions, sum(CASE WHEN op = 'N' THEN op_len ELSE 0 END)::BIGINT AS intron_bp,
      sum(CASE WHEN op = 'I' THEN op_len ELSE 0 END)::BIGINT AS insertion_bp, sum(CASE WHEN op = 'D' THEN op_len ELSE 0 END)::BIGINT AS deletion_bp,
      sum(CASE WHEN op = 'S' AND op_index = 0 THEN op_len ELSE 0 END)::BIGINT AS clip_left_bp, 0::BIGINT AS clip_right_bp,
      CASE WHEN any_value(alignment_class) <> 'primary' OR any_value(mapq) < 10 THEN 'WARN' ELSE 'PASS' END AS qc_status,
      concat_ws(';', CASE any_value(alignment_class) WHEN 'secondary' THEN 'SECONDARY' WHEN 'supplementary' THEN 'SUPPLEMENTARY' END, CASE WHEN any_value(mapq) < 10 THEN 'LOW_MAPQ_LT_10' END,
        'SPLICED', CASE WHEN sum(CASE WHEN op = 'S' THEN op_len ELSE 0 END) > 0 THEN 'SOFTCLIPPED' END, CASE WHEN any_value(alignment_class) = 'supplementary' THEN 'CHIMERIC_CANDIDATE' END) AS flags
      FROM o GROUP BY read_id, ordinal""",
)
def _(alignments):
    return al.features(alignments).drop("chrom", "alignment_class", "strand", "mapq", "chimeric")


@query("splice_blocks", "alignments", BLOCKS + " SELECT * FROM kb")
def _(alignments):
    return al.splice_blocks(alignments)


@query("padded_blocks", "blocks", "SELECT read_id, ordinal, block_index, greatest(0, block_start - 500)::BIGINT AS padded_start, (block_end + 500)::BIGINT AS padded_end FROM blocks")
def _(blocks):
    return al.padded(blocks).select("read_id", "ordinal", "block_index", F.col("padded_start").cast("long"), F.col("padded_end").cast("long"))


@query(
    "project_boundary", "alignments",
    OPS + """, b AS (SELECT *, ref_start - 5 + (read_id * 7) % 300 AS boundary, ref_start + ref_offset AS r0,
        ref_start + ref_offset + CASE WHEN op IN ('M', 'D', 'N') THEN op_len ELSE 0 END AS r1, query_offset + CASE WHEN op IN ('M', 'I', 'S') THEN op_len ELSE 0 END AS q1 FROM p),
      h AS (SELECT *, CASE WHEN boundary = r0 THEN query_offset WHEN op = 'M' THEN query_offset + boundary - r0 ELSE query_offset END AS q,
        CASE WHEN boundary = r0 THEN 'PROJECTED_AT_OPERATION_BOUNDARY' WHEN op = 'M' THEN 'PROJECTED_WITHIN_MATCHLIKE' WHEN op = 'D' THEN 'PROJECTED_WITHIN_DELETION' ELSE 'PROJECTED_WITHIN_REFERENCE_SKIP' END AS s
        FROM b WHERE boundary = r0 OR (op IN ('M', 'D', 'N') AND r0 < boundary AND boundary <= r1)),
      f AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY read_id, ordinal ORDER BY op_index) = 1),
      e AS (SELECT read_id, ordinal, any_value(boundary) AS boundary, any_value(ref_start) AS ref_start, max(r1) AS r1, max(q1) AS q1 FROM b GROUP BY ALL)
      SELECT e.read_id, e.ordinal, e.boundary, CASE WHEN e.boundary < e.ref_start THEN NULL WHEN f.q IS NOT NULL THEN f.q WHEN e.boundary = e.r1 THEN e.q1 END::BIGINT AS query_position,
        CASE WHEN e.boundary < e.ref_start THEN 'BOUNDARY_BEFORE_ALIGNMENT' WHEN f.s IS NOT NULL THEN f.s WHEN e.boundary = e.r1 THEN 'PROJECTED_AT_ALIGNMENT_END' ELSE 'BOUNDARY_AFTER_ALIGNMENT' END AS status
      FROM e LEFT JOIN f USING (read_id, ordinal)""",
)
def _(alignments):
    return al.project_boundary(alignments.withColumn("boundary", F.col("ref_start") - 5 + (F.col("read_id") * 7) % 300), "boundary")


@query(
    "project_interval", "alignments targets",
    f"""WITH a AS ({PAIRED}), x AS (SELECT *, regexp_extract(cigar, '^[0-9]+')::INT AS s, regexp_extract(cigar, 'M([0-9]+)I', 1)::INT AS i FROM a),
      m AS (SELECT read_id, ordinal, target_region_id, s + greatest(start_pos, ref_start) - ref_start AS q0, s + least(end_pos, ref_start + 30) - ref_start AS q1 FROM x WHERE least(end_pos, ref_start + 30) > greatest(start_pos, ref_start)
        UNION ALL SELECT read_id, ordinal, target_region_id, s + 30, s + 30 + i FROM x WHERE ref_start + 30 BETWEEN start_pos AND end_pos
        UNION ALL SELECT read_id, ordinal, target_region_id, s + 30 + i + greatest(start_pos, ref_start + 30) - ref_start - 30, s + 30 + i + least(end_pos, ref_start + 55) - ref_start - 30 FROM x WHERE least(end_pos, ref_start + 55) > greatest(start_pos, ref_start + 30))
      SELECT read_id, ordinal, target_region_id, min(q0)::BIGINT AS query_start, max(q1)::BIGINT AS query_end FROM m GROUP BY ALL""",
)
def _(alignments, targets):
    return al.project_interval(paired(alignments, targets))


@query(
    "orient_raw_interval", "paf_rows",
    """SELECT query_name, ordinal, CASE WHEN strand = '-' THEN query_length - query_end - ordinal ELSE query_start + ordinal END AS raw_start,
      CASE WHEN strand = '-' THEN query_length - query_start - ordinal ELSE query_end + ordinal END AS raw_end FROM paf_rows""",
)
def _(paf):
    start, end = al.orient(F.col("query_start"), F.col("query_end"), F.col("query_length"), F.col("strand") == "-", F.col("ordinal"))
    return paf.select("query_name", "ordinal", start.alias("raw_start"), end.alias("raw_end"))


@query(
    "query_length_audit", "alignments reads",
    OPS + """, q AS (SELECT read_id, ordinal, any_value(alignment_class) AS alignment_class, sum(CASE WHEN op IN ('M', 'I', 'S', '=', 'X', 'H') THEN op_len ELSE 0 END) AS n FROM o GROUP BY read_id, ordinal)
      SELECT alignment_class, count(*) AS alignments, count(*) FILTER (q.n = len(r.seq)) AS equal, count(*) FILTER (q.n > len(r.seq)) AS longer, sum(abs(q.n - len(r.seq)))::BIGINT AS difference_bp FROM q JOIN reads r USING (read_id) GROUP BY alignment_class""",
)
def _(alignments, reads):
    """Query length from the CIGAR, hard clips included, against the read's, by alignment class."""
    ops = al.cigar_ops(alignments)
    size = F.sum(F.when(F.col("op").isin("M", "I", "S", "=", "X", "H"), F.col("op_len")).otherwise(0))
    lengths = ops.groupBy("read_id", "ordinal", "alignment_class").agg(size.alias("n")).join(reads.select("read_id", F.length("seq").alias("size")), "read_id")
    n, k = F.col("n"), F.col("size")
    return lengths.groupBy("alignment_class").agg(F.count("*").alias("alignments"), F.count_if(n == k).alias("equal"), F.count_if(n > k).alias("longer"), F.sum(F.abs(n - k)).alias("difference_bp"))


@query(
    "anchor_bases", "alignments targets",
    f"""WITH a AS ({PAIRED}), m AS (SELECT read_id, ordinal, target_region_id, start_pos, end_pos, unnest([ref_start, ref_start + 30, ref_start + 155 + (regexp_extract(cigar, 'M([0-9]+)N', 1)::INT - 100), ref_start + 175 + (regexp_extract(cigar, 'M([0-9]+)N', 1)::INT - 100) + regexp_extract(cigar, 'M([0-9]+)D', 1)::INT]) AS r0, unnest([30, 25, 20, 40]) AS n FROM a)
      SELECT read_id, ordinal, target_region_id, sum(greatest(0, least(r0 + n, start_pos) - greatest(r0, greatest(0, start_pos - 100))))::BIGINT AS left_anchor_bp, sum(greatest(0, least(r0 + n, end_pos + 100) - greatest(r0, end_pos)))::BIGINT AS right_anchor_bp FROM m GROUP BY ALL""",
)
def _(alignments, targets):
    return al.anchor_bases(paired(alignments, targets))


CANDIDATES = "SELECT read_id, ordinal, target_source, target_region_id, target_overlap_bp::BIGINT AS target_overlap_bp, target_distance_bp::BIGINT AS target_distance_bp, supporting_block_count, CASE WHEN target_overlap_bp > 0 THEN 'EXACT_OVERLAP' ELSE 'PROXIMAL' END AS candidate_basis FROM candidates"
BEST = f"""WITH c AS ({CANDIDATES}), j AS (SELECT c.*, a.alignment_class, a.mapq, a.strand, CASE a.alignment_class WHEN 'primary' THEN 3 WHEN 'supplementary' THEN 2 ELSE 1 END AS class_priority FROM c JOIN alignments a USING (read_id, ordinal)),
      n AS (SELECT read_id, target_source, target_region_id, count(*) AS supporting_alignment_count, bool_or(alignment_class = 'primary') AS primary_support, bool_or(alignment_class = 'supplementary') AS supplementary_support, bool_or(alignment_class = 'secondary') AS secondary_support FROM j GROUP BY ALL),
      b AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY read_id, target_source, target_region_id ORDER BY target_overlap_bp > 0 DESC, target_overlap_bp DESC, target_distance_bp, class_priority DESC, mapq DESC, ordinal) = 1),
      r AS (SELECT b.* EXCLUDE (supporting_block_count), n.* EXCLUDE (read_id, target_source, target_region_id) FROM b JOIN n USING (read_id, target_source, target_region_id))"""  # fmt: skip


def wide(blocks):
    return blocks.withColumns({c: F.col(c).cast("long") for c in ("block_start", "block_end")})


@query("alignment_target_candidates", "blocks targets", CANDIDATES, oracle_views="candidates")
def _(blocks, targets):
    return asg.alignment_target_candidates(wide(blocks), targets)


@query("read_target_candidates", "blocks targets alignments", BEST + " SELECT * FROM r", oracle_views="blocks targets alignments candidates")
def _(blocks, targets, alignments):
    return asg.read_target_candidates(wide(blocks), targets, alignments)


@query(
    "assignment_rank", "blocks targets alignments",
    BEST + """ SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY target_overlap_bp > 0 DESC, target_overlap_bp DESC, target_distance_bp, class_priority DESC, mapq DESC, target_source, target_region_id)::INT AS assignment_rank,
      count(*) OVER (PARTITION BY read_id) AS read_candidate_target_count FROM r""",
    oracle_views="blocks targets alignments candidates",
)
def _(blocks, targets, alignments):
    return asg.ranked_targets(wide(blocks), targets, alignments)


@query(
    "alignment_distribution_qc", "lineitem",
    """SELECT l_returnflag, min(l_quantity) AS least, quantile_cont(l_quantity, 0.05) AS p05, quantile_cont(l_quantity, 0.5) AS p50, quantile_cont(l_quantity, 0.95) AS p95, max(l_quantity) AS most,
      count(*) FILTER (l_quantity >= 25) AS at_least_25, round(100.0 * count(*) FILTER (l_quantity >= 25) / count(*), 6) AS percent_25 FROM lineitem GROUP BY l_returnflag""",
)
def _(lineitem):
    """Exact quantiles by linear interpolation, counts and percents over thresholds."""
    over = F.count_if(F.col("l_quantity") >= 25)
    found = lineitem.groupBy("l_returnflag").agg(F.min("l_quantity").alias("least"), F.max("l_quantity").alias("most"), over.alias("at_least_25"), F.round(100.0 * over / F.count("*"), 6).alias("percent_25"))
    ladder = iv.quantiles(lineitem, ["l_returnflag"], F.col("l_quantity"), {"p05": 0.05, "p50": 0.5, "p95": 0.95}, tile=5)
    return found.join(ladder, "l_returnflag").select("l_returnflag", "least", "p05", "p50", "p95", "most", "at_least_25", "percent_25")


@query(
    "mapping_qc", "alignments",
    """SELECT alignment_class, count(*) AS records, count(DISTINCT read_id) AS reads, count(DISTINCT CASE WHEN mapq < 10 THEN read_id END) AS low_quality_reads, count(DISTINCT CASE WHEN strand = '-' THEN read_id END) AS reverse_reads,
      round(count(*) FILTER (strand = '-')::DOUBLE / count(*), 6) AS reverse_rate FROM alignments GROUP BY alignment_class""",
)
def _(alignments):
    reads = lambda c, name: F.count_distinct(F.when(c, F.col("read_id"))).alias(name)
    reverse = F.col("strand") == "-"
    return alignments.groupBy("alignment_class").agg(
        F.count("*").alias("records"), F.count_distinct("read_id").alias("reads"), reads(F.col("mapq") < 10, "low_quality_reads"), reads(reverse, "reverse_reads"), F.round(F.count_if(reverse) / F.count("*"), 6).alias("reverse_rate")
    )


@query(
    "read_length_stats", "reads",
    """WITH n AS (SELECT len(seq) AS n FROM reads), h AS (SELECT n, count(*) AS c FROM n GROUP BY n), s AS (SELECT n, sum(n * c) OVER (ORDER BY n DESC) AS so_far, sum(n * c) OVER () AS total FROM h)
      SELECT count(*) AS reads, sum(n)::BIGINT AS bases, min(n) AS least, round(avg(n), 6) AS mean, max(n) AS most, quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.5) AS median, quantile_cont(n, 0.75) AS q3, (SELECT max(n) FROM s WHERE 2 * so_far >= total) AS n50 FROM n""",
)
def _(reads):
    """Counts, mean, quartiles and N50. The running sum goes over the distinct lengths, not the reads."""
    n = reads.select(F.length("seq").alias("n"))
    stats = n.agg(F.count("*").alias("reads"), F.sum("n").alias("bases"), F.min("n").alias("least"), F.round(F.avg("n"), 6).alias("mean"), F.max("n").alias("most"))
    quartiles = iv.quantiles(n, [], F.col("n"), {"q1": 0.25, "median": 0.5, "q3": 0.75}, tile=1024)
    by_length = n.groupBy("n").agg((F.count("*") * F.col("n")).alias("held")).withColumn("least_n", -F.col("n"))
    running = iv.running_before(by_length, [], "least_n", ["least_n"], F.col("held"), "sum")
    total = n.agg(F.sum("n").alias("total"))
    n50 = running.join(F.broadcast(total), 2 * (F.col("_before") + F.col("held")) >= F.col("total")).agg(F.max("n").alias("n50"))
    return stats.join(F.broadcast(quartiles)).join(F.broadcast(n50)).select("reads", "bases", "least", "mean", "most", "q1", "median", "q3", "n50")  # one row each


@query(
    "candidate_multiplicity", "blocks targets",
    """WITH p AS (SELECT read_id, count(*) AS n, count(*) FILTER (target_overlap_bp > 0) AS exact, count(*) FILTER (target_source = 'DISEASE') AS disease FROM candidates GROUP BY read_id)
      SELECT read_id, n, exact, n - exact AS proximal, disease, CASE WHEN n = 1 THEN '1' WHEN n <= 5 THEN '2_5' WHEN n <= 10 THEN '6_10' WHEN n <= 20 THEN '11_20' WHEN n <= 50 THEN '21_50' ELSE 'GT50' END AS bin FROM p""",
    oracle_views="candidates",
)
def _(blocks, targets):
    n = F.col("n")
    found = asg.candidate_counts(blocks, targets)
    label = F.when(n == 1, "1").when(n <= 5, "2_5").when(n <= 10, "6_10").when(n <= 20, "11_20").when(n <= 50, "21_50").otherwise("GT50")
    return found.withColumns({"proximal": n - F.col("exact"), "bin": label})


@query(
    "disease_region_summary", "blocks targets",
    "SELECT target_region_id, CASE WHEN target_overlap_bp > 0 THEN 'EXACT' ELSE 'PROXIMAL' END AS basis, count(*) AS candidates, count(DISTINCT read_id) AS reads FROM candidates WHERE target_source = 'DISEASE' GROUP BY ALL",
    oracle_views="candidates",
)
def _(blocks, targets):
    return asg.region_counts(blocks, targets.filter("target_source = 'DISEASE'")).drop("target_source")


@query(
    "candidate_read_extract", "orders lineitem",
    """SELECT o_orderkey, o_custkey, 'candidate' AS kind FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)
      UNION ALL SELECT l_orderkey, NULL, 'missing read' FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 45) WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
      UNION ALL SELECT o_orderkey, NULL, 'duplicate read' FROM orders GROUP BY o_orderkey HAVING count(*) > 1""",
)
def _(orders, lineitem):
    """Reads in the candidate set, and what breaks it: candidates without a read, reads given twice."""
    wanted = lineitem.filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    none = F.lit(None).cast("long").alias("o_custkey")
    found = orders.join(wanted, "o_orderkey", "left_semi").select("o_orderkey", "o_custkey", F.lit("candidate").alias("kind"))
    missing = wanted.join(orders, "o_orderkey", "left_anti").select("o_orderkey", none, F.lit("missing read").alias("kind"))
    twice = orders.groupBy("o_orderkey").count().filter("count > 1").select("o_orderkey", none, F.lit("duplicate read").alias("kind"))
    return found.unionByName(missing).unionByName(twice)


@query(
    "select_projection_block", "blocks targets",
    """WITH j AS (SELECT b.*, t.target_region_id, greatest(0, least(block_end, end_pos) - greatest(block_start, start_pos)) AS overlap_bp, greatest(0, block_start - end_pos, start_pos - block_end) AS distance_bp FROM blocks b JOIN targets t ON b.chrom = t.chrom AND b.block_start < t.end_pos + 50 AND t.start_pos < b.block_end + 50 WHERE t.target_source = 'DISEASE')
      SELECT read_id, ordinal, target_region_id, block_index, overlap_bp::BIGINT AS overlap_bp, distance_bp::BIGINT AS distance_bp FROM j QUALIFY row_number() OVER (PARTITION BY read_id, ordinal, target_region_id ORDER BY overlap_bp DESC, distance_bp, block_end - block_start DESC, block_index) = 1""",
)
def _(blocks, targets):
    disease = targets.filter("target_source = 'DISEASE'").select("target_region_id", "chrom", "start_pos", "end_pos")
    best = asg.best_block(blocks, disease)
    return best.select("read_id", "ordinal", "target_region_id", "block_index", F.col("overlap_bp").cast("long"), F.col("distance_bp").cast("long"))


@query(
    "multi_block_flag", "blocks targets",
    "SELECT b.read_id, b.ordinal, t.target_region_id, count(*) AS overlapping_blocks, count(*) > 1 AS multi_block FROM blocks b JOIN targets t ON b.chrom = t.chrom AND b.block_start < t.end_pos AND t.start_pos < b.block_end GROUP BY ALL",
)
def _(blocks, targets):
    return asg.overlapping_blocks(blocks, targets)


@query(
    "window_sequence", "paf_rows reads",
    """SELECT p.query_name, p.ordinal, greatest(0, query_start - 10) AS window_start, least(len(seq), query_end + 10)::INT AS window_end, substr(seq, greatest(0, query_start - 10) + 1, (least(len(seq), query_end + 10) - greatest(0, query_start - 10))::INT) AS window_seq
      FROM paf_rows p JOIN reads r ON p.query_name = 'Q' || r.read_id""",
)
def _(paf, reads):
    """The read's bases in a window widened by 10 and cut at the read's ends."""
    named = reads.select(F.concat(F.lit("Q"), F.col("read_id")).alias("query_name"), "seq")
    start, end = F.greatest(F.lit(0), F.col("query_start") - 10), F.least(F.length("seq"), F.col("query_end") + 10)
    return paf.join(named, "query_name").select("query_name", "ordinal", start.alias("window_start"), end.alias("window_end"), F.substring(F.col("seq"), start + 1, end - start).alias("window_seq"))


@query(
    "candidate_window", "paf_rows",
    """SELECT query_name, ordinal, CASE WHEN ordinal % 3 = 0 THEN greatest(0, query_start - 100) WHEN ordinal % 3 = 1 THEN greatest(0, query_end - 100) ELSE 0 END AS window_start,
      CASE WHEN ordinal % 3 = 0 THEN least(query_length, query_end + 100) WHEN ordinal % 3 = 1 THEN query_length ELSE least(query_length, query_start + 100) END AS window_end FROM paf_rows""",
)
def _(paf):
    """Windows of projected targets, and of targets beyond the alignment's right or left end."""
    way, flank, size = F.col("ordinal") % 3, 100, F.col("query_length")
    start = F.when(way == 0, F.col("query_start") - flank).when(way == 1, F.col("query_end") - flank).otherwise(0)
    end = F.when(way == 0, F.col("query_end") + flank).when(way == 1, size).otherwise(F.col("query_start") + flank)
    return paf.select("query_name", "ordinal", F.greatest(F.lit(0), start).alias("window_start"), F.least(size, end).alias("window_end"))


@query(
    "target_geometry", "paf_rows",
    """WITH g AS (SELECT query_name, ordinal, target_end - target_start > 40 AS ov, query_start >= 5 AS l, query_end <= 110 AS r, mapq >= 5 AS projected, query_start % 3 > 0 AS clip, ordinal % 2 = 0 AS to_right FROM paf_rows),
      k AS (SELECT *, CASE WHEN ov AND l AND r AND projected THEN 'BOTH_FLANKS_PROJECTABLE' WHEN ov AND l AND r THEN 'FLANKS_WITHOUT_QUERY_TARGET' WHEN ov AND l THEN 'LEFT_FLANK_ONLY' WHEN ov AND r THEN 'RIGHT_FLANK_ONLY' WHEN ov THEN 'TARGET_INTERNAL_NO_FLANK'
        WHEN to_right AND l AND clip THEN 'PROXIMAL_RIGHT_WITH_SOFTCLIP' WHEN to_right AND l THEN 'PROXIMAL_RIGHT_NO_SOFTCLIP' WHEN to_right THEN 'PROXIMAL_ONLY' WHEN r AND clip THEN 'PROXIMAL_LEFT_WITH_SOFTCLIP' WHEN r THEN 'PROXIMAL_LEFT_NO_SOFTCLIP' ELSE 'PROXIMAL_ONLY' END AS geometry_class FROM g)
      SELECT query_name, ordinal, geometry_class, CASE geometry_class WHEN 'BOTH_FLANKS_PROJECTABLE' THEN 'SPAN_POTENTIAL' WHEN 'LEFT_FLANK_ONLY' THEN 'LEFT_ANCHORED_CENSORED_RIGHT_POTENTIAL' WHEN 'PROXIMAL_RIGHT_WITH_SOFTCLIP' THEN 'LEFT_ANCHORED_CENSORED_RIGHT_POTENTIAL' WHEN 'RIGHT_FLANK_ONLY' THEN 'RIGHT_ANCHORED_CENSORED_LEFT_POTENTIAL' WHEN 'PROXIMAL_LEFT_WITH_SOFTCLIP' THEN 'RIGHT_ANCHORED_CENSORED_LEFT_POTENTIAL' WHEN 'TARGET_INTERNAL_NO_FLANK' THEN 'REPEAT_ONLY_UNANCHORED_POTENTIAL' ELSE 'NOT_YET_CLASSIFIABLE' END AS potential_class,
        CASE WHEN geometry_class IN ('FLANKS_WITHOUT_QUERY_TARGET', 'PROXIMAL_RIGHT_NO_SOFTCLIP', 'PROXIMAL_LEFT_NO_SOFTCLIP', 'PROXIMAL_ONLY') THEN 'WARN' ELSE 'PASS' END AS projection_status FROM k""",
)
def _(paf):
    from ..operators.geometry import geometry

    rows = paf.select(
        "query_name", "ordinal", (F.col("target_end") - F.col("target_start") > 40).alias("overlaps"), (F.col("query_start") >= 5).alias("left"), (F.col("query_end") <= 110).alias("right"),
        (F.col("mapq") >= 5).alias("projected"), (F.col("query_start") % 3 > 0).alias("clip"), F.when(F.col("ordinal") % 2 == 0, "RIGHT").otherwise("LEFT").alias("side"),
    )
    return geometry(rows).select("query_name", "ordinal", "geometry_class", "potential_class", "projection_status")
