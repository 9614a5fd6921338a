"""Queries of catalog building and annotation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import sequences as s
from ..operators import intervals as iv
from ..operators import laid
from ..operators.spread import spread
from .common import register

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)
BLOCK, TARGET = ("chrom", "block_start", "block_end"), ("chrom", "start_pos", "end_pos")
TRACKS = "g AS (SELECT chrom, feature, start_1based - 1 AS s, end_1based AS e, strand, transcript_id FROM gtf_rows)"
#: Bases upstream and downstream of a start that make a promoter, and the contigs' length.
UPSTREAM, DOWNSTREAM, CONTIG = 1000, 200, 20100


def features(gtf):
    return gtf.select("chrom", "feature", (F.col("start_1based") - 1).alias("s"), F.col("end_1based").alias("e"), "strand", "transcript_id")


def tracks(gtf):
    """Typed tracks of a gene annotation: features as they are, and promoters on the strand's side of gene starts."""
    rows = features(gtf)
    plain = rows.filter("feature IN ('CDS', 'exon', 'gene')").select(F.when(F.col("feature") == "gene", "gene_body").otherwise(F.lower("feature")).alias("track"), "chrom", "s", "e")
    start = F.when(F.col("strand") == "+", F.col("s")).otherwise(F.col("e"))
    up, down = F.when(F.col("strand") == "+", UPSTREAM).otherwise(DOWNSTREAM), F.when(F.col("strand") == "+", DOWNSTREAM).otherwise(UPSTREAM)
    promoter = rows.filter("feature = 'gene'").select(F.lit("promoter").alias("track"), "chrom", F.greatest(F.lit(0), start - up).alias("s"), F.least(F.lit(CONTIG), start + down).alias("e"))
    return plain.unionByName(promoter.filter("e > s"))


def utr_sides(gtf):
    """UTRs before or after their transcript's coding bounds, by strand."""
    rows = features(gtf)
    bounds = rows.filter("feature = 'CDS'").groupBy("transcript_id").agg(F.min("s").alias("c0"), F.max("e").alias("c1"), F.max("strand").alias("cds_strand"))
    utr = rows.filter("feature = 'UTR'").join(bounds, "transcript_id", "left")
    before, after = F.col("e") <= F.col("c0"), F.col("s") >= F.col("c1")
    plus = F.col("strand") == "+"
    side = (
        F.when(F.col("c0").isNull() | (F.col("strand") != F.col("cds_strand")), "unresolved").when((plus & before) | (~plus & after), "utr5").when((plus & after) | (~plus & before), "utr3").otherwise("unresolved")
    )
    return utr.select("transcript_id", "chrom", "s", "e", side.alias("side"))


TRACK_SQL = f"""{TRACKS}, t AS (SELECT CASE WHEN feature = 'gene' THEN 'gene_body' ELSE lower(feature) END AS track, chrom, s, e FROM g WHERE feature IN ('CDS', 'exon', 'gene')
      UNION ALL SELECT 'promoter', chrom, greatest(0, CASE WHEN strand = '+' THEN s - {UPSTREAM} ELSE e - {DOWNSTREAM} END), least({CONTIG}, CASE WHEN strand = '+' THEN s + {DOWNSTREAM} ELSE e + {UPSTREAM} END) FROM g WHERE feature = 'gene')"""
SIDE_SQL = """b AS (SELECT transcript_id, min(s) AS c0, max(e) AS c1 FROM g WHERE feature = 'CDS' GROUP BY transcript_id),
      bs AS (SELECT transcript_id, max(strand) AS cds_strand FROM g WHERE feature = 'CDS' GROUP BY transcript_id),
      us AS (SELECT g.transcript_id, chrom, s, e, CASE WHEN c0 IS NULL OR strand <> cds_strand THEN 'unresolved' WHEN e <= c0 THEN CASE strand WHEN '+' THEN 'utr5' ELSE 'utr3' END WHEN s >= c1 THEN CASE strand WHEN '+' THEN 'utr3' ELSE 'utr5' END ELSE 'unresolved' END AS side
        FROM g LEFT JOIN b ON g.transcript_id = b.transcript_id LEFT JOIN bs ON g.transcript_id = bs.transcript_id WHERE feature = 'UTR')"""


@query(
    "catalog_profile", "targets",
    """WITH o AS (SELECT *, lag(start_pos) OVER w AS p0, lag(end_pos) OVER w AS p1 FROM targets WINDOW w AS (PARTITION BY chrom ORDER BY CAST(substr(target_region_id, 2) AS INT)))
      SELECT chrom, count(*) AS entries, min(end_pos - start_pos) AS shortest, max(end_pos - start_pos) AS longest, count(*) FILTER ((end_pos - start_pos) % len(motif) = 0) AS whole_motifs,
        count(*) FILTER (p0 > start_pos) AS out_of_order, count(*) FILTER (p0 <= start_pos AND p1 > start_pos) AS overlapping_neighbours FROM o GROUP BY chrom""",
)
def _(targets):
    size = F.col("end_pos") - F.col("start_pos")
    rows = iv.with_previous(targets.withColumn("_line", F.substring("target_region_id", 2, 20).cast("long")), ["chrom"], "_line", {"p0": "start_pos", "p1": "end_pos"})
    return rows.groupBy("chrom").agg(
        F.count("*").alias("entries"), F.min(size).alias("shortest"), F.max(size).alias("longest"), F.count_if(size % F.length("motif") == 0).alias("whole_motifs"), F.count_if(F.col("p0") > F.col("start_pos")).alias("out_of_order"),
        F.count_if((F.col("p0") <= F.col("start_pos")) & (F.col("p1") > F.col("start_pos"))).alias("overlapping_neighbours"),
    )


@query("repeated_coordinates", "targets", "SELECT chrom, start_pos, count(*) AS entries, string_agg(motif, ',' ORDER BY motif) AS motifs FROM targets GROUP BY chrom, start_pos HAVING count(*) > 1")
def _(targets):
    return targets.groupBy("chrom", "start_pos").agg(F.count("*").alias("entries"), F.array_join(F.sort_array(F.collect_list("motif")), ",").alias("motifs")).filter("entries > 1")


@query(
    "reference_motif_identity", "reads orders",
    """WITH w AS (SELECT read_id, o_custkey % 6 AS k, substr(seq, 33, len(seq) - 64) AS tract FROM reads JOIN orders ON read_id = o_orderkey),
      i AS (SELECT k, tract, unnest(['CAG', 'AGC', 'GCA', 'CTG', 'TGC', 'GCT']) AS way, read_id FROM w),
      p AS (SELECT read_id, any_value(k) AS k, max(len(list_filter(range(1, len(tract) + 1), lambda j: substr(tract, j, 1) = substr(way, (j - 1) % 3 + 1, 1)))::DOUBLE / len(tract)) AS identity FROM i GROUP BY read_id)
      SELECT k, count(*) AS tracts, round(quantile_cont(identity, 0.25), 6) AS q1, round(quantile_cont(identity, 0.5), 6) AS median, round(quantile_cont(identity, 0.75), 6) AS q3 FROM p GROUP BY k""",
)
def _(reads, orders):
    """Best cyclic identity of each read's planted tract to one motif, in quartiles by the motif planted."""
    # laid side by side in Arrow batches, in as many tasks as a shuffle has: a file of many short reads is few splits
    planted = orders.select(F.col("o_orderkey").alias("read_id"), (F.col("o_custkey") % 6).alias("k"))
    tract = spread(reads.select("read_id", F.substring(F.col("seq"), F.lit(33), F.length("seq") - 64).alias("tract")), "read_id").join(planted, "read_id")
    identity = laid.purities(tract.select("k", "tract", F.lit("CAG").alias("motif")), "tract", "motif")
    quartiles = iv.quantiles(identity, ["k"], F.col("purity"), {"q1": 0.25, "median": 0.5, "q3": 0.75}, tile=0.05, places=6)
    return reads.select("read_id").join(planted, "read_id").groupBy("k").agg(F.count("*").alias("tracts")).join(quartiles, "k").select("k", "tracts", "q1", "median", "q3")


@query(
    "locus_master", "targets",
    """SELECT target_region_id, chrom || '-' || start_pos || '-' || end_pos || '-' || motif AS locus_id, len(motif) AS motif_bp, (end_pos - start_pos) // len(motif) AS units, (end_pos - start_pos) % len(motif) = 0 AS whole_units, target_source = 'CATALOG' AS id_matches FROM targets""",
)
def _(targets):
    """Clean locus fields; a stated id is held against the one that the fields give."""
    locus = F.concat_ws("-", "chrom", "start_pos", "end_pos", "motif")
    stated = F.when(F.col("target_source") == "CATALOG", locus).otherwise(F.concat(locus, F.lit("?")))
    size = F.col("end_pos") - F.col("start_pos")
    return targets.select("target_region_id", locus.alias("locus_id"), F.length("motif").cast("long").alias("motif_bp"), F.floor(size / F.length("motif")).alias("units"), (size % F.length("motif") == 0).alias("whole_units"), (stated == locus).alias("id_matches"))


@query(
    "id_set_reconcile", "orders lineitem",
    """SELECT CASE WHEN o IS NULL THEN 'RIGHT_ONLY' WHEN l IS NULL THEN 'LEFT_ONLY' ELSE 'SHARED' END AS side, count(*) AS ids FROM (SELECT DISTINCT o_orderkey AS o FROM orders) FULL JOIN (SELECT DISTINCT l_orderkey AS l FROM lineitem) ON o = l GROUP BY side""",
)
def _(orders, lineitem):
    left, right = orders.select(F.col("o_orderkey").alias("o")).distinct(), lineitem.select(F.col("l_orderkey").alias("l")).distinct()
    side = F.when(F.col("o").isNull(), "RIGHT_ONLY").when(F.col("l").isNull(), "LEFT_ONLY").otherwise("SHARED")
    return left.join(right, F.col("o") == F.col("l"), "full_outer").groupBy(side.alias("side")).agg(F.count("*").alias("ids"))


@query("gtf_tracks", "gtf_rows", f"WITH {TRACK_SQL} SELECT track, chrom, s::BIGINT AS s, e::BIGINT AS e FROM t WHERE e > s")
def _(gtf):
    return tracks(gtf).select("track", "chrom", F.col("s").cast("long"), F.col("e").cast("long"))


@query("utr_side", "gtf_rows", f"WITH {TRACKS}, {SIDE_SQL} SELECT * FROM us")
def _(gtf):
    return utr_sides(gtf)


@query(
    "merge_intervals", "blocks",
    """WITH o AS (SELECT chrom, block_start, block_end, max(block_end) OVER (PARTITION BY chrom ORDER BY block_start, block_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM blocks),
      n AS (SELECT *, sum((seen IS NULL OR block_start > seen)::INT) OVER (PARTITION BY chrom ORDER BY block_start, block_end ROWS UNBOUNDED PRECEDING) AS g FROM o)
      SELECT chrom, min(block_start) AS block_start, max(block_end) AS block_end FROM n GROUP BY chrom, g""",
)
def _(blocks):
    return iv.merge_intervals(blocks, ["chrom"], "block_start", "block_end")


@query(
    "interval_semi_join", "targets gtf_rows",
    f"WITH {TRACKS} SELECT target_region_id FROM targets t WHERE EXISTS (SELECT 1 FROM g WHERE feature = 'exon' AND g.chrom = t.chrom AND g.s < t.end_pos AND t.start_pos < g.e)",
)
def _(targets, gtf):
    return iv.interval_filter(targets, features(gtf).filter("feature = 'exon'"), TARGET, ("chrom", "s", "e"), keep=True).select("target_region_id")


@query(
    "interval_anti_join", "targets gtf_rows",
    f"WITH {TRACKS} SELECT target_region_id FROM targets t WHERE NOT EXISTS (SELECT 1 FROM g WHERE feature = 'exon' AND g.chrom = t.chrom AND g.s < t.end_pos AND t.start_pos < g.e)",
)
def _(targets, gtf):
    return iv.interval_filter(targets, features(gtf).filter("feature = 'exon'"), TARGET, ("chrom", "s", "e"), keep=False).select("target_region_id")


@query(
    "interval_inner_join", "blocks targets",
    "SELECT read_id, ordinal, block_index, target_region_id, (least(block_end, end_pos) - greatest(block_start, start_pos))::BIGINT AS overlap_bp FROM blocks b JOIN targets t ON b.chrom = t.chrom AND block_start < end_pos AND start_pos < block_end",
)
def _(blocks, targets):
    return iv.interval_join(blocks, targets, BLOCK, TARGET).select("read_id", "ordinal", "block_index", "target_region_id", F.col("overlap_bp").cast("long"))


@query(
    "interval_nearby_join", "targets gtf_rows",
    f"WITH {TRACKS} SELECT target_region_id, transcript_id, feature, greatest(0, s - end_pos, start_pos - e)::BIGINT AS distance_bp FROM targets t JOIN g ON g.chrom = t.chrom AND s - end_pos <= 100 AND start_pos - e <= 100",
)
def _(targets, gtf):
    """Spans are paired, not copies: what lies at one span shares a row, and a row for each pair is made at the end."""
    loci = iv.gathered(targets, list(TARGET), ["target_region_id"], "_loci")
    near = iv.interval_join(loci, iv.gathered(features(gtf), ["chrom", "s", "e"], ["transcript_id", "feature"], "_features"), TARGET, ("chrom", "s", "e"), within=100)
    rows = near.select(F.explode("_loci").alias("x"), "_features", F.col("distance_bp").cast("long").alias("distance_bp"))
    return rows.select("x.target_region_id", F.explode("_features").alias("y"), "distance_bp").select("target_region_id", "y.transcript_id", "y.feature", "distance_bp")


def overlap_flags(targets, gtf):
    """Which tracks overlap each target. Each track is merged first and targets go by their distinct spans, so that copies of either add no pairs."""
    sides = utr_sides(gtf).select(F.col("side").alias("track"), "chrom", "s", "e").filter("track <> 'unresolved'")
    kinds = ("cds", "utr5", "utr3", "exon", "gene_body", "promoter")
    merged = iv.merge_intervals(tracks(gtf).unionByName(sides).filter("e > s"), ["track", "chrom"], "s", "e")
    hits = iv.interval_join(targets.select(*TARGET).distinct(), merged, TARGET, ("chrom", "s", "e"))
    found = hits.groupBy(*TARGET).agg(*[F.bool_or(F.col("track") == k).alias(k) for k in kinds])
    own = targets.select("target_region_id", *TARGET).join(found, list(TARGET), "left")
    return own.groupBy("target_region_id").agg(*[F.coalesce(F.bool_or(k), F.lit(False)).alias(k) for k in kinds])


FLAG_SQL = f"""{TRACK_SQL}, {SIDE_SQL}, k AS (SELECT track, chrom, s, e FROM t WHERE e > s UNION ALL SELECT side, chrom, s, e FROM us WHERE side <> 'unresolved'),
      f AS (SELECT x.target_region_id, {', '.join(f"coalesce(bool_or(k.track = '{n}'), false) AS {n}" for n in ('cds', 'utr5', 'utr3', 'exon', 'gene_body', 'promoter'))}
        FROM targets x LEFT JOIN k ON k.chrom = x.chrom AND k.s < x.end_pos AND x.start_pos < k.e GROUP BY x.target_region_id)"""


def regions(flags):
    """Primary region, all regions and priority of loci from their overlap flags."""
    coding, exon = F.col("cds") | F.col("utr5") | F.col("utr3"), F.col("exon")
    other = exon & ~coding
    intron = F.col("gene_body") & ~exon & ~coding
    away = ~F.col("gene_body") & ~F.col("promoter")
    named = [("CDS", F.col("cds")), ("5_prime_UTR", F.col("utr5")), ("3_prime_UTR", F.col("utr3")), ("other_exon", other), ("intron", intron), ("promoter", F.col("promoter")), ("intergenic", away)]
    primary = F.coalesce(*[F.when(c, n) for n, c in named], F.lit("intergenic"))
    every = F.array_join(F.array_compact(F.array(*[F.when(c, n) for n, c in named])), ",")
    return flags.select("target_region_id", primary.alias("primary_region"), every.alias("regions"), F.when(coding | other, "high").when(intron, "medium").otherwise("low").alias("priority"))


@query(
    "locus_region_flags", "targets gtf_rows",
    f"""WITH {FLAG_SQL}, r AS (SELECT *, cds OR utr5 OR utr3 AS coding, exon AND NOT (cds OR utr5 OR utr3) AS other, gene_body AND NOT exon AND NOT (cds OR utr5 OR utr3) AS intron FROM f)
      SELECT target_region_id, CASE WHEN cds THEN 'CDS' WHEN utr5 THEN '5_prime_UTR' WHEN utr3 THEN '3_prime_UTR' WHEN other THEN 'other_exon' WHEN intron THEN 'intron' WHEN promoter THEN 'promoter' ELSE 'intergenic' END AS primary_region,
        concat_ws(',', CASE WHEN cds THEN 'CDS' END, CASE WHEN utr5 THEN '5_prime_UTR' END, CASE WHEN utr3 THEN '3_prime_UTR' END, CASE WHEN other THEN 'other_exon' END, CASE WHEN intron THEN 'intron' END, CASE WHEN promoter THEN 'promoter' END, CASE WHEN NOT gene_body AND NOT promoter THEN 'intergenic' END) AS regions,
        CASE WHEN coding OR other THEN 'high' WHEN intron THEN 'medium' ELSE 'low' END AS priority FROM r""",
)
def _(targets, gtf):
    return regions(overlap_flags(targets, gtf))


@query(
    "select_regions_with_fallback", "targets gtf_rows",
    f"""WITH {TRACKS}, c AS (SELECT * FROM targets WHERE target_source = 'DISEASE'), r AS (SELECT transcript_id, feature, chrom, s, e FROM g WHERE feature IN ('exon', 'gene'))
      SELECT feature AS region, chrom, s AS region_start, e AS region_end, CASE feature WHEN 'gene' THEN 'VARIATION_CLUSTER' ELSE 'SINGLE_LOCUS' END AS mode FROM r WHERE EXISTS (SELECT 1 FROM c WHERE c.chrom = r.chrom AND r.s < c.end_pos AND c.start_pos < r.e)
      UNION ALL SELECT target_region_id, chrom, start_pos, end_pos, 'FALLBACK' FROM c WHERE NOT EXISTS (SELECT 1 FROM r WHERE c.chrom = r.chrom AND r.s < c.end_pos AND c.start_pos < r.e)""",
)
def _(targets, gtf):
    """Regions that touch core loci, and a fallback row for each core locus without one."""
    core = targets.filter("target_source = 'DISEASE'")
    own = features(gtf).filter("feature IN ('exon', 'gene')").drop("strand")
    touched = iv.interval_filter(own, core, ("chrom", "s", "e"), TARGET, keep=True)
    mode = F.when(F.col("feature") == "gene", "VARIATION_CLUSTER").otherwise("SINGLE_LOCUS")
    kept = touched.select(F.col("feature").alias("region"), "chrom", F.col("s").alias("region_start"), F.col("e").alias("region_end"), mode.alias("mode"))
    alone = iv.interval_filter(core, own, TARGET, ("chrom", "s", "e"), keep=False)
    return kept.unionByName(alone.select(F.col("target_region_id").alias("region"), "chrom", F.col("start_pos").alias("region_start"), F.col("end_pos").alias("region_end"), F.lit("FALLBACK").alias("mode")))


@query(
    "priority_tiers", "part supplier",
    """SELECT coalesce(p_partkey, s_suppkey) AS id, CASE WHEN p_partkey IS NULL THEN 'T9' WHEN s_suppkey IS NOT NULL THEN 'T0' WHEN p_size <= 10 THEN 'T1' WHEN p_size <= 30 THEN 'T2' ELSE 'T3' END AS tier,
        CASE WHEN p_partkey IS NULL THEN 'RIGHT_ONLY' WHEN s_suppkey IS NULL THEN 'LEFT_ONLY' ELSE 'BOTH' END AS matched, p_partkey IS NOT NULL AND (s_suppkey IS NOT NULL OR p_size <= 10) AS included
      FROM part FULL JOIN supplier ON p_partkey = s_suppkey""",
)
def _(part, supplier):
    """Tier of each id of two tables: forced, small, middle, rest, or known to the second table only."""
    joined = part.select("p_partkey", "p_size").join(supplier.select("s_suppkey"), F.col("p_partkey") == F.col("s_suppkey"), "full_outer")
    unknown, forced = F.col("p_partkey").isNull(), F.col("s_suppkey").isNotNull()
    tier = F.when(unknown, "T9").when(forced, "T0").when(F.col("p_size") <= 10, "T1").when(F.col("p_size") <= 30, "T2").otherwise("T3")
    matched = F.when(unknown, "RIGHT_ONLY").when(~forced, "LEFT_ONLY").otherwise("BOTH")
    included = ~unknown & (forced | (F.col("p_size") <= 10))
    return joined.select(F.coalesce("p_partkey", "s_suppkey").alias("id"), tier.alias("tier"), matched.alias("matched"), included.alias("included"))


PAIR_SQL = """d AS (SELECT target_region_id AS q, chrom, start_pos AS q0, end_pos AS q1, motif AS qm FROM targets WHERE target_source = 'DISEASE'), c AS (SELECT target_region_id AS r, chrom, start_pos AS r0, end_pos AS r1, motif AS rm FROM targets WHERE target_source = 'CATALOG'),
      n AS (SELECT *, greatest(0, least(q1, r1) - greatest(q0, r0)) AS overlap_bp, greatest(0, r0 - q1, q0 - r1) AS distance_bp, abs(q0 - r0) + abs(q1 - r1) AS delta FROM d JOIN c USING (chrom) WHERE r0 - q1 <= 100 AND q0 - r1 <= 100)"""


#: What loci have in common that meet the same others in the same way.
SHAPE = ["chrom", "q0", "q1", "qm"]


def nearby_shapes(targets, told):
    """Disease loci with their shapes, and the pairs of shapes that lie near each other, `told` of the catalog loci of one."""
    known = targets.filter("target_source = 'DISEASE'").select(F.col("target_region_id").alias("q"), "chrom", F.col("start_pos").alias("q0"), F.col("end_pos").alias("q1"), F.struct("motif").alias("qm"))
    other = targets.filter("target_source = 'CATALOG'").select(F.col("target_region_id").alias("r"), "chrom", F.col("start_pos").alias("r0"), F.col("end_pos").alias("r1"), F.col("motif").alias("rm"))
    shapes = other.groupBy("chrom", "r0", "r1", "rm").agg(told)
    near = iv.interval_join(known.select(*SHAPE).distinct(), shapes, ("chrom", "q0", "q1"), ("chrom", "r0", "r1"), within=100)
    return known, near.withColumn("delta", F.abs(F.col("q0") - F.col("r0")) + F.abs(F.col("q1") - F.col("r1")))


@query(
    "disease_concordance", "targets",
    f"""WITH {PAIR_SQL}, b AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY q ORDER BY (qm = rm) DESC, overlap_bp DESC, delta, len(rm) DESC, r) = 1)
      SELECT d.q, b.r, b.overlap_bp::BIGINT AS overlap_bp, CASE WHEN b.r IS NULL THEN 'NO_CANDIDATE' WHEN b.qm = b.rm AND b.delta = 0 THEN 'EXACT' WHEN b.qm = b.rm AND b.overlap_bp > 0 THEN 'SAME_MOTIF_OVERLAP' WHEN b.overlap_bp > 0 THEN 'OTHER_MOTIF_OVERLAP' ELSE 'NEARBY' END AS concordance FROM d LEFT JOIN b ON d.q = b.q""",
)
def _(targets):
    """The best catalog locus near each disease locus; loci without one are kept.

    Loci with the same span and motif have the same best, and of catalog loci with the same the first id is better: pairs
    are of spans and motifs, no more than places that they can lie at.
    """
    known, near = nearby_shapes(targets, F.min("r").alias("r"))
    pairs = near.withColumn("same", F.col("qm.motif") == F.col("rm"))
    order = F.struct(F.coalesce(F.col("same").cast("int"), F.lit(-1)), "overlap_bp", -F.col("delta"), F.coalesce(F.length("rm"), F.lit(-1)))
    # of equal ones the first id: least rows are kept by an aggregate, so no shape's pairs are sorted in one task
    top = pairs.groupBy(*SHAPE, order.alias("o")).agg(F.min(F.struct("r", "same", "overlap_bp", "delta")).alias("x")).groupBy(*SHAPE).agg(F.max_by("x", "o").alias("x"), F.max("o").alias("o"))
    own = known.join(top, SHAPE).groupBy("q", "o").agg(F.min("x").alias("x")).groupBy("q").agg(F.max_by("x", "o").alias("x"))
    joined = known.select("q").join(own, "q", "left").select("q", "x.*")
    overlaps = F.col("overlap_bp") > 0
    kind = F.when(F.col("r").isNull(), "NO_CANDIDATE").when(F.col("same") & (F.col("delta") == 0), "EXACT").when(F.col("same") & overlaps, "SAME_MOTIF_OVERLAP").when(overlaps, "OTHER_MOTIF_OVERLAP").otherwise("NEARBY")
    return joined.select("q", "r", F.col("overlap_bp").cast("long"), kind.alias("concordance"))


@query(
    "locus_crosswalk", "targets",
    f"""WITH {PAIR_SQL} SELECT q, r, row_number() OVER (PARTITION BY q ORDER BY overlap_bp DESC, distance_bp, delta, r)::INT AS rank, count(*) OVER (PARTITION BY q) AS candidates, round(overlap_bp::DOUBLE / (q1 - q0), 6) AS query_fraction, round(overlap_bp::DOUBLE / (r1 - r0), 6) AS other_fraction,
        len(qm) = len(rm) AND (q0 - r0) % len(qm) = 0 AS phase_compatible FROM n""",
)
def _(targets):
    """All catalog loci near each disease locus, ranked. Loci of one span rank others alike, so each span's are ranked once."""
    span = ["chrom", "q0", "q1"]
    known = targets.filter("target_source = 'DISEASE'").select(F.col("target_region_id").alias("q"), "chrom", F.col("start_pos").alias("q0"), F.col("end_pos").alias("q1"), F.col("motif").alias("qm"))
    other = targets.filter("target_source = 'CATALOG'").select(F.col("target_region_id").alias("r"), "chrom", F.col("start_pos").alias("r0"), F.col("end_pos").alias("r1"), F.length("motif").alias("unit"))
    pairs = iv.interval_join(known.select(*span).distinct(), other, ("chrom", "q0", "q1"), ("chrom", "r0", "r1"), within=100)
    per, delta = Window.partitionBy(*span), F.abs(F.col("q0") - F.col("r0")) + F.abs(F.col("q1") - F.col("r1"))
    ranked = pairs.select(
        *span, "r", "unit", (F.col("q0") - F.col("r0")).alias("shift"), F.row_number().over(per.orderBy(F.desc("overlap_bp"), "distance_bp", delta, "r")).alias("rank"), F.count("*").over(per).alias("candidates"),
        F.round(F.col("overlap_bp") / (F.col("q1") - F.col("q0")), 6).alias("query_fraction"), F.round(F.col("overlap_bp") / (F.col("r1") - F.col("r0")), 6).alias("other_fraction"),
    )
    phase = (F.length("qm") == F.col("unit")) & (F.col("shift") % F.length("qm") == 0)
    return ranked.join(known, span).select("q", "r", "rank", "candidates", "query_fraction", "other_fraction", phase.alias("phase_compatible"))


@query(
    "crosswalk_tiers", "targets",
    f"""WITH {PAIR_SQL}, k AS (SELECT d.q, count(*) FILTER (n.delta = 0) AS exact, count(*) FILTER (n.overlap_bp > 0) AS overlapping, count(n.r) AS near FROM d LEFT JOIN n ON d.q = n.q GROUP BY d.q)
      SELECT CASE WHEN exact > 0 THEN 'EXACT' WHEN overlapping = 1 THEN 'UNIQUE_OVERLAP' WHEN overlapping > 1 THEN 'MULTIPLE_OVERLAP' WHEN near > 0 THEN 'NEARBY' ELSE 'NONE' END AS tier, count(*) AS loci FROM k GROUP BY tier""",
)
def _(targets):
    """Loci by how many catalog loci lie at or near them, counted by pairs of spans and motifs."""
    known, near = nearby_shapes(targets, F.count("*").alias("n"))
    over = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    counts = near.groupBy(*SHAPE).agg(over(F.col("delta") == 0).alias("exact"), over(F.col("overlap_bp") > 0).alias("overlapping"), F.sum("n").alias("near"))
    own = known.join(counts, SHAPE).groupBy("q").agg(*[F.sum(c).alias(c) for c in ("exact", "overlapping", "near")])
    rows = known.select("q").join(own, "q", "left").fillna(0, ["exact", "overlapping", "near"])
    tier = F.when(F.col("exact") > 0, "EXACT").when(F.col("overlapping") == 1, "UNIQUE_OVERLAP").when(F.col("overlapping") > 1, "MULTIPLE_OVERLAP").when(F.col("near") > 0, "NEARBY").otherwise("NONE")
    return rows.groupBy(tier.alias("tier")).agg(F.count("*").alias("loci"))


@query(
    "mapping_targets", "targets gtf_rows",
    f"""WITH {TRACKS}, u AS (SELECT target_source AS source, target_region_id AS id, chrom, start_pos AS s, end_pos AS e FROM targets UNION ALL SELECT 'GENE', transcript_id, chrom, s, e FROM g WHERE feature = 'gene')
      SELECT source, id, chrom, s::BIGINT AS s, e::BIGINT AS e, CASE WHEN count(*) OVER (PARTITION BY source, id) > 1 THEN 'COLLISION' WHEN e > 20010 THEN 'OUT_OF_BOUNDS' ELSE 'PASS' END AS status FROM u""",
)
def _(targets, gtf):
    """Two sources as one target table, in contig order; repeated ids and intervals beyond the contig are marked."""
    genes = features(gtf).filter("feature = 'gene'").select(F.lit("GENE").alias("source"), F.col("transcript_id").alias("id"), "chrom", "s", "e")
    every = targets.select(F.col("target_source").alias("source"), F.col("target_region_id").alias("id"), "chrom", F.col("start_pos").alias("s"), F.col("end_pos").alias("e")).unionByName(genes)
    twice = F.count("*").over(Window.partitionBy("source", "id")) > 1
    marked = every.withColumn("status", F.when(twice, "COLLISION").when(F.col("e") > 20010, "OUT_OF_BOUNDS").otherwise("PASS"))
    return marked.select("source", "id", "chrom", F.col("s").cast("long"), F.col("e").cast("long"), "status").orderBy("chrom", "s", "e", "source", "id")


@query(
    "transcript_junctions", "gtf_rows",
    f"""WITH {TRACKS}, x AS (SELECT DISTINCT transcript_id, chrom, strand, s, e FROM g WHERE feature = 'exon'), l AS (SELECT *, lead(s) OVER (PARTITION BY transcript_id, chrom, strand ORDER BY s, e) AS n FROM x)
      SELECT transcript_id, chrom, strand, min(s) AS tx_start, max(e) AS tx_end, count(*) AS blocks, count(n) AS junctions, string_agg((e - s)::VARCHAR, ',' ORDER BY s, e) AS block_sizes FROM l GROUP BY transcript_id, chrom, strand HAVING count(*) > 1""",
)
def _(gtf):
    """Blocks and junctions of transcripts with several exons. A transcript's exons are few."""
    exons = features(gtf).filter("feature = 'exon'").select("transcript_id", "chrom", "strand", "s", "e")
    blocks = F.array_sort(F.collect_set(F.struct("s", "e")))
    found = exons.groupBy("transcript_id", "chrom", "strand").agg(F.min("s").alias("tx_start"), F.max("e").alias("tx_end"), blocks.alias("b")).filter(F.size("b") > 1)
    return found.select("transcript_id", "chrom", "strand", "tx_start", "tx_end", F.size("b").cast("long").alias("blocks"), (F.size("b") - 1).cast("long").alias("junctions"), F.array_join(F.transform("b", lambda x: (x["e"] - x["s"]).cast("string")), ",").alias("block_sizes"))


@query(
    "overlap_clusters", "targets",
    """WITH o AS (SELECT *, max(end_pos) OVER (PARTITION BY chrom ORDER BY start_pos, end_pos, target_region_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM targets),
      n AS (SELECT *, sum((seen IS NOT NULL AND start_pos >= seen)::INT) OVER (PARTITION BY chrom ORDER BY start_pos, end_pos, target_region_id ROWS UNBOUNDED PRECEDING) AS cluster_no FROM o)
      SELECT chrom, cluster_no::BIGINT AS cluster_no, min(start_pos) AS cluster_start, max(end_pos) AS cluster_end, count(*) AS members, string_agg(target_region_id, ';' ORDER BY target_region_id) AS ids FROM n GROUP BY chrom, cluster_no""",
)
def _(targets):
    found = iv.islands(targets, ["chrom"], "start_pos", "end_pos", touching=False, ties=["target_region_id"], name="cluster_no")
    return found.groupBy("chrom", "cluster_no").agg(
        F.min("start_pos").alias("cluster_start"), F.max("end_pos").alias("cluster_end"), F.count("*").alias("members"), F.array_join(F.array_sort(F.collect_set("target_region_id")), ";").alias("ids")
    )


@query(
    "union_and_depth", "targets",
    """WITH v AS (SELECT target_source, chrom, start_pos AS p, 1 AS d FROM targets UNION ALL SELECT target_source, chrom, end_pos, -1 FROM targets), c AS (SELECT target_source, chrom, p, sum(d) AS d FROM v GROUP BY ALL),
      w AS (SELECT *, sum(d) OVER (PARTITION BY target_source, chrom ORDER BY p) AS depth, lead(p) OVER (PARTITION BY target_source, chrom ORDER BY p) AS q FROM c)
      SELECT target_source, (SELECT sum(end_pos - start_pos) FROM targets t WHERE t.target_source = w.target_source)::BIGINT AS total_bp, sum(CASE WHEN depth > 0 THEN q - p ELSE 0 END)::BIGINT AS union_bp, max(depth)::BIGINT AS max_depth FROM w GROUP BY target_source""",
)
def _(targets):
    return iv.union_and_depth(targets, ["target_source"], "chrom", "start_pos", "end_pos")


@query("coordinate_aliases", "targets", "SELECT chrom, start_pos, end_pos - end_pos % 8 AS end_bin, count(DISTINCT target_region_id) AS targets FROM targets GROUP BY ALL HAVING count(DISTINCT target_region_id) > 1")
def _(targets):
    return targets.groupBy("chrom", "start_pos", (F.col("end_pos") - F.col("end_pos") % 8).alias("end_bin")).agg(F.count_distinct("target_region_id").alias("targets")).filter("targets > 1")


@query(
    "stratum_coverage", "orders",
    "SELECT o_orderpriority, count(*) AS loci, round(avg((o_orderstatus = 'F')::INT), 6) AS finished, round(avg((o_totalprice > 100000)::INT), 6) AS large FROM orders GROUP BY o_orderpriority",
)
def _(orders):
    share = lambda c, n: F.round(F.avg(c.cast("int")), 6).alias(n)
    return orders.groupBy("o_orderpriority").agg(F.count("*").alias("loci"), share(F.col("o_orderstatus") == "F", "finished"), share(F.col("o_totalprice") > 100000, "large"))


@query(
    "coordinate_match_methods", "targets",
    """WITH c AS (SELECT target_region_id AS r, chrom, start_pos AS s, end_pos AS e FROM targets), q AS (SELECT target_region_id AS q, chrom, start_pos + CAST(substr(target_region_id, 2) AS INT) % 2 AS t, end_pos AS e FROM targets),
      u AS (SELECT q, chrom, t AS s, e, 'ZERO_BASED' AS convention FROM q UNION ALL SELECT q, chrom, t - 1, e, 'ONE_BASED' FROM q WHERE t >= 1)
      SELECT convention, count(*) AS matches, count(DISTINCT q) AS matched FROM u JOIN c ON u.chrom = c.chrom AND u.s = c.s AND u.e = c.e GROUP BY convention""",
)
def _(targets):
    """Loci given as text matched to the catalog under both coordinate conventions."""
    shift = F.substring("target_region_id", 2, 20).cast("int") % 2
    text = F.concat(F.col("chrom"), F.lit(":"), F.col("start_pos") + shift, F.lit("-"), F.col("end_pos"))
    stated = targets.select(F.col("target_region_id").alias("q"), F.explode(s.coordinates(text)).alias("c")).select("q", "c.*")
    joined = stated.join(targets.select("chrom", F.col("start_pos").alias("start"), F.col("end_pos").alias("end")), ["chrom", "start", "end"])
    return joined.groupBy("convention").agg(F.count("*").alias("matches"), F.count_distinct("q").alias("matched"))


@query(
    "infer_statistic_unit", "lineitem",
    """WITH v AS (SELECT l_returnflag AS source, l_quantity AS raw, 3 + l_partkey % 4 AS m, CASE WHEN l_returnflag < 'M' THEN l_quantity ELSE l_quantity * (3 + l_partkey % 4) END AS span FROM lineitem WHERE l_quantity > 0),
      r AS (SELECT source, quantile_cont(abs(log2(raw / span)), 0.5) AS bp, quantile_cont(abs(log2(raw * m / span)), 0.5) AS units FROM v GROUP BY source)
      SELECT source, round(bp, 6) AS bp_score, round(units, 6) AS unit_score, CASE WHEN abs(bp - units) < 0.2 THEN 'HOLD_AMBIGUOUS' WHEN bp < units THEN 'PASS_BP' ELSE 'PASS_REPEAT_UNITS' END AS unit FROM r""",
)
def _(lineitem):
    """Whether a source states bases or repeat units: the reading whose median log ratio to the span is lower."""
    m, raw = 3 + F.col("l_partkey") % 4, F.col("l_quantity")
    span = F.when(F.col("l_returnflag") < "M", raw).otherwise(raw * m)
    rows = lineitem.filter(raw > 0).withColumn("source", F.col("l_returnflag"))
    half = lambda x, name: iv.quantiles(rows, ["source"], F.abs(F.log2(x / span)), {name: 0.5}, tile=0.05)
    scores = half(raw, "bp").join(half(raw * m, "units"), "source")
    unit = F.when(F.abs(F.col("bp") - F.col("units")) < 0.2, "HOLD_AMBIGUOUS").when(F.col("bp") < F.col("units"), "PASS_BP").otherwise("PASS_REPEAT_UNITS")
    return scores.select("source", F.round("bp", 6).alias("bp_score"), F.round("units", 6).alias("unit_score"), unit.alias("unit"))


@query(
    "infer_lps_unit", "lineitem",
    """WITH r AS (SELECT l_returnflag AS source, avg((l_quantity > 30 + l_partkey % 20)::INT) AS bp, avg((l_quantity * 3 > 30 + l_partkey % 20)::INT) AS units FROM lineitem GROUP BY 1)
      SELECT source, round(bp, 6) AS bp_violations, round(units, 6) AS unit_violations, CASE WHEN abs(bp - units) < 0.02 THEN 'HOLD_AMBIGUOUS' WHEN bp < units THEN 'PASS_BP' ELSE 'PASS_REPEAT_UNITS' END AS unit FROM r""",
)
def _(lineitem):
    """The same by which reading breaks the bound less often."""
    most = 30 + F.col("l_partkey") % 20
    broken = lambda x: F.avg((x > most).cast("int"))
    found = lineitem.groupBy(F.col("l_returnflag").alias("source")).agg(broken(F.col("l_quantity")).alias("bp"), broken(F.col("l_quantity") * 3).alias("units"))
    unit = F.when(F.abs(F.col("bp") - F.col("units")) < 0.02, "HOLD_AMBIGUOUS").when(F.col("bp") < F.col("units"), "PASS_BP").otherwise("PASS_REPEAT_UNITS")
    return found.select("source", F.round("bp", 6).alias("bp_violations"), F.round("units", 6).alias("unit_violations"), unit.alias("unit"))


@query(
    "population_tail_class", "lineitem",
    """WITH l AS (SELECT l_linestatus, min(l_extendedprice) AS p0, quantile_cont(l_extendedprice, 0.05) AS p5, quantile_cont(l_extendedprice, 0.95) AS p95, quantile_cont(l_extendedprice, 0.99) AS p99 FROM lineitem WHERE l_returnflag = 'N' GROUP BY l_linestatus),
      c AS (SELECT l_linestatus, CASE WHEN l_extendedprice < p0 THEN 'BELOW_OBSERVED_MIN' WHEN l_extendedprice < p5 THEN 'BELOW_P5' WHEN l_extendedprice > p99 THEN 'ABOVE_P99' WHEN l_extendedprice > p95 THEN 'ABOVE_P95' ELSE 'WITHIN_P5_P95' END AS tail FROM lineitem JOIN l USING (l_linestatus))
      SELECT l_linestatus, tail, count(*) AS observations FROM c GROUP BY ALL""",
)
def _(lineitem):
    """Observations against the percentile ladder of their population."""
    x = F.col("l_extendedprice")
    observed = lineitem.filter("l_returnflag = 'N'")
    ladder = iv.quantiles(observed, ["l_linestatus"], x, {"p0": 0.0, "p5": 0.05, "p95": 0.95, "p99": 0.99}, tile=1000)
    tail = F.when(x < F.col("p0"), "BELOW_OBSERVED_MIN").when(x < F.col("p5"), "BELOW_P5").when(x > F.col("p99"), "ABOVE_P99").when(x > F.col("p95"), "ABOVE_P95").otherwise("WITHIN_P5_P95")
    return lineitem.join(F.broadcast(ladder), "l_linestatus").groupBy("l_linestatus", tail.alias("tail")).agg(F.count("*").alias("observations"))
