"""Queries of anchors around loci and of the review of tracts that aren't exact."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequences as s
from ..operators import assignment as asg
from ..operators import intervals as iv
from .common import register

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)


@query(
    "record_key_profile", "events",
    """WITH k AS (SELECT event_type, unnest(list_concat(json_keys(props), CASE WHEN value > 100 THEN ['large'] ELSE [] END)) AS key FROM events), n AS (SELECT event_type, count(*) AS records FROM events GROUP BY event_type)
      SELECT event_type, key, count(*) AS holding, round(count(*)::DOUBLE / any_value(records), 6) AS share FROM k JOIN n USING (event_type) GROUP BY event_type, key""",
)
def _(events):
    """The share of records that hold each key."""
    keys = F.concat(F.json_object_keys("props"), F.when(F.col("value") > 100, F.array(F.lit("large"))).otherwise(F.array().cast("array<string>")))
    counts = events.groupBy("event_type").agg(F.count("*").alias("records"))
    held = events.select("event_type", F.explode(keys).alias("key")).groupBy("event_type", "key").agg(F.count("*").alias("holding"))
    return held.join(counts, "event_type").select("event_type", "key", "holding", F.round(F.col("holding") / F.col("records"), 6).alias("share"))


def anchors(blocks, targets, good=None):
    """Per read and disease locus: whether blocks within 150 bases lie before it and after it, and how many were refused."""
    loci = targets.filter("target_source = 'DISEASE'").select("target_region_id", "chrom", "start_pos", "end_pos")
    found = asg.flanking(blocks, loci, good or (lambda start, end: F.lit(True)))
    geometry = F.when(F.col("l") & F.col("r"), "BOTH_GENOMIC_FLANKS_RESCUED").when(F.col("r"), "GENOMIC_RIGHT_FLANK_RESCUED_ONLY").when(F.col("l"), "GENOMIC_LEFT_FLANK_RESCUED_ONLY").otherwise("NO_GENOMIC_FLANK_RESCUE")
    evidence = F.when(F.col("l") & F.col("r"), "SPAN_RESCUE_CANDIDATE").when(F.col("r"), "RIGHT_ONLY_INTERNAL_RESCUED").when(F.col("l"), "LEFT_ONLY_INTERNAL_RESCUED").otherwise("REPEAT_ONLY_UNANCHORED")
    return found.select("read_id", "ordinal", "target_region_id", geometry.alias("geometry_class"), evidence.alias("evidence"), "refused")


ANCHOR_SQL = """WITH n AS (SELECT read_id, ordinal, target_region_id, block_end <= start_pos AS l, block_start >= end_pos AS r, {ok} AS ok FROM blocks b JOIN targets t ON b.chrom = t.chrom AND t.target_source = 'DISEASE' AND ((block_end <= start_pos AND start_pos - block_end <= 150) OR (block_start >= end_pos AND block_start - end_pos <= 150))),
      g AS (SELECT read_id, ordinal, target_region_id, bool_or(l AND ok) AS l, bool_or(r AND ok) AS r, count(*) FILTER (NOT ok) AS refused FROM n GROUP BY ALL)
      SELECT read_id, ordinal, target_region_id, CASE WHEN l AND r THEN 'BOTH_GENOMIC_FLANKS_RESCUED' WHEN r THEN 'GENOMIC_RIGHT_FLANK_RESCUED_ONLY' WHEN l THEN 'GENOMIC_LEFT_FLANK_RESCUED_ONLY' ELSE 'NO_GENOMIC_FLANK_RESCUE' END AS geometry_class,
        CASE WHEN l AND r THEN 'SPAN_RESCUE_CANDIDATE' WHEN r THEN 'RIGHT_ONLY_INTERNAL_RESCUED' WHEN l THEN 'LEFT_ONLY_INTERNAL_RESCUED' ELSE 'REPEAT_ONLY_UNANCHORED' END AS evidence, refused FROM g"""


@query("block_anchor_geometry", "blocks targets", ANCHOR_SQL.replace("{ok}", "true"))
def _(blocks, targets):
    return anchors(blocks, targets)


@query("validated_geometry", "blocks targets", ANCHOR_SQL.replace("{ok}", "block_end - block_start >= 56"))
def _(blocks, targets):
    """The same after the quality filter, here a least length; refused anchors are counted."""
    return anchors(blocks, targets, lambda start, end: end - start >= 56)


@query(
    "extreme_tract_audit", "segments reads",
    """WITH t AS (SELECT s.read_id, s.attempt_no, s.purity, s.seg_end - s.seg_start AS bp, len(seq) AS n, substr(seq, (seg_start + 1)::INT, (seg_end - seg_start)::INT) AS tract FROM segments s JOIN reads r USING (read_id) WHERE evidence_class <> 'SPAN' AND seg_end - seg_start >= 45 AND seg_start < len(seq)),
      c AS (SELECT *, greatest(len(tract) - len(replace(tract, 'A', '')), len(tract) - len(replace(tract, 'T', '')))::DOUBLE / len(tract) AS at_share FROM t)
      SELECT read_id, attempt_no, bp, round(bp::DOUBLE / n, 6) AS share, CASE WHEN at_share >= 0.8 THEN 'POLY_A_T_OR_HOMOPOLYMER_REVIEW' WHEN bp::DOUBLE / n >= 0.5 THEN 'LOW_COMPLEXITY_LONG_TRACT_REVIEW' WHEN purity >= 0.8 THEN 'HIGH_PURITY_LONG_PERIODIC_TRACT_REVIEW' ELSE 'COMPOUND_OR_UNRESOLVED_SEQUENCE_REVIEW' END AS review FROM c""",
)
def _(segments, reads):
    """Long tracts that aren't exact, with what to review them for."""
    bp = F.col("seg_end") - F.col("seg_start")
    rows = segments.filter((F.col("evidence_class") != "SPAN") & (bp >= 45)).join(reads, "read_id").filter(F.col("seg_start") < F.length("seq"))
    rows = rows.withColumn("bp", bp).withColumn("c", s.complexity(F.substring(F.col("seq"), (F.col("seg_start") + 1).cast("int"), F.col("bp").cast("int"))))
    poly, share = F.greatest("c.fraction_a", "c.fraction_t") >= 0.8, F.col("bp") / F.length("seq")
    review = F.when(poly, "POLY_A_T_OR_HOMOPOLYMER_REVIEW").when(share >= 0.5, "LOW_COMPLEXITY_LONG_TRACT_REVIEW").when(F.col("purity") >= 0.8, "HIGH_PURITY_LONG_PERIODIC_TRACT_REVIEW").otherwise("COMPOUND_OR_UNRESOLVED_SEQUENCE_REVIEW")
    return rows.select("read_id", "attempt_no", "bp", F.round(share, 6).alias("share"), review.alias("review"))


def recurrent(segments):
    """Non-exact segments with how many different reads of good quality support their locus."""
    rows = segments.filter("evidence_class <> 'SPAN'")
    support = rows.filter("mapq >= 20").groupBy("target_region_id").agg(F.count_distinct("read_id").alias("recurrent"))
    return rows.join(support, "target_region_id", "left").withColumn("recurrent", F.coalesce("recurrent", F.lit(0)))


RECURRENT = """WITH v AS (SELECT * FROM segments WHERE evidence_class <> 'SPAN'), k AS (SELECT target_region_id, count(DISTINCT read_id) AS n FROM v WHERE mapq >= 20 GROUP BY target_region_id), w AS (SELECT v.*, coalesce(k.n, 0) AS recurrent FROM v LEFT JOIN k USING (target_region_id))"""


@query(
    "event_triage", "segments",
    RECURRENT + """ SELECT read_id, attempt_no, recurrent, CASE WHEN mapq < 5 THEN 'NO_CALL_LOW_MAPPING' WHEN canonical_motif IN ('A', 'AT') THEN 'HOMOPOLYMER_REVIEW' WHEN purity >= 0.9 THEN 'REFERENCE_COMPARISON_HIGH_PERIODICITY' WHEN recurrent >= 10 THEN 'REFERENCE_COMPARISON_RECURRENT' ELSE 'NO_CALL_SINGLE_COMPLEX' END AS disposition FROM w""",
)
def _(segments):
    first = (
        F.when(F.col("mapq") < 5, "NO_CALL_LOW_MAPPING").when(F.col("canonical_motif").isin("A", "AT"), "HOMOPOLYMER_REVIEW").when(F.col("purity") >= 0.9, "REFERENCE_COMPARISON_HIGH_PERIODICITY")
        .when(F.col("recurrent") >= 10, "REFERENCE_COMPARISON_RECURRENT").otherwise("NO_CALL_SINGLE_COMPLEX")
    )
    return recurrent(segments).select("read_id", "attempt_no", "recurrent", first.alias("disposition"))


@query(
    "locus_support", "segments targets",
    RECURRENT + """, o AS (SELECT w.*, greatest(0, least(seg_end, 30 + end_pos - start_pos) - greatest(seg_start, 30)) AS ov FROM w JOIN targets USING (target_region_id))
      SELECT read_id, attempt_no, round(ov::DOUBLE / (seg_end - seg_start), 6) AS overlap_fraction, CASE WHEN ov = 0 THEN 'NO_CALL_NO_TARGET_SUPPORT' WHEN ov::DOUBLE / (seg_end - seg_start) < 0.5 THEN 'NO_CALL_PARTIAL_TARGET_SUPPORT' WHEN purity >= 0.9 THEN 'RETAIN_REFERENCE_COMPARISON_HIGH_PERIODICITY' WHEN recurrent >= 10 THEN 'RETAIN_REFERENCE_COMPARISON_RECURRENT_COMPOUND' ELSE 'NO_CALL_SINGLE_COMPLEX_TARGET_SUPPORTED' END AS disposition FROM o""",
)
def _(segments, targets):
    """Dispositions refined by how much of a tract its target supports; the target starts at base 30."""
    rows = recurrent(segments).join(targets.select("target_region_id", (F.col("end_pos") - F.col("start_pos")).alias("span")), "target_region_id")
    both = s.overlap(F.col("seg_start"), F.col("seg_end"), F.lit(30), F.col("span") + 30)
    share = both / (F.col("seg_end") - F.col("seg_start"))
    kind = (
        F.when(both == 0, "NO_CALL_NO_TARGET_SUPPORT").when(share < 0.5, "NO_CALL_PARTIAL_TARGET_SUPPORT").when(F.col("purity") >= 0.9, "RETAIN_REFERENCE_COMPARISON_HIGH_PERIODICITY")
        .when(F.col("recurrent") >= 10, "RETAIN_REFERENCE_COMPARISON_RECURRENT_COMPOUND").otherwise("NO_CALL_SINGLE_COMPLEX_TARGET_SUPPORTED")
    )
    return rows.select("read_id", "attempt_no", F.round(share, 6).alias("overlap_fraction"), kind.alias("disposition"))


@query(
    "apply_overrides", "targets",
    """WITH d AS (SELECT * FROM targets WHERE target_source = 'DISEASE'), c AS (SELECT * FROM targets WHERE target_source = 'CATALOG'), o AS (SELECT c.target_region_id, string_agg(d.target_region_id, ';' ORDER BY d.target_region_id) AS ids FROM c JOIN d ON d.chrom = c.chrom AND d.start_pos < c.end_pos AND c.start_pos < d.end_pos GROUP BY c.target_region_id)
      SELECT c.target_region_id, ids, ids IS NOT NULL AS forced, CASE WHEN ids IS NOT NULL THEN 'T0' WHEN end_pos - start_pos <= 20 THEN 'T1' ELSE 'T2' END AS tier, CASE WHEN ids IS NOT NULL THEN 'DISEASE_OVERRIDE' WHEN end_pos - start_pos <= 20 THEN 'SHORT' ELSE 'NONE' END AS include_reason FROM c LEFT JOIN o USING (target_region_id)""",
)
def _(targets):
    """Catalog loci with the disease loci that touch them, and forced, tier and reason worked out anew."""
    catalog = targets.filter("target_source = 'CATALOG'")
    known = targets.filter("target_source = 'DISEASE'").select("chrom", F.col("target_region_id").alias("known"), F.col("start_pos").alias("d0"), F.col("end_pos").alias("d1"))
    # ids are put together once for loci that lie at the same places, of disease loci by span; an id may have several rows
    spans = known.groupBy("chrom", "d0", "d1").agg(F.collect_set("known").alias("names"))
    places = catalog.groupBy("target_region_id").agg(F.sort_array(F.collect_set(F.struct("chrom", "start_pos", "end_pos"))).alias("places"))
    at = places.select("places").distinct().select("places", F.explode("places").alias("p")).select("places", "p.*")
    hits = iv.interval_join(at, spans, ("chrom", "start_pos", "end_pos"), ("chrom", "d0", "d1"))
    ids = hits.groupBy("places").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))), ";").alias("ids"))
    forced, short = F.col("ids").isNotNull(), F.col("end_pos") - F.col("start_pos") <= 20
    tier, reason = F.when(forced, "T0").when(short, "T1").otherwise("T2"), F.when(forced, "DISEASE_OVERRIDE").when(short, "SHORT").otherwise("NONE")
    return catalog.join(places.join(ids, "places"), "target_region_id", "left").select("target_region_id", "ids", forced.alias("forced"), tier.alias("tier"), reason.alias("include_reason"))


@query(
    "override_plan", "motifs",
    f"""WITH w AS (SELECT p_partkey, motif, other, unnest(list_concat(list_transform(range(1, len(motif) + 1), lambda i: substr(motif, i) || substr(motif, 1, i - 1)),
        list_transform(range(1, len(motif) + 1), lambda i: substr(reverse(translate(motif, 'ACGTN', 'TGCAN')), i) || substr(reverse(translate(motif, 'ACGTN', 'TGCAN')), 1, i - 1)))) AS way FROM motifs),
      c AS (SELECT p_partkey, bool_or(len(motif) = len(other) AND regexp_full_match(other, replace(way, 'N', '[ACGT]'))) AS compatible FROM w GROUP BY p_partkey)
      SELECT p_partkey, CASE WHEN NOT compatible THEN 'MANUAL_MOTIF_REVIEW' WHEN p_partkey % 4 = 0 THEN 'KEEP_CURRENT_CORE' ELSE 'ADD_TO_CORE' END AS action FROM c""",
)
def _(motifs):
    """What to do with a disease locus's candidate: its motif must fit, degenerate codes included; core members stay."""
    fits = s.iupac_match(F.col("motif"), F.col("other"))
    return motifs.select("p_partkey", F.when(~fits, "MANUAL_MOTIF_REVIEW").when(F.col("p_partkey") % 4 == 0, "KEEP_CURRENT_CORE").otherwise("ADD_TO_CORE").alias("action"))


@query(
    "caller_integration", "segments",
    """SELECT read_id, attempt_no, CASE WHEN mapq = 0 THEN 'NOT_ATTEMPTED_NO_PROJECTED_TARGET' WHEN canonical_motif = 'A' THEN 'NOT_ATTEMPTED_UNSUPPORTED_STRATEGY' WHEN seg_start > 85 THEN 'NOT_ATTEMPTED_NO_WINDOW_SEQUENCE' ELSE 'CALLED' END AS integration_status,
      CASE WHEN evidence_class = 'LEFT_ANCHORED_CENSORED_RIGHT' THEN CASE WHEN attempt_no % 2 = 0 THEN 'LEFT' ELSE 'RIGHT' END ELSE 'NONE' END AS censor_side, CASE WHEN mapq > 0 AND canonical_motif <> 'A' AND seg_start <= 85 THEN seg_start + 100 END AS raw_start FROM segments""",
)
def _(segments):
    """Why a job wasn't attempted, which raw side is censored (turned on the reverse strand), raw coordinates of calls."""
    status = F.when(F.col("mapq") == 0, "NOT_ATTEMPTED_NO_PROJECTED_TARGET").when(F.col("canonical_motif") == "A", "NOT_ATTEMPTED_UNSUPPORTED_STRATEGY").when(F.col("seg_start") > 85, "NOT_ATTEMPTED_NO_WINDOW_SEQUENCE").otherwise("CALLED")
    side = F.when(F.col("evidence_class") != "LEFT_ANCHORED_CENSORED_RIGHT", "NONE").when(F.col("attempt_no") % 2 == 0, "LEFT").otherwise("RIGHT")
    return segments.withColumn("integration_status", status).select("read_id", "attempt_no", "integration_status", side.alias("censor_side"), F.when(F.col("integration_status") == "CALLED", F.col("seg_start") + 100).alias("raw_start"))


@query(
    "target_constrained_evidence", "segments targets",
    """WITH j AS (SELECT s.*, greatest(0, least(seg_end, 30 + end_pos - start_pos) - greatest(seg_start, 30)) AS ov, least(12, (end_pos - start_pos) // 2) AS need FROM segments s JOIN targets USING (target_region_id))
      SELECT read_id, attempt_no, CASE WHEN ov < need THEN 'UNRESOLVED' WHEN seg_start > 10 AND seg_end < 90 THEN 'SPAN' WHEN seg_start > 10 THEN 'LEFT_ANCHORED_CENSORED_RIGHT' WHEN seg_end < 90 THEN 'RIGHT_ANCHORED_CENSORED_LEFT' ELSE 'REPEAT_ONLY_UNANCHORED' END AS evidence,
        CASE WHEN ov < need THEN 'no_call' WHEN seg_start > 10 AND seg_end < 90 THEN 'exact' ELSE 'lower_bound' END AS sizing, CASE WHEN ov >= need AND mapq >= 30 AND purity >= 0.9 THEN 'HIGH' WHEN ov >= need AND mapq >= 10 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM j""",
)
def _(segments, targets):
    """Evidence of tracts that overlap their target enough, by how near they come to the read's ends."""
    size = F.col("span")
    rows = segments.join(targets.select("target_region_id", (F.col("end_pos") - F.col("start_pos")).alias("span")), "target_region_id")
    enough = s.overlap(F.col("seg_start"), F.col("seg_end"), F.lit(30), size + 30) >= F.least(F.lit(12), F.floor(size / 2))
    left, right = F.col("seg_start") > 10, F.col("seg_end") < 90
    evidence = F.when(~enough, "UNRESOLVED").when(left & right, "SPAN").when(left, "LEFT_ANCHORED_CENSORED_RIGHT").when(right, "RIGHT_ANCHORED_CENSORED_LEFT").otherwise("REPEAT_ONLY_UNANCHORED")
    sizing = F.when(~enough, "no_call").when(left & right, "exact").otherwise("lower_bound")
    confidence = F.when(enough & (F.col("mapq") >= 30) & (F.col("purity") >= 0.9), "HIGH").when(enough & (F.col("mapq") >= 10), "MEDIUM").otherwise("LOW")
    return rows.select("read_id", "attempt_no", evidence.alias("evidence"), sizing.alias("sizing"), confidence.alias("confidence"))


@query(
    "residual_context_class", "reads",
    """WITH b AS (SELECT read_id, seq, substr(seq, 1, 20 + (read_id % 13)::INT) AS part FROM reads), u AS (SELECT read_id, part, unnest(range(1, len(part) - 1)) AS i FROM b),
      k AS (SELECT read_id, any_value(part) AS part, count(DISTINCT substr(part, i::INT, 3))::DOUBLE / least(64, any_value(len(part)) - 2) AS kmers FROM u GROUP BY read_id)
      SELECT read_id, CASE WHEN len(part) < 22 THEN 'SHORT_CONTEXT' WHEN kmers < 0.8 THEN 'LOW_COMPLEXITY_CONTEXT' WHEN greatest(len(part) - len(replace(part, 'A', '')), len(part) - len(replace(part, 'C', '')), len(part) - len(replace(part, 'G', '')), len(part) - len(replace(part, 'T', '')))::DOUBLE / len(part) >= 0.5 THEN 'BIASED_CONTEXT' ELSE 'UNRESOLVED_CONTEXT' END AS context FROM k""",
)
def _(reads):
    """What the rest of a read beside its tract looks like."""
    part = F.substring(F.col("seq"), F.lit(1), (20 + F.col("read_id") % 13).cast("int"))
    rows = reads.select("read_id", F.length(part).alias("n"), s.complexity(part).alias("c"))
    most = F.greatest(*[F.col(f"c.fraction_{b}") for b in "acgt"])
    kind = F.when(F.col("n") < 22, "SHORT_CONTEXT").when(F.col("c.kmer_fraction") < 0.8, "LOW_COMPLEXITY_CONTEXT").when(most >= 0.5, "BIASED_CONTEXT").otherwise("UNRESOLVED_CONTEXT")
    return rows.select("read_id", kind.alias("context"))


@query(
    "bridge_motif_signal", "paf_rows",
    """WITH d AS (SELECT query_name, ordinal, mapq = 0 OR strand = '-' OR query_start > 10 OR target_start > 10 OR residue_matches < 70 OR query_end - query_start < 84 OR target_end < 112 AS fails, target_start % 4 AS windows FROM paf_rows)
      SELECT CASE WHEN NOT fails AND windows > 0 THEN 'BRIDGE_AND_REPEAT_SIGNAL' WHEN NOT fails THEN 'BRIDGE_WITHOUT_REPEAT_SIGNAL' WHEN windows > 0 THEN 'REPEAT_SIGNAL_WITHOUT_BRIDGE' ELSE 'NEITHER' END AS signal, count(*) AS clips FROM d GROUP BY signal""",
)
def _(paf):
    """Bridges beside repeat-like windows in the clip (here a count from the target start)."""
    from ..operators.rescue import bridge_decision

    rows = bridge_decision(paf, entry=100).withColumn("windows", F.col("target_start") % 4)
    good, repeat = F.col("priority") == 5, F.col("windows") > 0
    signal = F.when(good & repeat, "BRIDGE_AND_REPEAT_SIGNAL").when(good, "BRIDGE_WITHOUT_REPEAT_SIGNAL").when(repeat, "REPEAT_SIGNAL_WITHOUT_BRIDGE").otherwise("NEITHER")
    return rows.groupBy(signal.alias("signal")).agg(F.count("*").alias("clips"))


@query(
    "reference_architecture", "reads orders",
    """WITH w AS (SELECT read_id, o_custkey % 6 AS k, substr(seq, 33, len(seq) - 64) AS tract FROM reads JOIN orders ON read_id = o_orderkey), m AS (SELECT read_id, k, tract, unnest(['CAG', 'AAG', 'GCC']) AS motif FROM w),
      i AS (SELECT read_id, k, tract, motif, unnest([0, 1, 2]) AS phase FROM m), p AS (SELECT read_id, any_value(k) AS k, motif, max(len(list_filter(range(len(tract)), lambda j: substr(tract, j::INT + 1, 1) = substr(motif, (j::INT + phase) % 3 + 1, 1)))::DOUBLE / len(tract)) AS purity FROM i GROUP BY read_id, motif),
      b AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY round(purity, 9) DESC, motif) = 1)
      SELECT read_id, motif AS observed, round(purity, 6) AS purity, motif = CASE k WHEN 0 THEN 'CAG' WHEN 1 THEN 'AAG' WHEN 2 THEN 'GCC' ELSE '-' END AS same_motif FROM b""",
)
def _(reads, orders):
    """The best motif of each tract, its purity, and whether it is the reference's."""
    motifs = ("CAG", "AAG", "GCC")
    tracts = reads.join(orders, F.col("read_id") == F.col("o_orderkey")).select("read_id", (F.col("o_custkey") % 6).cast("int").alias("k"), s.letters(F.substring(F.col("seq"), F.lit(33), F.length("seq") - 64)).alias("bases"))
    ways = F.explode(F.array(*[F.struct(F.lit(m).alias("motif"), F.lit(m[p:] + m[:p]).alias("way")) for m in motifs for p in range(3)]))
    hit = F.aggregate(F.transform("bases", lambda b, i: (b == F.substring(F.col("w.way"), (i % 3 + 1).cast("int"), F.lit(1))).cast("int")), F.lit(0), lambda a, x: a + x)
    scored = tracts.withColumn("w", ways).groupBy("read_id", "k", F.col("w.motif").alias("motif")).agg(F.max(hit / F.size("bases")).alias("purity"))
    best = scored.groupBy("read_id", "k").agg(F.min_by(F.struct("motif", "purity"), F.struct(-F.round("purity", 9), "motif")).alias("b"))
    expected = F.get(F.array(*[F.lit(m) for m in motifs]), F.col("k"))
    return best.select("read_id", F.col("b.motif").alias("observed"), F.round("b.purity", 6).alias("purity"), F.coalesce(F.col("b.motif") == expected, F.lit(False)).alias("same_motif"))
