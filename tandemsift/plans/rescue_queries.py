"""Queries of rescue decisions, competitions and audits of calls against their targets."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import sequences as s
from .common import register

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)


@query(
    "orientation_transform", "reads alignments",
    """SELECT read_id, ordinal, CASE WHEN (strand = '+') = (mapq % 2 = 0) THEN 'AS_RAW' ELSE 'REVERSE_COMPLEMENT' END AS transform,
      CASE WHEN (strand = '+') = (mapq % 2 = 0) THEN substr(seq, 1, 20) ELSE reverse(translate(substr(seq, 1, 20), 'ACGT', 'TGCA')) END AS clip FROM alignments JOIN reads USING (read_id)""",
)
def _(reads, alignments):
    """A clip turned to run from the mapped block toward its target."""
    right = F.col("mapq") % 2 == 0
    as_raw = (F.col("strand") == "+") == right
    clip = F.substring("seq", 1, 20)
    rows = alignments.join(reads, "read_id")
    return rows.select("read_id", "ordinal", F.when(as_raw, "AS_RAW").otherwise("REVERSE_COMPLEMENT").alias("transform"), F.when(as_raw, F.upper(clip)).otherwise(s.reverse_complement(clip)).alias("clip"))


@query(
    "orientation_audit", "reads alignments",
    """WITH c AS (SELECT read_id, ordinal, substr(seq, 1, 20) AS raw, reverse(translate(substr(seq, 1, 20), 'ACGT', 'TGCA')) AS rc, mapq % 7 AS k FROM alignments JOIN reads USING (read_id)),
      t AS (SELECT *, CASE WHEN k = 0 THEN reverse(raw) WHEN k = 1 THEN rc WHEN k = 2 THEN raw || 'A' ELSE raw END AS stored FROM c)
      SELECT CASE WHEN stored = raw THEN 'AGREES' WHEN stored = rc THEN 'TRANSFORM_MISMATCH' WHEN stored = reverse(raw) THEN 'REVERSAL_MISMATCH' ELSE 'CONTENT_MISMATCH' END AS outcome, count(*) AS clips FROM t GROUP BY outcome""",
)
def _(reads, alignments):
    """Stored clips against independently turned ones."""
    raw, k = F.substring("seq", 1, 20), F.col("mapq") % 7
    stored = F.when(k == 0, F.reverse(raw)).when(k == 1, s.reverse_complement(raw)).when(k == 2, F.concat(raw, F.lit("A"))).otherwise(raw)
    rows = alignments.join(reads, "read_id").select(raw.alias("raw"), stored.alias("stored"))
    outcome = F.when(F.col("stored") == F.col("raw"), "AGREES").when(F.col("stored") == s.reverse_complement(F.col("raw")), "TRANSFORM_MISMATCH").when(F.col("stored") == F.reverse("raw"), "REVERSAL_MISMATCH").otherwise("CONTENT_MISMATCH")
    return rows.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("clips"))


@query(
    "bridge_reference_geometry", "blocks targets",
    """SELECT b.read_id, b.ordinal, b.block_index, t.target_region_id, CASE WHEN t.start_pos >= b.block_end THEN 'RIGHT' ELSE 'LEFT' END AS side, CASE WHEN t.start_pos >= b.block_end THEN b.block_end ELSE greatest(0, t.start_pos) END::BIGINT AS fetch_start,
        CASE WHEN t.start_pos >= b.block_end THEN t.end_pos ELSE b.block_start END::BIGINT AS fetch_end, CASE WHEN t.start_pos >= b.block_end THEN t.start_pos - b.block_end ELSE b.block_start - t.end_pos END::BIGINT + least(12, t.end_pos - t.start_pos) AS required_bp
      FROM blocks b JOIN targets t ON b.chrom = t.chrom WHERE t.target_source = 'DISEASE' AND ((t.start_pos >= b.block_end AND t.start_pos - b.block_end <= 40) OR (b.block_start >= t.end_pos AND b.block_start - t.end_pos <= 40))""",
)
def _(blocks, targets):
    """What reference to fetch from a block's edge to a target beyond it, and how far an alignment must reach."""
    from ..operators.intervals import interval_join

    near = interval_join(blocks, targets.filter("target_source = 'DISEASE'"), ("chrom", "block_start", "block_end"), ("chrom", "start_pos", "end_pos"), within=40).filter("overlap_bp = 0")
    right = F.col("start_pos") >= F.col("block_end")
    start, end = F.when(right, F.col("block_end")).otherwise(F.greatest(F.lit(0), "start_pos")), F.when(right, F.col("end_pos")).otherwise(F.col("block_start"))
    entry = F.least(F.lit(12), F.col("end_pos") - F.col("start_pos"))
    return near.select("read_id", "ordinal", "block_index", "target_region_id", F.when(right, "RIGHT").otherwise("LEFT").alias("side"), start.cast("long").alias("fetch_start"), end.cast("long").alias("fetch_end"), (F.col("distance_bp").cast("long") + entry).alias("required_bp"))


@query(
    "one_flank_reclassify", "segments",
    """WITH g AS (SELECT *, CASE mapq % 5 WHEN 0 THEN 'LEFT_FLANK_ONLY' WHEN 1 THEN 'PROXIMAL_RIGHT_WITH_SOFTCLIP' WHEN 2 THEN 'RIGHT_FLANK_ONLY' WHEN 3 THEN 'PROXIMAL_LEFT_WITH_SOFTCLIP' ELSE 'UNRESOLVED' END AS geometry, purity >= 0.8 AS pass FROM segments),
      n AS (SELECT *, CASE WHEN evidence_class = 'UNRESOLVED' AND pass AND mapq % 5 IN (0, 1) THEN 'LEFT_ONLY_INTERNAL' WHEN evidence_class = 'UNRESOLVED' AND pass AND mapq % 5 IN (2, 3) THEN 'RIGHT_ONLY_INTERNAL' ELSE evidence_class END AS new_class FROM g)
      SELECT read_id, attempt_no, new_class, CASE WHEN new_class LIKE '%_ONLY_INTERNAL' AND mapq >= 20 AND attempt_no = 1 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM n""",
)
def _(segments):
    """Unresolved tracts with one flank become internal ones of that side; good ones gain confidence."""
    k = (F.col("mapq") % 5).cast("int")
    names = ("LEFT_FLANK_ONLY", "PROXIMAL_RIGHT_WITH_SOFTCLIP", "RIGHT_FLANK_ONLY", "PROXIMAL_LEFT_WITH_SOFTCLIP", "UNRESOLVED")
    rows = segments.withColumn("geometry", F.get(F.array(*[F.lit(n) for n in names]), k))
    open_ = (F.col("evidence_class") == "UNRESOLVED") & (F.col("purity") >= 0.8)
    kind = F.when(open_ & F.col("geometry").isin(*names[:2]), "LEFT_ONLY_INTERNAL").when(open_ & F.col("geometry").isin(*names[2:4]), "RIGHT_ONLY_INTERNAL").otherwise(F.col("evidence_class"))
    lifted = kind.isin("LEFT_ONLY_INTERNAL", "RIGHT_ONLY_INTERNAL") & (F.col("mapq") >= 20) & (F.col("attempt_no") == 1)
    return rows.select("read_id", "attempt_no", kind.alias("new_class"), F.when(lifted, "MEDIUM").otherwise("LOW").alias("confidence"))


@query(
    "exact_span_audit", "segments targets",
    """WITH j AS (SELECT s.*, end_pos - start_pos AS span, 20 AS t0 FROM segments s JOIN targets t USING (target_region_id) WHERE evidence_class = 'SPAN')
      SELECT read_id, attempt_no, CASE WHEN span < 12 THEN 'EXACT_SPAN_TOO_SHORT' WHEN purity >= 0.8 THEN 'PERIODIC_EXACT_SPAN_PASS' ELSE 'EXACT_SPAN_LOW_PERIODICITY' END AS status, round((seg_end - seg_start)::DOUBLE / span, 6) AS old_ratio,
        concat_ws(';', CASE WHEN span < 12 THEN 'PROJECTED_SPAN_BELOW_MINIMUM_REPEAT_BP' END, CASE WHEN purity < 0.8 THEN 'GLOBAL_PURITY_BELOW_THRESHOLD' END, CASE WHEN greatest(0, t0 - seg_start) + greatest(0, seg_end - t0 - span) > 0 THEN 'OLD_LOCAL_TRACT_EXTENDED_OUTSIDE_TARGET' END) AS flags FROM j""",
)
def _(segments, targets):
    """Spanning tracts held against their target's interval (from base 20 of the read): status, ratio, flags."""
    rows = segments.filter("evidence_class = 'SPAN'").join(targets.select("target_region_id", (F.col("end_pos") - F.col("start_pos")).alias("span")), "target_region_id")
    span, purity = F.col("span"), F.col("purity")
    outside = F.greatest(F.lit(0), 20 - F.col("seg_start")) + F.greatest(F.lit(0), F.col("seg_end") - 20 - span)
    flags = F.array_compact(F.array(F.when(span < 12, "PROJECTED_SPAN_BELOW_MINIMUM_REPEAT_BP"), F.when(purity < 0.8, "GLOBAL_PURITY_BELOW_THRESHOLD"), F.when(outside > 0, "OLD_LOCAL_TRACT_EXTENDED_OUTSIDE_TARGET")))
    status = F.when(span < 12, "EXACT_SPAN_TOO_SHORT").when(purity >= 0.8, "PERIODIC_EXACT_SPAN_PASS").otherwise("EXACT_SPAN_LOW_PERIODICITY")
    return rows.select("read_id", "attempt_no", status.alias("status"), F.round((F.col("seg_end") - F.col("seg_start")) / span, 6).alias("old_ratio"), F.array_join(flags, ";").alias("flags"))


@query(
    "flank_rescue_status", "paf_rows",
    """WITH q AS (SELECT query_name, bool_or(strand = '+' AND mapq >= 20) AS l, bool_or(strand = '-' AND mapq >= 20) AS r, min(query_start) <= 2 AS s, max(query_end) >= 115 AS e FROM paf_rows GROUP BY query_name)
      SELECT query_name, CASE WHEN l AND r THEN 'RESCUED_BOTH_FLANKS_CANDIDATE' WHEN l AND e THEN 'LEFT_FLANK_RIGHT_CENSORED_CANDIDATE' WHEN r AND s THEN 'RIGHT_FLANK_LEFT_CENSORED_CANDIDATE' WHEN l OR r THEN 'ONE_FLANK_PARTIAL_INTERNAL' WHEN s OR e THEN 'REPEAT_ONLY_END_TRUNCATED' ELSE 'REPEAT_ONLY_UNANCHORED_CONFIRMED' END AS rescue_status,
        CASE WHEN l AND r THEN 'EXACT_SPAN_RESCUE_REQUIRES_INTERVAL_VALIDATION' WHEN (l AND e) OR (r AND s) THEN 'LOWER_BOUND_RESCUE_REQUIRES_INTERVAL_VALIDATION' WHEN l OR r THEN 'NOT_MEASURABLE_ONE_FLANK_INTERNAL' WHEN s OR e THEN 'NOT_MEASURABLE_REPEAT_ONLY_END_TRUNCATED' ELSE 'NOT_MEASURABLE_REPEAT_ONLY_UNANCHORED' END AS allele_status FROM q""",
)
def _(paf):
    """What the anchors on both sides of an event and its contact with the read's ends allow."""
    good = F.col("mapq") >= 20
    rows = paf.groupBy("query_name").agg(
        F.bool_or((F.col("strand") == "+") & good).alias("l"), F.bool_or((F.col("strand") == "-") & good).alias("r"), (F.min("query_start") <= 2).alias("s"), (F.max("query_end") >= 115).alias("e")
    )
    l, r, s0, e = (F.col(c) for c in "lrse")
    rescue = (
        F.when(l & r, "RESCUED_BOTH_FLANKS_CANDIDATE").when(l & e, "LEFT_FLANK_RIGHT_CENSORED_CANDIDATE").when(r & s0, "RIGHT_FLANK_LEFT_CENSORED_CANDIDATE")
        .when(l | r, "ONE_FLANK_PARTIAL_INTERNAL").when(s0 | e, "REPEAT_ONLY_END_TRUNCATED").otherwise("REPEAT_ONLY_UNANCHORED_CONFIRMED")
    )
    bound = (l & e) | (r & s0)
    allele = (
        F.when(l & r, "EXACT_SPAN_RESCUE_REQUIRES_INTERVAL_VALIDATION").when(bound, "LOWER_BOUND_RESCUE_REQUIRES_INTERVAL_VALIDATION").when(l | r, "NOT_MEASURABLE_ONE_FLANK_INTERNAL")
        .when(s0 | e, "NOT_MEASURABLE_REPEAT_ONLY_END_TRUNCATED").otherwise("NOT_MEASURABLE_REPEAT_ONLY_UNANCHORED")
    )
    return rows.select("query_name", rescue.alias("rescue_status"), allele.alias("allele_status"))


@query(
    "sequence_group_competition", "paf_rows targets",
    """WITH d AS (SELECT query_name, motif AS digest, max(residue_matches) AS score, bool_or(ordinal = 1) AS expected FROM paf_rows JOIN targets ON target_name = target_region_id GROUP BY ALL),
      b AS (SELECT query_name, max(score) AS best, max(CASE WHEN expected THEN score END) AS own FROM d GROUP BY query_name), n AS (SELECT d.query_name, count(*) FILTER (score = best) AS tied FROM d JOIN b USING (query_name) GROUP BY d.query_name)
      SELECT query_name, best, own, tied, CASE WHEN own IS NULL THEN 'EXPECTED_SEQUENCE_GROUP_NOT_OBSERVED' WHEN own = best AND tied = 1 THEN 'EXPECTED_SEQUENCE_GROUP_UNIQUE_BEST' WHEN own = best THEN 'EXPECTED_SEQUENCE_GROUP_TIED_BEST' WHEN own >= best * 0.95 THEN 'EXPECTED_SEQUENCE_GROUP_NEAR_BEST' ELSE 'DECOY_SEQUENCE_GROUP_OUTSCORES_EXPECTED' END AS specificity FROM b JOIN n USING (query_name)""",
)
def _(paf, targets):
    """References of one sequence compete as a group (here by motif); the expected one is the first alignment's."""
    joined = paf.join(targets.select(F.col("target_region_id").alias("target_name"), "motif"), "target_name")
    groups = joined.groupBy("query_name", "motif").agg(F.max("residue_matches").alias("score"), F.bool_or(F.col("ordinal") == 1).alias("expected"))
    found = groups.groupBy("query_name").agg(F.max("score").alias("best"), F.max(F.when(F.col("expected"), F.col("score"))).alias("own"), F.collect_list("score").alias("scores"))
    tied = F.size(F.filter("scores", lambda x: x == F.col("best"))).cast("long")
    own, best = F.col("own"), F.col("best")
    kind = (
        F.when(own.isNull(), "EXPECTED_SEQUENCE_GROUP_NOT_OBSERVED").when((own == best) & (F.col("tied") == 1), "EXPECTED_SEQUENCE_GROUP_UNIQUE_BEST").when(own == best, "EXPECTED_SEQUENCE_GROUP_TIED_BEST")
        .when(own >= best * 0.95, "EXPECTED_SEQUENCE_GROUP_NEAR_BEST").otherwise("DECOY_SEQUENCE_GROUP_OUTSCORES_EXPECTED")
    )
    return found.withColumn("tied", tied).select("query_name", "best", "own", "tied", kind.alias("specificity"))


@query(
    "catalog_local_competition", "paf_rows targets",
    """WITH j AS (SELECT p.*, motif FROM paf_rows p JOIN targets ON target_name = target_region_id), m AS (SELECT *, max(residue_matches) OVER (PARTITION BY query_name) AS best FROM j),
      g AS (SELECT query_name, count(*) AS targets, count(DISTINCT motif) AS sequences, count(*) FILTER (residue_matches = best) AS tied, count(DISTINCT CASE WHEN residue_matches = best THEN motif END) AS tied_sequences, count(*) FILTER (residue_matches >= 0.95 * best) AS near FROM m GROUP BY query_name)
      SELECT query_name, CASE WHEN targets = 1 THEN 'SOLE_TARGET' WHEN sequences = 1 THEN 'SHARED_SEQUENCE' WHEN tied_sequences > 1 THEN 'TIED_DISTINCT_SEQUENCES' WHEN tied > 1 THEN 'TIED_SAME_SEQUENCE' WHEN near > 1 THEN 'NEAR_BEST_COMPETITOR' ELSE 'UNIQUE_BEST' END AS status, targets, sequences FROM g""",
)
def _(paf, targets):
    """All reachable targets of a clip compete."""
    joined = paf.join(targets.select(F.col("target_region_id").alias("target_name"), "motif"), "target_name")
    rows = joined.withColumn("best", F.max("residue_matches").over(Window.partitionBy("query_name")))
    top = F.col("residue_matches") == F.col("best")
    found = rows.groupBy("query_name").agg(
        F.count("*").alias("targets"), F.count_distinct("motif").alias("sequences"), F.count_if(top).alias("tied"), F.count_distinct(F.when(top, F.col("motif"))).alias("tied_sequences"), F.count_if(F.col("residue_matches") >= 0.95 * F.col("best")).alias("near")
    )
    status = (
        F.when(F.col("targets") == 1, "SOLE_TARGET").when(F.col("sequences") == 1, "SHARED_SEQUENCE").when(F.col("tied_sequences") > 1, "TIED_DISTINCT_SEQUENCES").when(F.col("tied") > 1, "TIED_SAME_SEQUENCE").when(F.col("near") > 1, "NEAR_BEST_COMPETITOR").otherwise("UNIQUE_BEST")
    )
    return found.select("query_name", status.alias("status"), "targets", "sequences")


@query(
    "local_anchor_competition", "paf_rows",
    """WITH k AS (SELECT query_name, ordinal, query_start // 5 AS anchor, residue_matches, rank() OVER (PARTITION BY query_name, query_start // 5 ORDER BY residue_matches DESC) AS r, count(*) OVER (PARTITION BY query_name, query_start // 5) AS n FROM paf_rows),
      t AS (SELECT query_name, anchor, count(*) FILTER (r = 1) AS best FROM k GROUP BY ALL) SELECT k.query_name, k.ordinal, r::INT AS local_rank, CASE WHEN n = 1 THEN 'SOLE_AT_ANCHOR' WHEN r = 1 AND best = 1 THEN 'LOCAL_BEST' WHEN r = 1 THEN 'LOCAL_TIE' ELSE 'LOCAL_LOSER' END AS status FROM k JOIN t USING (query_name, anchor)""",
)
def _(paf):
    """Only targets at one anchor compete with each other."""
    rows = paf.withColumn("anchor", F.floor(F.col("query_start") / 5))
    per = Window.partitionBy("query_name", "anchor")
    rows = rows.withColumns({"local_rank": F.rank().over(per.orderBy(F.desc("residue_matches"))), "n": F.count("*").over(per), "most": F.max("residue_matches").over(per)})
    rows = rows.withColumn("ties", F.sum((F.col("residue_matches") == F.col("most")).cast("int")).over(per))
    first = F.col("local_rank") == 1
    status = F.when(F.col("n") == 1, "SOLE_AT_ANCHOR").when(first & (F.col("ties") == 1), "LOCAL_BEST").when(first, "LOCAL_TIE").otherwise("LOCAL_LOSER")
    return rows.select("query_name", "ordinal", "local_rank", status.alias("status"))


@query(
    "block_quality", "paf_rows",
    """WITH q AS (SELECT query_name, ordinal, query_end - query_start AS qs, target_end - target_start AS rs, residue_matches AS m FROM paf_rows WHERE target_end > target_start)
      SELECT query_name, ordinal, round(m::DOUBLE / qs, 6) AS query_match_fraction, round(least(qs, rs)::DOUBLE / greatest(qs, rs), 6) AS span_balance,
        concat_ws(';', CASE WHEN qs < 60 THEN 'QUERY_SPAN_TOO_SHORT' END, CASE WHEN rs < 60 THEN 'REFERENCE_SPAN_TOO_SHORT' END, CASE WHEN m < 50 THEN 'MATCHLIKE_BP_TOO_LOW' END, CASE WHEN m::DOUBLE / qs < 0.7 THEN 'QUERY_MATCH_FRACTION_TOO_LOW' END, CASE WHEN least(qs, rs)::DOUBLE / greatest(qs, rs) < 0.6 THEN 'QUERY_REFERENCE_SPAN_IMBALANCE' END) AS fail_reasons FROM q""",
)
def _(paf):
    """Reasons why a block is no good anchor; none for those that are."""
    q, r, m = F.col("query_end") - F.col("query_start"), F.col("target_end") - F.col("target_start"), F.col("residue_matches")
    match, balance = m / q, F.least(q, r) / F.greatest(q, r)
    checks = {"QUERY_SPAN_TOO_SHORT": q < 60, "REFERENCE_SPAN_TOO_SHORT": r < 60, "MATCHLIKE_BP_TOO_LOW": m < 50, "QUERY_MATCH_FRACTION_TOO_LOW": match < 0.7, "QUERY_REFERENCE_SPAN_IMBALANCE": balance < 0.6}
    reasons = F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()])), ";")
    return paf.filter(r > 0).select("query_name", "ordinal", F.round(match, 6).alias("query_match_fraction"), F.round(balance, 6).alias("span_balance"), reasons.alias("fail_reasons"))


@query(
    "cluster_rules", "segments",
    """WITH c AS (SELECT read_id, attempt_no, evidence_class, CASE WHEN mapq % 9 = 0 THEN 'X' || attempt_no ELSE 'C' || attempt_no END AS label, mapq % 11 = 0 AS phased, purity >= 0.9 AS used FROM segments)
      SELECT read_id, attempt_no, concat_ws(';', CASE WHEN NOT phased AND NOT regexp_full_match(label, 'C[1-9][0-9]*') THEN 'UNPHASED_LABEL' END, CASE WHEN used AND evidence_class <> 'SPAN' THEN 'CENSORED_FIT' END) AS broken FROM c
      WHERE (NOT phased AND NOT regexp_full_match(label, 'C[1-9][0-9]*')) OR (used AND evidence_class <> 'SPAN')""",
)
def _(segments):
    """Cluster memberships whose label or fit contradicts their phase or kind of size."""
    label = F.concat(F.when(F.col("mapq") % 9 == 0, "X").otherwise("C"), "attempt_no")
    rows = segments.select("read_id", "attempt_no", "evidence_class", label.alias("label"), (F.col("mapq") % 11 == 0).alias("phased"), (F.col("purity") >= 0.9).alias("used"))
    checks = {"UNPHASED_LABEL": ~F.col("phased") & ~F.regexp_like("label", F.lit("^C[1-9][0-9]*$")), "CENSORED_FIT": F.col("used") & (F.col("evidence_class") != "SPAN")}
    broken = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]))
    return rows.withColumn("b", broken).filter(F.size("b") > 0).select("read_id", "attempt_no", F.array_join("b", ";").alias("broken"))


@query(
    "region_master", "targets",
    """WITH r AS (SELECT target_region_id, chrom, start_pos - 2 * (CAST(substr(target_region_id, 2) AS INT) % 3) AS s, end_pos + CAST(substr(target_region_id, 2) AS INT) % 3 - 1 AS e, start_pos, end_pos, motif FROM targets)
      SELECT substr(chrom, 4) || '-' || s || '-' || e || '-TR' AS analysis_region_id, motif, CASE WHEN s = start_pos AND e = end_pos THEN 'EQUALS' WHEN s <= start_pos AND e >= end_pos THEN 'CONTAINS' ELSE 'OUTSIDE' END AS relation FROM r""",
)
def _(targets):
    """Regions with their id and how they lie to their representative locus, from attribute text."""
    k = F.substring("target_region_id", 2, 20).cast("int") % 3
    text = F.concat(F.lit("ID="), F.concat_ws("-", F.substring("chrom", 4, 20), "start_pos", "end_pos", "motif"), F.lit(";MOTIFS="), F.col("motif"), F.lit(";TYPE=TR"))
    rows = targets.select("chrom", (F.col("start_pos") - 2 * k).alias("s"), (F.col("end_pos") + k - 1).alias("e"), text.alias("attributes"))
    part = lambda i: F.regexp_extract("attributes", "^ID=([^;]*);MOTIFS=([^;]*);TYPE=(.*)$", i)
    locus = F.split(part(1), "-")
    l0, l1 = F.get(locus, F.lit(1)).cast("long"), F.get(locus, F.lit(2)).cast("long")
    relation = F.when((F.col("s") == l0) & (F.col("e") == l1), "EQUALS").when((F.col("s") <= l0) & (F.col("e") >= l1), "CONTAINS").otherwise("OUTSIDE")
    return rows.select(F.concat_ws("-", F.substring("chrom", 4, 20), "s", "e", part(3)).alias("analysis_region_id"), part(2).alias("motif"), relation.alias("relation"))
