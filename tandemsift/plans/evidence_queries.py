"""Queries of the event model, evidence tables, summaries and rescue decisions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.sequences import overlap
from ..operators import assignment as asg
from ..operators import intervals as iv
from ..operators import dossier, rescue
from .common import register

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)
RANK = "CASE evidence_class WHEN 'SPAN' THEN 3 WHEN 'UNRESOLVED' THEN 1 ELSE 2 END"
ORDER = f"{RANK} DESC, seg_end - seg_start DESC, purity DESC, mapq DESC, attempt_no, target_region_id"
ISLAND = """i AS (SELECT *, max(seg_end) OVER (PARTITION BY read_id ORDER BY seg_start, seg_end, attempt_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM segments),
      e AS (SELECT * EXCLUDE (seen), sum((seen IS NOT NULL AND seg_start >= seen)::INT) OVER (PARTITION BY read_id ORDER BY seg_start, seg_end, attempt_no ROWS UNBOUNDED PRECEDING)::BIGINT AS event_index FROM i)"""


def attempt_order():
    rank = F.when(F.col("evidence_class") == "SPAN", 3).when(F.col("evidence_class") == "UNRESOLVED", 1).otherwise(2)
    return [F.desc(rank), F.desc(F.col("seg_end") - F.col("seg_start")), F.desc("purity"), F.desc("mapq"), F.asc("attempt_no"), F.asc("target_region_id")]


def events_of(segments):
    """Segments with the number of their event, a group of overlapping segments of a read."""
    return iv.islands(segments, ["read_id"], "seg_start", "seg_end", touching=False, ties=["attempt_no"], name="event_index")


@query("attempt_rank", "segments", f"SELECT read_id, attempt_no, row_number() OVER (PARTITION BY read_id ORDER BY {ORDER})::INT AS attempt_rank FROM segments")
def _(segments):
    return segments.select("read_id", "attempt_no", F.row_number().over(Window.partitionBy("read_id").orderBy(*attempt_order())).alias("attempt_rank"))


@query("group_overlapping_calls", "segments", f"WITH {ISLAND} SELECT read_id, attempt_no, event_index FROM e")
def _(segments):
    return events_of(segments).select("read_id", "attempt_no", "event_index")


@query(
    "event_primary", "segments",
    f"WITH {ISLAND} SELECT read_id, event_index, attempt_no AS primary_attempt, evidence_class FROM e QUALIFY row_number() OVER (PARTITION BY read_id, event_index ORDER BY {ORDER}) = 1",
)
def _(segments):
    return iv.top_row(events_of(segments), ["read_id", "event_index"], attempt_order()).select("read_id", "event_index", F.col("attempt_no").alias("primary_attempt"), "evidence_class")


@query(
    "repeat_segments", "segments",
    """SELECT read_id, row_number() OVER (PARTITION BY read_id ORDER BY seg_start, seg_end, attempt_no)::INT - 1 AS segment_index, seg_start + 100 AS read_start, seg_end + 100 AS read_end, canonical_motif,
      CASE WHEN row_number() OVER (PARTITION BY read_id ORDER BY seg_end - seg_start DESC, seg_start, attempt_no) = 1 THEN 'PRIMARY' ELSE 'COMPONENT' END AS role FROM segments""",
)
def _(segments):
    """Segments exploded from each read's JSON list, in read coordinates, the longest primary."""
    packed = segments.groupBy("read_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("seg_start", "seg_end", "attempt_no", "canonical_motif")))).alias("json"))
    parsed = F.from_json("json", "array<struct<seg_start:long,seg_end:long,attempt_no:int,canonical_motif:string>>")
    rows = packed.select("read_id", F.posexplode(parsed).alias("segment_index", "x")).select("read_id", "segment_index", "x.*")
    longest = Window.partitionBy("read_id").orderBy(F.desc(F.col("seg_end") - F.col("seg_start")), "seg_start", "attempt_no")
    role = F.when(F.row_number().over(longest) == 1, "PRIMARY").otherwise("COMPONENT")
    return rows.select("read_id", "segment_index", (F.col("seg_start") + 100).alias("read_start"), (F.col("seg_end") + 100).alias("read_end"), "canonical_motif", role.alias("role"))


@query(
    "repeat_interruptions", "segments",
    """WITH o AS (SELECT read_id, attempt_no, seg_end, canonical_motif, lead(seg_start) OVER w AS next_start, lead(canonical_motif) OVER w AS next_motif FROM segments WINDOW w AS (PARTITION BY read_id ORDER BY seg_start, seg_end, attempt_no))
      SELECT read_id, attempt_no, seg_end AS gap_start, next_start AS gap_end, next_start - seg_end AS gap_bp, CASE WHEN canonical_motif <> next_motif THEN 'MOTIF_SWITCH' ELSE 'OTHER' END AS kind FROM o WHERE next_start > seg_end""",
)
def _(segments):
    w = Window.partitionBy("read_id").orderBy("seg_start", "seg_end", "attempt_no")
    rows = segments.withColumns({"next_start": F.lead("seg_start").over(w), "next_motif": F.lead("canonical_motif").over(w)}).filter("next_start > seg_end")
    kind = F.when(F.col("canonical_motif") != F.col("next_motif"), "MOTIF_SWITCH").otherwise("OTHER")
    return rows.select("read_id", "attempt_no", F.col("seg_end").alias("gap_start"), F.col("next_start").alias("gap_end"), (F.col("next_start") - F.col("seg_end")).alias("gap_bp"), kind.alias("kind"))


@query(
    "repeat_events", "segments",
    f"""WITH {ISLAND} SELECT read_id, event_index, min(seg_start) AS event_start, max(seg_end) AS event_end, count(*) AS segments, count(DISTINCT canonical_motif) AS motifs, round(min(purity), 6) AS worst_purity,
        CASE WHEN bool_or(evidence_class = 'SPAN') THEN 'EXACT_SPAN' WHEN bool_or(evidence_class = 'LEFT_ANCHORED_CENSORED_RIGHT') THEN 'LOWER_BOUND' ELSE 'NO_CALL' END AS sizing,
        CASE WHEN bool_or(evidence_class = 'SPAN') THEN max(CASE WHEN evidence_class = 'SPAN' THEN seg_end - seg_start END) END AS exact_bp FROM e GROUP BY read_id, event_index""",
)
def _(segments):
    """One row for each event. Exact sizes come from spanning segments alone."""
    span = F.col("evidence_class") == "SPAN"
    sizing = F.when(F.bool_or(span), "EXACT_SPAN").when(F.bool_or(F.col("evidence_class") == "LEFT_ANCHORED_CENSORED_RIGHT"), "LOWER_BOUND").otherwise("NO_CALL")
    return events_of(segments).groupBy("read_id", "event_index").agg(
        F.min("seg_start").alias("event_start"), F.max("seg_end").alias("event_end"), F.count("*").alias("segments"), F.count_distinct("canonical_motif").alias("motifs"), F.round(F.min("purity"), 6).alias("worst_purity"),
        sizing.alias("sizing"), F.max(F.when(span, F.col("seg_end") - F.col("seg_start"))).alias("exact_bp"),
    )


@query(
    "general_repeat_calls", "segments",
    f"""WITH {ISLAND}, b AS (SELECT read_id, event_index, attempt_no AS primary_attempt FROM e QUALIFY row_number() OVER (PARTITION BY read_id, event_index ORDER BY {ORDER}) = 1)
      SELECT e.read_id, e.attempt_no, e.target_region_id, e.event_index, b.primary_attempt, CASE WHEN e.attempt_no = b.primary_attempt THEN 'PRIMARY_EVENT_CALL' ELSE 'SUPPORTING_CALL' END AS status FROM e JOIN b USING (read_id, event_index)""",
)
def _(segments):
    """Every attempt, with its event and what it is there; none is dropped."""
    calls = events_of(segments)
    best = iv.top_row(calls, ["read_id", "event_index"], attempt_order()).select("read_id", "event_index", F.col("attempt_no").alias("primary_attempt"))
    status = F.when(F.col("attempt_no") == F.col("primary_attempt"), "PRIMARY_EVENT_CALL").otherwise("SUPPORTING_CALL")
    return calls.join(best, ["read_id", "event_index"]).select("read_id", "attempt_no", "target_region_id", "event_index", "primary_attempt", status.alias("status"))


@query(
    "read_evidence", "segments",
    f"""WITH {ISLAND}, n AS (SELECT read_id, target_region_id, count(*) AS attempts, count(*) FILTER (evidence_class <> 'UNRESOLVED') AS called, count(DISTINCT event_index) AS events FROM e GROUP BY ALL),
      b AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY read_id, target_region_id ORDER BY {ORDER}) = 1)
      SELECT n.*, b.attempt_no AS best_attempt, b.event_index AS best_event, b.evidence_class, CASE b.evidence_class WHEN 'SPAN' THEN 'exact' WHEN 'UNRESOLVED' THEN 'no_call' ELSE 'lower_bound' END AS sizing_status,
        CASE WHEN b.evidence_class = 'SPAN' THEN b.seg_end - b.seg_start END AS estimate_bp, CASE WHEN b.evidence_class = 'LEFT_ANCHORED_CENSORED_RIGHT' THEN b.seg_end - b.seg_start END AS lower_bound_bp,
        CASE WHEN b.evidence_class = 'UNRESOLVED' THEN 'GENERAL_CALLER_LOW_CONFIDENCE' ELSE 'NONE' END AS failure_code, CASE WHEN b.mapq < 10 THEN 'LOW' WHEN b.purity >= 0.9 AND b.evidence_class = 'SPAN' THEN 'HIGH' ELSE 'MEDIUM' END AS confidence
      FROM n JOIN b USING (read_id, target_region_id)""",
)
def _(segments):
    """One row for each read and target: the best attempt, counts, size by kind, failure and confidence."""
    calls, key = events_of(segments), ["read_id", "target_region_id"]
    called = F.col("evidence_class") != "UNRESOLVED"
    counts = calls.groupBy(*key).agg(F.count("*").alias("attempts"), F.count_if(called).alias("called"), F.count_distinct("event_index").alias("events"))
    best, kind, size = iv.top_row(calls, key, attempt_order()), F.col("evidence_class"), F.col("seg_end") - F.col("seg_start")
    return counts.join(best, key).select(
        *counts.columns, F.col("attempt_no").alias("best_attempt"), F.col("event_index").alias("best_event"), kind,
        F.when(kind == "SPAN", "exact").when(kind == "UNRESOLVED", "no_call").otherwise("lower_bound").alias("sizing_status"),
        F.when(kind == "SPAN", size).alias("estimate_bp"), F.when(kind == "LEFT_ANCHORED_CENSORED_RIGHT", size).alias("lower_bound_bp"),
        F.when(kind == "UNRESOLVED", "GENERAL_CALLER_LOW_CONFIDENCE").otherwise("NONE").alias("failure_code"),
        F.when(F.col("mapq") < 10, "LOW").when((F.col("purity") >= 0.9) & (kind == "SPAN"), "HIGH").otherwise("MEDIUM").alias("confidence"),
    )


@query(
    "equivalence_groups", "segments",
    """SELECT read_id, seg_start, seg_end, canonical_motif, count(*) AS rows, count(*) FILTER (cohort = 'P1') AS p1_rows, count(DISTINCT target_region_id) AS targets, round(min(purity), 6) AS purity_min, round(max(purity), 6) AS purity_max,
      CASE WHEN bool_or(cohort = 'P1') AND bool_or(cohort = 'P2') THEN 'P1_P2_SHARED_SEQUENCE_EVIDENCE' WHEN bool_or(cohort = 'P1') THEN 'P1_ONLY_SEQUENCE_EVIDENCE' ELSE 'P2_ONLY_SEQUENCE_EVIDENCE' END AS group_class FROM segments GROUP BY ALL""",
)
def _(segments):
    p1, p2 = F.bool_or(F.col("cohort") == "P1"), F.bool_or(F.col("cohort") == "P2")
    kind = F.when(p1 & p2, "P1_P2_SHARED_SEQUENCE_EVIDENCE").when(p1, "P1_ONLY_SEQUENCE_EVIDENCE").otherwise("P2_ONLY_SEQUENCE_EVIDENCE")
    return segments.groupBy("read_id", "seg_start", "seg_end", "canonical_motif").agg(
        F.count("*").alias("rows"), F.count_if(F.col("cohort") == "P1").alias("p1_rows"), F.count_distinct("target_region_id").alias("targets"), F.round(F.min("purity"), 6).alias("purity_min"), F.round(F.max("purity"), 6).alias("purity_max"), kind.alias("group_class")
    )


@query("competing_motifs", "segments", "SELECT read_id, seg_start, count(DISTINCT canonical_motif) AS motifs, count(*) AS rows FROM segments GROUP BY ALL HAVING count(DISTINCT canonical_motif) > 1")
def _(segments):
    return segments.groupBy("read_id", "seg_start").agg(F.count_distinct("canonical_motif").alias("motifs"), F.count("*").alias("rows")).filter("motifs > 1")


@query(
    "read_competition", "segments",
    """WITH a AS (SELECT *, EXISTS (SELECT 1 FROM segments p WHERE p.cohort = 'P1' AND p.read_id = s.read_id AND p.seg_start = s.seg_start AND p.canonical_motif = s.canonical_motif) AS redundant FROM segments s WHERE cohort = 'P2')
      SELECT read_id, count(*) AS alternates, count(*) FILTER (redundant) AS redundant, CASE WHEN bool_and(redundant) THEN 'REDUNDANT_ONLY' WHEN bool_or(redundant) THEN 'MIXED' ELSE 'NON_REDUNDANT_ONLY' END AS class FROM a GROUP BY read_id""",
)
def _(segments):
    """Alternates of each read that repeat a primary's start and motif, and that don't."""
    key = ["read_id", "seg_start", "canonical_motif"]
    primary = segments.filter("cohort = 'P1'").select(*key).distinct().withColumn("hit", F.lit(True))
    alternates = segments.filter("cohort = 'P2'").join(primary, key, "left").withColumn("redundant", F.coalesce("hit", F.lit(False)))
    kind = F.when(F.bool_and("redundant"), "REDUNDANT_ONLY").when(F.bool_or("redundant"), "MIXED").otherwise("NON_REDUNDANT_ONLY")
    return alternates.groupBy("read_id").agg(F.count("*").alias("alternates"), F.count_if("redundant").alias("redundant"), kind.alias("class"))


@query(
    "best_overlap_relationship", "segments",
    """WITH p AS (SELECT a.read_id, a.attempt_no, a.canonical_motif AS m2, a.seg_start AS s2, a.seg_end AS e2, b.attempt_no AS other, b.canonical_motif AS m1, b.seg_start AS s1, b.seg_end AS e1, greatest(0, least(a.seg_end, b.seg_end) - greatest(a.seg_start, b.seg_start)) AS ov
        FROM segments a LEFT JOIN segments b ON a.read_id = b.read_id AND b.cohort = 'P1' WHERE a.cohort = 'P2'),
      b AS (SELECT *, least(ov::DOUBLE / (e2 - s2), ov::DOUBLE / (e1 - s1)) AS f FROM p QUALIFY row_number() OVER (PARTITION BY read_id, attempt_no ORDER BY ov > 0 DESC NULLS LAST, least(ov::DOUBLE / (e2 - s2), ov::DOUBLE / (e1 - s1)) DESC, ov DESC, m1 = m2 DESC, other) = 1)
      SELECT read_id, attempt_no, other, CASE WHEN other IS NULL THEN 'NO_P1_SPAN_ON_READ' WHEN s1 = s2 AND e1 = e2 AND m1 = m2 THEN 'EXACT_SAME_INTERVAL_SAME_MOTIF' WHEN s1 = s2 AND e1 = e2 THEN 'EXACT_SAME_INTERVAL_DIFFERENT_MOTIF'
        WHEN ov > 0 AND f >= 0.8 AND m1 = m2 THEN 'HIGH_OVERLAP_SAME_MOTIF' WHEN ov > 0 AND f >= 0.8 THEN 'HIGH_OVERLAP_DIFFERENT_MOTIF' WHEN ov > 0 THEN 'PARTIAL_OVERLAP' ELSE 'DISJOINT' END AS relationship FROM b""",
)
def _(segments):
    """For each alternate the primary span that it overlaps best, and how they relate."""
    side = lambda n: [F.col(c).alias(f"{c}{n}") for c in ("attempt_no", "canonical_motif", "seg_start", "seg_end")]
    left, right = segments.filter("cohort = 'P2'").select("read_id", *side(2)), segments.filter("cohort = 'P1'").select("read_id", *side(1))
    s1, e1, s2, e2 = (F.col(c) for c in ("seg_start1", "seg_end1", "seg_start2", "seg_end2"))
    pairs = left.join(right, "read_id", "left").withColumn("ov", overlap(s1, e1, s2, e2)).withColumn("same", F.col("canonical_motif1") == F.col("canonical_motif2"))
    pairs = pairs.withColumn("f", F.least(F.col("ov") / (e2 - s2), F.col("ov") / (e1 - s1)))
    order = [F.desc_nulls_last((F.col("ov") > 0).cast("int")), F.desc("f"), F.desc("ov"), F.desc(F.col("same").cast("int")), F.asc("attempt_no1")]
    best = iv.top_row(pairs, ["read_id", "attempt_no2"], order)
    equal, near = (s1 == s2) & (e1 == e2), (F.col("ov") > 0) & (F.col("f") >= 0.8)
    kind = (
        F.when(F.col("attempt_no1").isNull(), "NO_P1_SPAN_ON_READ").when(equal & F.col("same"), "EXACT_SAME_INTERVAL_SAME_MOTIF").when(equal, "EXACT_SAME_INTERVAL_DIFFERENT_MOTIF").when(near & F.col("same"), "HIGH_OVERLAP_SAME_MOTIF")
        .when(near, "HIGH_OVERLAP_DIFFERENT_MOTIF").when(F.col("ov") > 0, "PARTIAL_OVERLAP").otherwise("DISJOINT")
    )
    return best.select("read_id", F.col("attempt_no2").alias("attempt_no"), F.col("attempt_no1").alias("other"), kind.alias("relationship"))


@query(
    "read_event_intervals", "segments",
    f"WITH {ISLAND} SELECT read_id, event_index, min(seg_start) AS event_start, max(seg_end) AS event_end, string_agg(DISTINCT cohort, ';' ORDER BY cohort) AS cohorts, string_agg(DISTINCT canonical_motif, ';' ORDER BY canonical_motif) AS motifs FROM e GROUP BY read_id, event_index",
)
def _(segments):
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ";")
    return events_of(segments).groupBy("read_id", "event_index").agg(F.min("seg_start").alias("event_start"), F.max("seg_end").alias("event_end"), names("cohort").alias("cohorts"), names("canonical_motif").alias("motifs"))


@query(
    "exact_event_model", "segments",
    f"""WITH {ISLAND}, h AS (SELECT read_id, event_index, canonical_motif, count(*) AS n, max(purity) AS purity FROM e GROUP BY ALL)
      SELECT read_id, event_index, count(*) AS hypotheses, sum(n)::BIGINT AS members, first(canonical_motif ORDER BY n DESC, purity DESC, canonical_motif) AS representative, CASE WHEN count(*) = 1 THEN 'SINGLE_MOTIF_EVENT' ELSE 'COMPETING_MOTIF_EVENT' END AS event_class FROM h GROUP BY read_id, event_index""",
)
def _(segments):
    """Events, their motif hypotheses and members, with the hypothesis that represents each."""
    hypotheses = events_of(segments).groupBy("read_id", "event_index", "canonical_motif").agg(F.count("*").alias("n"), F.max("purity").alias("purity"))
    best = F.min_by("canonical_motif", F.struct(-F.col("n"), -F.col("purity"), "canonical_motif"))
    kind = F.when(F.count("*") == 1, "SINGLE_MOTIF_EVENT").otherwise("COMPETING_MOTIF_EVENT")
    return hypotheses.groupBy("read_id", "event_index").agg(F.count("*").alias("hypotheses"), F.sum("n").alias("members"), best.alias("representative"), kind.alias("event_class"))


@query(
    "top_nonexact_tracts", "segments",
    "SELECT read_id, attempt_no, seg_end - seg_start AS tract_bp, purity, mapq FROM segments WHERE evidence_class <> 'SPAN' AND cohort = 'P2' ORDER BY tract_bp DESC, purity DESC, mapq DESC, read_id, attempt_no LIMIT 500",
)
def _(segments):
    rows = segments.filter("evidence_class <> 'SPAN' AND cohort = 'P2'").select("read_id", "attempt_no", (F.col("seg_end") - F.col("seg_start")).alias("tract_bp"), "purity", "mapq")
    return rows.orderBy(F.desc("tract_bp"), F.desc("purity"), F.desc("mapq"), "read_id", "attempt_no").limit(500)


SIZE = "(seg_end - seg_start)"


@query(
    "locus_repeat_distribution", "segments",
    f"""SELECT target_region_id, count(*) AS events, count(*) FILTER (evidence_class = 'SPAN') AS exact, count(*) FILTER (evidence_class = 'LEFT_ANCHORED_CENSORED_RIGHT') AS right_censored, count(*) FILTER (evidence_class = 'UNRESOLVED') AS low_confidence,
      min(CASE WHEN evidence_class = 'SPAN' THEN {SIZE} END) AS exact_min, round(quantile_cont(CASE WHEN evidence_class = 'SPAN' THEN {SIZE} END, 0.5), 6) AS exact_median, round(quantile_cont(CASE WHEN evidence_class = 'SPAN' THEN {SIZE} END, 0.95), 6) AS exact_p95, max(CASE WHEN evidence_class = 'SPAN' THEN {SIZE} END) AS exact_max FROM segments GROUP BY target_region_id""",
)
def _(segments):
    """Counts by kind of size; lengths of exact events alone."""
    exact = F.when(F.col("evidence_class") == "SPAN", F.col("seg_end") - F.col("seg_start"))
    of = lambda k: F.count_if(F.col("evidence_class") == k)
    return segments.groupBy("target_region_id").agg(
        F.count("*").alias("events"), of("SPAN").alias("exact"), of("LEFT_ANCHORED_CENSORED_RIGHT").alias("right_censored"), of("UNRESOLVED").alias("low_confidence"),
        F.min(exact).alias("exact_min"), F.round(F.percentile(exact, F.lit(0.5)), 6).alias("exact_median"), F.round(F.percentile(exact, F.lit(0.95)), 6).alias("exact_p95"), F.max(exact).alias("exact_max"),
    )


@query(
    "locus_summary", "segments",
    f"""SELECT target_region_id, count(DISTINCT read_id) AS reads, count(DISTINCT CASE WHEN evidence_class = 'SPAN' THEN read_id END) AS span_reads, max(CASE WHEN evidence_class = 'SPAN' THEN {SIZE} END) AS max_exact_bp, max(CASE WHEN evidence_class = 'LEFT_ANCHORED_CENSORED_RIGHT' THEN {SIZE} END) AS max_lower_bound_bp,
      round(max(purity), 6) AS max_purity, min(mapq) AS min_mapq, CASE WHEN bool_or(evidence_class = 'SPAN' AND mapq >= 30) THEN 'HIGH' WHEN bool_or(evidence_class = 'SPAN') THEN 'MEDIUM' ELSE 'LOW' END AS best_confidence FROM segments GROUP BY target_region_id""",
)
def _(segments):
    span, size = F.col("evidence_class") == "SPAN", F.col("seg_end") - F.col("seg_start")
    best = F.when(F.bool_or(span & (F.col("mapq") >= 30)), "HIGH").when(F.bool_or(span), "MEDIUM").otherwise("LOW")
    return segments.groupBy("target_region_id").agg(
        F.count_distinct("read_id").alias("reads"), F.count_distinct(F.when(span, F.col("read_id"))).alias("span_reads"), F.max(F.when(span, size)).alias("max_exact_bp"),
        F.max(F.when(F.col("evidence_class") == "LEFT_ANCHORED_CENSORED_RIGHT", size)).alias("max_lower_bound_bp"), F.round(F.max("purity"), 6).alias("max_purity"), F.min("mapq").alias("min_mapq"), best.alias("best_confidence"),
    )


@query(
    "region_summary", "blocks targets",
    """SELECT target_region_id, target_source, count(*) AS candidates, count(DISTINCT read_id) AS reads, count(*) FILTER (target_overlap_bp > 0) AS exact, first(read_id ORDER BY target_overlap_bp DESC, target_distance_bp, read_id, ordinal) AS best_read FROM candidates GROUP BY ALL""",
    oracle_views="candidates",
)
def _(blocks, targets):
    return asg.region_summary(blocks, targets)


@query(
    "length_cluster_membership", "segments",
    f"""WITH x AS (SELECT target_region_id, read_id, attempt_no, {SIZE} AS bp FROM segments WHERE evidence_class = 'SPAN'), l AS (SELECT *, bp - lag(bp) OVER w AS gap FROM x WINDOW w AS (PARTITION BY target_region_id ORDER BY bp, read_id, attempt_no))
      SELECT target_region_id, read_id, attempt_no, bp, 'C' || (1 + sum(coalesce(gap > 6, false)::INT) OVER (PARTITION BY target_region_id ORDER BY bp, read_id, attempt_no ROWS UNBOUNDED PRECEDING)) AS cluster FROM l""",
)
def _(segments):
    """Neutral length clusters of exact events, split at gaps of more than 6 bases; censored ones are never fitted."""
    rows = segments.filter("evidence_class = 'SPAN'").select("target_region_id", "read_id", "attempt_no", (F.col("seg_end") - F.col("seg_start")).alias("bp"))
    # equal lengths are of one cluster, so the windows go over a locus's distinct lengths, however deep it is
    w = Window.partitionBy("target_region_id").orderBy("bp")
    new = F.coalesce((F.col("bp") - F.lag("bp").over(w) > 6).cast("int"), F.lit(0))
    lengths = rows.select("target_region_id", "bp").distinct().withColumn("new", new)
    clusters = lengths.select("target_region_id", "bp", F.concat(F.lit("C"), 1 + F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))).alias("cluster"))
    return rows.join(clusters, ["target_region_id", "bp"]).select("target_region_id", "read_id", "attempt_no", "bp", "cluster")


@query(
    "molecule_groups", "blocks",
    """WITH c AS (SELECT read_id, ordinal, chrom, min(block_start) // 50 AS start_bin, max(block_end) // 50 AS end_bin, sha256(string_agg((block_end // 50)::VARCHAR, ',' ORDER BY block_index)) AS chain FROM blocks GROUP BY read_id, ordinal, chrom)
      SELECT chrom, start_bin, end_bin, chain, count(*) AS alignments, count(DISTINCT read_id) AS reads FROM c GROUP BY ALL""",
)
def _(blocks):
    """Alignments of one splice chain whose ends fall into the same bins."""
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_index", F.floor(F.col("block_end") / 50).alias("b")))), lambda x: x["b"].cast("string")), ",")
    chains = blocks.groupBy("read_id", "ordinal", "chrom").agg(F.floor(F.min("block_start") / 50).alias("start_bin"), F.floor(F.max("block_end") / 50).alias("end_bin"), F.sha2(ordered, 256).alias("chain"))
    return chains.groupBy("chrom", "start_bin", "end_bin", "chain").agg(F.count("*").alias("alignments"), F.count_distinct("read_id").alias("reads"))


@query(
    "sample_locus_summary", "segments",
    f"""SELECT cohort AS sample_id, target_region_id, count(*) FILTER (evidence_class = 'SPAN') AS exact, count(*) FILTER (evidence_class = 'LEFT_ANCHORED_CENSORED_RIGHT') AS lower_bound, count(*) FILTER (evidence_class = 'UNRESOLVED') AS limited,
      round(avg(CASE WHEN evidence_class = 'SPAN' THEN {SIZE} END), 6) AS exact_mean_bp FROM segments GROUP BY ALL""",
)
def _(segments):
    of = lambda k: F.count_if(F.col("evidence_class") == k)
    exact = F.when(F.col("evidence_class") == "SPAN", F.col("seg_end") - F.col("seg_start"))
    return segments.groupBy(F.col("cohort").alias("sample_id"), "target_region_id").agg(of("SPAN").alias("exact"), of("LEFT_ANCHORED_CENSORED_RIGHT").alias("lower_bound"), of("UNRESOLVED").alias("limited"), F.round(F.avg(exact), 6).alias("exact_mean_bp"))


@query(
    "ranking_lanes", "segments targets",
    f"""WITH l AS (SELECT t.target_source AS lane, s.target_region_id, max({SIZE}) AS longest, count(*) AS n FROM segments s JOIN targets t ON s.target_region_id = t.target_region_id WHERE t.target_source = 'DISEASE' OR s.evidence_class = 'SPAN' GROUP BY ALL)
      SELECT *, rank() OVER (PARTITION BY lane ORDER BY longest DESC, n DESC)::INT AS lane_rank FROM l""",
)
def _(segments, targets):
    """Separate ranks by lane; the lane of known disease loci is never filtered."""
    rows = segments.join(targets.select("target_region_id", F.col("target_source").alias("lane")), "target_region_id").filter("lane = 'DISEASE' OR evidence_class = 'SPAN'")
    loci = rows.groupBy("lane", "target_region_id").agg(F.max(F.col("seg_end") - F.col("seg_start")).alias("longest"), F.count("*").alias("n"))
    return iv.ranked_by_histogram(loci, ["lane"], [("longest", -1), ("n", -1)], "lane_rank", tile=8).select("lane", "target_region_id", "longest", "n", "lane_rank")


@query(
    "candidate_dossier", "segments",
    """SELECT cohort AS sample_id, target_region_id, count(*) AS calls, string_agg(read_id || ':' || attempt_no, ',' ORDER BY read_id, attempt_no) AS sources FROM segments WHERE evidence_class = 'SPAN' GROUP BY ALL""",
)
def _(segments):
    """Documents of 100 calls for each sample and locus, read back from their JSON and put together again."""
    spans = segments.filter("evidence_class = 'SPAN'").withColumnRenamed("cohort", "sample_id")
    docs = dossier.candidate_dossier(spans, ["sample_id", "target_region_id"], ["read_id", "attempt_no"], page=100)
    d = docs.withColumn("d", F.from_json("dossier", "struct<calls:long,sources:array<struct<read_id:long,attempt_no:int>>>"))
    page = F.struct("page", F.array_join(F.transform("d.sources", lambda x: F.concat_ws(":", x["read_id"], x["attempt_no"])), ",").alias("text"))
    pages = d.groupBy("sample_id", "target_region_id").agg(F.sum("d.calls").alias("calls"), F.array_sort(F.collect_list(page)).alias("pages"))
    return pages.select("sample_id", "target_region_id", "calls", F.array_join("pages.text", ",").alias("sources"))


PAF = "WITH p AS (SELECT *, residue_matches / alignment_block_length::DOUBLE AS identity, (query_end - query_start) / query_length::DOUBLE AS coverage FROM paf_rows)"


@query(
    "bridge_decision", "paf_rows",
    PAF + """ SELECT query_name, ordinal, CASE WHEN mapq = 0 THEN 'NO_CANDIDATE_ALIGNMENT' WHEN strand = '-' THEN 'ORIENTATION_INCONSISTENT_BRIDGE' WHEN query_start > 10 OR target_start > 10 THEN 'ALIGNMENT_NOT_CONNECTED_TO_BLOCK_BOUNDARY'
      WHEN identity < 0.7 OR coverage < 0.7 THEN 'LOW_QUALITY_BRIDGE_ALIGNMENT' WHEN target_end < 112 THEN 'BRIDGE_STOPS_BEFORE_TARGET_ENTRY' ELSE 'BRIDGE_REACHES_TARGET_ENTRY' END AS bridge_status FROM p""",
)
def _(paf):
    return rescue.bridge_decision(paf, entry=100).select("query_name", "ordinal", "bridge_status")


@query(
    "pair_selection", "paf_rows",
    PAF + """, d AS (SELECT *, CASE WHEN mapq = 0 THEN 0 WHEN strand = '-' THEN 1 WHEN query_start > 10 OR target_start > 10 THEN 2 WHEN identity < 0.7 OR coverage < 0.7 THEN 3 WHEN target_end < 112 THEN 4 ELSE 5 END AS priority FROM p)
      SELECT query_name, target_name, ordinal, priority FROM d QUALIFY row_number() OVER (PARTITION BY query_name ORDER BY priority DESC, residue_matches DESC, coverage DESC, identity DESC, mapq DESC, ordinal) = 1""",
)
def _(paf):
    return rescue.best_pair(rescue.bridge_decision(paf, entry=100)).select("query_name", "target_name", "ordinal", "priority")


@query(
    "clip_evidence_decision", "paf_rows",
    """WITH r AS (SELECT query_name, ordinal, strand, mapq >= 5 AS projected, ordinal % 5 = 0 AS homopolymer, target_start * 3 AS tract_bp, query_end >= 100 AS reaches_end, ordinal % 2 = 0 AS to_right FROM paf_rows),
      s AS (SELECT *, CASE WHEN strand = '-' THEN 'REJECT_ORIENTATION_INCONSISTENT_BRIDGE' WHEN NOT projected THEN 'REJECT_TARGET_ENTRY_NOT_PROJECTED' WHEN homopolymer THEN 'HOMOPOLYMER_REVIEW_NO_STANDARD_P3_EVIDENCE' WHEN tract_bp = 0 THEN 'ORIENTATION_VALID_BRIDGE_ONLY_NO_REPEAT_TRACT' WHEN reaches_end THEN 'P3_CENSORED_LOWER_BOUND' ELSE 'P3_PARTIAL_INTERNAL' END AS primary_status FROM r)
      SELECT query_name, ordinal, primary_status, CASE primary_status WHEN 'P3_CENSORED_LOWER_BOUND' THEN CASE WHEN to_right THEN 'LEFT_ANCHORED_CENSORED_RIGHT' ELSE 'RIGHT_ANCHORED_CENSORED_LEFT' END WHEN 'P3_PARTIAL_INTERNAL' THEN CASE WHEN to_right THEN 'LEFT_ONLY_INTERNAL' ELSE 'RIGHT_ONLY_INTERNAL' END ELSE 'UNRESOLVED' END AS evidence_class,
        CASE primary_status WHEN 'P3_CENSORED_LOWER_BOUND' THEN 'lower_bound' WHEN 'P3_PARTIAL_INTERNAL' THEN 'partial_internal' ELSE 'no_call' END AS sizing_status, CASE WHEN primary_status = 'P3_CENSORED_LOWER_BOUND' THEN tract_bp END AS lower_bound_bp FROM s""",
)
def _(paf):
    rows = paf.select(
        "query_name", "ordinal", "strand", (F.col("mapq") >= 5).alias("projected"), F.when(F.col("ordinal") % 5 == 0, "A").otherwise("CAG").alias("motif"), (F.col("target_start") * 3).alias("tract_bp"),
        (F.col("query_end") >= 100).alias("reaches_end"), F.when(F.col("ordinal") % 2 == 0, "RIGHT").otherwise("LEFT").alias("side"),
    )
    return rescue.clip_evidence(rows).select("query_name", "ordinal", "primary_status", "evidence_class", "sizing_status", "lower_bound_bp")


@query(
    "near_best_placements", "paf_rows",
    """WITH m AS (SELECT *, max(residue_matches) OVER (PARTITION BY query_name) AS best FROM paf_rows), n AS (SELECT query_name, count(*) AS placements, count(*) FILTER (residue_matches >= 0.95 * best) AS near_best FROM m GROUP BY query_name)
      SELECT *, round(near_best::DOUBLE / placements, 6) AS near_best_fraction, CASE WHEN near_best = 1 THEN 'UNIQUE_BEST' ELSE 'MULTIPLE_NEAR_BEST' END AS status FROM n""",
)
def _(paf):
    best = paf.groupBy("query_name").agg(F.max("residue_matches").alias("best"))
    n = paf.join(best, "query_name").groupBy("query_name").agg(F.count("*").alias("placements"), F.count_if(F.col("residue_matches") >= 0.95 * F.col("best")).alias("near_best"))
    return n.withColumns({"near_best_fraction": F.round(F.col("near_best") / F.col("placements"), 6), "status": F.when(F.col("near_best") == 1, "UNIQUE_BEST").otherwise("MULTIPLE_NEAR_BEST")})


@query(
    "flank_side_check", "paf_rows",
    """WITH s AS (SELECT query_name, ordinal, strand, CASE WHEN target_end <= 70 THEN 'UPSTREAM' WHEN target_start >= 10 THEN 'DOWNSTREAM' ELSE 'OVERLAPS' END AS side FROM paf_rows)
      SELECT query_name, ordinal, side, side = CASE strand WHEN '+' THEN 'UPSTREAM' ELSE 'DOWNSTREAM' END AS as_expected FROM s""",
)
def _(paf):
    side = F.when(F.col("target_end") <= 70, "UPSTREAM").when(F.col("target_start") >= 10, "DOWNSTREAM").otherwise("OVERLAPS")
    return paf.select("query_name", "ordinal", side.alias("side"), (side == F.when(F.col("strand") == "+", "UPSTREAM").otherwise("DOWNSTREAM")).alias("as_expected"))
