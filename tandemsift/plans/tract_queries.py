"""Queries of tracts worked out from the reads themselves: labels, target entries, audits of exact spans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequences as s
from ..operators import assignment as asg
from ..operators import calling, rescue
from ..operators import intervals as iv
from ..operators.spread import spread
from .assignment_queries import BEST, wide
from .common import register
from .sequence_queries import COMP, ROT

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)
WAYS = f"list_distinct(list_concat({ROT.format('motif')}, {ROT.format('(' + COMP.format('motif') + ')')}))"


def motifs_of(segments, targets):
    """The motifs of each read's targets."""
    return segments.join(targets.select("target_region_id", "motif"), "target_region_id").select("read_id", "motif").distinct()


@query(
    "label_segments", "reads segments targets",
    f"""WITH m AS (SELECT DISTINCT read_id, seq, len(seq) AS n, motif FROM segments JOIN targets USING (target_region_id) JOIN reads USING (read_id)), w AS (SELECT *, unnest({WAYS}) AS way FROM m),
      h AS (SELECT read_id, n, motif, way, list_transform(range(n), lambda i: (substr(seq, i::INT + 1, 1) = substr(way, (i % len(motif))::INT + 1, 1))::INT) AS hits FROM w),
      x AS (SELECT *, unnest(range(n))::INT AS pos, greatest(9, 3 * len(motif)) AS width FROM h), y AS (SELECT *, least(n, greatest(0, pos - width // 2) + width) AS high FROM x), z AS (SELECT *, greatest(0, high - width) AS low FROM y),
      a AS (SELECT read_id, pos, motif, max(list_sum(hits[low + 1:high]))::DOUBLE / any_value(high - low) AS score FROM z WHERE high - low >= greatest(6, 2 * len(motif)) GROUP BY read_id, pos, motif),
      b AS (SELECT *, row_number() OVER (PARTITION BY read_id, pos ORDER BY score DESC, motif DESC) AS k, lead(score) OVER (PARTITION BY read_id, pos ORDER BY score DESC, motif DESC) AS next FROM a),
      l AS (SELECT read_id, pos, CASE WHEN score >= 0.72 AND (next IS NULL OR score - next >= 0.04) THEN motif END AS lab FROM b WHERE k = 1),
      l1 AS (SELECT *, coalesce(lab IS DISTINCT FROM lag(lab) OVER v, true) AS new FROM l WINDOW v AS (PARTITION BY read_id ORDER BY pos)), l2 AS (SELECT *, sum(new::INT) OVER (PARTITION BY read_id ORDER BY pos) AS g FROM l1),
      r1 AS (SELECT read_id, min(pos) AS st, max(pos) + 1 AS en, any_value(lab) AS lab FROM l2 GROUP BY read_id, g), d AS (SELECT read_id, st, en, CASE WHEN en - st >= greatest(6, 2 * len(lab)) THEN lab END AS lab FROM r1),
      d1 AS (SELECT *, lab IS DISTINCT FROM lag(lab) OVER v AS new FROM d WINDOW v AS (PARTITION BY read_id ORDER BY st)), d2 AS (SELECT *, sum(new::INT) OVER (PARTITION BY read_id ORDER BY st) AS g FROM d1),
      r2 AS (SELECT read_id, min(st) AS st, max(en) AS en, any_value(lab) AS lab FROM d2 GROUP BY read_id, g),
      f AS (SELECT read_id, st, en, CASE WHEN lab IS NULL AND en - st <= 2 AND lag(lab) OVER v = lead(lab) OVER v THEN lag(lab) OVER v ELSE lab END AS lab FROM r2 WINDOW v AS (PARTITION BY read_id ORDER BY st)),
      f1 AS (SELECT *, lab IS DISTINCT FROM lag(lab) OVER v AS new FROM f WINDOW v AS (PARTITION BY read_id ORDER BY st)), f2 AS (SELECT *, sum(new::INT) OVER (PARTITION BY read_id ORDER BY st) AS g FROM f1)
      SELECT read_id, any_value(lab) AS motif, min(st)::INT AS seg_start, max(en)::INT AS seg_end FROM f2 WHERE lab IS NOT NULL GROUP BY read_id, g""",
)
def _(reads, segments, targets):
    return calling.label_segments(reads, motifs_of(segments, targets))


#: Each read from base 20 on as the clip of an alignment that ends there, odd reads turned; the entry lies near its tract.
CLIPS = f"""c AS (SELECT read_id, motif, read_id % 2 = 1 AS turned, 20 AS raw_start, len(seq) AS raw_end, CASE WHEN read_id % 2 = 1 THEN {COMP.format('substr(seq, 21)')} ELSE substr(seq, 21) END AS clip,
        (CASE WHEN read_id % 2 = 1 THEN 32 ELSE 12 END + read_id % 7 - 3)::INT AS entry FROM reads JOIN orders ON read_id = o_orderkey, LATERAL (SELECT CASE o_custkey % 6 WHEN 0 THEN 'CAG' WHEN 1 THEN 'AAG' WHEN 2 THEN 'GCC' WHEN 3 THEN 'AT' WHEN 4 THEN 'A' ELSE 'CCTG' END AS motif))"""
TRACTS = f"""{CLIPS}, k AS (SELECT *, unnest({WAYS}) AS way, unnest(range(-5, 6))::INT AS d FROM (SELECT * FROM c)),
      sd AS (SELECT c.*, d.d AS d, w.way AS way FROM c, (SELECT unnest(range(-5, 6))::INT AS d) d, LATERAL (SELECT unnest({WAYS}) AS way) w WHERE entry + d.d BETWEEN 0 AND len(clip)),
      p AS (SELECT read_id, d, way, entry + d AS st, unnest(range(1, len(clip) - entry - d + 1))::INT AS bp, clip, len(way) AS u FROM sd),
      q AS (SELECT read_id, d, way, st, bp, sum((substr(clip, st + bp, 1) = substr(way, ((bp - 1) % u)::INT + 1, 1))::INT) OVER (PARTITION BY read_id, d, way ORDER BY bp) AS same FROM p),
      g AS (SELECT read_id, d, st, bp, max(same) AS same FROM q WHERE bp >= 12 AND same::DOUBLE / bp >= 0.7 GROUP BY ALL),
      t AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY bp DESC, same DESC, abs(d), st) = 1),
      e AS (SELECT c.*, t.st AS tract_start, t.st + t.bp AS tract_end, t.same::DOUBLE / t.bp AS purity, t.d AS entry_offset, len(clip) - t.st - t.bp <= 10 AS reaches_end FROM c LEFT JOIN t USING (read_id))"""
TRACTS = TRACTS.replace(f", k AS (SELECT *, unnest({WAYS}) AS way, unnest(range(-5, 6))::INT AS d FROM (SELECT * FROM c))", "")


def clips_of(reads, orders):
    motif = F.get(F.array(*[F.lit(m) for m in ("CAG", "AAG", "GCC", "AT", "A", "CCTG")]), (F.col("o_custkey") % 6).cast("int"))
    turned, clip = F.col("read_id") % 2 == 1, F.substring(F.col("seq"), F.lit(21), F.length("seq"))
    rows = spread(reads, "read_id").hint("merge").join(orders.select(F.col("o_orderkey").alias("read_id"), motif.alias("motif")), "read_id")
    oriented = F.when(turned, s.reverse_complement(clip)).otherwise(clip)
    entry = F.when(turned, 32).otherwise(12) + F.col("read_id") % 7 - 3
    return rows.select("read_id", "motif", turned.alias("reverse"), F.lit(20).alias("raw_start"), F.length("seq").alias("raw_end"), oriented.alias("oriented_clip"), entry.cast("int").alias("entry"))


@query(
    "target_entry_tract", "reads orders",
    f"""WITH {TRACTS} SELECT read_id, tract_start::INT AS tract_start, tract_end::INT AS tract_end, round(purity, 6) AS purity, entry_offset, reaches_end,
      (CASE WHEN turned THEN raw_end - tract_end ELSE raw_start + tract_start END)::INT AS tract_raw_start, (CASE WHEN turned THEN raw_end - tract_start ELSE raw_start + tract_end END)::INT AS tract_raw_end FROM e""",
)
def _(reads, orders):
    found = calling.entry_tracts(clips_of(reads, orders))
    return found.select("read_id", "tract_start", "tract_end", F.round("tract_purity", 6).alias("purity"), "entry_offset", "reaches_end", "tract_raw_start", "tract_raw_end")


@query(
    "clip_evidence_by_tract", "reads orders",
    f"""WITH {TRACTS}, s AS (SELECT *, tract_end - tract_start AS bp, CASE WHEN motif = 'A' THEN 'HOMOPOLYMER_REVIEW_NO_STANDARD_P3_EVIDENCE' WHEN tract_start IS NULL THEN 'ORIENTATION_VALID_BRIDGE_ONLY_NO_REPEAT_TRACT' WHEN reaches_end THEN 'P3_CENSORED_LOWER_BOUND' ELSE 'P3_PARTIAL_INTERNAL' END AS primary_status FROM e)
      SELECT read_id, primary_status, CASE primary_status WHEN 'P3_CENSORED_LOWER_BOUND' THEN CASE WHEN turned THEN 'RIGHT_ANCHORED_CENSORED_LEFT' ELSE 'LEFT_ANCHORED_CENSORED_RIGHT' END WHEN 'P3_PARTIAL_INTERNAL' THEN CASE WHEN turned THEN 'RIGHT_ONLY_INTERNAL' ELSE 'LEFT_ONLY_INTERNAL' END ELSE 'UNRESOLVED' END AS evidence_class,
        CASE WHEN primary_status = 'P3_CENSORED_LOWER_BOUND' THEN bp END::INT AS lower_bound_bp FROM s""",
)
def _(reads, orders):
    """Evidence of the tracts found at the entry, in place of stated lengths."""
    found = calling.entry_tracts(clips_of(reads, orders))
    rows = found.withColumns({"tract_bp": F.col("tract_end") - F.col("tract_start"), "strand": F.lit("+"), "projected": F.lit(True), "side": F.when(F.col("reverse"), "LEFT").otherwise("RIGHT")})
    return rescue.clip_evidence(rows).select("read_id", "primary_status", "evidence_class", "lower_bound_bp")


#: Exact calls with the bases of their projected interval, which starts at base 30 of the read, and their global purity.
EXACT = f"""j AS (SELECT s.*, end_pos - start_pos AS span, motif, substr(seq, 31, (end_pos - start_pos)::INT) AS tract FROM segments s JOIN targets USING (target_region_id) JOIN reads USING (read_id)),
      w AS (SELECT read_id, attempt_no, tract, motif, unnest({WAYS}) AS way FROM j WHERE evidence_class = 'SPAN' AND len(tract) > 0),
      g AS (SELECT read_id, attempt_no, max(len(list_filter(range(len(tract)), lambda i: substr(tract, i::INT + 1, 1) = substr(way, (i % len(motif))::INT + 1, 1)))) AS same FROM w GROUP BY ALL),
      x AS (SELECT j.*, g.same, g.same::DOUBLE / len(tract) AS global_purity FROM j LEFT JOIN g USING (read_id, attempt_no))"""


def exact_spans(reads, segments, targets):
    rows = segments.join(targets.select("target_region_id", "motif", (F.col("end_pos") - F.col("start_pos")).alias("span")), "target_region_id").join(reads, "read_id")
    tract = F.substring(F.col("seq"), F.lit(31), F.col("span").cast("int"))
    best = F.when(F.col("evidence_class") == "SPAN", s.phase_purity(tract, F.col("motif"))["purity"])
    return rows.withColumns({"tract": tract, "global_purity": best}).withColumn("same", F.round(F.col("global_purity") * F.length("tract")).cast("long"))


@query(
    "exact_span_audit_by_sequence", "reads segments targets",
    f"""WITH {EXACT} SELECT read_id, attempt_no, CASE WHEN span < 12 THEN 'EXACT_SPAN_TOO_SHORT' WHEN global_purity >= 0.8 THEN 'PERIODIC_EXACT_SPAN_PASS' ELSE 'EXACT_SPAN_LOW_PERIODICITY' END AS status, same AS matches, len(tract) - same AS mismatches, round(global_purity, 6) AS global_purity, round((seg_end - seg_start)::DOUBLE / span, 6) AS old_ratio,
      concat_ws(';', CASE WHEN span < 12 THEN 'PROJECTED_SPAN_BELOW_MINIMUM_REPEAT_BP' END, CASE WHEN global_purity < 0.8 THEN 'GLOBAL_PURITY_BELOW_THRESHOLD' END, CASE WHEN seg_start < 30 OR seg_end > 30 + span THEN 'OLD_LOCAL_TRACT_EXTENDED_OUTSIDE_TARGET' END) AS flags FROM x WHERE evidence_class = 'SPAN'""",
)
def _(reads, segments, targets):
    """Exact calls against the periodicity of all bases of their interval."""
    rows, span, pure = exact_spans(reads, segments.filter("evidence_class = 'SPAN'"), targets), F.col("span"), F.col("global_purity")
    outside = (F.col("seg_start") < 30) | (F.col("seg_end") > 30 + span)
    flags = F.array_compact(F.array(F.when(span < 12, "PROJECTED_SPAN_BELOW_MINIMUM_REPEAT_BP"), F.when(pure < 0.8, "GLOBAL_PURITY_BELOW_THRESHOLD"), F.when(outside, "OLD_LOCAL_TRACT_EXTENDED_OUTSIDE_TARGET")))
    status = F.when(span < 12, "EXACT_SPAN_TOO_SHORT").when(pure >= 0.8, "PERIODIC_EXACT_SPAN_PASS").otherwise("EXACT_SPAN_LOW_PERIODICITY")
    sizes = [F.col("same").alias("matches"), (F.length("tract") - F.col("same")).alias("mismatches"), F.round(pure, 6).alias("global_purity"), F.round((F.col("seg_end") - F.col("seg_start")) / span, 6).alias("old_ratio")]
    return rows.select("read_id", "attempt_no", status.alias("status"), *sizes, F.array_join(flags, ";").alias("flags"))


@query(
    "span_normalization_by_sequence", "reads segments targets",
    f"""WITH {EXACT} SELECT read_id, attempt_no, CASE WHEN evidence_class = 'SPAN' THEN 30 ELSE seg_start END::BIGINT AS tract_start, CASE WHEN evidence_class = 'SPAN' THEN 30 + span ELSE seg_end END::BIGINT AS tract_end, CASE WHEN evidence_class = 'SPAN' THEN span ELSE seg_end - seg_start END::BIGINT AS tract_bp,
      round(CASE WHEN evidence_class = 'SPAN' THEN span ELSE seg_end - seg_start END::DOUBLE / len(motif), 6) AS units, round(coalesce(global_purity, purity), 6) AS tract_purity, same AS matches, len(tract) - same AS mismatches, CASE WHEN evidence_class = 'SPAN' THEN 'SPAN_FIELDS_NORMALIZED' ELSE '' END AS flags FROM x""",
)
def _(reads, segments, targets):
    """Every tract field of exact calls from the projected interval and its global metrics; running it again changes nothing."""
    exact = F.col("evidence_class") == "SPAN"
    rows = exact_spans(reads, segments, targets).withColumns({"tract_start": F.col("seg_start"), "tract_end": F.col("seg_end"), "tract_purity": F.col("purity"), "flags": F.array().cast("array<string>")})
    for _ in range(2):
        mark = F.when(exact, F.array_sort(F.array_distinct(F.concat("flags", F.array(F.lit("SPAN_FIELDS_NORMALIZED")))))).otherwise(F.col("flags"))
        rows = rows.withColumns({"tract_start": F.when(exact, 30).otherwise(F.col("tract_start")), "tract_end": F.when(exact, 30 + F.col("span")).otherwise(F.col("tract_end")), "tract_purity": F.coalesce("global_purity", "tract_purity"), "flags": mark})
    size = F.col("tract_end") - F.col("tract_start")
    fields = [F.col(c).cast("long").alias(c) for c in ("tract_start", "tract_end")] + [size.cast("long").alias("tract_bp"), F.round(size / F.length("motif"), 6).alias("units"), F.round("tract_purity", 6).alias("tract_purity")]
    return rows.select("read_id", "attempt_no", *fields, F.col("same").alias("matches"), (F.length("tract") - F.col("same")).alias("mismatches"), F.array_join("flags", ";").alias("flags"))


@query(
    "alternate_target_calls_by_rank", "blocks targets alignments segments",
    BEST + """, k AS (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY target_overlap_bp > 0 DESC, target_overlap_bp DESC, target_distance_bp, class_priority DESC, mapq DESC, target_source, target_region_id)::INT AS assignment_rank FROM r)
      SELECT k.read_id, k.target_region_id, assignment_rank, s.attempt_no, s.evidence_class, CASE WHEN s.seg_start IS NULL THEN 'no_call' WHEN s.evidence_class = 'SPAN' THEN 'exact' WHEN s.evidence_class = 'UNRESOLVED' THEN 'no_call' ELSE 'lower_bound' END AS sizing_status, s.seg_end - s.seg_start AS tract_bp, 'alternate_exact_target' AS assignment_status, 'LOW' AS assignment_confidence
      FROM k LEFT JOIN segments s ON s.read_id = k.read_id AND s.target_region_id = k.target_region_id WHERE k.target_overlap_bp > 0 AND k.target_source <> 'DISEASE' AND assignment_rank > 1""",
    oracle_views="blocks targets alignments segments candidates",
)
def _(blocks, targets, alignments, segments):
    """Evidence for targets that a read overlaps but isn't assigned to first; its confidence is always low."""
    ranked = asg.ranked_targets(wide(blocks), targets, alignments)
    others = ranked.filter("target_overlap_bp > 0 AND target_source <> 'DISEASE' AND assignment_rank > 1").select("read_id", "target_region_id", "assignment_rank")
    rows = others.join(segments.select("read_id", "target_region_id", "attempt_no", "evidence_class", (F.col("seg_end") - F.col("seg_start")).alias("tract_bp")), ["read_id", "target_region_id"], "left")
    kind = F.col("evidence_class")
    sizing = F.when(kind.isNull() | (kind == "UNRESOLVED"), "no_call").when(kind == "SPAN", "exact").otherwise("lower_bound")
    return rows.withColumns({"sizing_status": sizing, "assignment_status": F.lit("alternate_exact_target"), "assignment_confidence": F.lit("LOW")})


@query(
    "repeated_coordinates_whole", "listed_targets",
    "SELECT chrom, start_pos, end_pos, count(*) AS entries, string_agg(motif, ',' ORDER BY motif) AS motifs FROM listed_targets GROUP BY ALL HAVING count(*) > 1",
)
def _(listed):
    """Entries with the same contig, start and end, and their motifs."""
    return listed.groupBy("chrom", "start_pos", "end_pos").agg(F.count("*").alias("entries"), F.array_join(F.sort_array(F.collect_list("motif")), ",").alias("motifs")).filter("entries > 1")


@query("coordinate_aliases_whole", "listed_targets", "SELECT chrom, start_pos, end_pos, count(DISTINCT target_region_id) AS targets, min(target_region_id) AS first_target FROM listed_targets GROUP BY ALL HAVING count(DISTINCT target_region_id) > 1")
def _(listed):
    return listed.groupBy("chrom", "start_pos", "end_pos").agg(F.count_distinct("target_region_id").alias("targets"), F.min("target_region_id").alias("first_target")).filter("targets > 1")


@query(
    "global_merge_order_checked", "segments",
    """WITH a AS (SELECT read_id, target_region_id, attempt_no, seg_start FROM segments UNION ALL SELECT read_id, target_region_id, attempt_no, seg_start + 1 FROM segments WHERE read_id % 50 = 0 AND attempt_no = 1),
      n AS (SELECT *, count(*) OVER (PARTITION BY read_id, target_region_id, attempt_no) AS n FROM a), k AS (SELECT read_id, target_region_id, attempt_no, row_number() OVER (ORDER BY read_id, target_region_id, attempt_no) - 1 AS place FROM n WHERE n = 1)
      SELECT DISTINCT read_id, target_region_id, attempt_no, place, n AS rows, CASE WHEN n = 1 THEN 'ORDERED' ELSE 'DUPLICATE_KEY' END AS status FROM n LEFT JOIN k USING (read_id, target_region_id, attempt_no)""",
)
def _(segments):
    """Each key's place in the package's global order; keys given more than once are rejected and have none."""
    key = ["read_id", "target_region_id", "attempt_no"]
    shards = segments.select(*key).unionByName(segments.filter("read_id % 50 = 0 AND attempt_no = 1").select(*key))
    counted = shards.groupBy(*key).agg(F.count("*").alias("rows"))
    placed = iv.running_before(counted.filter("rows = 1"), [], "read_id", key, F.lit(1), "sum", tile=1 << 12).withColumn("place", F.coalesce("_before", F.lit(0)).cast("long")).drop("_before")
    twice = counted.filter("rows > 1").withColumn("place", F.lit(None).cast("long"))
    return placed.unionByName(twice).withColumn("status", F.when(F.col("rows") == 1, "ORDERED").otherwise("DUPLICATE_KEY"))
