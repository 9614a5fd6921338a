"""Queries of calls made on the reads' own bases: integration and sizing, baseline flags, windows, reference profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequences as s
from ..operators import alignments as al
from ..operators import laid
from ..operators import intervals as iv
from ..operators.geometry import geometry
from ..operators.rescue import bridge_decision
from ..sources import readers
from ..operators.spread import spread
from .common import register
from .sequence_queries import COMP
from .shape_queries import OPS as SHAPE_OPS
from .tract_queries import WAYS

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)


def called(jobs):
    """Why a job isn't attempted, else the best stretch of its motif in its window, on either strand."""
    start, end = F.col("projected_start") - F.col("window_start"), F.col("projected_end") - F.col("window_start")
    status = (
        F.when(F.length("motif") == 1, "NOT_ATTEMPTED_UNSUPPORTED_STRATEGY").when(F.coalesce(F.length("window_seq"), F.lit(0)) == 0, "NOT_ATTEMPTED_NO_WINDOW_SEQUENCE")
        .when(start.isNull() | end.isNull(), "NOT_ATTEMPTED_NO_PROJECTED_TARGET").when((start < 0) | (end <= start) | (end > F.length("window_seq")), "NOT_ATTEMPTED_INVALID_LOCAL_PRIOR").otherwise("CALLED")
    )
    rows = geometry(jobs.drop("seq").withColumnsRenamed({"meets": "overlaps", "has_left": "left", "has_right": "right"}).withColumn("projected", F.col("projected_start").isNotNull())).withColumn("integration_status", status)
    # worked out in the job's own row, so that jobs are neither made twice nor joined with themselves
    tried = F.when(F.col("integration_status") == "CALLED", F.upper("window_seq"))
    rows = spread(rows, "read_id").withColumns({"_text": tried, "_unit": F.upper("motif"), "_other": s.reverse_complement(F.col("motif"))})
    return laid.best_stretch_of_all(rows, "_text", "_unit", "_other", match=2, mismatch=-3).drop("_text", "_unit", "_other")


CALLED = f"""g AS (SELECT *, CASE WHEN meets AND has_left AND has_right AND projected_start IS NOT NULL THEN 'BOTH_FLANKS_PROJECTABLE' WHEN meets AND has_left AND has_right THEN 'FLANKS_WITHOUT_QUERY_TARGET' WHEN meets AND has_left THEN 'LEFT_FLANK_ONLY' WHEN meets AND has_right THEN 'RIGHT_FLANK_ONLY' WHEN meets THEN 'TARGET_INTERNAL_NO_FLANK'
        WHEN CASE side WHEN 'RIGHT' THEN has_left ELSE has_right END THEN 'PROXIMAL_' || side || CASE WHEN clip THEN '_WITH_SOFTCLIP' ELSE '_NO_SOFTCLIP' END ELSE 'PROXIMAL_ONLY' END AS geometry_class,
        CASE WHEN len(motif) = 1 THEN 'NOT_ATTEMPTED_UNSUPPORTED_STRATEGY' WHEN coalesce(len(window_seq), 0) = 0 THEN 'NOT_ATTEMPTED_NO_WINDOW_SEQUENCE' WHEN projected_start IS NULL THEN 'NOT_ATTEMPTED_NO_PROJECTED_TARGET'
          WHEN projected_start < window_start OR projected_end <= projected_start OR projected_end - window_start > len(window_seq) THEN 'NOT_ATTEMPTED_INVALID_LOCAL_PRIOR' ELSE 'CALLED' END AS integration_status FROM jobs),
      w AS (SELECT read_id, window_seq, motif, unnest({WAYS}) AS way FROM g WHERE integration_status = 'CALLED'), u AS (SELECT *, unnest(range(len(window_seq)))::INT AS pos FROM w),
      v AS (SELECT read_id, way, pos, CASE WHEN substr(window_seq, pos + 1, 1) = substr(way, pos % len(way) + 1, 1) THEN 2 ELSE -3 END AS v FROM u), x AS (SELECT *, sum(v) OVER (PARTITION BY read_id, way ORDER BY pos) AS prefix FROM v),
      y AS (SELECT *, min(struct_pack(p := (prefix - v)::BIGINT, start := pos)) OVER (PARTITION BY read_id, way ORDER BY pos) AS low FROM x), z AS (SELECT read_id, low.start AS st, pos + 1 AS en, (prefix - low.p)::BIGINT AS score FROM y),
      b AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY score DESC, st, en) = 1),
      k AS (SELECT g.*, st, en, en - st AS bp, (score + 3 * (en - st)) / 5.0::DOUBLE / (en - st) AS tract_purity, greatest(3, 2 * len(motif)) AS guard, CASE WHEN geometry_class = 'BOTH_FLANKS_PROJECTABLE' THEN 'SPAN' WHEN geometry_class IN ('LEFT_FLANK_ONLY', 'PROXIMAL_RIGHT_WITH_SOFTCLIP') THEN CASE strand WHEN '+' THEN 'RIGHT_CENSORED' ELSE 'LEFT_CENSORED' END
        WHEN geometry_class IN ('RIGHT_FLANK_ONLY', 'PROXIMAL_LEFT_WITH_SOFTCLIP') THEN CASE strand WHEN '+' THEN 'LEFT_CENSORED' ELSE 'RIGHT_CENSORED' END ELSE 'UNKNOWN' END AS call_geometry FROM g LEFT JOIN b USING (read_id))"""


def call_geometry():
    """The censored side of the raw read: the genomic one, turned on the reverse strand."""
    turned = lambda a, b: F.when(F.col("strand") == "+", a).otherwise(b)
    return (
        F.when(F.col("geometry_class") == "BOTH_FLANKS_PROJECTABLE", "SPAN").when(F.col("geometry_class").isin("LEFT_FLANK_ONLY", "PROXIMAL_RIGHT_WITH_SOFTCLIP"), turned("RIGHT_CENSORED", "LEFT_CENSORED"))
        .when(F.col("geometry_class").isin("RIGHT_FLANK_ONLY", "PROXIMAL_LEFT_WITH_SOFTCLIP"), turned("LEFT_CENSORED", "RIGHT_CENSORED")).otherwise("UNKNOWN")
    )


@query(
    "caller_integration_by_job", "jobs",
    f"WITH {CALLED} SELECT read_id, target_region_id, integration_status, geometry_class, call_geometry, (window_start + st)::BIGINT AS raw_tract_start, (window_start + en)::BIGINT AS raw_tract_end, round(tract_purity, 6) AS tract_purity FROM k",
)
def _(jobs):
    rows = called(jobs).withColumn("call_geometry", call_geometry())
    bp = F.col("call.end") - F.col("call.start")
    purity = F.round((F.col("call.score") + 3 * bp) / 5.0 / bp, 6)
    place = lambda c: (F.col("window_start") + F.col(f"call.{c}")).cast("long").alias(f"raw_tract_{c}")
    return rows.select("read_id", "target_region_id", "integration_status", "geometry_class", "call_geometry", place("start"), place("end"), purity.alias("tract_purity"))


@query(
    "caller_sizing_by_context", "jobs",
    f"""WITH {CALLED}, c AS (SELECT *, bp >= 3 * len(motif) AND tract_purity >= 0.55 AS good, st <= guard AS tl, len(window_seq) - en <= guard AS tr FROM k WHERE integration_status = 'CALLED')
      SELECT read_id, CASE WHEN NOT good THEN 'LOW_CONFIDENCE' WHEN call_geometry = 'SPAN' AND NOT (tl OR tr) THEN 'EXACT_SPAN' WHEN call_geometry = 'LEFT_CENSORED' THEN 'LOWER_BOUND_LEFT_CENSORED' WHEN call_geometry = 'RIGHT_CENSORED' THEN 'LOWER_BOUND_RIGHT_CENSORED' WHEN tl OR tr THEN 'CONTEXT_LIMITED_LOWER_BOUND' ELSE 'LOWER_BOUND_UNKNOWN_GEOMETRY' END AS sizing_status,
        CASE WHEN good AND call_geometry = 'SPAN' AND NOT (tl OR tr) THEN bp END AS exact_bp, CASE WHEN good THEN bp END AS lower_bound_bp,
        CASE WHEN call_geometry = 'LEFT_CENSORED' THEN 'CENSORED_BY_GEOMETRY' WHEN tl THEN 'CONTEXT_EDGE' WHEN NOT good THEN 'LOW_CONFIDENCE' ELSE 'SEQUENCE_BOUNDED' END AS left_boundary, CASE WHEN call_geometry = 'RIGHT_CENSORED' THEN 'CENSORED_BY_GEOMETRY' WHEN tr THEN 'CONTEXT_EDGE' WHEN NOT good THEN 'LOW_CONFIDENCE' ELSE 'SEQUENCE_BOUNDED' END AS right_boundary FROM c""",
)
def _(jobs):
    """Exact or lower bound by what the flanks allow and whether the tract meets the ends of its window."""
    rows = called(jobs).filter("integration_status = 'CALLED'").withColumn("call_geometry", call_geometry())
    bp, unit = F.col("call.end") - F.col("call.start"), F.length("motif")
    good = (bp >= 3 * unit) & ((F.col("call.score") + 3 * bp) / 5.0 / bp >= 0.55)
    guard = F.greatest(F.lit(3), 2 * unit)
    edge = {"LEFT": F.col("call.start") <= guard, "RIGHT": F.length("window_seq") - F.col("call.end") <= guard}
    limited, way = edge["LEFT"] | edge["RIGHT"], F.col("call_geometry")
    exact = good & (way == "SPAN") & ~limited
    sizing = (
        F.when(~good, "LOW_CONFIDENCE").when(exact, "EXACT_SPAN").when(way.isin("LEFT_CENSORED", "RIGHT_CENSORED"), F.concat(F.lit("LOWER_BOUND_"), way)).when(limited, "CONTEXT_LIMITED_LOWER_BOUND").otherwise("LOWER_BOUND_UNKNOWN_GEOMETRY")
    )
    bound = lambda side: F.when(way == f"{side}_CENSORED", "CENSORED_BY_GEOMETRY").when(edge[side], "CONTEXT_EDGE").when(~good, "LOW_CONFIDENCE").otherwise("SEQUENCE_BOUNDED")
    return rows.select("read_id", sizing.alias("sizing_status"), F.when(exact, bp).alias("exact_bp"), F.when(good, bp).alias("lower_bound_bp"), bound("LEFT").alias("left_boundary"), bound("RIGHT").alias("right_boundary"))


@query(
    "baseline_call_by_target", "segments targets",
    """WITH n AS (SELECT read_id, count(DISTINCT target_region_id) AS targets FROM segments GROUP BY read_id), j AS (SELECT s.*, t.target_source, t.motif, t.end_pos - t.start_pos AS span, n.targets, (seg_end - seg_start)::DOUBLE / len(t.motif) AS units, greatest(3, ceil(12.0 / len(t.motif))) AS required FROM segments s JOIN targets t USING (target_region_id) JOIN n USING (read_id))
      SELECT read_id, attempt_no, round(units, 6) AS units, required::INT AS required_units, CASE WHEN units >= required AND seg_end - seg_start >= 12 AND purity >= 0.8 THEN 'PASS' ELSE 'LOW_CONFIDENCE' END AS status,
        concat_ws(';', CASE WHEN units < required THEN 'BELOW_MINIMUM_UNITS' END, CASE WHEN seg_end - seg_start < 12 THEN 'BELOW_MINIMUM_REPEAT_BP' END, CASE WHEN purity < 0.8 THEN 'BELOW_MINIMUM_PURITY' END, CASE WHEN target_source = 'DISEASE' THEN 'KNOWN_DISEASE_REGION' END, CASE WHEN targets > 1 THEN 'MULTIPLE_TARGET_CANDIDATES' END) AS flags,
        CASE WHEN target_source = 'CATALOG' THEN round(units / (span::DOUBLE / len(motif)), 6) END AS reference_ratio FROM j""",
)
def _(segments, targets):
    """Minimum units, bases and purity, flags, and units over those of the reference for catalog loci."""
    several = segments.groupBy("read_id").agg((F.count_distinct("target_region_id") > 1).alias("several"))
    rows = segments.join(targets.select("target_region_id", "target_source", "motif", (F.col("end_pos") - F.col("start_pos")).alias("span")), "target_region_id").join(several, "read_id")
    size, unit = F.col("seg_end") - F.col("seg_start"), F.length("motif")
    units, required = size / unit, F.greatest(F.lit(3), F.ceil(F.lit(12.0) / unit)).cast("int")
    few, short, impure = units < required, size < 12, F.col("purity") < 0.8
    flags = F.array_compact(F.array(*[F.when(c, n) for c, n in (
        (few, "BELOW_MINIMUM_UNITS"), (short, "BELOW_MINIMUM_REPEAT_BP"), (impure, "BELOW_MINIMUM_PURITY"), (F.col("target_source") == "DISEASE", "KNOWN_DISEASE_REGION"), (F.col("several"), "MULTIPLE_TARGET_CANDIDATES"),
    )]))
    status = F.when(few | short | impure, "LOW_CONFIDENCE").otherwise("PASS")
    ratio = F.when(F.col("target_source") == "CATALOG", F.round(units / (F.col("span") / unit), 6))
    return rows.select("read_id", "attempt_no", F.round(units, 6).alias("units"), required.alias("required_units"), status.alias("status"), F.array_join(flags, ";").alias("flags"), ratio.alias("reference_ratio"))


@query(
    "bridge_motif_signal_by_windows", "paf_rows reads targets",
    f"""WITH c AS (SELECT p.*, t.motif, substr(r.seq, p.query_start + 1) AS clip FROM paf_rows p JOIN targets t ON t.target_region_id = p.target_name JOIN reads r ON p.query_name = 'Q' || r.read_id),
      i AS (SELECT query_name, ordinal, motif, clip, unnest(range(0, len(clip), 20)) AS start FROM c), k AS (SELECT *, substr(clip, start + 1, 40) AS part FROM i WHERE (start = 0 OR start + 20 < len(clip)) AND len(clip) - start >= 20),
      w AS (SELECT query_name, ordinal, start, part, motif, unnest({WAYS}) AS way FROM k), q AS (SELECT query_name, ordinal, start, max(len(list_filter(range(len(part)), lambda j: substr(part, j::INT + 1, 1) = substr(way, (j % len(way))::INT + 1, 1)))::DOUBLE / len(part)) AS purity FROM w GROUP BY query_name, ordinal, start, part),
      n AS (SELECT query_name, ordinal, count(*) FILTER (purity >= 0.7) AS windows FROM q GROUP BY ALL),
      d AS (SELECT c.query_name, c.ordinal, coalesce(n.windows, 0) AS windows, NOT (mapq = 0 OR strand = '-' OR query_start > 10 OR target_start > 10 OR residue_matches < 70 OR query_end - query_start < 84 OR target_end < 112) AS reaches FROM c LEFT JOIN n ON c.query_name = n.query_name AND c.ordinal = n.ordinal)
      SELECT query_name, ordinal, windows, CASE WHEN reaches AND windows > 0 THEN 'BRIDGE_PLUS_TARGET_MOTIF_SIGNAL' WHEN reaches THEN 'BRIDGE_ONLY_NO_TARGET_MOTIF_SIGNAL' WHEN windows > 0 THEN 'TARGET_MOTIF_SIGNAL_WITHOUT_BRIDGE' ELSE 'NO_BRIDGE_NO_TARGET_MOTIF_SIGNAL' END AS signal FROM d""",
)
def _(paf, reads, targets):
    """Bridges beside the windows of the clip that look like the target's motif."""
    named = reads.select(F.concat(F.lit("Q"), F.col("read_id")).alias("query_name"), "seq")
    rows = paf.join(targets.select(F.col("target_region_id").alias("target_name"), "motif"), "target_name").join(named.hint("merge"), "query_name")
    rows = rows.withColumn("clip", F.substring(F.col("seq"), (F.col("query_start") + 1).cast("int"), F.length("seq"))).drop("seq", "target_name")
    found, windows = bridge_decision(laid.count_like_windows(rows, "clip", "motif"), entry=100), F.col("windows")
    good, repeat = F.col("priority") == 5, windows > 0
    signal = F.when(good & repeat, "BRIDGE_PLUS_TARGET_MOTIF_SIGNAL").when(good, "BRIDGE_ONLY_NO_TARGET_MOTIF_SIGNAL").when(repeat, "TARGET_MOTIF_SIGNAL_WITHOUT_BRIDGE").otherwise("NO_BRIDGE_NO_TARGET_MOTIF_SIGNAL")
    return found.select("query_name", "ordinal", windows.alias("windows"), signal.alias("signal"))


REFERENCE = """rs AS (SELECT target_region_id, motif, array_to_string(list_transform(range(start_pos, end_pos), lambda p: substr(translate(md5(chrom || ':' || (p // 32)), '0123456789abcdef', 'ACGTACGTACGTACGT'), (p % 32 + 1)::INT, 1)), '') AS sequence FROM targets)"""


def reference_of(targets):
    """Each target with its reference bases, from tiles of 32."""
    places = targets.select("chrom", F.explode(F.sequence(F.floor(F.col("start_pos") / 32), F.floor((F.col("end_pos") - 1) / 32))).alias("tile_no")).distinct()
    tiles = places.select(F.col("chrom").alias("contig"), "tile_no", F.translate(F.md5(F.concat_ws(":", "chrom", "tile_no")), "0123456789abcdef", "ACGTACGTACGTACGT").alias("seq"))
    spans = targets.select("target_region_id", "motif", F.col("chrom").alias("contig"), F.col("start_pos").alias("start"), F.col("end_pos").alias("end"))
    return readers.fetch_tiles(spans, tiles, 32).select("target_region_id", "motif", "sequence")


@query(
    "reference_motif_identity_by_locus", "targets",
    f"""WITH {REFERENCE}, w AS (SELECT *, unnest({WAYS}) AS way FROM rs), p AS (SELECT target_region_id, motif, max(len(list_filter(range(len(sequence)), lambda j: substr(sequence, j::INT + 1, 1) = substr(way, (j % len(way))::INT + 1, 1)))::DOUBLE / len(sequence)) AS identity FROM w GROUP BY ALL)
      SELECT motif, count(*) AS loci, round(quantile_cont(identity, 0.25), 6) AS q1, round(quantile_cont(identity, 0.5), 6) AS median, round(quantile_cont(identity, 0.75), 6) AS q3 FROM p GROUP BY motif""",
)
def _(targets):
    """Best cyclic identity of each locus's reference bases to its own motif, on either strand, in quartiles."""
    rows = laid.purities(reference_of(targets), "sequence", "motif").select("motif", F.col("purity").alias("identity"))
    quartiles = iv.quantiles(rows, ["motif"], F.col("identity"), {"q1": 0.25, "median": 0.5, "q3": 0.75}, tile=0.05, places=6)
    return rows.groupBy("motif").agg(F.count("*").alias("loci")).join(quartiles, "motif")


BEST = lambda source, key, text: f"""(SELECT {key}, motif, purity FROM (SELECT {key}, motif, max(len(list_filter(range(len({text})), lambda j: substr({text}, j::INT + 1, 1) = substr(way, (j % len(way))::INT + 1, 1)))::DOUBLE / len({text})) AS purity FROM (SELECT {key}, {text}, m.motif, unnest({WAYS.replace('motif', 'm.motif')}) AS way FROM {source}, ms m) GROUP BY {key}, {text}, motif) QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY round(purity, 9) DESC, motif) = 1)"""


@query(
    "reference_architecture_by_locus", "jobs targets",
    f"""WITH {REFERENCE}, ms AS (SELECT DISTINCT motif FROM targets), ev AS (SELECT read_id, target_region_id, substr(seq, seg_start::INT + 1, (seg_end - seg_start)::INT) AS tract FROM jobs), es AS (SELECT * FROM ev WHERE len(tract) > 0),
      ob AS {BEST('es', 'read_id', 'tract')}, rf AS {BEST('rs', 'target_region_id', 'sequence')}
      SELECT read_id, target_region_id, ob.motif AS observed, round(ob.purity, 6) AS observed_purity, rf.motif AS reference, round(rf.purity, 6) AS reference_purity, ob.motif = rf.motif AS same_motif FROM es JOIN ob USING (read_id) JOIN rf USING (target_region_id)""",
)
def _(jobs, targets):
    """The best catalog motif of each event's bases and of its locus's reference bases."""
    motifs = F.broadcast(targets.agg(F.array_sort(F.collect_set("motif")).alias("motifs")))  # one row, of the catalog's few motifs

    def profiled(rows, text):
        each = F.transform("motifs", lambda m: F.struct((-F.round(s.phase_purity(F.col(text), m)["purity"], 9)).alias("less"), m.alias("motif")))
        return rows.join(motifs).withColumn("best", F.explode(F.array(F.array_min(each)))).drop("motifs")

    events = jobs.select("read_id", "target_region_id", F.substring(F.col("seq"), (F.col("seg_start") + 1).cast("int"), (F.col("seg_end") - F.col("seg_start")).cast("int")).alias("tract")).filter("tract <> ''")
    own = profiled(events, "tract").select("read_id", "target_region_id", F.col("best.motif").alias("observed"), F.round(-F.col("best.less"), 6).alias("observed_purity"))
    reference = profiled(reference_of(targets), "sequence").select("target_region_id", F.col("best.motif").alias("reference"), F.round(-F.col("best.less"), 6).alias("reference_purity"))
    return own.join(reference, "target_region_id").withColumn("same_motif", F.col("observed") == F.col("reference"))


@query(
    "residual_context_by_side", "jobs",
    """WITH x AS (SELECT read_id, unnest(['LEFT', 'RIGHT']) AS side, unnest([substr(seq, 1, seg_start::INT), substr(seq, seg_end::INT + 1)]) AS part FROM jobs), u AS (SELECT read_id, side, part, unnest(range(1, greatest(2, len(part) - 1))) AS i FROM x),
      k AS (SELECT read_id, side, any_value(part) AS part, count(DISTINCT substr(part, i::INT, 3))::DOUBLE / greatest(1, least(64, any_value(len(part)) - 2)) AS kmers FROM u GROUP BY read_id, side)
      SELECT read_id, side, len(part)::INT AS bp, CASE WHEN len(part) < 22 THEN 'SHORT_CONTEXT' WHEN kmers < 0.8 THEN 'LOW_COMPLEXITY_CONTEXT' WHEN greatest(len(part) - len(replace(part, 'A', '')), len(part) - len(replace(part, 'C', '')), len(part) - len(replace(part, 'G', '')), len(part) - len(replace(part, 'T', '')))::DOUBLE / len(part) >= 0.5 THEN 'BIASED_CONTEXT' ELSE 'UNRESOLVED_CONTEXT' END AS context FROM k""",
)
def _(jobs):
    """What a read looks like before and behind its tract, over all its bases there."""
    sides = F.array(F.struct(F.lit("LEFT").alias("side"), F.substring(F.col("seq"), F.lit(1), F.col("seg_start").cast("int")).alias("part")), F.struct(F.lit("RIGHT").alias("side"), F.substring(F.col("seq"), (F.col("seg_end") + 1).cast("int"), F.length("seq")).alias("part")))
    # exploded, so that a side's complexity is worked out once, not for each of its fields
    rows = spread(jobs.select("read_id", "seq", "seg_start", "seg_end"), "read_id").select("read_id", F.explode(sides).alias("x")).select("read_id", "x.side", F.length("x.part").alias("bp"), F.explode(F.array(s.complexity(F.col("x.part")))).alias("c"))
    most = F.greatest(*[F.col(f"c.fraction_{b}") for b in "acgt"])
    kind = F.when(F.col("bp") < 22, "SHORT_CONTEXT").when(F.col("c.kmer_fraction") < 0.8, "LOW_COMPLEXITY_CONTEXT").when(most >= 0.5, "BIASED_CONTEXT").otherwise("UNRESOLVED_CONTEXT")
    return rows.select("read_id", "side", "bp", kind.alias("context"))


SIDES = SHAPE_OPS + """, n AS (SELECT *, row_number() OVER (PARTITION BY read_id, ordinal ORDER BY op_index) AS i, row_number() OVER (PARTITION BY read_id, ordinal ORDER BY op_index DESC) AS j FROM o WHERE op <> 'H'),
      sd AS (SELECT read_id, ordinal, strand, 'LEFT' AS side, op_len AS bp FROM n WHERE op = 'S' AND i = 1 UNION ALL SELECT read_id, ordinal, strand, 'RIGHT', op_len FROM n WHERE op = 'S' AND j = 1 AND i > 1),
      c AS (SELECT sd.*, CASE WHEN (strand = '+') = (side = 'RIGHT') THEN substr(seq, greatest(1, len(seq) - bp + 1)) ELSE substr(seq, 1, bp) END AS raw FROM sd JOIN reads USING (read_id))"""


def raw_clips(shapes, reads):
    """Soft clips by side of the reference with their bases in the raw read, of which a reverse alignment has the other end."""
    rows = al.features(shapes).join(reads, "read_id")
    sides = F.filter(F.array(*[F.struct(F.lit(n).alias("side"), F.col(c).cast("int").alias("bp")) for n, c in (("LEFT", "clip_left_bp"), ("RIGHT", "clip_right_bp"))]), lambda x: x["bp"] > 0)
    rows = rows.select("read_id", "ordinal", "strand", "seq", F.explode(sides).alias("x")).select("read_id", "ordinal", "strand", "seq", "x.*")
    as_raw, bp = (F.col("strand") == "+") == (F.col("side") == "RIGHT"), F.col("bp")
    start = F.when(as_raw, F.greatest(F.lit(1), F.length("seq") - bp + 1)).otherwise(1)
    return rows.withColumns({"as_raw": as_raw, "raw": F.substring(F.col("seq"), start, bp)})


@query(
    "orientation_transform_by_clip", "shapes reads",
    f"{SIDES} SELECT read_id, ordinal, side, CASE WHEN (strand = '+') = (side = 'RIGHT') THEN 'AS_RAW' ELSE 'REVERSE_COMPLEMENT' END AS transform, CASE WHEN (strand = '+') = (side = 'RIGHT') THEN raw ELSE {COMP.format('raw')} END AS clip FROM c",
)
def _(shapes, reads):
    """Each soft clip, as long as the CIGAR has it, turned to run from the mapped block outward."""
    rows, as_raw = raw_clips(shapes, reads), F.col("as_raw")
    return rows.select("read_id", "ordinal", "side", F.when(as_raw, "AS_RAW").otherwise("REVERSE_COMPLEMENT").alias("transform"), F.when(as_raw, F.upper("raw")).otherwise(s.reverse_complement(F.col("raw"))).alias("clip"))


@query(
    "orientation_audit_by_clip", "shapes reads",
    f"""{SIDES}, t AS (SELECT *, CASE WHEN (strand = '+') = (side = 'RIGHT') THEN raw ELSE {COMP.format('raw')} END AS own, CASE read_id % 7 WHEN 0 THEN reverse(raw) WHEN 1 THEN {COMP.format('raw')} WHEN 2 THEN raw || 'A' ELSE raw END AS stored FROM c)
      SELECT side, CASE WHEN stored = own THEN 'AGREES' WHEN stored = {COMP.format('own')} THEN 'TRANSFORM_MISMATCH' WHEN stored = reverse(own) OR stored = reverse({COMP.format('own')}) THEN 'REVERSAL_MISMATCH' ELSE 'CONTENT_MISMATCH' END AS outcome, count(*) AS clips, sum(bp)::BIGINT AS bases FROM t GROUP BY ALL""",
)
def _(shapes, reads):
    """Stored clips against those turned from the raw read, over their whole length."""
    rows, other = raw_clips(shapes, reads), s.reverse_complement
    kind, raw = F.col("read_id") % 7, F.col("raw")
    stored = F.when(kind == 0, F.reverse(raw)).when(kind == 1, other(raw)).when(kind == 2, F.concat(raw, F.lit("A"))).otherwise(raw)
    rows = rows.withColumns({"own": F.when(F.col("as_raw"), raw).otherwise(other(raw)), "stored": stored})
    own, kept = F.col("own"), F.col("stored")
    outcome = F.when(kept == own, "AGREES").when(kept == other(own), "TRANSFORM_MISMATCH").when((kept == F.reverse(own)) | (kept == F.reverse(other(own))), "REVERSAL_MISMATCH").otherwise("CONTENT_MISMATCH")
    return rows.groupBy("side", outcome.alias("outcome")).agg(F.count("*").alias("clips"), F.sum("bp").alias("bases"))


@query(
    "enum_dictionary_diff_occurring", "lineitem",
    """WITH a AS (SELECT DISTINCT l_partkey AS code FROM lineitem WHERE l_quantity > 45), b AS (SELECT DISTINCT l_partkey AS code FROM lineitem WHERE l_quantity < 5)
      SELECT code, 'MISSING_RIGHT' AS side FROM (SELECT code FROM a EXCEPT SELECT code FROM b) UNION ALL SELECT code, 'MISSING_LEFT' FROM (SELECT code FROM b EXCEPT SELECT code FROM a)""",
)
def _(lineitem):
    """Codes that occur in one part of a table and not in another, both ways."""
    left, right = (lineitem.filter(c).select(F.col("l_partkey").alias("code")).distinct() for c in ("l_quantity > 45", "l_quantity < 5"))
    return left.exceptAll(right).withColumn("side", F.lit("MISSING_RIGHT")).unionByName(right.exceptAll(left).withColumn("side", F.lit("MISSING_LEFT")))
