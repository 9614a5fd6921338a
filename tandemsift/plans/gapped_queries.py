"""Queries of gapped alignment: exact spans and called tracts against their motif, with edits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequences as s
from ..operators import gapped
from .common import register
from .sequence_queries import COMP

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)

#: Every alignment as [score, matches, -mismatches, -insertions, -deletions, motif bases, -first phase], base by base, the best of each phase kept.
ALIGNED = f"""u AS (SELECT DISTINCT tract, motif FROM edited_tracts WHERE len(tract) > 0),
      w AS (SELECT tract, motif, 0 AS place, motif AS unit FROM u UNION ALL SELECT tract, motif, -1, {COMP.format('motif')} FROM u),
      band AS (
        SELECT tract, motif, place, unit, 0 AS n, ph, [0, 0, 0, 0, 0, 0, -ph] AS best FROM (SELECT *, unnest(range(len(unit)))::INT AS ph FROM w)
        UNION ALL
        SELECT tract, motif, place, unit, n + 1, ph, max(best) FROM (
          SELECT tract, motif, place, unit, n, ph, [best[1] - 4, best[2], best[3], best[4] - 1, best[5], best[6], best[7]] AS best FROM band WHERE n < len(tract)
          UNION ALL
          SELECT tract, motif, place, unit, n, (ph + d + 1) % len(unit), CASE WHEN substr(unit, (ph + d) % len(unit) + 1, 1) = substr(tract, n + 1, 1)
            THEN [best[1] + 3 - 4 * d, best[2] + 1, best[3], best[4], best[5] - d, best[6] + d + 1, best[7]] ELSE [best[1] - 4 - 4 * d, best[2], best[3] - 1, best[4], best[5] - d, best[6] + d + 1, best[7]] END
          FROM band, (SELECT unnest([0, 1])::INT AS d) WHERE n < len(tract)
        ) GROUP BY tract, motif, place, unit, n, ph
      ),
      top AS (SELECT tract, motif, max(struct_pack(best := best[1:3] || [best[7]], place := place, all_ := best)) AS t FROM band WHERE n = len(tract) GROUP BY tract, motif),
      x AS (SELECT e.*, t.all_[1] AS score, t.all_[2] AS matches, -t.all_[3] AS mismatches, -t.all_[4] AS insertions, -t.all_[5] AS deletions, t.all_[6] AS motif_bases, CASE t.place WHEN 0 THEN '+' WHEN -1 THEN '-' END AS strand,
        matches + mismatches + insertions + deletions AS steps FROM edited_tracts e LEFT JOIN top USING (tract, motif)),
      y AS (SELECT *, matches / nullif(steps, 0) AS purity_, (steps - matches) / nullif(steps, 0) AS edit_fraction, insertions / nullif(steps, 0) AS insertion_fraction, deletions / nullif(steps, 0) AS deletion_fraction, motif_bases / nullif(len(tract), 0) AS path_ratio, CASE motif_bases WHEN 0 THEN 0 ELSE score / motif_bases END AS dense FROM x)"""


@query(
    "exact_span_audit_by_edits", "edited_tracts",
    f"""WITH {ALIGNED} SELECT read_id, attempt_no, score, strand, matches, mismatches, insertions, deletions, round(purity_, 6) AS global_purity, round(edit_fraction, 6) AS edit_fraction, round(insertion_fraction, 6) AS insertion_fraction, round(deletion_fraction, 6) AS deletion_fraction,
        round(score / nullif(len(tract), 0), 6) AS score_per_bp, round(path_ratio, 6) AS path_ratio, round((seg_end - seg_start) / nullif(len(tract), 0), 6) AS old_ratio,
        CASE WHEN len(tract) < 12 THEN 'EXACT_SPAN_TOO_SHORT' WHEN purity_ >= 0.7 THEN 'PERIODIC_EXACT_SPAN_PASS' ELSE 'EXACT_SPAN_LOW_PERIODICITY' END AS status,
        concat_ws(';', CASE WHEN len(tract) < 12 THEN 'PROJECTED_SPAN_BELOW_MINIMUM_REPEAT_BP' END, CASE WHEN purity_ < 0.7 THEN 'GLOBAL_PURITY_BELOW_THRESHOLD' END, CASE WHEN path_ratio > 1.25 THEN 'GLOBAL_MOTIF_PATH_INFLATION_GT_1_25' END,
          CASE WHEN edit_fraction > 0.3 THEN 'GLOBAL_EDIT_FRACTION_GT_0_30' END, CASE WHEN seg_start < 30 OR seg_end > 30 + len(tract) THEN 'OLD_LOCAL_TRACT_EXTENDED_OUTSIDE_TARGET' END) AS flags
      FROM y WHERE evidence_class = 'SPAN'""",
    recursive=True,
)
def _(tracts):
    """Exact spans against all bases of their interval, from base 30 of the read: edits, status and flags."""
    rows = gapped.edit_fractions(gapped.align_to_motif(tracts.filter("evidence_class = 'SPAN'")))
    size, pure = F.length("tract"), F.col("purity")
    flags = {
        "PROJECTED_SPAN_BELOW_MINIMUM_REPEAT_BP": size < 12, "GLOBAL_PURITY_BELOW_THRESHOLD": pure < 0.7, "GLOBAL_MOTIF_PATH_INFLATION_GT_1_25": F.col("path_ratio") > 1.25,
        "GLOBAL_EDIT_FRACTION_GT_0_30": F.col("edit_fraction") > 0.3, "OLD_LOCAL_TRACT_EXTENDED_OUTSIDE_TARGET": (F.col("seg_start") < 30) | (F.col("seg_end") > 30 + size),
    }
    status = F.when(size < 12, "EXACT_SPAN_TOO_SHORT").when(pure >= 0.7, "PERIODIC_EXACT_SPAN_PASS").otherwise("EXACT_SPAN_LOW_PERIODICITY")
    shares = {"global_purity": pure, "score_per_bp": F.try_divide("score", size), "old_ratio": F.try_divide(F.col("seg_end") - F.col("seg_start"), size)} | {c: F.col(c) for c in ("edit_fraction", "insertion_fraction", "deletion_fraction", "path_ratio")}
    counts = ["read_id", "attempt_no", "score", "strand", "matches", "mismatches", "insertions", "deletions"]
    return rows.select(*counts, *[F.round(v, 6).alias(n) for n, v in shares.items()], status.alias("status"), F.concat_ws(";", *[F.when(w, n) for n, w in flags.items()]).alias("flags"))


@query(
    "target_concordance_by_edits", "edited_tracts",
    f"""WITH {ALIGNED}, z AS (SELECT *, greatest(0, least(seg_start + len(tract), 30 + span) - greatest(seg_start, 30)) AS ov FROM y)
      SELECT read_id, attempt_no, round(ov / nullif(len(tract), 0), 6) AS tract_fraction, round(ov / span, 6) AS target_fraction, round(path_ratio, 6) AS unit_inflation, round(edit_fraction, 6) AS edit_fraction, round(insertion_fraction, 6) AS insertion_fraction,
        round(deletion_fraction, 6) AS deletion_fraction, round(dense, 6) AS score_density,
        CASE WHEN mapq < 5 THEN 'BASELINE_LOW_CONFIDENCE' WHEN span IS NULL THEN 'TARGET_COORDINATE_REVIEW' WHEN ov = 0 THEN 'OFF_TARGET_TRACT' WHEN path_ratio > 1.25 OR edit_fraction > 0.3 OR insertion_fraction > 0.15 OR deletion_fraction > 0.15 OR dense < 0.75 THEN 'GAP_OR_SCORE_REVIEW' ELSE 'KEEP_FOR_TARGET_CONSTRAINED_REFINEMENT' END AS technical_class,
        concat_ws(';', CASE WHEN ov = 0 THEN 'TRACT_DOES_NOT_OVERLAP_TARGET' END, CASE WHEN path_ratio > 1.25 THEN 'MOTIF_PATH_UNITS_GT_READ_UNITS_1_25' END, CASE WHEN edit_fraction > 0.3 THEN 'EDIT_FRACTION_GT_0_30' END, CASE WHEN insertion_fraction > 0.15 THEN 'INSERTION_FRACTION_GT_0_15' END,
          CASE WHEN deletion_fraction > 0.15 THEN 'DELETION_FRACTION_GT_0_15' END, CASE WHEN dense < 0.75 THEN 'SCORE_DENSITY_LT_0_75' END, CASE WHEN purity_ < 0.7 THEN 'PURITY_LT_0_70' END) AS flags FROM z""",
    recursive=True,
)
def _(tracts):
    """Called tracts against the projected target, from base 30 of the read: overlap, inflation of units, edits, class and flags."""
    rows = gapped.edit_fractions(gapped.align_to_motif(tracts))
    start, size, span = F.col("seg_start"), F.length("tract"), F.col("span")
    both, dense = s.overlap(start, start + size, F.lit(30), span + 30), F.when(F.col("motif_bases") == 0, 0.0).otherwise(F.try_divide("score", "motif_bases"))
    inflated, edited, inserted, deleted = F.col("path_ratio") > 1.25, F.col("edit_fraction") > 0.3, F.col("insertion_fraction") > 0.15, F.col("deletion_fraction") > 0.15
    kind = (
        F.when(F.col("mapq") < 5, "BASELINE_LOW_CONFIDENCE").when(span.isNull(), "TARGET_COORDINATE_REVIEW").when(both == 0, "OFF_TARGET_TRACT")
        .when(inflated | edited | inserted | deleted | (dense < 0.75), "GAP_OR_SCORE_REVIEW").otherwise("KEEP_FOR_TARGET_CONSTRAINED_REFINEMENT")
    )
    flags = {
        "TRACT_DOES_NOT_OVERLAP_TARGET": both == 0, "MOTIF_PATH_UNITS_GT_READ_UNITS_1_25": inflated, "EDIT_FRACTION_GT_0_30": edited, "INSERTION_FRACTION_GT_0_15": inserted,
        "DELETION_FRACTION_GT_0_15": deleted, "SCORE_DENSITY_LT_0_75": dense < 0.75, "PURITY_LT_0_70": F.col("purity") < 0.7,
    }
    shares = {"tract_fraction": F.try_divide(both, size), "target_fraction": F.try_divide(both, span), "unit_inflation": F.col("path_ratio"), "score_density": dense} | {c: F.col(c) for c in ("edit_fraction", "insertion_fraction", "deletion_fraction")}
    return rows.select("read_id", "attempt_no", *[F.round(v, 6).alias(n) for n, v in shares.items()], kind.alias("technical_class"), F.concat_ws(";", *[F.when(w, n) for n, w in flags.items()]).alias("flags"))
