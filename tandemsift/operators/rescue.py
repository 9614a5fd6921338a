"""Decisions on clips that face a target and on their local alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .intervals import top_row

#: The outcomes of a bridge alignment, worst first.
BRIDGE = (
    "NO_CANDIDATE_ALIGNMENT", "ORIENTATION_INCONSISTENT_BRIDGE", "ALIGNMENT_NOT_CONNECTED_TO_BLOCK_BOUNDARY", "LOW_QUALITY_BRIDGE_ALIGNMENT", "BRIDGE_STOPS_BEFORE_TARGET_ENTRY", "BRIDGE_REACHES_TARGET_ENTRY",
)


def bridge_decision(rows: DataFrame, entry: int, identity: float = 0.7, coverage: float = 0.7, tolerance: int = 10, entry_bp: int = 12) -> DataFrame:
    """Whether an alignment from a block's edge, both sides turned toward the target, reaches into the target.

    Rows of mapping quality 0 count as no alignment. Adds identity, coverage, priority and bridge_status.
    """
    rows = rows.withColumns({"identity": F.col("residue_matches") / F.col("alignment_block_length"), "coverage": (F.col("query_end") - F.col("query_start")) / F.col("query_length")})
    priority = (
        F.when(F.col("mapq") == 0, 0)
        .when(F.col("strand") != "+", 1)
        .when((F.col("query_start") > tolerance) | (F.col("target_start") > tolerance), 2)
        .when((F.col("identity") < identity) | (F.col("coverage") < coverage), 3)
        .when(F.col("target_end") < entry + entry_bp, 4)
        .otherwise(5)
    )
    names = F.array(*[F.lit(n) for n in BRIDGE])
    return rows.withColumn("priority", priority).withColumn("bridge_status", F.get(names, F.col("priority")))


def best_pair(decided: DataFrame) -> DataFrame:
    """The best alignment of each clip by outcome, matches, coverage, identity and quality; ties to the lowest ordinal."""
    return top_row(decided, ["query_name"], [F.desc("priority"), F.desc("residue_matches"), F.desc("coverage"), F.desc("identity"), F.desc("mapq"), F.asc("ordinal")])


def clip_evidence(rows: DataFrame) -> DataFrame:
    """rows[strand, projected, motif, tract_bp, reaches_end, side] -> status, evidence, sizing and lower bound.

    One flank never measures an allele: a tract to the read's end is a lower bound, one inside it partial.
    """
    status = (
        F.when(F.col("strand") != "+", "REJECT_ORIENTATION_INCONSISTENT_BRIDGE")
        .when(~F.col("projected"), "REJECT_TARGET_ENTRY_NOT_PROJECTED")
        .when(F.length("motif") == 1, "HOMOPOLYMER_REVIEW_NO_STANDARD_P3_EVIDENCE")
        .when(F.coalesce("tract_bp", F.lit(0)) == 0, "ORIENTATION_VALID_BRIDGE_ONLY_NO_REPEAT_TRACT")
        .when(F.col("reaches_end"), "P3_CENSORED_LOWER_BOUND")
        .otherwise("P3_PARTIAL_INTERNAL")
    )
    rows = rows.withColumn("primary_status", status)
    censored, partial, right = F.col("primary_status") == "P3_CENSORED_LOWER_BOUND", F.col("primary_status") == "P3_PARTIAL_INTERNAL", F.col("side") == "RIGHT"
    evidence = (
        F.when(censored & right, "LEFT_ANCHORED_CENSORED_RIGHT").when(censored, "RIGHT_ANCHORED_CENSORED_LEFT").when(partial & right, "LEFT_ONLY_INTERNAL").when(partial, "RIGHT_ONLY_INTERNAL").otherwise("UNRESOLVED")
    )
    sizing = F.when(censored, "lower_bound").when(partial, "partial_internal").otherwise("no_call")
    return rows.withColumns({"evidence_class": evidence, "sizing_status": sizing, "lower_bound_bp": F.when(censored, F.col("tract_bp"))})
