"""What a read's flanks allow to be said about a target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The evidence each geometry may give; all others give none yet.
POTENTIAL = {
    "BOTH_FLANKS_PROJECTABLE": "SPAN_POTENTIAL",
    "LEFT_FLANK_ONLY": "LEFT_ANCHORED_CENSORED_RIGHT_POTENTIAL",
    "RIGHT_FLANK_ONLY": "RIGHT_ANCHORED_CENSORED_LEFT_POTENTIAL",
    "TARGET_INTERNAL_NO_FLANK": "REPEAT_ONLY_UNANCHORED_POTENTIAL",
    "PROXIMAL_RIGHT_WITH_SOFTCLIP": "LEFT_ANCHORED_CENSORED_RIGHT_POTENTIAL",
    "PROXIMAL_LEFT_WITH_SOFTCLIP": "RIGHT_ANCHORED_CENSORED_LEFT_POTENTIAL",
}


def geometry(rows: DataFrame) -> DataFrame:
    """rows[overlaps, left, right, projected, clip, side] -> geometry_class, potential_class, projection_status.

    left and right tell of enough anchor on that flank, side where a target beyond the alignment lies, clip
    whether the read goes on there.
    """
    both = F.col("left") & F.col("right")
    within = (
        F.when(both & F.col("projected"), "BOTH_FLANKS_PROJECTABLE").when(both, "FLANKS_WITHOUT_QUERY_TARGET").when(F.col("left"), "LEFT_FLANK_ONLY").when(F.col("right"), "RIGHT_FLANK_ONLY").otherwise("TARGET_INTERNAL_NO_FLANK")
    )
    anchored = F.when(F.col("side") == "RIGHT", F.col("left")).otherwise(F.col("right"))
    beyond = F.when(anchored, F.concat(F.lit("PROXIMAL_"), "side", F.when(F.col("clip"), "_WITH_SOFTCLIP").otherwise("_NO_SOFTCLIP"))).otherwise("PROXIMAL_ONLY")
    table = F.create_map(*[F.lit(x) for item in POTENTIAL.items() for x in item])
    named = rows.withColumn("geometry_class", F.when(F.col("overlaps"), within).otherwise(beyond))
    potential = F.coalesce(F.try_element_at(table, "geometry_class"), F.lit("NOT_YET_CLASSIFIABLE"))
    return named.withColumns({"potential_class": potential, "projection_status": F.when(F.col("geometry_class").isin(*POTENTIAL), "PASS").otherwise("WARN")})
