"""Queries of scans by seeds: windows under their locus's own motif, and reads under every catalog motif."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import seeds
from .common import register
from .sequence_queries import COMP

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)

#: Every window with both strands of a motif, all phases, without seeds: hits, runs of hits and the best stretch.
SCANNED = f"""b AS (SELECT read_id, motif, strand, seq, CASE strand WHEN '-' THEN {COMP.format('motif')} ELSE motif END AS unit, unnest(range(len(seq)))::INT AS pos FROM laid),
      h AS (SELECT read_id, motif, strand, phase, pos, substr(seq, pos + 1, 1) = substr(unit, (pos + phase) % len(unit) + 1, 1) AS hit FROM (SELECT *, unnest(range(len(unit)))::INT AS phase FROM b)),
      g AS (SELECT *, pos - row_number() OVER (PARTITION BY read_id, motif, strand, phase ORDER BY pos) AS g FROM h WHERE hit),
      n AS (SELECT read_id, motif, strand, phase, max(n) AS run_bp FROM (SELECT read_id, motif, strand, phase, count(*) AS n FROM g GROUP BY read_id, motif, strand, phase, g) GROUP BY ALL HAVING max(n) >= 8)"""


@query(
    "periodic_segment_scan_by_seeds", "jobs",
    f"""WITH laid AS (SELECT read_id, motif, window_seq AS seq, unnest(['+', '-']) AS strand FROM jobs), {SCANNED},
      x AS (SELECT h.*, run_bp, CASE WHEN hit THEN 2 ELSE -3 END AS v, sum(CASE WHEN hit THEN 2 ELSE -3 END) OVER (PARTITION BY read_id, motif, strand, phase ORDER BY pos) AS prefix FROM h JOIN n USING (read_id, motif, strand, phase)),
      y AS (SELECT *, min(struct_pack(p := (prefix - v)::BIGINT, start := pos)) OVER (PARTITION BY read_id, motif, strand, phase ORDER BY pos) AS low FROM x),
      z AS (SELECT read_id, motif, strand, phase, run_bp, low.start AS start, pos + 1 AS stop, (prefix - low.p)::BIGINT AS score FROM y)
      SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY read_id, motif, strand, phase ORDER BY score DESC, start, stop) = 1""",
)
def _(jobs):
    """The projected windows under their own locus's motif, both strands, every phase with 8 motif bases in a row."""
    windows = jobs.select("read_id", "motif", F.col("window_seq").alias("seq"))
    return seeds.scan_by_seeds(windows, windows, "read_id", own="motif").withColumn("score", F.col("score").cast("long")).withColumnRenamed("end", "stop")


@query(
    "exact_periodic_run_by_seeds", "reads targets",
    f"""WITH laid AS (SELECT read_id, seq, motif, unnest(['+', '-']) AS strand FROM reads, (SELECT DISTINCT motif FROM targets)), {SCANNED} SELECT read_id, motif, strand, max(run_bp)::BIGINT AS run_bp FROM n GROUP BY ALL""",
)
def _(reads, targets):
    """Every catalog motif in every read, both strands, where 8 of its bases stand in a row."""
    return seeds.longest_by_seeds(reads, targets, "read_id")
