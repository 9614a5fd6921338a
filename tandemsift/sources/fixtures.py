"""Stand-in tables for reads, alignments, targets and calls, derived by SQL from the driver's tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..operators.assignment import alignment_target_candidates

BASES = "'0123456789abcdef', 'ACGTACGTACGTACGT'"
MOTIF = "CASE {} % 6 WHEN 0 THEN 'CAG' WHEN 1 THEN 'AAG' WHEN 2 THEN 'GCC' WHEN 3 THEN 'AT' WHEN 4 THEN 'A' ELSE 'CCTG' END"

#: The same text runs on Spark and DuckDB; names are other views or the driver's tables.
VIEWS = {
    "reads": f"SELECT o_orderkey AS read_id, concat(translate(md5(concat('L', cast(o_orderkey AS varchar(32)))), {BASES}), repeat({MOTIF.format('o_custkey')}, cast(3 + o_orderkey % 9 AS int)), translate(md5(concat('R', cast(o_orderkey AS varchar(32)))), {BASES})) AS seq FROM orders",
    "lines": "SELECT *, cast(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS int) AS ordinal FROM lineitem",
    "alignments": "SELECT l_orderkey AS read_id, ordinal, concat('chr', cast(1 + l_suppkey % 5 AS varchar(32))) AS chrom, (l_partkey * 37) % 20000 AS ref_start, CASE WHEN ordinal = 1 THEN 'primary' WHEN ordinal % 2 = 0 THEN 'secondary' ELSE 'supplementary' END AS alignment_class, CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand, cast(l_partkey % 61 AS int) AS mapq, concat(cast(cast(l_quantity AS int) AS varchar(32)), 'S30M', cast(1 + l_partkey % 7 AS varchar(32)), 'I25M', cast(100 + l_suppkey % 50 AS varchar(32)), 'N20M', cast(1 + l_suppkey % 4 AS varchar(32)), 'D40M') AS cigar FROM lines",
    "targets": f"SELECT concat('T', cast(p_partkey AS varchar(32))) AS target_region_id, CASE WHEN p_partkey % 10 = 0 THEN 'DISEASE' ELSE 'CATALOG' END AS target_source, concat('chr', cast(1 + p_partkey % 5 AS varchar(32))) AS chrom, (p_partkey * 41) % 20000 AS start_pos, (p_partkey * 41) % 20000 + 6 + p_size AS end_pos, {MOTIF.format('p_partkey')} AS motif FROM part",
    "segments": f"SELECT l_orderkey AS read_id, concat('T', cast(l_partkey AS varchar(32))) AS target_region_id, ordinal AS attempt_no, (l_partkey * 7 + ordinal * 13) % 90 AS seg_start, (l_partkey * 7 + ordinal * 13) % 90 + 4 + cast(l_quantity AS int) AS seg_end, {MOTIF.format('l_suppkey')} AS canonical_motif, CASE WHEN l_returnflag = 'N' THEN 'SPAN' WHEN l_returnflag = 'A' THEN 'LEFT_ANCHORED_CENSORED_RIGHT' ELSE 'UNRESOLVED' END AS evidence_class, round(1.0 - l_discount * 3, 6) AS purity, cast(l_partkey % 61 AS int) AS mapq, CASE WHEN ordinal = 1 THEN 'P1' ELSE 'P2' END AS cohort FROM lines",
    "blocks": "SELECT l_orderkey AS read_id, ordinal, concat('chr', cast(1 + l_suppkey % 5 AS varchar(32))) AS chrom, 0 AS block_index, (l_partkey * 37) % 20000 AS block_start, (l_partkey * 37) % 20000 + 55 AS block_end FROM lines UNION ALL SELECT l_orderkey, ordinal, concat('chr', cast(1 + l_suppkey % 5 AS varchar(32))), 1, (l_partkey * 37) % 20000 + 155 + l_suppkey % 50, (l_partkey * 37) % 20000 + 216 + l_suppkey % 50 + l_suppkey % 4 FROM lines",
    "candidates": "SELECT b.read_id, b.ordinal, t.target_source, t.target_region_id, sum(greatest(0, least(b.block_end, t.end_pos) - greatest(b.block_start, t.start_pos))) AS target_overlap_bp, min(greatest(0, greatest(b.block_start - t.end_pos, t.start_pos - b.block_end))) AS target_distance_bp, count(DISTINCT b.block_index) AS supporting_block_count FROM blocks b JOIN targets t ON b.chrom = t.chrom AND b.block_start - 50 < t.end_pos AND b.block_end + 50 > t.start_pos GROUP BY b.read_id, b.ordinal, t.target_source, t.target_region_id",
    "paf_rows": "SELECT concat('Q', cast(l_orderkey AS varchar(32))) AS query_name, 120 AS query_length, cast(l_partkey % 15 AS int) AS query_start, cast(70 + l_partkey % 50 AS int) AS query_end, CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand, concat('T', cast(l_partkey AS varchar(32))) AS target_name, 150 AS target_length, cast(l_suppkey % 15 AS int) AS target_start, cast(60 + l_suppkey % 90 AS int) AS target_end, cast(40 + l_quantity AS int) AS residue_matches, 100 AS alignment_block_length, cast(l_partkey % 61 AS int) AS mapq, ordinal FROM lines",
    "gtf_rows": "SELECT concat('chr', cast(1 + p_partkey % 5 AS varchar(32))) AS chrom, CASE p_partkey % 4 WHEN 0 THEN 'gene' WHEN 1 THEN 'exon' WHEN 2 THEN 'CDS' ELSE 'UTR' END AS feature, (p_partkey * 53) % 20000 + 1 AS start_1based, (p_partkey * 53) % 20000 + 10 + p_size AS end_1based, CASE WHEN (p_partkey % 40) < 20 THEN '+' ELSE '-' END AS strand, concat('tx', cast(p_partkey % 40 AS varchar(32))) AS transcript_id FROM part",
    # catalog entries of which some repeat the coordinates of another, with another motif
    "listed_targets": "SELECT target_region_id, chrom, start_pos, end_pos, motif FROM targets UNION ALL SELECT concat('A', target_region_id), chrom, start_pos, end_pos, CASE WHEN motif = 'CAG' THEN 'CTG' ELSE 'CAG' END FROM targets WHERE (end_pos - start_pos) % 9 = 0",
    # tracts of a target's motif, from any phase and on both strands, with bases left out, put in and replaced; some are a read's own
    "edited_tracts": "SELECT read_id, attempt_no, evidence_class, seg_start, seg_end, mapq, motif, span, CASE WHEN mapq % 6 = 5 THEN own WHEN read_id % 2 = 1 THEN reverse(translate(edited, 'ACGT', 'TGCA')) ELSE edited END AS tract FROM (SELECT *, CASE mapq % 6 WHEN 0 THEN u WHEN 1 THEN concat(substr(u, 1, k), substr(u, k + 2)) WHEN 2 THEN concat(substr(u, 1, k), 'T', substr(u, k + 1)) WHEN 3 THEN concat(substr(u, 1, k), 'G', substr(u, k + 2)) ELSE concat('C', substr(u, 1, k), substr(u, k + 3), 'AC') END AS edited FROM (SELECT s.*, t.motif, t.end_pos - t.start_pos AS span, cast(3 + s.read_id % 11 AS int) AS k, substr(repeat(t.motif, 60), cast(1 + s.attempt_no % 3 AS int), cast(t.end_pos - t.start_pos AS int)) AS u, substr(r.seq, cast(s.seg_start + 1 AS int), cast(s.seg_end - s.seg_start AS int)) AS own FROM segments s JOIN targets t ON s.target_region_id = t.target_region_id JOIN reads r ON r.read_id = s.read_id) q) e",
    # one call job for each read: its window around the projected target, what its flanks allow, and the target
    "jobs": "SELECT s.read_id, s.seg_start, s.seg_end, s.purity, t.target_region_id, t.target_source, t.motif, t.end_pos - t.start_pos AS span, p.strand, CASE WHEN p.mapq >= 5 THEN p.query_start END AS projected_start, CASE WHEN p.mapq >= 5 THEN p.query_end END AS projected_end, greatest(0, p.query_start - 10) AS window_start, substr(r.seq, cast(greatest(0, p.query_start - 10) + 1 AS int), cast(p.query_end - p.query_start + 20 AS int)) AS window_seq, r.seq AS seq, p.target_end - p.target_start > 40 AS meets, p.query_start >= 5 AS has_left, p.query_end <= 110 AS has_right, p.query_start % 3 > 0 AS clip, CASE WHEN p.target_start % 2 = 0 THEN 'RIGHT' ELSE 'LEFT' END AS side FROM segments s JOIN targets t ON s.target_region_id = t.target_region_id JOIN paf_rows p ON p.query_name = concat('Q', cast(s.read_id AS varchar(32))) AND p.ordinal = s.attempt_no JOIN reads r ON r.read_id = s.read_id WHERE s.attempt_no = 1",
    # alignments of eight shapes: clips of both kinds on either side, =, X, P, several skips, operations in other orders
    "shapes": "SELECT read_id, ordinal, chrom, ref_start, alignment_class, strand, mapq, CASE read_id % 8 WHEN 0 THEN concat(cast(5 + mapq % 9 AS varchar(32)), 'H', cast(3 + mapq AS varchar(32)), 'S40M2I30M') WHEN 1 THEN concat('25=1X20=', cast(1 + mapq % 4 AS varchar(32)), 'D30=', cast(2 + mapq AS varchar(32)), 'S') WHEN 2 THEN concat('20M', cast(60 + mapq AS varchar(32)), 'N15M80N35M7S4H') WHEN 3 THEN '4S10M3D2I10M1P20M5D25M6S' WHEN 4 THEN concat('80M', cast(4 + mapq AS varchar(32)), 'H') WHEN 5 THEN '12I40=3N2X38=' WHEN 6 THEN concat(cast(1 + mapq AS varchar(32)), 'S30M50N8D30M2I5N20M') ELSE '90M' END AS cigar FROM alignments",
    # motifs of every kind, spread over the rows of part
    "motifs": "SELECT p_partkey, CASE p_partkey % 10 WHEN 0 THEN 'CAG' WHEN 1 THEN 'CTG' WHEN 2 THEN 'AGC' WHEN 3 THEN 'AAG' WHEN 4 THEN 'CAGCAG' WHEN 5 THEN 'ATAT' WHEN 6 THEN 'A' WHEN 7 THEN 'GCN' WHEN 8 THEN 'CCTG' ELSE 'AAAAG' END AS motif, CASE p_partkey % 7 WHEN 0 THEN 'CAG' WHEN 1 THEN 'GCA' WHEN 2 THEN 'TTTTC' WHEN 3 THEN 'CTG' WHEN 4 THEN 'AT' WHEN 5 THEN 'CAGG' ELSE 'GCC' END AS other FROM part",
}
REFERRED = re.compile(r"\b(FROM|JOIN) (\w+)")


def candidates(blocks: DataFrame, targets: DataFrame) -> DataFrame:
    """The candidates view by bins: targets that a read's blocks overlap or come within 50 bases of."""
    return alignment_target_candidates(blocks, targets).drop("candidate_basis")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in table, or one of the driver's."""
    if name == "candidates":
        return candidates(*(view(spark, sf_dir, n) for n in ("blocks", "targets")))
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needs = {m[1]: view(spark, sf_dir, m[1]) for m in REFERRED.findall(VIEWS[name])}
    return spark.sql(REFERRED.sub(r"\1 {\2}", VIEWS[name]), **needs)


def with_views(*names: str, recursive: bool = False) -> str:
    """The WITH clause that gives an oracle the named views."""
    order: list[str] = []

    def add(name: str) -> None:
        for _, other in REFERRED.findall(VIEWS[name]):
            if other in VIEWS and other not in order:
                add(other)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return f"WITH {'RECURSIVE ' * recursive}" + ", ".join(f"{n} AS ({VIEWS[n]})" for n in order)
