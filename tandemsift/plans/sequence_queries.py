"""Queries of the sequence, motif and interval expressions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import sequences as s
from ..operators import laid
from ..operators.spread import spread
from .common import register

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)
COMP = "reverse(translate(upper({0}), 'ACGTRYSWKMBDHVN', 'TGCAYRSWMKVHDBN'))"
ROT = "list_transform(range(1, len({0}) + 1), lambda i: substr({0}, i) || substr({0}, 1, i - 1))"
PRIM = "substr({0}, 1, list_filter(range(1, len({0}) + 1), lambda p: len({0}) % p = 0 AND repeat(substr({0}, 1, p), len({0}) // p) = {0})[1]::INT)"


def canon(unit: str) -> str:
    return f"list_min(list_concat({ROT.format(unit)}, {ROT.format('(' + COMP.format(unit) + ')')}))"


@query("reverse_complement", "reads", f"SELECT read_id, {COMP.format('seq')} AS rc FROM reads")
def _(reads):
    return reads.select("read_id", s.reverse_complement(F.col("seq")).alias("rc"))


@query("motif_rotations", "motifs", f"SELECT p_partkey, array_to_string({ROT.format('motif')}, ',') AS rotations FROM motifs")
def _(motifs):
    return motifs.select("p_partkey", F.array_join(s.rotations(F.col("motif")), ",").alias("rotations"))


@query("primitive_motif", "motifs", f"SELECT p_partkey, {PRIM.format('motif')} AS unit FROM motifs")
def _(motifs):
    return motifs.select("p_partkey", s.primitive_motif(F.col("motif")).alias("unit"))


@query(
    "canonical_motif", "motifs",
    f"WITH u AS (SELECT p_partkey, motif, {PRIM.format('motif')} AS unit FROM motifs) SELECT p_partkey, {canon('unit')} AS canonical, {canon('motif')} AS canonical_whole FROM u",
)
def _(motifs):
    return motifs.select("p_partkey", s.canonical_motif(F.col("motif")).alias("canonical"), s.canonical_motif(F.col("motif"), False).alias("canonical_whole"))


@query(
    "motif_relation", "motifs",
    f"""WITH u AS (SELECT p_partkey, motif, other, {PRIM.format('motif')} AS ua, {PRIM.format('other')} AS ub FROM motifs)
    SELECT p_partkey, CASE WHEN {canon('motif')} = {canon('other')} THEN 'STRICT_DIHEDRAL_EQUIVALENT'
      WHEN {canon('ua')} = {canon('ub')} THEN 'PRIMITIVE_DIHEDRAL_EQUIVALENT' ELSE 'MOTIF_MISMATCH' END AS relation FROM u""",
)
def _(motifs):
    return motifs.select("p_partkey", s.motif_relation(F.col("motif"), F.col("other")).alias("relation"))


@query(
    "iupac_motif_match", "motifs",
    f"""WITH w AS (SELECT p_partkey, other, motif, unnest(list_concat({ROT.format('motif')}, {ROT.format('(' + COMP.format('motif') + ')')})) AS way FROM motifs)
    SELECT p_partkey, bool_or(len(motif) = len(other) AND regexp_full_match(other, replace(way, 'N', '[ACGT]'))) AS compatible FROM w GROUP BY p_partkey""",
)
def _(motifs):
    return motifs.select("p_partkey", s.iupac_match(F.col("motif"), F.col("other")).alias("compatible"))


@query(
    "split_motif_tokens", "part",
    r"""WITH t AS (SELECT p_partkey, list_transform(regexp_split_to_array(trim('[' || p_type || '];NA/' || p_type), '[,;/|\s]+'), lambda x: upper(regexp_replace(x, '^[\[\]]+|[\[\]]+$', '', 'g'))) AS l FROM part),
    f AS (SELECT p_partkey, list_filter(l, lambda x: x NOT IN ('', '.', 'NA', 'N/A', 'NONE', 'NULL', 'NAN')) AS l FROM t)
    SELECT p_partkey, array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda i: list_position(l, l[i]) = i), lambda i: l[i]), ',') AS motifs FROM f""",
)
def _(part):
    text = F.concat(F.lit("["), "p_type", F.lit("];NA/"), "p_type")
    return part.select("p_partkey", F.array_join(s.split_motifs(text), ",").alias("motifs"))


@query(
    "infer_motif_from_locus_id", "targets",
    "SELECT target_region_id, CASE WHEN start_pos % 3 = 0 THEN NULL ELSE motif END AS inferred FROM targets",
)
def _(targets):
    locus = F.concat_ws("-", "chrom", "start_pos", "end_pos", F.when(F.col("start_pos") % 3 == 0, F.lit("x1")).otherwise(F.col("motif")))
    return targets.select("target_region_id", s.motif_of_locus_id(locus).alias("inferred"))


@query(
    "motif_alphabet_class", "motifs",
    """SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'NONE' WHEN p_partkey % 13 = 0 THEN 'UNSUPPORTED_SYMBOL'
      WHEN contains(motif, 'N') THEN 'IUPAC_DEGENERATE' ELSE 'ACGT_ONLY' END AS alphabet FROM motifs""",
)
def _(motifs):
    listed = F.when(F.col("p_partkey") % 11 == 0, F.lit("")).when(F.col("p_partkey") % 13 == 0, F.concat("motif", F.lit(",X1"))).otherwise(F.concat_ws(",", "motif", "other"))
    return motifs.select("p_partkey", s.alphabet_class(s.split_motifs(listed)).alias("alphabet"))


@query(
    "mean_phred_quality", "orders",
    "SELECT o_orderkey, list_sum(list_transform(range(1, 33), lambda i: ascii(substr(md5(o_orderkey::VARCHAR), i, 1)) - 33))::DOUBLE / 32 AS mean_q FROM orders",
)
def _(orders):
    return orders.select("o_orderkey", s.mean_quality(F.md5(F.col("o_orderkey").cast("string"))).alias("mean_q"))


@query(
    "sequence_complexity", "reads",
    """WITH b AS (SELECT read_id, unnest(range(1, len(seq) + 1)) AS i, seq FROM reads),
    c AS (SELECT read_id, seq, i, substr(seq, i, 1) AS base, substr(seq, i, 3) AS kmer FROM b),
    n AS (SELECT read_id, base, count(*) AS n, any_value(len(seq)) AS size FROM c GROUP BY ALL),
    e AS (SELECT read_id, round(sum(-(n::DOUBLE / size) * log2(n::DOUBLE / size)), 6) AS entropy, first(base ORDER BY n DESC, base) AS dominant_base, round(max(n)::DOUBLE / any_value(size), 6) AS dominant_fraction FROM n GROUP BY read_id),
    k AS (SELECT read_id, round(count(DISTINCT CASE WHEN len(kmer) = 3 THEN kmer END)::DOUBLE / least(64, any_value(len(seq)) - 2), 6) AS kmer_fraction FROM c GROUP BY read_id),
    g AS (SELECT *, i - row_number() OVER (PARTITION BY read_id, base ORDER BY i) AS g FROM c),
    h AS (SELECT read_id, base, g, count(*) AS n, min(i) AS pos FROM g GROUP BY ALL),
    m AS (SELECT read_id, max(n) AS homopolymer_bp, first(base ORDER BY n DESC, pos) AS homopolymer_base FROM h GROUP BY read_id)
    SELECT * FROM e JOIN k USING (read_id) JOIN m USING (read_id)""",
)
def _(reads):
    c = F.col("c")
    found = reads.select("read_id", s.complexity(F.col("seq")).alias("c"))
    most = F.greatest(*[c[f"fraction_{b}"] for b in "acgtn"])
    return found.select(
        "read_id", F.round(c["entropy"], 6).alias("entropy"), c["dominant_base"].alias("dominant_base"), F.round(most, 6).alias("dominant_fraction"),
        F.round(c["kmer_fraction"], 6).alias("kmer_fraction"), c["homopolymer_bp"].cast("long").alias("homopolymer_bp"), c["homopolymer_base"].alias("homopolymer_base"),
    )


PURITY = f"""w AS (SELECT read_id, seq, 'CAG' AS motif, unnest(list_distinct(list_concat({ROT.format("'CAG'")}, {ROT.format("'CTG'")}))) AS way FROM {{0}}),
    p AS (SELECT read_id, way, len(list_filter(range(1, len(seq) + 1), lambda i: substr(seq, i, 1) = substr(way, (i - 1) % 3 + 1, 1))) AS n, len(seq) AS size FROM w)"""


@query(
    "phase_purity", "reads",
    f"WITH {PURITY.format('reads')} SELECT read_id, round(max(n)::DOUBLE / any_value(size), 6) AS purity, first(way ORDER BY n DESC, way) AS orientation FROM p GROUP BY read_id",
)
def _(reads):
    found = laid.purities(spread(reads.select("read_id", "seq", F.lit("CAG").alias("motif")), "read_id"), "seq", "motif")
    return found.select("read_id", F.round("purity", 6).alias("purity"), "orientation")


@query(
    "diagnostic_windows", "reads",
    """WITH s AS (SELECT read_id, seq, unnest(range(0, len(seq), 20)) AS start FROM reads),
    i AS (SELECT read_id, start, least(len(seq), start + 40) AS stop, substr(seq, start + 1, least(len(seq), start + 40) - start) AS part FROM s WHERE start = 0 OR start - 20 + 40 < len(seq)),
    k AS (SELECT * FROM i WHERE stop - start >= 20),
    w AS (SELECT read_id, start, stop, part, unnest(['CAG', 'AGC', 'GCA', 'CTG', 'TGC', 'GCT']) AS way FROM k),
    p AS (SELECT read_id, start, stop, max(len(list_filter(range(1, len(part) + 1), lambda j: substr(part, j, 1) = substr(way, (j - 1) % 3 + 1, 1)))::DOUBLE / len(part)) AS purity FROM w GROUP BY ALL)
    SELECT read_id, count(*) AS windows, count(*) FILTER (purity >= 0.7) AS repeat_like, first(start ORDER BY purity DESC, stop - start DESC, start)::INT AS best_start,
      first(stop ORDER BY purity DESC, stop - start DESC, start)::INT AS best_end, round(max(purity), 6) AS best_purity FROM p GROUP BY read_id""",
)
def _(reads):
    """Windows of 40 every 20 bases, the last cut at the end; those below 20 bases don't count."""
    size, width, step, least, like = F.length("seq"), 40, 20, 20, 0.7
    starts = F.filter(F.sequence(F.lit(0), size - 1, F.lit(step)), lambda a: (a == 0) | (a - step + width < size))
    windows = reads.select("read_id", "seq", F.explode(starts).alias("start")).withColumn("end", F.least(F.length("seq"), F.col("start") + width))
    windows = windows.filter(F.col("end") - F.col("start") >= least)
    part = F.substring(F.col("seq"), F.col("start") + 1, F.col("end") - F.col("start"))
    scored = windows.withColumn("purity", s.phase_purity(part, F.lit("CAG"))["purity"])
    best = F.max_by(F.struct("start", "end"), F.struct("purity", F.col("end") - F.col("start"), -F.col("start")))
    found = scored.groupBy("read_id").agg(F.count("*").alias("windows"), F.count_if(F.col("purity") >= like).alias("repeat_like"), best.alias("b"), F.round(F.max("purity"), 6).alias("best_purity"))
    return found.select("read_id", "windows", "repeat_like", F.col("b.start").alias("best_start"), F.col("b.end").alias("best_end"), "best_purity")


@query(
    "interval_overlap_distance", "paf_rows",
    """SELECT query_name, ordinal, CASE WHEN query_start < target_end AND target_start < query_end THEN least(query_end, target_end) - greatest(query_start, target_start) ELSE 0 END AS overlap_bp,
      CASE WHEN query_end <= target_start THEN target_start - query_end WHEN target_end <= query_start THEN query_start - target_end ELSE 0 END AS distance_bp,
      round(CASE WHEN query_start < target_end AND target_start < query_end THEN least(query_end, target_end) - greatest(query_start, target_start) ELSE 0 END / (query_end - query_start)::DOUBLE, 6) AS query_fraction FROM paf_rows""",
)
def _(paf):
    ends = [F.col(c) for c in ("query_start", "query_end", "target_start", "target_end")]
    both = s.overlap(*ends)
    return paf.select("query_name", "ordinal", both.alias("overlap_bp"), s.distance(*ends).alias("distance_bp"), F.round(both / (F.col("query_end") - F.col("query_start")), 6).alias("query_fraction"))


@query(
    "parse_coordinate_text", "targets",
    """WITH t AS (SELECT target_region_id, CASE WHEN start_pos % 4 = 0 THEN 'nowhere' ELSE chrom END AS chrom, start_pos, end_pos FROM targets), u AS (
      SELECT target_region_id, chrom, start_pos AS start, end_pos AS stop, 'ZERO_BASED' AS convention FROM t UNION ALL SELECT target_region_id, chrom, start_pos - 1, end_pos, 'ONE_BASED' FROM t)
    SELECT target_region_id, chrom, start::BIGINT AS start, stop::BIGINT AS stop, convention FROM u WHERE chrom <> 'nowhere' AND start >= 0""",
)
def _(targets):
    text = F.when(F.col("start_pos") % 4 == 0, F.lit("no coordinates")).otherwise(F.concat(F.col("chrom"), F.lit(":"), F.col("start_pos"), F.lit("-"), F.col("end_pos")))
    found = targets.select("target_region_id", F.explode(s.coordinates(text)).alias("c"))
    return found.select("target_region_id", "c.chrom", "c.start", F.col("c.end").alias("stop"), "c.convention")


@query("stable_id", "lines", "SELECT l_orderkey, ordinal, substr(sha256(l_orderkey::VARCHAR || '|' || l_partkey || '|' || ordinal), 1, 24) AS id FROM lines")
def _(lines):
    return lines.select("l_orderkey", "ordinal", s.stable_id(F.col("l_orderkey"), F.col("l_partkey"), F.col("ordinal")).alias("id"))


@query(
    "duplicate_ordinal", "lineitem",
    """SELECT l_orderkey, l_linenumber, n::INT AS ordinal, count(*) AS rows FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS n FROM lineitem) GROUP BY ALL""",
)
def _(lineitem):
    """0-based place of a row among those with its signature, in the order of its other columns."""
    same = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    numbered = lineitem.withColumn("ordinal", F.row_number().over(same) - 1)
    return numbered.groupBy("l_orderkey", "l_linenumber", "ordinal").agg(F.count("*").alias("rows"))


@query(
    "strict_boolean_optional_int", "orders",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN false END AS flag,
      CASE WHEN o_orderkey % 4 = 0 THEN o_custkey END AS value, o_orderkey % 4 < 3 AND o_orderkey % 4 <> 1 AS ok FROM orders""",
)
def _(orders):
    k = F.col("o_orderkey")
    flag = F.element_at(F.array(F.lit(" TRUE"), F.lit("1"), F.lit("no"), F.lit("False "), F.lit("maybe")), (k % 5 + 1).cast("int"))
    number = F.element_at(F.array(F.col("o_custkey").cast("string"), F.lit("-3"), F.lit(" . "), F.lit("x")), (k % 4 + 1).cast("int"))
    parsed = s.optional_int(number)
    return orders.select("o_orderkey", s.strict_boolean(flag).alias("flag"), parsed["value"].alias("value"), parsed["ok"].alias("ok"))


@query(
    "length_bins", "part",
    """SELECT p_partkey, CASE WHEN p_size % 20 + 1 = 1 THEN '1_homopolymer' WHEN p_size % 20 + 1 IN (2, 3) THEN (p_size % 20 + 1)::VARCHAR WHEN p_size % 20 + 1 < 7 THEN '4_to_6' WHEN p_size % 20 + 1 < 11 THEN '7_to_10' ELSE '11_to_20' END AS motif_bin,
      CASE WHEN p_size * 8 < 12 THEN 'lt_12' WHEN p_size * 8 < 20 THEN '12_to_19' WHEN p_size * 8 < 40 THEN '20_to_39' WHEN p_size * 8 < 80 THEN '40_to_79' WHEN p_size * 8 < 160 THEN '80_to_159' WHEN p_size * 8 < 320 THEN '160_to_319' ELSE 'ge_320' END AS span_bin FROM part""",
)
def _(part):
    return part.select("p_partkey", s.motif_length_bin(F.col("p_size") % 20 + 1).alias("motif_bin"), s.span_length_bin(F.col("p_size") * 8).alias("span_bin"))
