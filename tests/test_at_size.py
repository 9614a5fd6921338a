"""Plans and results that must hold when tables grow."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandemsift.functions import sequences as s
from tandemsift.operators import alignments as al
from tandemsift.operators import assignment as asg
from tandemsift.operators import calling, laid
from tandemsift.operators import consensus as batched
from tandemsift.plans import registry
from tandemsift.sources import package

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["exact_periodic_run_by_motif", "exact_periodic_run_by_seeds", "periodic_segment_scan_by_motif"])
def test_reads_are_not_broadcast(spark, name):
    assert "BroadcastHashJoin [read_id" not in plan(registry.queries()[name](spark, SF))


def test_motifs_in_groups_give_the_same_rows(spark, monkeypatch):
    reads = spark.createDataFrame([(1, "CAGCAGCATTAGA"), (2, "ACAGAAGAAGAG"), (3, ""), (4, None)], "read_id long, seq string")
    motifs = spark.createDataFrame([("CAG", "+"), ("cag", "-"), ("AAG", "+"), ("AT", "-"), ("N", "+"), ("", "+"), (None, "-"), ("X1", "+")], "motif string, strand string")
    rows = reads.select("read_id").crossJoin(motifs)

    def found():
        return sorted(map(str, calling.exact_runs_of_all(reads, motifs).collect())), sorted(map(str, calling.segment_scan_of_all(reads, motifs).collect()))

    one = found()
    monkeypatch.setattr(calling, "BROADCAST_MOTIFS", 2)
    assert found() == one
    assert one[0] == sorted(map(str, calling.exact_runs_by_motif(reads, rows).collect()))
    assert one[1] == sorted(map(str, calling.segment_scan_by_motif(reads, rows).collect()))


def test_motif_relation_is_that_of_canonical_motifs(spark):
    names = ["CAG", "GCA", "CTG", "CAGCAG", "ctgctgctg", "A", "AAA", "T", "AT", "ATAT", "RYN", "NRY", "AAG", "CAGCAGC", "", None, "x-1", "C-AG"]
    pairs = spark.createDataFrame([(a, b) for a in names for b in names], "a string, b string")
    clean = lambda c: F.regexp_replace(F.upper(F.coalesce(F.col(c), F.lit(""))), f"[^{s.CODES}]", "")
    whole, unit = (s.canonical_motif(clean("a"), p) == s.canonical_motif(clean("b"), p) for p in (False, True))
    want = F.when((clean("a") == "") | (clean("b") == ""), "MOTIF_UNAVAILABLE").when(whole, "STRICT_DIHEDRAL_EQUIVALENT").when(unit, "PRIMITIVE_DIHEDRAL_EQUIVALENT").otherwise("MOTIF_MISMATCH")
    relation = s.motif_relation(F.col("a"), F.col("b"))
    assert pairs.filter(~relation.eqNullSafe(want)).collect() == []
    # worked out in a few native functions, not by listing all rotations for each comparison
    assert plan(pairs.select(relation)).count("sequence(") == 0


def test_complexity_is_worked_out_once(spark):
    """Its runs of bases are listed once for a text, and the query asks for it once for a side."""
    df = registry.queries()["residual_context_by_side"](spark, SF)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(") <= 2
    rows = spark.createDataFrame([("AACCCGGG",), ("A",), ("NNAC",), ("",), (None,)], "seq string").select("seq", s.complexity(F.col("seq")).alias("c"))
    got = {r["seq"]: (r["c"]["homopolymer_bp"], r["c"]["homopolymer_base"]) if r["c"] else None for r in rows.collect()}
    assert got == {"AACCCGGG": (3, "C"), "A": (1, "A"), "NNAC": (2, "N"), "": None, None: None}


@pytest.mark.parametrize("name", ["candidate_multiplicity", "disease_region_summary"])
def test_oracle_of_shapes_is_unchanged(name):
    assert "candidates AS (" in registry.oracle_sql()[name]


def test_copies_add_no_pairs_to_counts(spark):
    """Ten times the reads and targets at the same places: the pairs of shapes stay, the counts grow."""
    few = spark.range(8).selectExpr("id AS read_id", "1 AS ordinal", "'chr1' AS chrom", "id % 4 * 100 AS block_start", "id % 4 * 100 + 60 AS block_end")
    loci = spark.range(6).selectExpr("'DISEASE' AS target_source", "concat('T', id) AS target_region_id", "'chr1' AS chrom", "id % 3 * 150 AS start_pos", "id % 3 * 150 + 20 AS end_pos")
    more = few.crossJoin(spark.range(10).withColumnRenamed("id", "c")).withColumn("read_id", F.col("read_id") + 8 * F.col("c")).drop("c")
    many = loci.crossJoin(spark.range(10).withColumnRenamed("id", "c")).withColumn("target_region_id", F.concat_ws("_", "target_region_id", "c")).drop("c")
    assert asg.candidate_shapes(more, many)[2].count() == asg.candidate_shapes(few, loci)[2].count()
    one, ten = ({r["read_id"]: r for r in asg.candidate_counts(*x).collect()} for x in ((few, loci), (more, many)))
    assert len(ten) == 10 * len(one) and all(ten[k + 8 * c]["n"] == 10 * r["n"] for k, r in one.items() for c in range(10))
    totals = [asg.region_counts(*x).agg(F.sum("candidates"), F.sum("reads")).first() for x in ((few, loci), (more, many))]
    assert tuple(totals[1]) == tuple(100 * v for v in totals[0])


def test_consensus_of_batches_is_that_of_rows(spark, monkeypatch):
    """Reads side by side, in groups of any size, give what each gives in its own row."""
    texts = ["", "AC", "ACG", "NNNNNN", "cagcagcagcat", "ACGTTGCANNXACGT" * 5, "A" * 301, "é" * 4 + "ACGACG", None, "GATTACA" * 40]
    reads = spark.createDataFrame(list(enumerate(texts)), "read_id long, seq string")
    size = F.length("seq")
    want = calling.consensus(reads.filter(size >= 3), F.sequence(F.lit(1), F.least(F.lit(50), F.floor(size / 3)).cast("int")))
    rows = sorted(map(str, want.collect()))
    assert sorted(map(str, calling.consensus_all_periods(reads).collect())) == rows
    for cells in (1, 40, 700):
        monkeypatch.setattr(batched, "CELLS", cells)
        sizes = np.array([0, 5, 5, 7, 300, 3, 40])
        parts = list(batched.groups(sizes))
        assert sorted(np.concatenate(parts)) == list(range(7)) and all(len(p) == 1 or len(p) * sizes[p].max() <= cells for p in parts)
    assert "RoundRobin" not in plan(calling.consensus_all_periods(reads)) and "Exchange hashpartitioning(read_id" in plan(calling.consensus_all_periods(reads))


def test_canonical_motifs_of_batches(spark):
    """Canonical motifs come with the consensus, as the column function gives them."""
    texts = ["CAGCAGCAGCAGCAG", "CTGCTGACTGCTGCTG" * 3, "ATATATATATAT", "TTTTTTTTT", "GATTACA" * 10, "ACGTTGCANNXACGT" * 5]
    reads = spark.createDataFrame(list(enumerate(texts)), "read_id long, seq string")
    found = calling.consensus_all_periods(reads, least=0.5)
    assert found.filter(~F.col("canonical_motif").eqNullSafe(calling.canonical(F.col("motif")))).collect() == []
    assert sorted(map(str, found.drop("canonical_motif").collect())) == sorted(map(str, calling.consensus_all_periods(reads).filter("agreement >= 0.5").collect()))


def test_a_package_s_files_are_read_by_many_tasks(spark, tmp_path):
    """One task writes the list; those that read and digest the files are apart from it."""
    spark.range(1000).repartition(5).write.parquet(f"{tmp_path}/a")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    try:
        listed = package.file_list(spark, str(tmp_path), ["a"])
        assert "Exchange" in plan(listed) and "Coalesce" not in plan(listed)
        assert package.files_of(spark, str(tmp_path), ["a"]).rdd.getNumPartitions() > 1
        assert sorted(map(str, listed.collect())) == sorted(map(str, package.files_of(spark, str(tmp_path), ["a"]).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_the_list_of_files_goes_through_it(spark, tmp_path, monkeypatch):
    used = []
    real = package.file_list
    monkeypatch.setattr(package, "file_list", lambda *a: used.append(1) or real(*a))
    package.write_result_package({"a": spark.range(10)}, f"{tmp_path}/p")
    assert used == [1] and package.file_integrity(spark, f"{tmp_path}/p").count() == 0


def test_pairs_of_groups_are_not_shuffled(spark):
    """Between the join of blocks and targets and the result there is no exchange; before, pairs were dealt by read."""
    for name in ("alignment_target_candidates", "read_target_candidates", "multi_block_flag", "select_projection_block", "block_anchor_geometry", "validated_geometry"):
        df = registry.queries()[name](spark, SF)
        text = plan(df)
        assert "Exchange" not in text[: text.index("Join")], name


@pytest.mark.parametrize("repeated", [False, True])
def test_groups_meet_targets_once(spark, repeated):
    """Crowded alignments, some of one read at one place, against pairs put together one by one."""
    rng = np.random.default_rng(7)
    blocks = [(r, o, b, f"chr{rng.integers(2)}", int(s), int(s + rng.integers(1, 90))) for r in range(12) for o in range(1, 4) for b, s in enumerate(rng.integers(0, 500, 4))]
    loci = [("DISEASE", f"T{i % 9 if repeated else i}", f"chr{rng.integers(2)}", int(s), int(s + rng.integers(1, 120))) for i, s in enumerate(rng.integers(0, 500, 15))]
    kinds = {1: "primary", 2: "secondary", 3: "supplementary"}
    own = [(r, o, kinds[o], int(rng.integers(3)), "+") for r in range(12) for o in kinds]
    quality = {(r, o): (k, m) for r, o, k, m, _ in own}
    a = spark.createDataFrame(blocks, "read_id long, ordinal int, block_index int, chrom string, block_start long, block_end long")
    t = spark.createDataFrame(loci, "target_source string, target_region_id string, chrom string, start_pos long, end_pos long")
    found = {}
    for r, o, b, c, s0, s1 in blocks:
        for _, name, tc, e0, e1 in loci:
            if c == tc and max(0, s0 - e1, e0 - s1) <= 49:
                found.setdefault((r, o, name), []).append((max(0, min(s1, e1) - max(s0, e0)), max(0, s0 - e1, e0 - s1), s1 - s0, b))
    want = {k: (sum(x[0] for x in v), min(x[1] for x in v), len(v)) for k, v in found.items()}
    rows = asg.alignment_target_candidates(a, t).collect()
    assert len(rows) == len(want) and {(r[0], r[1], r[3]): tuple(r[4:7]) for r in rows} == want
    best = {k: max((x[0], -x[1], x[2], -x[3]) for x in v) for k, v in found.items()}
    rows = asg.best_block(a, t).collect()
    assert len(rows) == len(best) and {(r[0], r[1], r[2]): (r[4], -r[5], -r[3]) for r in rows} == {k: (v[0], v[1], v[3]) for k, v in best.items()}
    touching = {k: n for k, v in found.items() if (n := sum(x[0] > 0 for x in v))}
    assert {(r[0], r[1], r[2]): r[3] for r in asg.overlapping_blocks(a, t).collect()} == touching
    reads = {}
    for (r, o, name), (covered, apart, _) in want.items():
        kind, mapq = quality[r, o]
        reads.setdefault((r, name), []).append((covered > 0, covered, -apart, asg.CLASS[kind], mapq, -o))
    rows = asg.read_target_candidates(a, t, spark.createDataFrame(own, "read_id long, ordinal int, alignment_class string, mapq int, strand string")).collect()
    assert len(rows) == len(reads)
    for row in rows:
        ways = reads[row["read_id"], row["target_region_id"]]
        top = max(ways)
        assert (row["ordinal"], row["target_overlap_bp"], row["target_distance_bp"], row["supporting_alignment_count"]) == (-top[5], top[1], -top[2], len(ways))
        assert row["primary_support"] == any(w[3] == 3 for w in ways) and row["secondary_support"] == any(w[3] == 1 for w in ways)
    near = {}
    for r, o, b, c, s0, s1 in blocks:
        for _, name, tc, e0, e1 in loci:
            if c == tc and max(0, s0 - e1, e0 - s1) <= 150 and min(s1, e1) <= max(s0, e0):
                ok, x = s1 - s0 >= 40, near.setdefault((r, o, name), [False, False, 0])
                x[0], x[1], x[2] = x[0] or s1 <= e0 and ok, x[1] or s0 >= e1 and ok, x[2] + (not ok)
    rows = asg.flanking(a, t, lambda s, e: e - s >= 40).collect()
    assert len(rows) == len(near) and {(r[0], r[1], r[2]): [r["l"], r["r"], r["refused"]] for r in rows} == near


@pytest.mark.parametrize("name", ["read_paf_alignments", "read_sam_alignments"])
def test_lines_are_split_once(spark, name):
    """Before, the filter of valid rows split a line again for each field that it names."""
    df = registry.queries()[name](spark, SF)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


@pytest.mark.parametrize("name", ["disease_concordance", "crosswalk_tiers", "apply_overrides"])
def test_loci_at_the_same_places_are_paired_once(spark, name, monkeypatch):
    """Four times the loci at the same places: as many rows go into the interval join as before."""
    from tandemsift.plans import catalog_queries, common

    loci = [("DISEASE" if i % 3 == 0 else "CATALOG", f"T{i}", "chr1", i * 37 % 400, i * 37 % 400 + 9 + i % 40, "CAG" if i % 2 else "AT") for i in range(60)]
    loci += [("CATALOG", "T1", "chr1", 300, 330, "CAG"), ("DISEASE", "T3", "chr1", 10, 44, "AT")]  # names given again
    schema = "target_source string, target_region_id string, chrom string, start_pos long, end_pos long, motif string"
    sizes, real = [], catalog_queries.iv.interval_join
    monkeypatch.setattr(catalog_queries.iv, "interval_join", lambda a, b, *x, **y: sizes.append((a.count(), b.count())) or real(a, b, *x, **y))
    results = []
    for times in (1, 4):
        rows = [(s, i if not n else f"{i}_{n}", *rest) for n in range(times) for s, i, *rest in loci]
        monkeypatch.setattr(common, "view", lambda *_, rows=rows: spark.createDataFrame(rows, schema))
        results.append(registry.queries()[name](spark, SF).collect())
    assert sizes[0] == sizes[1]
    if name == "disease_concordance":
        first = {r["q"]: r[1:] for r in results[0]}
        assert {r["q"].split("_")[0]: r[1:] for r in results[1]} == first and len(results[1]) == 4 * len(results[0])
        touching = lambda q: [r for r in loci for d in loci if d[1] == q and d[0] == "DISEASE" and r[0] == "CATALOG" and r[3] - d[4] <= 100 and d[3] - r[4] <= 100]
        assert all((r["r"] is None) == (not touching(r["q"])) for r in results[0])
    elif name == "crosswalk_tiers":
        assert sum(r["loci"] for r in results[0]) == sum(x[0] == "DISEASE" for x in loci)
    else:
        meets = lambda c: {d[1] for d in loci for x in loci if x[1] == c and x[0] == "CATALOG" and d[0] == "DISEASE" and d[3] < x[4] and x[3] < d[4]}
        assert all((r["ids"] or "") == ";".join(sorted(meets(r["target_region_id"]))) for r in results[0])


def shuffled_parts(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_labels_are_batches_in_many_tasks(spark):
    """Reads are dealt to as many tasks as a shuffle has; a read may have more motifs than one byte has signs."""
    df = registry.queries()["label_segments"](spark, SF)
    assert "MapInArrow" in plan(df) and df.rdd.getNumPartitions() == shuffled_parts(spark)
    units = sorted({"".join(u) for u in itertools.product("ACGT", repeat=5)})[:400:2] + ["TTTGC"]
    motifs = spark.createDataFrame([(1, u) for u in units] + [(2, "T-G"), (3, "CAG")], "read_id long, motif string")
    reads = spark.createDataFrame([(1, "TTTGC" * 12), (2, "T-G" * 9), (3, None)], "read_id long, seq string")
    assert [tuple(r) for r in calling.label_segments(reads, motifs, margin=-1.0).collect()] == [(1, "TTTGC", 0, 60)]


def test_entry_tracts_are_batches_in_many_tasks(spark):
    """Clips are dealt to as many tasks as a shuffle has and worked out side by side; an empty motif gives no tract."""
    df = registry.queries()["clip_evidence_by_tract"](spark, SF)
    assert "MapInArrow" in plan(df) and df.rdd.getNumPartitions() == shuffled_parts(spark)
    clips = [(1, "TTTTT" + "CAG" * 500, "cag", 4, True), (2, "CAG" * 9, "", 3, False), (3, "CAG" * 9, "C-G", 3, False), (4, None, "CAG", 3, False), (5, "CAG" * 9, "CTG", 27, False)]
    table = spark.createDataFrame([(i, c, m, e, 0, 2000, r) for i, c, m, e, r in clips], "read_id long, oriented_clip string, motif string, entry int, raw_start int, raw_end int, reverse boolean")
    got = {r.read_id: (r.tract_start, r.tract_end, r.entry_offset, r.tract_raw_start, r.tract_raw_end) for r in calling.entry_tracts(table).collect()}
    assert got == {1: (0, 1505, -4, 495, 2000), 2: (None,) * 5, 3: (None,) * 5, 4: (None,) * 5, 5: (None,) * 5}


@pytest.mark.parametrize("name", ["target_concordance_by_edits", "exact_span_audit_by_edits"])
def test_gapped_alignments_are_batches(spark, name):
    """Tracts are aligned side by side, not base by base in their own rows."""
    found = plan(registry.queries()[name](spark, SF))
    assert "MapInArrow" in found and "aggregate(" not in found


def test_cigars_are_parsed_once_in_batches(spark):
    """Odd CIGARs give no rows; distinct ones are parsed once for all rows of a batch, not walked through row by row."""
    for name in ("cigar_positions", "cigar_positions_by_shape", "project_interval", "project_interval_by_shape", "anchor_bases", "anchor_bases_by_shape"):
        found = plan(registry.queries()[name](spark, SF))
        assert "MapInArrow" in found and "aggregate(" not in found and "regexp_extract_all(" not in found
    odd = [None, "", "M", "5", "5M3", "M5", "5MM", "5Q", "5M é", " 5M", "٣M"]
    rows = [(i, 1, "c", 100, c) for i, c in enumerate(odd)] + [(50, 1, "c", 100, "05S10M2147483647N0I3=")] * 2 + [(51, 1, "c", 7, "1X")]
    table = spark.createDataFrame(rows, "read_id long, ordinal int, chrom string, ref_start long, cigar string")
    got = [(r.read_id, r.op_index, r.op, r.op_len, r.ref_offset, r.query_offset, r.op_ref_start) for r in al.cigar_positions(table).collect()]
    one = [(50, 0, "S", 5, 0, 0, 100), (50, 1, "M", 10, 0, 5, 100), (50, 2, "N", 2147483647, 10, 15, 110), (50, 3, "I", 0, 2147483657, 15, 2147483757), (50, 4, "=", 3, 2147483657, 15, 2147483757)]
    assert sorted(got) == sorted([*one, *one, (51, 0, "X", 1, 0, 0, 7)])
    assert al.cigar_positions(table.limit(0)).collect() == [] and al.cigar_positions(table.filter("read_id < 11")).collect() == []


def test_windows_of_clips_are_batches(spark):
    """No read's letters are broadcast, and windows are counted side by side as phase_purity counts them one by one."""
    found = plan(registry.queries()["bridge_motif_signal_by_windows"](spark, SF))
    assert "MapInArrow" in found and "BroadcastHashJoin [query_name" not in found and "aggregate(" not in found
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices("ACGT", k=rng.randrange(0, 60))) + "CAG" * rng.randrange(0, 40), rng.choice(["CAG", "ctg", "AT", "CCTG", "A"])) for i in range(200)]
    rows += [(900, None, "CAG"), (901, "CAG" * 20, None), (902, "CAG" * 20, ""), (903, "CAG" * 20, "C-G"), (904, "cag" * 20, "CAG")]
    table = spark.createDataFrame(rows, "id long, clip string, motif string")
    starts = F.sequence(F.lit(0), F.greatest(F.length("clip") - 1, F.lit(0)), F.lit(20))
    cut = table.select("*", F.explode(starts).alias("a")).filter("(a = 0 OR a + 20 < length(clip)) AND length(clip) - a >= 20 AND motif <> ''")
    pure = cut.filter(s.phase_purity(F.substring(F.col("clip"), F.col("a") + 1, F.lit(40)), F.col("motif"))["purity"] >= 0.7).groupBy("id").count()
    want = {r["id"]: r["count"] for r in pure.collect()}
    got = {r["id"]: r["windows"] for r in laid.count_like_windows(table, "clip", "motif").collect()}
    assert got == {i: want.get(i, 0) for i, _, _ in rows} and len(want) > 50


def test_stretches_of_batches_are_those_of_rows(spark):
    """Best stretches and runs side by side in Arrow batches, against the fold over one row's hits; before, each row was folded."""
    rng = random.Random(3)
    texts = ["".join(rng.choices("ACGT", k=rng.randint(1, 60))) for _ in range(120)] + ["CAG" * 9 + "T" + "CAG" * 3, "A", "TTTT", "CAGTCAGCAG", "", None]
    rows = [(i, t, u, p) for i, t in enumerate(texts) for u in ("CAG", "A", "AT", "CCTG", "NN") for p in range(len(u))]
    df = spark.createDataFrame(rows, "read_id long, _seq string, _unit string, phase int")
    got = {(r["read_id"], r["_unit"], r["phase"]): tuple(r[c] for c in ("run_bp", "start", "end", "score")) for r in laid.stretches(df, "_seq", "_unit", "phase", 2, -3).collect()}
    own = df.filter("_seq <> ''").withColumns({"_l": s.letters(F.col("_seq")), "_u": s.letters(F.col("_unit"))})
    own = own.withColumn("hits", calling.agreeing(F.col("_u"), F.size("_u"), F.col("phase"))).select("*", calling.longest_run(F.col("hits")).alias("run_bp"), calling.best_stretch(F.col("hits"), 2, -3).alias("b"))
    want = {(r["read_id"], r["_unit"], r["phase"]): (r["run_bp"], r["b"]["start"], r["b"]["end"], r["b"]["score"]) for r in own.collect()}
    assert got == want
    for name in ("caller_sizing_by_context", "periodic_segment_scan_by_seeds"):
        assert "MapInArrow" in plan(registry.queries()[name](spark, SF)), name


def test_crosswalk_ranks_a_span_once(spark, monkeypatch):
    """Disease loci of one span, of whatever motif, go into the interval join once; before, each went by itself."""
    from tandemsift.plans import catalog_queries, common

    loci = [("DISEASE", f"D{i}", "chr1", 100, 130, "CAG" if i % 2 else "AT") for i in range(6)] + [("CATALOG", f"C{i}", "chr1", 90 + i % 2, 121 + i % 2, "CAG") for i in range(4)]
    sizes, real = [], catalog_queries.iv.interval_join
    monkeypatch.setattr(catalog_queries.iv, "interval_join", lambda a, b, *x, **y: sizes.append(a.count()) or real(a, b, *x, **y))
    monkeypatch.setattr(common, "view", lambda *_: spark.createDataFrame(loci, "target_source string, target_region_id string, chrom string, start_pos long, end_pos long, motif string"))
    rows = registry.queries()["locus_crosswalk"](spark, SF).collect()
    assert sizes == [1] and sorted((r["q"], r["rank"], r["r"], r["candidates"]) for r in rows) == sorted((f"D{i}", k + 1, r, 4) for i in range(6) for k, r in enumerate(("C1", "C3", "C0", "C2")))
    assert {r["q"] for r in rows if r["phase_compatible"]} == {"D1", "D3", "D5"}


def test_purities_of_batches_are_those_of_rows(spark):
    """Phase purity of texts side by side in Arrow batches, dealt out by read; before, each base went through lambda functions in one task."""
    rng = random.Random(5)
    texts = ["".join(rng.choices("ACGT", k=rng.randint(1, 50))) for _ in range(60)] + ["CAG" * 9, "GCTGCTG", "cagcag", "ACGN", "é" * 3 + "CAG", "", None]
    rows = [(i, t, m) for i, t in enumerate(texts) for m in ("CAG", "ctg", "AT", "A", "NRY", "C-G", "", None)]
    df = spark.createDataFrame(rows, "read_id long, seq string, motif string")
    want = df.select("read_id", "motif", s.phase_purity(F.col("seq"), F.col("motif")).alias("p")).select("read_id", "motif", "p.*")
    assert sorted(map(str, laid.purities(df, "seq", "motif").select("read_id", "motif", "purity", "orientation").collect())) == sorted(map(str, want.collect()))
    for name in ("reference_motif_identity", "phase_purity"):
        found = plan(registry.queries()[name](spark, SF))
        assert "MapInArrow" in found and "Exchange hashpartitioning(read_id" in found and "zip_with" not in found, name
    assert "zip_with" not in plan(registry.queries()["reference_motif_identity_by_locus"](spark, SF))


def counted_plainly(candidates):
    """What candidate_counts, region_counts and region_summary give, from the pairs themselves."""
    exact, basis = F.col("target_overlap_bp") > 0, F.when(F.col("target_overlap_bp") > 0, "EXACT").otherwise("PROXIMAL")
    counts = candidates.groupBy("read_id").agg(F.count("*").alias("n"), F.count_if(exact).alias("exact"), F.count_if(F.col("target_source") == "DISEASE").alias("disease"))
    regions = candidates.groupBy("target_source", "target_region_id", basis.alias("basis")).agg(F.count("*").alias("candidates"), F.count_distinct("read_id").alias("reads"))
    best = F.min_by("read_id", F.struct(-F.col("target_overlap_bp"), "target_distance_bp", F.coalesce("read_id", F.lit(1 << 40))))
    summary = candidates.groupBy("target_source", "target_region_id").agg(F.count("*").alias("candidates"), F.count_distinct("read_id").alias("reads"), F.count_if(exact).alias("exact"), best.alias("best_read"))
    return counts, regions, summary


def dense_blocks_and_loci(spark):
    """Reads of up to five alignments with up to three blocks each, many of which meet a locus; copies of reads and loci, and odd ones."""
    rng = random.Random(11)
    blocks = []
    for r in range(60):
        for o in range(rng.randint(1, 5)):
            at = rng.randrange(0, 900)
            for _ in range(rng.randint(1, 3)):
                blocks.append((r, o, f"chr{r % 2}", at, at + rng.randint(1, 80)))
                at += rng.randint(0, 120)
    blocks += [(r + 100, *x) for r, *x in blocks if r < 30] + [(999, 1, None, 5, 9), (998, 1, "chr0", None, 9), (None, 1, "chr0", 100, 160), (997, None, "chr0", 100, 160)]
    rng.shuffle(blocks)
    loci = [("DISEASE" if i % 3 == 0 else "CATALOG", f"T{i}", f"chr{i % 2}", i * 37 % 900, i * 37 % 900 + 3 + i % 40) for i in range(50)]
    loci += [(s_, f"{n}c", *x) for s_, n, *x in loci if len(n) == 2]
    return spark.createDataFrame(blocks, "read_id long, ordinal int, chrom string, block_start long, block_end long"), spark.createDataFrame(loci, "target_source string, target_region_id string, chrom string, start_pos long, end_pos long")


def test_shapes_of_reads_count_as_pairs_do(spark):
    """Counts of candidates come from each shape of reads with each span, and no pair is shuffled; before, pairs were grouped by both."""
    blocks, loci = dense_blocks_and_loci(spark)
    for targets in (loci, loci.unionByName(loci.limit(3).withColumn("start_pos", F.col("start_pos") - 10))):
        want = counted_plainly(asg.alignment_target_candidates(blocks, targets))
        got = asg.candidate_counts(blocks, targets), asg.region_counts(blocks, targets), asg.region_summary(blocks, targets)
        for g, w in zip(got, want):
            names = sorted(w.columns)
            assert sorted(map(str, g.select(*names).collect())) == sorted(map(str, w.select(*names).collect()))
    met = asg.shapes_met(blocks, loci)
    assert met.groupBy("_shape", "_shape2", "chrom", "start_pos", "end_pos").count().filter("count > 1").isEmpty()
    assert met.groupBy("read_id").count().count() < blocks.select("read_id").distinct().count()
    for name in ("candidate_multiplicity", "disease_region_summary", "region_summary"):
        found = registry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_set" not in found and found.count("Join Inner") <= 4, name


def test_flags_of_copies_join_no_more_rows(spark, monkeypatch):
    """Copies of loci and features put no more rows into the interval join of flags and audits; before, each copy was joined with each."""
    from pyspark.sql import DataFrame

    from tandemsift.plans import catalog_queries, common

    sizes, real = [], catalog_queries.iv.interval_join
    monkeypatch.setattr(catalog_queries.iv, "interval_join", lambda a, b, *x, **y: sizes.append((a.count(), b.count())) or real(a, b, *x, **y))
    loci = [("DISEASE" if i % 2 else "CATALOG", f"T{i}", "chr1", i * 9, i * 9 + 12, ("CAG", "GCA", "AT", None, "C-G")[i % 5]) for i in range(20)]
    feats = [("chr1", ("gene", "exon", "CDS", "UTR")[i % 4], i * 11 + 1, i * 11 + 30, "+-"[i % 2], f"tx{i % 3}") for i in range(16)]

    def found(name: str, n: int) -> tuple[list, DataFrame]:
        targets = spark.createDataFrame([(s_, f"T{int(i[1:]) + 20 * c}", *x) for s_, i, *x in loci for c in range(n)], "target_source string, target_region_id string, chrom string, start_pos long, end_pos long, motif string")
        gtf = spark.createDataFrame(feats * n, "chrom string, feature string, start_1based long, end_1based long, strand string, transcript_id string")
        monkeypatch.setattr(common, "view", lambda _s, _d, v: {"targets": targets, "gtf_rows": gtf}[v])
        sizes.clear()
        rows = registry.queries()[name](spark, SF).collect()
        return list(sizes), sorted((int(r["target_region_id"][1:]) % 20, *r[1:]) for r in rows)

    for name in ("locus_region_flags", "forced_locus_audit"):
        (one, rows), (many, more) = found(name, 1), found(name, 4)
        assert one == many and more == sorted(r for r in rows for _ in range(4)), name


def test_scans_of_all_motifs_are_batches(spark):
    """Scans of all reads under all motifs lay reads side by side in Arrow batches; before, each base went through lambda functions."""
    for name in ("exact_periodic_run_by_motif", "periodic_segment_scan_by_motif"):
        found = plan(registry.queries()[name](spark, SF))
        assert "MapInArrow" in found and "Exchange hashpartitioning(read_id" in found and "aggregate(" not in found, name


def test_ranks_of_batches_are_those_of_joins(spark, monkeypatch):
    """Best alignments and ranks beside a small catalog, in Arrow batches of any size, are those of the join and the window; before, all pairs were shuffled to be ranked."""
    from tandemsift.operators import ranked

    blocks, loci = dense_blocks_and_loci(spark)
    blocks = blocks.filter("ordinal IS NOT NULL AND read_id IS NOT NULL")
    loci = loci.unionByName(spark.createDataFrame([("CATALOG", "long", "chr1", 0, 20000), ("DISEASE", "none", None, 1, 5), ("DISEASE", "away", "chrX", 1, 5), ("CATALOG", "point", "chr0", 50, 50)], loci.schema))
    kinds = F.array(*[F.lit(k) for k in ("primary", "secondary", "supplementary", "other")])
    alike = F.col("read_id") % 100 * 7 + F.col("ordinal") * 5
    alignments = blocks.filter("ordinal < 4").select("read_id", "ordinal").distinct().select("read_id", "ordinal", F.get(kinds, (alike % 4).cast("int")).alias("alignment_class"), F.when(alike % 9 > 0, alike % 3).cast("int").alias("mapq"), F.when(alike % 2 == 0, "+").otherwise("-").alias("strand"))
    found = lambda: [sorted(map(str, f(blocks, loci, alignments).collect())) for f in (asg.read_target_candidates, asg.ranked_targets)]
    got = found()
    monkeypatch.setattr(ranked, "CELLS", 50)
    monkeypatch.setattr(ranked, "ALIKE", 1)
    assert found() == got
    monkeypatch.setattr(ranked, "LOCI", 1)
    assert found() == got and len(got[1]) == len(got[0]) > 1000
    monkeypatch.undo()
    assert asg.reads_alike(blocks, alignments).count() < blocks.select("read_id").distinct().count()
    for name in ("read_target_candidates", "assignment_rank"):
        found_plan = plan(registry.queries()[name](spark, SF))
        assert "MapInArrow" in found_plan and "Window [row_number() windowspecdefinition(read_id" not in found_plan, name


def test_nearby_copies_join_no_more_rows(spark, monkeypatch):
    """Copies of loci and features at one span go into the interval join as one row; before, each by itself."""
    from tandemsift.plans import catalog_queries, common

    sizes, real = [], catalog_queries.iv.interval_join
    monkeypatch.setattr(catalog_queries.iv, "interval_join", lambda a, b, *x, **y: sizes.append((a.count(), b.count())) or real(a, b, *x, **y))
    targets = spark.createDataFrame([(f"T{i}-{c}", "chr1", i * 90, i * 90 + 12) for i in range(8) for c in range(5)], "target_region_id string, chrom string, start_pos long, end_pos long")
    gtf = spark.createDataFrame([("chr1", "exon", i * 70 + 1, i * 70 + 30, "+", f"tx{c}") for i in range(6) for c in range(4)], "chrom string, feature string, start_1based long, end_1based long, strand string, transcript_id string")
    monkeypatch.setattr(common, "view", lambda _s, _d, v: {"targets": targets, "gtf_rows": gtf}[v])
    got = sorted(tuple(r) for r in registry.queries()["interval_nearby_join"](spark, SF).select("target_region_id", "transcript_id", "distance_bp").collect())
    apart = lambda i, j: max(0, j * 70 - i * 90 - 12, i * 90 - j * 70 - 30)
    assert sizes == [(8, 6)] and got == sorted((f"T{i}-{c}", f"tx{d}", apart(i, j)) for i in range(8) for c in range(5) for j in range(6) for d in range(4) if apart(i, j) <= 100)
