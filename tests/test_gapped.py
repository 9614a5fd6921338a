import random

from pyspark.sql import functions as F

from tandemsift.operators import calling, gapped, seeds

COMP = str.maketrans("ACGT", "TGCA")


def best(tract, motif):
    """The best alignment over both strands, by tuples, base by base."""
    top = None
    for place, unit in ((0, motif), (-1, motif[::-1].translate(COMP))):
        band = {ph: (0, 0, 0, 0, 0, -ph) for ph in range(len(unit))}
        for base in tract:
            new = {}
            for ph, (score, same, other, put, out, first) in band.items():
                ways = [(ph, (score - 4, same, other, put - 1, out, first))]
                for d in (0, 1):
                    hit = unit[(ph + d) % len(unit)] == base
                    ways.append(((ph + d + 1) % len(unit), (score + (3 if hit else -4) - 4 * d, same + hit, other - (not hit), put, out - d, first)))
                for to, way in ways:
                    new[to] = max(new.get(to, way), way)
            band = new
        own = max(band.values())
        key = (own[0], own[1], own[2], own[5], place)
        if top is None or key > top[0]:
            top = (key, own)
    _, (score, same, other, put, out, _) = top
    return (score, same, -other, -put, -out)


def test_alignments_are_the_best_ones(spark):
    """Bases left out, put in and replaced, chance texts, both strands; nulls, empty texts and codes that aren't bases."""
    rng, rows = random.Random(5), []
    for k in range(300):
        motif = "".join(rng.choices("ACGT", k=rng.randint(1, 7)))
        tract = list((motif * 20)[rng.randint(0, 3) :][: rng.randint(1, 45)])
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(tract))
            tract[at : at + 1] = rng.choice(([], [rng.choice("ACGT")], [tract[at], rng.choice("ACGT")]))
            tract = tract or ["A"]
        text = "".join(tract)
        rows.append((k, text[::-1].translate(COMP) if k % 2 else text, motif.lower() if k % 5 == 0 else motif, "kept"))
    odd = [(900, None, "CAG", "x"), (901, "", "CAG", "x"), (902, "CAG", None, "x"), (903, "CAG", "", "x"), (904, "CAG", "C?G", "x"), (905, "NNN", "A", "x")]
    docs = spark.createDataFrame(rows + odd, "id long, tract string, motif string, score string")
    got = {r.id: r for r in gapped.align_to_motif(docs).collect()}
    for k, tract, motif, _ in rows:
        r = got[k]
        assert (r.score, r.matches, r.mismatches, r.insertions, r.deletions) == best(tract, motif.upper()), (tract, motif)
        assert r.motif_bases == r.matches + r.mismatches + r.deletions
    assert all(got[k].score is None and got[k].strand is None for k in range(900, 905))
    assert (got[905].matches, got[905].mismatches + got[905].insertions) == (0, 3)
    assert gapped.align_to_motif(docs.limit(0)).collect() == []


def test_long_tracts_are_counted_in_two_numbers(spark):
    """A tract over what one number holds has the counts that its parts lead to expect; a unit too long gives null."""
    tract = "CAG" * 6000 + "CA" + "CAG" * 10 + "T" + "CAG" * 5
    docs = spark.createDataFrame([(tract, "CAG"), ("A" * 50, "ACGT" * 600)], "tract string, motif string")
    long, wide = gapped.edit_fractions(gapped.align_to_motif(docs)).collect()
    assert (long.matches, long.mismatches, long.insertions, long.deletions) == (len(tract) - 1, 0, 1, 1)
    assert long.score == 3 * (len(tract) - 1) - 8 and abs(long.edit_fraction - 2 / (len(tract) + 1)) < 1e-12
    assert wide.score is None


def test_seeds_name_all_scans_that_hold_one(spark):
    """As scans of every window under every motif on both strands, kept where the run is long enough; odd rows give nothing."""
    rng = random.Random(6)
    motifs = [("CAG",), ("cag",), ("A",), ("AT",), ("CCTG",), ("GATTACAGATC",), (None,), ("",), ("A?",)]
    rows = [(i, "".join(rng.choices("ACGT", k=20)) + rng.choice(motifs[:6])[0].upper() * rng.randint(1, 9) + "".join(rng.choices("AC", k=15)), "x") for i in range(80)]
    windows = spark.createDataFrame(rows + [(200, None, "x"), (201, "", "x"), (202, "ACG", "x"), (203, "N" * 20, "x")], "read_id long, seq string, motif string")
    catalog = spark.createDataFrame(motifs, "motif string")
    every = windows.select("read_id").crossJoin(catalog.filter("motif RLIKE '^[ACGT]+$'")).withColumn("strand", F.explode(F.array(F.lit("+"), F.lit("-"))))
    whole = calling.segment_scan_by_motif(windows.filter("seq <> ''"), every)
    runs = {(r.read_id, r.motif, r.strand): r.run_bp for r in calling.exact_runs_by_motif(windows.filter("seq <> ''"), every).collect() if r.run_bp >= 8}
    got = seeds.scan_by_seeds(windows, catalog, "read_id").collect()
    best_runs = {}
    for r in got:
        best_runs[r.read_id, r.motif, r.strand] = max(best_runs.get((r.read_id, r.motif, r.strand), 0), r.run_bp)
    assert best_runs == runs and all(r.run_bp >= 8 for r in got)
    want = {(r.read_id, r.motif, r.strand, r.phase): (r.start, r.end, r.score) for r in whole.collect()}
    assert len(got) > 50 and all(want[r.read_id, r.motif, r.strand, r.phase] == (r.start, r.end, r.score) for r in got)


def test_windows_meet_their_own_motif_alone_and_no_product_is_made(spark):
    windows = spark.createDataFrame([(1, "CAG" * 6, "cag"), (2, "CAG" * 6, "AT"), (3, "AT" * 9 + "CAG" * 5, "AT")], "read_id long, seq string, motif string")
    found = seeds.scan_by_seeds(windows, windows, "read_id", own="motif")
    assert {(r.read_id, r.motif, r.strand) for r in found.collect()} == {(1, "CAG", "+"), (3, "AT", "+"), (3, "AT", "-")}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
