"""Periodic scans by seeds: an inverted index of motifs' bases in a row, probed by the bases in a row of windows.

A scan of every window under every motif is their product. Here a motif's repeat is cut to seeds, each known with the
motif, strand and place it has; a window's own seeds are looked up in it, and only what they name, down to the phase, is
scanned. A stretch with SEED bases of its motif in a row always shares a seed with it, so none of these is missed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import reverse_complement
from . import laid
from .spread import spread

#: Bases of a seed, and rows up to which an index is broadcast.
SEED, BROADCAST_ROWS = 8, 1 << 18


def seed_index(motifs: DataFrame, seed: int = SEED) -> DataFrame:
    """motifs[motif] -> seed, motif, strand, place: every stretch of so many bases of a motif's repeat, on both strands.

    Each motif counts once, whatever its case. Null and empty motifs and such as have symbols outside the IUPAC codes add
    nothing. There are two rows for each base of a motif.
    """
    named = motifs.select(F.upper("motif").alias("motif")).filter("motif <> ''").distinct()
    other = reverse_complement(F.col("motif"))
    strands = F.array(F.struct(F.lit("+").alias("strand"), F.col("motif").alias("unit")), F.struct(F.lit("-").alias("strand"), other.alias("unit")))
    rows = named.filter(other.isNotNull()).select("motif", F.explode(strands).alias("s")).select("motif", "s.strand", "s.unit")
    size = F.length("unit")
    whole = F.repeat("unit", (F.ceil(F.lit(seed) / size) + 1).cast("int"))
    places = rows.withColumns({"_whole": whole, "place": F.explode(F.sequence(F.lit(0), size - 1))})
    return places.select(F.substring("_whole", F.col("place") + 1, F.lit(seed)).alias("seed"), "motif", "strand", "place")


def named_by_seeds(windows: DataFrame, index: DataFrame, key: str, own: str | None = None, seed: int = SEED) -> DataFrame:
    """windows[key, seq] -> key, motif, strand, phase that share a seed with a window, each once.

    With `own`, the name of a column of motifs, a window meets its own motif alone. Only keys and seeds go into the join,
    which is by seed, so its cost follows what windows hold, not how many motifs there are. An index of more than
    BROADCAST_ROWS rows is joined by a shuffle.
    """
    places = F.sequence(F.lit(0), F.length("seq") - seed)
    held = spread(windows.filter(F.length("seq") >= seed), key).select(key, *([F.upper(own).alias("_own")] if own else []), F.upper("seq").alias("_seq"), F.explode(places).alias("_at"))
    held = held.withColumn("seed", F.substring("_seq", F.col("_at") + 1, F.lit(seed))).drop("_seq")
    index = F.broadcast(index) if index.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else index
    met = held.join(index, "seed")
    if own:
        met = met.filter("_own = motif")
    return met.select(key, "motif", "strand", F.pmod(F.col("place") - F.col("_at"), F.length("motif")).alias("phase")).distinct()


def scans(windows: DataFrame, named: DataFrame, key: str, match: int = 2, mismatch: int = -3) -> DataFrame:
    """named[key, motif, strand, phase] with run_bp (the longest run without a mismatch), start, end and score of the best stretch."""
    unit = F.when(F.col("strand") == "-", reverse_complement(F.col("motif"))).otherwise(F.col("motif"))
    # bases come as text and are dealt by key: Spark's estimate takes a table of them for small, as its files are
    rows = windows.select(key, F.upper("seq").alias("_seq")).hint("merge").join(spread(named, key), key).withColumn("_unit", unit)
    found = laid.stretches(rows, "_seq", "_unit", "phase", match, mismatch)
    return found.select(key, "motif", "strand", "phase", F.col("run_bp").cast("long").alias("run_bp"), "start", "end", "score")


def scan_by_seeds(windows: DataFrame, motifs: DataFrame, key: str, own: str | None = None, seed: int = SEED, match: int = 2, mismatch: int = -3) -> DataFrame:
    """Per window of windows[key, seq], motif of motifs[motif], strand and phase with `seed` motif bases in a row: run and best stretch.

    As a scan of every window under every motif, less those rows that hold fewer motif bases in a row. Keys are unique; null
    and short windows give no row; further columns of both tables are left out.
    """
    return scans(windows, named_by_seeds(windows, seed_index(motifs, seed), key, own, seed), key, match, mismatch)


def longest_by_seeds(windows: DataFrame, motifs: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """Per window, motif and strand: the longest run without a mismatch, where it has `seed` bases at least."""
    return scan_by_seeds(windows, motifs, key, seed=seed).groupBy(key, "motif", "strand").agg(F.max("run_bp").alias("run_bp"))
