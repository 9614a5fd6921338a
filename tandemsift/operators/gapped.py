"""Gapped alignment of whole tracts to a motif that repeats, in one pass over the bases of a batch of tracts.

The state of the pass is the band: one best alignment for each place of the motif that may come next. As an alignment is
two numbers that compare in order and only ever have constants added, a step is sums and maxima of arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.sequences import reverse_complement
from .consensus import groups
from .laid import codes, matrix

#: Bits of an alignment's counts of matches and mismatches, and of its first phase, in one number.
COUNT_BITS, PHASE_BITS = 26, 11
PHASES = 1 << PHASE_BITS
#: Places of the band that are worked out at once, for all tracts laid side by side.
CELLS = 1 << 18


@dataclass(frozen=True)
class Scores:
    """What a base gains or loses, and how many motif bases may be left out before one of the tract's."""

    match: int = 3
    mismatch: int = 4
    insertion: int = 4
    deletion: int = 4
    most_deleted: int = 1


def best_alignments(bases: np.ndarray, sizes: np.ndarray, units: np.ndarray, scores: Scores) -> list[np.ndarray]:
    """score, matches, -mismatches and -phase of the best alignment of all bases of each tract to its unit, which repeats.

    Of equal scores that with more matches, then fewer mismatches, then the lower first phase is taken; insertions and
    deletions follow from these. Tracts (their letters side by side, shortest first) and units (all of one size) aren't
    empty. An alignment is its score beside one number, of matches, mismatches and phase, the last two counted down.
    """
    size, counts = units.shape[1], 1 << COUNT_BITS
    one_match, one_mismatch = counts * PHASES, -PHASES
    phase = np.arange(size)
    score, tie = np.zeros(units.shape, np.int64), np.broadcast_to((counts - 1) * PHASES + PHASES - 1 - phase, units.shape).astype(np.int64)
    last = units[:, (phase - 1) % size]
    first = np.searchsorted(sizes, np.arange(bases.shape[1]), "right")  # from this tract on, all have a base there
    for i, at in enumerate(first):
        own, own_tie = score[at:], tie[at:]
        hit = last[at:] == bases[at:, i : i + 1]
        gain, mark = np.where(hit, scores.match, -scores.mismatch), np.where(hit, one_match, one_mismatch)
        best, best_tie = own - scores.insertion, own_tie
        for left_out in range(scores.most_deleted + 1):
            before = (phase - 1 - left_out) % size
            way, way_tie = own[:, before] + (gain - scores.deletion * left_out), own_tie[:, before] + mark
            better = (way > best) | ((way == best) & (way_tie > best_tie))
            best, best_tie = np.where(better, way, best), np.where(better, way_tie, best_tie)
        score[at:], tie[at:] = best, best_tie
    top = score.max(axis=1)
    tied = np.where(score == top[:, None], tie, -1).max(axis=1)
    part = lambda low, bits: (tied >> low) & ((1 << bits) - 1)
    return [top, part(COUNT_BITS + PHASE_BITS, COUNT_BITS), part(PHASE_BITS, COUNT_BITS) - (counts - 1), part(0, PHASE_BITS) - (PHASES - 1)]


def best_strands(texts: list, units: list, others: list, scores: Scores) -> tuple[np.ndarray, np.ndarray]:
    """For each tract with a unit score, matches, -mismatches and place (0 or, for the other strand, -1); and whether it has one."""
    told, known, by_size = np.zeros((len(texts), 4), np.int64), np.zeros(len(texts), bool), {}
    for i, (text, unit, other) in enumerate(zip(texts, units, others)):
        if text and other and len(unit) < PHASES:
            by_size.setdefault(len(unit), []).append(i)
    for size, alike in by_size.items():
        lengths = np.array([len(texts[i]) for i in alike], np.int64)
        for at in groups(lengths, CELLS, size):
            own = [alike[i] for i in at]
            bases = matrix([codes(texts[i]) for i in own])
            plus, minus = (best_alignments(bases, lengths[at], matrix([codes(x[i]) for i in own]), scores) for x in (units, others))
            turned, tied = np.zeros(len(own), bool), np.ones(len(own), bool)
            for p, m in zip(plus, minus):
                turned |= tied & (m > p)
                tied &= m == p
            told[own] = np.stack([np.where(turned, m, p) for p, m in zip(plus[:3], minus)] + [-turned.astype(np.int64)], axis=1)
            known[own] = True
    return told, known


def align_to_motif(rows: DataFrame, tract: str = "tract", motif: str = "motif", scores: Scores = Scores()) -> DataFrame:
    """rows with strand, score, matches, mismatches, insertions, deletions and motif_bases of each tract against its motif.

    Every base of the tract is accounted for; the motif may start at any phase, on either strand (on a tie the + strand).
    A deletion leaves out motif bases before a tract's base, an insertion is a tract's base without one. Rows whose tract
    is null or empty or whose motif is null, empty, over 2,047 bases or outside the IUPAC codes have nulls. Nothing is
    shuffled or exploded; tracts are laid side by side in Arrow batches, and one of n bases is n steps over an array as long
    as its motif.
    """
    names = ("strand", "score", "matches", "mismatches", "insertions", "deletions", "motif_bases")
    rows = rows.drop(*[n for n in names if n in rows.columns])
    helped = rows.withColumns({"_text": F.upper(tract), "_unit": F.upper(motif), "_other": reverse_complement(F.upper(motif))})
    columns = helped.columns
    added = ("_score", "_matches", "_replaced", "_place")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told, known = best_strands(*[batch.column(columns.index(c)).to_pylist() for c in ("_text", "_unit", "_other")], scores)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(told[:, j], mask=~known) for j in range(4)]], [*columns, *added])

    best = helped.mapInArrow(found, StructType([*helped.schema.fields, *[StructField(c, LongType()) for c in added]]))
    size = F.length(tract)
    insertions = size - F.col("matches") - F.col("mismatches")
    lost = scores.match * F.col("matches") - scores.mismatch * F.col("mismatches") - scores.insertion * F.col("insertions") - F.col("score")
    strand = F.when(F.col("_place") == 0, "+").when(F.col("_place") < 0, "-")
    counted = best.withColumns({"score": F.col("_score"), "strand": strand, "matches": F.col("_matches"), "mismatches": -F.col("_replaced")})
    counted = counted.withColumn("insertions", insertions.cast("long")).withColumn("deletions", F.floor(lost / scores.deletion))
    counted = counted.withColumn("motif_bases", F.col("matches") + F.col("mismatches") + F.col("deletions"))
    return counted.select(*rows.columns, *names)


def fraction(part: Column) -> Column:
    """A share of all steps of an alignment, null without one."""
    steps = F.col("matches") + F.col("mismatches") + F.col("insertions") + F.col("deletions")
    return F.try_divide(part, steps)


def edit_fractions(aligned: DataFrame) -> DataFrame:
    """aligned with purity, edit_fraction, insertion_fraction, deletion_fraction and path_ratio (motif bases for each tract base)."""
    edits = F.col("mismatches") + F.col("insertions") + F.col("deletions")
    return aligned.withColumns(
        {
            "purity": fraction(F.col("matches")), "edit_fraction": fraction(edits), "insertion_fraction": fraction(F.col("insertions")),
            "deletion_fraction": fraction(F.col("deletions")), "path_ratio": F.try_divide("motif_bases", F.col("matches") + F.col("mismatches") + F.col("insertions")),
        }
    )
