"""Consensus motifs of all periods, worked out for a batch of reads at once as a matrix of bases."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import spread

SCHEMA = "period int, motif string, agreement double"
#: Bases of the reads that are laid side by side, padding included.
CELLS = 1 << 21
BASES = np.frombuffer(b"ACGT", np.uint8)
CODE = np.full(256, 4, np.uint8)
CODE[BASES] = range(4)


def groups(sizes: np.ndarray, cells: int | None = None, least: int = 1) -> Iterator[np.ndarray]:
    """Rows by length, at least `least` counted for each, as many at once as `cells` (CELLS) holds; one at least."""
    cells = CELLS if cells is None else cells
    order = np.argsort(sizes, kind="stable")
    start = 0
    for stop, row in enumerate(order):
        # lengths ascend, so the row that comes next would be the group's width
        if stop > start and max(int(sizes[row]), least) * (stop + 1 - start) > cells:
            yield order[start:stop]
            start = stop
    if start < len(order):
        yield order[start:]


def of_period(codes: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Motifs (rows of bytes) and agreement of reads in a matrix of codes, of which 4 doesn't count."""
    rows, width = codes.shape
    deep = -(-width // period)
    if deep * period > width:
        codes = np.concatenate([codes, np.full((rows, deep * period - width), 4, np.uint8)], axis=1)
    shaped = codes.reshape(rows, deep, period)
    counts = np.stack([(shaped == b).sum(axis=1, dtype=np.int32) for b in range(4)])
    total, most = counts.sum(axis=(0, 2), dtype=np.int64), counts.max(axis=0)
    agreement = np.divide(most.sum(axis=1, dtype=np.int64), total, out=np.zeros(rows), where=total > 0)
    return BASES[counts.argmax(axis=0)], agreement  # argmax takes the first of equals


def canonical(motifs: np.ndarray) -> np.ndarray:
    """Rows of bytes with the least rotation of either strand of each motif's primitive unit, zeros behind it."""
    rows, size = motifs.shape
    found, left = np.zeros_like(motifs), np.arange(rows)
    for unit in (d for d in range(1, size + 1) if size % d == 0):
        repeats = (motifs[left].reshape(len(left), size // unit, unit) == motifs[left][:, None, :unit]).all(axis=(1, 2))
        own, left = left[repeats], left[~repeats]
        if len(own):
            one = motifs[own, :unit]
            other = BASES[3 - CODE[one[:, ::-1]]]
            best = None
            for strand in (one, other):
                twice = np.concatenate([strand, strand], axis=1)
                for k in range(unit):
                    way = np.ascontiguousarray(twice[:, k : k + unit]).view(f"S{unit}")[:, 0]
                    best = way if best is None else np.where(way < best, way, best)
            found[own, :unit] = np.ascontiguousarray(best).view(np.uint8).reshape(len(own), unit)
    return found


def texts(motifs: np.ndarray) -> pa.Array:
    """Rows of bytes as texts, without the zeros behind them."""
    offsets = np.concatenate([[0], np.cumsum((motifs > 0).sum(axis=1))]).astype(np.int32)
    return pa.StringArray.from_buffers(len(motifs), pa.py_buffer(offsets), pa.py_buffer(motifs[motifs > 0]))


def consensus_all_periods(reads: DataFrame, key: str, longest: int, least: float | None = None) -> DataFrame:
    """Per read and period from 1 to min(longest, a third of the read): motif and agreement, as calling.consensus.

    With `least`, rows of less agreement are left out and the others have their canonical_motif.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases = [np.frombuffer(t.encode("ascii", "replace"), np.uint8) for t in batch.column(1).to_pylist()]
            sizes = np.array([len(b) for b in bases], np.int64)
            for rows in groups(sizes):
                codes = np.full((len(rows), int(sizes[rows].max())), 4, np.uint8)
                for i, row in enumerate(rows):
                    codes[i, : sizes[row]] = CODE[bases[row]]
                for period in range(1, min(longest, int(sizes[rows[-1]]) // 3) + 1):
                    fit = np.searchsorted(sizes[rows], 3 * period)  # lengths ascend
                    motifs, agreement = of_period(codes[fit:], period)
                    own = rows[fit:]
                    if least is not None:
                        good = agreement >= least
                        own, motifs, agreement = own[good], motifs[good], agreement[good]
                    columns = {key: batch.column(0).take(pa.array(own)), "period": pa.array(np.full(len(own), period, np.int32)), "motif": texts(motifs), "agreement": pa.array(agreement)}
                    if least is not None:
                        columns["canonical_motif"] = texts(canonical(motifs))
                    yield pa.RecordBatch.from_pydict(columns)

    rows = spread(reads.filter(F.length("seq") >= 3).select(key, F.upper("seq").alias("seq")), key)
    return rows.mapInArrow(found, f"{key} {reads.schema[key].dataType.simpleString()}, {SCHEMA}" + (", canonical_motif string" if least is not None else ""))
