"""Motifs laid along a batch of texts at once, as matrices of letters: labels of reads, tracts at an entry, windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.sequences import reverse_complement
from .consensus import groups


def codes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le"), np.uint32)


def matrix(texts: list[np.ndarray]) -> np.ndarray:
    """Texts side by side, zeros behind them."""
    found = np.zeros((len(texts), max(map(len, texts), default=0)), np.uint32)
    for i, t in enumerate(texts):
        found[i, : len(t)] = t
    return found


def counted(bases: np.ndarray, units: np.ndarray, others: np.ndarray) -> Iterator[np.ndarray]:
    """For each rotation of both strands, how many bases before each place agree with it laid from the start."""
    rows, width = bases.shape
    size = units.shape[1]
    for strand in (units, others):
        for k in range(size):
            before = np.zeros((rows, width + 1), np.int32)
            np.cumsum(bases == strand[:, (np.arange(width) + k) % size], axis=1, out=before[:, 1:])
            yield before


def window_shares(bases: np.ndarray, sizes: np.ndarray, units: np.ndarray, others: np.ndarray) -> np.ndarray:
    """For each base the best share of agreeing bases in the window of max(9, 3 units) around it."""
    at, n, width = np.arange(bases.shape[1]), sizes[:, None], max(9, 3 * units.shape[1])
    high = np.minimum(n, np.maximum(0, at - width // 2) + width)
    low = np.maximum(0, high - width)
    best = None
    for before in counted(bases, units, others):
        agree = np.take_along_axis(before, high, 1) - np.take_along_axis(before, low, 1)
        best = agree if best is None else np.maximum(best, agree, out=best)
    return best / np.minimum(n, width)


def merged(row: np.ndarray, label: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Neighbours in one row with one label, as one."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (label[1:] != label[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    return [row[first], label[first], start[first], end[last]]


def labels(bases: np.ndarray, sizes: np.ndarray, motifs: list[list[np.ndarray]], others: list[list[np.ndarray | None]], threshold: float, margin: float) -> np.ndarray:
    """The place among its read's motifs of the one that explains each base best; -1 for none."""
    best, second, label = np.full(bases.shape, -np.inf), np.full(bases.shape, -np.inf), np.full(bases.shape, -1, np.int32)
    for k in range(max(map(len, motifs))):
        by_size: dict[int, list[int]] = {}
        for i, own in enumerate(motifs):
            if k < len(own) and others[i][k] is not None and sizes[i] >= max(6, 2 * len(own[k])):
                by_size.setdefault(len(own[k]), []).append(i)
        for alike in by_size.values():
            share = window_shares(bases[alike], sizes[alike], matrix([motifs[i][k] for i in alike]), matrix([others[i][k] for i in alike]))
            top = share >= best[alike]
            second[alike] = np.where(top, best[alike], np.maximum(second[alike], share))
            best[alike] = np.where(top, share, best[alike])
            label[alike] = np.where(top, k, label[alike])
    with np.errstate(invalid="ignore"):
        return np.where((best >= threshold) & ~((second > -np.inf) & (best - second < margin)), label, -1)


def label_segments(rows: DataFrame, key: str, threshold: float, margin: float, fill: int) -> DataFrame:
    """rows[key, seq, motifs, others] -> segments, as calling.label_segments; others are the motifs' complements, null for unknown symbols."""

    def segments(batch: pa.RecordBatch, at: np.ndarray, bases: list, motifs: list, others: list) -> pa.RecordBatch:
        laid, sizes = matrix(bases), np.array([len(b) for b in bases])
        found = labels(laid, sizes, motifs, others, threshold, margin)
        row = np.repeat(np.arange(len(bases)), sizes)
        pos = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        row, label, start, end = merged(row, found[row, pos], pos, pos + 1)
        unit = np.zeros((len(bases), max(map(len, motifs))), np.int64)
        for i, own in enumerate(motifs):
            unit[i, : len(own)] = [len(m) for m in own]
        label = np.where(end - start < np.maximum(6, 2 * unit[row, label]), -1, label)
        row, label, start, end = merged(row, label, start, end)
        between = np.zeros(len(row), bool)
        between[1:-1] = (label[1:-1] < 0) & ((end - start)[1:-1] <= fill) & (row[:-2] == row[1:-1]) & (row[2:] == row[1:-1]) & (label[:-2] == label[2:])
        label = np.where(between, np.roll(label, 1), label)
        runs = merged(row, label, start, end)
        row, label, start, end = (x[runs[1] >= 0] for x in runs)
        names = pa.array(["".join(map(chr, motifs[r][m])) for r, m in zip(row.tolist(), label.tolist())], pa.string())
        columns = [batch.column(0).take(pa.array(at[row])), names, pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, [key, "motif", "seg_start", "seg_end"])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases = [codes(t) for t in batch.column(1).to_pylist()]
            motifs = [[codes(m) for m in own] for own in batch.column(2).to_pylist()]
            others = [[None if m is None else codes(m) for m in own] for own in batch.column(3).to_pylist()]
            for at in groups(np.array([len(b) for b in bases], np.int64)):
                yield segments(batch, at, *[[x[i] for i in at] for x in (bases, motifs, others)])

    return rows.mapInArrow(found, f"{key} {rows.schema[key].dataType.simpleString()}, motif string, seg_start int, seg_end int")


def best_tracts(bases: np.ndarray, sizes: np.ndarray, entry: np.ndarray, units: np.ndarray, others: np.ndarray, reach: int, least_bp: int, purity: float, match: int, mismatch: int) -> np.ndarray:
    """Start, length and agreeing bases of the best tract of each clip; length 0 for none."""
    offsets = sorted(range(-reach, reach + 1), key=lambda d: (abs(d), d))  # of equals the first is kept
    starts = entry[:, None] + np.array(offsets)
    fits = (starts >= 0) & (starts + least_bp <= sizes[:, None]) & ((entry >= 0) & (entry <= sizes))[:, None]
    starts = np.where(fits, starts, 0)
    most = [None] * len(offsets)
    for before in counted(bases, units, others):
        for j in range(len(offsets)):
            hits = before - np.take_along_axis(before, starts[:, j : j + 1], 1)
            most[j] = hits if most[j] is None else np.maximum(most[j], hits, out=most[j])
    found, at = np.zeros((len(bases), 3), np.int64), np.arange(bases.shape[1] + 1)
    for j, hits in enumerate(most):
        start = starts[:, j]
        n = at - start[:, None]
        inside = fits[:, j : j + 1] & (n >= least_bp) & (at <= sizes[:, None])
        good = inside & (hits / np.maximum(n, 1) >= purity) & (match * hits > mismatch * (n - hits))
        end = len(at) - 1 - good[:, ::-1].argmax(axis=1)
        bp = np.where(good.any(axis=1), end - start, 0)
        same = hits[np.arange(len(bases)), end]
        better = (bp > found[:, 1]) | ((bp == found[:, 1]) & (bp > 0) & (same > found[:, 2]))
        found[better] = np.stack([start, bp, same], axis=1)[better]
    return found


def entry_tracts(clips: DataFrame, clip: str, unit: str, other: str, entry: str, **rule) -> DataFrame:
    """clips with `_start`, `_bp` and `_same` of their best tract, as calling.entry_tracts; null without one."""
    names = clips.columns
    added = ("_start", "_bp", "_same")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda c: batch.column(names.index(c)).to_pylist()
            texts, units, others, entries = column(clip), column(unit), column(other), column(entry)
            told, known = np.zeros((batch.num_rows, 3), np.int64), np.zeros(batch.num_rows, bool)
            by_size: dict[int, list[int]] = {}
            for i, values in enumerate(zip(texts, units, others, entries)):
                if None not in values and values[1]:
                    by_size.setdefault(len(values[1]), []).append(i)
            for alike in by_size.values():
                bases = [codes(texts[i]) for i in alike]
                sizes = np.array([len(b) for b in bases], np.int64)
                for at in groups(sizes):
                    own = [alike[i] for i in at]
                    laid = [matrix([codes(x[i]) for i in own]) for x in (units, others)]
                    told[own] = best_tracts(matrix([bases[i] for i in at]), sizes[at], np.array([entries[i] for i in own], np.int64), *laid, **rule)
                    known[own] = told[own, 1] > 0
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(told[:, j].astype(np.int32), mask=~known) for j in range(3)]], [*names, *added])

    return clips.mapInArrow(found, StructType([*clips.schema.fields, *[StructField(c, IntegerType()) for c in added]]))


def like_windows(bases: np.ndarray, sizes: np.ndarray, units: np.ndarray, others: np.ndarray, width: int, step: int, purity: float) -> np.ndarray:
    """Windows of `width` bases, one each `step`, the last ones cut short to `step` at least, that a motif explains to `purity`."""
    starts, n = np.arange(0, bases.shape[1], step), sizes[:, None]
    low, high = np.minimum(starts, n), np.minimum(starts + width, n)
    best = None
    for before in counted(bases, units, others):
        agree = np.take_along_axis(before, high, 1) - np.take_along_axis(before, low, 1)
        best = agree if best is None else np.maximum(best, agree, out=best)
    wanted = ((starts == 0) | (starts + width - step < n)) & (n - starts >= step)
    return (wanted & (best / np.maximum(high - low, 1) >= purity)).sum(axis=1)


def count_like_windows(rows: DataFrame, text: str, motif: str, width: int = 40, step: int = 20, purity: float = 0.7, name: str = "windows") -> DataFrame:
    """rows with the number of windows of a text that look like a motif, over all rotations of both strands.

    The text's letters count as they stand. 0 for a null or short text and for a motif that is null, empty or outside the
    IUPAC codes. Texts are laid side by side in Arrow batches.
    """
    helped = rows.drop(name).withColumns({"_unit": F.upper(motif), "_other": reverse_complement(F.upper(motif))})
    names = helped.columns
    places = [names.index(c) for c in (text, "_unit", "_other")]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told, by_size = np.zeros(batch.num_rows, np.int64), {}
            texts, units, others = (batch.column(i).to_pylist() for i in places)
            for i, other in enumerate(others):
                if other and texts[i] and len(texts[i]) >= step:
                    by_size.setdefault(len(other), []).append(i)
            for alike in by_size.values():
                sizes = np.array([len(texts[i]) for i in alike], np.int64)
                for at in groups(sizes):
                    own = [alike[i] for i in at]
                    laid = [matrix([codes(x[i]) for i in own]) for x in (texts, units, others)]
                    told[own] = like_windows(laid[0], sizes[at], laid[1], laid[2], width, step, purity)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(told)], [*names, name])

    return helped.mapInArrow(found, StructType([*helped.schema.fields, StructField(name, LongType())])).drop("_unit", "_other")


def purities(rows: DataFrame, text: str, motif: str) -> DataFrame:
    """rows with purity and orientation, as sequences.phase_purity gives them for a text and its motif; null where it gives none.

    Texts of one motif are laid side by side in Arrow batches.
    """
    helped = rows.drop("purity", "orientation").withColumns({"_unit": F.upper(motif), "_other": reverse_complement(F.col(motif))})
    names = helped.columns
    places = [names.index(c) for c in (text, "_unit", "_other")]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            purity, way, by_unit = np.full(batch.num_rows, -1.0), [None] * batch.num_rows, {}
            texts, units, others = (batch.column(i).to_pylist() for i in places)
            for i, own in enumerate(zip(texts, units, others)):
                if all(own):
                    by_unit.setdefault(own[1:], []).append(i)
            for strands, alike in by_unit.items():
                ways = sorted({x[k:] + x[:k] for x in strands for k in range(len(x))})
                sizes = np.array([len(texts[i]) for i in alike], np.int64)
                for at in groups(sizes):
                    own = [alike[i] for i in at]
                    bases = matrix([codes(texts[i]) for i in own])
                    laid = [np.resize(codes(w), bases.shape[1]) for w in ways]
                    same = np.stack([(bases == x).sum(axis=1) for x in laid])
                    best = same.argmax(axis=0)  # the first of equals
                    purity[own] = same[best, np.arange(len(own))] / sizes[at]
                    for i, w in zip(own, best.tolist()):
                        way[i] = ways[w]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(purity, mask=purity < 0), pa.array(way, pa.string())], [*names, "purity", "orientation"])

    schema = StructType([*helped.schema.fields, StructField("purity", DoubleType()), StructField("orientation", StringType())])
    return helped.mapInArrow(found, schema).drop("_unit", "_other")


def best_stretches(bases: np.ndarray, sizes: np.ndarray, units: np.ndarray, phases: np.ndarray, match: int, mismatch: int) -> np.ndarray:
    """Longest run of agreeing bases, and start, end and score of the best stretch, with each unit laid from its phase.

    Ties go to the lowest start, then the shortest; without any hit it is the first base.
    """
    rows, at = np.arange(len(bases)), np.arange(bases.shape[1])
    inside = at < sizes[:, None]
    hit = inside & (bases == units[rows[:, None], (at + phases[:, None]) % units.shape[1]])
    return np.concatenate([longest_runs(hit)[:, None], best_of_hits(hit, inside, match, mismatch)], axis=1)


def longest_runs(hit: np.ndarray) -> np.ndarray:
    """The longest run of hits of each row."""
    at = np.arange(hit.shape[1])
    return (at - np.maximum.accumulate(np.where(hit, -1, at), axis=1)).max(axis=1, initial=0)


def best_of_hits(hit: np.ndarray, inside: np.ndarray, match: int, mismatch: int) -> np.ndarray:
    """Start, end and score of each row's best stretch, as best_stretches."""
    rows, at = np.arange(len(hit)), np.arange(hit.shape[1])
    value = np.where(hit, match, mismatch).astype(np.int32)
    prefix = np.cumsum(value, axis=1, dtype=np.int32)
    before = prefix - value
    low = np.minimum.accumulate(before, axis=1)
    fresh = np.ones(hit.shape, bool)
    fresh[:, 1:] = before[:, 1:] < low[:, :-1]
    start = np.maximum.accumulate(np.where(fresh, at, 0), axis=1)
    score = np.where(inside, prefix - low, np.iinfo(np.int32).min)
    end = score.argmax(axis=1)  # starts ascend along a row, so the first of equal scores has the lowest start and end
    return np.stack([start[rows, end], end + 1, score[rows, end]], axis=1)


def scans_of_all(reads: DataFrame, key: str, units: list[tuple[str, str, str]], scores: tuple[int, int] | None = None) -> DataFrame:
    """Each of reads[key, seq] under each of units (motif, strand, what is laid): run_bp, the longest run over all phases.

    With `scores` (match, mismatch) instead for each phase the best stretch's start, end and score. Letters count as they
    stand; a null text is empty. Texts are laid side by side in Arrow batches, and units are few enough to go with the task.
    """
    added = {"run_bp": "bigint"} if scores is None else {"phase": "int", "start": "int", "end": "int", "score": "int"}
    laid = [(motif, strand, codes(unit)) for motif, strand, unit in units]
    schema = f"{key} {reads.schema[key].dataType.simpleString()}, motif string, strand string, " + ", ".join(f"{n} {kind}" for n, kind in added.items())

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases = [codes(t) for t in batch.column(1).to_pylist()]
            for own in groups(np.array([len(b) for b in bases], np.int64)):
                texts, at = matrix([bases[i] for i in own]), batch.column(0).take(pa.array(own))
                inside = np.arange(texts.shape[1]) < np.array([len(bases[i]) for i in own])[:, None]

                def rows(motif: str, strand: str, *values: np.ndarray) -> pa.RecordBatch:
                    names = [pa.array([x], pa.string()).take(pa.array(np.zeros(len(own), np.int32))) for x in (motif, strand)]
                    kinds = [pa.int64() if k == "bigint" else pa.int32() for k in added.values()]
                    return pa.RecordBatch.from_arrays([at, *names, *[pa.array(v).cast(k) for v, k in zip(values, kinds)]], [key, "motif", "strand", *added])

                for motif, strand, unit in laid:
                    hits = (texts == np.resize(np.roll(unit, -phase), texts.shape[1]) for phase in range(len(unit)))
                    if scores is None:
                        yield rows(motif, strand, np.max([longest_runs(h) for h in hits], axis=0))
                    else:
                        for phase, h in enumerate(hits):
                            yield rows(motif, strand, np.full(len(own), phase), *best_of_hits(h, inside, *scores).T)

    return reads.mapInArrow(found, schema)


def stretches(rows: DataFrame, text: str, unit: str, phase: str, match: int, mismatch: int) -> DataFrame:
    """rows with run_bp, start, end and score of the best stretch of a text under a unit laid from a phase.

    Letters count as they stand. Rows whose text or unit is null or empty, or whose phase is null, are left out. Texts are laid side by side in Arrow batches.
    """
    kept = rows.filter((F.length(text) > 0) & (F.length(unit) > 0)).dropna(subset=[phase])
    names = kept.columns
    places = [names.index(c) for c in (text, unit, phase)]
    added = ("run_bp", "start", "end", "score")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told, by_size = np.zeros((batch.num_rows, len(added)), np.int64), {}
            texts, units, phases = (batch.column(i).to_pylist() for i in places)
            for i, own in enumerate(units):
                by_size.setdefault(len(own), []).append(i)
            for alike in by_size.values():
                sizes = np.array([len(texts[i]) for i in alike], np.int64)
                for at in groups(sizes):
                    own = [alike[i] for i in at]
                    laid = [matrix([codes(x[i]) for i in own]) for x in (texts, units)]
                    told[own] = best_stretches(laid[0], sizes[at], laid[1], np.array([phases[i] for i in own], np.int64), match, mismatch)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(told[:, j].astype(np.int32)) for j in range(len(added))]], [*names, *added])

    return kept.mapInArrow(found, StructType([*kept.schema.fields, *[StructField(c, IntegerType()) for c in added]]))


def best_stretch_of_all(rows: DataFrame, text: str, unit: str, other: str, match: int, mismatch: int, name: str = "call") -> DataFrame:
    """rows with the best stretch (start, end, score) of a text over all phases of a unit and of its complement.

    Ties go to the lowest start, then the shortest. Null where text, unit or complement is null or empty. A text is worked out in its own row.
    """
    names = rows.columns
    places = [names.index(c) for c in (text, unit, other)]
    added = ("_start", "_end", "_score")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told, known, by_size = np.zeros((batch.num_rows, 3), np.int64), np.zeros(batch.num_rows, bool), {}
            texts, units, others = (batch.column(i).to_pylist() for i in places)
            for i, own in enumerate(zip(texts, units, others)):
                if all(own):
                    by_size.setdefault(len(own[1]), []).append(i)
            for size, alike in by_size.items():
                sizes = np.array([len(texts[i]) for i in alike], np.int64)
                for at in groups(sizes):
                    own, best = [alike[i] for i in at], None
                    bases, *ways = (matrix([codes(x[i]) for i in own]) for x in (texts, units, others))
                    for way in ways:
                        for k in range(size):
                            x = best_stretches(bases, sizes[at], way, np.full(len(own), k), match, mismatch)[:, 1:]
                            if best is not None:
                                same = x[:, 2] == best[:, 2]
                                earlier = (x[:, 0] < best[:, 0]) | ((x[:, 0] == best[:, 0]) & (x[:, 1] < best[:, 1]))
                                x = np.where(((x[:, 2] > best[:, 2]) | (same & earlier))[:, None], x, best)
                            best = x
                    told[own], known[own] = best, True
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(told[:, j].astype(np.int32), mask=~known) for j in range(3)]], [*names, *added])

    done = rows.mapInArrow(found, StructType([*rows.schema.fields, *[StructField(c, IntegerType()) for c in added]]))
    return done.withColumn(name, F.when(F.col("_score").isNotNull(), F.struct(*[F.col(c).alias(c[1:]) for c in added]))).drop(*added)
