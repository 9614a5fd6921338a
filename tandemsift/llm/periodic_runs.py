"""Runs of words with a period, found in overlapping tiles for each octave of periods and stitched by document and period.

A run of period q is at least three periods long, so it holds two whole periods behind some boundary, boundaries being
multiples of the octave's least period. Boundaries of a tile's core are tried alone; what they find is a piece of a run,
cut at the tile's ends, and pieces of one run overlap by a period at least. Pieces of different runs of one period never do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import arrays, common

#: A run has so many words and periods at least.
LEAST, TIMES = 24, 3
#: Words of a tile's core at least, and in periods of its octave; bytes of texts whose tiles are dealt out.
CORE, CORE_PERIODS, LONG = 1 << 12, 8, 1 << 20
#: Equal words that a boundary needs behind it and one period on before it is worked on.
SEED = 8


def z_function(s: list[int], most: int) -> list[int]:
    """Of each place below `most`, how far s repeats from there what stands at its start; all of s at place 0."""
    n = len(s)
    z = [0] * min(most, n)
    if z:
        z[0] = n
    left = right = 0
    for i in range(1, len(z)):
        length = min(right - i, z[i - left]) if i < right else 0
        if i + length >= right:
            length = max(length, 0)
            while i + length < n and s[length] == s[i + length]:
                length += 1
            left, right = i, i + length
        z[i] = length
    return z


def extent_back(words: np.ndarray, at: int, period: int) -> int:
    """How many words before a place equal those one period on, in steps that double."""
    done, step = 0, 64
    while done < at:
        low = max(0, at - done - step)
        differ = np.flatnonzero(words[low : at - done] != words[low + period : at - done + period])
        if len(differ):
            return done + at - done - low - 1 - int(differ[-1])
        done, step = at - low, step * 2
    return at


def tile_pieces(words: np.ndarray, octave: int, core_start: int, core_end: int, ends: tuple[bool, bool]) -> set[tuple[int, int, int]]:
    """(period, start, end) of stretches in a tile that have a smallest period in an octave and two of them behind a boundary.

    Boundaries are the multiples of 2^octave in the core (places count from the tile's first word, which is one). A
    boundary whose SEED words do not come again a period on is passed over for that period; for the others a Z-function of
    what follows tells how far they go on, and whether a shorter period fills the square: then the run has that one.
    `ends` says whether the tile's ends are the document's; stretches that are whole and too short are left out.
    """
    least, n, found = 1 << octave, len(words), set()
    seed = min(SEED, least)
    bounds = np.arange(core_start, core_end, least)
    if n < 2 * least or not len(bounds):
        return found
    live: dict[int, list[int]] = {}
    for periods in np.array_split(np.arange(least, 2 * least), max(1, least * len(bounds) >> 18)):
        b, q = np.repeat(bounds, len(periods)), np.tile(periods, len(bounds))
        fits = b + 2 * q <= n
        b, q = b[fits], q[fits]
        for j in range(seed):
            same = words[b + j] == words[b + q + j]
            b, q = b[same], q[same]
        for at, period in zip(b.tolist(), q.tolist()):
            live.setdefault(at, []).append(period)
    for at, periods in live.items():
        known = [p for p in periods if any(f[0] == p and f[1] <= at and at + 2 * p <= f[2] for f in found)] if found and len(periods) < 4 else []
        periods = [p for p in periods if p not in known]
        if not periods:
            continue
        z = z_function(words[at : at + 4 * least].tolist(), 2 * least)
        reach = 0  # how far from the boundary a shorter period holds at most, by that period
        shorter: list[tuple[int, int]] = []
        want = set(periods)
        for p in range(1, 2 * least):
            if p in want and z[p] >= p and not any(p % d == 0 and far >= 2 * p for d, far in shorter):
                forward = z[p]
                if at + p + forward == min(n, at + 4 * least) and at + p + forward < n:  # the window ends, not the stretch
                    differ = words[at + p + forward :] != words[at + forward : n - p]
                    first = int(differ.argmax()) if differ.any() else len(differ)
                    forward += first
                start, end = at - extent_back(words, at, p), at + p + forward
                open_ended = start == 0 and not ends[0] or end == n and not ends[1]
                if open_ended or end - start >= max(LEAST, TIMES * p):
                    found.add((p, start, end))
            if p + z[p] > reach and z[p] >= p:
                reach = p + z[p]
                shorter.append((p, reach))
    return found


def tiles_of(n: int, least_core: int = CORE) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(low octave, high octave, start, end, core start, core end) of the tiles of a text of n words.

    A tile of an octave reaches one period over its core to the left and two octaves to the right, which holds two whole
    periods behind each boundary and an overlap of a period with the next tile. Octaves whose tile would be the same
    stretch share one.
    """
    high = max(n // TIMES, 1).bit_length() - 1
    octave = 0
    while octave <= high:
        core = max(least_core, CORE_PERIODS << octave)
        last = octave
        while last < high and max(least_core, CORE_PERIODS << last + 1) == core:
            last += 1
        if core >= n:
            last = high
        widest = 1 << last
        for at in range(0, n, core):
            # the start is a multiple of every period of the tile's octaves, as cores are
            yield octave, last, max(0, at - widest), min(n, at + core + 4 * widest), at, min(n, at + core)
        octave = last + 1


def repeated_words(ids: np.ndarray, h: int | None) -> np.ndarray:
    """The contract's changed texts: where h ends in 0, words from a place on repeat a stretch of some period."""
    n = len(ids)
    if h is None or h % 10 or not n:
        return ids
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return ids[np.where(at < a, at, a + (at - a) % p)]


class Words:
    """The words of a chunk of texts: ids that are equal for equal words, and their bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        starts, ends, self.counts = arrays.word_spans(data, offsets)
        kept = data[~arrays.SEPARATOR[data]]
        bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        self.words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(kept))])
        coded = self.words.dictionary_encode()
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        self.dictionary = coded.dictionary
        self.firsts = np.cumsum(self.counts) - self.counts

    def of(self, row: int, h: int | None) -> np.ndarray:
        return repeated_words(self.ids[self.firsts[row] : self.firsts[row] + self.counts[row]], h)

    def joined(self, ids: np.ndarray) -> bytes:
        return b" ".join(self.dictionary.take(pa.array(ids)).to_pylist())


def pieces_of(words: np.ndarray, tiles: Iterator[tuple[int, int, int, int, int, int]]) -> set[tuple[int, int, int]]:
    found = set()
    for low, high, start, end, core_start, core_end in tiles:
        for octave in range(low, high + 1):
            own = tile_pieces(words[start:end], octave, core_start - start, core_end - start, (start == 0, end == len(words)))
            found |= {(p, s + start, e + start) for p, s, e in own}
    return found


def keyed(docs: DataFrame, changed: Column) -> DataFrame:
    """doc_id, k1, k2, h, text: rows of one id, text and change have one key of 128 bits."""
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), changed.cast("long").alias("h"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return held.select(F.xxhash64(named, "h", "text").alias("k1"), F.xxhash64("text", "h", named, F.lit(1)).alias("k2"), "doc_id", "h", "text")


def solved(rows: DataFrame, core: int) -> DataFrame:
    """keyed rows -> the same with n, plain_sha256 (of all words) and pieces; text is kept, its words one blank apart, where pieces are."""

    @arrays.returning
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.text_bytes(batch.column(4))
            hs = batch.column(3).to_pylist()
            for low, high in arrays.chunks(offsets):
                chunk = Words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                plain, texts, found = [], [], []
                for row in range(high - low):
                    words = chunk.of(row, hs[low + row])
                    own = sorted(pieces_of(words, tiles_of(len(words), core))) if len(words) >= LEAST else []
                    text = chunk.joined(words)
                    plain.append(hashlib.sha256(text).hexdigest())
                    texts.append(text.decode() if own else None)
                    found.append([{"period": p, "start": s, "end": e} for p, s, e in own])
                part = batch.slice(low, high - low)
                kind = pa.list_(pa.struct([("period", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(plain), pa.array(texts, pa.string()), pa.array(found, kind)],
                    names=["k1", "k2", "doc_id", "plain_sha256", "text", "pieces"],
                )

    return rows.mapInArrow(work, "k1 long, k2 long, doc_id long, plain_sha256 string, text string, pieces array<struct<period:int,start:int,end:int>>")


def exploded(rows: DataFrame, core: int) -> DataFrame:
    """keyed rows of long texts -> a row for each tile, with its words as numbers."""

    @arrays.returning
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                data, offsets = arrays.text_bytes(batch.column(4).slice(row, 1))
                words = Words(data, offsets).of(0, batch.column(3)[row].as_py())
                for low, high, start, end, core_start, core_end in tiles_of(len(words), core):
                    own = words[start:end]
                    yield pa.RecordBatch.from_pylist(
                        [{"k1": batch.column(0)[row].as_py(), "k2": batch.column(1)[row].as_py(), "n": len(words), "low": low, "high": high, "start": start, "core_start": core_start, "core_end": core_end}]
                    ).append_column("words", pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), pa.array(own)))

    return rows.mapInArrow(work, "k1 long, k2 long, n long, low long, high long, start long, core_start long, core_end long, words array<int>")


def tiles_solved(tiles: DataFrame) -> DataFrame:
    """The pieces of tiles, each by itself."""

    @arrays.returning
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                tile = batch.slice(row, 1)
                words = tile.column(8).flatten().to_numpy(zero_copy_only=False)
                k1, k2, n, low, high, start, core_start, core_end = (tile.column(i)[0].as_py() for i in range(8))
                found = set()
                for octave in range(low, high + 1):
                    found |= tile_pieces(words, octave, core_start - start, core_end - start, (start == 0, start + len(words) == n))
                yield pa.RecordBatch.from_pylist(
                    [{"k1": k1, "k2": k2, "period": p, "start": s + start, "end": e + start} for p, s, e in found],
                    pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("period", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]),
                )

    return tiles.mapInArrow(work, "k1 long, k2 long, period int, start int, end int")


def stitched(pieces: DataFrame) -> DataFrame:
    """pieces[k1, k2, period, start, end] -> whole runs: pieces of one document and period that overlap by a period are one.

    Equal pieces of repeated rows are dropped before the shuffle.
    """
    key = ["k1", "k2", "period"]
    own = Window.partitionBy(*key).orderBy("start", "end")
    before = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    marked = pieces.distinct().withColumn("_new", F.coalesce(F.col("start") > before - F.col("period"), F.lit(True)).cast("int"))
    runs = marked.withColumn("_run", F.sum("_new").over(own)).groupBy(*key, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    runs = runs.withColumn("length", F.col("end") - F.col("start")).drop("_run", "end")
    return runs.filter(F.col("length") >= F.greatest(F.lit(LEAST), F.col("period") * TIMES))


def collapsed(rows: DataFrame) -> DataFrame:
    """rows[doc_id, text, runs (start, period, length in order)] with the digests and the greatest run, and the text without repeats."""

    def best(runs: list[dict]) -> dict:
        top = runs[0]
        for r in runs[1:]:  # in order of start and period: only a greater one takes over
            if r["length"] * top["period"] > top["length"] * r["period"]:
                top = r
        return top

    @arrays.returning
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, runs = (batch.column(i).to_pylist() for i in range(3))
            out = []
            for doc_id, text, own in zip(ids, texts, runs):
                words = text.split(" ")
                dropped = np.zeros(len(words) + 1, np.int64)
                for r in own:
                    dropped[r["start"] + r["period"]] += 1
                    dropped[r["start"] + r["length"]] -= 1
                kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0).tolist()
                left = " ".join([words[i] for i in kept])
                lines = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in own)
                out.append({"doc_id": doc_id, "n_runs": len(own), "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(), "collapsed": left, **best(own)})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("runs_sha256", pa.string()), ("collapsed", pa.string())]))

    return rows.mapInArrow(work, "doc_id long, n_runs long, start long, length long, period long, runs_sha256 string, collapsed string")


def find_runs(docs: DataFrame, changed: Column | None = None, long_bytes: int = LONG, core: int = CORE) -> tuple[DataFrame, DataFrame]:
    """(texts, runs) of docs[doc_id, text]: stored rows k1, k2, doc_id, plain_sha256, text, and runs by k1 and k2 in an array.

    A run is a longest stretch of words with a smallest period, LEAST words and TIMES periods long at least. `changed` is
    the number that may change a row's words (see repeated_words), none if left out.

    Cores of tiles have `core` words at least, a power of two. Texts up to `long_bytes` have their tiles solved where they are read; those of longer ones are exploded to rows and
    dealt out, so one text of any length is work for many tasks (its widest octaves' tiles are the whole text). Pieces are
    shuffled by document and period. Null and empty texts and those under LEAST words have no runs; rows of one id and
    text share their runs, and each is a row of the result; an empty table gives none. Ids may be null.
    """
    common.small_batches(docs.sparkSession)
    rows = keyed(docs, F.lit(None) if changed is None else changed)
    long = F.octet_length("text") > long_bytes
    texts = common.stored(solved(rows.filter(~long), core), "runs-texts")
    spread = exploded(rows.filter(long), core).repartition("k1", "low", "core_start")
    far = common.stored(tiles_solved(spread), "runs-tiles")
    own = texts.select("k1", "k2", F.explode("pieces").alias("p")).select("k1", "k2", "p.period", "p.start", "p.end")
    runs = stitched(own.unionByName(far))
    runs = runs.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    return texts.drop("pieces").unionByName(plain(rows.filter(long))), common.stored(runs, "runs")


def plain(rows: DataFrame) -> DataFrame:
    """Long texts as solved() gives them, with text kept and without pieces."""

    @arrays.returning
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                chunk = Words(*arrays.text_bytes(batch.column(4).slice(row, 1)))
                text = chunk.joined(chunk.of(0, batch.column(3)[row].as_py()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(row, 1) for i in range(3)), pa.array([hashlib.sha256(text).hexdigest()]), pa.array([text.decode()])],
                    names=["k1", "k2", "doc_id", "plain_sha256", "text"],
                )

    return rows.mapInArrow(work, "k1 long, k2 long, doc_id long, plain_sha256 string, text string")


def collapse(texts: DataFrame, runs: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period of the greatest run, runs_sha256 and collapsed_sha256 of every text.

    Only texts that had pieces are shuffled, to meet their runs.
    """
    none = hashlib.sha256(b"").hexdigest()
    nothing = [F.lit(None).cast("long").alias(c) for c in ("start", "length", "period")]
    bare = lambda df: df.select("doc_id", F.lit(0).cast("long").alias("n_runs"), *nothing, F.lit(none).alias("runs_sha256"), F.col("plain_sha256").alias("collapsed_sha256"))
    met = texts.filter("text IS NOT NULL").join(runs, ["k1", "k2"], "left")
    found = collapsed(met.filter("runs IS NOT NULL").select("doc_id", "text", "runs"))
    found = found.select("doc_id", "n_runs", "start", "length", "period", "runs_sha256", F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return bare(texts.filter("text IS NULL")).unionByName(bare(met.filter("runs IS NULL"))).unionByName(found)


def query(spark, sf_dir):
    """A null id changes nothing."""
    docs = common.table(spark, sf_dir, "documents")
    texts, runs = find_runs(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")))
    milli = F.floor(F.lit(1000) * F.col("length") / F.col("period")).cast("long")
    return collapse(texts, runs).withColumn("exponent_milli", milli)


#: Every word against every equal one up to a third of the text on; stretches of such pairs are islands, divisors' stretches win.
ORACLE = rf"""
WITH h AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         xor({common.CRC32.format("doc_id::VARCHAR")}, 4294967295::BIGINT) AS h
  FROM documents
), d AS (
  SELECT *, len(ws) AS n, (h // 10) % nullif(len(ws), 0) AS a, 1 + (len(ws) - (h // 10) % nullif(len(ws), 0)) // (3 + (h // 10) % 8) AS p FROM h
), t AS (
  SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: ws[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE ws END AS ws FROM d
), e AS (
  SELECT rid, n, unnest(ws) AS word, unnest(range(n)) AS i FROM t
), g AS (
  SELECT x.rid, y.i - x.i AS q, x.i, x.i - row_number() OVER (PARTITION BY x.rid, y.i - x.i ORDER BY x.i) AS g
  FROM e x JOIN e y ON x.rid = y.rid AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // 3
), s AS (
  SELECT rid, q, min(i) AS start, count(*) + q AS length FROM g GROUP BY rid, q, g HAVING count(*) + q >= greatest(24, 3 * q)
), r AS (
  SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM s o WHERE o.rid = s.rid AND o.q < s.q AND s.q % o.q = 0 AND o.start <= s.start AND o.start + o.length >= s.start + s.length)
), top AS (
  SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length / q DESC, start, q) = 1
), lines AS (
  SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines FROM r GROUP BY rid
), kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS text FROM e WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.rid = e.rid AND e.i >= r.start + r.q AND e.i < r.start + r.length) GROUP BY rid
)
SELECT t.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.start::BIGINT AS start, top.length::BIGINT AS length, top.q::BIGINT AS period, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(kept.text, '')) AS collapsed_sha256, (1000 * top.length // top.q)::BIGINT AS exponent_milli
FROM t LEFT JOIN top USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN kept USING (rid)
"""
