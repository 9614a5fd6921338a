"""Interpolated modified Kneser-Ney bigram model, counted in Spark and scored from memory-mapped arrays."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, common, files

#: Tokens that a task holds before it sends their counts on.
FLUSH = 2 << 20
END = np.uint64(0x1D5F3C6A9B7E2480)
#: Id of the context before a text's first token in arrays of ids; in packed pairs it is the highest number of its bits.
BEGIN = np.int64(2**62)
#: Bits of a word id in packed pairs, at least.
BITS = 32
PARTIAL = "kind string, shard int, a binary, b binary, c binary"


@dataclass(frozen=True)
class Model:
    """Where the arrays lie and the few numbers that hold for all of them."""

    folder: str
    shards: int
    starts: list[int]  # the first id of each vocabulary shard, and the number of words
    train_tokens: int
    discounts: dict[int, list[float]]  # by order: for counts 0, 1, 2 and more
    continuations: int  # distinct bigrams
    words_continued: tuple[int, int, int]  # words by continuation count: 1, 2 and more
    begin: tuple[int, int, int, int]  # total, n1, n2, n3 of the context before a text
    bits: int = BITS


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows, an end after each, and the number of tokens of each row."""
    data = arrays.TO_LOWER[data]
    starts, ends, words = arrays.word_spans(data, offsets)
    hashes = arrays.span_hashes(data, starts, ends)
    out = np.empty(len(hashes) + len(words), np.uint64)
    last = np.cumsum(words + 1) - 1
    inside = np.ones(len(out), bool)
    inside[last] = False
    out[last] = END
    out[inside] = hashes
    return out, words + 1


def held_out(ids: pa.Array) -> np.ndarray:
    return np.array([zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i in ids.to_pylist()], bool)


def token_chunks(batches: Iterator[pa.RecordBatch], training: bool) -> Iterator[tuple]:
    """(ids, held out, token hashes, tokens of each row) for stretches of rows."""
    for batch in batches:
        ids, out = batch.column(0), held_out(batch.column(0))
        text = batch.column(1)
        if training:
            keep = pa.array(~out)
            ids, text, out = ids.filter(keep), text.filter(keep), out[~out]
        data, offsets = arrays.text_bytes(text)
        for low, high in arrays.chunks(offsets):
            yield ids[low:high], out[low:high], *tokens_of(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])


def counted(ranked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = arrays.run_starts(ranked)
    return ranked[starts], np.diff(np.append(starts, len(ranked)))


def rows(kind: str, shard: np.ndarray, shards: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row of array bytes for each shard that has values."""
    order = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    columns = [c[order] for c in columns]
    full = np.flatnonzero(np.diff(bounds))
    cells = [[c[bounds[s] : bounds[s + 1]].tobytes() for s in full] for c in columns]
    cells += [[None] * len(full)] * (3 - len(cells))
    if len(full):
        yield pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(full)), pa.array(full.astype(np.int32)), *(pa.array(x, pa.binary()) for x in cells)],
            names=["kind", "shard", "a", "b", "c"],
        )


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of sorted batches, one shard after another."""
    shard, held = None, []
    for batch in batches:
        for kind, own, *cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != shard and held:
                yield shard, held
                held = []
            shard = own
            held.append((kind, *cells))
    if held:
        yield shard, held


def joined(held: list[tuple], at: int, kind: np.dtype) -> np.ndarray:
    return np.concatenate([np.frombuffer(row[at], kind) for row in held])


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = arrays.run_starts(keys)
    return keys[starts], np.add.reduceat(counts, starts)


def top_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards in hash order, so that places in shards make ids in hash order."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def key_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((arrays.mixed(keys) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


class Vocabulary:
    """Ids and counts of token hashes."""

    def __init__(self, folder: str, starts: list[int]) -> None:
        self.folder, self.starts, self.shards = folder, np.array(starts), len(starts) - 1
        self.parts: dict[str, np.ndarray] = {}

    def part(self, name: str) -> np.ndarray:
        if name not in self.parts:
            self.parts[name] = files.map_array(self.folder, name)
        return self.parts[name]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Id of each token, -1 if it isn't known."""
        first, group = arrays.grouped(hashes)
        own = hashes[first]  # in the order of their high bits, so also of shards
        found = np.full(len(own), -1, np.int64)
        shard = top_shard(own, self.shards)
        bounds = np.searchsorted(shard, np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(bounds)):
            if self.starts[s] < self.starts[s + 1]:
                part, some = self.part(f"vocabulary-{s}"), slice(bounds[s], bounds[s + 1])
                at = np.minimum(np.searchsorted(part, own[some]), len(part) - 1)
                found[some] = np.where(part[at] == own[some], self.starts[s] + at, -1)
        return found[group]

    def values(self, name: str, ids: np.ndarray, missing: int = 0) -> np.ndarray:
        """A value of each word, from dense arrays by shard."""
        out = np.full(len(ids), missing, np.int64)
        shard = np.searchsorted(self.starts, ids, side="right") - 1
        order = np.argsort(shard.astype(np.int16) if self.shards < 1 << 15 else shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(bounds)):
            some = order[bounds[s] : bounds[s + 1]]
            out[some] = self.part(f"{name}-{s}")[ids[some] - self.starts[s]]
        return out


def previous(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The id before each, BEGIN for the first of a text."""
    before = np.empty(len(ids), np.int64)
    before[1:] = ids[:-1]
    before[np.cumsum(sizes) - sizes] = BEGIN
    return before


class Packing:
    """Pairs of ids as one 64-bit number and a part.

    Ids of up to 32 bits fit whole and there is one part; of wider ones the second id's lowest bits are the part,
    which is kept apart as a range of shards, so pairs stay exact whatever the vocabulary.
    """

    def __init__(self, bits: int, shards: int) -> None:
        self.bits, self.shards, self.low = bits, shards, max(0, 2 * bits - 64)
        self.begin = (1 << bits) - 1
        self.all_shards = shards << self.low

    def pack(self, before: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Packed pairs and the part of each."""
        left = np.where(before == BEGIN, self.begin, before).astype(np.uint64)
        right = ids.astype(np.uint64)
        keys = left << np.uint64(self.bits - self.low) | right >> np.uint64(self.low)
        return keys, (right & np.uint64((1 << self.low) - 1)).astype(np.uint32)

    def shard(self, keys: np.ndarray, part: np.ndarray) -> np.ndarray:
        return part.astype(np.int64) * self.shards + key_shard(keys, self.shards)

    def unpack(self, keys: np.ndarray, shard: int) -> tuple[np.ndarray, np.ndarray]:
        """Both ids of the packed pairs of a shard."""
        width = np.uint64(self.bits - self.low)
        before = (keys >> width).astype(np.int64)
        right = (keys & np.uint64((1 << int(width)) - 1)) << np.uint64(self.low) | np.uint64(shard // self.shards)
        return np.where(before == self.begin, BEGIN, before), right.astype(np.int64)


def discounts(n: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more, from how many keys have count 1 to 4.

    Where a class is missing, as in tiny corpora, its discount is 0.5; none exceeds its count.
    """
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    d = [1 - 2 * y * n2 / n1 if n1 and n2 else 0.5, 2 - 3 * y * n3 / n2 if n2 and n3 else 0.5, 3 - 4 * y * n4 / n3 if n3 and n4 else 0.5]
    return [0.0, *(min(max(x, 0.0), k) for k, x in enumerate(d, 1))]


def counted_pairs(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct packed pairs, the part of each and how often it occurs."""
    keys, part = (np.concatenate(x) for x in zip(*held, strict=True))
    if not part.any():
        keys, counts = counted(np.sort(keys))
        return keys, np.zeros(len(keys), part.dtype), counts
    order = np.lexsort((keys, part))
    keys, part = keys[order], part[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (part[1:] != part[:-1])
    starts = np.flatnonzero(new)
    return keys[starts], part[starts], np.diff(np.append(starts, len(keys)))


def train(docs: DataFrame, shards: int | None = None, bits: int = BITS) -> Model:
    """The model of all documents but the held out ones. docs[doc_id, text].

    Every task counts tokens, then bigrams, in sorted arrays and sends one piece for each shard, so a
    frequent word or pair is one entry of each task's piece. Shards are by hash, so of one size. The
    model lies in the shared folder: the sorted token hashes (a place is a word's id), the sorted
    packed bigrams with their counts, and what each word has as a context. There are as many shards as the
    bytes of text ask for. Ids take `bits` bits, or as many more as the words need.

    Null and empty texts count as the end alone, a null id as an empty string; repeated rows count as often
    as they are there; a text is never cut; without training rows, as on an empty table, every word is unknown;
    other columns are ignored. The session then sends 1,000 rows at most to a worker at once.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string"))
    common.small_batches(spark)
    shards = shards or common.shards_for(docs)
    folder = common.new_folder(spark, "model")

    def count_tokens(batches):
        held, size = [], 0

        def flush():
            keys, counts = counted(np.sort(np.concatenate(held)))
            return rows("token", top_shard(keys, shards), shards, keys, counts)

        for _, _, tokens, _ in token_chunks(batches, training=True):
            held.append(tokens)
            size += len(tokens)
            if size >= FLUSH:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def merge_tokens(batches):
        for shard, held in by_shard(batches):
            keys, counts = summed(joined(held, 1, np.uint64), joined(held, 2, np.int64))
            files.save_array(folder, f"vocabulary-{shard}", keys)
            files.save_array(folder, f"count-{shard}", counts)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "n": [len(keys)], "total": [int(counts.sum())]})

    pieces = common.dealt(docs.mapInArrow(count_tokens, PARTIAL), shards)
    sizes = {r["shard"]: r for r in pieces.mapInArrow(merge_tokens, "shard int, n long, total long").collect()}  # a row for each shard
    starts = np.concatenate([[0], np.cumsum([sizes[s]["n"] if s in sizes else 0 for s in range(shards)])]).tolist()
    bits = max(bits, int(starts[-1] + 1).bit_length())  # one number is left for BEGIN
    packing = Packing(bits, shards)

    def count_bigrams(batches):
        vocabulary = Vocabulary(folder, starts)
        held, size = [], 0

        def flush():
            keys, part, counts = counted_pairs(held)
            return rows("bigram", packing.shard(keys, part), packing.all_shards, keys, counts.astype(np.uint32))

        for _, _, tokens, lengths in token_chunks(batches, training=True):
            ids = vocabulary.ids(tokens)
            held.append(packing.pack(previous(ids, lengths), ids))
            size += len(tokens)
            if size >= FLUSH:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def merge_bigrams(batches):
        edges = np.array(starts)
        for shard, held in by_shard(batches):
            keys, counts = summed(joined(held, 1, np.uint64), joined(held, 2, np.uint32).astype(np.int64))
            files.save_array(folder, f"bigram-{shard}", keys)
            files.save_array(folder, f"pairs-{shard}", counts.astype(np.uint32) if counts.max() < 1 << 32 else counts)
            left, right = packing.unpack(keys, shard)
            first = arrays.run_starts(left)  # keys are sorted by context
            context = left[first]
            sums = np.stack([np.add.reduceat(x, first) for x in (counts, counts == 1, counts == 2, counts >= 3)], axis=1).astype(np.int64)
            begins = context == BEGIN
            yield from rows("begin", np.zeros(begins.sum(), np.int64), 1, sums[begins].view("V32").ravel())
            context, sums = context[~begins], sums[~begins]
            owner = np.searchsorted(edges, context, side="right") - 1
            place, wide = (context - edges[owner]).astype(np.uint32), sums[:, 0] >= 1 << 32
            yield from rows("context", owner[~wide], shards, place[~wide], np.ascontiguousarray(sums[~wide].astype(np.uint32)).view("V16").ravel())
            yield from rows("wide context", owner[wide], shards, place[wide], np.ascontiguousarray(sums[wide]).view("V32").ravel())
            word, times = counted(np.sort(right))
            owner = np.searchsorted(edges, word, side="right") - 1
            yield from rows("word", owner, shards, (word - edges[owner]).astype(np.uint32), times.astype(np.uint32))
            n = np.array([(counts == k).sum() for k in (1, 2, 3, 4)] + [len(counts)], np.int64)
            yield from rows("bigrams", np.zeros(1, np.int64), 1, n.view("V40"))

    parts = common.stored(common.dealt(docs.mapInArrow(count_bigrams, PARTIAL), packing.all_shards).mapInArrow(merge_bigrams, PARTIAL), "contexts")

    def merge_words(batches):
        for shard, held in by_shard(batches):
            size = starts[shard + 1] - starts[shard]
            values = np.zeros((5, size), np.int64)
            for kind, a, b, _ in held:
                at = np.frombuffer(a, np.uint32)
                if kind == "word":
                    values[4, at] += np.frombuffer(b, np.uint32)  # a word is once in each piece
                else:
                    values[:4, at] += np.frombuffer(b, np.uint32 if kind == "context" else np.int64).reshape(-1, 4).T
            for name, value in zip(("total", "once", "twice", "often", "continued"), values, strict=True):
                files.save_array(folder, f"{name}-{shard}", value)
            n = [int((values[4] == k).sum()) for k in (1, 2, 3, 4)]
            yield pa.RecordBatch.from_pydict({f"n{k + 1}": [x] for k, x in enumerate(n)} | {"more": [int((values[4] >= 3).sum())]})

    words = common.dealt(parts.filter("kind in ('word', 'context', 'wide context')"), shards).mapInArrow(merge_words, "n1 long, n2 long, n3 long, n4 long, more long")
    n1, n2, n3, n4, more = words.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n1", "n2", "n3", "n4", "more"))).first()
    few = parts.filter("kind in ('begin', 'bigrams')").select("kind", "a").collect()  # two small rows for each shard
    total = lambda kind, size: np.sum([np.frombuffer(r["a"], np.int64) for r in few if r["kind"] == kind] or [[0] * size], axis=0).tolist()
    *pair_n, pairs = total("bigrams", 5)
    common.remove(parts, spark)
    return Model(
        folder, shards, starts, sum(r["total"] for r in sizes.values()),
        {1: discounts([n1, n2, n3, n4]), 2: discounts(pair_n)}, pairs, (n1, n2, more), tuple(total("begin", 4)), bits,
    )


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.vocabulary, self.packing = model, Vocabulary(model.folder, model.starts), Packing(model.bits, model.shards)

    def pair_counts(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        shards, out = self.packing.all_shards, np.zeros(len(ids), np.int64)
        keys, part = self.packing.pack(before, ids)
        shard = self.packing.shard(keys, part)
        order = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(shards + 1))
        for s in np.flatnonzero(np.diff(bounds)):
            some = order[bounds[s] : bounds[s + 1]]
            try:
                part = self.vocabulary.part(f"bigram-{s}")
            except FileNotFoundError:  # no training bigram fell into this shard
                continue
            at = np.minimum(np.searchsorted(part, keys[some]), len(part) - 1)
            hit = part[at] == keys[some]
            out[some[hit]] = self.vocabulary.part(f"pairs-{s}")[at[hit]]
        return out

    def unigrams(self, ids: np.ndarray) -> np.ndarray:
        """Interpolated continuation probabilities; what the discounts leave is shared by V words and the unknown."""
        m = self.model
        uniform = 1.0 / (m.starts[-1] + 1)
        if not m.continuations:
            return np.full(len(ids), uniform)
        known, d = ids >= 0, np.array(m.discounts[1])
        continued = np.zeros(len(ids), np.int64)
        continued[known] = self.vocabulary.values("continued", ids[known])
        left = sum(n * x for n, x in zip(m.words_continued, d[1:], strict=True)) / m.continuations
        return (continued - d[np.minimum(continued, 3)]) / m.continuations + left * uniform

    def score(self, tokens: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        m, v = self.model, self.vocabulary
        ids = v.ids(tokens)
        known = ids >= 0
        counts = np.zeros(len(ids), np.int64)
        counts[known] = v.values("count", ids[known])
        firsts = np.cumsum(sizes) - sizes
        base = np.log10((counts + 0.1) / (m.train_tokens + 0.1 * (m.starts[-1] + 1)))
        p = self.unigrams(ids)
        before = previous(ids, sizes)
        context = np.zeros((4, len(ids)), np.int64)
        inner = np.flatnonzero((before >= 0) & (before != BEGIN))
        for row, name in zip(context, ("total", "once", "twice", "often"), strict=True):
            row[inner] = v.values(name, before[inner])
        context[:, firsts] = np.array(m.begin)[:, None]
        pair = np.zeros(len(ids), np.int64)
        both = np.flatnonzero(known & (before >= 0))
        pair[both] = self.pair_counts(before[both], ids[both])
        d, seen = np.array(m.discounts[2]), context[0] > 0
        total = context[0, seen]
        left = (context[1:, seen] * d[1:, None]).sum(axis=0) / total
        p[seen] = (pair[seen] - d[np.minimum(pair[seen], 3)]) / total + left * p[seen]
        return {
            "n_tokens": sizes,
            "n_known": np.add.reduceat(known.astype(np.int64), firsts),
            "base_score": np.add.reduceat(base, firsts),
            "score": np.add.reduceat(np.log10(p), firsts),
        }


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every whole text.

    Tokens are the lower-cased words and one end for each text; base_score is the add-0.1 unigram score
    and score the model's log10 probability. Workers map the model's arrays and touch the pages they need.
    Null and empty texts are the end alone; a null id counts as an empty string; repeated rows give
    repeated results; an empty table gives none; texts are never cut.
    """

    def scored(batches):
        scorer = Scorer(model)
        for ids, out, tokens, sizes in token_chunks(batches, training=False):
            got = scorer.score(tokens, sizes)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": ids,
                    "held_out": pa.array(out),
                    "n_tokens": pa.array(got["n_tokens"]),
                    "n_known": pa.array(got["n_known"]),
                    "train_tokens": pa.array(np.full(len(out), model.train_tokens)),
                    "base_score": pa.array(got["base_score"]),
                    "score": pa.array(got["score"]),
                    "perplexity": pa.array(10.0 ** (-got["score"] / got["n_tokens"])),
                }
            )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(scored, schema)


def query(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    return score(docs, train(docs))


def base_query(spark, sf_dir):
    """The columns that SQL can be held against: the split, the counts and, to six places, the base score."""
    return query(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6).alias("base_score"))


#: A blank, which no word holds, stands for the end of a text.
ORACLE_BASE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(xor({common.CRC32.format("doc_id::VARCHAR")}, 4294967295::BIGINT), 0) % 10 = 0 AS held_out,
         list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' ') AS ws
  FROM documents
), t AS (SELECT rid, doc_id, held_out, unnest(ws) AS w FROM d
), c AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY w
), s AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM c)
SELECT any_value(t.doc_id) AS doc_id, bool_or(held_out) AS held_out, count(*)::BIGINT AS n_tokens, count(c.c)::BIGINT AS n_known, any_value(s.n)::BIGINT AS train_tokens,
       round(sum(log10((coalesce(c.c, 0) + 0.1) / (s.n + 0.1 * (s.v + 1)))), 6) AS base_score
FROM t CROSS JOIN s LEFT JOIN c ON c.w = t.w GROUP BY t.rid
"""
