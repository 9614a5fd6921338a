"""N-gram Jaccard self-join by prefixes under several global token orders."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import add, and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, common, components

#: Counters of the frequency sketch and bits of the maps of wanted rows: fixed sizes, whatever the input.
SLOTS = 1 << 22
SLICES = 16
#: Up to so many sets that share a prefix token are paired among themselves at once, more by way of a leader.
GROUP = 64
#: Words of 64 bits of a set's bitmap; sets of hot tokens in a cell's side; pairs that a task tests, about.
WORDS, CELL, PAIRS = 16, 1 << 12, 1 << 24
KEYS = arrays.mixed(np.arange(64, dtype=np.uint64) + np.uint64(7 << 50)) | np.uint64(1)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each n-word shingle of each row, repeats included, and how many each row has.

    Rows of fewer words have their whole sequence as one; rows without words have none.
    """
    data = arrays.TO_LOWER[data]
    starts, ends, words = arrays.word_spans(data, offsets)
    hashes = arrays.span_hashes(data, starts, ends)
    counts = np.where(words >= n, words - n + 1, np.minimum(words, 1))
    firsts = np.cumsum(words) - words
    at = np.repeat(firsts, counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    width = np.repeat(np.minimum(words, n), counts)
    total = width.astype(np.uint64)
    for k in range(n):
        some = width > k
        total[some] += hashes[at[some] + k] * KEYS[k]
    return arrays.mixed(total), counts


def by_row(row: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The order of values within their rows."""
    order = np.argsort(values)
    return order[np.argsort(row[order].astype(np.uint16) if row.size and row[-1] < 1 << 16 else row[order], kind="stable")]


def distinct_shingles(data: np.ndarray, offsets: np.ndarray, n: int, rank: Callable | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row, in the order of their rank (else hash), and the size of each set."""
    hashes, counts = shingle_hashes(data, offsets, n)
    row = np.repeat(np.arange(len(counts)), counts)
    order = by_row(row, rank(hashes) if rank else hashes)
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], np.bincount(row[new], minlength=len(counts)).astype(np.int64)


def signatures(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One number for each set; equal sets have equal numbers."""
    return arrays.mixed(arrays.row_sums(arrays.mixed(hashes ^ KEYS[50]), sizes) + sizes.astype(np.uint64) * KEYS[51])


def bitmaps(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The parities of how many of a set's tokens fall to each of 64 * WORDS places, as words: rows x WORDS.

    Two sets' bitmaps differ in no more places than there are tokens that only one of them has.
    """
    width = 64 * WORDS
    place = (hashes >> np.uint64(32)) % np.uint64(width)
    row = np.repeat(np.arange(len(sizes)), sizes)
    odd = np.bincount(row * width + place.astype(np.int64), minlength=len(sizes) * width).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64).reshape(len(sizes), WORDS)


def needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least intersection of sets of these sizes at which they link."""
    return -((-percent * (a + b)) // (100 + percent))


def prefix_lengths(sizes: np.ndarray, percent: int) -> np.ndarray:
    """So many first tokens of a set under any order hold one of each set that links with it."""
    return np.where(sizes > 0, sizes + (-percent * sizes) // 100 + 1, 0)


def prefixes(hashes: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    firsts = np.cumsum(sizes) - sizes
    return [hashes[f : f + k].tobytes() for f, k in zip(firsts.tolist(), lengths.tolist(), strict=True)]


def slices(total: np.ndarray) -> pa.RecordBatch:
    parts = np.split(total, SLICES)
    return pa.RecordBatch.from_pydict({"slice": pa.array(range(SLICES), pa.int32()), "data": pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())})


def sketch(df: DataFrame, count: Callable[[pa.RecordBatch, np.ndarray], None]) -> np.ndarray:
    """SLOTS counters, summed over all tasks slice by slice; the driver gets an array of that fixed size."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.uint32)
        for batch in batches:
            count(batch, total)
        yield slices(total)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(zlib.decompress(data), np.uint32).astype(np.int64)
                sums[s] = sums[s] + part if s in sums else part
        for s, part in sums.items():
            # powers of two are enough
            level = np.frexp(part.astype(np.float64))[1].astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"slice": pa.array([s], pa.int32()), "data": pa.array([zlib.compress(level.tobytes(), 1)], pa.binary())})

    schema = "slice int, data binary"
    out = np.zeros(SLOTS, np.uint8)
    for s, data in df.mapInArrow(arrays.returning(local), schema).repartition(SLICES, "slice").mapInArrow(arrays.returning(merged), schema).collect():
        out[s * SLOTS // SLICES : (s + 1) * SLOTS // SLICES] = np.frombuffer(zlib.decompress(data), np.uint8)
    return out


def slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(SLOTS - 1)).astype(np.int64)


def id_slots(column: pa.Array) -> np.ndarray:
    return slot(arrays.mixed(pc.fill_null(column.cast(pa.int64()), 0).to_numpy(zero_copy_only=False).astype(np.uint64)))


def order_rank(level: np.ndarray, seed: int) -> Callable[[np.ndarray], np.ndarray]:
    """A global token order: rare before frequent by the sketch, then by a hash of its own."""
    return lambda h: level[slot(h)].astype(np.uint64) << np.uint64(58) | arrays.mixed(h ^ KEYS[seed]) >> np.uint64(6)


def paired(tok: np.ndarray, sig: np.ndarray, n: np.ndarray, pos: np.ndarray, percent: int) -> tuple[list, np.ndarray, np.ndarray]:
    """Candidate pairs of entries sorted by token: (pairs, tokens of large groups, leaders' places).

    A pair passes if the sets' sizes and the token's places in both still leave room for enough shared
    tokens. In large groups only the leader, the entry with the fewest rarer tokens, is paired.
    """

    def passing(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= needed(n[i], n[j], percent)) & (sig[i] != sig[j])
        a, b = sig[i[ok]], sig[j[ok]]
        return np.minimum(a, b), np.maximum(a, b)

    starts = arrays.run_starts(tok)
    size = np.diff(np.append(starts, len(tok)))
    pairs = []
    own = np.repeat(size, size)
    group_end = np.repeat(starts + size, size)
    live = np.flatnonzero((own > 1) & (own <= GROUP))
    for d in range(1, GROUP):
        live = live[live + d < group_end[live]]
        if not len(live):
            break
        pairs.append(passing(live, live + d))
    large = np.flatnonzero(size > GROUP)
    leaders = []
    for s, k in zip(starts[large], size[large], strict=True):
        some = np.arange(s, s + k)
        leader = some[np.lexsort((sig[some], n[some], pos[some]))[0]]
        leaders.append(leader)
        pairs.append(passing(np.full(k, leader), some))
    return pairs, tok[starts[large]], np.array(leaders, np.int64)


def distinct_pairs(pairs: list) -> tuple[np.ndarray, np.ndarray]:
    if not pairs:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    first, _ = arrays.grouped(arrays.mixed(a * KEYS[60] + b))
    return a[first], b[first]


def entries(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """token, set, size and place of each prefix token of the sets in a batch, each set once."""
    sig = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
    first, _ = arrays.grouped(sig)
    data = [batch.column(2)[i].as_py() for i in first]
    lengths = np.array([len(d) // 8 for d in data], np.int64)
    tok = np.frombuffer(b"".join(data), np.uint64)
    pos = np.arange(len(tok)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    n = batch.column(1).to_numpy(zero_copy_only=False)[first]
    return tok, np.repeat(sig[first], lengths), np.repeat(n, lengths), pos


def candidates(sets: DataFrame, percent: int, shards: int) -> DataFrame:
    """sets[sig, n, p1] -> kind, a, b: pairs of sets, or tokens (a) of groups too large to pair at once.

    Each task pairs what it has, sending on only the leader of a large group, so that a token that very
    many sets share is a few entries where the shards meet.
    """
    cells = "kind string, shard int, a binary, b binary, c binary, d binary"

    def cut(kind, shard, columns):
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(shards + 1))
        full = np.flatnonzero(np.diff(bounds))
        columns = [c[order] for c in columns]
        data = [[c[bounds[s] : bounds[s + 1]].tobytes() for s in full] for c in columns] + [[None] * len(full)] * (4 - len(columns))
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(full), pa.string()), pa.array(full.astype(np.int32)), *(pa.array(x, pa.binary()) for x in data)], names=["kind", "shard", "a", "b", "c", "d"]
        )

    def shard_of(h):
        return ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)

    def local(batches):
        for batch in batches:
            tok, sig, n, pos = entries(batch)
            order = np.argsort(tok, kind="stable")
            tok, sig, n, pos = tok[order], sig[order], n[order], pos[order]
            starts = arrays.run_starts(tok)
            own = np.repeat(size := np.diff(np.append(starts, len(tok))), size)
            many = own > GROUP
            pairs, large, leaders = paired(tok[many], sig[many], n[many], pos[many], percent)
            keep = ~many
            keep[np.flatnonzero(many)[leaders]] = True
            a, b = distinct_pairs(pairs)
            yield cut("pair", shard_of(a), [a, b])
            yield cut("large", shard_of(arrays.mixed(large)), [large])
            tok = tok[keep]
            yield cut("entry", shard_of(arrays.mixed(tok)), [tok, sig[keep], n[keep].astype(np.uint32), pos[keep].astype(np.uint32)])

    def finish(held):
        pairs, large = [], []
        got = {k: [r for r in held if r[0] == k] for k in ("pair", "large", "entry")}
        read = lambda k, i, t: np.concatenate([np.frombuffer(r[i], t) for r in got[k]])
        if got["pair"]:
            pairs.append((read("pair", 1, np.uint64), read("pair", 2, np.uint64)))
        if got["large"]:
            large.append(read("large", 1, np.uint64))
        if got["entry"]:
            tok, sig, n, pos = (read("entry", i, t) for i, t in ((1, np.uint64), (2, np.uint64), (3, np.uint32), (4, np.uint32)))
            order = np.lexsort((sig, tok))
            tok, sig, n, pos = tok[order], sig[order], n[order].astype(np.int64), pos[order].astype(np.int64)
            new = np.ones(len(tok), bool)
            new[1:] = (tok[1:] != tok[:-1]) | (sig[1:] != sig[:-1])
            more, tokens, _ = paired(tok[new], sig[new], n[new], pos[new], percent)
            pairs += more
            large.append(tokens)
        a, b = distinct_pairs(pairs)
        tokens = np.concatenate(large) if large else np.zeros(0, np.uint64)
        kind = np.array(["pair"] * len(a) + ["large"] * len(tokens), object)
        return pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.string()), pa.array(np.concatenate([a, tokens]).view(np.int64)), pa.array(np.concatenate([b, np.zeros_like(tokens)]).view(np.int64))],
            names=["kind", "a", "b"],
        )

    def merged(batches):
        shard, held = None, []
        for batch in batches:
            for kind, own, *data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != shard and held:
                    yield finish(held)
                    held = []
                shard = own
                held.append((kind, *data))
        if held:
            yield finish(held)

    dealt = sets.select("sig", "n", "p1").mapInArrow(arrays.returning(local), cells)
    return common.dealt(dealt, shards).mapInArrow(arrays.returning(merged), "kind string, a long, b long")


def join(docs: DataFrame, n: int = 4, percent: int = 85, carry: Sequence[str] = ()) -> DataFrame:
    """docs[doc_id, text] -> doc_id, n_shingles, sig, component, component_id: one row for each row of docs.

    Two rows link when 100 * intersection >= percent * union of their sets of distinct n-word shingles
    (words lower-cased in A-Z; fewer than n words count as one shingle). component_id is the smallest
    doc_id that links reach, the row's own included, component a number of the component itself (null for empty
    sets). Columns named in `carry` come along; their names must not be those above.

    Equal sets are one set from the start. Under each of three global orders (rare before frequent by a
    sketch of fixed size, then by a hash of the order's own) linking sets share a prefix token. Pairs are
    made under the first order, with bounds from sizes and places; they must also share enough of their
    prefixes under the other two; what is left is verified on the whole texts. Of a token that many sets
    share, only a leader is paired at first; once the links so far are known, the sets of such tokens that
    are still in different components are paired too, so that no link between components is missed.

    Null and blank texts have empty sets and link with nothing; a null id never becomes a component's
    unless it has no other; rows that repeat an id are rows of their own; an empty table gives none;
    texts are never cut; other columns are ignored. The session then sends 1,000 rows at most to a worker at once.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    carry = list(carry)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *carry)
    carried = docs.select(*carry).schema if carry else None
    shards = common.shards_for(docs)

    def count_shingles(batch, total):
        data, offsets = arrays.text_bytes(batch.column(1))
        for low, high in arrays.chunks(offsets):
            hashes, _ = shingle_hashes(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], n)
            places = np.sort(slot(hashes))
            firsts = arrays.run_starts(places)
            total[places[firsts]] += np.diff(np.append(firsts, len(places))).astype(np.uint32)

    level = spark.sparkContext.broadcast(sketch(docs, count_shingles))

    def make_sets(batches):
        ranks = [order_rank(level.value, k) for k in (1, 2, 3)]
        for batch in batches:
            data, offsets = arrays.text_bytes(batch.column(1))
            for low, high in arrays.chunks(offsets):
                hashes, sizes = distinct_shingles(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], n, ranks[0])
                words = bitmaps(hashes, sizes)
                lengths, row = prefix_lengths(sizes, percent), np.repeat(np.arange(len(sizes)), sizes)
                others = []
                for rank in ranks[1:]:
                    order = by_row(row, value := rank(hashes))
                    others.append(prefixes(value[order].astype(np.uint32), sizes, lengths))
                yield pa.RecordBatch.from_pydict(
                    {
                        **{c: batch.column(c)[low:high] for c in carry},
                        "doc_id": batch.column(0)[low:high],
                        "n": pa.array(sizes),
                        "sig": pa.array(signatures(hashes, sizes).view(np.int64)),
                        "p1": pa.array(prefixes(hashes, sizes, lengths), pa.binary()),
                        "p2": pa.array(others[0], pa.binary()),
                        "p3": pa.array(others[1], pa.binary()),
                        **{f"w{k}": pa.array(words[:, k]) for k in range(WORDS)},
                    }
                )

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in carried) if carry else ""
    sets = common.stored(docs.mapInArrow(arrays.returning(make_sets), kinds + "doc_id long, n long, sig long, p1 binary, p2 binary, p3 binary" + "".join(f", w{k} long" for k in range(WORDS))), "sets")
    docs = docs.drop(*carry)
    full = sets.filter("n > 0")
    classes = common.stored(full.groupBy("sig").agg(F.min("doc_id").alias("rep")), "classes")
    found = common.stored(candidates(full, percent, shards), "candidates")
    pairs = found.filter("kind = 'pair'").select("a", "b").distinct()
    links = verified(docs, full, classes, pairs, n, percent)
    large = found.filter("kind = 'large'").select(F.col("a").alias("token"))
    if large.limit(1).count():
        labels = components.components(links)
        rest = remaining_pairs(full, classes, labels, large, percent).join(pairs, ["a", "b"], "left_anti")
        rest = common.stored(rest, "rest")
        links = links.unionByName(verified(docs, full, classes, rest, n, percent))
    labels = components.components(links)
    reached = classes.join(labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    smallest = reached.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = reached.join(smallest, "component").select("sig", "component", "component_id")
    linked = full.select("doc_id", "n", "sig", *carry).join(named, "sig").select("doc_id", F.col("n").alias("n_shingles"), "sig", "component", "component_id", *carry)
    none = F.lit(None).cast("long").alias("component")
    alone = sets.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), "sig", none, F.col("doc_id").alias("component_id"), *carry)
    return linked.unionByName(alone)


def of_representatives(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """rows[sig, doc_id, ...] of the representatives in nodes[sig, rep]; a set without any id is represented by null."""
    own = nodes.select(F.col("sig").alias("_sig"), F.col("rep").alias("_rep"))
    return rows.join(own, (F.col("sig") == F.col("_sig")) & F.col("doc_id").eqNullSafe(F.col("_rep"))).drop("_sig", "_rep")


def salted(rows: DataFrame, few: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """rows joined with few[*keys, ...], where any number of rows may have one key.

    A key's rows are dealt to GROUP salts by their sets, and its one row of few goes to each. The keys of few have over
    GROUP rows each, so that its copies are no more than the rows.
    """
    mine = rows.withColumn("_salt", F.pmod(F.xxhash64("sig"), F.lit(GROUP)))
    return mine.join(few.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(GROUP - 1).cast("long")))), [*keys, "_salt"], how).drop("_salt")


def dealt_cells(mixed: DataFrame, percent: int, cell: int) -> tuple[DataFrame, DataFrame, int]:
    """Both sides of the pairs to test of mixed[token, sig, n, component, main, ...], and how many pairs these are.

    On the left are the sets outside the main component of their token, on the right all. Sets that link differ in size
    by a factor of 100 / percent at most, so a set meets those of its own band of sizes and of the two beside it. A
    token's band is a grid of cells with about `cell` sets on either side: _i and _j tell the part of the left and of
    the right side.
    """
    # a little wider than the factor, so that rounding can't part sets that link
    band = F.floor(F.log("n") / F.log(F.lit(100 / percent * (1 + 1e-9)))).cast("long")
    rows = mixed.withColumn("_band", band) if percent < 100 else mixed.withColumn("_band", F.col("n"))
    own = F.col("component") != F.col("main")
    near = F.explode(F.array(*[F.col("_band") + d for d in (-1, 0, 1)]))
    counted = rows.groupBy("token", "_band").agg(F.count("*").alias("r"), F.count_if(own).alias("l"))
    left = counted.filter("l > 0").select("token", near.alias("_band"), "l").groupBy("token", "_band").agg(F.sum("l").alias("l"))
    grid = common.stored(left.join(counted.select("token", "_band", "r"), ["token", "_band"], "full").fillna(0, ["l", "r"]), "grid")
    work = grid.agg(F.sum(F.col("l") * F.col("r"))).first()[0] or 0
    parts = lambda c: F.ceil(F.col(c) / F.lit(cell)).alias(f"_{c}")
    crowded = grid.filter((F.col("l") > cell) | (F.col("r") > cell)).select("token", "_band", parts("l"), parts("r"))

    def dealt(side: DataFrame, mine: str, others: str, part: str, copy: str) -> DataFrame:
        placed = salted(side, crowded, ["token", "_band"], "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("_l", "_r")})
        placed = placed.filter(F.col(others) > 0).withColumns({part: F.pmod(F.xxhash64(F.lit("cell"), "sig"), F.col(mine)), copy: F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1))})
        return placed.drop("_l", "_r")

    return dealt(rows.filter(own).withColumn("_band", near), "_l", "_r", "_i", "_j"), dealt(rows, "_r", "_l", "_j", "_i"), work


def remaining_pairs(full: DataFrame, classes: DataFrame, labels: DataFrame, large: DataFrame, percent: int, cell: int = CELL) -> DataFrame:
    """Pairs of sets of different components that share a token of a large group and pass the bounds.

    In each group the largest component's sets are not paired with each other; tokens all of whose sets
    are in one component drop out. The others are paired in cells of bounded size (`dealt_cells`), many of a hot token,
    with a task for some PAIRS pairs. A pair is written only if the token's places and the sets' bitmaps leave room for the
    intersection: bitmaps of linking sets differ in no more places than there are tokens that one of them lacks. That
    decides nearly all pairs of up to some 6,000 tokens a set; larger ones are left to the prefixes of the other orders.
    """
    spark = full.sparkSession

    def mark(batch, total):
        total[slot(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))] = 1

    bits = spark.sparkContext.broadcast(sketch(large, mark) > 0)

    def exploded(batches):
        for batch in batches:
            tok, sig, n, pos = entries(batch)
            keep = bits.value[slot(tok)]
            yield pa.RecordBatch.from_pydict({"token": pa.array(tok[keep].view(np.int64)), "sig": pa.array(sig[keep].view(np.int64)), "n": pa.array(n[keep]), "pos": pa.array(pos[keep])})

    words = [f"w{k}" for k in range(WORDS)]
    reps = of_representatives(full, classes)
    rows = reps.select("sig", "n", "p1").mapInArrow(arrays.returning(exploded), "token long, sig long, n long, pos long").distinct()
    rows = rows.join(labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    rows = common.stored(rows, "entries")
    sizes = rows.groupBy("token", "component").agg(F.count("*").alias("size"))
    main = sizes.groupBy("token").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.count("*").alias("parts")).filter("parts > 1").drop("parts")
    mixed = salted(rows, main.join(large.distinct(), "token", "left_semi"), ["token"])
    mixed = common.stored(mixed.join(reps.select("sig", *words).dropDuplicates(["sig"]), "sig"), "mixed")
    a, b, work = dealt_cells(mixed, percent, cell)
    keys, tasks = ["token", "_band", "_i", "_j"], max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(work // PAIRS, 1 << 15))
    a, b = (side.repartition(tasks, *keys).alias(name) for side, name in ((a, "a"), (b, "b")))  # so many tasks whatever their bytes
    least = F.ceil((F.col("a.n") + F.col("b.n")) * percent / (100 + percent))
    room = F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos"))
    once = (F.col("b.component") == F.col("b.main")) | (F.col("a.sig") < F.col("b.sig"))
    apart = reduce(add, (F.bit_count(F.col(f"a.{w}").bitwiseXOR(F.col(f"b.{w}"))) for w in words))
    meet = reduce(and_, (F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys))
    joined = a.join(b, meet & (F.col("a.component") != F.col("b.component")) & once & (room >= least) & (apart <= F.col("a.n") + F.col("b.n") - 2 * least))
    return joined.select(F.least("a.sig", "b.sig").alias("a"), F.greatest("a.sig", "b.sig").alias("b")).distinct()


def verified(docs: DataFrame, full: DataFrame, classes: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs of sets that link: first the prefixes under the other orders, then the whole texts."""
    spark = docs.sparkSession
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct().join(classes, "sig")
    slim = common.stored(of_representatives(full, nodes).select("sig", "n", "p2", "p3").dropDuplicates(["sig"]), "slim")

    def side(name):
        return slim.select(F.col("sig").alias(name), *(F.col(c).alias(f"{c}{name}") for c in ("n", "p2", "p3")))

    def filtered(batches):
        for batch in batches:
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            least = needed(na, nb, percent)
            ok = np.minimum(na, nb) >= least
            for p in ("p2", "p3"):
                left, right = batch.column(f"{p}a"), batch.column(f"{p}b")
                for i in np.flatnonzero(ok):
                    x, y = np.frombuffer(left[i].as_py(), np.uint32), np.frombuffer(right[i].as_py(), np.uint32)
                    # shared tokens lie in both prefixes or behind the one that ends first
                    ok[i] = np.isin(x, y).sum() + max(na[i] - len(x), nb[i] - len(y)) >= least[i]
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    left = common.stored(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(arrays.returning(filtered), "a long, b long"), "filtered")
    wanted = left.select(F.explode(F.array("a", "b")).alias("sig")).distinct().join(classes, "sig").select("rep")

    def mark(batch, total):
        total[id_slots(batch.column(0))] = 1

    bits = spark.sparkContext.broadcast(sketch(wanted, mark) > 0)

    def fetched(batches):
        for batch in batches:
            batch = batch.filter(pa.array(bits.value[id_slots(batch.column(0))]))
            data, offsets = arrays.text_bytes(batch.column(1))
            for low, high in arrays.chunks(offsets):
                hashes, sizes = distinct_shingles(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], n)
                yield pa.RecordBatch.from_arrays([batch.column(0)[low:high], pa.array(signatures(hashes, sizes).view(np.int64)), batch.column(1)[low:high]], names=["doc_id", "sig", "text"])

    texts = docs.mapInArrow(arrays.returning(fetched), "doc_id long, sig long, text string")
    texts = common.stored(of_representatives(texts, classes).select("sig", "text").dropDuplicates(["sig"]), "texts")

    def checked(batches):
        for batch in batches:
            at = [arrays.text_bytes(batch.column(c)) for c in ("ta", "tb")]
            low, rows = 0, batch.num_rows
            both = at[0][1] + at[1][1]
            for low, high in arrays.chunks(both):
                sides = [distinct_shingles(d[o[low] : o[high]], o[low : high + 1] - o[low], n) for d, o in at]
                row = np.concatenate([np.repeat(np.arange(high - low), s) for _, s in sides])
                value = np.concatenate([h for h, _ in sides])
                order = np.lexsort((value, row))
                row, value = row[order], value[order]
                same = (row[1:] == row[:-1]) & (value[1:] == value[:-1])
                shared = np.bincount(row[1:][same], minlength=high - low)
                keep = pa.array(shared >= needed(sides[0][1], sides[1][1], percent))
                yield pa.RecordBatch.from_arrays([batch.column(c)[low:high].filter(keep) for c in ("a", "b")], names=["a", "b"])

    side = lambda name: texts.select(F.col("sig").alias(name), F.col("text").alias(f"t{name}"))
    links = common.stored(left.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb").mapInArrow(arrays.returning(checked), "a long, b long"), "links")
    for done in (slim, left, texts):
        common.remove(done, spark)
    return links


def survivors(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of linked rows of docs, as they are: that of the smallest doc_id.

    Rows are told apart by two hashes of all their columns, so of rows that share an id, or have none, each is judged
    for itself: of a component's rows with the smallest id the one with the smaller hashes stays (a null id counts as the
    largest), and of rows that are equal in all columns one. Rows without words link with nothing and all stay. An
    empty table gives none; columns named _row and _other are this function's own.
    """
    marks = {"_row": F.xxhash64(*docs.columns), "_other": F.xxhash64(F.lit("other"), *docs.columns)}
    spark, mark = docs.sparkSession, common.mark()
    found = common.stored(join(docs.withColumns(marks), n, percent, carry=list(marks)).filter("n_shingles > 0").select("doc_id", "component", *marks), "components")
    common.clean(spark, mark, found)  # what the join stored isn't read any more
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *marks)
    first = found.groupBy("component").agg(F.min(order).alias("o")).select(*[F.col(f"o.{c}").alias(c) for c in marks])
    gone = common.stored(found.select(*marks).join(first, list(marks), "left_anti").distinct(), "gone")
    twice = common.stored(found.groupBy(*marks).count().filter("count > 1").select(*marks).join(first, list(marks), "left_semi"), "twice")
    common.remove(found, spark)
    rows = docs.withColumns(marks).join(common.bounded(gone), list(marks), "left_anti")
    if not twice.limit(1).count():
        return rows.select(*docs.columns)
    once = rows.join(common.bounded(twice), list(marks), "left_semi").dropDuplicates(docs.columns)
    return rows.join(common.bounded(twice), list(marks), "left_anti").unionByName(once).select(*docs.columns)


def query(spark, sf_dir):
    return join(common.table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
  ) p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * p.c >= 85 * (na.n + nb.n - p.c)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
"""
