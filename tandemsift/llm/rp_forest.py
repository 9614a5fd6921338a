"""Approximate nearest neighbours: random-projection trees, one priority queue for all, exact reranking."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, vectors

#: Rows that the trees are fitted on, at most: those of the smallest hashes. Every row is indexed.
SAMPLE = 1 << 14
TREES, LEAF = 16, 128
#: Share of the true neighbours that the visited leaves must hold, measured on PROBES rows of the sample.
RECALL, PROBES = 0.95, 128
#: Index rows and queries that are reranked together, and pairs that are kept between two looks at the best.
BLOCK, QUERIES, PAIRS = 1 << 13, 1 << 12, 1 << 20


@dataclass
class Forest:
    """All trees' nodes in one set of arrays; children below 0 are leaves (-1 - leaf)."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    roots: list[int]
    leaves: int


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with a coordinate more, so that all are of one length and inner products order as angles do."""
    return np.c_[x, np.sqrt(np.maximum(0.0, longest**2 - (x * x).sum(axis=1)))]


def build(x: np.ndarray, trees: int, leaf: int, seed: int = 7) -> Forest:
    """Trees over sample rows. A node parts its rows by the plane between two means that it finds on a few of them."""
    rng = np.random.default_rng(seed)
    normals, offsets, children, roots, leaves = [], [], [], [], 0

    def plane(rows: np.ndarray) -> tuple[np.ndarray, float]:
        a, b = x[rng.choice(rows, 2, replace=False)]
        for _ in range(6):
            some = x[rng.choice(rows, min(len(rows), 128), replace=False)]
            near = ((some - a) ** 2).sum(axis=1) < ((some - b) ** 2).sum(axis=1)
            if near.all() or not near.any():
                break
            a, b = some[near].mean(axis=0), some[~near].mean(axis=0)
        w = a - b
        size = np.linalg.norm(w)
        w = w / size if size > 1e-12 else rng.normal(size=len(w))
        return w, float(-w @ (a + b) / 2)

    for _ in range(trees):
        work = [(np.arange(len(x)), -1, 0)]
        while work:
            rows, parent, side = work.pop()
            child = None
            if len(rows) > leaf:
                for attempt in range(3):
                    w, o = plane(rows)
                    right = x[rows] @ w + o > 0
                    if 0 < right.sum() < len(rows) and (attempt == 2 or 0.05 < right.mean() < 0.95):
                        child = len(normals)
                        normals.append(w)
                        offsets.append(o)
                        children.append([0, 0])
                        work += [(rows[~right], child, 0), (rows[right], child, 1)]
                        break
            if child is None:  # small enough, or of rows that no plane parts
                leaves += 1
                child = -leaves
            if parent < 0:
                roots.append(child)
            else:
                children[parent][side] = child
    d = x.shape[1]
    return Forest(np.array(normals).reshape(-1, d), np.array(offsets), np.array(children, np.int64).reshape(-1, 2), roots, leaves)


def leaves_of(forest: Forest, x: np.ndarray) -> np.ndarray:
    """The leaf of each row in each tree."""
    out = np.empty((len(forest.roots), len(x)), np.int64)
    for t, root in enumerate(forest.roots):
        at = np.full(len(x), root)
        while len(live := np.flatnonzero(at >= 0)):
            node = at[live]
            side = np.einsum("ij,ij->i", x[live], forest.normals[node]) + forest.offsets[node] > 0
            at[live] = forest.children[node, side.astype(np.int64)]
        out[t] = -1 - at
    return out


def search(forest: Forest, margins: np.ndarray, sizes: np.ndarray, wanted: float) -> list[int]:
    """The leaves that a query visits: the best open node of all trees first, until they hold enough rows."""
    heap = [(-np.inf, root) for root in forest.roots]
    heapq.heapify(heap)
    found, rows = [], 0
    while heap and rows < wanted:
        bound, node = heapq.heappop(heap)
        if node < 0:
            found.append(-1 - node)
            rows += sizes[-1 - node]
        else:
            m = margins[node]
            left, right = forest.children[node]
            heapq.heappush(heap, (max(bound, m), left))
            heapq.heappush(heap, (max(bound, -m), right))
    return found


def asking(q: np.ndarray, longest: float) -> np.ndarray:
    """Queries in the lifted space."""
    return np.c_[q * (longest / np.linalg.norm(q, axis=1))[:, None], np.zeros(len(q))]


def leaf_bounds(forest: Forest, margins: np.ndarray) -> np.ndarray:
    """Of each query (a row of margins) the place of every leaf in the queue: search() visits leaves in this order."""
    nodes, leaves = np.full((len(forest.normals), len(margins)), -np.inf), np.full((forest.leaves, len(margins)), -np.inf)
    for node, sides in enumerate(forest.children.tolist()):  # a node comes before its children
        for child, margin in zip(sides, (margins[:, node], -margins[:, node]), strict=True):
            (nodes if child >= 0 else leaves)[child if child >= 0 else -1 - child] = np.maximum(nodes[node], margin)
    return leaves.T


def share_needed(forest: Forest, x: np.ndarray, longest: float, k: int, recall: float) -> float:
    """How many rows, as a share of all, a query's leaves must hold in all to have `recall` of its k nearest.

    Measured on the first rows x (lifted) of the sample as queries and the whole sample as candidates.
    """
    if recall >= 1 or len(x) < 2:
        return float(len(forest.roots))
    q, plain = x[:PROBES, :-1], x[:, :-1]
    score = q @ plain.T
    score[np.arange(len(q)), np.arange(len(q))] = -np.inf
    k = min(k, len(x) - 1)
    truth = np.argpartition(-score, k - 1, axis=1)[:, :k]
    leaves = leaves_of(forest, x)
    sizes = np.bincount(leaves.ravel(), minlength=forest.leaves)
    order = np.argsort(leaf_bounds(forest, asking(q, longest) @ forest.normals.T + forest.offsets), axis=1, kind="stable")
    need = np.empty((len(q), k))
    for i, visited in enumerate(order):
        before = np.empty(forest.leaves)
        before[visited] = np.cumsum(sizes[visited]) - sizes[visited]
        need[i] = before[leaves[:, truth[i]]].min(axis=0)
    return (float(np.quantile(need, recall, method="higher")) + 1) / len(x)


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products summed component by component, in order."""
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += x[:, k] * q[..., k]
    return total


def rerank(ids: np.ndarray, x: np.ndarray, leaves: np.ndarray, query_ids: np.ndarray, q: np.ndarray, visits: tuple[np.ndarray, np.ndarray], k: int) -> tuple[list, list]:
    """The k best rows of a block for each query among those in its leaves, ties to smaller ids.

    leaves holds each row's leaves, visits the leaf and the query of each visit. One matrix product for each leaf
    gives the inner products of its rows and all queries that visit it; those that can't be among a
    query's k best are dropped as the best so far rise.
    """
    n, least = len(ids), np.full(len(q), -np.inf)  # least: what a pair's product must reach to be looked at
    row_order, visit_order = np.argsort(leaves.ravel(), kind="stable"), np.argsort(visits[0], kind="stable")
    row_leaf, rows = leaves.ravel()[row_order], row_order // leaves.shape[1]
    visit_leaf, visitors = visits[0][visit_order], visits[1][visit_order]
    place = dict(zip(ids.tolist(), range(n), strict=True))
    own = np.array([i * n + place[j] if j in place else -1 for i, j in enumerate(query_ids.tolist())], np.int64)
    keys, scores, held = [], [], 0

    def best() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best pairs so far in order, with their products and exact scores."""
        key, first = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_index=True)
        score = np.concatenate([np.zeros(0), *scores])[first]
        open_ = ~np.isin(key, own)
        key, score = key[open_], score[open_]
        order = np.lexsort((-score, key // n))
        key, score = key[order], score[order]
        asked, first, count = np.unique(key // n, return_index=True, return_counts=True)
        full = count >= k
        known = score[first[full] + k - 1]
        least[asked[full]] = known - 1e-9 * (1 + np.abs(known))  # products may round otherwise than exact scores
        open_ = score >= least[key // n]
        key, score = key[open_], score[open_]
        true = np.concatenate([np.zeros(0), *(exact(x[key[s : s + 65536] % n], q[key[s : s + 65536] // n]) for s in range(0, len(key), 65536))])
        order = np.lexsort((ids[key % n], -true, key // n))
        asked = key[order] // n
        top = order[np.arange(len(order)) - np.searchsorted(asked, asked) < k]
        return key[top], score[top], true[top]

    both = np.intersect1d(row_leaf, visit_leaf)
    ends = [np.searchsorted(where, both, side=side).tolist() for where in (row_leaf, visit_leaf) for side in ("left", "right")]
    for r0, r1, v0, v1 in zip(*ends, strict=True):
        some, who = rows[r0:r1], visitors[v0:v1]
        product = q[who] @ x[some].T
        at = np.flatnonzero((product >= least[who, None]).ravel())
        a, b = np.divmod(at, len(some))
        keys.append(who[a] * n + some[b])
        scores.append(product.ravel()[at])
        held += len(at)
        if held > PAIRS:
            key, score, _ = best()
            keys, scores, held = [key], [score], len(key)
    key, _, score = best()
    cuts = np.searchsorted(key // n, np.arange(1, len(q)))
    return [ids[s % n] for s in np.split(key, cuts)], np.split(score, cuts)


def neighbours(
    table: DataFrame, k: int = 20, step: int = vectors.QUERY_STEP, trees: int = TREES, leaf: int = LEAF, recall: float = RECALL, sample: int = SAMPLE
) -> DataFrame:
    """table[vec_id, embedding] -> query_id, rank, vec_id, score: the k largest inner products found.

    Queries are the rows whose vec_id is divisible by `step`, candidates all others. The trees are fitted
    on a bounded sample and sent to the workers; every row gets its leaf in each. How many rows a query's
    leaves hold in all is a share of the table, found on the sample such that they have `recall` of the
    nearest there (1 visits every leaf). Rows lie in blocks by their first tree's leaf, once each with their
    leaves; a query goes to the blocks that have rows in a leaf it visits, where one matrix product a leaf gives
    its inner products, and those of the best are worked out again on the vectors in order.

    Null or zero vectors and those with null or non-finite components take no part, nor those of another
    length than the most frequent (ties to the longer). Of equal vectors the smallest ids alone are indexed,
    one more than could be reported. Of rows that repeat an id the least vector counts. Ties go to the smaller
    id. An empty table gives none; other columns are ignored.
    """
    spark = table.sparkSession
    rows, dim = vectors.usable(table)
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = common.stored(rows.filter(F.exists("vector", lambda x: x != 0)), "vectors")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    count, asked, longest = rows.agg(F.count("*"), F.count_if(F.col("vec_id") % step == 0), F.coalesce(F.max(norm), F.lit(0.0))).first()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    few = vectors.matrix(rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow().column("vector"), dim)
    few = few[np.sort(np.unique(few, axis=0, return_index=True)[1])]
    x = lifted(few, longest)
    made = build(x, trees, max(8, leaf * len(x) // count))
    # of a query's k nearest, so many are expected in the sample
    share = share_needed(made, x, longest, max(1, round(k * len(x) / count)), recall)
    # consecutive leaves of the first tree make a cell of a block or more
    first_leaves = np.bincount(leaves_of(made, x)[0], minlength=made.leaves)
    cells = np.unique((np.cumsum(first_leaves) - first_leaves) * count // (len(x) * BLOCK), return_inverse=True)[1]
    forest = spark.sparkContext.broadcast((made, cells))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, cells = forest.value
        for batch in batches:
            found = leaves_of(made, lifted(vectors.matrix(batch.column("vector"), dim), longest))
            flat = pa.array(np.ascontiguousarray(found.T).ravel().astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells[found[0]]), pa.FixedSizeListArray.from_arrays(flat, len(found)).cast(pa.list_(pa.int32()))], names=["vec_id", "vector", "cell", "leaves"])

    own = Window.partitionBy("vector").orderBy("vec_id")
    distinct = rows.withColumn("_place", F.row_number().over(own)).filter(F.col("_place") <= k + 1).drop("_place")
    placed = common.stored(distinct.mapInArrow(routed, "vec_id long, vector array<double>, cell long, leaves array<int>"), "placed")
    # bounded by the sample: a row for each cell, and one for each leaf
    held = dict(placed.groupBy("cell").count().collect())
    sizes = np.zeros(made.leaves, np.int64)
    for leaf_id, n in placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect():
        sizes[leaf_id] = n
    bit = F.col("leaf") + 1
    maps = placed.select("cell", F.explode("leaves").alias("leaf")).groupBy("cell", F.bitmap_bucket_number(bit).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    width = 1 << 12  # bytes of a bitmap, as Spark fixes it
    has = np.zeros((int(cells.max()) + 1, -(-made.leaves // (8 * width)) * width), np.uint8)
    for cell, part, bits in maps.collect():
        has[cell, (part - 1) * width : part * width] = np.frombuffer(bits, np.uint8)
    shared = spark.sparkContext.broadcast((sizes, has))
    wanted = share * count

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with the leaves that they visit and the cells that have rows of these."""
        size, has = shared.value
        made, size_list = forest.value[0], size.tolist()
        for whole in batches:
            for low in range(0, whole.num_rows, 256):
                batch = whole.slice(low, 256)
                margins = asking(vectors.matrix(batch.column("vector"), dim), longest) @ made.normals.T + made.offsets
                visits, where = [], []
                for i in range(batch.num_rows):
                    visits.append(np.array(search(made, margins[i].tolist(), size_list, wanted), np.int32))
                    seen = np.zeros(has.shape[1] * 8, bool)
                    seen[visits[-1]] = True
                    where.append(np.flatnonzero((has & np.packbits(seen, bitorder="little")).any(axis=1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(visits, pa.list_(pa.int32())), pa.array(where, pa.list_(pa.int64()))], names=["query_id", "vector", "visits", "cells"])

    dealt = rows.filter(F.col("vec_id") % step == 0).repartition(max(1, -(-asked // 256)))
    visits = common.stored(dealt.mapInArrow(sent, "query_id long, vector array<double>, visits array<int>, cells array<long>"), "visits")
    common.remove(rows, spark)
    # a cell's rows are dealt to blocks, its queries to parts, both of bounded size
    asking_of = dict(visits.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect())
    blocks = {c: -(-n // BLOCK) for c, n in held.items()}
    parts = {c: -(-n // QUERIES) for c, n in asking_of.items()}
    of_cell = F.broadcast(spark.createDataFrame([(c, blocks[c], parts[c]) for c in blocks if c in parts], "cell long, blocks long, parts long"))
    below = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    tasks = max(1, min(1 << 13, 2 * sum(blocks[c] * parts.get(c, 0) for c in blocks)))
    keys = ["cell", "block", "part"]
    index_rows = placed.join(of_cell, "cell").withColumns({"block": F.pmod(F.xxhash64("vec_id"), "blocks"), "part": F.explode(below("parts"))}).drop("blocks", "parts").repartition(tasks, *keys)
    query_rows = visits.withColumn("cell", F.explode("cells")).drop("cells").join(of_cell, "cell").withColumns({"part": F.pmod(F.xxhash64("query_id"), "parts"), "block": F.explode(below("blocks"))}).drop("blocks", "parts").repartition(tasks, *keys)

    def reranked(left: pa.Table, right: pa.Table) -> pa.Table:
        query_ids = vectors.numbers(right.column("query_id"))
        if not left.num_rows or not right.num_rows:
            found = [[] for _ in query_ids], [[] for _ in query_ids]
        else:
            visit = right.column("visits").combine_chunks()
            who = np.repeat(np.arange(len(visit)), np.diff(visit.offsets.to_numpy()))
            leaves = vectors.matrix(left.column("leaves"), trees)
            found = rerank(vectors.numbers(left.column("vec_id")), vectors.matrix(left.column("vector"), dim), leaves, query_ids, vectors.matrix(right.column("vector"), dim), (visit.flatten().to_numpy(), who), k)
        return pa.table({"query_id": pa.array(query_ids, pa.int64()), "ids": pa.array(found[0], pa.list_(pa.int64())), "scores": pa.array(found[1], pa.list_(pa.float64()))})

    found = index_rows.groupBy(*keys).cogroup(query_rows.groupBy(*keys)).applyInArrow(reranked, "query_id long, ids array<long>, scores array<double>")
    return vectors.merged_top(found, k, "double")


def query(spark, sf_dir):
    return neighbours(common.table(spark, sf_dir, "embeddings"))
