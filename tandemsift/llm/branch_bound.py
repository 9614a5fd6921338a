"""Exact top-k inner products by columnar branch-and-bound over blocks of dimensions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, vectors

#: Dimensions that are added up between two looks at the bounds.
DIMENSIONS = 16
#: Rows of a block of candidates and of queries.
CANDIDATES, QUERIES = 1 << 13, 1 << 10
#: Rows of most mass that every query meets first, for a score that its k best can't be below.
SEEDS = 1 << 11
#: Doubles hold all whole numbers up to here.
SAFE = 2**53
LEAST, MOST = -(2**63), 2**63 - 1


def reached(q: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """A score for each query that k of the given candidates reach; minus infinity if there are fewer."""
    scores = q @ x.T
    scores[query_ids[:, None] == ids] = -np.inf
    return np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) >= k else np.full(len(q), -np.inf)


def top_of_wide_block(q: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[list, list]:
    """As top_of_block, for components whose products doubles can't hold: approximate scores with an error
    bound first, then whole numbers for the candidates that may be among the best."""
    power = np.frexp(np.abs(x).max(axis=1))[1]
    scaled = np.ldexp(x, -power[:, None])
    highest = int(power.max())
    slack = (len(x[0]) + 4) * 2.0**-51 * np.sqrt((scaled * scaled).sum(axis=1))
    best_ids, best_scores = [], []
    for i in range(len(q)):
        own = int(np.frexp(np.abs(q[i]).max())[1])
        asked = np.ldexp(q[i], -own)
        around = np.ldexp(scaled @ asked, power - highest)
        error = np.ldexp(slack * np.sqrt((asked * asked).sum()), power - highest) + 1e-300
        others = np.flatnonzero(ids != query_ids[i])
        lower = (around - error)[others]
        cut = np.partition(lower, len(lower) - k)[len(lower) - k] if len(lower) >= k else -np.inf
        limit = np.ldexp(1.0, 63 - own - highest)  # scores beyond a long are all equal
        cut = -np.inf if cut < -limit / 2 else min(cut, limit / 2)
        live = others[(around + error)[others] >= cut]
        whole = [int(c) for c in q[i].tolist()]
        score = [min(MOST, max(LEAST, sum(a * int(b) for a, b in zip(whole, x[j].tolist(), strict=True)))) for j in live]
        top = sorted(range(len(live)), key=lambda j: (-score[j], ids[live[j]]))[:k]
        best_ids.append(ids[live[top]])
        best_scores.append([score[j] for j in top])
    return best_ids, best_scores


def top_of_block(q: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, known: np.ndarray | None = None) -> tuple[list, list]:
    """The k best candidates of a block for each query, ties to smaller ids.

    Candidates lie in vertical layout, one stretch for each dimension, those of most mass first. After each
    block of dimensions a candidate can gain no more than the product of what is left of both norms; those
    that can't reach the k-th best known score, here or elsewhere (`known`), are dropped and the rest compacted.
    """
    order = np.argsort(-(x * x).sum(axis=0), kind="stable")
    columns, q = np.ascontiguousarray(x[:, order].T), q[:, order]
    blocks = [slice(s, s + DIMENSIONS) for s in range(0, len(columns), DIMENSIONS)]
    left_x = [np.sqrt((columns[b.stop :] ** 2).sum(axis=0)) * (1 + 1e-9) for b in blocks]
    left_q = [np.sqrt((q[:, b.stop :] ** 2).sum(axis=1)) for b in blocks]
    first = q[:, blocks[0]] @ columns[blocks[0]]
    best_ids, best_scores = [], []
    for i in range(len(q)):
        others = ids != query_ids[i]
        bound = first[i] + left_q[0][i] * left_x[0]
        # the candidates of the highest bounds give a first score to beat
        seed = np.flatnonzero(others)
        if len(seed) > 2 * k:
            seed = seed[np.argpartition(-bound[seed], 2 * k)[: 2 * k]]
        seen = columns[:, seed].T @ q[i]
        least = np.partition(seen, len(seen) - k)[len(seen) - k] if len(seen) >= k else -np.inf
        least = least if known is None else max(least, known[i])
        live = np.flatnonzero(others & (bound >= least))
        score = first[i][live]
        for b, lx, lq in zip(blocks[1:], left_x[1:], left_q[1:], strict=True):
            score = score + q[i, b] @ columns[b, live]
            keep = score + lq[i] * lx[live] >= least
            live, score = live[keep], score[keep]
        score = np.rint(score).astype(np.int64)
        top = np.lexsort((ids[live], -score))[:k]
        best_ids.append(ids[live[top]])
        best_scores.append(score[top])
    return best_ids, best_scores


def top_k(table: DataFrame, k: int = 20, step: int = vectors.QUERY_STEP, scale: int = 64) -> DataFrame:
    """table[vec_id, embedding] -> query_id, rank, vec_id, score: the k highest inner products of floor(scale * x).

    Queries are the rows whose vec_id is divisible by `step`, candidates all others. Blocks of queries meet
    blocks of candidates, each pair in a task of its own; a query brings along the k-th best score that it has with
    the SEEDS rows of most mass. Scores are exact at any size; beyond a long they count as its least or largest value.

    Null vectors and those with null or non-finite components (scaled, too) take no part, nor those of another
    length than the most frequent (ties to the longer); zero vectors do. Of rows that repeat an id the least vector
    counts. Ties go to the smaller id. An empty table gives none; other columns are ignored.
    """
    spark = table.sparkSession
    rows, dim = vectors.usable(table)
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    scaled = F.transform("vector", lambda x: F.when(F.abs(x * scale) < SAFE, F.floor(x * scale).cast("double")).otherwise(x * scale))
    rows = rows.select("vec_id", scaled.alias("vector")).filter(F.forall("vector", lambda x: F.abs(x) < float("inf")))
    whole = common.stored(rows, "vectors")
    most = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    n, n_queries = whole.agg(F.count("*"), F.count_if(F.col("vec_id") % step == 0)).first()
    seeds = whole.orderBy(most.desc(), "vec_id").limit(SEEDS).toArrow()
    shared = spark.sparkContext.broadcast((vectors.numbers(seeds.column("vec_id")), vectors.matrix(seeds.column("vector"), dim)))

    def started(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with the score that their k best reach."""
        ids, x = shared.value
        for whole in batches:
            for low in range(0, whole.num_rows, QUERIES):
                batch = whole.slice(low, QUERIES)
                q = vectors.matrix(batch.column("vector"), dim)
                wide = max((x * x).sum(axis=1).max(), (q * q).sum(axis=1).max()) >= SAFE
                known = np.full(len(q), -np.inf) if wide else reached(q, vectors.numbers(batch.column("vec_id")), x, ids, k)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(known)], names=["vec_id", "vector", "known"])

    queries = whole.filter(F.col("vec_id") % step == 0).mapInArrow(started, "vec_id long, vector array<double>, known double")
    across, down = max(1, -(-n // CANDIDATES)), max(1, -(-n_queries // QUERIES))
    dealt = lambda count: F.pmod(F.xxhash64("vec_id", "vector"), F.lit(count))
    candidates = whole.withColumn("a", dealt(across)).withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(down - 1).cast("long"))))
    asked = queries.withColumn("b", dealt(down)).withColumn("a", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(across - 1).cast("long"))))

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = not left.num_rows or not right.num_rows
        query_ids = vectors.numbers(right.column("vec_id"))
        if empty:
            found = [[] for _ in query_ids], [[] for _ in query_ids]
        else:
            q, x, ids = vectors.matrix(right.column("vector"), dim), vectors.matrix(left.column("vector"), dim), vectors.numbers(left.column("vec_id"))
            with np.errstate(over="ignore"):
                wide = max((q * q).sum(axis=1).max(), (x * x).sum(axis=1).max()) >= SAFE
            known = right.column("known").to_numpy()
            found = top_of_wide_block(q, query_ids, x, ids, k) if wide else top_of_block(q, query_ids, x, ids, k, known)
        return pa.table({"query_id": pa.array(query_ids, pa.int64()), "ids": pa.array(found[0], pa.list_(pa.int64())), "scores": pa.array(found[1], pa.list_(pa.int64()))})

    found = candidates.groupBy("a", "b").cogroup(asked.groupBy("a", "b")).applyInArrow(searched, "query_id long, ids array<long>, scores array<long>")
    return vectors.merged_top(found, k, "long")


def query(spark, sf_dir):
    return top_k(common.table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0
), r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
"""
