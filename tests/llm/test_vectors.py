import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tandemsift.llm import branch_bound, rp_forest

SCHEMA = "vec_id long, embedding array<float>, score int"


def odd_rows():
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), 0) for i in range(300)]
    rows += [(1000 + i, rows[7][1], 0) for i in range(60)]  # equal vectors, more than are reported
    rows += [(2000, None, 0), (2020, [0.0] * 8, 0), (2040, [None] + [1.0] * 7, 0), (2060, [float("nan")] * 8, 0), (2080, [float("inf")] + [0.0] * 7, 0), (2100, [1.0], 0), (2120, [], 0), (None, [1.0] * 8, 0)]
    return rows + [(2140, [3.0] * 8, 0), (20, rows[20][1], 0), (41, rows[41][1], 0)]


def brute(rows, values, zero, k=20):
    kept = {}
    for i, v, _ in rows:
        if i is not None and v and len(v) == 8 and None not in v and np.isfinite(v).all() and (zero or any(v)):
            kept.setdefault(i, values(np.array(v, float)))
    out = {}
    for q in kept:
        if q % 20 == 0:
            found = sorted((-sum(float(a) * float(b) for a, b in zip(kept[q], v, strict=True)), i) for i, v in kept.items() if i != q)
            out[q] = [(i, -s) for s, i in found[:k]]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_branch_and_bound_is_exact(spark):
    rows = odd_rows()
    got, want = lists(branch_bound.top_k(spark.createDataFrame(rows, SCHEMA))), brute(rows, lambda v: np.floor(64 * v), True)
    assert got == want
    assert branch_bound.top_k(spark.createDataFrame([], SCHEMA)).collect() == []


def clamped(a, b):
    return min(2**63 - 1, max(-(2**63), sum(int(x) * int(y) for x, y in zip(a, b, strict=True))))


def test_branch_and_bound_is_exact_on_large_components(spark):
    draw = random.Random(8)
    sizes = [1, 2.0**20, 2.0**27, 2.0**28, 2.0**31, 1e30, 1e300]
    rows = [(i, [draw.choice(sizes) * draw.uniform(-1, 1) for _ in range(6)], 0) for i in range(120)]
    rows += [(200 + i, [2.0**27 + i % 3, 2.0**26 + 1, 0.5, 0.25, 0.0, i / 64], 0) for i in range(60)]  # apart in the last bits only
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v, _ in rows}
    for some in (rows, rows[120:]):
        got = lists(branch_bound.top_k(table.filter(f"vec_id >= {some[0][0]}")))
        ids = [i for i, _, _ in some]
        want = {q: [(i, -s) for s, i in sorted((-clamped(whole[q], whole[i]), i) for i in ids if i != q)[:20]] for q in ids if q % 20 == 0}
        assert got == want
    few = lists(branch_bound.top_k(spark.createDataFrame([(0, [1e30], 0), (1, [1e30], 0)], SCHEMA)))
    assert few == {0: [(1, 2**63 - 1)]}


@pytest.mark.parametrize("search", [branch_bound.top_k, rp_forest.neighbours])
def test_a_vector_of_another_length_is_left_out_alone(spark, search):
    rows = [(i, [float(i), 1.0, 2.0], 0) for i in range(60)]
    want = lists(search(spark.createDataFrame(rows, SCHEMA)))
    assert set(want) == {0, 20, 40} and lists(search(spark.createDataFrame([*rows, (80, [9.0] * 4, 0)], SCHEMA))) == want


def test_blocks_prune_and_agree():
    rng = np.random.default_rng(3)
    x = np.floor(64 * rng.normal(size=(4000, 64)) * np.linspace(2, 0.05, 64))
    ids = rng.permutation(4000).astype(np.int64)
    got_ids, got = branch_bound.top_of_block(x[:50], ids[:50], x, ids, 20)
    for i in range(50):
        s = (x @ x[i]).astype(np.int64)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:20]
        assert got_ids[i].tolist() == ids[order].tolist() and got[i].tolist() == s[order].tolist()


def test_forest_with_all_leaves_is_exact(spark):
    rows = odd_rows()
    got, want = lists(rp_forest.neighbours(spark.createDataFrame(rows, SCHEMA), leaf=8, recall=1.0)), brute(rows, lambda v: v, False)
    assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in r] for q, r in want.items()}
    assert all(s == pytest.approx(t) for q in got for (_, s), (_, t) in zip(got[q], want[q], strict=True))
    assert rp_forest.neighbours(spark.createDataFrame([], SCHEMA)).collect() == []


def recall(table, e, **options):
    x, ids = np.stack(e.embedding.values).astype(float), e.vec_id.values
    got = lists(rp_forest.neighbours(table, **options))
    hits = total = 0
    for q, found in got.items():
        s = x @ x[np.searchsorted(ids, q)]
        s[ids == q] = -np.inf
        hits += len({i for i, _ in found} & set(ids[np.argsort(-s)[:20]].tolist()))
        total += 20
    assert len(got) == (ids % options.get("step", 20) == 0).sum()
    return hits / total


def test_forest_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    assert recall(table, table.toPandas().sort_values("vec_id")) >= 0.9


@pytest.mark.parametrize("centres", [0, 400])
def test_forest_recall_beyond_the_sample(spark, tmp_path, centres):
    """30,000 vectors, uniform or in clusters: recall holds with a small share of all leaf places visited."""
    rng = np.random.default_rng(5)
    n, d = 30_000, 32
    x = rng.normal(size=(n, d))
    if centres:
        x = rng.normal(size=(centres, d))[rng.integers(0, centres, n)] + 0.2 * x
    x /= np.linalg.norm(x, axis=1)[:, None]
    pa_table = pa.table({"vec_id": np.arange(n), "embedding": list(x.astype(np.float32))})
    pq.write_table(pa_table, tmp_path / "v.parquet")
    e = pa_table.to_pandas()
    assert recall(spark.read.parquet(str(tmp_path / "v.parquet")), e, step=100) >= 0.9
    some = rp_forest.lifted(x[: rp_forest.SAMPLE], 1.0)
    forest = rp_forest.build(some, rp_forest.TREES, rp_forest.LEAF * len(some) // n)
    share = rp_forest.share_needed(forest, some, 1.0, 11, rp_forest.RECALL)
    assert share / rp_forest.TREES < (0.01 if centres else 0.1)
    assert share < (0.2 if centres else 1.0)


def test_rerank_with_many_ties_keeps_the_smallest_ids(monkeypatch):
    monkeypatch.setattr(rp_forest, "PAIRS", 50)
    x, ids = np.eye(8)[np.arange(400) % 8], np.arange(400)[::-1] * 3
    leaves, visits = np.stack([np.arange(400) % 5, 5 + np.arange(400) % 3], axis=1), (np.repeat(np.arange(8), 2), np.tile([0, 1], 8))
    got, scores = rp_forest.rerank(ids, x, leaves, np.array([6, 1]), x[:2] * 2, visits, 20)
    for i, own in enumerate([6, 1]):
        want = sorted((-float(x[j] @ x[i] * 2), int(ids[j])) for j in range(400) if ids[j] != own)[:20]
        assert got[i].tolist() == [j for _, j in want] and scores[i].tolist() == [-s for s, _ in want]


def test_leaf_bounds_give_the_order_of_the_search():
    rng = np.random.default_rng(12)
    x = rp_forest.lifted(rng.normal(size=(900, 6)), 9.0)
    forest = rp_forest.build(x, 4, 20)
    sizes = np.bincount(rp_forest.leaves_of(forest, x).ravel(), minlength=forest.leaves).tolist()
    margins = rp_forest.asking(rng.normal(size=(15, 6)), 9.0) @ forest.normals.T + forest.offsets
    for bounds, own in zip(rp_forest.leaf_bounds(forest, margins), margins, strict=True):
        found = rp_forest.search(forest, own.tolist(), sizes, np.inf)
        assert sorted(found) == list(range(forest.leaves)) and (np.diff(bounds[found]) >= 0).all()
