from collections import defaultdict

import pytest

from tandemsift.llm import mixing


def fill(sizes, weights=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    rest, free, target = 1.5 * sum(sizes.values()), set(names), {}
    while True:
        level = rest / sum(w[s] for s in free) if free else 0
        over = {s for s in free if level * w[s] > 2 * sizes[s]}
        if not over:
            return target | {s: level * w[s] for s in free}
        for s in over:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
        free -= over


def run(spark, rows):
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, source string, text string, target int")
    return mixing.mix(mixing.sized(docs))


def test_targets_copies_and_reruns(spark):
    rows = [(i, ("hot" if i % 3 else f"s{i % 5}"), "w " * (i % 40)) for i in range(900)]
    rows += [(1000, None, "a b c"), (1001, None, None), (1002, "", " \t"), (1003, "", "x" * 100000), (1004, "é", "one word"), (5, "hot", "w w"), (5, "hot", "w w")]
    got = sorted(tuple(r) for r in run(spark, rows).select("doc_id", "size", "source_size", "target", "taken").collect())
    again = sorted(tuple(r) for r in run(spark, rows[::-1]).repartition(3).select("doc_id", "size", "source_size", "target", "taken").collect())
    assert got == again and len(got) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in run(spark, rows).collect():
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken <= 2 * r.size
    want = fill(sizes)
    for r in run(spark, rows).select("source", "source_size", "target").distinct().collect():
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert abs(taken[r.source] - r.target) <= 40


def test_emitted_and_empty(spark):
    rows = [(i, "ab"[i % 2], "w w") for i in range(100)]
    mixed = run(spark, rows)
    assert mixing.emitted(mixed).count() == sum(r.copies for r in mixed.collect())
    assert run(spark, []).collect() == []
