import random
import re

import numpy as np
from pyspark.sql import functions as F

from tandemsift.llm import ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def brute(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            shared = len(x & sets[j])
            if x and 100 * shared >= percent * (len(x) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def run(spark, rows, n=4, percent=85):
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, sig int")
    got = ngram_join.join(docs, n, percent).select("doc_id", "n_shingles", "component_id").collect()
    return sorted((tuple(r) for r in got), key=str)


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = rng.choices(words, k=120)
    rows = []
    for i in range(150):  # a large group of near copies, some out of reach, some by a chain only
        own = list(base)
        for k in range(rng.randrange(0, 7)):
            own[rng.randrange(120)] = f"own{i}-{k}"
        rows.append((i, " ".join(own)))
    passage = " ".join(rng.choices(words, k=40))
    rows += [(200 + i, " ".join(rng.choices(words, k=60)) + " " + passage) for i in range(90)]
    rows += [(400 + i, rows[3][1].upper()) for i in range(5)] + [(500, None), (501, " \t\n"), (502, "a b"), (503, "A  b"), (504, "a b c d"), (505, "x" * 9000)]
    rows += [(None, rows[160][1]), (None, "quite alone here now"), (502, "a b"), (502, "another text of that id")]
    rng.shuffle(rows)
    return rows


def test_components_are_those_of_all_pairs(spark):
    rows = corpus()
    assert run(spark, rows) == brute(rows, 4, 85)


def test_other_parameters_and_empty(spark):
    rows = [r for r in corpus() if r[0] is None or r[0] < 60 or r[0] > 490]
    assert run(spark, rows, 5, 80) == brute(rows, 5, 80)
    assert run(spark, []) == []


def test_a_near_copy_without_id_bridges_two_documents(spark):
    base = [f"w{i}" for i in range(120)]
    first, last = list(base), list(base)
    first[10], first[30], last[80], last[100] = "p", "q", "r", "s"
    rows = [(7, " ".join(first)), (None, " ".join(base)), (9, " ".join(last)), (None, "alone without id or copy")]
    got = run(spark, rows)
    assert got == brute(rows, 4, 85)
    assert sorted((d or 0, c) for d, _, c in got if c) == [(0, 7), (7, 7), (9, 7)]


def boilerplate(texts, lines=24, each=6, words=14):
    """Texts of shared lines only: no token of theirs is rare, few of them link."""
    rng = random.Random(8)
    shared = [[f"l{k}w{i}" for i in range(words)] for k in range(lines)]
    rows = [(i, " ".join(w for k in rng.sample(range(lines), each) for w in shared[k])) for i in range(texts)]
    near = rows[5][1].split()
    near[-1] = "changed"
    return rows + [(texts, " ".join(near)), (texts + 1, rows[9][1] + " more")]


def test_texts_of_shared_lines_that_do_not_link(spark):
    rows = boilerplate(1500)
    assert run(spark, rows) == brute(rows, 4, 85)


def test_bitmaps_differ_by_no_more_than_the_sets():
    rng = np.random.default_rng(3)
    for size in (1, 40, 700, 5000):
        a = rng.integers(1 << 63, size=size, dtype=np.uint64)
        b = np.concatenate([a[: size * 9 // 10], rng.integers(1 << 63, size=size // 8, dtype=np.uint64)])
        x, y = (ngram_join.bitmaps(v, np.array([0, len(v)]))[1] for v in (a, b))
        differ = sum(int(w).bit_count() for w in (x ^ y).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b)) and (size < 40 or differ > 0)


def test_a_hot_token_is_dealt_to_cells_in_which_each_pair_meets_once(spark):
    n = 1500
    mixed = spark.range(n).selectExpr("7L AS token", "id AS sig", "100 + id % 30 AS n", "id AS component", "3L AS main", "0L AS pos")
    left, right, work = ngram_join.dealt_cells(mixed, 85, 64)
    keys = ["token", "_band", "_i", "_j"]
    for side in (left, right):
        assert side.groupBy(*keys).count().agg(F.max("count")).first()[0] < 2 * 64
    met = left.select(*keys, F.col("sig").alias("x"), F.col("n").alias("nx")).join(right.select(*keys, F.col("sig").alias("y"), F.col("n").alias("ny")), keys)
    close = met.filter("100 * least(nx, ny) >= 85 * greatest(nx, ny)").agg(F.count("*"), F.count_distinct("x", "y")).first()
    sizes = [100 + i % 30 for i in range(n)]
    per = {s: sizes.count(s) for s in set(sizes)}
    wanted = sum(per[s] * per[t] for s in per for t in per if 100 * min(s, t) >= 85 * max(s, t)) - sum(per[t] for t in per if 100 * min(103, t) >= 85 * max(103, t))
    assert close[0] == close[1] == wanted
    assert work >= wanted
