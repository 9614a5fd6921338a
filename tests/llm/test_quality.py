import random
import re

import pytest

from tandemsift.llm import quality


def frames(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, keep string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = quality.classify(docs, labels.filter("doc_id % 3 != 0")).join(labels.filter("doc_id % 3 = 0"), "doc_id")
    rows = [(r.quality, r.keep) for r in got.select("quality", "keep").collect()]
    assert len(rows) > 500
    good = [k for q, k in rows if q]
    assert sum(good) / len(good) > 0.995
    assert sum(bool(q) == k for q, k in rows) / len(rows) > 0.97


def test_sparse_sites_shrink_toward_the_whole(spark):
    rng = random.Random(1)
    rows = [(f"h{i % 3}", "a", 0.9 if i % 3 else 0.1) for i in range(3000)] + [("sparse", "b", 0.0)]
    scored = spark.createDataFrame([(h, p, min(1.0, max(0.0, x + rng.uniform(-0.05, 0.05)))) for h, p, x in rows], "source string, lang string, p double")
    sites, mean = quality.site_posteriors(scored, "source", "lang")
    site = {r["_host"]: r["site_mean"] for r in sites.collect()}
    assert mean == pytest.approx(0.633, abs=0.02)
    assert site["h0"] == pytest.approx(0.1, abs=0.02) and site["h1"] == pytest.approx(0.9, abs=0.02)
    assert 0.2 < site["sparse"] < mean


def test_nulls_empty_and_repeats(spark):
    docs = [(1, None, None, None, "x"), (2, "", "s", None, "x"), (3, "good words here", "s", "en", "x"), (3, "good words here", "s", "en", "x"), (None, "W!! X!!", None, "en", "x"), (4, "w " * 60000, "s", "en", "x")]
    d, labels = frames(spark, docs, [(3, 1, 0), (9, 0, 0), (2, None, 0), (None, 1, 0)])
    got = quality.classify(d, labels).collect()
    assert len(got) == 6 and all(0 < r.quality_score < 1 and isinstance(r.keep, bool) for r in got)
    d, labels = frames(spark, [], [])
    assert quality.classify(d, labels).collect() == []


def kind(text):
    words = text.split()
    run = most = 0
    for a, b in zip(["", *words], words, strict=False):
        run = run + 1 if a == b else 1
        most = max(most, run)
    marks = {"bars": r"\|", "shouts": "!!", "symbols": r"[*&$%#]{3,}"}
    return "words" if most >= 6 else next((k for k, p in marks.items() if re.search(p, text)), "other")


def test_held_out_recall_of_each_kind_of_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = labels.filter("doc_id % 3 = 0 AND quality = 0").select("doc_id")
    got = quality.classify(docs, labels.filter("doc_id % 3 != 0")).join(held, "doc_id").select("text", "doc_score", "keep").collect()
    for k in ("words", "bars", "shouts", "symbols"):
        own = [r for r in got if kind(r.text or "") == k]
        assert len(own) > 30
        assert sum(not r.keep for r in own) / len(own) > 0.95, k
        assert sum(r.doc_score < 0.5 for r in own) / len(own) > 0.95, k


def test_repetition_features(spark):
    texts = ["a a\tb b\nB ab b", "x y\n\nx y\n  \nz", "ab abc ab", None, "", "a" * 100000 + " " + "a" * 100001, "w " * 60000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r["_repeats"], r["_distinct"], r["_top"], r["_lines"]) for r in quality.featured(docs).collect()}
    assert got[0] == pytest.approx((2 / 7, 4 / 7, 3 / 7, 0))
    assert got[1] == pytest.approx((0, 3 / 5, 2 / 5, 1 / 3))
    assert got[2] == pytest.approx((0, 2 / 3, 2 / 3, 0))
    assert got[3] == got[4] == (0, 0, 0, 0)
    assert got[5] == pytest.approx((0, 1, 0.5, 0))
    assert got[6] == pytest.approx((59999 / 60000, 1 / 60000, 1, 0))


def test_site_means_and_scores_are_those_of_dictionaries(spark):
    """The hierarchical part by brute force, from the documents' own scores."""
    import math
    from collections import defaultdict

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source", "lang")
    extra = spark.createDataFrame([(70001, "good words", None, None), (70002, None, "alone", "en"), (70003, "a b", "src1", None)], docs.schema)
    got = quality.classify(docs.unionByName(extra), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")).collect()
    sites, hosts = defaultdict(list), defaultdict(list)
    for r in got:
        sites[r.source, r.lang].append(r.doc_score)
        hosts[r.source].append(r.doc_score)
    n, total = len(got), sum(r.doc_score for r in got)
    centre = lambda x: sum(x) / len(x)
    within = max(quality.CLIP, sum((p - centre(v)) ** 2 for v in sites.values() for p in v) / (n - len(sites)))
    spread = lambda groups: max(0.0, (sum(len(v) * (centre(v) - c) ** 2 for v, c in groups) - within * len(groups)) / n)
    strength = lambda x: min(max(within / x, 1.0), 1e4) if x > 0 else 1e4
    host_k = strength(spread([(v, total / n) for v in hosts.values()]))
    path_k = strength(spread([(v, centre(hosts[k[0]])) for k, v in sites.items()]))
    odds = lambda p: math.log(min(max(p, 1e-4), 1 - 1e-4) / (1 - min(max(p, 1e-4), 1 - 1e-4)))
    for r in got:
        p, h, s = r.doc_score, hosts[r.source], sites[r.source, r.lang]
        whole = (total - p) / (n - 1)
        host = (sum(h) - p + host_k * whole) / (len(h) - 1 + host_k)
        site = (sum(s) - p + path_k * host) / (len(s) - 1 + path_k)
        score = 1 / (1 + math.exp(-(odds(p) + odds(site) - odds(whole))))
        assert r.host_mean == pytest.approx(host) and r.site_mean == pytest.approx(site)
        assert r.quality_score == pytest.approx(min(max(score, 1e-4), 1 - 1e-4)) and r.keep == (r.quality_score >= 0.5)


def test_word_ratios_and_clashing_names(spark):
    rows = [(i, "fine words" if i % 2 else "spam words", i % 2) for i in range(40)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    ratios = quality.word_ratios(labelled)
    at = {w: spark.range(1).select(quality.bucket(quality.F.lit(w))).first()[0] for w in ("fine", "spam", "words")}
    assert ratios[at["fine"]] > 2 and ratios[at["spam"]] < -2 and ratios[at["words"]] == pytest.approx(0)
    assert sum(x != 0 for x in ratios) == 2
    docs = labelled.selectExpr("doc_id", "text", "'s' AS source", "'en' AS lang", "7 AS p", "'x' AS site_mean")
    got = quality.classify(docs, labelled.select("doc_id", "quality")).collect()
    assert len(got) == 40 and all(r.p == 7 and r.keep == (r.text == "fine words") for r in got)
