from collections import Counter

import corpus_pipeline
from tests.llm.test_mixing import fill
from tests.llm.test_ngram_join import brute as components
from tests.llm.test_pii import brute as base_spans

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def small(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = [(9001, None, None, None, None), (9002, "", "en", "src0", 0), (9003, "a b c", None, "src1", 5)]
    return docs.unionByName(spark.createDataFrame(odd, DOCS))


def test_stages_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = small(spark)
    stages = dict(corpus_pipeline.STAGES)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = rows_of(stages["quality classifier"](spark, docs, sf_dir))
    ids = {r[0] for r in got}
    assert set(got) <= set(rows_of(docs))
    assert all(i in ids for i, q in labels.items() if q)

    rows = [(r[0], r[1]) for r in rows_of(docs)]
    kept = {i for i, n, c in components(rows, 5, 80) if not n or i == c}
    got = rows_of(stages["n-gram Jaccard join"](spark, docs, sf_dir))
    assert sorted(r[0] for r in got) == sorted(kept)

    got = {r[0]: r for r in rows_of(stages["personal data"](spark, docs, sf_dir))}
    for i, text in rows:
        if not base_spans(text) and "=" not in (text or "") and "AKIA" not in (text or ""):
            assert got[i][1] == text
        for start, _, _, end in base_spans(text):
            assert text[start:end] not in got[i][1]

    got = rows_of(stages["mixing sources"](spark, docs, sf_dir))
    copies = Counter(r[0] for r in got)
    assert max(copies.values()) <= 2
    words = lambda t: len((t or "").split())
    sizes, taken, most = Counter(), Counter(), Counter()
    for r in rows_of(docs):
        sizes[r[3]] += words(r[1])
        taken[r[3]] += copies[r[0]] * words(r[1])
        most[r[3]] = max(most[r[3]], words(r[1]))
    for source, target in fill(sizes).items():
        assert abs(taken[source] - target) <= 2 * most[source]

    got = stages["SentencePiece tokens"](spark, docs, sf_dir).collect()
    assert len(got) == docs.count() and all(r.parity and r.round_trip for r in got)


def test_run_on_nothing(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_survivors_are_rows_not_ids(spark):
    text, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(1, text, "en", "a", 1), (1, other, "en", "a", 2), (2, text + " more", "en", "a", 3), (2, "something else of the same id here", "de", "b", 4), (3, other, "en", "a", 5), (3, other, "en", "a", 5)]
    rows += [(None, "no id but copies of one another, twice", None, None, None)] * 2 + [(None, "No id but copies of one another, twice", "x", None, None), (None, text, "en", None, 6), (4, None, None, None, None), (4, None, None, None, None), (5, " ", "en", "a", 7)]
    rows += [(6, "equal in all columns, of which one stays", "en", "a", 8)] * 3
    docs = spark.createDataFrame([(*r, "clash", 9) for r in rows], DOCS + ", sig string, component int")
    got = sorted((tuple(r) for r in corpus_pipeline.STAGES[1][1](spark, docs, "").collect()), key=str)
    assert all(r[5:] == ("clash", 9) for r in got)
    kept = [r[:5] for r in got]
    assert kept.count(rows[0]) == 1 and kept.count(rows[1]) == 1 and kept.count(rows[3]) == 1
    assert rows[2] not in kept and rows[4] not in kept and rows[9] not in kept
    assert sum(r[0] is None for r in kept) == 1 and sum(r[0] == 4 for r in kept) == 2 and sum(r[0] == 5 for r in kept) == 1
    assert sum(r[0] == 6 for r in kept) == 1 and len(kept) == 8


def test_stages_with_repeats_nulls_and_further_columns(spark, tmp_path):
    docs = small(spark)
    docs = docs.unionByName(docs.limit(7)).selectExpr("*", "'x' AS taken", "1 AS p", "'y' AS token_ids", "doc_id AS component_id")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, "/root/testdata/sf0.001")
        kept = [c for c in docs.columns if c != "token_ids" or name != "SentencePiece tokens"]
        assert set(kept) <= set(got.columns) and got.count() > 0, name
        assert got.filter("taken <> 'x' OR p <> 1").count() == 0


def test_run_removes_what_stages_stored(spark, tmp_path):
    from tandemsift.llm import common

    mark = common.mark()
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").count()
    assert rows > 0 and len(common._made) - mark <= 2
    common.clean(spark, mark)
    assert common.mark() == mark
