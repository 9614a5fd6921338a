import json

from pyspark.sql import functions as F

from tandemsift.operators import dossier


def test_a_locus_of_many_calls_is_many_pages(spark):
    calls = spark.range(200000).select(F.when(F.col("id") < 150000, "A").otherwise("B").alias("locus"), F.col("id").alias("read_id"), (F.col("id") % 3).cast("int").alias("attempt"))
    docs = dossier.candidate_dossier(calls, ["locus"], ["read_id", "attempt"], page=500).collect()
    assert sorted((r.locus, r.page) for r in docs) == [("A", i) for i in range(300)] + [("B", i) for i in range(100)]
    for r in docs:
        d, first = json.loads(r.dossier), (0 if r.locus == "A" else 150000) + 500 * r.page
        assert d["calls"] == 500 and d["page"] == r.page
        assert d["sources"] == [{"read_id": i, "attempt": i % 3} for i in range(first, first + 500)]


def test_nulls_ties_and_empty_tables(spark):
    rows = spark.createDataFrame([("A", None, 1), ("A", 5, 1), ("A", 5, 1), ("A", -3, None), (None, 7, 2)], "locus string, read_id long, attempt int")
    docs = {(r.locus, r.page): [(s.get("read_id"), s.get("attempt")) for s in json.loads(r.dossier)["sources"]] for r in dossier.candidate_dossier(rows, ["locus"], ["read_id", "attempt"], page=3).collect()}
    assert docs[("A", 0)] == [(None, 1), (-3, None), (5, 1)] and docs[("A", 1)] == [(5, 1)] and docs[(None, 0)] == [(7, 2)]
    assert dossier.candidate_dossier(rows.limit(0), ["locus"], ["read_id", "attempt"]).count() == 0
