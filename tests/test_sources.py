import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from tandemsift.sources import package, readers
from tandemsift.streaming import incremental

SCHEMA = StructType().add("id", LongType()).add("name", StringType()).add("x", DoubleType())


def test_tsv_contract(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text("id\tname\tx\n1\ta\t0.5\n2\t.\tNA\n")
    assert [tuple(r) for r in readers.read_tsv_contract(spark, str(path), SCHEMA).orderBy("id").collect()] == [(1, "a", 0.5), (2, None, None)]
    path.write_text("id\tname\tx\n1\ta\tabc\n")
    with pytest.raises(Exception, match="x is no double: abc"):
        readers.read_tsv_contract(spark, str(path), SCHEMA).collect()
    path.write_text("id\tx\tname\n")
    with pytest.raises(ValueError):
        readers.read_tsv_contract(spark, str(path), SCHEMA)


def test_bed_targets(spark, tmp_path):
    path = tmp_path / "t.bed"
    rest = "\tC\tlocus\tmode\tL"
    path.write_text("".join(f"chr1\t{a}\t{b}\t{i}{rest}\n" for a, b, i in ((1, 5, "A"), ("x", 5, "B"), (5, 900, "D"), (1, 2, "E"), (3, 4, "E"))))
    contigs = spark.createDataFrame([("chr1", 100)], "chrom string, length long")
    good, bad = readers.read_bed_targets(spark, str(path), contigs)
    assert [r.target_region_id for r in good.collect()] == ["A"]
    assert sorted(r.reason for r in bad.collect()) == ["NOT_NUMERIC", "OUT_OF_BOUNDS", "REPEATED_ID", "REPEATED_ID"]


def test_package(spark, tmp_path):
    tables = {"a": spark.range(10), "b": spark.range(3).withColumn("v", F.lit(None).cast("string"))}
    path = str(tmp_path / "package")
    manifest = {r.table: r.rows for r in package.write_result_package(tables, path).collect()}
    assert manifest == {"a": 10, "b": 3}
    assert package.manifest_integrity(spark, path).count() == 0
    spark.range(9).write.mode("overwrite").parquet(f"{path}/a")
    assert [r.table for r in package.manifest_integrity(spark, path).collect()] == ["a"]
    with pytest.raises(FileExistsError):
        package.write_result_package(tables, path)


def test_incremental(spark, tmp_path):
    source, output, checkpoint = (str(tmp_path / d) for d in ("in", "out", "check"))
    run = lambda: incremental.incremental_evidence(spark, source, SCHEMA, output, checkpoint, "id", lambda df: df.withColumn("done", F.lit(True))).awaitTermination()
    spark.createDataFrame([(1, "a", 0.0), (2, "b", 1.0)], SCHEMA).write.parquet(source)
    run()
    run()
    assert spark.read.parquet(output).count() == 2
    spark.createDataFrame([(2, "b", 1.0), (3, "c", 1.0)], SCHEMA).write.mode("append").parquet(source)
    run()
    assert sorted(r.id for r in spark.read.parquet(output).collect()) == [1, 2, 3]


def test_repeated_tags_and_attributes_keep_the_first(spark):
    sam = spark.createDataFrame([("r\t16\tchr1\t5\t9\t3M\t*\t0\t0\tACG\t*\tNM:i:1\tXA:Z:a:b\tNM:i:2",)], "value string")
    assert readers.sam_alignments(sam).first().tags == {"NM": "1", "XA": "a:b"}
    paf = spark.createDataFrame([("q\t9\t0\t9\t+\tt\t9\t0\t9\t8\t9\t60\tAS:i:7\tAS:i:8",)], "value string")
    assert readers.paf_alignments(paf)[0].first().score == 7
    gtf = spark.createDataFrame([('chr1\tsrc\texon\t3\t9\t.\t+\t.\tgene_id "g"; tag "basic"; tag "CCDS"; exon_number 2; tag "basic";',)], "value string")
    row = readers.gtf_features(gtf).first()
    assert row.attributes == {"gene_id": "g", "tag": "basic", "exon_number": "2"} and row.repeated == {"tag": ["basic", "CCDS", "basic"]}


def test_a_table_that_came_out_otherwise_is_not_published(spark, tmp_path):
    import os

    changing = spark.range(100).withColumn("x", F.current_timestamp())  # each reading gives other values
    with pytest.raises(OSError):
        package.write_result_package({"a": changing, "b": spark.range(3)}, str(tmp_path / "p"))
    assert not os.path.exists(tmp_path / "p")


def test_rows_repeated_within_a_run_count_once(spark, tmp_path):
    source, output, checkpoint = (str(tmp_path / d) for d in ("in", "out", "check"))
    spark.createDataFrame([(1, "b", 0.0), (1, "a", 2.0), (2, None, None), (2, None, None)], SCHEMA).write.parquet(source)
    incremental.incremental_evidence(spark, source, SCHEMA, output, checkpoint, "id", lambda df: df).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(output).collect())) == [(1, "a", 2.0), (2, None, None)]


def test_gtf_counters_are_those_of_the_pass_that_reads(spark):
    good = 'chr1\tsrc\texon\t3\t9\t.\t+\t.\tgene_id "g";'
    lines = [good, good, "#" + good, "# only", "", "chr1\tsrc", good + "\tmore", good.replace("\t3\t", "\tx\t"), good.replace("\t3\t", "\t0\t"), good.replace("\t9\t", "\t2\t"), None]
    rows, seen = readers.gtf_features_counted(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert rows.count() == 2
    assert seen.get == {"lines": 11, "comments": 2, "malformed": 3, "invalid": 3, "features": 2}


def test_damaged_files_are_named(spark, tmp_path):
    path = str(tmp_path / "package")
    package.write_result_package({"a": spark.range(40).repartition(4), "b": spark.range(9).coalesce(1)}, path)
    assert package.file_integrity(spark, path).count() == 0
    files = sorted(f for f in (tmp_path / "package" / "a").glob("*.parquet"))
    for crc in (tmp_path / "package").rglob(".*.crc"):
        crc.unlink()
    whole = files[0].read_bytes()
    files[0].write_bytes(whole[: len(whole) // 2])
    files[1].write_bytes(b"X" + files[1].read_bytes()[1:])
    files[2].unlink()
    (tmp_path / "package" / "b" / "more.parquet").write_bytes(b"PAR1")
    want = {(files[0].name, "SIZE"), (files[1].name, "CONTENT"), (files[2].name, "MISSING"), ("more.parquet", "ADDED")}
    assert {(r.file, r.reason) for r in package.file_integrity(spark, path).collect()} == want
    assert {(r.file, r.reason) for r in package.file_integrity(spark, path, contents=False).collect()} == {w for w in want if w[1] != "CONTENT"}
    with pytest.raises(ValueError):
        package.write_result_package({"files": spark.range(1)}, str(tmp_path / "other"))


def test_differing_rows_are_found_by_digests(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (1, "x"), (2, None), (None, None), (3, "")], "`a.b` long, n string")
    b = spark.createDataFrame([("x", 1), (None, 2), (None, None), (None, None), (None, 3)], "n string, `a.b` long")
    got = sorted(map(repr, map(tuple, package.differing_rows(a, b).collect())))
    assert got == sorted(map(repr, [("ONLY_A", 1, "x"), ("ONLY_A", 1, "x"), ("ONLY_A", 3, ""), ("ONLY_B", None, None), ("ONLY_B", 3, None)]))
    same = package.differing_rows(a, a.repartition(3))
    assert same.count() == 0 and "Exchange" not in same._jdf.queryExecution().executedPlan().toString()
    assert package.differing_rows(a.limit(0), a.limit(0)).count() == 0
    big = spark.range(50000).withColumn("x", F.col("id") % 7)
    assert [tuple(r) for r in package.differing_rows(big, big.filter("id <> 777")).collect()] == [("ONLY_A", 777, 0)]


def test_runs_read_only_the_buckets_they_touch(spark, tmp_path):
    source, output, checkpoint = (str(tmp_path / d) for d in ("in", "out", "check"))
    run = lambda: incremental.incremental_evidence(spark, source, SCHEMA, output, checkpoint, "id", lambda df: df, buckets=32).awaitTermination()
    rows = lambda a, b: spark.range(a, b).select("id", F.lit("a").alias("name"), F.lit(0.0).alias("x"))
    rows(0, 500).write.parquet(source)
    run()
    run()
    rows(498, 501).unionByName(spark.createDataFrame([(None, "n", 1.0)], SCHEMA)).write.mode("append").parquet(source)
    run()
    assert sorted((r.id for r in spark.read.parquet(output).collect()), key=lambda x: -1 if x is None else x) == [None, *range(501)]
    done = incremental.done_in_touched_buckets(rows(498, 500), output, "id", 32)
    assert done.select("_bucket").distinct().count() <= 2
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan or "PartitionFilters: [isnotnull(_bucket" in plan
