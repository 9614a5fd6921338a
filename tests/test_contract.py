import gzip

import pytest

from tandemsift.sources.contract import Field, read_contract

FIELDS = [Field("id", "integer", required=True), Field("strand", values=("+", "-", ".")), Field("x", "number", least=0, most=9), Field("ok", "boolean"), Field("at", "datetime")]
HEADER = "id\tstrand\tx\tok\tat\n"


def test_rejects_name_file_line_column_and_reason(spark, tmp_path):
    """Marks that an enum owns are values; others are missing; what doesn't parse is never null."""
    (tmp_path / "a.tsv").write_text(HEADER + "1\t.\t0.5\ttrue\t2024-01-02T03:04:05\n2\t+\tNA\t.\t\nx\t?\tabc\tyes\t2024-01-02\n.\t+\t10\tfalse\t.\n4\t+\n")
    with gzip.open(tmp_path / "b.tsv.gz", "wt") as f:
        f.write(HEADER + "5\t-\t-1\ttrue\t.\n99999999999999999999\t-\tnan\ttrue\t.\n6\t-\t1e0\tfalse\t.\n")
    rows, rejects = read_contract(spark, str(tmp_path), FIELDS)
    got = sorted((r.id, r.strand, r.x, r.ok, r["at"] is None) for r in rows.collect())
    assert got == [(1, ".", 0.5, True, False), (2, "+", None, None, True), (6, "-", 1.0, False, True)]
    found = sorted((r.file.rpartition("/")[2], r.line, r.column or "", r.reason, r.value) for r in rejects.collect())
    assert found == [
        ("a.tsv", 4, "at", "NOT_DATETIME", "2024-01-02"), ("a.tsv", 4, "id", "NOT_INTEGER", "x"), ("a.tsv", 4, "ok", "NOT_BOOLEAN", "yes"), ("a.tsv", 4, "strand", "NOT_IN_ENUM", "?"), ("a.tsv", 4, "x", "NOT_NUMBER", "abc"),
        ("a.tsv", 5, "id", "REQUIRED", "."), ("a.tsv", 5, "x", "ABOVE_MOST", "10"), ("a.tsv", 6, "", "WRONG_FIELD_COUNT", "4\t+"),
        ("b.tsv.gz", 2, "x", "BELOW_LEAST", "-1"), ("b.tsv.gz", 3, "id", "NOT_INTEGER", "99999999999999999999"),
    ]


def test_lines_are_counted_over_the_blocks_of_a_file(spark, tmp_path):
    lines = [f"{i}\t+\t1\ttrue\t." if i % 997 else f"bad{i}\t+\t1\ttrue\t." for i in range(2, 20_000)]
    (tmp_path / "big.tsv").write_text(HEADER + "\n".join(lines) + "\n")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        rows, rejects = read_contract(spark, str(tmp_path), FIELDS)
        assert rows.rdd.getNumPartitions() > 3
        assert sorted((r.line, r.value) for r in rejects.collect()) == [(i, f"bad{i}") for i in range(997, 20_000, 997)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_headers_of_all_files(spark, tmp_path):
    (tmp_path / "a.tsv").write_text(HEADER + "1\t+\t1\ttrue\t.\n")
    (tmp_path / "b.tsv").write_text("id\tx\tstrand\tok\tat\n")
    with pytest.raises(ValueError, match="b.tsv"):
        read_contract(spark, str(tmp_path), FIELDS)
    (tmp_path / "b.tsv").write_text("")
    assert read_contract(spark, str(tmp_path), FIELDS)[0].count() == 1
