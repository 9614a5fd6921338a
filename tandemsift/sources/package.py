"""Result packages: tables written beside a manifest that tells their rows and digest, and the bytes and digest of each file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def digest(df: DataFrame) -> DataFrame:
    """Rows and an order-free digest of a table, as one row. Columns count in the order of their names; nulls differ from any text."""
    cells = [c for n in sorted(df.columns) for c in (F.col(n).isNull(), F.col(n).cast("string"))]
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.xxhash64(*cells).cast("decimal(20,0)")), F.lit(0)).cast("string").alias("digest"))


def write_result_package(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Writes tables to a staging folder, checks each against what was read in, then publishes by one rename.

    A table whose rows or digest came out otherwise than they went in stops the package, and nothing is published.
    Beside the manifest stands a list of the tables' files. No table may be named manifest or files. Returns the manifest.
    """
    spark = next(iter(tables.values())).sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    staging = f"{path}.staging"
    fs = hadoop(staging).getFileSystem(spark._jsc.hadoopConfiguration())
    if {"manifest", "files"} & set(tables):
        raise ValueError("manifest and files are the package's own names")
    if fs.exists(hadoop(path)):
        raise FileExistsError(path)
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{staging}/{name}")
    manifest = named_digests({name: spark.read.parquet(f"{staging}/{name}") for name in tables})
    given = named_digests(tables).withColumnsRenamed({"rows": "_rows", "digest": "_digest"})
    broken = [r[0] for r in manifest.join(given, "table").filter("rows <> _rows OR digest <> _digest").select("table").collect()]
    if broken:
        raise OSError(f"{path}: {', '.join(sorted(broken))} came out otherwise than read in")
    manifest.coalesce(1).write.mode("overwrite").json(f"{staging}/manifest")
    file_list(spark, staging, list(tables)).write.mode("overwrite").json(f"{staging}/files")
    if not fs.rename(hadoop(staging), hadoop(path)):
        raise OSError(f"{path} can't be published")
    return manifest_of(spark, path)


def named_digests(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [digest(df).withColumn("table", F.lit(name)) for name, df in tables.items()])


def manifest_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("table string, rows long, digest string").json(f"{path}/manifest")


def manifest_integrity(spark: SparkSession, path: str) -> DataFrame:
    """Tables whose rows or digest differ from the manifest's; none in a whole package."""
    stated = manifest_of(spark, path)
    held = {name: spark.read.parquet(f"{path}/{name}") for (name,) in stated.select("table").collect()}
    found = named_digests(held).withColumnsRenamed({"rows": "found_rows", "digest": "found_digest"})
    return stated.join(found, "table").filter("rows <> found_rows OR digest <> found_digest")


def files_of(spark: SparkSession, path: str, tables: list[str]) -> DataFrame:
    """Per Parquet file of the tables: its bytes and SHA-256. Executors read a file at a time, which must be under 2 GB."""
    read = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    each = [read.load(f"{path}/{name}").select(F.lit(name).alias("table"), F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")) for name in tables]
    return reduce(DataFrame.unionByName, each)


def file_list(spark: SparkSession, path: str, tables: list[str]) -> DataFrame:
    """files_of() as one file's rows. These are shuffled: coalesced, one task would read all the tables' files."""
    return files_of(spark, path, tables).repartition(1)


def file_integrity(spark: SparkSession, path: str, contents: bool = True) -> DataFrame:
    """Files that differ from the package's list: MISSING, ADDED, SIZE (cut short or longer) or CONTENT (as long, other bytes).

    A damaged file is named without being opened as Parquet. Without contents only lengths are compared, from the
    folder listing; no file is read then.
    """
    stated = spark.read.schema("table string, file string, bytes long, sha256 string").json(f"{path}/files")
    tables = [r[0] for r in manifest_of(spark, path).select("table").collect()]
    found = files_of(spark, path, tables).withColumnsRenamed({"bytes": "found_bytes", "sha256": "found_sha256"})
    if not contents:
        found = found.withColumn("found_sha256", F.lit(None).cast("string"))
    reason = (
        F.when(F.col("found_bytes").isNull(), "MISSING").when(F.col("bytes").isNull(), "ADDED").when(F.col("bytes") != F.col("found_bytes"), "SIZE").when(F.col("sha256") != F.col("found_sha256"), "CONTENT")
    )
    return stated.join(found, ["table", "file"], "full").withColumn("reason", reason).filter("reason IS NOT NULL").select("table", "file", "reason", "bytes", "found_bytes")


#: Bits of a row's hash that tell one level of the tree of digests.
BRANCH = 10


def differing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one of two tables has more often than the other, as often as it does: ONLY_A or ONLY_B in `side`.

    Both tables have the same columns. Digests of the rows whose hash starts alike are compared first, level by
    level of a tree with 1,024 branches: what is shuffled for that are counts and sums of at most so many nodes a
    task, and rows are shuffled only where nodes of the second level differ. Equal tables have no row shuffled.
    """
    names = a.columns
    cells = [c for n in sorted(names) for c in (F.col(f"`{n}`").isNull(), F.col(f"`{n}`").cast("string"))]
    node = lambda level: F.shiftrightunsigned(F.xxhash64(*cells), 64 - BRANCH * level)

    def unequal(x: DataFrame, y: DataFrame, level: int) -> DataFrame:
        digest = lambda df, p: df.groupBy(node(level).alias("_node")).agg(F.count("*").alias(f"{p}n"), F.sum(F.xxhash64(F.lit(level), *cells).cast("decimal(20,0)")).alias(f"{p}d"))
        both = digest(x, "x").join(digest(y, "y"), "_node", "full")
        return both.filter("NOT (xn <=> yn AND xd <=> yd)").select("_node")

    b = b.select(*[F.col(f"`{n}`") for n in names])
    first = [r[0] for r in unequal(a, b, 1).collect()]  # 1,024 numbers at most
    if not first:
        return a.limit(0).select(F.lit("").alias("side"), "*")
    a, b = (df.filter(node(1).isin(first)) for df in (a, b))
    second = F.broadcast(unequal(a, b, 2))  # 2 ** 20 numbers at most
    within = [df.withColumn("_at", node(2)).join(second, F.col("_at") == F.col("_node"), "left_semi").drop("_at").withColumn("_more", F.lit(n)) for df, n in ((a, 1), (b, -1))]
    counts = within[0].unionByName(within[1]).groupBy(*[F.col(f"`{n}`") for n in names]).agg(F.sum("_more").alias("_more")).filter("_more <> 0")
    each = counts.withColumn("_each", F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_more"))))
    return each.select(F.when(F.col("_more") > 0, "ONLY_A").otherwise("ONLY_B").alias("side"), *[F.col(f"`{n}`") for n in names])
