"""Tables under a contract: a cell parser that gives typed rows, and every cell that isn't as declared with its place and reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .readers import MISSING
from .scratch import new_folder

#: The texts of whole numbers, numbers, truth values and times.
PATTERNS = {
    "integer": r"^[+-]?[0-9]+$",
    "number": r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$",
    "boolean": r"^(true|false)$",
    "datetime": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T",
}
TYPES = {"string": "string", "integer": "bigint", "number": "double", "boolean": "boolean", "datetime": "timestamp"}


@dataclass(frozen=True)
class Field:
    """A column of a contract: its kind, whether it may be missing, the values allowed and the least and greatest number."""

    name: str
    kind: str = "string"
    required: bool = False
    values: tuple[str, ...] = ()
    least: float | None = None
    most: float | None = None

    def missing(self, cell: Column) -> Column:
        """Whether a cell stands for no value; a mark that is an allowed value is a value."""
        return cell.isin(*[m for m in MISSING if m not in self.values])

    def typed(self, cell: Column) -> Column:
        return F.when(~self.missing(cell), cell).try_cast(TYPES[self.kind])

    def reason(self, cell: Column) -> Column:
        """What is wrong with a cell, null if nothing is."""
        value = self.typed(cell)
        wrong = F.when(self.missing(cell), F.lit("REQUIRED") if self.required else F.lit(None).cast("string"))
        if self.kind in PATTERNS:
            wrong = wrong.when(~F.regexp_like(cell, F.lit(PATTERNS[self.kind])) | value.isNull(), f"NOT_{self.kind.upper()}")
        if self.values:
            wrong = wrong.when(~cell.isin(*self.values), "NOT_IN_ENUM")
        if self.least is not None:
            wrong = wrong.when(value < self.least, "BELOW_LEAST")
        if self.most is not None:
            wrong = wrong.when(value > self.most, "ABOVE_MOST")
        return wrong


def numbered_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(lines[file, line, value], headers[file, value]) of text files, lines counted from 1 within each file.

    A file is read in blocks by many tasks. A first pass counts each block's lines; a line's number is its place in its
    block and the lines of the blocks before, one row for each block.
    """
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    blocks = text.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"), F.min_by("value", "_id").alias("_value"))
    folder = new_folder(spark, "blocks")
    blocks.write.parquet(folder)
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = spark.read.parquet(folder).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    lines = text.join(starts.drop("_value", "_n"), ["file", "_block"]).select("file", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line"), "value")
    return lines, starts.filter("_before = 0").select("file", F.col("_value").alias("value"))


def read_contract(spark: SparkSession, path: str, fields: Sequence[Field]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a tab-separated table (plain or gzip, one file or many).

    Every file's header must be the fields' names in order, else ValueError names the file. Rows are typed; a line that
    holds anything not as declared is no row, and each of its wrong cells is a reject: file, line, column, reason, value.
    A line with too few or too many cells is one reject, WRONG_FIELD_COUNT, without a column. Nothing turns null by failing
    to parse. Empty files have no header and are passed over; no file at all, or none with a header, is an error.
    """
    lines, headers = numbered_lines(spark, path)
    names = [f.name for f in fields]
    wrong = headers.filter(F.col("value") != "\t".join(names)).first()
    if wrong or headers.isEmpty():
        raise ValueError(f"header of {wrong['file'] if wrong else path} isn't that of the contract")
    cell = lambda i: F.get("_cells", F.lit(i))
    found = lines.filter("line > 1").withColumn("_cells", F.split("value", "\t", -1))
    each = [F.struct(F.lit(f.name).alias("column"), f.reason(cell(i)).alias("reason"), cell(i).alias("value")) for i, f in enumerate(fields)]
    count = F.struct(F.lit(None).cast("string").alias("column"), F.lit("WRONG_FIELD_COUNT").alias("reason"), F.col("value"))
    bad = F.when(F.size("_cells") != len(fields), F.array(count)).otherwise(F.filter(F.array(*each), lambda x: x["reason"].isNotNull()))
    found = found.withColumn("_bad", bad)
    rows = found.filter(F.size("_bad") == 0).select(*[f.typed(cell(i)).alias(f.name) for i, f in enumerate(fields)])
    return rows, found.select("file", "line", F.explode("_bad").alias("_r")).select("file", "line", "_r.column", "_r.reason", "_r.value")
