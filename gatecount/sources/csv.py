"""Delimited text in and out: every cell a string, blanks kept apart from rows that are broken.

Spark strips a byte-order mark and gives null for blank cells; the quality operators treat null and
blank alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_strings(spark: SparkSession, path: str, columns: list[str], *, strict: bool = False) -> DataFrame:
    """Named columns as strings. ``strict`` drops rows of another length and rows without any value."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
    if not strict:
        return reader.csv(path)
    any_value = F.lit(False)
    for c in columns:
        any_value = any_value | F.col(c).isNotNull()
    return reader.option("mode", "DROPMALFORMED").option("columnPruning", False).csv(path).filter(any_value)


def read_with_rejects(spark: SparkSession, path: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows as strings, rejected lines with quality_issue): lines of another length and lines without any value.

    A rejected line is kept as it stood, with the file it came from; nothing is dropped without a trace.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "raw_line"]])
    read = spark.read.schema(schema).option("header", True).option("escape", '"').option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "raw_line").option("columnPruning", False).csv(path)
    blank = F.lit(True)
    for c in columns:
        blank = blank & F.col(c).isNull()
    issue = F.when(F.col("raw_line").isNotNull(), "BROKEN_LINE").when(blank, "BLANK_LINE")
    marked = read.select("*", issue.alias("quality_issue"), F.input_file_name().alias("source_file"))
    return marked.filter("quality_issue is null").select(*columns), marked.filter("quality_issue is not null").select("quality_issue", "raw_line", "source_file")


def read_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Columns of declared types from any file of a folder, with the file's name; bad cells become null."""
    return spark.read.schema(schema).option("header", True).csv(path).withColumn("source_file", F.input_file_name())


def write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def append_quarantine(df: DataFrame, table: str, path: str) -> None:
    """Rows with a quality_issue, under their table's partition."""
    df.filter(F.col("quality_issue").isNotNull()).withColumn("table", F.lit(table)).write.mode("append").partitionBy("table").parquet(path)
