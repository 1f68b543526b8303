"""Files in and out: CSV, Parquet and JSON, always with a declared schema."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import schemas


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType = schemas.RAW, keep_corrupt: bool = False
) -> DataFrame:
    """CSV with a header, columns in any order. Types come from ``schema`` by name; columns
    it lacks are read as text, and a file whose header differs from the first one's fails.

    A field that does not fit its type becomes null; with ``keep_corrupt`` the whole line is
    kept in ``_corrupt_record`` for the quality report.
    """
    header = spark.read.option("header", True).csv(path).columns
    declared = {f.name: f for f in schema.fields}
    fields = [declared.get(name, T.StructField(name, T.StringType())) for name in header]
    reader = (
        spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    )
    if keep_corrupt:
        fields.append(T.StructField(schemas.CORRUPT, T.StringType()))
        # The number of fields is checked whichever columns a query needs.
        reader = reader.option("columnNameOfCorruptRecord", schemas.CORRUPT).option("columnPruning", False)
    return reader.schema(T.StructType(fields)).csv(path)


def with_txn_id(raw: DataFrame) -> DataFrame:
    """Number the rows of a raw file that has no id of its own.

    Unique without a shuffle and equal for equal files, but tied to how the files are cut
    into tasks: write the result once and let later stages read that.
    """
    return raw.select(F.monotonically_increasing_id().alias("txn_id"), "*")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Filters and column choices on the result reach the scan."""
    return spark.read.parquet(path)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: str | None = "day",
    mode: str = "overwrite",
    gather: bool = True,
) -> None:
    """Parquet, in folders of ``partition_by``. Rows of a folder are brought together first,
    or every task would add a small file to every folder; a folder too large for one task is
    cut into several by adaptive execution. ``gather=False`` is for rows that come in the order
    of the folders already, or have few of them."""
    if partition_by is None:
        df.write.mode(mode).parquet(path)
        return
    if not gather:
        df.write.mode(mode).partitionBy(partition_by).parquet(path)
        return
    df.hint("rebalance", F.col(partition_by)).write.mode(mode).partitionBy(partition_by).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One document per line; nested arrays and structs are kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """``multi_line`` reads files that hold one indented document or an array of documents."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def load_policy(spark: SparkSession, path: str) -> dict[str, Any]:
    """The single record of a policy file."""
    return read_json(spark, path, schemas.POLICY, multi_line=True).first().asDict(recursive=True)


def write_report_csv(df: DataFrame, path: str) -> None:
    """A short ordered report, such as a sweep or its best rows, as one CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def stage_report(df: DataFrame, stage: str) -> DataFrame:
    """Rows and columns of a stage's output; on Parquet the count reads no column."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(stage).alias("stage"), "row_count", F.lit(len(df.columns)).alias("column_count")
    )
