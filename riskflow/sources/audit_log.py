"""The append-only audit log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import schemas


def append_audit(records: DataFrame, path: str, logged_at: Column | None = None) -> None:
    """Stamp the records with the UTC time and append them as JSON lines, by day."""
    stamped = records.withColumn(
        "timestamp", F.current_timestamp() if logged_at is None else logged_at
    )
    (
        stamped.withColumn("log_date", F.to_date("timestamp"))
        .write.mode("append")
        .partitionBy("log_date")
        .option("ignoreNullFields", False)
        .json(path)
    )


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """All records; ``log_date`` prunes folders."""
    schema = T.StructType([*schemas.AUDIT.fields, T.StructField("log_date", T.DateType())])
    return spark.read.schema(schema).json(path)
