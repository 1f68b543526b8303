"""Data-quality counts and the strict gate before modelling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import schemas
from riskflow.constants import TXN_TYPES


def _constraints() -> dict[str, Column]:
    """Conditions that hold for broken values; null for unknown ones."""
    amount = F.col("amount")
    return {
        "negative_amount": (amount < 0) | F.isnan(amount),
        "invalid_label": ~F.col("isFraud").isin(0, 1),
        "negative_step": F.col("step") < 0,
    }


def _violations(df: DataFrame) -> dict[str, Column]:
    checks = {
        **_constraints(),
        "null_amount": F.col("amount").isNull(),
        "null_step": F.col("step").isNull(),
        "unknown_type": F.col("type").isNull() | ~F.col("type").isin(*TXN_TYPES),
        "null_origin": F.col("nameOrig").isNull(),
        "null_target": F.col("nameDest").isNull(),
    }
    if schemas.CORRUPT in df.columns:
        checks["corrupt_record"] = F.col(schemas.CORRUPT).isNotNull()
    return checks


def dq_report(df: DataFrame) -> DataFrame:
    """One row per check with its number of violations, from a single pass over the table."""
    checks = _violations(df)
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(condition).alias(name) for name, condition in checks.items()),
    )
    lines = F.array(
        *(F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations")) for n in checks)
    )
    return counted.select("rows", F.inline(lines)).select("check_name", "violations", "rows")


def enforce(df: DataFrame) -> DataFrame:
    """The same rows, failing the job at the first negative amount, bad label or bad step.

    The test travels with the rows instead of being a job of its own. Nulls and empty input
    pass.
    """
    broken = F.lit(False)
    for condition in _constraints().values():
        broken = broken | F.coalesce(condition, F.lit(False))
    failure = F.raise_error(F.lit("Negative transaction amount or step, or invalid fraud label"))
    return df.filter(F.when(broken, failure.cast("boolean")).otherwise(True))


def schema_mismatches(df: DataFrame, expected: T.StructType = schemas.RAW) -> dict[str, str]:
    """Columns whose analysed type differs from the declared one, as ``found, expected``."""
    found = {f.name: f.dataType for f in df.schema.fields}
    return {
        f.name: f"{found[f.name].simpleString()}, {f.dataType.simpleString()}"
        for f in expected.fields
        if f.name in found and found[f.name] != f.dataType
    }


def failed_casts(df: DataFrame, expected: T.StructType = schemas.RAW) -> DataFrame:
    """For columns read as another type, such as text: how many non-null values do not fit
    the declared one. One pass over the table, no row when all types are right."""
    wrong = list(schema_mismatches(df, expected))
    if not wrong:
        return df.sparkSession.createDataFrame([], "column_name string, failed long")

    def fails(name: str) -> Column:
        value = F.col(name)
        return value.isNotNull() & value.try_cast(expected[name].dataType).isNull()

    counted = df.agg(*(F.count_if(fails(n)).alias(n) for n in wrong))
    lines = (F.struct(F.lit(n).alias("column_name"), F.col(n).alias("failed")) for n in wrong)
    return counted.select(F.inline(F.array(*lines)))


def with_misfits(text: DataFrame, expected: T.StructType = schemas.RAW) -> DataFrame:
    """Rows of a file read as text, with its corrupt lines, as typed columns and ``misfits``: the
    names of the fields that do not fit their declared type (these are null), ``layout`` for a
    line with the wrong number of fields, nothing for a sound line. Only an unsound one keeps its
    text, as one line.

    A typed read marks a line as corrupt only if a column that the query happens to need does not
    fit; here every field is looked at, whatever is selected later.
    """
    declared = {f.name: f.dataType for f in expected.fields}
    fields = [c for c in text.columns if c not in ("txn_id", schemas.CORRUPT)]
    typed = {c: F.col(c).try_cast(declared[c]).alias(c) for c in fields if c in declared}
    broken = F.array_compact(
        F.array(
            *(F.when(F.col(c).isNotNull() & F.col(c).try_cast(declared[c]).isNull(), F.lit(c)) for c in typed)
        )
    )
    misfits = F.when(F.col(schemas.CORRUPT).isNotNull(), F.array(F.lit("layout"))).otherwise(broken)
    line = F.coalesce(F.col(schemas.CORRUPT), F.when(F.size(broken) > 0, F.to_csv(F.struct(*fields))))
    return text.select(
        *(typed.get(c, F.col(c)) for c in text.columns if c != schemas.CORRUPT),
        line.alias(schemas.CORRUPT),
        misfits.alias("misfits"),
    )


def ingest_metrics(expected: T.StructType = schemas.RAW) -> list[Column]:
    """Counts to observe while rows with ``misfits`` pass by."""
    return [
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.size("misfits") > 0).alias("quarantined"),
        *(
            F.count_if(F.array_contains("misfits", name)).alias(f"misfit_{name}")
            for name in (*expected.names, "layout")
        ),
    ]
