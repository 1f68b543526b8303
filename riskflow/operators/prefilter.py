"""Dropping rows that a join cannot need, before anything is exchanged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits that mark the wanted keys: 2^24 bits, some megabytes however many keys there
#: are. Beyond ten million keys most bits are set, and fewer rows are dropped; none is lost.
WORDS = 1 << 18


def keep_possible(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``key`` may occur in ``wanted``: all that do, and few others.

    Each wanted key sets one bit of a fixed bitmap, which is sent to all tasks; a row stays if the
    bit of its key is set. Null keys match nothing in a join and go.
    """
    marked = _placed(rows.where(F.col(key).isNotNull()), key)
    possible = marked.join(F.broadcast(_marks(wanted, key)), F.col("_at") == F.col("_word"))
    return possible.where(F.expr("shiftright(_bits, _place) & 1L = 1L")).select(*rows.columns)


def maybe_in(rows: DataFrame, key: str, wanted: DataFrame, name: str) -> DataFrame:
    """Add ``name``: true for the rows that ``keep_possible`` would keep, false for the others."""
    marked = _placed(rows, key).join(F.broadcast(_marks(wanted, key)), F.col("_at") == F.col("_word"), "left")
    hit = F.coalesce(F.expr("shiftright(_bits, _place) & 1L = 1L"), F.lit(False))
    return marked.withColumn(name, hit).select(*rows.columns, name)


def _bit(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(WORDS * 64))


def _marks(wanted: DataFrame, key: str) -> DataFrame:
    return (
        wanted.where(F.col(key).isNotNull())
        .select((_bit(key) / 64).cast("int").alias("_word"), (_bit(key) % 64).cast("int").alias("_place"))
        .groupBy("_word")
        .agg(F.bit_or(F.expr("shiftleft(1L, _place)")).alias("_bits"))
    )


def _placed(rows: DataFrame, key: str) -> DataFrame:
    return rows.withColumns({"_at": (_bit(key) / 64).cast("int"), "_place": (_bit(key) % 64).cast("int")})
