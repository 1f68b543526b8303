"""Identifier columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskflow.constants import DEFAULT_SALT


def salted_hash(value: Column, salt: str = DEFAULT_SALT) -> Column:
    """Hex SHA-256 of ``value_salt``; a null stays null because ``concat`` propagates it."""
    return F.sha2(F.concat(value, F.lit(f"_{salt}")), 256)


def version_of(path: Column) -> Column:
    """Last segment of a slash-separated artifact path."""
    return F.element_at(F.split(path, "/"), -1)
