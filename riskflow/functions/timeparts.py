"""Calendar parts of the integer hour counter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskflow.constants import NIGHT_HOURS, TRAIN_END_DAY, VAL_END_DAY

#: 2024-01-01 in seconds: the moment of step 0 where a caller names no other.
STEP_ORIGIN = 1_704_067_200


def hour_of(step: Column) -> Column:
    """Hour 0..23, also for negative steps."""
    return F.pmod(step, F.lit(24)).cast("int")


def day_of(step: Column) -> Column:
    """Whole days, rounded down, so hour -1 belongs to day -1."""
    return F.floor(step / F.lit(24)).cast("int")


def is_night(hour: Column) -> Column:
    return hour.between(*NIGHT_HOURS).cast("int")


def moment_of(step: Column, origin: int = STEP_ORIGIN) -> Column:
    """The hour of a step as a timestamp; ``origin`` is step 0 in seconds since 1970, UTC."""
    return F.timestamp_seconds(step * 3600 + origin)


def split_of(day: Column) -> Column:
    """Chronological split name; null when the day is unknown."""
    return (
        F.when(day <= TRAIN_END_DAY, F.lit("train"))
        .when(day <= VAL_END_DAY, F.lit("val"))
        .when(day.isNotNull(), F.lit("test"))
    )
