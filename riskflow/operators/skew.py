"""Finding the few keys that hold too many rows for one task."""

from __future__ import annotations

from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is worth splitting ...
HOT_ROWS = 2_000_000
# ... unless that is still less than this many times an even share of BUCKETS, which any
# cluster large enough for the table takes in one task anyway.
BUCKETS = 1 << 16
EVEN_SHARES = 4


class HotKeys(NamedTuple):
    """Keys above ``limit`` rows; at most ``BUCKETS / EVEN_SHARES`` of them can exist."""

    values: tuple[Any, ...]
    limit: int

    def match(self, key: Column) -> Column:
        """True for rows of a hot key, never null."""
        known = [v for v in self.values if v is not None]
        hit = F.coalesce(key.isin(known), F.lit(False)) if known else F.lit(False)
        return hit | key.isNull() if None in self.values else hit


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> HotKeys:
    """Exact list of the keys holding more than ``limit`` rows, nulls counted as one key.

    A first pass counts rows per hash bucket: combined before the shuffle, at most BUCKETS
    rows leave it however many keys there are. Only when a bucket is over the limit does a
    second pass count the keys of those buckets exactly.
    """
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS))
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    summary = counts.agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("bucket", "n")).alias("counts")
    )
    limit = F.greatest(
        F.lit(hot_rows).cast("long"), F.ceil(F.col("total") * EVEN_SHARES / BUCKETS)
    )
    # One row; after the filter it lists at most BUCKETS / EVEN_SHARES buckets.
    found = summary.select(
        F.coalesce(limit, F.lit(hot_rows)).alias("limit"),
        F.transform(
            F.filter("counts", lambda c: c["n"] > limit), lambda c: c["bucket"]
        ).alias("buckets"),
    ).first()
    if not found["buckets"]:
        return HotKeys((), found["limit"])
    exact = (
        df.filter(bucket.isin(found["buckets"]))
        .groupBy(F.col(key).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > found["limit"])
    )
    return HotKeys(tuple(r["key"] for r in exact.select("key").collect()), found["limit"])
