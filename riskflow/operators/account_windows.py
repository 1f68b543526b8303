"""Per-account windows that survive an account holding a third of all rows.

Ordinary accounts take the plain route: one exchange and one sort on the account, one
window pass for all columns. The rows of a hot account are cut into consecutive chunks, and
each chunk is preceded by a halo of the earlier rows its windows can reach, so the same
window expressions give the same values chunk by chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import window as W

from riskflow.constants import ROLLING_SPAN
from riskflow.operators.skew import HOT_ROWS, HotKeys, hot_keys
from riskflow.session import scratch_dir

ROLLING = ("txn_count_24h", "avg_amount_24h")
SEQUENCE = ("step_gap", "last_transfer_step")
_BEFORE = -(ROLLING_SPAN - 1)
#: Units whose ends one task puts in order.
FAN = 256
#: Amounts in frames of hours are summed exactly, with eight decimals.
AMOUNT_TYPE = "decimal(38,8)"


def account_windows(
    df: DataFrame,
    account: str,
    columns: Sequence[str] = ROLLING + SEQUENCE,
    frame: str = "rows",
    row_id: str = "txn_id",
    is_transfer: Column | None = None,
    hot: HotKeys | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add per-account columns, ordered by ``step`` and then ``row_id``:

    ``txn_count_24h``, ``avg_amount_24h``: rows and mean amount of the last 24 rows
    (``frame="rows"``) or of the last 24 hours, all rows of this hour included
    (``frame="hours"``); ``step_gap``: hours since the previous row, null for the first;
    ``last_transfer_step``: hour of the latest row up to and including this one for which
    ``is_transfer`` holds.

    ``hot`` takes the result of an earlier ``hot_keys`` on the same rows. Where there are hot
    accounts, their rows are counted and written to the shared scratch folder when the frame is
    built, by a job of its own; their chunks do not exceed about ``hot_rows``. Both routes give the
    same values to the last bit.
    """
    if frame not in ("rows", "hours"):
        raise ValueError(f"frame must be 'rows' or 'hours', not {frame!r}")
    transfer = F.lit(False) if is_transfer is None else is_transfer
    hot = hot_keys(df, account, hot_rows) if hot is None else hot
    if not hot.values:
        return _plain(df, [account], columns, frame, row_id, transfer)
    is_hot = hot.match(F.col(account))
    usual = _plain(df.filter(~is_hot), [account], columns, frame, row_id, transfer)
    split = _chunked(
        df.filter(is_hot), account, columns, frame, row_id, transfer, min(hot.limit, hot_rows)
    )
    return usual.unionByName(split)


def _plain(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    frame: str,
    row_id: str,
    transfer: Column,
) -> DataFrame:
    ordered = W.Window.partitionBy(*keys).orderBy("step", row_id)
    span = ordered.rowsBetween(_BEFORE, 0)
    if frame == "hours":
        span = W.Window.partitionBy(*keys).orderBy("step").rangeBetween(_BEFORE, 0)
    return df.select("*", *_window_columns(columns, span, ordered, transfer, frame == "hours"))


def _window_columns(
    columns: Sequence[str],
    span: WindowSpec,
    ordered: WindowSpec,
    transfer: Column,
    exact: bool = False,
) -> list[Column]:
    transfer_step = F.when(transfer, F.col("step"))

    def mean() -> Column:
        if not exact:  # the same few rows in the same order on either route
            return F.avg("amount").over(span)
        amount = F.col("amount").cast("double")
        counts = (F.sum(c.cast("long")).over(span) for c in (_known(amount), F.isnan(amount)))
        return _mean(F.sum(_exact(amount)).over(span), *counts)

    made = {
        "txn_count_24h": lambda: F.count(F.lit(1)).over(span),
        "avg_amount_24h": mean,
        "step_gap": lambda: F.col("step") - F.lag("step").over(ordered),
        "last_transfer_step": lambda: F.last(transfer_step, ignorenulls=True).over(
            ordered.rowsBetween(W.Window.unboundedPreceding, 0)
        ),
    }
    return [made[name]().alias(name) for name in columns]


# -- hot accounts ---------------------------------------------------------------------


def _chunked(
    df: DataFrame,
    account: str,
    columns: Sequence[str],
    frame: str,
    row_id: str,
    transfer: Column,
    limit: int,
) -> DataFrame:
    given = df.columns
    if "amount" not in given:
        df = df.withColumn("amount", F.lit(None).cast("double"))
    df = df.withColumn("_is_transfer", F.coalesce(transfer, F.lit(False)))
    rows, parts = _with_chunks(df, account, row_id, limit)
    wanted = [c for c in columns if frame == "rows" or c in SEQUENCE]
    if wanted:
        rows = _with_halo(rows, account, wanted, row_id, parts)
    if frame == "hours" and set(columns) & set(ROLLING):
        rows = _with_hour_totals(rows, account, columns)
    return rows.select(*given, *columns)


def _with_chunks(df: DataFrame, account: str, row_id: str, limit: int) -> tuple[DataFrame, int]:
    """The rows, stored once with their chunk key, the account's hour and a part of it, and the
    number of parts.

    Parts are ranges of (account, hour, row id) of about half of ``limit`` rows each. Spark takes
    their edges from a sample of the rows, so ids may lie clustered or far apart. The stored table
    gives every later pass the same parts and spares it the source."""
    parts = max(1, -(-2 * df.count() // limit))
    cut = (
        df.withColumn("_hour", F.col("step"))
        .repartitionByRange(parts, account, "_hour", row_id)
        .withColumn("_part", F.spark_partition_id())
    )
    path = scratch_dir(df.sparkSession, "hot-rows")
    cut.write.parquet(path)
    return df.sparkSession.read.schema(cut.schema).parquet(path), parts


def _with_halo(
    rows: DataFrame, account: str, columns: Sequence[str], row_id: str, parts: int
) -> DataFrame:
    chunk = [account, "_hour", "_part"]
    carried = _carried(rows, account, row_id, parts)
    # A transfer older than the carried rows goes in front of them, out of the 24-row frame.
    older = F.col("_transfer").isNotNull() & ~F.array_contains(
        F.col(f"_rows.{row_id}"), F.col(f"_transfer.{row_id}")
    )
    halo = carried.select(
        *chunk,
        F.explode(
            F.when(older, F.concat(F.array("_transfer"), "_rows")).otherwise(F.col("_rows"))
        ).alias("_row"),
    ).select(*chunk, "_row.*", F.lit(True).alias("_halo"))

    both = rows.withColumn("_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)
    windowed = _plain(both, chunk, columns, "rows", row_id, F.col("_is_transfer"))
    return windowed.filter(~F.col("_halo")).drop("_halo")


def _carried(rows: DataFrame, account: str, row_id: str, parts: int) -> DataFrame:
    """Per chunk, the account's last rows and latest transfer before it, ``_rows`` and
    ``_transfer``.

    A scan in levels: chunks within their part, parts within groups of ``FAN`` parts, groups
    within groups of groups, until one group holds all. Two ends joined are an end again (the last
    rows of both, the later transfer), so each level looks at the ends of its own units only, and
    no task orders more than ``FAN`` of them or the chunks of one part.
    """
    chunk = [account, "_hour", "_part"]
    carried = _before(_ends(rows, account, row_id, chunk), [account, "_part"], "_hour")
    carried = carried.withColumn("_unit", F.col("_part"))
    ends = _ends(rows, account, row_id, [account, "_part"]).withColumnRenamed("_part", "_unit")
    size = 1
    while size < parts:
        size *= FAN
        group = F.floor(F.col("_unit") / FAN)
        ends = ends.withColumn("_group", group)
        carried = _joined(carried, _before(ends, [account, "_group"], "_unit"), account)
        carried = carried.withColumn("_unit", group)
        ends = ends.groupBy(account, F.col("_group").alias("_unit")).agg(
            _last_n(F.sort_array(F.flatten(F.collect_list("_rows")))).alias("_rows"),
            F.max("_transfer").alias("_transfer"),
        )
    return carried.select(*chunk, "_rows", "_transfer")


def _ends(rows: DataFrame, account: str, row_id: str, unit: Sequence[str]) -> DataFrame:
    """The last rows and the latest transfer of each unit of consecutive rows of an account."""
    # Transfers and others apart, so that the latest transfer is among them. A rank filter like
    # this is applied before the shuffle as well as after it.
    latest = W.Window.partitionBy(*unit, "_is_transfer").orderBy(F.desc("step"), F.desc(row_id))
    kept = (
        rows.select(*dict.fromkeys((*unit, "step", row_id, "amount", "_is_transfer")))
        .withColumn("_rank", F.row_number().over(latest))
        .filter(F.col("_rank") <= -_BEFORE)
    )
    row = F.struct("step", row_id, "amount", "_is_transfer")
    return kept.groupBy(*unit).agg(
        _last_n(F.sort_array(F.collect_list(row))).alias("_rows"),
        F.max(F.when(F.col("_is_transfer"), row)).alias("_transfer"),
    )


def _before(ends: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """Each unit with the joined ends of the earlier units of its group instead of its own."""
    earlier = W.Window.partitionBy(*group).orderBy(order)
    rows = F.flatten(F.collect_list("_rows").over(earlier.rowsBetween(_BEFORE, -1)))
    transfer = F.last("_transfer", ignorenulls=True).over(
        earlier.rowsBetween(W.Window.unboundedPreceding, -1)
    )
    return ends.select(
        *(c for c in ends.columns if c not in ("_rows", "_transfer")),
        _last_n(rows).alias("_rows"),
        transfer.alias("_transfer"),
    )


def _joined(carried: DataFrame, above: DataFrame, account: str) -> DataFrame:
    """What is carried into a unit goes before what its chunks have seen of it."""
    upper = above.select(
        F.col(account).alias("_a"),
        F.col("_unit").alias("_u"),
        F.col("_rows").alias("_upper_rows"),
        F.col("_transfer").alias("_upper_transfer"),
    )
    same = carried[account].eqNullSafe(F.col("_a")) & (carried["_unit"] == F.col("_u"))
    return carried.join(upper, same).select(
        *(c for c in carried.columns if c not in ("_rows", "_transfer")),
        _last_n(F.concat("_upper_rows", "_rows")).alias("_rows"),
        F.coalesce("_transfer", "_upper_transfer").alias("_transfer"),
    )


def _last_n(array: Column, n: int = -_BEFORE) -> Column:
    return F.slice(array, F.greatest(F.size(array) - (n - 1), F.lit(1)), F.lit(n))


# -- frames of hours --------------------------------------------------------------------


def _exact(amount: Column) -> Column:
    """An amount as a fixed-point number: its sums are exact, whatever their order."""
    return F.when(_known(amount), amount).cast(AMOUNT_TYPE)


def _known(amount: Column) -> Column:
    """Neither null nor NaN; a null is not NaN either."""
    return amount.isNotNull() & ~F.isnan(amount)


def _mean(total: Column, known: Column, unclear: Column) -> Column:
    """The mean from an exact total; NaN if a NaN was among the amounts, null without any."""
    mean = F.try_divide(total.cast("double"), known)
    return F.when(unclear > 0, F.lit(float("nan"))).otherwise(mean)


def _with_hour_totals(rows: DataFrame, account: str, columns: Sequence[str]) -> DataFrame:
    """A 24-hour frame takes whole hours, so totals of the hours are enough: the window runs over
    one row per account and hour, and its result goes back to the rows hour by hour."""
    amount = F.col("amount").cast("double")
    hours = rows.groupBy(account, "_hour").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(_exact(amount)).alias("_sum"),
        F.count_if(_known(amount)).alias("_known"),
        F.count_if(F.isnan(amount)).alias("_unclear"),
    )
    span = W.Window.partitionBy(account).orderBy("_hour").rangeBetween(_BEFORE, 0)
    over = {c: F.sum(c).over(span) for c in ("_n", "_sum", "_known", "_unclear")}
    totals = hours.select(
        F.col(account).alias("_a"),
        F.col("_hour").alias("_h"),
        over["_n"].alias("txn_count_24h"),
        _mean(over["_sum"], over["_known"], over["_unclear"]).alias("avg_amount_24h"),
    )
    same_hour = rows[account].eqNullSafe(F.col("_a")) & rows["_hour"].eqNullSafe(F.col("_h"))
    return rows.join(totals, same_hour, "left")
