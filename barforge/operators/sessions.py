"""Session windows: runs of a key's events without a longer gap.

An event begins a session if the one before it lies more than ``gap`` back. A key with
more events than a task should hold is cut into blocks of its order; a block knows of those
before it the time of their last event, and how many sessions began in them, so sessions
run on over the borders of blocks.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from barforge.functions.blocks import key_equals, placed_in_order, split_by_size
from barforge.functions.history import MAX_ROWS_PER_TASK


def add_sessions(events: DataFrame, by: Sequence[str], on: str, gap: str | float, out: str = "session",
                 max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """``events`` with the number of each row's session within its key, from 1.

    ``gap`` is an interval such as ``"INTERVAL 30 MINUTES"`` for times, or a number; events
    exactly that far apart are still of one session. A missing key is a key. Events without
    a time belong to no session: their number is missing.
    """
    by = list(by)
    keys = [f"__k{i}" for i in range(len(by))]
    rows = events.where(F.col(on).isNotNull()).withColumns({k: F.col(c) for k, c in zip(keys, by)})
    limit = F.expr(gap) if isinstance(gap, str) else F.lit(gap)

    def begins(before: Column) -> Column:
        return F.when(before.isNull() | (F.col(on) > before + limit), 1).otherwise(0).cast("bigint")

    def numbered(df: DataFrame, partition: list[str], order: list[str], before: Column | None = None) -> DataFrame:
        window = Window.partitionBy(*partition).orderBy(*order)
        last = F.lag(on).over(window)
        df = df.withColumn("__new", begins(last if before is None else F.coalesce(last, before)))
        return df.withColumn(out, F.sum("__new").over(window.rowsBetween(Window.unboundedPreceding, 0)))

    short, long = split_by_size(rows, keys, max_rows)
    # Rows of one time are of one session whatever their order; the other columns need no sorting.
    result = numbered(short, keys, [on]).select(*events.columns, out)
    if long is not None:
        blocks = placed_in_order(long, keys, [on]).withColumn("__block", F.floor(F.col("position") / F.lit(max_rows)))
        parted = Window.partitionBy(*keys).orderBy("__block")
        of = [F.col(k).alias(f"{k}_of") for k in keys]
        same = key_equals(keys) & (F.col("__block") == F.col("__block_of"))
        lasts = blocks.groupBy(*keys, "__block").agg(F.max(on).alias("__last"))
        lasts = lasts.select(*of, F.col("__block").alias("__block_of"), F.lag("__last").over(parted).alias("__before"))
        inside = numbered(blocks.join(lasts, same).drop(*(f"{k}_of" for k in keys), "__block_of"),
                          [*keys, "__block"], ["position"], F.col("__before"))
        begun = inside.groupBy(*keys, "__block").agg(F.sum("__new").alias("__begun"))
        earlier = F.sum("__begun").over(parted.rowsBetween(Window.unboundedPreceding, -1))
        begun = begun.select(*of, F.col("__block").alias("__block_of"), F.coalesce(earlier, F.lit(0)).alias("__earlier"))
        whole = inside.join(begun, same).withColumn(out, F.col(out) + F.col("__earlier"))
        result = result.unionByName(whole.select(*events.columns, out))
    return result.unionByName(events.where(F.col(on).isNull()).withColumn(out, F.lit(None).cast("bigint")))


def session_windows(events: DataFrame, by: Sequence[str], on: str, gap: str | float, aggregates: Sequence[Column] = (),
                    max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """One row per session: key, number, times of its first and last event, events, ``aggregates``.

    Aggregation combines before it shuffles, so a session of any length is no burden.
    """
    rows = add_sessions(events, by, on, gap, "session", max_rows).where("session is not null")
    return rows.groupBy(*by, "session").agg(
        F.min(on).alias("session_start"), F.max(on).alias("session_end"), F.count(F.lit(1)).alias("n_events"), *aggregates)
