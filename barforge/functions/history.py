"""Row-based windows over each symbol's history, for histories of any length."""

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from barforge.functions.storage import stored

# One task handles at most about this many rows of one symbol.
MAX_ROWS_PER_TASK = 1_000_000
# Lookup tables up to this many (small) rows are broadcast, larger ones shuffled.
MAX_BROADCAST_ROWS = 200_000

AddColumns = Callable[[DataFrame, WindowSpec], DataFrame]


def lookup(table: DataFrame) -> DataFrame:
    """Mark ``table`` for broadcast when its counted size allows it."""
    return F.broadcast(table) if table.count() <= MAX_BROADCAST_ROWS else table


def over_history(
    df: DataFrame,
    add_columns: AddColumns,
    back: int = 0,
    ahead: int = 0,
    min_rows: int = 0,
    max_rows: int = MAX_ROWS_PER_TASK,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Apply ``add_columns(df, window)`` to every symbol's rows in date order.

    ``back`` and ``ahead`` say how many rows before and after a row its new
    columns look at. Symbols with fewer than ``min_rows`` rows are dropped.

    Usually one task holds whole symbols: one shuffle, one sort. The rows of a
    symbol with more than ``max_rows`` rows are numbered in the same order and cut
    into blocks of that many rows, each sent to its task together with the ``back``
    rows before and the ``ahead`` rows behind it, so the results are the same and no
    task gets the whole symbol, nor a whole day of it. Rows without a symbol are a
    symbol of their own.
    ``sized_by`` may name a frame with at least as many rows per symbol as ``df``
    whose counts are cheaper to get (the bars before cleaning, say). If it has fewer and
    a history is longer than ``max_rows`` after all, reading the result is an error.
    """
    sizes = (df if sized_by is None else sized_by).groupBy("Symbol").count()
    whole = in_date_order(df, "Symbol")
    if sizes.where(F.col("count") > max_rows).isEmpty():
        if sized_by is None:
            return _added(df, add_columns, whole, min_rows)
        counted = df.withColumn("history_row", F.row_number().over(whole))
        broken = F.assert_true(F.col("history_row") <= max_rows, F.lit("sized_by has fewer rows than a symbol's history"))
        return _added(counted, add_columns, whole, min_rows).where(broken.isNull()).drop("history_row")

    long = stored(
        df.groupBy(F.col("Symbol").alias("long_symbol")).agg(F.count(F.lit(1)).alias("symbol_rows"))
        .where(F.col("symbol_rows") > max_rows), "long-histories")
    same = df["Symbol"].eqNullSafe(F.col("long_symbol"))
    short = df.join(lookup(long), same, "left_anti")
    placed = _placed(df.join(lookup(long), same).drop("long_symbol"), df.columns)
    blocks = _blocks(placed, back, ahead, max_rows)
    in_order = Window.partitionBy("Symbol", "block").orderBy("position")
    added = add_columns(blocks, in_order)
    own = F.floor(F.col("position") / F.lit(max_rows)) == F.col("block")
    kept = added.where(own & (F.col("symbol_rows") >= min_rows)).drop("block", "position", "symbol_rows")
    return _added(short, add_columns, whole, min_rows).unionByName(kept)


def in_date_order(df: DataFrame, *groups: str) -> WindowSpec:
    """Rows by date; those of one date by their other columns, so that the order is total
    but for rows equal in everything. Rows without a date come first."""
    rest = [c for c in df.columns if c not in (*groups, "Date")]
    return Window.partitionBy(*groups).orderBy("Date", *rest)


def _added(df: DataFrame, add_columns: AddColumns, in_order: WindowSpec, min_rows: int) -> DataFrame:
    if min_rows <= 1:
        return add_columns(df, in_order)
    # Counted over the ordered window, so that it shares the features' sort.
    counted = df.withColumn("symbol_rows", F.count(F.lit(1)).over(_whole(in_order)))
    added = add_columns(counted, in_order)
    return added.where(F.col("symbol_rows") >= min_rows).drop("symbol_rows")


def _whole(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _placed(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with their ``position`` in the order of their symbol, from 0.

    A range partitioning on the whole order deals even a single day to several
    tasks. What they write is read again, so every row has its place for good:
    the rows of its symbol in parts before its own, and those before it there.
    """
    order = ["Symbol", "Date", *(c for c in columns if c not in ("Symbol", "Date"))]
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({
        "part": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    rows = stored(sorted_, "long-histories")
    before = Window.partitionBy("Symbol").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        rows.groupBy("Symbol", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
        .withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
        .select(F.col("Symbol").alias("its_symbol"), F.col("part").alias("its_part"), "shift")
    )
    same = rows["Symbol"].eqNullSafe(F.col("its_symbol")) & (rows["part"] == F.col("its_part"))
    return rows.join(lookup(parts), same).select(
        *columns, "symbol_rows", (F.col("place") + F.col("shift")).alias("position"))


def _blocks(placed: DataFrame, back: int, ahead: int, max_rows: int) -> DataFrame:
    """Each row once in every block that needs it: its own, and those whose rows
    lie at most ``back`` behind or ``ahead`` before it."""
    size = F.lit(max_rows)
    first = F.greatest(F.floor((F.col("position") - ahead) / size), F.lit(0))
    last = F.least(F.floor((F.col("position") + back) / size),
                   F.floor((F.col("symbol_rows") - 1) / size))
    return placed.withColumn("block", F.explode(F.sequence(first, last)))
