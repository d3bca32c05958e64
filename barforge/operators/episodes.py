"""Drawdown episodes: several rows out of one ordered history.

An episode begins at a peak (the last row of the highest close so far), runs while closes
stay below it and ends at the first close that reaches it again; one that
does not is open. Between peak and recovery lies the trough, the first row of the lowest close.

The running maximum is the only thing a row must know of those before it, so a history of
more than ``max_rows`` rows is cut into blocks, each of which is handed the maximum of all blocks
before it; episodes are then sums over rows of equal peak, which run over block borders.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from barforge.functions.blocks import key_equals, placed_in_order, split_by_size
from barforge.functions.history import MAX_ROWS_PER_TASK, in_date_order

KEYS = ["Symbol"]


def drawdown_episodes(bars: DataFrame, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Symbol, peak_date, peak, trough_date, trough, depth, recovery_date, n_rows of every episode.

    ``depth`` is trough over peak minus one; ``n_rows`` counts the closes below the peak; an open
    episode has no ``recovery_date``. Rows without a date or close (NULL or NaN) are left out; a missing symbol is a
    symbol. Rows of one date are taken in the order of their other columns.
    """
    rows = bars.where(F.col("Date").isNotNull() & F.col("Close").isNotNull() & ~F.isnan("Close"))
    order = ["Date", *(c for c in rows.columns if c not in ("Symbol", "Date"))]
    so_far = (Window.unboundedPreceding, -1)

    def told(df: DataFrame, window, before: Column | None) -> DataFrame:
        """Rows with the highest close before them."""
        highest = F.max("Close").over(window.rowsBetween(*so_far))
        return df.withColumn("peak", highest if before is None else F.greatest(highest, before))

    short, long = split_by_size(rows, KEYS, max_rows)
    parts = [told(short, in_date_order(short, *KEYS), None).select("Symbol", "Date", "Close", "peak")]
    if long is not None:
        blocks = placed_in_order(long, KEYS, order).withColumn("block", F.floor(F.col("position") / F.lit(max_rows)))
        sequence = Window.partitionBy("Symbol").orderBy("block").rowsBetween(*so_far)
        tops = blocks.groupBy("Symbol", "block").agg(F.max("Close").alias("top"))
        handed = tops.select(F.col("Symbol").alias("Symbol_of"), F.col("block").alias("block_of"), F.max("top").over(sequence).alias("handed"))
        joined = blocks.join(handed, key_equals(KEYS) & (F.col("block") == F.col("block_of")))
        parts.append(told(joined, Window.partitionBy("Symbol", "block").orderBy("position"), F.col("handed")).select("Symbol", "Date", "Close", "peak"))
    every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return _summed(every)


def _summed(rows: DataFrame) -> DataFrame:
    """Episodes from rows with the highest close before them: rows of a symbol that share it belong together.

    A close equal to the peak ends one episode and begins the next, so a level may come back:
    its visits number the episodes. That number is a count over rows of that level alone.
    """
    # Of each level: closes below it, and the closes that reach it, which separate its episodes.
    level = F.when(F.col("peak").isNull() | (F.col("Close") >= F.col("peak")), F.col("Close")).otherwise(F.col("peak"))
    reaches = F.col("peak").isNull() | (F.col("Close") >= F.col("peak"))
    marked = rows.select("Symbol", "Date", "Close", "peak", level.alias("level"), reaches.alias("reaches"))
    # The highest closes rise, so levels are in order of time: the row that passes a level ends its last episode.
    visits = Window.partitionBy("Symbol", "level").orderBy("Date", F.col("reaches").desc()).rowsBetween(Window.unboundedPreceding, 0)
    numbered = marked.withColumn("visit", F.count_if("reaches").over(visits))
    below = ~F.col("reaches")
    episodes = numbered.groupBy("Symbol", "level", "visit").agg(
        F.max(F.when(F.col("reaches"), F.col("Date"))).alias("peak_date"),
        F.min(F.when(below, F.struct("Close", "Date"))).alias("low"), F.count_if(below).alias("n_rows"))
    # What ends an episode: the next visit of its level, or else the row that first passed the level.
    again = episodes.select(F.col("Symbol").alias("Symbol_of"), F.col("level").alias("level_of"),
                            (F.col("visit") - 1).alias("visit_of"), F.col("peak_date").alias("again"))
    passed = marked.where(F.col("reaches") & (F.col("Close") > F.col("peak"))).groupBy(
        F.col("Symbol").alias("Symbol_of"), F.col("peak").alias("level_of")).agg(F.min("Date").alias("passed"))
    ended = (episodes.where("n_rows > 0")
             .join(again, key_equals(["Symbol", "level", "visit"]), "left").drop("Symbol_of", "level_of", "visit_of")
             .join(passed, key_equals(["Symbol", "level"]), "left"))
    return ended.select(
        "Symbol", "peak_date", F.col("level").alias("peak"), F.col("low.Date").alias("trough_date"), F.col("low.Close").alias("trough"),
        (F.col("low.Close") / F.col("level") - 1).alias("depth"), F.coalesce("again", "passed").alias("recovery_date"), "n_rows")
