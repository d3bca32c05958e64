"""Row cleaning and the short-history filter."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from barforge.constants import MIN_ROWS, PRICE_COLUMNS


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def drop_null_prices(df: DataFrame) -> DataFrame:
    """Drop rows without a full set of prices (NULL or NaN)."""
    return df.dropna(subset=PRICE_COLUMNS)


def keep_positive(df: DataFrame) -> DataFrame:
    """Keep rows with prices above zero and a volume of zero or more.

    A comparison with NULL is not true, so rows without a volume go as well.
    """
    return df.where(_all([F.col(c) > 0 for c in PRICE_COLUMNS] + [F.col("Volume") >= 0]))


def keep_consistent(df: DataFrame) -> DataFrame:
    """Keep rows whose high is the highest and whose low is the lowest price."""
    highest = [F.col("High") >= F.col(c) for c in ("Open", "Close", "Low")]
    lowest = [F.col("Low") <= F.col(c) for c in ("Open", "Close")]
    return df.where(_all(highest + lowest))


def clean_market_data(df: DataFrame) -> DataFrame:
    return keep_consistent(keep_positive(df))


def filter_symbols_by_min_rows(df: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Keep the rows of symbols that have at least ``min_rows`` of them.

    Counts combine before the shuffle, and a semi join lets the engine pick a
    broadcast for few symbols or split an oversized one. Where a window over
    the same symbols follows, ``over_history`` takes ``min_rows`` itself.
    """
    enough = df.groupBy("Symbol").count().where(F.col("count") >= min_rows).select("Symbol")
    return df.join(enough, "Symbol", "left_semi")
