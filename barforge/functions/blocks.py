"""Long sequences cut into blocks of their order, so that no task gets a whole one.

``over_history`` does this for windows that look a fixed number of rows back. Here are
the parts for operators that hand a state from block to block instead.
"""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from barforge.functions.history import lookup
from barforge.functions.storage import stored


def key_equals(keys: Sequence[str]) -> Column:
    """Equality of ``keys`` with their namesakes that end in ``_of``; missing equals missing."""
    return reduce(and_, (F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in keys))


def split_by_size(df: DataFrame, keys: Sequence[str], max_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of keys with at most ``max_rows`` rows, and those of all others (None if there are none)."""
    sizes = df.groupBy(*(F.col(k).alias(f"{k}_of") for k in keys)).agg(F.count(F.lit(1)).alias("rows_of"))
    long = stored(sizes.where(F.col("rows_of") > max_rows), "long-keys")
    if long.isEmpty():
        return df, None
    same = key_equals(keys)
    return df.join(lookup(long), same, "left_anti"), df.join(lookup(long), same, "left_semi")


def placed_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``position``, the place of each row in the order of its key, from 0.

    A range partitioning on key and order deals one key to many tasks. What they write is
    read again, so that places hold; a part's rows before are counted, never gathered.
    """
    by = [*keys, *order]
    dealt = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumns(
        {"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    rows = stored(dealt, "placed-rows")
    before = Window.partitionBy(*(f"{k}_of" for k in keys)).orderBy("part_of").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        rows.groupBy(*(F.col(k).alias(f"{k}_of") for k in keys), F.col("part").alias("part_of"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
        .withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
        .drop("n", "first"))
    joined = rows.join(lookup(parts), key_equals(keys) & (F.col("part") == F.col("part_of")))
    return joined.select(*df.columns, (F.col("place") + F.col("shift")).alias("position"))
