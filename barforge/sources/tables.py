"""Bars derived from tables of trades or events.

A bar's open and close are the values of its first and last row in a total
order; they are found by aggregation, which combines before the shuffle, rather
than by numbering rows in a window.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _bars(df: DataFrame, group: list[Column], symbol: Column, price: str, order: list[str],
          volume: Column) -> DataFrame:
    """Bars per group, whose first columns make up the symbol and the last is ``Date``."""
    position = F.struct(*order)
    bars = df.groupBy(*group).agg(
        F.min_by(price, position).alias("Open"), F.max(price).alias("High"),
        F.min(price).alias("Low"), F.max_by(price, position).alias("Close"),
        volume.alias("Volume"))
    return bars.select(symbol.alias("Symbol"), "Date", "Open", "High", "Low", "Close", "Volume",
                       F.lit(0.0).alias("OpenInt"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def _line_bars(spark: SparkSession, sf_dir: str, parts: list[str]) -> DataFrame:
    # Some orders count as halted: their lines have no volume.
    halted = F.col("l_orderkey") % 89 == 0
    return _bars(
        _lines(spark, sf_dir), [*map(F.col, parts), F.col("l_shipdate").alias("Date")],
        F.concat_ws("-", *(F.col(c).cast("string") for c in parts)), "l_extendedprice",
        ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"],
        F.sum(F.when(halted, 0.0).otherwise(F.col("l_quantity"))))


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bar per supplier and shipping day."""
    return _line_bars(spark, sf_dir, ["l_suppkey"])


def supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per line: no fewer per symbol than bars, and one column to read."""
    return _lines(spark, sf_dir).select(F.col("l_suppkey").cast("string").alias("Symbol"))


def class_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bar per supplier, line class and shipping day: many short histories
    that begin and end at different times."""
    return _line_bars(spark, sf_dir, ["l_suppkey", "l_returnflag", "l_linestatus"])


def flawed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier bars with every kind of flaw that cleaning and profiling look for:
    zero, missing and inconsistent prices, negative volumes, copies, no symbol."""
    kind = (F.col("Symbol").cast("int") * 31 + F.dayofyear("Date")) % 97
    day = F.dayofyear("Date")

    def flaw(number: int, value, name: str) -> Column:
        return F.when(kind == number, value).otherwise(F.col(name))

    return supplier_bars(spark, sf_dir).select(
        F.when((kind == 6) & (day % 2 == 0), "").otherwise(F.col("Symbol")).alias("Symbol"),
        "Date",
        F.when(kind == 0, 0.0).when(kind == 7, None).otherwise(F.col("Open")).alias("Open"),
        flaw(2, F.col("Low") - 1.0, "High").alias("High"),
        flaw(1, -1.0, "Low").alias("Low"),
        flaw(3, F.col("High") + 1.0, "Close").alias("Close"),
        flaw(4, -1.0, "Volume").alias("Volume"), "OpenInt",
        F.explode(F.array_repeat(F.lit(1), F.when(kind == 5, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bar per event type and hour."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    hour = F.date_trunc("hour", "ts").cast(events.schema["ts"].dataType)
    return _bars(events, [F.col("event_type"), hour.alias("Date")], F.col("event_type"), "value",
                 ["ts", "event_id"], F.count(F.lit(1)).cast("double"))
