"""Profile of a bars table: shape, gaps, duplicates, ranges, distributions.

Aggregates combine before the shuffle; top lists are limits of a sort, which
keep only their few rows per task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from barforge.constants import NUMERIC_COLUMNS, PRICE_COLUMNS
from barforge.functions.ranks import by_name, exact_quantiles
from barforge.operators.coverage import describe_counts

QUANTILES = (0.01, 0.05, 0.5, 0.95, 0.99, 0.999)
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
SHORT_HISTORIES = (30, 40, 60)


def _rows(names_and_values: dict[str, Column], name: str, value: str) -> Column:
    """Expression that turns named values of one row into rows."""
    return F.inline(F.array(*(
        F.struct(F.lit(n).alias(name), v.alias(value)) for n, v in names_and_values.items())))


def _known(name: str) -> Column:
    """The value, NULL for NaN, which would compare as larger than any number."""
    return F.nanvl(name, F.lit(None).cast("double"))


def table_shape(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and the table's row count."""
    fields = F.array(*(
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("type"))
        for i, f in enumerate(df.schema.fields)))
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.inline(fields), "rows")


def head_rows(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.orderBy("Symbol", "Date").limit(rows)


def tail_rows(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.orderBy(F.desc("Symbol"), F.desc("Date")).limit(rows)


def null_counts(df: DataFrame) -> DataFrame:
    """NULL (or NaN) values per column, in one pass."""
    def missing(name: str, kind: str) -> Column:
        empty = F.col(name).isNull()
        return empty | F.isnan(name) if kind in ("double", "float") else empty

    counted = df.agg(*(F.count_if(missing(c, t)).alias(c) for c, t in df.dtypes))
    return counted.select(_rows({c: F.col(c) for c in df.columns}, "column", "nulls"))


def empty_string_counts(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    counted = df.agg(*(F.count_if(F.col(c) == "").alias(c) for c in texts))
    return counted.select(_rows({c: F.col(c) for c in texts}, "column", "empty_strings"))


def duplicate_count(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each group of equal rows (or equal keys).

    Copies combine before the shuffle, however many there are of one row.
    """
    groups = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("Date").alias("first_date"), F.max("Date").alias("last_date"),
                  F.count_if(F.col("Date").isNull()).alias("null_dates"))


def symbol_date_ranges(df: DataFrame) -> DataFrame:
    return df.groupBy("Symbol").agg(
        F.min("Date").alias("first_date"), F.max("Date").alias("last_date"),
        F.count("Date").alias("dates"))


def earliest_symbols(df: DataFrame, top: int = 10) -> DataFrame:
    ranges = symbol_date_ranges(df).where(F.col("first_date").isNotNull())
    return ranges.orderBy("first_date", "Symbol").limit(top).select("Symbol", "first_date")


def latest_symbols(df: DataFrame, top: int = 10) -> DataFrame:
    """Symbols that start last; ties in reverse order of symbol."""
    ranges = symbol_date_ranges(df).where(F.col("first_date").isNotNull())
    return ranges.orderBy(
        F.desc("first_date"), F.desc("Symbol")).limit(top).select("Symbol", "first_date")


def end_month_counts(df: DataFrame) -> DataFrame:
    """Symbols per month of their last bar, most first."""
    ranges = symbol_date_ranges(df).where(F.col("last_date").isNotNull())
    month = F.date_format("last_date", "yyyy-MM").alias("month")
    return ranges.groupBy(month).agg(F.count(F.lit(1)).alias("symbols")).orderBy(
        F.desc("symbols"), "month")


def column_summary(df: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles per number column; count,
    distinct values, most frequent value (tie: smallest) and its frequency of the
    symbol."""
    quartiles = exact_quantiles(df, NUMERIC_COLUMNS, list(QUARTILES.values()))
    # All numbers in one pass; one row is then turned into a row per column.
    measures = {"count": F.count, "mean": F.mean, "std": F.stddev_samp, "min": F.min, "max": F.max}
    numbers = df.agg(*(
        F.struct(F.lit(c).alias("column"), *(
            measure(_known(c)).alias(name) for name, measure in measures.items())).alias(c)
        for c in NUMERIC_COLUMNS)).select(F.inline(F.array(*NUMERIC_COLUMNS)))
    symbols = df.where(F.col("Symbol").isNotNull()).groupBy("Symbol").agg(
        F.count(F.lit(1)).alias("n"))
    # The most frequent symbol comes with the totals: the least of (-rows, symbol).
    texts = symbols.agg(
        F.lit("Symbol").alias("column"), F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"), F.max("n").alias("freq"),
        F.min(F.struct(-F.col("n"), F.col("Symbol").alias("top")))["top"].alias("top"))
    return numbers.join(by_name(quartiles, QUARTILES, ["column"]), "column", "left").unionByName(
        texts, allowMissingColumns=True)


def date_summary(df: DataFrame) -> DataFrame:
    """Count, mean, extremes and quartiles of the dates."""
    seconds = df.where(F.col("Date").isNotNull()).select(
        F.unix_micros(F.col("Date").cast("timestamp")).cast("double").alias("micros"))
    kind = df.schema["Date"].dataType
    quartiles = exact_quantiles(seconds, ["micros"], list(QUARTILES.values()))
    one_row = by_name(quartiles, QUARTILES, []).select(F.struct(*QUARTILES)).scalar()
    summary = seconds.agg(
        F.count("micros").alias("count"), F.mean("micros").alias("mean"),
        F.min("micros").alias("min"), F.max("micros").alias("max"),
    ).withColumn("quartiles", one_row).select("*", "quartiles.*")

    def as_date(name: str) -> Column:
        # Whole seconds, so a mean between two days does not depend on float noise.
        return F.timestamp_seconds(F.floor(F.col(name) / 1e6)).cast(kind).alias(name)

    return summary.select("count", *map(as_date, ("mean", "min", "p25", "p50", "p75", "max")))


def _checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("total"), *(
        F.count_if(c).alias(name) for name, c in checks.items()))
    return counted.select("total", _rows(
        {n: F.col(f"`{n}`") for n in checks}, "check", "rows")
    ).select("check", "rows", F.try_divide("rows", "total").alias("share"))


def invalid_value_checks(df: DataFrame) -> DataFrame:
    checks = {f"{c} <= 0": _known(c) <= 0 for c in PRICE_COLUMNS}
    checks |= {"Volume < 0": _known("Volume") < 0, "Volume == 0": _known("Volume") == 0}
    return _checks(df, checks)


def ohlc_violation_checks(df: DataFrame) -> DataFrame:
    checks = {f"High < {c}": _known("High") < _known(c) for c in ("Open", "Close", "Low")}
    checks |= {f"Low > {c}": _known("Low") > _known(c) for c in ("Open", "Close")}
    return _checks(df, checks)


def numeric_quantiles(df: DataFrame, probabilities: Sequence[float] = QUANTILES) -> DataFrame:
    """One row per probability, one column per price column and the volume."""
    columns = [*PRICE_COLUMNS, "Volume"]
    long = exact_quantiles(df, columns, probabilities)
    return long.groupBy("probability").agg(*(
        F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns))


def symbol_count(df: DataFrame) -> DataFrame:
    return df.agg(F.countDistinct("Symbol").alias("symbols"))


def rows_per_symbol(df: DataFrame) -> DataFrame:
    return df.where(F.col("Symbol").isNotNull()).groupBy("Symbol").agg(
        F.count(F.lit(1)).alias("rows"))


def rows_per_symbol_stats(df: DataFrame) -> DataFrame:
    return describe_counts(rows_per_symbol(df), "rows")


def top_symbols(df: DataFrame, top: int = 10) -> DataFrame:
    return rows_per_symbol(df).orderBy(F.desc("rows"), "Symbol").limit(top)


def short_history_counts(df: DataFrame, limits: Sequence[int] = SHORT_HISTORIES) -> DataFrame:
    """Symbols with fewer rows than each limit."""
    counted = rows_per_symbol(df).agg(*(
        F.count_if(F.col("rows") < n).alias(str(n)) for n in limits))
    return counted.select(F.inline(F.array(*(
        F.struct(F.lit(n).cast("bigint").alias("fewer_than"), F.col(f"`{n}`").alias("symbols"))
        for n in limits))))


def symbol_span_stats(df: DataFrame) -> DataFrame:
    """Distribution of the days between a symbol's first and last bar."""
    spans = symbol_date_ranges(df.where(F.col("Symbol").isNotNull())).select(
        F.datediff("last_date", "first_date").alias("span_days"))
    return describe_counts(spans, "span_days")


def rows_per_year(df: DataFrame) -> DataFrame:
    dated = df.where(F.col("Date").isNotNull())
    return dated.groupBy(F.year("Date").alias("year")).agg(
        F.count(F.lit(1)).alias("rows")).orderBy("year")


def active_symbols_per_year(df: DataFrame) -> DataFrame:
    dated = df.where(F.col("Date").isNotNull())
    return dated.groupBy(F.year("Date").alias("year")).agg(
        F.countDistinct("Symbol").alias("symbols")).orderBy("year")
