"""How symbols and rows of the later splits are covered by the training data.

Everything derives from one small table, rows per symbol and split: its
aggregation combines before the shuffle, so a symbol with very many rows does
not weigh on one task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from barforge.constants import ELIGIBLE_MIN_ROWS, HISTORY_THRESHOLDS, SPLITS

COUNTS = ["train_rows", "val_rows", "test_rows"]


def symbol_split_counts(df: DataFrame) -> DataFrame:
    """One row per symbol: rows in each split (0 where it has none) and in all."""
    rows = {name: F.count_if(F.col("split") == split) for name, split in zip(COUNTS, SPLITS)}
    return df.groupBy("Symbol").agg(
        *(count.alias(name) for name, count in rows.items()),
        F.count_if(F.col("split").isin(*SPLITS)).alias("total_rows"))


def symbols_per_split(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.countDistinct("Symbol").alias("symbols"))


def _seen(name: str) -> Column:
    return F.col(name) > 0


def symbol_overlap(counts: DataFrame) -> DataFrame:
    """Sizes of the pairwise intersections and the share seen in training."""
    train, val, test = (_seen(c) for c in COUNTS)
    sized = counts.agg(
        F.count_if(val & train).alias("val_and_train"),
        F.count_if(test & train).alias("test_and_train"),
        F.count_if(test & val).alias("test_and_val"),
        F.count_if(val).alias("val_symbols"), F.count_if(test).alias("test_symbols"))
    return sized.select(
        "val_and_train", "test_and_train", "test_and_val",
        F.try_divide("val_and_train", "val_symbols").alias("val_seen_share"),
        F.try_divide("test_and_train", "test_symbols").alias("test_seen_share"))


def new_symbols(counts: DataFrame) -> DataFrame:
    """Symbols of the later splits that training does not have, with the split."""
    untrained = counts.where(~_seen("train_rows"))
    later = F.array(F.struct(F.lit("validation").alias("split"), F.col("val_rows").alias("rows")),
                    F.struct(F.lit("test").alias("split"), F.col("test_rows").alias("rows")))
    return untrained.select("Symbol", F.inline(later)).where("rows > 0").select("split", "Symbol")


def _covered(by: Column) -> list[Column]:
    """Rows of the later splits whose symbols meet a condition, and their share."""
    columns = []
    for name, total in (("val", "val_rows"), ("test", "test_rows")):
        covered, rows = F.sum(F.when(by, F.col(total)).otherwise(0)), F.sum(total)
        columns += [covered.alias(f"{name}_covered"), rows.alias(f"{name}_rows"),
                    F.try_divide(covered, rows).alias(f"{name}_share")]
    return columns


def rows_seen_in_train(counts: DataFrame) -> DataFrame:
    """Rows of the later splits that belong to symbols seen in training."""
    return counts.agg(*_covered(_seen("train_rows")))


def history_coverage(
    counts: DataFrame, thresholds: Sequence[int] = HISTORY_THRESHOLDS
) -> DataFrame:
    """Rows covered by symbols with at least ``threshold`` training rows."""
    levels = F.explode(F.array(*(F.lit(t).cast("bigint") for t in thresholds)))
    return counts.withColumn("threshold", levels).groupBy("threshold").agg(
        *_covered(F.col("train_rows") >= F.col("threshold")))


def describe_counts(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Distribution of a whole-number column of counts or days, per group.

    ``percentile`` keeps one entry per distinct value. Row counts that add up to
    N take at most sqrt(2N) distinct values and day spans fewer than the days of
    the calendar, so that stays small; use ``exact_quantiles`` for real numbers.
    """
    value = F.col(column)
    quartiles = F.percentile(column, [0.25, 0.5, 0.75])
    return df.groupBy(*by).agg(
        F.count(column).alias("count"), F.mean(column).alias("mean"),
        F.stddev_samp(column).alias("std"), F.min(value.cast("double")).alias("min"),
        quartiles[0].alias("p25"), quartiles[1].alias("p50"), quartiles[2].alias("p75"),
        F.max(value.cast("double")).alias("max"))


def rows_by_split(df: DataFrame) -> DataFrame:
    """Rows of each symbol within each split it occurs in."""
    return df.groupBy("split", "Symbol").agg(F.count(F.lit(1)).alias("rows"))


def split_symbol_row_stats(df: DataFrame) -> DataFrame:
    return describe_counts(rows_by_split(df), "rows", ["split"])


def top_symbols_by_split(
    df: DataFrame, top: int = 10, splits: Sequence[str] = ("validation", "test")
) -> DataFrame:
    """Symbols with the most rows in each later split; ties by symbol.

    The rank limit is applied within tasks before the shuffle by split.
    """
    most = Window.partitionBy("split").orderBy(F.desc("rows"), "Symbol")
    ranked = rows_by_split(df.where(F.col("split").isin(*splits))).withColumn(
        "rank", F.row_number().over(most))
    return ranked.where(F.col("rank") <= top)


def eligible_symbols(counts: DataFrame, minimums: dict[str, int] | None = None) -> DataFrame:
    """Symbols with enough rows in every split."""
    minimums = ELIGIBLE_MIN_ROWS | (minimums or {})
    for column, split in zip(COUNTS, SPLITS):
        counts = counts.where(F.col(column) >= minimums[split])
    return counts


def eligible_share(counts: DataFrame, minimums: dict[str, int] | None = None) -> DataFrame:
    minimums = ELIGIBLE_MIN_ROWS | (minimums or {})
    enough = F.lit(True)
    for column, split in zip(COUNTS, SPLITS):
        enough = enough & (F.col(column) >= minimums[split])
    sized = counts.agg(F.count_if(enough).alias("eligible"), F.count(F.lit(1)).alias("symbols"))
    return sized.withColumn("share", F.try_divide("eligible", "symbols"))


def eligible_stats(eligible: DataFrame) -> DataFrame:
    """Distribution of each count column over the eligible symbols."""
    long = eligible.unpivot([], [*COUNTS, "total_rows"], "column", "rows")
    return describe_counts(long, "rows", ["column"])


def eligible_top(eligible: DataFrame, top: int = 10) -> DataFrame:
    return eligible.orderBy(F.desc("total_rows"), "Symbol").limit(top)


def eligible_bottom(eligible: DataFrame, top: int = 10) -> DataFrame:
    return eligible.orderBy(*COUNTS, "Symbol").limit(top)
