"""Statistics of the target per split, from frames with a ``split`` column."""

from pyspark.sql import Column, DataFrame, functions as F

from barforge.constants import HORIZON
from barforge.functions.ranks import quantile_columns

TARGET = f"LogReturn{HORIZON}"
SUMMARY_QUANTILES = {"p01": 0.01, "p05": 0.05, "median": 0.5, "p95": 0.95, "p99": 0.99}
DISTRIBUTION_QUANTILES = {
    "p01": 0.01, "p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99,
}


def unbiased_skewness(column: str) -> Column:
    """Bias-corrected sample skewness; Spark's built-in is the population one."""
    n = F.count(column).cast("double")
    return F.when(n > 2, F.skewness(column) * F.sqrt(n * (n - 1)) / (n - 2))


def unbiased_kurtosis(column: str) -> Column:
    """Bias-corrected sample excess kurtosis."""
    n = F.count(column).cast("double")
    inner = (n + 1) * F.kurtosis(column) + 6
    return F.when(n > 3, inner * (n - 1) / ((n - 2) * (n - 3)))


def _with_quantiles(df: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """Moments and quantiles per split; ``df`` is read twice, so store one that is costly."""
    basic = df.groupBy("split").agg(
        F.count(TARGET).alias("count"), F.mean(TARGET).alias("mean"),
        F.stddev_samp(TARGET).alias("std"), F.min(TARGET).alias("min"),
        F.max(TARGET).alias("max"))
    found = quantile_columns(df, TARGET, quantiles, ["split"]).withColumnRenamed("split", "split_of")
    return basic.join(found, F.col("split").eqNullSafe(F.col("split_of"))).drop("split_of")


def label_distribution(df: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and seven percentiles per split."""
    return _with_quantiles(df, DISTRIBUTION_QUANTILES)


def label_moments(df: DataFrame) -> DataFrame:
    """Mean, deviation, skewness and kurtosis per split, as sample estimates."""
    return df.groupBy("split").agg(
        F.mean(TARGET).alias("mean"), F.stddev_samp(TARGET).alias("std"),
        unbiased_skewness(TARGET).alias("skewness"), unbiased_kurtosis(TARGET).alias("kurtosis"))


def label_summary_table(df: DataFrame) -> DataFrame:
    """The side-by-side comparison of the splits."""
    return _with_quantiles(df, SUMMARY_QUANTILES)


def binary_balance(df: DataFrame) -> DataFrame:
    """Share of rising and other rows per split and the larger class (tie: 1)."""
    rises = F.col(TARGET) > 0
    counted = df.groupBy("split").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(rises).alias("positives"), F.count_if(~rises).alias("negatives"))
    return counted.withColumns({
        "positive_pct": F.col("positives") / F.col("total"),
        "negative_pct": F.col("negatives") / F.col("total"),
        "majority_class": F.when(F.col("positives") >= F.col("negatives"), 1).otherwise(0),
    })
