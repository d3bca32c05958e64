"""Sketches stored as columns: quantiles and distinct counts merged later without the rows.

A state is one binary value per group, made by partial aggregation, so that no task gets a
group's rows. States of months or symbols are merged in any order. Both are Spark's
own sketch aggregates; here they get errors that are told, stored tables and reads of many
columns at once.

Quantile sketches (KLL) answer with values of the data whose rank is off by at most about
``rank_error`` of the rows with 99 % confidence, distinct counts (HyperLogLog) are off by ``count_error``.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

QUANTILE_K = 800  # size of a quantile sketch, in retained values
COUNT_LOG = 12  # log2 of the registers of a distinct count


def rank_error(k: int = QUANTILE_K) -> float:
    """Normalised rank error of one quantile at 99 % confidence, the published fit for this sketch."""
    return 2.296 / k ** 0.9021


def count_error(log: int = COUNT_LOG) -> float:
    """Relative error of a distinct count at 99 % confidence (2.6 standard errors)."""
    return 2.6 * 1.04 / 2 ** (log / 2)


def sketched(df: DataFrame, by: Sequence[str], quantiles: Sequence[str] = (), distinct: Sequence[str] = (),
             k: int = QUANTILE_K, log: int = COUNT_LOG) -> DataFrame:
    """One row per group: ``n`` rows, ``q_<column>`` for each of ``quantiles`` and ``d_<column>`` for each of ``distinct``.

    NULL and NaN enter no quantile sketch, NULL no distinct count. A group without values has a missing sketch.
    """
    number = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.when(F.count(number(c)) > 0, F.kll_sketch_agg_double(number(c), F.lit(k))).alias(f"q_{c}") for c in quantiles),
        *(F.when(F.count(c) > 0, F.hll_sketch_agg(F.col(c).cast("string"), F.lit(log))).alias(f"d_{c}") for c in distinct))


def merged_sketches(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of larger groups from those of smaller ones, in any number of steps."""
    quantiles = [c for c in states.columns if c.startswith("q_") and c not in by]
    distinct = [c for c in states.columns if c.startswith("d_") and c not in by]
    return states.groupBy(*by).agg(
        F.sum("n").alias("n"),
        *(F.when(F.count(c) > 0, F.kll_merge_agg_double(c)).alias(c) for c in quantiles),
        *(F.when(F.count(c) > 0, F.hll_union_agg(c, F.lit(False))).alias(c) for c in distinct))


def sketch_quantiles(states: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Rows (*by, column, probability, value): each quantile sketch read at each probability."""
    columns = [c for c in states.columns if c.startswith("q_") and c not in by]
    long = states.select(*by, F.explode(F.array(*(F.struct(F.lit(c[2:]).alias("column"), F.col(c).alias("sketch")) for c in columns))).alias("s"))
    # The probability must be a constant of the expression.
    read = F.array(*(F.struct(F.lit(float(p)).alias("probability"), F.kll_sketch_get_quantile_double("s.sketch", F.lit(float(p))).alias("value"))
                     for p in probabilities))
    return long.where("s.sketch is not null").select(*by, "s.column", F.inline(read))


def sketch_counts(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Columns ``by`` and the estimated distinct count of each counted column; none counts 0."""
    columns = [c for c in states.columns if c.startswith("d_") and c not in by]
    return states.select(*by, *(F.coalesce(F.hll_sketch_estimate(c), F.lit(0)).alias(c[2:]) for c in columns))
