"""Mergeable moments: (n, mean, M2, M3, M4) of a column, stored by group and merged later without the rows.

``moments`` makes one state per group in a single aggregation, ``merged_moments`` adds states
up, and ``from_moments`` reads mean, deviation, skewness and kurtosis off them. Sums are
taken about a center near the values, never about zero, so that a large common offset costs no
digits: ``moments`` takes it from the group's mean (two passes over the column), merging from
the states' own means.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from barforge.functions.blocks import key_equals
from barforge.functions.history import lookup

STATE = ["n", "mean", "m2", "m3", "m4"]


def moments(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """A state per group of ``by``: count, mean and the sums of the second to fourth powers of the deviations.

    NULL and NaN are left out; a group without values has n = 0 and no mean. A missing key is a key.
    The mean is found first, so the powers are of plain deviations.
    """
    by = list(by)
    x = F.col(column).cast("double")
    known = df.select(*by, F.when(~F.isnan(x), x).alias("x"))
    means = known.groupBy(*(F.col(c).alias(f"{c}_of") for c in by)).agg(F.avg("x").alias("center"))
    centred = (known.join(lookup(means), key_equals(by)) if by else known.crossJoin(F.broadcast(means))).select(*by, "center", (
        F.col("x") - F.col("center")).alias("d"))
    sums = centred.groupBy(*by).agg(
        F.count("d").alias("n"), F.max("center").alias("center"),
        *(F.coalesce(F.sum(F.pow("d", F.lit(float(p)))), F.lit(0.0)).alias(f"s{p}") for p in (1, 2, 3, 4)))
    return _about_mean(sums, by)


def merged_moments(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One state per group of ``by`` from the states of smaller groups, in any order and in any number of steps.

    The powers are moved to a common center, the states' weighted mean, before they are summed.
    """
    by = list(by)
    weight = F.col("n") * F.col("mean")
    # A center near all means; exact to nothing in particular, the shift below makes up for it.
    centers = states.groupBy(*(F.col(c).alias(f"{c}_of") for c in by)).agg(F.try_divide(F.sum(weight), F.sum(
        F.when(F.col("mean").isNotNull(), F.col("n")))).alias("center"))
    placed = states.join(lookup(centers), key_equals(by)) if by else states.crossJoin(F.broadcast(centers))
    n, d = F.col("n"), F.col("mean") - F.col("center")
    m2, m3, m4 = (F.col(c) for c in STATE[2:])
    sums = placed.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.max("center").alias("center"),
        *(F.coalesce(F.sum(s), F.lit(0.0)).alias(name) for name, s in {
            "s1": n * d,
            "s2": m2 + n * d * d,
            "s3": m3 + 3 * d * m2 + n * d * d * d,
            "s4": m4 + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d}.items()))
    return _about_mean(sums, by)


def _about_mean(sums: DataFrame, by: list[str]) -> DataFrame:
    """States from power sums about a center: what rounding has left of the first power moves it to the mean."""
    n = F.col("n")
    shift = F.try_divide(F.col("s1"), n)
    s2, s3, s4 = (F.col(f"s{p}") for p in (2, 3, 4))
    return sums.select(
        *by, n, (F.col("center") + shift).alias("mean"),
        F.coalesce(s2 - n * shift * shift, F.lit(0.0)).alias("m2"),
        F.coalesce(s3 - 3 * shift * s2 + 2 * n * F.pow(shift, F.lit(3.0)), F.lit(0.0)).alias("m3"),
        F.coalesce(s4 - 4 * shift * s3 + 6 * shift * shift * s2 - 3 * n * F.pow(shift, F.lit(4.0)), F.lit(0.0)).alias("m4"))


def from_moments() -> list[Column]:
    """mean, std, skewness and kurtosis of a state, the last three as sample estimates; missing where too few rows tell."""
    n, m2, m3, m4 = (F.col(c).cast("double") for c in ("n", "m2", "m3", "m4"))
    variance = F.when(n > 1, m2 / (n - 1))
    spread = F.when(m2 > 0, m2)
    skew = F.when(n > 2, n * F.sqrt(n - 1) / (n - 2) * m3 / F.pow(spread, F.lit(1.5)))
    flat = n * (n + 1) * (n - 1) / ((n - 2) * (n - 3)) * m4 / (spread * spread) - 3 * (n - 1) * (n - 1) / ((n - 2) * (n - 3))
    return [F.col("mean"), F.sqrt(variance).alias("std"), skew.alias("skewness"), F.when(n > 3, flat).alias("kurtosis")]
