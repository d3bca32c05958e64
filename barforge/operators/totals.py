"""Aggregates for several groupings at once: all subtotals from one scan.

Each row is expanded to the groupings asked for and combined before the one shuffle.
``level`` says which keys a row sums over, bit by bit as ``grouping_id`` does, so a missing
key is told from a total.
"""

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

TOTAL = "(all)"


def cube_sets(keys: Sequence[str]) -> list[list[str]]:
    """All subsets of ``keys``."""
    return [list(c) for k in range(len(keys), -1, -1) for c in combinations(keys, k)]


def rollup_sets(keys: Sequence[str]) -> list[list[str]]:
    """``keys`` and each shorter beginning of them."""
    return [list(keys[:k]) for k in range(len(keys), -1, -1)]


def grouped_totals(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], sets: Sequence[Sequence[str]] | None = None,
                   named: bool = False) -> DataFrame:
    """``keys``, ``level`` and ``aggregates`` for every group of every set of keys; by default of all subsets.

    Bit i of ``level``, counted from the last key, is 1 where that key is summed over; the key is then
    missing, or with ``named`` (which makes keys strings) the word ``TOTAL``. A table without rows has no groups, and
    no total either.
    """
    keys = list(keys)
    sets = cube_sets(keys) if sets is None else [list(s) for s in sets]
    unknown = {c for s in sets for c in s} - set(keys)
    if unknown:
        raise ValueError(f"not among the keys: {', '.join(sorted(unknown))}")
    columns = [[F.col(c) for c in s] for s in sets]
    grouped = df.groupingSets(columns, *(F.col(c) for c in keys)).agg(
        F.grouping_id().cast("bigint").alias("level"), F.count(F.lit(1)).alias("__rows"), *aggregates)
    told = grouped.where("__rows > 0").drop("__rows")
    if not named:
        return told.select(*keys, "level", *(c for c in told.columns if c not in (*keys, "level")))
    names = [F.when(F.getbit("level", F.lit(len(keys) - 1 - i)) == 1, F.lit(TOTAL)).otherwise(F.col(c).cast("string")).alias(c)
             for i, c in enumerate(keys)]
    return told.select(*names, "level", *(c for c in told.columns if c not in (*keys, "level")))
