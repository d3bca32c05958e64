"""Exact order statistics without gathering a column in one task.

Equal values are counted first, which combines before the shuffle. The distinct
values are then dealt out by value ranges of even size, however close together they
lie, and stored; the counts of the ranges say how many rows lie before each, and
only the order within a range is left to a window.
"""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from barforge.functions.history import lookup
from barforge.functions.storage import stored


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of keys where missing equals missing; ``right`` names them with ``_of``."""
    return reduce(and_, (left[k].eqNullSafe(right[f"{k}_of"]) for k in keys))


def _renamed(df: DataFrame, keys: Sequence[str], *columns: str) -> DataFrame:
    return df.select(*(F.col(k).alias(f"{k}_of") for k in keys), *columns)


def _ranged(tally: DataFrame, keys: Sequence[str], count: str) -> tuple[DataFrame, DataFrame]:
    """Distinct values with the ``part`` that holds them, and per key and part the sums of
    ``count``: ``rows`` in it, those ``before`` it and those of the whole key, ``n``."""
    # Ranges are found from a sample of what is dealt: stored, the tally is counted once only.
    dealt = stored(tally, "tally").repartitionByRange(*keys, "value").withColumn("part", F.spark_partition_id())
    values = stored(dealt, "ranged")
    in_order = Window.partitionBy(*keys).orderBy("part")
    parts = (
        values.groupBy(*keys, "part").agg(F.sum(count).alias("rows"))
        .withColumn("before", F.sum("rows").over(in_order) - F.col("rows"))
        .withColumn("n", F.sum("rows").over(Window.partitionBy(*keys)))
    )
    return values, stored(parts, "parts")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Linearly interpolated quantiles as rows (*by, column, probability, value).

    NULL and NaN are left out; a missing group is a group. ``df`` is read once.
    """
    keys = [*by, "column"]
    tally = (
        df.select(*by, *(F.col(c).cast("double").alias(c) for c in columns))
        .unpivot(list(by), list(columns), "column", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("same"))
    )
    values, parts = _ranged(tally, keys, "same")

    # The one or two ranks of each probability, in the parts that hold them.
    exact = F.col("probability") * (F.col("n") - 1)
    held = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("rows"))
    wanted = (
        parts.withColumn(
            "probability", F.explode(F.array(*(F.lit(float(p)) for p in probabilities))))
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor(exact), F.ceil(exact)))))
        .where(held)
        .withColumn("upper", F.col("rank") > exact).withColumn("weight", exact - F.floor(exact))
    )
    # Parts that hold no wanted rank are not ranked.
    named = _renamed(wanted, [*keys, "part"], "before").distinct()
    in_part = Window.partitionBy(*keys, "part").orderBy("value")
    ranked = (
        values.join(lookup(named), _same(values, named, [*keys, "part"]))
        .select(*keys, "part", "value", "same", "before")
        .withColumn("end", F.col("before") + F.sum("same").over(in_part))
        .withColumn("start", F.col("end") - F.col("same"))
    )
    asked = _renamed(wanted, [*keys, "part"], "probability", "rank", "upper", "weight")
    hit = (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("end"))
    found = ranked.join(lookup(asked), _same(ranked, asked, [*keys, "part"]) & hit)
    lower = F.max(F.when(~F.col("upper"), F.col("value")))
    upper = F.max(F.when(F.col("upper"), F.col("value")))
    return found.groupBy(*keys, "probability").agg(
        (lower + F.coalesce((upper - lower) * F.max("weight"), F.lit(0.0))).alias("value"))


def by_name(quantiles: DataFrame, names: dict[str, float], keys: Sequence[str]) -> DataFrame:
    """Quantile rows to named columns, one row per key."""
    return quantiles.groupBy(*keys).agg(*(
        F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name)
        for name, p in names.items()))


def quantile_columns(df: DataFrame, column: str, names: dict[str, float],
                     by: Sequence[str] = ()) -> DataFrame:
    """The quantiles of one column side by side, one row per group."""
    return by_name(exact_quantiles(df, [column], list(names.values()), by), names, by)


def area_under_roc(df: DataFrame, score: str, label: str = "label",
                   by: Sequence[str] = ("split",)) -> DataFrame:
    """Exact area under the ROC curve per group of ``by``; a missing group is a group.

    A positive row counts the negatives scored below it and half of those
    scored the same; the sum over all is divided by positives x negatives. NaN is
    larger than any number; rows without a score count for nothing.
    """
    rises = F.col(label) == 1.0
    tally = (
        df.select(*by, F.col(score).cast("double").alias("value"), F.col(label).alias(label))
        .where("value is not null").groupBy(*by, "value")
        .agg(F.count_if(rises).alias("p"), F.count_if(~rises).alias("q"))
    )
    values, parts = _ranged(tally, by, "q")
    shift = _renamed(parts, [*by, "part"], "before")
    in_part = Window.partitionBy(*by, "part").orderBy("value")
    counted = values.withColumn("below", F.sum("q").over(in_part) - F.col("q"))
    counted = counted.join(lookup(shift), _same(counted, shift, [*by, "part"]))
    wins = F.sum(F.col("p") * (F.col("below") + F.col("before") + F.col("q") / 2))
    pairs = F.sum("p").cast("double") * F.sum("q")
    return counted.groupBy(*by).agg(F.try_divide(wins, pairs).alias("auc"))
