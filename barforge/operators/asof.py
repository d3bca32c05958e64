"""As-of joins: each row meets the last row of another table that is not after it.

Both tables are one sequence per key, ordered by time; a window carries the last row of
the other table forward. That is one shuffle and one sort, and nothing is paired.
A key with more rows than a task should hold is cut into blocks of its order. What a
block must know of those before it is one row, the last of the other table in them, so
blocks' last rows are carried over the blocks' own sequence.
"""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from barforge.functions.blocks import key_equals, placed_in_order, split_by_size
from barforge.functions.history import MAX_ROWS_PER_TASK


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str] = (),
    values: Sequence[str] | None = None,
    strict: bool = False,
    forward: bool = False,
    tolerance: float | str | None = None,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """``left`` with the ``values`` of the last row of ``right`` whose ``on`` is at most its own.

    ``by`` names key columns in both tables; without them all rows are one key. ``values``
    (by default all other columns of ``right``) come out under their names, with the matched
    time as ``<on>_matched``; names that ``left`` has already get the ending ``_right``.
    ``strict`` asks for an earlier time instead of an equal or earlier one, ``forward`` for the
    first row at or after the left one. A match farther away than ``tolerance`` (a number,
    or an interval such as ``"INTERVAL 1 HOUR"``) is none.

    Every row of ``left`` comes out once. Without a match, and for a missing time or key (which
    match nothing), the values are missing. Of several right rows at the matched time the last
    in the order of ``values`` is taken, ``forward`` the first.
    """
    by = list(by)
    values = [c for c in right.columns if c not in (*by, on)] if values is None else list(values)
    kept = [c for c in left.columns if c not in (*by, on)]
    told = F.struct(F.col(on).alias("t"), *(F.col(c).alias(f"v{i}") for i, c in enumerate(values)))
    own = F.struct(F.lit(0).alias("row"), *(F.col(c).alias(f"l{i}") for i, c in enumerate(kept)))
    own_type, told_type = _type(left, own), _type(right, told)
    keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(by)] or [F.lit(0).alias("k0")]
    names = [f"k{i}" for i in range(max(1, len(by)))]

    def side(df: DataFrame, number: int, left_row: Column, right_row: Column) -> DataFrame:
        return df.select(*keys, F.col(on).alias("t"), F.lit(number).alias("side"), left_row.alias("own"), right_row.alias("told"))

    # At equal times the side that comes first in the sequence is seen by the other.
    left_side = 0 if strict != forward else 1
    sound = reduce(and_, (F.col(c).isNotNull() for c in (*by, on)))
    rows = side(left.where(sound), left_side, own, F.lit(None).cast(told_type)).unionByName(
        side(right.where(sound), 1 - left_side, F.lit(None).cast(own_type), told))
    found = _carried(rows, names, ["t", "side", "told"], forward, max_rows).where(F.col("own").isNotNull())
    lone = side(left.where(~sound), left_side, own, F.lit(None).cast(told_type)).withColumn("match", F.lit(None).cast(told_type))

    near = F.lit(True)
    if tolerance is not None:
        limit = F.expr(tolerance) if isinstance(tolerance, str) else F.lit(tolerance)
        near = (F.col("t") <= F.col("match.t") + limit) & (F.col("match.t") <= F.col("t") + limit)
    match = F.when(near, F.col("match"))
    place = {**{c: F.col(f"k{i}") for i, c in enumerate(by)}, on: F.col("t"), **{c: F.col(f"own.l{i}") for i, c in enumerate(kept)}}

    def fresh(name: str) -> str:
        return f"{name}_right" if name in left.columns else name

    return found.unionByName(lone).select(
        *(place[c].alias(c) for c in left.columns), match["t"].alias(fresh(f"{on}_matched")),
        *(match[f"v{i}"].alias(fresh(c)) for i, c in enumerate(values)))


def _type(df: DataFrame, column: Column) -> str:
    return df.select(column.alias("c")).schema["c"].dataType.simpleString()


def _carried(rows: DataFrame, keys: list[str], order: list[str], forward: bool, max_rows: int) -> DataFrame:
    """``rows`` with ``match``: the last ``told`` so far (``forward``: the first from here on)."""
    def carry(column: str, partition: list[str], by: list[str], own: bool = True) -> Column:
        window = Window.partitionBy(*partition).orderBy(*by)
        if forward:
            return F.first(column, ignorenulls=True).over(window.rowsBetween(0 if own else 1, Window.unboundedFollowing))
        return F.last(column, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0 if own else -1))

    short, long = split_by_size(rows, keys, max_rows)
    simple = short.withColumn("match", carry("told", keys, order))
    if long is None:
        return simple
    blocks = placed_in_order(long, keys, order).withColumn("block", F.floor(F.col("position") / F.lit(max_rows)))
    # What a block hands on is one row; those are carried over the sequence of blocks.
    pick = F.min_by if forward else F.max_by
    edges = blocks.where("told is not null").groupBy(*keys, "block").agg(pick("told", "position").alias("edge"))
    every = blocks.select(*keys, "block").distinct().join(edges, [*keys, "block"], "left")
    handed = every.select(*(F.col(k).alias(f"{k}_of") for k in keys), F.col("block").alias("block_of"),
                          carry("edge", keys, ["block"], own=False).alias("handed"))
    inside = blocks.withColumn("here", carry("told", [*keys, "block"], ["position"]))
    joined = inside.join(handed, key_equals(keys) & (F.col("block") == F.col("block_of")), "left")
    return simple.unionByName(joined.select(*rows.columns, F.coalesce("here", "handed").alias("match")))
