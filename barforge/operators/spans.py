"""Range joins: pairs of rows whose spans overlap, without pairing all with all.

The line is cut into cells of several widths, each four times the last. A span's home is
the narrowest width not below its length, where it lies in one cell or two. Of an
overlapping pair, the longer span meets the other in cells of its own home width: the
shorter one is listed there, too. So both sides list each row at its home and at the
wider widths that are homes on the other side, and a pair is made in the cell that holds the
later of its two beginnings, once. Cells are as narrow as one of the two spans, so
a good part of what meets in a cell overlaps, and a long span is never listed in many cells.

A cell with many rows is dealt out: both sides to chunks, each pair of chunks being a
key of its own.
"""

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from barforge.functions.history import lookup
from barforge.functions.storage import stored

STEPS = 16  # widths below the longest span; spans shorter than all have the narrowest as their home


def range_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    by: Sequence[str] = (),
    closed: bool = True,
    max_rows: int = 100_000,
) -> DataFrame:
    """Pairs of rows whose spans (first and last column, numbers or times) have a point in common.

    Spans are closed, or half-open if ``closed`` is false: then spans that only touch do not
    overlap, and an empty one overlaps nothing. A point is a closed span from a column to itself.
    ``by`` names columns that must be equal in both. The result has the columns of ``left`` and those of ``right`` but ``by``; other
    names must differ. Rows with a missing bound or key, or that end before they begin, match nothing;
    repeated rows match repeatedly. A cell's task gets at most about ``max_rows`` rows of each side.
    """
    by = list(by)
    clash = [c for c in right.columns if c in left.columns and c not in by]
    if clash:
        raise ValueError(f"columns in both tables: {', '.join(clash)}")
    sides = [_bounds(left, left_span, by, "l", closed), _bounds(right, right_span, by, "r", closed)]
    grid = _Grid.over(sides)
    homes = [df.withColumn("home", grid.home(F.col(f"{s}_to") - F.col(f"{s}_from"))) for df, s in zip(sides, "lr")]
    used = [sorted(r.home for r in df.select("home").distinct().collect()) for df in homes]  # at most STEPS + 1 numbers
    lists = [F.array(*(F.lit(w) for w in ws)).cast("array<int>") for ws in used]

    home = F.col("home")
    own = F.array(home)
    keys = [*(f"k{i}" for i in range(len(by))), "width", "cell"]
    # The longer span is at home, the shorter listed there; of equal homes the left one is at home.
    longer_left = _paired(
        grid.listed(homes[0], "l", own), grid.listed(homes[1], "r", F.filter(lists[0], lambda w: w >= home)), keys, grid, closed, max_rows)
    longer_right = _paired(
        grid.listed(homes[0], "l", F.filter(lists[1], lambda w: w > home)), grid.listed(homes[1], "r", own), keys, grid, closed, max_rows)
    return longer_left.unionByName(longer_right).select("l.*", *(F.col(f"r.{c}") for c in right.columns if c not in by))


def _bounds(df: DataFrame, span: tuple[str, str], by: list[str], side: str, closed: bool) -> DataFrame:
    """Rows that can match, whole in ``side``, with their keys and bounds as numbers."""
    kind = df.schema[span[0]].dataType

    def number(name: str) -> Column:
        if isinstance(kind, T.TimestampNTZType):
            return F.unix_micros(F.col(name).cast("timestamp"))
        if isinstance(kind, T.TimestampType):
            return F.unix_micros(F.col(name))
        if isinstance(kind, T.DateType):
            return F.unix_date(F.col(name)).cast("bigint")
        return F.col(name)

    sound = reduce(and_, (F.col(c).isNotNull() for c in (*by, *span)))
    rows = df.where(sound).select(
        *(F.col(c).alias(f"k{i}") for i, c in enumerate(by)), F.struct(*df.columns).alias(side),
        number(span[0]).alias(f"{side}_from"), number(span[1]).alias(f"{side}_to"))
    first, last = F.col(f"{side}_from"), F.col(f"{side}_to")
    return rows.where(first <= last if closed else first < last)


@dataclass(frozen=True)
class _Grid:
    """Widths of cells, from the whole line's beginning and the longest span."""

    start: float
    longest: float
    steps: int

    @classmethod
    def over(cls, sides: Sequence[DataFrame]) -> "_Grid":
        told = [df.agg(F.min(f"{s}_from"), F.max(f"{s}_to"), F.max(F.col(f"{s}_to") - F.col(f"{s}_from"))).first()
                for df, s in zip(sides, "lr")]
        known = [[float(v) for v in t] for t in told if t[0] is not None]
        if not known:
            return cls(0.0, 1.0, 0)
        start, end, longest = min(k[0] for k in known), max(k[1] for k in known), max(k[2] for k in known)
        # Cell numbers fit into 62 bits.
        longest = max(longest, (end - start) / 2 ** 60) or 1.0
        fine = math.log(2 ** 62 / max(1.0, (end - start) / longest), 4)
        return cls(start, longest, max(0, min(STEPS, int(fine))))

    def home(self, length: Column) -> Column:
        """Number of the narrowest width that is not below ``length``; the widest is number ``steps``."""
        below = F.floor(F.log(F.lit(self.longest) / length) / math.log(4) - 1e-9)
        return F.when(length > 0, F.greatest(F.lit(self.steps) - below, F.lit(0))).otherwise(0).cast("int")

    def cell(self, position: Column) -> Column:
        """Number of the cell of the row's ``width`` that holds ``position``; never falls as that rises."""
        width = F.lit(self.longest) * F.pow(F.lit(4.0), F.col("width") - F.lit(self.steps))
        return F.floor((position.cast("double") - F.lit(self.start)) / width)

    def listed(self, df: DataFrame, side: str, widths: Column) -> DataFrame:
        """A row per cell that a span touches at each of ``widths``, none of which is below its home."""
        rows = df.withColumn("width", F.explode(widths))
        first, last = self.cell(F.col(f"{side}_from")), self.cell(F.col(f"{side}_to"))
        # Two cells at most; rounding may add a third.
        return rows.withColumn("cell", F.explode(F.array_distinct(F.array(first, F.least(first + 1, last), last)))).drop("home")


def _paired(left: DataFrame, right: DataFrame, keys: list[str], grid: _Grid, closed: bool, max_rows: int) -> DataFrame:
    """Overlapping pairs (l, r) of rows listed in the same cell, each in the cell of its later beginning."""
    later = F.greatest("l_from", "r_from")
    overlap = (F.col("l_from") <= F.col("r_to")) & (F.col("r_from") <= F.col("l_to")) if closed else (
        (F.col("l_from") < F.col("r_to")) & (F.col("r_from") < F.col("l_to")))

    def pairs(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        return left.join(right, on).where(overlap & (grid.cell(later) == F.col("cell"))).select("l", "r")

    counts = (left.groupBy(*keys).agg(F.count(F.lit(1)).alias("nl"))
              .join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("nr")), keys))
    chunks = lambda n: F.ceil(F.col(n) / F.lit(max_rows)).cast("int")
    hot = stored(counts.where((F.col("nl") > max_rows) | (F.col("nr") > max_rows))
                 .select(*keys, chunks("nl").alias("l_chunks"), chunks("nr").alias("r_chunks")), "hot-cells")
    if hot.isEmpty():
        return pairs(left, right, keys)

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        """Rows of hot cells, each in a chunk of its side and once for each chunk of the other; written, so that they stay there."""
        rows = df.join(lookup(hot), keys)
        rows = rows.withColumn(f"{own}_chunk", F.floor(F.rand(11) * F.col(f"{own}_chunks")).cast("int"))
        rows = rows.withColumn(f"{other}_chunk", F.explode(F.sequence(F.lit(0), F.col(f"{other}_chunks") - 1)))
        return stored(rows.drop("l_chunks", "r_chunks"), "dealt-cells")

    cool = (df.join(lookup(hot.select(*keys)), keys, "left_anti") for df in (left, right))
    return pairs(*cool, keys).unionByName(pairs(dealt(left, "l", "r"), dealt(right, "r", "l"), [*keys, "l_chunk", "r_chunk"]))
