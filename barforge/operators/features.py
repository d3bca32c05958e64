"""Date, price and volume features of one bar from its symbol's history.

All row windows share one partitioning and order, so a whole feature frame
costs one shuffle and one sort. ``rowsBetween`` frames are partial at the start
of a history. Ratios with a zero or missing denominator are NULL.
"""

import math

import numpy as np
from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from barforge.constants import (
    DRAWDOWN_ROWS, LOW_ROWS, PAST_RETURN_LAGS, PRICE_AVERAGE_ROWS, RETURN_LAGS,
    VOLATILITY_ROWS, VOLUME_AVERAGE_ROWS,
)
from barforge.functions.rolling import Columns, Shifted, add_rolling


def last_rows(window: WindowSpec, rows: int) -> WindowSpec:
    """The current row and the ones before it, ``rows`` in all."""
    return window.rowsBetween(1 - rows, 0)


def change(new: str, old: str) -> Column:
    return F.try_divide(F.col(new) - F.col(old), F.col(old))


def ratio(a: str, b: str) -> Column:
    return F.try_divide(F.col(a), F.col(b))


# --- date and single-bar columns -------------------------------------------------

def cyclic_columns(weekday: bool = True) -> dict[str, Column]:
    """Sine and cosine of month, day of month and (optionally) weekday."""
    steps = {"DateMonth": (F.month("Date") - 1, 12), "DateDay": (F.dayofmonth("Date") - 1, 31)}
    if weekday:
        steps["DayOfWeek"] = (F.dayofweek("Date") - 1, 7)
    turns = {name: step * (2 * math.pi / length) for name, (step, length) in steps.items()}
    return {
        f"{name}{suffix}": wave(angle)
        for name, angle in turns.items()
        for suffix, wave in (("Sin", F.sin), ("Cos", F.cos))
    }


def add_cyclic_features(df: DataFrame, weekday: bool = True) -> DataFrame:
    return df.withColumns(cyclic_columns(weekday))


def intraday_columns() -> dict[str, Column]:
    return {
        "intraday_range": F.try_divide(F.col("High") - F.col("Low"), F.col("Close")),
        "open_close_change": change("Close", "Open"),
        "high_close_ratio": F.try_divide(F.col("High") - F.col("Close"), F.col("Close")),
        "close_low_ratio": F.try_divide(F.col("Close") - F.col("Low"), F.col("Close")),
    }


def add_intraday_features(df: DataFrame) -> DataFrame:
    return df.withColumns(intraday_columns())


def add_log_volume(df: DataFrame) -> DataFrame:
    return df.withColumn("log_volume", F.log1p("Volume"))


# --- columns over the history ----------------------------------------------------
# Each adds its helper columns (lags, averages, extremes) and keeps them.

def _lags(window: WindowSpec, column: str, lags) -> dict[str, Column]:
    return {f"{column}_lag_{k}": F.lag(column, k).over(window) for k in lags}


def _averages(window: WindowSpec, column: str, prefix: str, sizes) -> dict[str, Column]:
    return {f"{prefix}_{n}": F.avg(column).over(last_rows(window, n)) for n in sizes}


def _extremes(window: WindowSpec) -> dict[str, Column]:
    highs = {f"rolling_max_{n}": F.max("Close").over(last_rows(window, n)) for n in DRAWDOWN_ROWS}
    return highs | {
        f"rolling_min_{LOW_ROWS}": F.min("Close").over(last_rows(window, LOW_ROWS))}


def _return_columns(lags=RETURN_LAGS) -> dict[str, Column]:
    return {f"ret_{k}": change("Close", f"Close_lag_{k}") for k in lags}


def add_simple_returns(df: DataFrame, window: WindowSpec, lags=RETURN_LAGS) -> DataFrame:
    return df.withColumns(_lags(window, "Close", lags)).withColumns(_return_columns(lags))


def _volatility_columns(window: WindowSpec) -> dict[str, Column]:
    return {f"vol_{n}": F.stddev_samp("ret_1").over(last_rows(window, n)) for n in VOLATILITY_ROWS}


def _volatility_ratio() -> dict[str, Column]:
    return {"vol_ratio_5_20": ratio("vol_5", "vol_20")}


def add_volatility(df: DataFrame, window: WindowSpec) -> DataFrame:
    """Sample standard deviation of one-row returns; needs ``ret_1``."""
    return df.withColumns(_volatility_columns(window)).withColumns(_volatility_ratio())


def _average_ratios() -> dict[str, Column]:
    return {f"ma_ratio_{n}": ratio("Close", f"ma_{n}") for n in PRICE_AVERAGE_ROWS}


def add_moving_averages(df: DataFrame, window: WindowSpec) -> DataFrame:
    return df.withColumns(
        _averages(window, "Close", "ma", PRICE_AVERAGE_ROWS)).withColumns(_average_ratios())


def add_gap_open(df: DataFrame, window: WindowSpec) -> DataFrame:
    return df.withColumns(_lags(window, "Close", [1])).withColumn(
        "gap_open", change("Open", "Close_lag_1"))


def _volume_columns() -> dict[str, Column]:
    ratios = {f"volume_ratio_{n}": ratio("Volume", f"volume_ma_{n}") for n in VOLUME_AVERAGE_ROWS}
    return ratios | {"volume_change_1": change("Volume", "Volume_lag_1")}


def add_volume_features(df: DataFrame, window: WindowSpec) -> DataFrame:
    helpers = _averages(window, "Volume", "volume_ma", VOLUME_AVERAGE_ROWS)
    return df.withColumns(helpers | _lags(window, "Volume", [1])).withColumns(_volume_columns())


def _range_columns() -> dict[str, Column]:
    drawdowns = {f"drawdown_{n}": change("Close", f"rolling_max_{n}") for n in DRAWDOWN_ROWS}
    return drawdowns | {
        f"close_to_max_{LOW_ROWS}": ratio("Close", f"rolling_max_{LOW_ROWS}"),
        f"close_to_min_{LOW_ROWS}": ratio("Close", f"rolling_min_{LOW_ROWS}"),
    }


def add_range_features(df: DataFrame, window: WindowSpec) -> DataFrame:
    return df.withColumns(_extremes(window)).withColumns(_range_columns())


def _rolled(close: Shifted, volume: Shifted) -> Columns:
    """The helper columns of all market features, and the deviations of one-row returns."""
    def times(column: Shifted, prefix: str, sizes, told) -> Columns:
        return {f"{prefix}_{n}": told(column, n) for n in sizes}

    before = np.r_[0.0, close.values[:-1]]
    known = close.known & np.r_[False, close.known[:-1]] & (close.row > 1) & (before != 0)
    returns = Shifted((close.values - before) / before, known, close.row, close.first)
    return (
        times(close, "Close_lag", RETURN_LAGS, Shifted.back) | times(volume, "Volume_lag", [1], Shifted.back)
        | times(close, "ma", PRICE_AVERAGE_ROWS, Shifted.mean)
        | times(volume, "volume_ma", VOLUME_AVERAGE_ROWS, Shifted.mean)
        | times(close, "rolling_max", DRAWDOWN_ROWS, Shifted.largest)
        | times(close, "rolling_min", [LOW_ROWS], Shifted.smallest)
        | times(returns, "vol", VOLATILITY_ROWS, Shifted.deviation)
    )


_ROLLED = [
    *(f"Close_lag_{k}" for k in RETURN_LAGS), "Volume_lag_1", *(f"ma_{n}" for n in PRICE_AVERAGE_ROWS),
    *(f"volume_ma_{n}" for n in VOLUME_AVERAGE_ROWS), *(f"rolling_max_{n}" for n in DRAWDOWN_ROWS),
    f"rolling_min_{LOW_ROWS}", *(f"vol_{n}" for n in VOLATILITY_ROWS),
]


def add_market_features(df: DataFrame, window: WindowSpec) -> DataFrame:
    """All market features: the operators above, with all moving frames in one pass over one
    sorted partitioning (see ``functions/rolling``).
    """
    rolled = add_rolling(df, window, ["Close", "Volume"], _ROLLED, _rolled, FEATURE_ROWS_BACK + 1)
    single = (
        _return_columns() | _average_ratios() | _volume_columns() | _range_columns()
        | intraday_columns() | _volatility_ratio()
        | {"gap_open": change("Open", "Close_lag_1"), "log_volume": F.log1p("Volume")}
    )
    return rolled.withColumns(single)


def add_past_returns(df: DataFrame, window: WindowSpec) -> DataFrame:
    """Log of a past close over the current one (past over present)."""
    lagged = df.withColumns(_lags(window, "Close", PAST_RETURN_LAGS))
    return lagged.withColumns({
        f"PastReturn{k}": F.log(ratio(f"Close_lag_{k}", "Close")) for k in PAST_RETURN_LAGS
    }).drop(*(f"Close_lag_{k}" for k in PAST_RETURN_LAGS))


# Rows before a row that its features look at: the longest frame or lag, and the
# volatility's frame of returns that each reach one row further back.
FEATURE_ROWS_BACK = max(*RETURN_LAGS, *(n - 1 for n in PRICE_AVERAGE_ROWS), *VOLATILITY_ROWS)
