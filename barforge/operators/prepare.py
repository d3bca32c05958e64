"""Model frames: cleaned bars with features and target.

``max_rows`` and ``sized_by`` are those of ``over_history``.
"""

from pyspark.sql import DataFrame, WindowSpec, functions as F

from barforge.constants import (
    FEATURES, HORIZON, LEGACY_FEATURES, MARKET_FEATURES, MIN_ROWS, PAST_RETURN_LAGS,
)
from barforge.functions.history import MAX_ROWS_PER_TASK, over_history
from barforge.operators.clean import clean_market_data
from barforge.operators.features import (
    FEATURE_ROWS_BACK, add_cyclic_features, add_market_features, add_past_returns,
)
from barforge.operators.targets import add_binary_label, add_log_return


def _complete(df: DataFrame, target: str, features: list[str]) -> DataFrame:
    """Rows with a date, a target and every feature that can be missing (NULL or NaN).

    The date features follow from the date; they are added behind this filter,
    which would otherwise compute them twice.
    """
    return df.where(F.col("Date").isNotNull()).dropna(subset=[target, *features])


def _with_label(df: DataFrame, target: str, features: list[str], keys: list[str]) -> DataFrame:
    """Keys, features and the target as a double ``label``."""
    return df.select(*keys, *(F.col(c).cast("double").alias(c) for c in features),
                     F.col(target).cast("double").alias("label"))


def _features_and_return(bars: DataFrame, min_rows: int, max_rows: int,
                         sized_by: DataFrame | None) -> DataFrame:
    def add(df: DataFrame, window: WindowSpec) -> DataFrame:
        labelled = add_log_return(df, window)
        if "symbol_rows" in df.columns:
            # Short histories go as a whole, before any of their features are told.
            labelled = labelled.where(F.col("symbol_rows") >= min_rows)
        return add_market_features(labelled, window)

    windowed = over_history(
        clean_market_data(bars), add, back=FEATURE_ROWS_BACK, ahead=HORIZON,
        min_rows=min_rows, max_rows=max_rows, sized_by=sized_by or bars)
    return add_cyclic_features(_complete(windowed, f"LogReturn{HORIZON}", MARKET_FEATURES))


def prepare_classification(
    bars: DataFrame, min_rows: int = MIN_ROWS, max_rows: int = MAX_ROWS_PER_TASK,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Symbol, Date, 33 features and the direction of the 20-row return."""
    df = add_binary_label(_features_and_return(bars, min_rows, max_rows, sized_by))
    return _with_label(df, "label_bin", FEATURES, ["Symbol", "Date"])


def prepare_regression(
    bars: DataFrame, min_rows: int = MIN_ROWS, max_rows: int = MAX_ROWS_PER_TASK,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Symbol, Date, 33 features and the 20-row log return."""
    df = _features_and_return(bars, min_rows, max_rows, sized_by)
    return _with_label(df, f"LogReturn{HORIZON}", FEATURES, ["Symbol", "Date"])


def prepare_legacy(
    bars: DataFrame, max_rows: int = MAX_ROWS_PER_TASK, sized_by: DataFrame | None = None
) -> DataFrame:
    """The early seven-feature regression frame: uncleaned bars, no weekday.

    Symbol and Date only serve the hash split and folds.
    """
    def add(df: DataFrame, window: WindowSpec) -> DataFrame:
        return add_past_returns(add_log_return(df, window), window)

    windowed = over_history(
        bars, add, back=max(PAST_RETURN_LAGS), ahead=HORIZON,
        max_rows=max_rows, sized_by=sized_by)
    target = f"LogReturn{HORIZON}"
    past = [f"PastReturn{k}" for k in PAST_RETURN_LAGS]
    df = add_cyclic_features(_complete(windowed, target, past), weekday=False)
    return _with_label(df, target, LEGACY_FEATURES, ["Symbol", "Date"])


def labelled_bars(
    bars: DataFrame, min_rows: int = MIN_ROWS, max_rows: int = MAX_ROWS_PER_TASK,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Symbol, Date and LogReturn20 of cleaned rows that have a return."""
    target = f"LogReturn{HORIZON}"
    windowed = over_history(
        clean_market_data(bars), add_log_return, ahead=HORIZON,
        min_rows=min_rows, max_rows=max_rows, sized_by=sized_by or bars)
    return windowed.dropna(subset=[target]).select("Symbol", "Date", target)
