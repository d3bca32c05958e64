"""Names, formats and defaults that results depend on."""

from pyspark.sql import types as T

# --- fixed values: input files -------------------------------------------------
RAW_SCHEMA = T.StructType(
    [T.StructField("Date", T.StringType())]
    + [T.StructField(name, T.DoubleType())
       for name in ("Open", "High", "Low", "Close", "Volume", "OpenInt")]
)
SYMBOL_FILE_SUFFIX = ".us.txt"
PRICE_COLUMNS = ["Open", "High", "Low", "Close"]
NUMERIC_COLUMNS = ["Open", "High", "Low", "Close", "Volume", "OpenInt"]

# --- fixed values: defaults of the jobs ----------------------------------------
MIN_ROWS = 60
HORIZON = 20
TRAIN_END = "2015-01-01"
VAL_END = "2016-01-01"
HISTORY_THRESHOLDS = (60, 252, 756)
ELIGIBLE_MIN_ROWS = {"train": 252, "validation": 20, "test": 20}
SPLITS = ("train", "validation", "test")

# --- fixed values: window sizes, in rows ---------------------------------------
RETURN_LAGS = (1, 2, 5, 10, 20, 40)
VOLATILITY_ROWS = (5, 10, 20)
PRICE_AVERAGE_ROWS = (5, 10, 20, 60)
VOLUME_AVERAGE_ROWS = (10, 20)
DRAWDOWN_ROWS = (10, 20)
LOW_ROWS = 20
PAST_RETURN_LAGS = (3, 5, 10)

# --- fixed values: model inputs, in the order the vectors use ------------------
CYCLIC_FEATURES = [
    "DateMonthSin", "DateMonthCos", "DateDaySin", "DateDayCos", "DayOfWeekSin", "DayOfWeekCos",
]
MARKET_FEATURES = [
    "ret_1", "ret_2", "ret_5", "ret_10", "ret_20", "ret_40",
    "vol_5", "vol_10", "vol_20", "vol_ratio_5_20",
    "ma_ratio_5", "ma_ratio_10", "ma_ratio_20", "ma_ratio_60",
    "intraday_range", "open_close_change", "high_close_ratio", "close_low_ratio", "gap_open",
    "volume_ratio_10", "volume_ratio_20", "volume_change_1", "log_volume",
    "drawdown_10", "drawdown_20", "close_to_max_20", "close_to_min_20",
]
FEATURES = CYCLIC_FEATURES + MARKET_FEATURES
LEGACY_FEATURES = CYCLIC_FEATURES[:4] + ["PastReturn3", "PastReturn5", "PastReturn10"]

# --- fixed values: tuning grids ------------------------------------------------
LOGISTIC_GRID = {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0]}
RF_CLASSIFIER_GRID = {"numTrees": [20, 50], "maxDepth": [5, 10]}
GBT_CLASSIFIER_GRID = {"maxDepth": [3, 5], "maxIter": [20, 50]}
LINEAR_GRID = {"regParam": [0.01, 0.1], "elasticNetParam": [0.5, 1.0]}
GLR_GRID = {"regParam": [0.005, 0.01, 0.02, 0.03, 0.1], "maxIter": [50, 100, 150]}
RF_REGRESSOR_GRID = {"numTrees": [20], "maxDepth": [5, 10]}
MAX_ITER = 100
SEED = 42
FOLDS = 3
