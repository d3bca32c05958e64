"""The registered queries: library operators on bars derived from the tables."""

from collections.abc import Callable

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, WindowSpec, functions as F

from barforge import constants as K
from barforge.functions.history import over_history
from barforge.functions.ranks import area_under_roc
from barforge.functions.rounding import round_columns
from barforge.functions.storage import scratch_path, stored
from barforge.operators import (
    clean, coverage, evaluate, features, labels, models, prepare, profile, report, split, targets,
)
from barforge.plans import exploration
from barforge.sources import audit, files, results, tables

# Cut-offs inside the tables' dates.
TRAIN_END, VAL_END = "2000-01-01", "2001-01-01"
# For the many short histories: some begin after the first, some end before the second.
CLASS_TRAIN_END, CLASS_VAL_END = "1995-02-15", "2000-03-01"
MIN_ROWS = 530  # splits the suppliers in two parts
CLASS_MIN_ROWS = 80
THRESHOLDS = (1, 2, 4)
ELIGIBLE = {"train": 2, "validation": 55, "test": 2}

Query = Callable[[SparkSession, str], DataFrame]


# --- helpers ---------------------------------------------------------------------

# Whole numbers that may be missing, given as doubles like any missing number.
OPTIONAL = ("unique", "freq", "grid_index")


def _plain(name: str, kind: str, digits: int | None) -> Column:
    if name in OPTIONAL:
        return F.col(name).cast("double").alias(name)
    if kind in ("double", "float"):
        return F.col(name) if digits is None else F.round(F.col(name), digits).alias(name)
    if kind in ("int", "smallint", "tinyint"):
        return F.col(name).cast("bigint").alias(name)
    return F.col(name)


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to some decimals, whole numbers as bigint."""
    return df.select(*(_plain(c, t, digits) for c, t in df.dtypes))


def comparable_rows(df: DataFrame, digits: int = 6) -> DataFrame:
    """``comparable`` for many rows: their doubles are rounded in Arrow batches."""
    doubles = [c for c, t in df.dtypes if t == "double" and c not in OPTIONAL]
    plain = df.select(*(_plain(c, t, None if c in doubles else digits) for c, t in df.dtypes))
    return round_columns(plain, doubles, digits)


def on(source: Query, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(operator(source(spark, sf_dir)))


def history(add: Callable[[DataFrame, WindowSpec], DataFrame], columns: list[str],
            back: int = 0, ahead: int = 0, digits: int = 6) -> Query:
    """Symbol, Date and the columns an operator adds over supplier histories."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bars = tables.supplier_bars(spark, sf_dir)
        return comparable(
            over_history(bars, add, back=back, ahead=ahead,
                         sized_by=tables.supplier_lines(spark, sf_dir))
            .select("Symbol", "Date", *columns), digits)
    return query


def with_returns(add):
    return lambda df, window: add(features.add_simple_returns(df, window, [1]), window)


def bar_columns(operator: Callable[[DataFrame], DataFrame], columns: list[str],
                source: Query = tables.supplier_bars) -> Query:
    return on(source, lambda df: operator(df).select("Symbol", "Date", *columns))


def classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_classification(
        tables.supplier_bars(spark, sf_dir), sized_by=tables.supplier_lines(spark, sf_dir))


def regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_regression(
        tables.supplier_bars(spark, sf_dir), sized_by=tables.supplier_lines(spark, sf_dir))


def legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_legacy(
        tables.supplier_bars(spark, sf_dir), sized_by=tables.supplier_lines(spark, sf_dir))


def by_date(source: Query) -> Query:
    return lambda spark, sf_dir: split.add_temporal_split(
        source(spark, sf_dir), TRAIN_END, VAL_END)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled supplier bars with their split."""
    bars = prepare.labelled_bars(
        tables.supplier_bars(spark, sf_dir), sized_by=tables.supplier_lines(spark, sf_dir))
    return split.add_temporal_split(bars, TRAIN_END, VAL_END)


def class_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled bars of the short histories with their split."""
    # A class has no more lines than its supplier.
    bars = prepare.labelled_bars(tables.class_bars(spark, sf_dir), CLASS_MIN_ROWS,
                                 sized_by=tables.supplier_lines(spark, sf_dir))
    return split.add_temporal_split(bars, CLASS_TRAIN_END, CLASS_VAL_END)


def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.symbol_split_counts(class_labelled(spark, sf_dir))


def once(source: Query, *columns: str) -> Query:
    """``source`` stored, for operators that read it more than once: its windows run once."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = source(spark, sf_dir)
        return stored(df.select(*columns) if columns else df, "once")
    return query


def momentum_guess(df: DataFrame) -> DataFrame:
    """Predict a rise after a rise over five rows."""
    return df.withColumn("prediction", F.when(F.col("ret_5") > 0, 1.0).otherwise(0.0))


# --- sources and sinks -----------------------------------------------------------

def scan_csv_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars written as symbol files and read back through the bulk scan."""
    path = scratch_path(spark, "symbol-files")
    files.write_symbol_files(tables.supplier_bars(spark, sf_dir), path)
    return comparable(files.load_stock_data(spark, path).withColumn(
        "Date", F.col("Date").cast("timestamp_ntz")))


def as_text(df: DataFrame) -> DataFrame:
    """Bars as text with some values that are no dates or numbers."""
    day = F.date_format("Date", "yyyy-MM-dd")
    weekday = F.dayofweek("Date")
    return df.select(
        "Symbol", day.alias("day"),
        F.when(weekday == 1, "no date").otherwise(day).alias("Date"),
        *(F.when(weekday == i + 2, "n/a").otherwise(F.col(c).cast("string")).alias(c)
          for i, c in enumerate(K.NUMERIC_COLUMNS[:5])))


def parse_dates(df: DataFrame) -> DataFrame:
    parsed = files.parse_dates(as_text(df).select("Symbol", "day", "Date"))
    return parsed.withColumn("Date", F.col("Date").cast("timestamp_ntz"))


def coerce_numeric(df: DataFrame) -> DataFrame:
    return files.coerce_numeric(as_text(df).drop("Date"), K.NUMERIC_COLUMNS[:5])


def audited_folder(spark: SparkSession, sf_dir: str) -> str:
    """Symbol files of suppliers; those with a negative balance get other columns."""
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.col("s_suppkey").cast("string").alias("Symbol"), "s_acctbal")
    # Two writes read them: stored, so that the lines are read and combined once.
    bars = stored(tables.supplier_bars(spark, sf_dir).join(suppliers, "Symbol"), "audited-bars")
    path = scratch_path(spark, "audited-files")
    files.write_symbol_files(bars.where("s_acctbal >= 0"), path)
    shuffled = [*K.PRICE_COLUMNS, "Date", "Volume"]
    files.write_symbol_files(bars.where("s_acctbal < 0"), path, shuffled, mode="append")
    return path


def file_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(audit.file_audit(spark, audited_folder(spark, sf_dir)))


def coherent_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of the audited folder's usable files."""
    bars = audit.load_coherent_bars(spark, audited_folder(spark, sf_dir))
    return bars.withColumn("Date", F.col("Date").cast("timestamp_ntz"))


def incoherent_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of unusable files that the exploration writes, read back."""
    out = scratch_path(spark, "exploration")
    exploration.load_and_report(spark, audited_folder(spark, sf_dir), out)
    return results.read_names(spark, f"{out}/incoherent_files")


def eligible_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of eligible symbols that the exploration writes, read back."""
    reports = exploration.split_reports(
        tables.class_bars(spark, sf_dir), CLASS_MIN_ROWS, CLASS_TRAIN_END, CLASS_VAL_END, ELIGIBLE)
    path = exploration.write_eligible(reports, scratch_path(spark, "exploration"))
    schema = reports["eligible"].schema
    return comparable(spark.read.schema(schema).option("header", True).csv(path))


def results_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = results.write_results(momentum_board(spark, sf_dir), scratch_path(spark, "results"))
    return comparable(results.read_results(spark, path))


# --- evaluation ------------------------------------------------------------------

def momentum_results(frame: DataFrame) -> DataFrame:
    """Result rows of six fixed rules, one per return column, in one pass."""
    rules = F.array(*(
        F.struct(F.lit(i).alias("grid_index"), F.lit(float(k)).alias("lag"),
                 F.when(F.col(f"ret_{k}") > 0, 1.0).otherwise(0.0).alias("prediction"))
        for i, k in enumerate(K.RETURN_LAGS)))
    guesses = frame.where("split <> 'train'").select("split", "label", F.inline(rules))
    keys = ["grid_index", "lag"]
    metrics = evaluate.classification_metrics(guesses, [*keys, "split"])
    wide = evaluate.val_test_columns(metrics, evaluate.CLASSIFICATION_METRICS, keys)
    return report.mark_best(
        wide.withColumn("model_name", F.lit("MomentumRule")), "val_f1", largest=True)


def all_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = once(by_date(classification), "split", "label", *_returns(K.RETURN_LAGS))(spark, sf_dir)
    return report.combine_results(evaluate.majority_baseline(frame), momentum_results(frame))


def momentum_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.leaderboard(
        comparable(all_results(spark, sf_dir)), report.CLASSIFICATION_ORDER)


def best_per_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(report.best_per_model(all_results(spark, sf_dir)))


def auc_exact(df: DataFrame) -> DataFrame:
    return area_under_roc(df, "ret_5")


def hash_split(df: DataFrame) -> DataFrame:
    return split.add_hash_split(df).groupBy("Symbol", "split").agg(
        F.count(F.lit(1)).alias("rows"))


# --- models ----------------------------------------------------------------------

def model_table(prepared: DataFrame, scale: bool) -> DataFrame | models.ScaledFrame:
    return (models.scaled_frame(prepared, K.FEATURES) if scale
            else models.training_table(prepared, K.FEATURES, scale))


def classifier(search: Callable, scale: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepared = by_date(classification)(spark, sf_dir)
        return search(model_table(prepared, scale)).results
    return query


def regressor(search: Callable, scale: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepared = by_date(regression)(spark, sf_dir)
        return search(model_table(prepared, scale)).results
    return query


def folded(df: DataFrame) -> DataFrame:
    """``df`` stored by split and fold, so that each is read alone."""
    return stored(df.drop("Symbol", "Date"), "folds", partition_by=["split", "fold"])


def cross_validated(search: Callable) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepared = split.add_fold(split.add_hash_split(legacy(spark, sf_dir)), K.FOLDS)
        return search(folded(prepared), K.LEGACY_FEATURES).results
    return query


# The same searches where SQL knows the answer: lines of one feature, and models of one
# 0/1 feature, which can only learn a value for each side.

def line(search: Callable) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = models.scaled_frame(by_date(regression)(spark, sf_dir), ["ret_5"])
        # Points that differ in iterations alone tie: which of them is best is not compared.
        return comparable(search(table).results.drop("is_best"))
    return query


def line_cv(search: Callable) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepared = split.add_fold(split.add_hash_split(legacy(spark, sf_dir)), K.FOLDS)
        return comparable(search(folded(prepared), ["PastReturn5"]).results.drop("is_best"))
    return query


def sides(source: Query, search: Callable[[DataFrame], models.Search]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rising = F.when(F.col("ret_5") > 0, 1.0).otherwise(0.0)
        df = by_date(source)(spark, sf_dir).select("split", "label", rising.alias("rising"))
        return comparable(search(models.training_table(df, ["rising"], scale=False)).results)
    return query


def stump(name: str, estimator, classification: bool) -> Callable[[DataFrame], models.Search]:
    """One tree of depth 1 on all rows."""
    return lambda table: models.grid_search(
        name, estimator(bootstrap=False, seed=K.SEED), {"numTrees": [1], "maxDepth": [1]}, table, classification)


def standard_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Read twice, to fit and to scale: stored so that the windows run once.
    prepared = stored(by_date(classification)(spark, sf_dir), "prepared")
    return comparable_rows(models.standard_scaled(
        prepared, K.FEATURES, ["Symbol", "Date", "split"]))


def linreg_slope(df: DataFrame) -> DataFrame:
    return models.single_feature_line(df, "ret_5")


# --- registry --------------------------------------------------------------------

def _keep(*columns: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.select(*columns)


def _returns(lags) -> list[str]:
    return [f"ret_{k}" for k in lags]


QUERIES: dict[str, Query] = {
    # sources and sinks
    "scan_csv_bars": scan_csv_bars,
    "parse_dates": on(tables.supplier_bars, parse_dates),
    "coerce_numeric": on(tables.supplier_bars, coerce_numeric),
    "file_audit": file_audit,
    "load_coherent_bars": on(coherent_bars, lambda df: df),
    "file_date_ranges": on(coherent_bars, files.file_date_ranges),
    "incoherent_roundtrip": incoherent_roundtrip,
    "eligible_roundtrip": eligible_roundtrip,
    "results_roundtrip": results_roundtrip,
    # filters and joins
    "drop_null_prices": on(tables.flawed_bars, clean.drop_null_prices),
    "clean_positive": on(tables.flawed_bars, clean.keep_positive),
    "clean_ohlc": on(tables.flawed_bars, clean.keep_consistent),
    "clean_market_data": on(tables.flawed_bars, clean.clean_market_data),
    "min_rows_filter": lambda spark, sf_dir: comparable(over_history(
        tables.supplier_bars(spark, sf_dir), lambda df, window: df, min_rows=MIN_ROWS,
        sized_by=tables.supplier_lines(spark, sf_dir))),
    "min_rows_semijoin": on(tables.supplier_bars, lambda df:
                            clean.filter_symbols_by_min_rows(df, MIN_ROWS)),
    # targets and windows
    "target_log_return": history(targets.add_log_return, ["LogReturn20"], ahead=K.HORIZON),
    "target_binary": history(
        targets.add_target_variable, ["LogReturn20", "label_bin"], ahead=K.HORIZON),
    "simple_returns": history(features.add_simple_returns, _returns(K.RETURN_LAGS), back=40),
    "rolling_volatility": history(
        with_returns(features.add_volatility), ["vol_5", "vol_10", "vol_20"], back=20),
    "volatility_ratio": history(
        with_returns(features.add_volatility), ["vol_ratio_5_20"], back=20),
    "moving_averages": history(
        # At eight decimals, no mean of up to 60 prices in cents is an exact half.
        features.add_moving_averages, ["ma_5", "ma_10", "ma_20", "ma_60"], back=59, digits=8),
    "ma_ratios": history(features.add_moving_averages, [
        "ma_ratio_5", "ma_ratio_10", "ma_ratio_20", "ma_ratio_60"], back=59),
    "gap_open": history(features.add_gap_open, ["gap_open"], back=1),
    "volume_ratios": history(features.add_volume_features, [
        "volume_ma_10", "volume_ma_20", "volume_ratio_10", "volume_ratio_20"], back=19),
    "volume_change": history(features.add_volume_features, ["volume_change_1"], back=19),
    "rolling_extrema": history(features.add_range_features, [
        "rolling_max_10", "rolling_max_20", "rolling_min_20"], back=19),
    "drawdowns": history(features.add_range_features, ["drawdown_10", "drawdown_20"], back=19),
    "range_position": history(
        features.add_range_features, ["close_to_max_20", "close_to_min_20"], back=19),
    "past_log_returns": history(features.add_past_returns, [
        "PastReturn3", "PastReturn5", "PastReturn10"], back=10),
    # projections
    "cyclic_features": bar_columns(features.add_cyclic_features, K.CYCLIC_FEATURES),
    "intraday_features": bar_columns(features.add_intraday_features, [
        "intraday_range", "open_close_change", "high_close_ratio", "close_low_ratio"],
        tables.event_bars),
    "log_volume": bar_columns(features.add_log_volume, ["log_volume"]),
    "prepared_features": on(classification, lambda df: df),
    "prepared_regression": on(regression, lambda df: df),
    "prepared_legacy": on(legacy, lambda df: df),
    "temporal_split": on(by_date(tables.supplier_bars), _keep("Symbol", "Date", "split")),
    "hash_split": on(tables.supplier_bars, hash_split),
    # profile
    "table_shape": on(tables.flawed_bars, profile.table_shape),
    "head_rows": on(tables.supplier_bars, profile.head_rows),
    "tail_rows": on(tables.supplier_bars, profile.tail_rows),
    "null_counts": on(tables.flawed_bars, profile.null_counts),
    "empty_string_counts": on(tables.flawed_bars, profile.empty_string_counts),
    "duplicate_rows": on(tables.flawed_bars, profile.duplicate_count),
    "duplicate_keys": on(tables.flawed_bars, lambda df:
                         profile.duplicate_count(df, ["Symbol", "Date"])),
    "date_range": on(tables.flawed_bars, profile.date_range),
    "earliest_symbols": on(tables.class_bars, profile.earliest_symbols),
    "latest_symbols": on(tables.class_bars, profile.latest_symbols),
    "end_month_counts": on(tables.class_bars, profile.end_month_counts),
    "column_summary": on(tables.flawed_bars, profile.column_summary),
    "date_summary": on(tables.flawed_bars, profile.date_summary),
    "invalid_value_checks": on(tables.flawed_bars, profile.invalid_value_checks),
    "ohlc_violation_checks": on(tables.flawed_bars, profile.ohlc_violation_checks),
    "numeric_quantiles": on(tables.flawed_bars, profile.numeric_quantiles),
    "symbol_count": on(tables.flawed_bars, profile.symbol_count),
    "rows_per_symbol_stats": on(tables.class_bars, profile.rows_per_symbol_stats),
    "top_symbols": on(tables.class_bars, profile.top_symbols),
    "short_history_counts": on(tables.class_bars, lambda df:
                               profile.short_history_counts(df, (60, 80, 100))),
    "symbol_span_stats": on(tables.class_bars, profile.symbol_span_stats),
    "rows_per_year": on(tables.flawed_bars, profile.rows_per_year),
    "active_symbols_per_year": on(tables.class_bars, profile.active_symbols_per_year),
    # targets and coverage per split
    "label_distribution": on(once(labelled), labels.label_distribution),
    "label_moments": on(labelled, labels.label_moments),
    "label_summary_table": on(once(labelled), labels.label_summary_table),
    "binary_balance": on(labelled, labels.binary_balance),
    "symbol_split_counts": on(class_counts, lambda df: df),
    "symbols_per_split": on(class_labelled, coverage.symbols_per_split),
    "symbol_overlap": on(class_counts, coverage.symbol_overlap),
    "new_symbols": on(class_counts, coverage.new_symbols),
    "rows_seen_in_train": on(class_counts, coverage.rows_seen_in_train),
    "split_symbol_row_stats": on(class_labelled, coverage.split_symbol_row_stats),
    "top_symbols_by_split": on(class_labelled, coverage.top_symbols_by_split),
    "history_coverage": on(class_counts, lambda df: coverage.history_coverage(df, THRESHOLDS)),
    "eligible_symbols": on(class_counts, lambda df: coverage.eligible_symbols(df, ELIGIBLE)),
    "eligible_share": on(class_counts, lambda df: coverage.eligible_share(df, ELIGIBLE)),
    "eligible_stats": on(class_counts, lambda df: coverage.eligible_stats(
        coverage.eligible_symbols(df, ELIGIBLE))),
    "eligible_top": on(class_counts, lambda df: coverage.eligible_top(
        coverage.eligible_symbols(df, ELIGIBLE))),
    "eligible_bottom": on(class_counts, lambda df: coverage.eligible_bottom(
        coverage.eligible_symbols(df, ELIGIBLE))),
    # evaluation
    "zero_baseline": on(by_date(regression), evaluate.zero_baseline),
    "majority_baseline": on(by_date(classification), evaluate.majority_baseline),
    "auc_exact": on(by_date(classification), auc_exact),
    "confusion_matrix": on(by_date(classification), lambda df:
                           evaluate.confusion_matrix(momentum_guess(df))),
    "class_report": on(by_date(classification), lambda df:
                       evaluate.class_report(momentum_guess(df))),
    "results_leaderboard": momentum_board,
    "best_per_model": best_per_model,
    # models
    "standard_scaled": standard_scaled,
    "linreg_slope": on(by_date(regression), linreg_slope),
    "linear_regression_grid": regressor(models.linear_regression_grid, scale=True),
    "glr_grid": regressor(models.glr_grid, scale=True),
    "rf_regressor_grid": regressor(models.rf_regressor_grid, scale=False),
    "logistic_grid": classifier(models.logistic_grid, scale=True),
    "rf_classifier_grid": classifier(models.rf_classifier_grid, scale=False),
    "gbt_classifier_grid": classifier(models.gbt_classifier_grid, scale=False),
    "linear_regression_cv": cross_validated(models.linear_regression_cv),
    "glr_cv": cross_validated(models.glr_cv),
    "linear_regression_line": line(models.linear_regression_grid),
    "glr_line": line(models.glr_grid),
    "linear_regression_cv_line": line_cv(models.linear_regression_cv),
    "glr_cv_line": line_cv(models.glr_cv),
    "logistic_sides": sides(classification, lambda table: models.logistic_grid(
        table, {"regParam": [0.0], "elasticNetParam": [0.0]})),
    "rf_classifier_sides": sides(classification, stump(
        "RandomForestClassifier", RandomForestClassifier, classification=True)),
    "gbt_classifier_sides": sides(classification, lambda table: models.gbt_classifier_grid(
        table, {"maxDepth": [1], "maxIter": [1]})),
    "rf_regressor_sides": sides(regression, stump(
        "RandomForestRegressor", RandomForestRegressor, classification=False)),
}
