"""The exploratory jobs: load what is usable, and reports as named frames.

Profile reports run when they are read. The load and the split reports first store
the frame that they all rest on.
"""

from pyspark.sql import DataFrame, SparkSession

from barforge.constants import MIN_ROWS, TRAIN_END, VAL_END
from barforge.functions.storage import stored
from barforge.operators import coverage, labels, profile
from barforge.operators.prepare import labelled_bars
from barforge.operators.split import add_temporal_split
from barforge.sources.audit import file_audit, incoherent_files, load_coherent_bars
from barforge.sources.results import write_names, write_table

# --- fixed values: rows a symbol needs in each split to be a model input -----------
SYMBOL_FEATURE_ROWS = {"train": 252, "validation": 60, "test": 60}


def load_and_report(spark: SparkSession, data_dir: str, output_dir: str) -> DataFrame:
    """Bars of the usable files; the names of the others go to ``incoherent_files``."""
    audit = stored(file_audit(spark, data_dir), "audit")
    write_names(incoherent_files(audit), f"{output_dir}/incoherent_files")
    return load_coherent_bars(spark, data_dir, audit)


def write_eligible(reports: dict[str, DataFrame], output_dir: str) -> str:
    """Write the symbols that ``split_reports`` found eligible; returns the folder."""
    path = f"{output_dir}/eligible_symbols"
    write_table(reports["eligible"], path)
    return path


def profile_reports(bars: DataFrame) -> dict[str, DataFrame]:
    """Reports on the bars as they were loaded."""
    return {
        "shape": profile.table_shape(bars),
        "head": profile.head_rows(bars),
        "tail": profile.tail_rows(bars),
        "nulls": profile.null_counts(bars),
        "empty strings": profile.empty_string_counts(bars),
        "duplicate rows": profile.duplicate_count(bars),
        "duplicate keys": profile.duplicate_count(bars, ["Symbol", "Date"]),
        "date range": profile.date_range(bars),
        "first to start": profile.earliest_symbols(bars),
        "last to start": profile.latest_symbols(bars),
        "end months": profile.end_month_counts(bars),
        "summary": profile.column_summary(bars),
        "date summary": profile.date_summary(bars),
        "invalid values": profile.invalid_value_checks(bars),
        "inconsistent prices": profile.ohlc_violation_checks(bars),
        "quantiles": profile.numeric_quantiles(bars),
        "symbols": profile.symbol_count(bars),
        "rows per symbol": profile.rows_per_symbol_stats(bars),
        "top symbols": profile.top_symbols(bars),
        "short histories": profile.short_history_counts(bars),
        "days per symbol": profile.symbol_span_stats(bars),
        "rows per year": profile.rows_per_year(bars),
        "symbols per year": profile.active_symbols_per_year(bars),
    }


def split_reports(
    bars: DataFrame, min_rows: int = MIN_ROWS, train_end: str = TRAIN_END,
    val_end: str = VAL_END, minimums: dict[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Reports on targets and symbols per split, all from one stored frame."""
    labelled = stored(
        add_temporal_split(labelled_bars(bars, min_rows), train_end, val_end), "labelled")
    counts = coverage.symbol_split_counts(labelled)
    eligible = coverage.eligible_symbols(counts, minimums or SYMBOL_FEATURE_ROWS)
    return {
        "label distribution": labels.label_distribution(labelled),
        "label moments": labels.label_moments(labelled),
        "label summary": labels.label_summary_table(labelled),
        "binary balance": labels.binary_balance(labelled),
        "symbols per split": coverage.symbols_per_split(labelled),
        "overlap": coverage.symbol_overlap(counts),
        "new symbols": coverage.new_symbols(counts),
        "rows seen in train": coverage.rows_seen_in_train(counts),
        "rows per symbol": coverage.split_symbol_row_stats(labelled),
        "top symbols": coverage.top_symbols_by_split(labelled),
        "coverage by history": coverage.history_coverage(counts),
        "eligible": eligible,
        "eligible share": coverage.eligible_share(counts, minimums or SYMBOL_FEATURE_ROWS),
        "eligible statistics": coverage.eligible_stats(eligible),
        "eligible top": coverage.eligible_top(eligible),
        "eligible bottom": coverage.eligible_bottom(eligible),
    }
