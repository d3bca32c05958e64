"""Forward-return targets."""

from pyspark.sql import DataFrame, WindowSpec, functions as F

from barforge.constants import HORIZON


def add_log_return(df: DataFrame, window: WindowSpec, horizon: int = HORIZON) -> DataFrame:
    """Log return to the close ``horizon`` rows ahead; NULL in the last rows."""
    future = F.lead("Close", horizon).over(window)
    return df.withColumn(f"LogReturn{horizon}", F.log(F.try_divide(future, F.col("Close"))))


def add_binary_label(df: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """1.0 for a return above zero, else 0.0 - also where there is no return."""
    return df.withColumn(
        "label_bin", F.when(F.col(f"LogReturn{horizon}") > 0, 1.0).otherwise(0.0))


def add_target_variable(df: DataFrame, window: WindowSpec, horizon: int = HORIZON) -> DataFrame:
    return add_binary_label(add_log_return(df, window, horizon), horizon)
