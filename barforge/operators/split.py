"""Temporal and hash-based splits, as one column instead of three frames."""

from pyspark.sql import Column, DataFrame, functions as F

from barforge.constants import TRAIN_END, VAL_END


def add_temporal_split(
    df: DataFrame, train_end: str = TRAIN_END, val_end: str = VAL_END
) -> DataFrame:
    """Tag rows train / validation / test by half-open date ranges.

    Rows without a date belong to no split and are dropped. Windows must be
    computed before: a date filter below them would cut their frames.
    """
    kind = df.schema["Date"].dataType
    first_val, first_test = (F.lit(day).cast(kind) for day in (train_end, val_end))
    split = (
        F.when(F.col("Date") < first_val, "train")
        .when(F.col("Date") < first_test, "validation")
        .when(F.col("Date") >= first_test, "test")
    )
    return df.withColumn("split", split).where(F.col("split").isNotNull())


def hash_bucket(key: Column, buckets: int) -> Column:
    """Bucket of a key from the first 16 bits of its MD5: the same on any cluster."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 4), 16, 10).cast("bigint") % buckets


def row_key() -> Column:
    """Text key of a bar: symbol and day."""
    return F.concat_ws("|", "Symbol", F.date_format("Date", "yyyy-MM-dd"))


def add_hash_split(df: DataFrame, train_tenths: int = 8) -> DataFrame:
    """Tag rows train / test in tenths by key.

    ``randomSplit`` depends on how rows lie in partitions, so a retried or
    re-partitioned scan changes it; a hash of the key does not.
    """
    return df.withColumn(
        "split", F.when(hash_bucket(row_key(), 10) < train_tenths, "train").otherwise("test"))


def add_fold(df: DataFrame, folds: int) -> DataFrame:
    """Cross-validation fold by key, independent of the hash split."""
    salted = F.concat(F.lit("fold|"), row_key())
    return df.withColumn("fold", hash_bucket(salted, folds).cast("int"))
