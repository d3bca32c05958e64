"""Result and report files."""

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession


def write_results(results: DataFrame, output_dir: str, name: str = "results") -> str:
    """Write a leaderboard, as CSV in its order and as typed Parquet beside it.

    Results hold a row per grid point, so one file each is right. Returns the
    folder, named by the time and a random part, so that two jobs never share one.
    """
    stamp = datetime.now().strftime("%Y%m%d_%H%M%S")
    path = f"{output_dir}/{name}_{stamp}_{uuid.uuid4().hex[:8]}"
    results.coalesce(1).write.parquet(f"{path}/parquet")
    typed = results.sparkSession.read.parquet(f"{path}/parquet")
    typed.write.option("header", True).csv(f"{path}/csv")
    return path


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The CSV of a leaderboard with the column types of its Parquet twin."""
    schema = spark.read.parquet(f"{path}/parquet").schema
    return spark.read.schema(schema).option("header", True).csv(f"{path}/csv")


def write_table(table: DataFrame, path: str) -> None:
    """Write a list that grows with the data (eligible symbols, say) as CSV."""
    table.write.option("header", True).csv(path)


def write_names(names: DataFrame, path: str) -> None:
    """Write a one-column frame as lines of text."""
    names.write.text(path)


def read_names(spark: SparkSession, path: str, column: str = "file") -> DataFrame:
    """What ``write_names`` wrote."""
    return spark.read.text(path).withColumnRenamed("value", column)
