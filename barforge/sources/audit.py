"""Which files of a folder hold usable bars, from names and text lines."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from barforge.functions.history import lookup
from barforge.functions.storage import stored
from barforge.sources.files import (
    coerce_numeric, file_name_of, file_path, listing_tasks, parse_dates, text_rows,
)


def file_audit(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per file: status and number of data rows.

    ``empty``: no bytes or a header only. ``incoherent``: another header than the
    alphabetically first file with data. ``unreadable``: a line with more fields
    than the header. ``ok``: the rest.
    """
    with listing_tasks(spark):
        lines = spark.read.text(f"{data_dir}/*.txt")
    # No scan has rows of files without bytes; their names come from the listing that the
    # scan's planning has made on the driver. It holds one path per file, that is, per
    # symbol or part of a symbol, and no content: this is its bound.
    names = spark.createDataFrame(pa.table({"path": pa.array(lines.inputFiles(), pa.string())}))
    files = names.select(file_name_of(file_path("path")).alias("file")).distinct()

    fields = F.size(F.split("value", ","))
    # A part file begins at block offset 0; the first line read from it is its header.
    lines = lines.where(F.trim("value") != "").select(
        file_name_of(file_path()).alias("file"), file_path().alias("path"), "value",
        fields.alias("fields"), F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("line"))
    position = F.struct("offset", "line")
    parts = lines.groupBy("file", "path").agg(
        F.min_by("value", position).alias("header"),
        F.max("fields").alias("most_fields"), (F.count(F.lit(1)) - 1).alias("rows"))
    # A row per file, asked twice: stored, so that the lines are read once.
    found = stored(parts.groupBy("file").agg(
        F.min("header").alias("header"), F.max("header").alias("other_header"),
        F.max("most_fields").alias("most_fields"), F.sum("rows").alias("rows")), "found")
    # One value: the header all files should have.
    expected = found.where(F.col("rows") > 0).agg(F.min_by("header", "file")).scalar()
    status = (
        F.when(F.coalesce("rows", F.lit(0)) == 0, "empty")
        .when(F.col("most_fields") > F.size(F.split("header", ",")), "unreadable")
        .when((F.col("header") != expected) | (F.col("other_header") != expected), "incoherent")
        .otherwise("ok")
    )
    return files.join(found, "file", "left").select(
        "file", status.alias("status"), F.coalesce("rows", F.lit(0)).alias("rows"))


def incoherent_files(audit: DataFrame) -> DataFrame:
    """Names of the files left out for their content, as the report lists them."""
    return audit.where(F.col("status").isin("incoherent", "unreadable")).select("file")


def load_coherent_bars(spark: SparkSession, data_dir: str, audit: DataFrame | None = None) -> DataFrame:
    """Bars of the files whose audit is ``ok``, with the ``file`` of each row.

    Empty, unreadable and incoherent files are left out whole: their columns may
    stand in another order. Of the rest, what is no date or number is NULL.
    ``audit`` may hand over an audit made before.
    """
    audited = stored(file_audit(spark, data_dir), "audit") if audit is None else audit
    usable = audited.where("status = 'ok'").select("file")
    rows = text_rows(spark, data_dir).join(lookup(usable), "file", "left_semi")
    return coerce_numeric(parse_dates(rows))
