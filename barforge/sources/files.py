"""Per-symbol text files of bars: ``<symbol>.us.txt``, one file per symbol.

A symbol's data may also be a folder of that name holding part files, which is
how ``write_symbol_files`` lays it out, so that many tasks can write one symbol.
"""

import os
import re
import shutil
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from barforge.constants import NUMERIC_COLUMNS, RAW_SCHEMA, SYMBOL_FILE_SUFFIX
from barforge.operators.clean import drop_null_prices

# --- fixed values: file names ------------------------------------------------------
# An optional folder of part files follows the name; "file=" is its partition key.
FILE_PATTERN = r"(?:^|/)(?:file=)?([^/]+\.txt)(?:/[^/]+)?$"
PARTITION_PATTERN = r"(?:^|/)file=[^/]+/[^/]+$"
# Possessive: "file=" is never part of a symbol.
SYMBOL_PATTERN = r"(?:^|/)(?:file=)?+([^/]+)\.us\.txt(?:/[^/]+)?$"


def _decoded(text: Column) -> Column:
    # A plus sign is not encoded in paths but would decode to a blank.
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def file_path(path: str = "_metadata.file_path") -> Column:
    """The path of the row's file as written; Spark gives it URL-encoded.

    Names of partition folders are encoded once more when they are written. Both
    decodings are asked for with every row: a path without a percent sign skips them.
    """
    plain = _decoded(F.col(path))
    decoded = F.when(plain.rlike(PARTITION_PATTERN), _decoded(plain)).otherwise(plain)
    return F.when(F.contains(F.col(path), F.lit("%")), decoded).otherwise(F.col(path))


def _name_and_part(path: Column) -> Column:
    # Both patterns span two names at most; a search through the whole path is slow.
    return F.substring_index(path, "/", -2)


def symbol_of(path: Column) -> Column:
    """Symbol from a file path; an empty string for other names."""
    return F.regexp_extract(_name_and_part(path), SYMBOL_PATTERN, 1)


def file_name_of(path: Column) -> Column:
    return F.regexp_extract(_name_and_part(path), FILE_PATTERN, 1)


def parse_dates(df: DataFrame) -> DataFrame:
    """Text dates to timestamps; what is not a date becomes NULL."""
    return df.withColumn("Date", F.try_to_timestamp("Date"))


def coerce_numeric(df: DataFrame, columns=tuple(NUMERIC_COLUMNS)) -> DataFrame:
    """Text numbers to doubles; what is not a number becomes NULL."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS double)") for c in columns})


# --- fixed value: listing --------------------------------------------------------------
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def listing_tasks(spark: SparkSession, per_core: int = 4) -> Iterator[None]:
    """Readers made inside list folders in a few tasks a core, each many folders.

    By default each of up to 10,000 folders is listed by a task of its own, which
    takes longer to start than to run.
    """
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(before), per_core * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before)


def load_stock_data(spark: SparkSession, data_dir: str) -> DataFrame:
    """All symbol files of a folder as one frame with Symbol and parsed Date.

    The schema is given, so nothing is read to infer it; small files are packed
    into tasks by the scan. Rows without prices are dropped.
    """
    with listing_tasks(spark):
        rows = spark.read.schema(RAW_SCHEMA).option("header", True).csv(f"{data_dir}/*.txt")
    named = rows.withColumn("Symbol", symbol_of(file_path()))
    return parse_dates(drop_null_prices(named))


def text_rows(spark: SparkSession, data_dir: str) -> DataFrame:
    """Every column read as text, with the ``file`` and Symbol of each row."""
    text = StructType([StructField(f.name, StringType()) for f in RAW_SCHEMA.fields])
    with listing_tasks(spark):
        rows = spark.read.schema(text).option("header", True).csv(f"{data_dir}/*.txt")
    return rows.select(*text.fieldNames(), file_name_of(file_path()).alias("file"),
                       symbol_of(file_path()).alias("Symbol"))


def load_text_bars(spark: SparkSession, data_dir: str) -> DataFrame:
    """The lenient form: every column read as text, then dates and numbers
    converted where they can be."""
    return coerce_numeric(parse_dates(text_rows(spark, data_dir).drop("file")))


def write_symbol_files(bars: DataFrame, data_dir: str, columns: list[str] | None = None,
                       mode: str = "error") -> None:
    """Write bars as one ``<symbol>.us.txt`` per symbol.

    Fails on a missing or empty symbol, which no file can be named after, and by
    default where the folder exists; ``mode`` may be "overwrite" or "append". Dates at
    midnight are written as days, others with their time. The rebalance hint gathers
    each symbol's rows into few tasks and splits the symbols that are too large for one.
    On file systems opened by path, tasks write the files themselves; other stores go through Spark's writer.
    """
    columns = columns or RAW_SCHEMA.fieldNames()
    nameless = F.col("Symbol").isNull() | (F.trim("Symbol") == "")
    day = F.date_trunc("day", "Date") == F.col("Date")
    text = bars.withColumns({
        "file": F.when(nameless, F.raise_error(F.lit("a bar has no symbol to name its file after")))
        .otherwise(F.concat("Symbol", F.lit(SYMBOL_FILE_SUFFIX))),
        "Date": F.when(day, F.date_format("Date", "yyyy-MM-dd")).otherwise(
            F.date_format("Date", "yyyy-MM-dd HH:mm:ss.SSSSSS")),
    }).select(*columns, "file")
    rows = text.hint("rebalance", "file")
    folder = _local_folder(bars.sparkSession, data_dir)
    if folder is None or mode not in ("error", "append") or not all(re.fullmatch(r"\w+", c) for c in columns):
        rows.write.mode(mode).option("header", True).partitionBy("file").csv(data_dir)
        return
    # Makes the folder, or refuses to.
    text.limit(0).write.mode(mode).option("header", True).partitionBy("file").csv(data_dir)
    _write_local(rows.select("file", F.to_csv(F.struct(*columns)).alias("line")), folder, ",".join(columns))


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """The path by which a file system mounted on all machines is opened; None for other stores."""
    context = spark.sparkContext
    named = context._jvm.org.apache.hadoop.fs.Path(path)
    uri = named.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(named).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _partition_folder(file: str) -> str:
    """The folder's name as Spark's writers give it."""
    return "file=" + re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", file)


def _write_local(rows: DataFrame, folder: str, header: str) -> None:
    """``line``s of each ``file`` below a folder that all executors see, laid out as by Spark's writer.

    That one starts two processes a file on such a folder, to set permissions, which takes far longer than writing
    a symbol's lines. Tasks write below a hidden folder of their attempt; when all are done, files of the
    attempts that succeeded are moved to their places.
    """
    job = uuid.uuid4().hex
    hidden = os.path.join(folder, f"_temporary-{job}")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        own = os.path.join(hidden, f"{task.partitionId()}-{task.taskAttemptId()}")
        part, now, out = f"part-{task.partitionId():05d}-{job}.csv", None, None
        for batch in batches:
            lines, at = batch.column(1).to_pylist(), 0
            for file, same in groupby(batch.column(0).to_pylist()):
                end = at + sum(1 for _ in same)
                if file != now:
                    if out:
                        out.close()
                    os.makedirs(target := os.path.join(own, _partition_folder(file)))
                    now, out = file, open(os.path.join(target, part), "w", newline="", encoding="utf-8")
                    out.write(header + "\n")
                out.write("\n".join(lines[at:end]) + "\n")
                at = end
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"attempt": [own]})

    try:
        for attempt, in rows.sortWithinPartitions("file").mapInArrow(write, "attempt string").collect():
            for name in os.listdir(attempt):
                source, target = os.path.join(attempt, name), os.path.join(folder, name)
                if os.path.isdir(target):
                    for part in os.listdir(source):
                        os.replace(os.path.join(source, part), os.path.join(target, part))
                else:
                    os.rename(source, target)
    finally:
        shutil.rmtree(hidden, ignore_errors=True)


def file_date_ranges(rows: DataFrame, file: str = "file") -> DataFrame:
    """First and last date of each file."""
    return rows.groupBy(file).agg(
        F.min("Date").alias("first_date"), F.max("Date").alias("last_date"))
