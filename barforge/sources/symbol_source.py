"""Symbol files as a partitioned source with filters pushed down to it.

``files.load_stock_data`` lists every file before it reads one. This source deals the listing out instead: it
plans one partition for each folder below its root (and one for the root's own files), each task lists its
folder, and opens only files whose symbol and dates can match. Files lie in folders of their
symbols' first characters, ``<root>/<a>/<symbol>.us.txt``, as ``write_partitioned_files`` writes them.

A filter on ``Symbol`` skips folders before anything is listed, and files before they are opened; a lower or upper bound of ``Date``
ends the reading of a file early, as its rows are in order of their dates (``sorted`` false: rows are only filtered).

The folder is one that all executors see as a path: a mounted store, or the shared folder of a cluster.
"""

import csv
import datetime as dt
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, StringStartsWith,
)

from barforge.constants import NUMERIC_COLUMNS, RAW_SCHEMA, SYMBOL_FILE_SUFFIX

SCHEMA = T.StructType([T.StructField("Symbol", T.StringType()), T.StructField("Date", T.TimestampNTZType()),
                       *(T.StructField(c, T.DoubleType()) for c in NUMERIC_COLUMNS), T.StructField("file", T.StringType())])
ROWS_AT_ONCE = 20_000


def _local(path: str) -> str:
    return path.removeprefix("file://") if path.startswith("file:///") else path.removeprefix("file:")


@dataclass(frozen=True)
class Wanted:
    """What pushed filters ask for; None: anything."""

    symbols: frozenset[str] | None = None
    prefixes: tuple[str, ...] = ()
    since: dt.datetime | None = None
    until: dt.datetime | None = None

    def folder(self, name: str, width: int) -> bool:
        """Whether a folder named after the first ``width`` characters of symbols can hold a match."""
        if self.symbols is not None and not any(folder_of(s, width) == name for s in self.symbols):
            return False
        return all(name.startswith(folder_of(p, width)[:len(p)]) or folder_of(p, width).startswith(name) for p in self.prefixes)

    def symbol(self, name: str) -> bool:
        return (self.symbols is None or name in self.symbols) and all(name.startswith(p) for p in self.prefixes)


def folder_of(symbol: str, width: int = 1) -> str:
    """Name of the folder of a symbol: its first characters, all but letters and digits written as ``_``."""
    return "".join(c if c.isascii() and c.isalnum() else "_" for c in symbol[:width].lower()) or "_"


@dataclass
class FolderPartition(InputPartition):
    folder: str = ""
    files: list[str] | None = field(default=None)  # those of the root itself; None: the task lists its folder

    def __init__(self, folder: str, files: list[str] | None = None):
        self.folder, self.files = folder, files


class SymbolReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = _local(options["path"])
        self.width = int(options.get("width", 1))
        self.sorted = str(options.get("sorted", "true")).lower() == "true"
        self.wanted = Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes what files can be chosen by. Spark goes on to apply every filter itself."""
        symbols, prefixes, since, until = None, [], None, None
        for f in filters:
            name = f.attribute if hasattr(f, "attribute") else ()
            if name == ("Symbol",) and isinstance(f, (EqualTo, In)):
                given = frozenset(v for v in (f.value if isinstance(f, In) else [f.value]) if v is not None)
                symbols = given if symbols is None else symbols & given
            elif name == ("Symbol",) and isinstance(f, StringStartsWith):
                prefixes.append(f.value)
            elif name == ("Date",) and isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)) and isinstance(f.value, dt.datetime):
                since = f.value if since is None else max(since, f.value)
            if name == ("Date",) and isinstance(f, (LessThan, LessThanOrEqual, EqualTo)) and isinstance(f.value, dt.datetime):
                until = f.value if until is None else min(until, f.value)
            yield f
        self.wanted = Wanted(symbols, tuple(prefixes), since, until)

    def partitions(self) -> Sequence[InputPartition]:
        """One per folder that can match; only the root's own entries are listed here."""
        folders, files = [], []
        with os.scandir(self.root) as entries:
            for e in entries:
                if e.is_dir() and self.wanted.folder(e.name, self.width):
                    folders.append(e.path)
                elif e.is_file() and e.name.endswith(SYMBOL_FILE_SUFFIX):
                    files.append(e.path)
        return [*(FolderPartition(f) for f in sorted(folders)), *([FolderPartition(self.root, sorted(files))] if files else [])] or [
            FolderPartition(self.root, [])]

    def read(self, partition: FolderPartition) -> Iterator[pa.RecordBatch]:
        paths = partition.files
        if paths is None:
            with os.scandir(partition.folder) as entries:
                paths = sorted(e.path for e in entries if e.is_file() and e.name.endswith(SYMBOL_FILE_SUFFIX))
        for path in paths:
            symbol = os.path.basename(path).removesuffix(SYMBOL_FILE_SUFFIX)
            if self.wanted.symbol(symbol):
                yield from self._file(path, symbol)

    def _file(self, path: str, symbol: str) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.timestamp("us"), *[pa.float64()] * len(NUMERIC_COLUMNS), pa.string()]
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=SCHEMA.names)

        with open(path, newline="", encoding="utf-8") as lines:
            reader = csv.reader(lines)
            head = next(reader, None)
            at = {name: head.index(name) for name in RAW_SCHEMA.names if name in head} if head else {}
            for cells in reader:
                told = {name: cells[i] if i < len(cells) else None for name, i in at.items()}
                date = _date(told.get("Date"))
                if date is not None:
                    if self.wanted.since is not None and date < self.wanted.since:
                        continue
                    if self.wanted.until is not None and date > self.wanted.until:
                        if self.sorted:
                            break
                        continue
                rows.append((symbol, date, *(_number(told.get(c)) for c in NUMERIC_COLUMNS), path))
                if len(rows) >= ROWS_AT_ONCE:
                    yield batch()
                    rows.clear()
        if rows:
            yield batch()


def _date(text: str | None) -> dt.datetime | None:
    """The date or time of a cell; None where there is none that can be read."""
    try:
        return dt.datetime.fromisoformat(text.strip()) if text else None
    except ValueError:
        return None


def _number(text: str | None) -> float | None:
    try:
        return float(text) if text and text.strip() else None
    except ValueError:
        return None


class SymbolSource(DataSource):
    """``spark.read.format("symbol_files").load(root)``; options ``width`` (of folder names) and ``sorted``."""

    @classmethod
    def name(cls) -> str:
        return "symbol_files"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> SymbolReader:
        return SymbolReader(self.options)


def read_symbol_files(spark: SparkSession, root: str, width: int = 1, sorted: bool = True) -> DataFrame:
    """Bars of all symbol files below ``root``, with the ``file`` each row is from; dates that cannot be read and numbers that are none are missing."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SymbolSource)
    return spark.read.format("symbol_files").option("width", width).option("sorted", str(sorted).lower()).load(root)


def write_partitioned_files(bars: DataFrame, root: str, width: int = 1) -> None:
    """Symbol files in folders of their symbols' first characters, rows in order of date; a missing symbol is an error.

    Tasks write the files themselves, each under a name of its own first, so a task that runs again replaces what it wrote.
    A symbol's file is written by one task, row by row.
    """
    bad = F.assert_true(F.col("Symbol").isNotNull(), F.lit("a bar has no symbol"))
    checked = bars.where(bad.isNull()).select("Symbol", F.date_format("Date", "yyyy-MM-dd HH:mm:ss").alias("Date"), *NUMERIC_COLUMNS)
    target = _local(root)
    os.makedirs(target, exist_ok=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, count = None, None, 0

        def close() -> None:
            if out is not None:
                out.close()
                os.replace(out.name, out.name.removesuffix(f".{os.getpid()}.part"))

        for batch in batches:
            for row in batch.to_pylist():
                if row["Symbol"] != now:
                    close()
                    now, count = row["Symbol"], count + 1
                    folder = os.path.join(target, folder_of(now, width))
                    os.makedirs(folder, exist_ok=True)
                    out = open(os.path.join(folder, f"{now}{SYMBOL_FILE_SUFFIX}.{os.getpid()}.part"), "w", newline="", encoding="utf-8")
                    writer = csv.writer(out)
                    writer.writerow(["Date", *NUMERIC_COLUMNS])
                writer.writerow(["" if row["Date"] is None else row["Date"].removesuffix(" 00:00:00"),
                                 *("" if row[c] is None else repr(row[c]) for c in NUMERIC_COLUMNS)])
        close()
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["files"])

    checked.repartition("Symbol").sortWithinPartitions("Symbol", "Date", *NUMERIC_COLUMNS).mapInArrow(write, "files bigint").agg(F.sum("files")).collect()
