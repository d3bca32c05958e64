"""The partitioned source of symbol files: same rows as the bulk scan, fewer files opened."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan, StringStartsWith

from barforge.sources.symbol_source import SymbolReader, folder_of, read_symbol_files, write_partitioned_files
from tests.bars import frame, random_bars


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = f"{tmp_path_factory.mktemp('bars')}/files"
    write_partitioned_files(frame(spark, random_bars({"aa": 40, "ab": 30, "b": 20, "c-1": 10, "Zed": 5})), folder)
    return folder


def rows(df):
    return sorted((r.Symbol, r.Date, r.Open, r.High, r.Low, r.Close, r.Volume, r.OpenInt) for r in df.collect())


def test_all_rows_come_back(spark, root):
    want = frame(spark, random_bars({"aa": 40, "ab": 30, "b": 20, "c-1": 10, "Zed": 5}))
    got = read_symbol_files(spark, root)
    assert rows(got) == rows(want.withColumn("Date", F.col("Date").cast("timestamp_ntz")))
    assert sorted(os.listdir(root)) == ["a", "b", "c", "z"] and sorted(os.listdir(f"{root}/a")) == ["aa.us.txt", "ab.us.txt"]
    assert got.rdd.getNumPartitions() == 4


def opened(reader):
    """Paths that a read of all partitions opens."""
    paths = set()
    for p in reader.partitions():
        for batch in reader.read(p):
            paths |= set(batch.column("file").to_pylist())
    return {os.path.basename(p).split(".")[0] for p in paths}


@pytest.mark.parametrize("filters,folders,files", [
    ([], 4, {"aa", "ab", "b", "c-1", "Zed"}),
    ([EqualTo(("Symbol",), "ab")], 1, {"ab"}),
    ([In(("Symbol",), ("ab", "b", None))], 2, {"ab", "b"}),
    ([EqualTo(("Symbol",), "ab"), EqualTo(("Symbol",), "b")], 1, set()),
    ([StringStartsWith(("Symbol",), "a")], 1, {"aa", "ab"}),
    ([StringStartsWith(("Symbol",), "aa")], 1, {"aa"}),
    ([EqualTo(("Symbol",), "nobody")], 1, set()),
    ([LessThan(("Date",), dt.datetime(2014, 1, 1))], 4, set()),
    ([GreaterThanOrEqual(("Date",), dt.datetime(2014, 7, 25))], 4, {"aa", "ab"}),
])
def test_filters_choose_folders_and_files(root, filters, folders, files):
    reader = SymbolReader({"path": root})
    assert list(reader.pushFilters(filters)) == filters  # Spark applies them again
    partitions = reader.partitions()
    assert len(partitions) == max(1, folders) and opened(reader) >= files
    if files or not any(f for f in filters if f.attribute == ("Date",)):
        assert opened(reader) == files or filters[0].attribute == ("Date",)


def test_filtered_reads_equal_filtered_rows(spark, root):
    every = read_symbol_files(spark, root).toPandas()
    cut = pd.Timestamp("2014-07-01")
    for condition, keep in (("Symbol = 'ab'", every.Symbol == "ab"), ("Symbol in ('b', 'Zed') and Date >= timestamp_ntz'2014-06-05'",
                            every.Symbol.isin(["b", "Zed"]) & (every.Date >= "2014-06-05")),
                            (f"Date < timestamp_ntz'{cut}'", every.Date < cut), ("Symbol like 'a%' and Close > 50", every.Symbol.str.startswith("a") & (every.Close > 50))):
        got = read_symbol_files(spark, root).where(condition)
        assert got.count() == keep.sum() > 0, condition


def test_odd_files(spark, tmp_path):
    os.makedirs(f"{tmp_path}/x")
    files = {"x/empty.us.txt": "", "x/x1.us.txt": "Date,Open,High,Low,Close,Volume,OpenInt\n",
             "x/x2.us.txt": "Close,Date,Open\n1.5,2020-01-02,n/a\nbad,no date,2\n7\n", "x/readme.md": "?", "root.us.txt": "Date,Open\n2020-01-01,3\n"}
    for name, text in files.items():
        with open(f"{tmp_path}/{name}", "w") as f:
            f.write(text)
    got = sorted((tuple(r[:3]) + (r.Close,) for r in read_symbol_files(spark, str(tmp_path)).collect()), key=str)
    day = dt.datetime(2020, 1, 2)
    assert got == sorted([("x2", day, None, 1.5), ("x2", None, 2.0, None), ("x2", None, None, 7.0), ("root", dt.datetime(2020, 1, 1), 3.0, None)], key=str)
    os.makedirs(f"{tmp_path}/none")
    assert read_symbol_files(spark, f"{tmp_path}/none").collect() == []
    assert folder_of("É5") == "_" and folder_of("brk.b", 4) == "brk_" and folder_of("") == "_"


def test_a_bar_without_symbol_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="no symbol"):
        write_partitioned_files(frame(spark, random_bars({"a": 3})).withColumn("Symbol", F.lit(None).cast("string")), f"{tmp_path}/out")
