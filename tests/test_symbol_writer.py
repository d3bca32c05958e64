import os

import pytest
from pyspark.sql import functions as F

from barforge.sources import files
from tests.bars import frame, random_bars


def contents(root):
    """Header and sorted lines by folder."""
    told = {}
    for name in os.listdir(root):
        if name.startswith("file="):
            parts = [open(f"{root}/{name}/{p}").read().splitlines() for p in os.listdir(f"{root}/{name}") if p.endswith(".csv")]
            told[name] = ({p[0] for p in parts}, sorted(line for p in parts for line in p[1:]))
    return told


@pytest.fixture
def bars(spark):
    odd = {"a b": 30, "x=y": 3, 'q"%/:#[z]{^': 2, "c+d": 4, "ü*?'": 1}
    df = frame(spark, random_bars(odd, seed=2))
    return df.withColumns({"Open": F.when(F.col("Volume") > 300, F.col("Open")), "Volume": F.col("Volume") * 1e9})


def test_tasks_write_what_sparks_writer_writes(spark, bars, tmp_path, monkeypatch):
    written, real = [], files._write_local
    monkeypatch.setattr(files, "_write_local", lambda rows, folder, header: written.append(folder) or real(rows, folder, header))
    files.write_symbol_files(bars, f"file:{tmp_path}/own")
    assert written == [f"{tmp_path}/own"]
    monkeypatch.setattr(files, "_local_folder", lambda spark, path: None)
    files.write_symbol_files(bars, f"{tmp_path}/sparks")
    assert contents(f"{tmp_path}/own") == contents(f"{tmp_path}/sparks") and len(contents(f"{tmp_path}/own")) == 5
    assert not [n for n in os.listdir(f"{tmp_path}/own") if n.startswith("_temporary")]
    assert files.load_stock_data(spark, f"{tmp_path}/own").count() == files.load_stock_data(spark, f"{tmp_path}/sparks").count()


def test_appended_rows_join_those_of_their_symbol(spark, tmp_path):
    df = frame(spark, random_bars({"a": 10, "b": 5}))
    for mode, half in (("error", "a"), ("append", "ab"), ("append", "c")):
        files.write_symbol_files(df.where(F.col("Symbol").isin(*half)), f"{tmp_path}/out", mode=mode)
    assert {n: len(lines) for n, (_, lines) in contents(f"{tmp_path}/out").items()} == {"file=a.us.txt": 20, "file=b.us.txt": 5}


def test_a_failed_job_leaves_no_files(spark, tmp_path):
    df = frame(spark, random_bars({"a": 10, "b": 5})).withColumn(
        "Symbol", F.when((F.col("Symbol") == "a") | (F.col("Volume") < 500), F.col("Symbol")))
    with pytest.raises(Exception, match="no symbol"):
        files.write_symbol_files(df, f"{tmp_path}/out")
    assert contents(f"{tmp_path}/out") == {} and not [n for n in os.listdir(f"{tmp_path}/out") if n.startswith("_temp")]
