import pandas as pd
import pytest
from pyspark.sql import functions as F

from barforge.plans import exploration
from barforge.sources import audit, files, results
from barforge.functions.storage import scratch_path, stored
from registry import queries
from tests.bars import frame, random_bars, rows

HEADER = "Date,Open,High,Low,Close,Volume,OpenInt"


@pytest.fixture
def folder(tmp_path):
    contents = {
        "a b.us.txt": f"{HEADER}\n2010-01-04,1,2,0.5,1.5,100,0\n2010-01-05,1,2,0.5,1.6,110,0\n",
        "c+d%.us.txt": f"{HEADER}\n2011-02-03,1,2,0.5,x,100,0\nno date,1,2,0.5,1.5,abc,0\n",
        "empty.us.txt": "",
        "header.us.txt": f"{HEADER}\n",
        "other.us.txt": "Open,Date,High,Low,Close,Volume,OpenInt\n1,2010-01-04,2,0.5,1.5,100,0\n",
        "wide.us.txt": f"{HEADER}\n2010-01-04,1,2,0.5,1.5,100,0\n2010-01-05,1,2,3,4,5,6,7\n",
    }
    for name, text in contents.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_audit(spark, folder):
    got = {r.file: (r.status, r.rows) for r in audit.file_audit(spark, folder).collect()}
    assert got == {
        "a b.us.txt": ("ok", 2), "c+d%.us.txt": ("ok", 2), "empty.us.txt": ("empty", 0),
        "header.us.txt": ("empty", 0), "other.us.txt": ("incoherent", 1),
        "wide.us.txt": ("unreadable", 2)}
    named = audit.incoherent_files(audit.file_audit(spark, folder))
    assert sorted(r.file for r in named.collect()) == ["other.us.txt", "wide.us.txt"]


def test_lenient_load_takes_symbols_from_names(spark, folder):
    df = files.load_text_bars(spark, folder).where(F.col("Symbol").isin("a b", "c+d%"))
    got = rows(df.orderBy("Symbol", "Date"), "Symbol", "Open")
    assert got["Symbol"].tolist() == ["a b", "a b", "c+d%", "c+d%"]
    assert got["Date"].isna().sum() == 1 and got["Close"].isna().sum() == 1
    assert got["Volume"].isna().sum() == 1
    ranges = {r.file: r.first_date for r in files.file_date_ranges(df, "Symbol").withColumnRenamed(
        "Symbol", "file").collect()}
    assert ranges["c+d%"] == pd.Timestamp("2011-02-03")


def test_coherent_load_leaves_bad_files_out(spark, folder):
    df = audit.load_coherent_bars(spark, folder)
    assert set(df.columns) == {*HEADER.split(","), "Symbol", "file"}
    got = {r.file: r["count"] for r in df.groupBy("file").count().collect()}
    assert got == {"a b.us.txt": 2, "c+d%.us.txt": 2}
    ranges = {r.file: (r.first_date, r.last_date) for r in files.file_date_ranges(df).collect()}
    assert ranges["a b.us.txt"] == (pd.Timestamp("2010-01-04"), pd.Timestamp("2010-01-05"))


def test_plans_write_their_lists(spark, folder, tmp_path):
    bars = exploration.load_and_report(spark, folder, f"{tmp_path}/out")
    assert bars.count() == 4
    names = results.read_names(spark, f"{tmp_path}/out/incoherent_files")
    assert sorted(r.file for r in names.collect()) == ["other.us.txt", "wide.us.txt"]


def test_symbol_files_keep_times_and_refuse_what_they_cannot_keep(spark, tmp_path):
    bars = spark.sql("""SELECT 's' AS Symbol, d AS Date, 1.0D AS Open, 1.0D AS High, 1.0D AS Low, 1.0D AS Close,
        1.0D AS Volume, 0.0D AS OpenInt FROM VALUES (TIMESTAMP'2020-01-02 09:30:00'), (TIMESTAMP'2020-01-02 10:30:00.25'),
        (TIMESTAMP'2020-01-03 00:00:00'), (NULL) t(d)""")
    files.write_symbol_files(bars, f"{tmp_path}/a")
    back = files.load_stock_data(spark, f"{tmp_path}/a")
    assert sorted(map(str, (r.Date for r in back.collect()))) == sorted(map(str, (r.Date for r in bars.collect())))
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        files.write_symbol_files(bars, f"{tmp_path}/a")
    files.write_symbol_files(bars, f"{tmp_path}/a", mode="overwrite")
    assert files.load_stock_data(spark, f"{tmp_path}/a").count() == 4
    for name in (None, "", " "):
        bad = bars.withColumn("Symbol", F.lit(name).cast("string"))
        with pytest.raises(Exception, match="no symbol"):
            files.write_symbol_files(bad, f"{tmp_path}/b{name}")


def test_bulk_load_drops_rows_without_prices(spark, folder):
    df = files.load_stock_data(spark, folder).where("Symbol = 'c+d%'")
    row = df.first()
    assert df.count() == 1 and row.Date is None and row.Volume is None and row.Close == 1.5


def test_symbol_of_other_names(spark):
    paths = ["file:/x/ge.us.txt", "file:/x/file=ge.us.txt/part-0.csv", "file:/x/ge.txt", "ge.us.txt",
             "file:/x/file=.us.txt/part-0.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(files.symbol_of(F.col("p"))).collect()] == [
        "ge", "ge", "", "ge", ""]


def test_symbol_files_round_trip(spark, tmp_path):
    pdf = random_bars({"a b": 30, "x=y": 20})
    files.write_symbol_files(frame(spark, pdf), f"{tmp_path}/out")
    got = rows(files.load_stock_data(spark, f"{tmp_path}/out"), "Symbol", "Date")
    want = pdf.sort_values(["Symbol", "Date"]).reset_index(drop=True)
    assert got["Symbol"].tolist() == want["Symbol"].tolist()
    pd.testing.assert_series_equal(got["Close"], want["Close"])
    assert set(r.status for r in audit.file_audit(spark, f"{tmp_path}/out").collect()) == {"ok"}


def test_results_keep_their_order(spark, tmp_path):
    df = spark.createDataFrame([("m", i, float(i)) for i in range(20)],
                               "model_name string, grid_index int, val_f1 double")
    path = results.write_results(df.orderBy(F.desc("val_f1")), str(tmp_path))
    back = results.read_results(spark, path)
    assert back.schema == df.schema
    assert [r.grid_index for r in back.collect()] == list(range(19, -1, -1))
    results.write_names(df.select("model_name"), f"{tmp_path}/names")
    results.write_table(df, f"{tmp_path}/table")
    assert spark.read.text(f"{tmp_path}/names").count() == 20
    assert spark.read.option("header", True).csv(f"{tmp_path}/table").columns == df.columns


class Session:
    """The two things the scratch folder is taken from."""

    def __init__(self, configured, master, checkpoint=None):
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}
        self.sparkContext = self
        self.master = master
        self.getCheckpointDir = lambda: checkpoint


def test_scratch_folder_is_the_configured_one():
    cluster = "spark://host:7077"
    assert scratch_path(Session("/shared/x/", cluster), "t").startswith("/shared/x/t-")
    assert scratch_path(Session(None, cluster, "/shared/y"), "t").startswith("/shared/y/t-")
    for master in (cluster, "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(Session(None, master), "t")


def test_a_local_session_keeps_its_checkpoint_folder(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "t").rsplit("/", 1)[0] == scratch_path(spark, "u").rsplit("/", 1)[0]
    assert spark.sparkContext.getCheckpointDir() == before


def test_stored_table_prunes_by_split(spark):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 3, "test").otherwise("train"))
    kept = stored(df, "t", partition_by="split")
    assert kept.where("split = 'test'").count() == 3 and kept.count() == 10
    plan = kept.where("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_audit_reads_the_lines_once(spark, folder, monkeypatch):
    names = []
    monkeypatch.setattr(audit, "stored", lambda df, name: names.append(name) or stored(df, name))
    plan = audit.file_audit(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert names == ["found"] and "Relation [value" not in plan and " text" not in plan


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    files.write_symbol_files(frame(spark, random_bars({f"s{i}": 2 for i in range(40)})), f"{tmp_path}/out")
    context, before = spark.sparkContext, spark.conf.get(files.LISTING)
    for i, load in enumerate((files.load_stock_data, files.text_rows, audit.file_audit)):
        context.setJobGroup(f"listing {i}", "")
        load(spark, f"{tmp_path}/out")
        tracker = context.statusTracker()
        first = min(tracker.getJobIdsForGroup(f"listing {i}"))
        tasks = sum(tracker.getStageInfo(s).numTasks for s in tracker.getJobInfo(first).stageIds)
        assert tasks <= 4 * context.defaultParallelism < 40
    context.setJobGroup("", "")
    assert spark.conf.get(files.LISTING) == before


def test_names_are_decoded_only_where_they_are_encoded(spark):
    paths = ["file:/x/a%20b/file=c+d%2525.us.txt/part-0.csv", "file:/x/a%20b.us.txt", "file:/x/c+d.us.txt",
             "file:/x/y.txt/z.us.txt", "file:/x/y.us.txt/part.csv/more", None]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(files.file_path("p").alias("p"))
    got = df.select("p", files.file_name_of(F.col("p")), files.symbol_of(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [
        ("file:/x/a b/file=c+d%.us.txt/part-0.csv", "c+d%.us.txt", "c+d%"), ("file:/x/a b.us.txt", "a b.us.txt", "a b"),
        ("file:/x/c+d.us.txt", "c+d.us.txt", "c+d"), ("file:/x/y.txt/z.us.txt", "y.txt", "z"),
        ("file:/x/y.us.txt/part.csv/more", "", ""), (None, None, None)]


def test_the_audited_folder_reads_its_lines_once(spark, tmp_path, monkeypatch):
    spark.sql("""SELECT id AS l_orderkey, id % 3 AS l_suppkey, id AS l_partkey, 1 AS l_linenumber, 2.0D AS l_quantity,
        3.0D AS l_extendedprice, date'2020-01-01' AS l_shipdate FROM range(9)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT id AS s_suppkey, id - 1.0D AS s_acctbal FROM range(3)").write.parquet(f"{tmp_path}/supplier.parquet")
    names = []
    monkeypatch.setattr(queries, "stored", lambda df, name: names.append(name) or stored(df, name))
    folder = queries.audited_folder(spark, str(tmp_path))
    assert names == ["audited-bars"]
    got = {r.file: r.status for r in audit.file_audit(spark, folder).collect()}
    assert got == {"0.us.txt": "incoherent", "1.us.txt": "ok", "2.us.txt": "ok"} or got == {
        "0.us.txt": "ok", "1.us.txt": "incoherent", "2.us.txt": "incoherent"}
