"""Registered queries on ordered rows: as-of and range joins, sessions, streamed windows; their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from barforge.functions.storage import scratch_path
from barforge.operators.asof import asof_join
from barforge.operators.sessions import session_windows
from barforge.operators.spans import range_join
from barforge.sources import tables
from barforge.streaming.windows import windows_of_files
from registry.oracles import EVENT_BARS
from registry.queries import comparable

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_asof_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the close and volume of the last bar of its type that was complete by then."""
    bars = tables.event_bars(spark, sf_dir).select(
        F.col("Symbol").alias("event_type"), (F.col("Date") + F.expr("INTERVAL 1 HOUR")).alias("ts"), "Close", "Volume")
    events = _read(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    return comparable(asof_join(events, bars, "ts", ["event_type"]))


def previous_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its customer's last earlier order day within 120 days, and the largest price then."""
    orders = _read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    days = _read(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderdate").agg(F.max("o_totalprice").alias("price"))
    return comparable(asof_join(orders, days, "o_orderdate", ["o_custkey"], strict=True, tolerance="INTERVAL 120 DAYS"))


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer, order and the span from the first to the last shipment of an order's lines."""
    lines = _read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    orders = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer"))
    return lines.join(orders, "l_orderkey")


def overlapping_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of an order's first 30 days and a shipment span of the same customer that overlap."""
    orders = _read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer"), "o_orderkey", F.col("o_orderdate").alias("opened"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("closed"))
    pairs = range_join(orders, _shipments(spark, sf_dir), ("opened", "closed"), ("first_ship", "last_ship"), by=["customer"], closed=False)
    both = F.least("closed", "last_ship").cast("date"), F.greatest("opened", "first_ship").cast("date")
    return comparable(pairs.select("customer", "o_orderkey", "l_orderkey", F.datediff(*both).alias("days")))


def orders_in_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per supplier: orders placed within three days of its dearest line, and their value. No key joins them, only time."""
    lines = _read(spark, sf_dir, "lineitem")
    top = lines.groupBy("l_suppkey").agg(F.max_by("l_shipdate", F.struct("l_extendedprice", "l_shipdate")).alias("day"))
    spans = top.select("l_suppkey", *((F.col("day") + F.expr(f"INTERVAL {d} DAYS")).alias(n) for d, n in ((-3, "since"), (3, "until"))))
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    pairs = range_join(orders, spans, ("o_orderdate", "o_orderdate"), ("since", "until"))
    return comparable(pairs.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("value")), digits=2)


def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions per user: events not more than six hours apart."""
    events = _read(spark, sf_dir, "events").select("user_id", "ts", "value")
    return comparable(session_windows(events, ["user_id"], "ts", "INTERVAL 6 HOURS", [F.max("value").alias("top_value")]))


def _event_files(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The events as files of a folder, each a range of time; and what a stream of them looks like."""
    events = _read(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "user_id", "value")
    folder = scratch_path(spark, "event-files")
    events.repartitionByRange(6, "ts").write.parquet(folder)
    return folder, events


def _streamed(width: str, slide: str | None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder, events = _event_files(spark, sf_dir)
        # Files come in no certain order: the delay is longer than all they span, so that no row is late.
        windows = windows_of_files(
            spark, folder, events.schema, "ts", width, slide, ["event_type"],
            [F.max("value").alias("top_value"), F.count_if(F.col("value") > 10).alias("dear")], delay="3650 days", files_per_batch=2)
        ends = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
        return comparable(windows.select(*ends, *windows.columns[2:]))
    return query


QUERIES: dict[str, Query] = {
    "events_asof_bars": events_asof_bars,
    "previous_order": previous_order,
    "overlapping_spans": overlapping_spans,
    "orders_in_windows": orders_in_windows,
    "user_sessions": user_sessions,
    "streamed_tumbling": _streamed("1 day", None),
    "streamed_sliding": _streamed("12 hours", "4 hours"),
}

ORACLES: dict[str, str] = {
    "events_asof_bars": f"""SELECT event_id, event_type, e.ts, round(value, 6) AS value, b.ts AS ts_matched,
  round(b."Close", 6) AS "Close", round(b."Volume", 6) AS "Volume"
FROM events e ASOF LEFT JOIN (SELECT "Symbol", "Date" + INTERVAL 1 HOUR AS ts, "Close", "Volume" FROM ({EVENT_BARS}) x) b
  ON e.event_type = b."Symbol" AND e.ts >= b.ts""",
    "previous_order": """WITH days AS (SELECT o_custkey AS c, o_orderdate AS d, max(o_totalprice) AS price FROM orders GROUP BY ALL),
last AS (SELECT o_custkey, o_orderdate, o_orderkey, (SELECT max(d) FROM days WHERE c = o_custkey AND d < o_orderdate
  AND d >= o_orderdate - INTERVAL 120 DAYS) AS o_orderdate_matched FROM orders)
SELECT last.*, round(price, 6) AS price FROM last LEFT JOIN days ON c = o_custkey AND d = o_orderdate_matched""",
    "overlapping_spans": """WITH ships AS (SELECT o_custkey AS customer, l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL)
SELECT o_custkey AS customer, o_orderkey, l_orderkey,
  date_diff('day', greatest(o_orderdate, first_ship)::DATE, least(o_orderdate + INTERVAL 30 DAYS, last_ship)::DATE) AS days
FROM orders JOIN ships ON customer = o_custkey AND o_orderdate < last_ship AND first_ship < o_orderdate + INTERVAL 30 DAYS
WHERE first_ship < last_ship""",
    "orders_in_windows": """WITH top AS (SELECT l_suppkey, l_shipdate AS day FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_shipdate DESC) = 1)
SELECT l_suppkey, COUNT(*) AS orders, round(SUM(o_totalprice), 2) AS value FROM top JOIN orders
  ON o_orderdate BETWEEN day - INTERVAL 3 DAYS AND day + INTERVAL 3 DAYS GROUP BY l_suppkey""",
    "user_sessions": """WITH marked AS (SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 6 HOURS THEN 0 ELSE 1 END AS fresh FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM marked)
SELECT user_id, session, min(ts) AS session_start, max(ts) AS session_end, COUNT(*) AS n_events, round(max(value), 6) AS top_value
FROM numbered GROUP BY ALL""",
    "streamed_tumbling": """SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start, window_start + INTERVAL 1 DAY AS window_end,
  event_type, COUNT(*) AS n, round(max(value), 6) AS top_value, COUNT(*) FILTER (value > 10) AS dear FROM events GROUP BY ALL""",
    "streamed_sliding": """SELECT time_bucket(INTERVAL 4 HOURS, ts, TIMESTAMP '1970-01-01') - k * INTERVAL 4 HOURS AS window_start,
  window_start + INTERVAL 12 HOURS AS window_end, event_type, COUNT(*) AS n, round(max(value), 6) AS top_value,
  COUNT(*) FILTER (value > 10) AS dear FROM events, range(3) t(k) GROUP BY ALL""",
}
