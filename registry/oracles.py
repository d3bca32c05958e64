"""The registered queries as SQL over the same tables, written independently."""

import math

# Feature names, in the order of the vectors.
FEATURES = [
    "DateMonthSin", "DateMonthCos", "DateDaySin", "DateDayCos", "DayOfWeekSin", "DayOfWeekCos",
    "ret_1", "ret_2", "ret_5", "ret_10", "ret_20", "ret_40",
    "vol_5", "vol_10", "vol_20", "vol_ratio_5_20",
    "ma_ratio_5", "ma_ratio_10", "ma_ratio_20", "ma_ratio_60",
    "intraday_range", "open_close_change", "high_close_ratio", "close_low_ratio", "gap_open",
    "volume_ratio_10", "volume_ratio_20", "volume_change_1", "log_volume",
    "drawdown_10", "drawdown_20", "close_to_max_20", "close_to_min_20",
]
LEGACY = FEATURES[:4] + ["PastReturn3", "PastReturn5", "PastReturn10"]
NUMBERS = ["Open", "High", "Low", "Close", "Volume", "OpenInt"]

# --- inputs ------------------------------------------------------------------------


def _line_bars(symbol: str) -> str:
    return f"""
SELECT sym AS "Symbol", l_shipdate AS "Date",
  MAX(CASE WHEN rn = 1 THEN l_extendedprice END) AS "Open", MAX(l_extendedprice) AS "High",
  MIN(l_extendedprice) AS "Low", MAX(CASE WHEN rn = n THEN l_extendedprice END) AS "Close",
  SUM(CASE WHEN l_orderkey % 89 = 0 THEN 0.0 ELSE l_quantity END) AS "Volume",
  CAST(0 AS DOUBLE) AS "OpenInt"
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sym, l_shipdate
               ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) rn,
        COUNT(*) OVER (PARTITION BY sym, l_shipdate) n
      FROM (SELECT *, {symbol} AS sym FROM lineitem) l) x
GROUP BY sym, l_shipdate"""


BARS = _line_bars("CAST(l_suppkey AS VARCHAR)")
CLASS_BARS = _line_bars("CAST(l_suppkey AS VARCHAR) || '-' || l_returnflag || '-' || l_linestatus")
FLAWED = f"""
SELECT CASE WHEN k = 6 AND dayofyear("Date") % 2 = 0 THEN '' ELSE "Symbol" END AS "Symbol", "Date",
  CASE WHEN k = 0 THEN 0.0 WHEN k = 7 THEN NULL ELSE "Open" END AS "Open",
  CASE WHEN k = 2 THEN "Low" - 1.0 ELSE "High" END AS "High",
  CASE WHEN k = 1 THEN -1.0 ELSE "Low" END AS "Low",
  CASE WHEN k = 3 THEN "High" + 1.0 ELSE "Close" END AS "Close",
  CASE WHEN k = 4 THEN -1.0 ELSE "Volume" END AS "Volume", "OpenInt"
FROM (SELECT b.*, (CAST("Symbol" AS INT) * 31 + dayofyear("Date")) % 97 AS k FROM ({BARS}) b) t
CROSS JOIN (VALUES (1), (2)) AS copies(c)
WHERE c = 1 OR k = 5"""
EVENT_BARS = """
SELECT event_type AS "Symbol", hr AS "Date", MAX(CASE WHEN rn = 1 THEN value END) AS "Open",
  MAX(value) AS "High", MIN(value) AS "Low", MAX(CASE WHEN rn = n THEN value END) AS "Close",
  CAST(COUNT(*) AS DOUBLE) AS "Volume"
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type, hr ORDER BY ts, event_id) rn,
        COUNT(*) OVER (PARTITION BY event_type, hr) n
      FROM (SELECT *, date_trunc('hour', ts) AS hr FROM events) a) b
GROUP BY event_type, hr"""

POSITIVE = '"Open" > 0 AND "High" > 0 AND "Low" > 0 AND "Close" > 0 AND "Volume" >= 0'
CONSISTENT = ('"High" >= "Open" AND "High" >= "Close" AND "High" >= "Low"'
              ' AND "Low" <= "Open" AND "Low" <= "Close"')
CLEAN = f"{POSITIVE} AND {CONSISTENT}"


def q(name: str) -> str:
    return f'"{name}"'


def r(expression: str, name: str | None = None) -> str:
    """Six decimals; the sum turns a negative zero into zero."""
    return f"round({expression}, 6) + 0.0 AS {q(name or expression.strip(chr(34)))}"


def bars_rounded() -> str:
    return '"Symbol", "Date", ' + ", ".join(r(q(c)) for c in NUMBERS)


# --- windows and features ------------------------------------------------------------

def _w(rows: int | None = None) -> str:
    frame = f" ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW" if rows else ""
    return f'OVER (PARTITION BY "Symbol" ORDER BY "Date"{frame})'


def _featured(source: str) -> str:
    """Every helper and feature column of the histories in ``source``."""
    lags = ", ".join(f'lag("Close", {k}) {_w()} AS c{k}' for k in (1, 2, 3, 5, 10, 20, 40))
    averages = ", ".join(f'avg("Close") {_w(n)} AS ma_{n}' for n in (5, 10, 20, 60))
    volumes = ", ".join(f'avg("Volume") {_w(n)} AS volume_ma_{n}' for n in (10, 20))
    first = f"""SELECT *, {lags}, {averages}, {volumes}, lag("Volume", 1) {_w()} AS v1,
  max("Close") {_w(10)} AS rolling_max_10, max("Close") {_w(20)} AS rolling_max_20,
  min("Close") {_w(20)} AS rolling_min_20,
  ln(lead("Close", 20) {_w()} / "Close") AS "LogReturn20" FROM ({source}) s"""
    returns = ", ".join(f'("Close" - c{k}) / c{k} AS ret_{k}' for k in (1, 2, 5, 10, 20, 40))
    second = f'SELECT *, {returns}, ("Open" - c1) / c1 AS gap_open FROM ({first}) f'
    third = "SELECT *, " + ", ".join(
        f"stddev_samp(ret_1) {_w(n)} AS vol_{n}" for n in (5, 10, 20)) + f" FROM ({second}) g"
    ratios = ", ".join(f'"Close" / ma_{n} AS ma_ratio_{n}' for n in (5, 10, 20, 60))
    past = ", ".join(f'ln(c{k} / "Close") AS "PastReturn{k}"' for k in (3, 5, 10))
    angles = {"DateMonth": ('month("Date") - 1', 12), "DateDay": ('day("Date") - 1', 31),
              "DayOfWeek": ('dayofweek("Date")', 7)}
    cyclic = ", ".join(
        f'{f}(({part}) * {2 * math.pi / n!r}::DOUBLE) AS "{name}{f.title()}"'
        for name, (part, n) in angles.items() for f in ("sin", "cos"))
    return f"""SELECT *, {ratios}, {past}, {cyclic},
  CASE WHEN "LogReturn20" > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS label_bin,
  CASE WHEN vol_20 <> 0 THEN vol_5 / vol_20 END AS vol_ratio_5_20,
  ("High" - "Low") / "Close" AS intraday_range, ("Close" - "Open") / "Open" AS open_close_change,
  ("High" - "Close") / "Close" AS high_close_ratio, ("Close" - "Low") / "Close" AS close_low_ratio,
  CASE WHEN volume_ma_10 <> 0 THEN "Volume" / volume_ma_10 END AS volume_ratio_10,
  CASE WHEN volume_ma_20 <> 0 THEN "Volume" / volume_ma_20 END AS volume_ratio_20,
  CASE WHEN v1 <> 0 THEN ("Volume" - v1) / v1 END AS volume_change_1,
  ln(1 + "Volume") AS log_volume,
  ("Close" - rolling_max_10) / rolling_max_10 AS drawdown_10,
  ("Close" - rolling_max_20) / rolling_max_20 AS drawdown_20,
  CASE WHEN rolling_max_20 <> 0 THEN "Close" / rolling_max_20 END AS close_to_max_20,
  CASE WHEN rolling_min_20 <> 0 THEN "Close" / rolling_min_20 END AS close_to_min_20
FROM ({third}) h"""


def _kept(source: str, min_rows: int) -> str:
    """Cleaned rows of symbols with enough of them."""
    return f"""SELECT * EXCLUDE (n_rows) FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY "Symbol") AS n_rows FROM ({source}) b WHERE {CLEAN}) c
WHERE n_rows >= {min_rows}"""


def _complete(names: list[str]) -> str:
    return " AND ".join(f"{q(n)} IS NOT NULL AND NOT isnan({q(n)})" for n in names)


ALL = _featured(BARS)
CLASSIFICATION = f"""SELECT "Symbol", "Date", {", ".join(map(q, FEATURES))}, label_bin AS label
FROM ({_featured(_kept(BARS, 60))}) p WHERE {_complete(["LogReturn20", *FEATURES])}"""
REGRESSION = f"""SELECT "Symbol", "Date", {", ".join(map(q, FEATURES))}, "LogReturn20" AS label
FROM ({_featured(_kept(BARS, 60))}) p WHERE {_complete(["LogReturn20", *FEATURES])}"""
LEGACY_FRAME = f"""SELECT "Symbol", "Date", {", ".join(map(q, LEGACY))}, "LogReturn20" AS label
FROM ({ALL}) p WHERE {_complete(["LogReturn20", *LEGACY])}"""


def columns(names: list[str], source: str = ALL, digits: int = 6) -> str:
    rounded = ", ".join(f"round({q(n)}, {digits}) + 0.0 AS {q(n)}" for n in names)
    return f'SELECT "Symbol", "Date", {rounded} FROM ({source}) z'


def _split(source: str, train_end: str = "2000-01-01", val_end: str = "2001-01-01") -> str:
    return f"""SELECT *, CASE WHEN "Date" < TIMESTAMP '{train_end}' THEN 'train'
  WHEN "Date" < TIMESTAMP '{val_end}' THEN 'validation' ELSE 'test' END AS split
FROM ({source}) u"""


def _labelled(source: str, min_rows: int, train_end: str, val_end: str) -> str:
    target = f"""SELECT "Symbol", "Date", ln(lead("Close", 20) {_w()} / "Close") AS "LogReturn20"
FROM ({_kept(source, min_rows)}) k"""
    return _split(f'SELECT * FROM ({target}) l WHERE "LogReturn20" IS NOT NULL',
                  train_end, val_end)


LABELLED = _labelled(BARS, 60, "2000-01-01", "2001-01-01")
CLASS_LABELLED = _labelled(CLASS_BARS, 80, "1995-02-15", "2000-03-01")
COUNTS = f"""SELECT "Symbol", COUNT(*) FILTER (split = 'train') AS train_rows,
  COUNT(*) FILTER (split = 'validation') AS val_rows,
  COUNT(*) FILTER (split = 'test') AS test_rows, COUNT(*) AS total_rows
FROM ({CLASS_LABELLED}) l GROUP BY "Symbol\""""
SPLIT_ROWS = f"""SELECT split, "Symbol", COUNT(*) AS rows
FROM ({CLASS_LABELLED}) l GROUP BY split, "Symbol\""""
ELIGIBLE = f"SELECT * FROM ({COUNTS}) c WHERE train_rows >= 2 AND val_rows >= 55 AND test_rows >= 2"
CLASS_SPLIT = _split(CLASSIFICATION)
REG_SPLIT = _split(REGRESSION)


# --- statistics ----------------------------------------------------------------------

def _described(value: str) -> str:
    v = f"{value}::DOUBLE"
    return ", ".join([
        f"COUNT({value}) AS count", r(f"avg({v})", "mean"), r(f"stddev_samp({v})", "std"),
        r(f"min({v})", "min"), r(f"quantile_cont({v}, 0.25)", "p25"),
        r(f"quantile_cont({v}, 0.5)", "p50"), r(f"quantile_cont({v}, 0.75)", "p75"),
        r(f"max({v})", "max")])


def _label_stats(quantiles: dict[str, float]) -> str:
    t = '"LogReturn20"'
    return f"""SELECT split, COUNT(*) AS count, {r(f"avg({t})", "mean")},
  {r(f"stddev_samp({t})", "std")}, {r(f"min({t})", "min")}, {r(f"max({t})", "max")},
  {", ".join(r(f"quantile_cont({t}, {p})", name) for name, p in quantiles.items())}
FROM ({LABELLED}) l GROUP BY split"""


def _checks(checks: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "check", COUNT(*) FILTER ({condition}) AS rows,
  {r(f"COUNT(*) FILTER ({condition}) / COUNT(*)", "share")} FROM flawed"""
        for name, condition in checks.items())


def _column_summary() -> str:
    parts = [
        f"""SELECT '{c}' AS "column", COUNT({q(c)}) AS count, {r(f"avg({q(c)})", "mean")},
  {r(f"stddev_samp({q(c)})", "std")}, {r(f"min({q(c)})", "min")}, {r(f"max({q(c)})", "max")},
  {r(f"quantile_cont({q(c)}, 0.25)", "p25")}, {r(f"quantile_cont({q(c)}, 0.5)", "p50")},
  {r(f"quantile_cont({q(c)}, 0.75)", "p75")},
  NULL::DOUBLE AS "unique", NULL::DOUBLE AS freq, NULL::VARCHAR AS top FROM flawed"""
        for c in NUMBERS]
    parts.append("""SELECT 'Symbol', SUM(n)::BIGINT, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  COUNT(*), MAX(n), (SELECT "Symbol" FROM s ORDER BY n DESC, "Symbol" LIMIT 1) FROM s""")
    return f"""WITH flawed AS ({FLAWED}),
s AS (SELECT "Symbol", COUNT(*) AS n FROM flawed GROUP BY "Symbol")
{" UNION ALL ".join(parts)}"""


def _ranges(source: str) -> str:
    return f"""SELECT "Symbol", min("Date") AS first_date, max("Date") AS last_date
FROM ({source}) b GROUP BY "Symbol\""""


# --- evaluation ----------------------------------------------------------------------

def _cells(source: str, keys: str) -> str:
    return f"""SELECT {keys}, COUNT(*) FILTER (label = 0 AND prediction = 0) AS tn,
  COUNT(*) FILTER (label = 0 AND prediction = 1) AS fp,
  COUNT(*) FILTER (label = 1 AND prediction = 0) AS fn,
  COUNT(*) FILTER (label = 1 AND prediction = 1) AS tp
FROM ({source}) p GROUP BY {keys}"""


def _scores(source: str, keys: str) -> str:
    """Cells with precision, recall and F1 of both classes."""
    return f"""SELECT *, CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0 END AS f1,
  CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0 END AS f0
FROM (SELECT *, tn + fp + fn + tp AS n,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p1,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r1,
    CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END AS p0,
    CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS r0
  FROM ({_cells(source, keys)}) c) d"""


def _weighted(source: str, keys: str) -> str:
    return f"""SELECT {keys}, (tp + tn) / n AS accuracy,
  (f1 * (tp + fn) + f0 * (tn + fp)) / n AS f1, (p1 * (tp + fn) + p0 * (tn + fp)) / n AS "precision",
  (r1 * (tp + fn) + r0 * (tn + fp)) / n AS recall FROM ({_scores(source, keys)}) e"""


def _wide(source: str, names: list[str]) -> str:
    sides = {"val": "validation", "test": "test"}
    return ", ".join(
        f"max({q(name)}) FILTER (split = '{split}') AS {side}_{name}"
        for side, split in sides.items() for name in names)


METRICS = ["accuracy", "f1", "precision", "recall"]
VAL_TEST = [f"{side}_{m}" for side in ("val", "test") for m in METRICS]
GUESSED = f"""SELECT split, label, CASE WHEN ret_5 > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
FROM ({CLASS_SPLIT}) c"""
MAJORITY = f"""
SELECT 'MajorityBaseline' AS model_name, max(prediction) AS majority_class, {_wide("", METRICS)},
  TRUE AS is_best
FROM (SELECT w.*, m.prediction FROM ({_weighted('''
    SELECT split, label, prediction FROM data, majority WHERE split <> 'train' ''', "split")}) w,
  majority m) v"""
MAJORITY_WITH = f"""data AS ({CLASS_SPLIT}),
majority AS (SELECT CASE WHEN COUNT(*) FILTER (label = 1) >= COUNT(*) FILTER (label = 0)
  THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction FROM data WHERE split = 'train')"""
RULES = " UNION ALL ".join(
    f"""SELECT {i} AS grid_index, {k}.0::DOUBLE AS lag, split, label,
  CASE WHEN ret_{k} > 0 THEN 1.0 ELSE 0.0 END AS prediction FROM data WHERE split <> 'train'"""
    for i, k in enumerate((1, 2, 5, 10, 20, 40)))
RESULTS = f"""WITH {MAJORITY_WITH},
rules AS (SELECT grid_index, lag, {_wide("", METRICS)}
  FROM ({_weighted(RULES, "grid_index, lag, split")}) w GROUP BY grid_index, lag),
results AS (
  SELECT model_name, majority_class, {", ".join(VAL_TEST)}, is_best,
    NULL::DOUBLE AS grid_index, NULL::DOUBLE AS lag FROM ({MAJORITY}) m
  UNION ALL
  SELECT 'MomentumRule', NULL, {", ".join(VAL_TEST)},
    ROW_NUMBER() OVER (ORDER BY val_f1 DESC, grid_index) = 1, grid_index, lag FROM rules)
SELECT model_name, majority_class, {", ".join(r(c) for c in VAL_TEST)}, is_best,
  grid_index::DOUBLE AS grid_index, lag FROM results"""
AUC = f"""WITH data AS (SELECT split, ret_5 AS s, label FROM ({CLASS_SPLIT}) c),
g AS (SELECT split, s, COUNT(*) FILTER (label = 1) AS p, COUNT(*) FILTER (label <> 1) AS q
  FROM data GROUP BY split, s),
b AS (SELECT *, SUM(q) OVER (PARTITION BY split ORDER BY s) - q AS below FROM g)
SELECT split, {r("SUM(p * (below + q / 2)) / (SUM(p)::DOUBLE * SUM(q))", "auc")}
FROM b GROUP BY split"""

# --- models whose answers have a closed form -------------------------------------------
# A line of standardised x and y: correlation, soft-thresholded by the L1 part of the
# penalty and shrunk by the L2 part, penalties divided by the deviation of y.

def _lines(frame: str, x: str, grid: str, train: str, groups: str = "") -> str:
    """(groups, grid_index, regParam, penalties, w, b) of every grid point."""
    return f"""SELECT *, my - w * mx AS b FROM (
  SELECT *, sign(rho) * greatest(abs(rho) - reg / sy * l1, 0) / (1 + reg / sy * (1 - l1)) * sy / sx AS w
  FROM (SELECT {groups} corr({x}, label) AS rho, stddev_pop({x}) AS sx, stddev_pop(label) AS sy,
      avg({x}) AS mx, avg(label) AS my FROM {frame} WHERE {train} {"GROUP BY ALL" if groups else ""}) s, ({grid}) g) t"""


def _errors(pairs: str, keys: str) -> str:
    return f"""SELECT {keys}, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae,
  1 - SUM(e * e) / (COUNT(*) * var_pop(label)) AS r2 FROM ({pairs}) p GROUP BY {keys}"""


ERRORS = ["rmse", "mae", "r2"]
LINEAR_POINTS = """SELECT row_number() OVER () - 1 AS grid_index, reg, l1, l1 AS second FROM (VALUES
  (0.01, 0.5), (0.01, 1.0), (0.1, 0.5), (0.1, 1.0)) v(reg, l1)"""
GLR_POINTS = """SELECT (a.i * 3 + b.i) AS grid_index, reg, 0.0 AS l1, second FROM
  (VALUES (0, 0.005), (1, 0.01), (2, 0.02), (3, 0.03), (4, 0.1)) a(i, reg), (VALUES (0, 50.0), (1, 100.0), (2, 150.0)) b(i, second)"""


def _line_grid(name: str, points: str, second: str) -> str:
    return f"""WITH d AS MATERIALIZED (SELECT split, label, ret_5 FROM ({REG_SPLIT}) x),
t AS MATERIALIZED ({_lines("d", "ret_5", points, "split = 'train'")}),
m AS ({_errors("SELECT split, grid_index, label, label - b - w * ret_5 AS e FROM d, t WHERE split <> 'train'", "split, grid_index")})
SELECT '{name}' AS model_name, grid_index::DOUBLE AS grid_index, {r("max(reg)::DOUBLE", "regParam")},
  {r("max(second)::DOUBLE", second)}, {", ".join(
      r(f"max({m}) FILTER (split = '{split}')", f"{side}_{m}")
      for side, split in (("val", "validation"), ("test", "test")) for m in ERRORS)}
FROM m JOIN t USING (grid_index) GROUP BY grid_index"""


def _line_cv(name: str, points: str, second: str) -> str:
    key = "\"Symbol\" || '|' || strftime(\"Date\", '%Y-%m-%d')"
    bucket = "CAST('0x' || substr(md5({}), 1, 4) AS INT)"
    return f"""WITH d AS MATERIALIZED (SELECT label, "PastReturn5" AS x, {bucket.format(key)} % 10 < 8 AS train,
  {bucket.format("'fold|' || " + key)} % 3 AS fold FROM ({LEGACY_FRAME}) l),
f AS MATERIALIZED ({_lines("d, (VALUES (0), (1), (2)) h(held)", "x", points, "train AND fold <> held", "held,")}),
c AS (SELECT grid_index, avg(rmse) AS cv FROM ({_errors(
    "SELECT held, grid_index, label, label - b - w * x AS e FROM d JOIN f ON train AND fold = held",
    "held, grid_index")}) v GROUP BY grid_index),
t AS MATERIALIZED ({_lines("d", "x", points, "train")}),
m AS ({_errors("SELECT grid_index, label, label - b - w * x AS e FROM d, t WHERE NOT train", "grid_index")})
SELECT '{name}' AS model_name, grid_index::DOUBLE AS grid_index, {r("reg::DOUBLE", "regParam")},
  {r("second::DOUBLE", second)}, {r("cv", "cv_rmse_avg")}, {", ".join(r(e, f"test_{e}") for e in ERRORS)}
FROM m JOIN c USING (grid_index) JOIN t USING (grid_index)"""


# Models of one 0/1 feature learn a value for each side.
def _sides(frame: str) -> str:
    return f"""d AS MATERIALIZED (SELECT split, label, ret_5 > 0 AS rising FROM ({frame}) x),
v AS (SELECT rising, avg(label) AS s FROM d WHERE split = 'train' GROUP BY rising)"""


def _class_sides(name: str, parameters: str, merged: bool = False) -> str:
    """``merged``: sides with one answer become one, and share their score."""
    score = "CASE WHEN (SELECT min(s) > 0.5 OR max(s) <= 0.5 FROM v) THEN 0.5 ELSE s END" if merged else "s"
    return f"""WITH {_sides(CLASS_SPLIT)},
p AS MATERIALIZED (SELECT split, label, CASE WHEN s > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
  {score} AS s FROM d JOIN v USING (rising) WHERE split <> 'train'),
g AS (SELECT split, s, COUNT(*) FILTER (label = 1) AS p, COUNT(*) FILTER (label <> 1) AS q FROM p GROUP BY split, s),
a AS (SELECT split, SUM(p * (below + q / 2)) / (SUM(p)::DOUBLE * SUM(q)) AS auc FROM (
  SELECT *, SUM(q) OVER (PARTITION BY split ORDER BY s) - q AS below FROM g) b GROUP BY split),
m AS (SELECT * FROM ({_weighted("SELECT * FROM p", "split")}) w JOIN a USING (split))
SELECT '{name}' AS model_name, 0::DOUBLE AS grid_index, {parameters}, {", ".join(
    r(f"max({q(c)}) FILTER (split = '{split}')", f"{side}_{c}")
    for side, split in (("val", "validation"), ("test", "test")) for c in [*METRICS, "auc"])}, TRUE AS is_best FROM m"""


RF_SIDES = f"""WITH {_sides(REG_SPLIT)},
m AS ({_errors("SELECT split, label, label - s AS e FROM d JOIN v USING (rising) WHERE split <> 'train'", "split")})
SELECT 'RandomForestRegressor' AS model_name, 0::DOUBLE AS grid_index, 1::DOUBLE AS "numTrees", 1::DOUBLE AS "maxDepth",
  {", ".join(r(f"max({e}) FILTER (split = '{split}')", f"{side}_{e}")
             for side, split in (("val", "validation"), ("test", "test")) for e in ERRORS)}, TRUE AS is_best FROM m"""

TEXT_DAY = 'strftime("Date", \'%Y-%m-%d\')'


def _hidden(i: int, value: str, otherwise: str = "NULL") -> str:
    return f'CASE WHEN dayofweek("Date") = {i} THEN {otherwise} ELSE {value} END'


def _seen(threshold: str) -> str:
    columns = []
    for name in ("val", "test"):
        covered = f"SUM(CASE WHEN train_rows >= {threshold} THEN {name}_rows ELSE 0 END)"
        columns += [f"{covered}::BIGINT AS {name}_covered",
                    f"SUM({name}_rows)::BIGINT AS {name}_rows",
                    r(f"{covered} / SUM({name}_rows)", f"{name}_share")]
    return ", ".join(columns)


# Files whose columns stand as in the first file are fine.
AUDITED = f"""SELECT b.*, "Symbol" || '.us.txt' AS file,
  CASE WHEN (s_acctbal < 0) = first_is_odd THEN 'ok' ELSE 'incoherent' END AS status
FROM ({BARS}) b JOIN supplier s ON b."Symbol" = CAST(s_suppkey AS VARCHAR),
  (SELECT s_acctbal < 0 AS first_is_odd FROM supplier
   WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)
   ORDER BY CAST(s_suppkey AS VARCHAR) || '.us.txt' LIMIT 1) f"""

ORACLES: dict[str, str] = {
    "scan_csv_bars": f"SELECT {bars_rounded()} FROM ({BARS}) b",
    "parse_dates": f"""SELECT "Symbol", {TEXT_DAY} AS day, {_hidden(0, '"Date"')} AS "Date"
FROM ({BARS}) b""",
    "coerce_numeric": f"""SELECT "Symbol", {TEXT_DAY} AS day, {", ".join(
        r(_hidden(i + 1, q(c)), c) for i, c in enumerate(NUMBERS[:5]))} FROM ({BARS}) b""",
    "file_audit": f"""SELECT file, status, COUNT(*) AS rows FROM ({AUDITED}) a GROUP BY ALL""",
    "load_coherent_bars": f"""SELECT file, {bars_rounded()} FROM ({AUDITED}) a
WHERE status = 'ok'""",
    "file_date_ranges": f"""SELECT file, MIN("Date") AS first_date, MAX("Date") AS last_date
FROM ({AUDITED}) a WHERE status = 'ok' GROUP BY file""",
    "incoherent_roundtrip": f"SELECT DISTINCT file FROM ({AUDITED}) a WHERE status <> 'ok'",
    "eligible_roundtrip": ELIGIBLE,
    "results_roundtrip": RESULTS,
    "drop_null_prices": f"""SELECT {bars_rounded()} FROM ({FLAWED}) b
WHERE "Open" IS NOT NULL AND "High" IS NOT NULL AND "Low" IS NOT NULL AND "Close" IS NOT NULL""",
    "clean_positive": f"SELECT {bars_rounded()} FROM ({FLAWED}) b WHERE {POSITIVE}",
    "clean_ohlc": f"SELECT {bars_rounded()} FROM ({FLAWED}) b WHERE {CONSISTENT}",
    "clean_market_data": f"SELECT {bars_rounded()} FROM ({FLAWED}) b WHERE {CLEAN}",
    "min_rows_filter": f"""SELECT {bars_rounded()} FROM ({BARS}) b
WHERE "Symbol" IN (SELECT "Symbol" FROM ({BARS}) c GROUP BY "Symbol" HAVING COUNT(*) >= 530)""",
    "min_rows_semijoin": f"""SELECT {bars_rounded()} FROM ({BARS}) b
WHERE "Symbol" IN (SELECT "Symbol" FROM ({BARS}) c GROUP BY "Symbol" HAVING COUNT(*) >= 530)""",
    "target_log_return": columns(["LogReturn20"]),
    "target_binary": columns(["LogReturn20", "label_bin"]),
    "simple_returns": columns(FEATURES[6:12]),
    "rolling_volatility": columns(["vol_5", "vol_10", "vol_20"]),
    "volatility_ratio": columns(["vol_ratio_5_20"]),
    "moving_averages": columns(["ma_5", "ma_10", "ma_20", "ma_60"], digits=8),
    "ma_ratios": columns(["ma_ratio_5", "ma_ratio_10", "ma_ratio_20", "ma_ratio_60"]),
    "gap_open": columns(["gap_open"]),
    "volume_ratios": columns(
        ["volume_ma_10", "volume_ma_20", "volume_ratio_10", "volume_ratio_20"]),
    "volume_change": columns(["volume_change_1"]),
    "rolling_extrema": columns(["rolling_max_10", "rolling_max_20", "rolling_min_20"]),
    "drawdowns": columns(["drawdown_10", "drawdown_20"]),
    "range_position": columns(["close_to_max_20", "close_to_min_20"]),
    "past_log_returns": columns(["PastReturn3", "PastReturn5", "PastReturn10"]),
    "cyclic_features": columns(FEATURES[:6]),
    "intraday_features": columns(FEATURES[20:24], _featured(EVENT_BARS)),
    "log_volume": columns(["log_volume"]),
    "prepared_features": columns([*FEATURES, "label"], CLASSIFICATION),
    "prepared_regression": columns([*FEATURES, "label"], REGRESSION),
    "prepared_legacy": columns([*LEGACY, "label"], LEGACY_FRAME),
    "temporal_split": f'SELECT "Symbol", "Date", split FROM ({_split(BARS)}) s',
    "hash_split": f"""SELECT "Symbol", split, COUNT(*) AS rows FROM (
  SELECT "Symbol", CASE WHEN CAST('0x' || substr(md5("Symbol" || '|' || {TEXT_DAY}), 1, 4) AS INT)
    % 10 < 8 THEN 'train' ELSE 'test' END AS split FROM ({BARS}) b) h
GROUP BY "Symbol", split""",
    "table_shape": f"""SELECT position::BIGINT AS position, c AS "column", t AS type,
  (SELECT COUNT(*) FROM ({FLAWED}) f) AS rows
FROM (VALUES (0, 'Symbol', 'string'), (1, 'Date', 'timestamp_ntz'), (2, 'Open', 'double'),
  (3, 'High', 'double'), (4, 'Low', 'double'), (5, 'Close', 'double'), (6, 'Volume', 'double'),
  (7, 'OpenInt', 'double')) AS v(position, c, t)""",
    "head_rows": f'SELECT {bars_rounded()} FROM ({BARS}) b ORDER BY "Symbol", "Date" LIMIT 5',
    "tail_rows": f"""SELECT {bars_rounded()} FROM ({BARS}) b
ORDER BY "Symbol" DESC, "Date" DESC LIMIT 5""",
    "null_counts": f"WITH flawed AS ({FLAWED}) " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(*) FILTER ({q(c)} IS NULL) AS nulls FROM flawed"""
        for c in ["Symbol", "Date", *NUMBERS]),
    "empty_string_counts": f"""SELECT 'Symbol' AS "column",
  COUNT(*) FILTER ("Symbol" = '') AS empty_strings FROM ({FLAWED}) f""",
    "duplicate_rows": f"""SELECT (COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM
  ({FLAWED}) d) e))::BIGINT AS duplicates FROM ({FLAWED}) f""",
    "duplicate_keys": f"""SELECT (COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT "Symbol", "Date"
  FROM ({FLAWED}) d) e))::BIGINT AS duplicates FROM ({FLAWED}) f""",
    "date_range": f"""SELECT min("Date") AS first_date, max("Date") AS last_date,
  COUNT(*) FILTER ("Date" IS NULL) AS null_dates FROM ({FLAWED}) f""",
    "earliest_symbols": f"""SELECT "Symbol", first_date FROM ({_ranges(CLASS_BARS)}) s
ORDER BY first_date, "Symbol" LIMIT 10""",
    "latest_symbols": f"""SELECT "Symbol", first_date FROM ({_ranges(CLASS_BARS)}) s
ORDER BY first_date DESC, "Symbol" DESC LIMIT 10""",
    "end_month_counts": f"""SELECT strftime(last_date, '%Y-%m') AS month, COUNT(*) AS symbols
FROM ({_ranges(CLASS_BARS)}) s GROUP BY 1""",
    "column_summary": _column_summary(),
    "date_summary": f"""SELECT COUNT("Date") AS count,
  {", ".join(f"make_timestamp(floor({e})::BIGINT * 1000000) AS {name}" for name, e in {
      "mean": 'avg(epoch("Date"))', "min": 'min(epoch("Date"))',
      "p25": 'quantile_cont(epoch("Date"), 0.25)', "p50": 'quantile_cont(epoch("Date"), 0.5)',
      "p75": 'quantile_cont(epoch("Date"), 0.75)', "max": 'max(epoch("Date"))'}.items())}
FROM ({FLAWED}) f""",
    "invalid_value_checks": f"WITH flawed AS ({FLAWED}) " + _checks(
        {f"{c} <= 0": f"{q(c)} <= 0" for c in NUMBERS[:4]}
        | {"Volume < 0": '"Volume" < 0', "Volume == 0": '"Volume" = 0'}),
    "ohlc_violation_checks": f"WITH flawed AS ({FLAWED}) " + _checks(
        {f"High < {c}": f'"High" < {q(c)}' for c in ("Open", "Close", "Low")}
        | {f"Low > {c}": f'"Low" > {q(c)}' for c in ("Open", "Close")}),
    "numeric_quantiles": f"WITH flawed AS ({FLAWED}) " + " UNION ALL ".join(
        f"""SELECT {p}::DOUBLE AS probability, {", ".join(
            r(f"quantile_cont({q(c)}, {p})", c) for c in NUMBERS[:5])} FROM flawed"""
        for p in (0.01, 0.05, 0.5, 0.95, 0.99, 0.999)),
    "symbol_count": f'SELECT COUNT(DISTINCT "Symbol") AS symbols FROM ({FLAWED}) f',
    "rows_per_symbol_stats": f"""SELECT {_described("n")} FROM (
  SELECT COUNT(*) AS n FROM ({CLASS_BARS}) b GROUP BY "Symbol") s""",
    "top_symbols": f"""SELECT "Symbol", COUNT(*) AS rows FROM ({CLASS_BARS}) b GROUP BY "Symbol"
ORDER BY rows DESC, "Symbol" LIMIT 10""",
    "short_history_counts": f"""WITH s AS (SELECT COUNT(*) AS n FROM ({CLASS_BARS}) b
  GROUP BY "Symbol") """ + " UNION ALL ".join(
        f"SELECT {n}::BIGINT AS fewer_than, COUNT(*) FILTER (n < {n}) AS symbols FROM s"
        for n in (60, 80, 100)),
    "symbol_span_stats": f"""SELECT {_described("days")} FROM (
  SELECT date_diff('day', first_date, last_date) AS days FROM ({_ranges(CLASS_BARS)}) b) s""",
    "rows_per_year": f"""SELECT year("Date") AS year, COUNT(*) AS rows
FROM ({FLAWED}) f GROUP BY 1""",
    "active_symbols_per_year": f"""SELECT year("Date") AS year, COUNT(DISTINCT "Symbol") AS symbols
FROM ({CLASS_BARS}) f GROUP BY 1""",
    "label_distribution": _label_stats({
        "p01": 0.01, "p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}),
    "label_moments": f"""SELECT split, {r('avg("LogReturn20")', "mean")},
  {r('stddev_samp("LogReturn20")', "std")}, {r('skewness("LogReturn20")', "skewness")},
  {r('kurtosis("LogReturn20")', "kurtosis")} FROM ({LABELLED}) l GROUP BY split""",
    "label_summary_table": _label_stats(
        {"p01": 0.01, "p05": 0.05, "median": 0.5, "p95": 0.95, "p99": 0.99}),
    "binary_balance": f"""SELECT split, COUNT(*) AS total, SUM(up)::BIGINT AS positives,
  SUM(1 - up)::BIGINT AS negatives, {r("avg(up)", "positive_pct")},
  {r("avg(1 - up)", "negative_pct")},
  (CASE WHEN SUM(up) >= SUM(1 - up) THEN 1 ELSE 0 END)::BIGINT AS majority_class
FROM (SELECT split, CASE WHEN "LogReturn20" > 0 THEN 1 ELSE 0 END AS up FROM ({LABELLED}) l) b
GROUP BY split""",
    "symbol_split_counts": COUNTS,
    "symbols_per_split": f"""SELECT split, COUNT(DISTINCT "Symbol") AS symbols
FROM ({CLASS_LABELLED}) l GROUP BY split""",
    "symbol_overlap": f"""WITH s AS (SELECT DISTINCT split, "Symbol" FROM ({CLASS_LABELLED}) l),
t AS (SELECT "Symbol" FROM s WHERE split = 'train'),
v AS (SELECT "Symbol" FROM s WHERE split = 'validation'),
e AS (SELECT "Symbol" FROM s WHERE split = 'test'),
n AS (SELECT (SELECT COUNT(*) FROM (FROM v INTERSECT FROM t)) AS val_and_train,
  (SELECT COUNT(*) FROM (FROM e INTERSECT FROM t)) AS test_and_train,
  (SELECT COUNT(*) FROM (FROM e INTERSECT FROM v)) AS test_and_val)
SELECT *, {r("val_and_train / (SELECT COUNT(*) FROM v)", "val_seen_share")},
  {r("test_and_train / (SELECT COUNT(*) FROM e)", "test_seen_share")} FROM n""",
    "new_symbols": f"""WITH s AS (SELECT DISTINCT split, "Symbol" FROM ({CLASS_LABELLED}) l)
SELECT split, "Symbol" FROM s WHERE split <> 'train'
  AND "Symbol" NOT IN (SELECT "Symbol" FROM s WHERE split = 'train')""",
    "rows_seen_in_train": f"SELECT {_seen('1')} FROM ({COUNTS}) c",
    "split_symbol_row_stats": f"""SELECT split, {_described("rows")}
FROM ({SPLIT_ROWS}) s GROUP BY split""",
    "top_symbols_by_split": f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY split ORDER BY rows DESC, "Symbol") AS rank FROM ({SPLIT_ROWS}) s
  WHERE split <> 'train') t WHERE rank <= 10""",
    "history_coverage": f"""SELECT threshold::BIGINT AS threshold, {_seen("threshold")}
FROM ({COUNTS}) c, (VALUES (1), (2), (4)) AS v(threshold) GROUP BY threshold""",
    "eligible_symbols": ELIGIBLE,
    "eligible_share": f"""SELECT (SELECT COUNT(*) FROM ({ELIGIBLE}) e) AS eligible,
  COUNT(*) AS symbols, {r(f"(SELECT COUNT(*) FROM ({ELIGIBLE}) e) / COUNT(*)", "share")}
FROM ({COUNTS}) c""",
    "eligible_stats": f"WITH e AS ({ELIGIBLE}) " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {_described(c)} FROM e"""
        for c in ("train_rows", "val_rows", "test_rows", "total_rows")),
    "eligible_top": f"SELECT * FROM ({ELIGIBLE}) e ORDER BY total_rows DESC, \"Symbol\" LIMIT 10",
    "eligible_bottom": f"""SELECT * FROM ({ELIGIBLE}) e
ORDER BY train_rows, val_rows, test_rows, "Symbol" LIMIT 10""",
    "zero_baseline": f"""SELECT 'ZeroBaseline' AS model_name, TRUE AS is_best, {", ".join(
        r(f"max({m}) FILTER (split = '{split}')", f"{side}_{m}")
        for side, split in (("val", "validation"), ("test", "test"))
        for m in ("rmse", "mae", "r2"))}
FROM (SELECT split, sqrt(avg(label * label)) AS rmse, avg(abs(label)) AS mae,
    1 - SUM(label * label) / (COUNT(*) * var_pop(label)) AS r2
  FROM ({REG_SPLIT}) x GROUP BY split) m""",
    "majority_baseline": f"""WITH {MAJORITY_WITH} SELECT model_name, majority_class,
  {", ".join(r(c) for c in VAL_TEST)}, is_best FROM ({MAJORITY}) m""",
    "auc_exact": AUC,
    "confusion_matrix": f"""SELECT split, label, prediction, COUNT(*) AS rows
FROM ({GUESSED}) g GROUP BY split, label, prediction""",
    "class_report": f"""SELECT split, n AS total, tp + fp AS predicted_positive,
  {r("(tp + fp) / n", "positive_pct")}, tn + fn AS predicted_negative,
  {r("(tn + fn) / n", "negative_pct")}, tn, fp, fn, tp,
  {r("p1", "precision_1")}, {r("r1", "recall_1")}, {r("f1", "f1_1")},
  {r("p0", "precision_0")}, {r("r0", "recall_0")}, {r("f0", "f1_0")},
  {r("(r0 + r1) / 2", "balanced_accuracy")} FROM ({_scores(GUESSED, "split")}) s""",
    "results_leaderboard": RESULTS,
    "best_per_model": f"SELECT * FROM ({RESULTS}) z WHERE is_best",
    # Means and deviations of the training rows as windows over all rows: one pass, no join.
    "standard_scaled": f"""SELECT "Symbol", "Date", split, {", ".join(
        r(f"({q(c)} - avg({q(c)}) FILTER (split = 'train') OVER ()) / stddev_samp({q(c)}) FILTER (split = 'train') OVER ()", c)
        for c in FEATURES)} FROM ({CLASS_SPLIT}) x""",
    "linear_regression_line": _line_grid("LinearRegression", LINEAR_POINTS, "elasticNetParam"),
    "glr_line": _line_grid("GeneralizedLinearRegression", GLR_POINTS, "maxIter"),
    "linear_regression_cv_line": _line_cv("LinearRegression", LINEAR_POINTS, "elasticNetParam"),
    "glr_cv_line": _line_cv("GeneralizedLinearRegression", GLR_POINTS, "maxIter"),
    "logistic_sides": _class_sides(
        "LogisticRegression", '0::DOUBLE AS "regParam", 0::DOUBLE AS "elasticNetParam"'),
    "rf_classifier_sides": _class_sides(
        "RandomForestClassifier", '1::DOUBLE AS "numTrees", 1::DOUBLE AS "maxDepth"', merged=True),
    "gbt_classifier_sides": _class_sides(
        "GBTClassifier", '1::DOUBLE AS "maxDepth", 1::DOUBLE AS "maxIter"'),
    "rf_regressor_sides": RF_SIDES,
    "linreg_slope": f"""SELECT 'ret_5' AS feature, {r("regr_slope(label, ret_5)", "slope")},
  {r("regr_intercept(label, ret_5)", "intercept")} FROM ({REG_SPLIT}) x""",
}
