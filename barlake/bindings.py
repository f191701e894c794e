"""Driver bindings: one Spark query per operator key, each with an
independent DuckDB SQL oracle over the same Parquet tables.

Stand-in roles on the driver tables: ticker := events.event_type (few long
series) or user_id (many short ones); event_time := events.ts; close :=
events.value. The tables hold no NULLs in these columns, so defects are
injected by expression (e.g. NULL close where event_id % 7 = 0); every row of
every table is still processed.

Hash-safety: doubles that come out of sums are rounded to 9 decimals;
decimal(19,4) prices go through decimal(38,9) first; counts are BIGINT;
timestamps stay TIMESTAMP_NTZ; every window order is total.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.time import date_key, local_to_utc, parse_time_lenient, round_to_second
from .operators.bars import build_bars
from .operators.clean import (
    clean_keys,
    dedupe_keep_last,
    filter_time_window,
    normalize_schema,
    row_sample,
    universe_filter,
)
from .operators.completeness import landing_gaps
from .operators.constraints import check_constraints
from .operators.evaluate import directional_accuracy, error_metrics, supervised_set, time_split, top_k_per_group
from .operators.quality import RULES, duplicate_keys, quality_metrics, report_row, violated, write_report
from .operators.series import forward_fill, lead_target, pick_strategy, rolling_mean, series_windows
from .operators.upsert import assign_keys, upsert
from .plans import gold, silver
from .plans.windows import ingest_window, load_window, slice_column
from .session import scratch_path, staged, table
from .sources.scan import read_window, read_with_path_key, scan_partitioned, scan_recursive
from .sources.sinks import append, land_bronze, publish, staged_overwrite

MAS = (10, 20, 50, 200)
TARGET_DAY = "2024-01-25"
LOAD_TS = "2024-02-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---------------------------------------------------------------- shared frames

def _events(spark, d) -> DataFrame:
    return table(spark, d, "events")


def _b(spark, d) -> DataFrame:
    e = _events(spark, d)
    return e.select("event_id", "event_type", "user_id", "ts",
                    F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("v"))


B_CTE = ("b AS (SELECT event_id, event_type, user_id, ts, "
         "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS v FROM events)")


def _bars(spark, d) -> DataFrame:
    """Hourly bars per event_type; close NULL on hours divisible by 5."""
    bars = build_bars(_events(spark, d), ["event_type"], "ts", "value", None, "1 hour",
                      tie_break=["event_id"], bar_time="event_time")
    return bars.select(
        F.col("event_type").alias("ticker"), "event_time", "open", "high", "low",
        F.when(F.hour("event_time") % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("close")).alias("close"),
        "volume", F.to_date("event_time").alias("trade_date"),
    )


BARS_CTE = """
bars AS (
  SELECT event_type AS ticker, date_trunc('hour', ts) AS event_time,
         arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         CASE WHEN hour(date_trunc('hour', ts)) % 5 = 0 THEN NULL
              ELSE arg_max(value, (ts, event_id)) END AS close,
         count(*) AS volume
  FROM events GROUP BY 1, 2)"""


def _fill_ma_ctes(src: str, ma_round: int | None = 9) -> str:
    w = "PARTITION BY ticker ORDER BY event_time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    fills = ", ".join(f"last_value({c} IGNORE NULLS) OVER ({w}) AS {c}" for c in ("open", "high", "low", "close"))

    def ma(n):
        e = f"avg(close) OVER (PARTITION BY ticker ORDER BY event_time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        return f"round({e}, {ma_round}) AS ma{n}" if ma_round is not None else f"{e} AS ma{n}"

    mas = ", ".join(ma(n) for n in MAS)
    return f"""
filled AS (SELECT ticker, event_time, {fills}, volume FROM {src}),
enriched AS (SELECT *, {mas} FROM filled),
silver AS (
  SELECT ticker, event_time, open, high, low, close, volume, ma10, ma20, ma50, ma200,
         CAST(event_time AS DATE) AS trade_date
  FROM enriched
  WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL)"""


def _silver(spark, d, ma_round: int | None = 9) -> DataFrame:
    # staged: the bars are read by the series bound and by the window
    out = silver.enrich(staged(_bars(spark, d), "bars"), "ticker", "event_time", MAS)
    if ma_round is not None:
        out = out.select(*[F.round(c, ma_round).alias(c) if c.startswith("ma") else F.col(c) for c in out.columns])
    return out.select("ticker", "event_time", "open", "high", "low", "close", "volume",
                      *[f"ma{n}" for n in MAS], "trade_date")


SILVER_CTES = "WITH " + BARS_CTE + "," + _fill_ma_ctes("bars")
SILVER_RAW_CTES = "WITH " + BARS_CTE + "," + _fill_ma_ctes("bars", None)


def _gold_tables(spark, d):
    # dims and fact all derive from the base: computed once (as in run_gold)
    base = staged(gold.gold_base(_silver(spark, d, None), zone="UTC"), "gold_base")
    dim_t = gold.ticker_dim(None, base.select("ticker"), LOAD_TS)
    dim_d = gold.date_dim(base)
    fact = gold.upsert_fact(None, gold.fact_rows(base, dim_t, dim_d, LOAD_TS))
    return dim_t, dim_d, fact, base


def _view(fact, dim_t, dim_d, base) -> DataFrame:
    # bound on a ticker's series measured on the materialised base: the fact
    # only inner-joins unique dimension keys and de-duplicates, so it never
    # holds more rows per ticker than the base.
    return gold.feature_view(fact, dim_t, dim_d, strategy=pick_strategy(base, ["ticker"]))


def _price_sql(c: str) -> str:
    return f"CAST(CAST(round({c}, 9) AS DECIMAL(38,9)) AS DECIMAL(19,4))"


def _gold_ctes(silver_ctes: str) -> str:
    return silver_ctes + f""",
dim_ticker AS (SELECT CAST(row_number() OVER (ORDER BY ticker) AS BIGINT) AS ticker_key, ticker
               FROM (SELECT DISTINCT ticker FROM silver)),
dim_date AS (SELECT DISTINCT CAST(strftime(trade_date, '%Y%m%d') AS INTEGER) AS date_key, trade_date AS full_date
             FROM silver),
fact AS (
  SELECT t.ticker_key, d.date_key,
         date_trunc('second', s.event_time + INTERVAL 500 MILLISECOND) AS event_time,
         {_price_sql('s.open')} AS open_price, {_price_sql('s.high')} AS high_price,
         {_price_sql('s.low')} AS low_price, {_price_sql('s.close')} AS close_price,
         CAST(s.volume AS BIGINT) AS volume,
         {_price_sql('s.ma10')} AS ma10, {_price_sql('s.ma20')} AS ma20,
         {_price_sql('s.ma50')} AS ma50, {_price_sql('s.ma200')} AS ma200,
         TIMESTAMP '{LOAD_TS}' AS load_ts_utc
  FROM silver s JOIN dim_ticker t ON t.ticker = s.ticker JOIN dim_date d ON d.full_date = s.trade_date),
features AS (
  SELECT t.ticker, d.full_date AS feature_date, f.event_time, f.open_price, f.high_price, f.low_price,
         f.close_price, f.volume, f.ma10, f.ma20, f.ma50, f.ma200,
         lead(f.close_price) OVER (PARTITION BY t.ticker ORDER BY f.event_time) AS target_next_close
  FROM fact f JOIN dim_ticker t ON t.ticker_key = f.ticker_key JOIN dim_date d ON d.date_key = f.date_key)"""


GOLD_CTES = _gold_ctes(SILVER_RAW_CTES)


def _features(spark, d) -> DataFrame:
    dim_t, dim_d, fact, base = _gold_tables(spark, d)
    return _view(fact, dim_t, dim_d, base)


# ---------------------------------------------------------------- windows

@register("forward_fill", f"""
WITH {B_CTE}
SELECT event_id, event_type, ts, v AS v_raw,
       last_value(v IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v_filled
FROM b""")
def q_forward_fill(spark, d):
    b = _b(spark, d).select("event_id", "event_type", "ts", F.col("v").alias("v_raw"), F.col("v").alias("v_filled"))
    return forward_fill(b, ["event_type"], ["ts", "event_id"], ["v_filled"])


def _ma_sql(col: str, key: str, order: str, digits: int = 9) -> str:
    return ", ".join(
        f"round(avg({col}) OVER (PARTITION BY {key} ORDER BY {order} "
        f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), {digits}) AS ma{n}" for n in MAS)


@register("moving_averages", f"""
SELECT event_id, event_type, ts, value, {_ma_sql('value', 'event_type', 'ts, event_id')}
FROM events""")
def q_moving_averages(spark, d):
    e = _events(spark, d).select("event_id", "event_type", "ts", "value")
    out = rolling_mean(e, ["event_type"], ["ts", "event_id"], "value", MAS, method="prefix")
    return out.select("event_id", "event_type", "ts", "value", *[F.round(f"ma{n}", 9).alias(f"ma{n}") for n in MAS])


@register("moving_averages_by_user", f"""
WITH {B_CTE}
SELECT event_id, user_id, ts, v, {_ma_sql('v', 'user_id', 'ts, event_id')}
FROM b""")
def q_moving_averages_by_user(spark, d):
    b = _b(spark, d).select("event_id", "user_id", "ts", "v")
    out = rolling_mean(b, ["user_id"], ["ts", "event_id"], "v", MAS)
    return out.select("event_id", "user_id", "ts", "v", *[F.round(f"ma{n}", 9).alias(f"ma{n}") for n in MAS])


@register("moving_sums_exact", """
SELECT event_id, event_type, ts,
       CAST(sum(CAST(value AS DECIMAL(19,4))) OVER w AS DECIMAL(38,4)) AS sum200,
       CAST(count(value) OVER w AS BIGINT) AS n200
FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)""")
def q_moving_sums_exact(spark, d):
    e = _events(spark, d).select("event_id", "event_type", "ts", F.col("value").cast("decimal(19,4)").alias("px"))

    def build(spec):
        frame = spec.rowsBetween(-199, 0)
        return [F.sum("px").over(frame).cast("decimal(38,4)").alias("sum200"),
                F.count("px").over(frame).cast("long").alias("n200")]

    out = series_windows(e, ["event_type"], ["ts", "event_id"], build=build, halo_before=199)
    return out.select("event_id", "event_type", "ts", "sum200", "n200")


@register("lead_target", """
SELECT event_id, event_type, ts, value,
       lead(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS target_next
FROM events""")
def q_lead_target(spark, d):
    e = _events(spark, d).select("event_id", "event_type", "ts", "value")
    return lead_target(e, ["event_type"], ["ts", "event_id"], "value", "target_next")


@register("forward_fill_null_keys", f"""
WITH {B_CTE}, k AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS key, ts, v FROM b)
SELECT event_id, key, last_value(v IGNORE NULLS) OVER (PARTITION BY key ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v_filled
FROM k""")
def q_forward_fill_null_keys(spark, d):
    """Rows without a key are a series of their own, whatever the strategy."""
    key = F.when(F.col("event_type") != "error", F.col("event_type"))
    b = _b(spark, d).select("event_id", key.alias("key"), "ts", F.col("v").alias("v_filled"))
    return forward_fill(b, ["key"], ["ts", "event_id"], ["v_filled"]).select("event_id", "key", "v_filled")


@register("forward_fill_types", """
WITH t AS (SELECT event_id, event_type, ts,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE 9007199254740000 + event_id END AS big,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(value AS DECIMAL(19,4)) END AS price FROM events)
SELECT event_id, last_value(big IGNORE NULLS) OVER w AS big, last_value(price IGNORE NULLS) OVER w AS price
FROM t WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_forward_fill_types(spark, d):
    """Filled columns keep their types: bigint and decimal stay exact."""
    gap = F.col("event_id") % 7 == 0
    t = _events(spark, d).select("event_id", "event_type", "ts",
                                 F.when(~gap, F.lit(9007199254740000) + F.col("event_id")).alias("big"),
                                 F.when(~gap, F.col("value").cast("decimal(19,4)")).alias("price"))
    return forward_fill(t, ["event_type"], ["ts", "event_id"], ["big", "price"]).select("event_id", "big", "price")


@register("row_sample", "SELECT event_id, ts, event_type, value FROM events ORDER BY ts, event_id LIMIT 20")
def q_row_sample(spark, d):
    return row_sample(_events(spark, d).select("event_id", "ts", "event_type", "value"), ["ts", "event_id"], 20)


# ---------------------------------------------------------------- bars, time

@register("hourly_bars", "WITH " + BARS_CTE.replace(
    "CASE WHEN hour(date_trunc('hour', ts)) % 5 = 0 THEN NULL\n              ELSE arg_max(value, (ts, event_id)) END",
    "arg_max(value, (ts, event_id))") + "\nSELECT * FROM bars")
def q_hourly_bars(spark, d):
    bars = build_bars(_events(spark, d), ["event_type"], "ts", "value", None, "1 hour",
                      tie_break=["event_id"], bar_time="event_time")
    return bars.select(F.col("event_type").alias("ticker"), "event_time", "open", "high", "low", "close", "volume")


@register("time_normalize", """
SELECT event_id, ts, ts - INTERVAL 7 HOUR AS ts_utc, CAST(ts AS DATE) AS trade_date
FROM events""")
def q_time_normalize(spark, d):
    e = _events(spark, d)
    return e.select("event_id", "ts", local_to_utc("ts", "Asia/Ho_Chi_Minh").alias("ts_utc"),
                    F.to_date("ts").alias("trade_date"))


@register("second_rounding", """
SELECT event_id, ts, date_trunc('second', ts + INTERVAL 500 MILLISECOND) AS ts_second FROM events""")
def q_second_rounding(spark, d):
    return _events(spark, d).select("event_id", "ts", round_to_second("ts").alias("ts_second"))


@register("dim_date", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
       CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS TINYINT) AS quarter,
       CAST(month(d) AS TINYINT) AS month, CAST(day(d) AS TINYINT) AS day,
       CAST(dayofweek(d) + 1 AS TINYINT) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""")
def q_dim_date(spark, d):
    return gold.date_dim(table(spark, d, "orders"), "o_orderdate")


@register("parse_time_lenient", """
SELECT o_orderkey, CAST(try_cast(s AS TIMESTAMP) AS TIMESTAMP) AS order_ts
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'bad' ELSE CAST(o_orderdate AS VARCHAR) END AS s
      FROM orders)
WHERE try_cast(s AS TIMESTAMP) IS NOT NULL""")
def q_parse_time_lenient(spark, d):
    o = table(spark, d, "orders")
    s = F.when(F.col("o_orderkey") % 5 == 0, F.lit("bad")).otherwise(F.col("o_orderdate").cast("string"))
    return o.select("o_orderkey", parse_time_lenient(s).alias("order_ts")).filter(F.col("order_ts").isNotNull())


# ---------------------------------------------------------------- clean / dedupe (P*, A2, A6, A7)

@register("dedupe_keep_last", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC,
             l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_dedupe_keep_last(spark, d):
    li = table(spark, d, "lineitem")
    return dedupe_keep_last(li, ["l_orderkey", "l_linenumber"],
                                ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
                                 "l_discount", "l_tax", "l_returnflag", "l_linestatus"])


@register("duplicate_keys", """
SELECT CAST(count(*) AS BIGINT) AS duplicate_key_count
FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""")
def q_duplicate_keys(spark, d):
    return duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("normalize_schema", """
SELECT l_orderkey AS order_key, CAST(l_linenumber AS INTEGER) AS line_number, l_quantity AS quantity,
       CAST(l_extendedprice AS DECIMAL(19,4)) AS extended_price, l_discount AS discount,
       upper(l_returnflag) AS return_flag, CAST(l_shipdate AS DATE) AS ship_date
FROM lineitem""")
def q_normalize_schema(spark, d):
    mapping = {
        "order_key": ("l_orderkey", "bigint"), "line_number": ("l_linenumber", "int"),
        "quantity": ("l_quantity", "double"), "extended_price": ("l_extendedprice", "decimal(19,4)"),
        "discount": ("l_discount", "double"), "return_flag": ("l_returnflag", "string"),
        "ship_date": ("l_shipdate", "date"),
    }
    return normalize_schema(table(spark, d, "lineitem"), mapping, upper=["return_flag"])


@register("clean_keys", """
SELECT event_id, k AS ticker, ts, COALESCE(vol, 0) AS volume
FROM (SELECT event_id, ts,
             CASE WHEN event_id % 17 = 0 THEN '  ' WHEN event_id % 19 = 0 THEN NULL ELSE event_type END AS k,
             CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS vol
      FROM events)
WHERE k IS NOT NULL AND length(trim(k)) > 0""")
def q_clean_keys(spark, d):
    e = _events(spark, d).select(
        "event_id", "ts",
        F.when(F.col("event_id") % 17 == 0, F.lit("  ")).when(F.col("event_id") % 19 == 0, F.lit(None))
        .otherwise(F.col("event_type")).alias("ticker"),
        F.when(F.col("event_id") % 3 == 0, F.lit(None).cast("long")).otherwise(F.col("user_id")).alias("volume"),
    )
    return clean_keys(e, "ticker", "ts", defaults={"volume": 0}).select("event_id", "ticker", "ts", "volume")


@register("filter_time_window", """
SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'""")
def q_filter_time_window(spark, d):
    return filter_time_window(_events(spark, d), "ts", "2024-01-05", "2024-01-11")


@register("universe_filter", """
SELECT DISTINCT p_brand FROM part WHERE p_type = 'ECONOMY' AND p_brand IS NOT NULL""")
def q_universe_filter(spark, d):
    return universe_filter(table(spark, d, "part"), "p_brand", {"p_type": "ECONOMY"})


# ---------------------------------------------------------------- quality (A1, Q1-Q3)

def _quality_input(spark, d, defects: bool) -> DataFrame:
    e = _events(spark, d)
    if not defects:
        return e.select(F.col("event_type").alias("ticker"), F.col("ts").alias("event_time"),
                        F.col("value").alias("open"), F.col("value").alias("high"), F.col("value").alias("low"),
                        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("close"),
                        F.col("user_id").alias("volume"))
    return e.select(
        F.col("event_type").alias("ticker"), F.col("ts").alias("event_time"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("open"),
        F.when(F.col("event_id") % 13 == 0, F.col("value") - 60).otherwise(F.col("value")).alias("high"),
        F.col("value").alias("low"), F.col("value").alias("close"),
        (F.col("user_id") - 3).alias("volume"),
    )


def _metrics_sql(src: str) -> str:
    return f"""
SELECT CAST(count(*) AS BIGINT) AS total_rows,
       CAST(COALESCE(sum(CASE WHEN ticker IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS ticker_null_count,
       CAST(COALESCE(sum(CASE WHEN event_time IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS event_time_null_count,
       CAST(COALESCE(sum(CASE WHEN open IS NULL OR isnan(open) OR high IS NULL OR isnan(high) OR low IS NULL
            OR isnan(low) OR close IS NULL OR isnan(close) THEN 1 ELSE 0 END), 0) AS BIGINT) AS ohlc_null_count,
       CAST(COALESCE(sum(CASE WHEN open < 0 OR high < 0 OR low < 0 OR close < 0 THEN 1 ELSE 0 END), 0) AS BIGINT)
            AS invalid_price_count,
       CAST(COALESCE(sum(CASE WHEN high < low OR high < open OR high < close OR low > open OR low > close
            THEN 1 ELSE 0 END), 0) AS BIGINT) AS invalid_ohlc_count,
       CAST(COALESCE(sum(CASE WHEN volume < 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS invalid_volume_count,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT ticker, event_time FROM {src} GROUP BY 1, 2
        HAVING count(*) > 1)) AS duplicate_key_count
FROM {src}"""


QI_CLEAN = """qi AS (SELECT event_type AS ticker, ts AS event_time, value AS open, value AS high, value AS low,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS close, user_id AS volume FROM events)"""
QI_BAD = """qi AS (SELECT event_type AS ticker, ts AS event_time,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS open,
  CASE WHEN event_id % 13 = 0 THEN value - 60 ELSE value END AS high,
  value AS low, value AS close, user_id - 3 AS volume FROM events)"""


@register("quality_metrics", f"WITH {QI_CLEAN}" + _metrics_sql("qi"))
def q_quality_metrics(spark, d):
    return quality_metrics(_quality_input(spark, d, False))


_GATE_UNION = " UNION ALL ".join(
    f"SELECT {i} AS rule_order, '{m}' AS rule, {m} AS violations FROM m" for i, m in enumerate(RULES))


@register("quality_gate", f"WITH {QI_BAD}, m AS ({_metrics_sql('qi')})\n"
                          f"SELECT * FROM ({_GATE_UNION}) WHERE violations > 0")
def q_quality_gate(spark, d):
    return violated(quality_metrics(_quality_input(spark, d, True)))


@register("quality_report", SILVER_CTES + ", m AS (" + _metrics_sql("silver") + ")\n"
          f"SELECT *, '{LOAD_TS[:10]}T00:00:00Z' AS run_ts_utc, '{LOAD_TS[:10]}' AS run_date, 'full' AS mode, "
          f"'{TARGET_DAY}' AS target_date, CAST(NULL AS VARCHAR) AS start_date FROM m")
def q_quality_report(spark, d):
    out = _silver(spark, d)
    rep = report_row(quality_metrics(staged(out, "silver")), f"{LOAD_TS[:10]}T00:00:00Z", "full", TARGET_DAY, None)
    path = scratch_path(spark, "quality_report")
    write_report(rep, path)
    from .operators.quality import REPORT_SCHEMA

    back = spark.read.schema(REPORT_SCHEMA).parquet(path)
    return back.select(*[f.name for f in REPORT_SCHEMA.fields])


# ---------------------------------------------------------------- constraints (M5)

@register("constraint_checks", """
SELECT 'lineitem' AS table_name, 'pk:l_orderkey,l_linenumber' AS check_name,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber
        HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'lineitem', 'not_null:l_shipdate', CAST(count(*) FILTER (WHERE l_shipdate IS NULL) AS BIGINT) FROM lineitem
UNION ALL SELECT 'lineitem', 'not_null:l_quantity', CAST(count(*) FILTER (WHERE l_quantity IS NULL) AS BIGINT) FROM lineitem
UNION ALL SELECT 'lineitem', 'fk:l_orderkey',
       CAST(count(*) AS BIGINT) FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)
UNION ALL SELECT 'lineitem', 'fk:l_partkey',
       CAST(count(*) AS BIGINT) FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL)
UNION ALL SELECT 'lineitem', 'fk:l_suppkey',
       CAST(count(*) AS BIGINT) FROM lineitem WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL)
UNION ALL SELECT 'orders', 'pk:o_orderkey',
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))
UNION ALL SELECT 'orders', 'not_null:o_orderdate', CAST(count(*) FILTER (WHERE o_orderdate IS NULL) AS BIGINT) FROM orders
UNION ALL SELECT 'orders', 'fk:o_custkey',
       CAST(count(*) AS BIGINT) FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)""")
def q_constraint_checks(spark, d):
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    a = check_constraints(li, "lineitem", pk=["l_orderkey", "l_linenumber"], not_null=["l_shipdate", "l_quantity"],
                          fks={"l_orderkey": (o, "o_orderkey"), "l_partkey": (table(spark, d, "part"), "p_partkey"),
                               "l_suppkey": (table(spark, d, "supplier"), "s_suppkey")})
    b = check_constraints(o, "orders", pk=["o_orderkey"], not_null=["o_orderdate"],
                          fks={"o_custkey": (table(spark, d, "customer"), "c_custkey")})
    return a.unionByName(b)


# ---------------------------------------------------------------- upsert / keys

@register("upsert_merge", """
WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
     s AS (SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate,
                  o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority,
       CASE WHEN t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL THEN 'update'
            WHEN t.o_orderkey IS NULL THEN 'insert' ELSE 'keep' END AS action
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey""")
def q_upsert_merge(spark, d):
    o = table(spark, d, "orders")
    target = o.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    source = o.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", F.lit("U").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"),
        "o_orderdate", "o_orderpriority")
    return upsert(target, source, ["o_orderkey"], action_col="action")


@register("dim_key_assign", """
WITH e AS (SELECT o_custkey, CAST(row_number() OVER (ORDER BY o_custkey) AS BIGINT) AS cust_sk
           FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' AND o_custkey IS NOT NULL)),
     n AS (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL
           AND o_custkey NOT IN (SELECT o_custkey FROM e))
SELECT * FROM e
UNION ALL
SELECT o_custkey, CAST((SELECT max(cust_sk) FROM e) + row_number() OVER (ORDER BY o_custkey) AS BIGINT) FROM n""")
def q_dim_key_assign(spark, d):
    o = table(spark, d, "orders")
    early = o.filter(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")).select("o_custkey")
    existing = assign_keys(None, early, "o_custkey", "cust_sk")
    return assign_keys(existing, o.select("o_custkey"), "o_custkey", "cust_sk")


def _dim_ticker_sql() -> str:
    return """
WITH u AS (SELECT DISTINCT 'U' || CAST(user_id AS VARCHAR) AS ticker, ts FROM events),
     e AS (SELECT DISTINCT ticker FROM u WHERE ts < TIMESTAMP '2024-01-02'),
     ek AS (SELECT CAST(row_number() OVER (ORDER BY ticker) AS BIGINT) AS ticker_key, ticker FROM e),
     a AS (SELECT DISTINCT ticker FROM u),
     nk AS (SELECT CAST((SELECT COALESCE(max(ticker_key), 0) FROM ek) + row_number() OVER (ORDER BY ticker) AS BIGINT)
                   AS ticker_key, ticker FROM a WHERE ticker NOT IN (SELECT ticker FROM e))
SELECT ticker_key, ticker, CAST(NULL AS VARCHAR) AS sector, 'HOSE' AS exchange, true AS is_active,
       TIMESTAMP '2024-01-02 00:00:00' AS created_at, TIMESTAMP '2024-02-01 00:00:00' AS updated_at FROM ek
UNION ALL
SELECT ticker_key, ticker, CAST(NULL AS VARCHAR), 'HOSE', true,
       TIMESTAMP '2024-02-01 00:00:00', TIMESTAMP '2024-02-01 00:00:00' FROM nk"""


@register("dim_ticker", _dim_ticker_sql())
def q_dim_ticker(spark, d):
    e = _events(spark, d).select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"), "ts")
    first = gold.ticker_dim(None, e.filter(F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz")),
                            "2024-01-02 00:00:00")
    return gold.ticker_dim(first, e, LOAD_TS)


# ---------------------------------------------------------------- star schema

@register("star_join", """
SELECT c.c_mktsegment, CAST(o.o_orderdate AS DATE) AS order_date,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(19,4))) AS DECIMAL(38,4)) AS revenue,
       CAST(count(*) AS BIGINT) AS n_orders
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
GROUP BY 1, 2""")
def q_star_join(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    # join first: almost every (customer, day) is unique, so aggregating before
    # the join would only add a shuffle. customer is a dimension (one row per
    # key); AQE broadcasts it when its measured size allows.
    j = o.select("o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("order_date")).join(
        c.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    return j.groupBy("c_mktsegment", "order_date").agg(
        F.sum(F.col("o_totalprice").cast("decimal(19,4)")).cast("decimal(38,4)").alias("revenue"),
        F.count(F.lit(1)).cast("long").alias("n_orders"))


@register("silver_full", SILVER_CTES + "\nSELECT * FROM silver")
def q_silver_full(spark, d):
    return _silver(spark, d)


@register("silver_incremental", SILVER_CTES + f"\nSELECT * FROM silver WHERE trade_date = DATE '{TARGET_DAY}'")
def q_silver_incremental(spark, d):
    day = dt.date.fromisoformat(TARGET_DAY)
    bars = _bars(spark, d)
    # published silver up to the day before, as a partitioned table
    path = scratch_path(spark, "silver_history")
    publish(silver.enrich(bars.filter(F.col("trade_date") < F.lit(TARGET_DAY).cast("date"))),
            path, ["trade_date"], mode="full", sort_by=["ticker", "event_time"])
    history = scan_partitioned(spark, path)
    new = bars.filter(F.col("trade_date") == F.lit(TARGET_DAY).cast("date"))
    out = silver.incremental(new, history, day, lookback_days=3)
    return out.select("ticker", "event_time", "open", "high", "low", "close", "volume",
                      *[F.round(f"ma{n}", 9).alias(f"ma{n}") for n in MAS], "trade_date")


@register("gold_fact", GOLD_CTES + "\nSELECT * FROM fact")
def q_gold_fact(spark, d):
    return _gold_tables(spark, d)[2]


@register("feature_view", GOLD_CTES + "\nSELECT * FROM features")
def q_feature_view(spark, d):
    return _features(spark, d)


@register("landing_gaps", """
WITH bars AS (SELECT DISTINCT event_type AS ticker, date_trunc('hour', ts) AS event_time FROM events),
slots AS (SELECT event_time, row_number() OVER (ORDER BY event_time) AS slot FROM (SELECT DISTINCT event_time FROM bars)),
universe AS (SELECT ticker FROM bars UNION SELECT n_name FROM nation),
missing AS (SELECT ticker, slot, event_time FROM universe, slots
            WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.ticker = universe.ticker AND b.event_time = slots.event_time)),
runs AS (SELECT *, slot - row_number() OVER (PARTITION BY ticker ORDER BY slot) AS run FROM missing)
SELECT ticker, min(event_time) AS first_missing, max(event_time) AS last_missing, CAST(count(*) AS BIGINT) AS n_missing
FROM runs GROUP BY ticker, run""")
def q_landing_gaps(spark, d):
    """The universe: the keys of events, and the nations, none of which has a bar."""
    bars = build_bars(_events(spark, d), ["event_type"], "ts", "value", None, "1 hour", tie_break=["event_id"], bar_time="event_time")
    names = _events(spark, d).select("event_type").union(table(spark, d, "nation").select("n_name"))
    return landing_gaps(bars.withColumnRenamed("event_type", "ticker"), names, strategy="auto")


@register("fact_key_assign", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_keys, CAST(1 AS BIGINT) AS lowest, CAST(count(*) AS BIGINT) AS highest,
       CAST(count(*) FILTER (WHERE l_shipdate < DATE '1995-06-17') AS BIGINT) AS kept
FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) l_orderkey, l_linenumber,
             min(l_shipdate) OVER (PARTITION BY l_orderkey, l_linenumber) AS l_shipdate FROM lineitem)""")
def q_fact_key_assign(spark, d):
    """Keys of a fact in two loads, the second holding all rows of the first: dense,
    unique, and kept through the merge."""
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("ticker_key"), F.col("l_linenumber").alias("event_time")).agg(
        F.min("l_shipdate").alias("day"))
    early = rows.where(F.col("day") < F.lit("1995-06-17").cast("date"))
    none = early.select("ticker_key", "event_time", F.lit(None).cast("long").alias("fact_price_key")).limit(0)
    first = staged(gold.with_fact_keys(early, none, 0), "first_load")
    high = first.agg(F.max("fact_price_key")).first()[0] or 0
    second = staged(gold.with_fact_keys(rows, first, high), "second_load")
    same = first.select("ticker_key", "event_time", F.col("fact_price_key").alias("before"))
    kept = second.join(same, ["ticker_key", "event_time"], "left")
    return kept.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("fact_price_key").alias("n_keys"), F.min("fact_price_key").alias("lowest"),
                    F.max("fact_price_key").alias("highest"), F.count_if(F.col("fact_price_key") == F.col("before")).alias("kept"))


@register("validation_snapshot", GOLD_CTES + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM dim_ticker) AS dim_ticker_count,
       (SELECT CAST(count(*) AS BIGINT) FROM dim_date) AS dim_date_count,
       (SELECT CAST(count(*) AS BIGINT) FROM fact) AS fact_prices_count,
       (SELECT CAST(count(*) AS BIGINT) FROM features) AS ml_feature_rows""")
def q_validation_snapshot(spark, d):
    dim_t, dim_d, fact, base = _gold_tables(spark, d)
    return gold.validation_snapshot(dim_t, dim_d, fact, _view(fact, dim_t, dim_d, base))


@register("supervised_set", GOLD_CTES + "\nSELECT * FROM features WHERE target_next_close IS NOT NULL")
def q_supervised_set(spark, d):
    return supervised_set(_features(spark, d))


# ---------------------------------------------------------------- evaluation

@register("time_split", """
WITH k AS (SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key FROM events),
     c AS (SELECT CAST(quantile_disc(date_key, 0.8) AS INTEGER) AS cut_key FROM (SELECT DISTINCT date_key FROM k))
SELECT CASE WHEN date_key <= cut_key THEN 'train' ELSE 'test' END AS split,
       CAST(count(*) AS BIGINT) AS n_rows, min(date_key) AS first_key, max(date_key) AS last_key
FROM k, c GROUP BY 1""")
def q_time_split(spark, d):
    k = _events(spark, d).select("event_id", date_key("ts").alias("date_key"))
    s = time_split(k, "date_key", 0.8)
    return s.groupBy("split").agg(F.count(F.lit(1)).cast("long").alias("n_rows"),
                                  F.min("date_key").alias("first_key"), F.max("date_key").alias("last_key"))


def _lag_lead(spark, d) -> DataFrame:
    e = _events(spark, d).select("event_id", "event_type", "ts", "value")

    def build(spec):
        return [F.lag("value").over(spec).alias("prev_value"), F.lead("value").over(spec).alias("next_value")]

    return series_windows(e, ["event_type"], ["ts", "event_id"], build=build, halo_before=1, halo_after=1)


LAG_LEAD_CTE = """x AS (SELECT event_type, value,
  lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev_value,
  lead(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS next_value FROM events)"""


@register("naive_metrics", f"""
WITH {LAG_LEAD_CTE}
SELECT event_type, CAST(count(*) AS BIGINT) AS n,
       round(avg((next_value - value) * (next_value - value)), 6) AS mse,
       round(sqrt(avg((next_value - value) * (next_value - value))), 6) AS rmse,
       round(avg(abs(next_value - value)), 6) AS mae
FROM x WHERE next_value IS NOT NULL GROUP BY 1""")
def q_naive_metrics(spark, d):
    # naive forecast of the next value: the current value
    return error_metrics(_lag_lead(spark, d), "event_type", "next_value", "value")


@register("directional_accuracy", f"""
WITH {LAG_LEAD_CTE}
SELECT event_type, CAST(count(*) AS BIGINT) AS n,
       round(avg(CAST(CASE WHEN sign(next_value - value) = sign(value + (value - prev_value) - value) THEN 1 ELSE 0 END
             AS DOUBLE)), 9) AS directional_accuracy
FROM x WHERE next_value IS NOT NULL AND prev_value IS NOT NULL GROUP BY 1""")
def q_directional_accuracy(spark, d):
    # momentum forecast: value + last move
    x = _lag_lead(spark, d).withColumn("predicted", F.col("value") + (F.col("value") - F.col("prev_value")))
    return directional_accuracy(x, "event_type", "next_value", "predicted", "value")


@register("top_movers", """
SELECT * FROM (
  SELECT CAST(ts AS DATE) AS day, event_id, event_type, value,
         row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY value DESC, event_id) AS rank
  FROM events) WHERE rank <= 3""")
def q_top_movers(spark, d):
    e = _events(spark, d).select(F.to_date("ts").alias("day"), "event_id", "event_type", "value")
    return top_k_per_group(e, "day", [F.col("value").desc(), F.col("event_id")], 3)


DAILY_CTE = GOLD_CTES + """,
daily AS (SELECT ticker, feature_date, arg_max(close_price, event_time) AS actual_close
          FROM features GROUP BY 1, 2),
naive AS (SELECT ticker, feature_date AS prediction_date,
                 lag(actual_close) OVER (PARTITION BY ticker ORDER BY feature_date) AS predicted_close
          FROM daily)"""


def _daily(spark, d) -> DataFrame:
    f = _features(spark, d)
    return f.groupBy("ticker", "feature_date").agg(F.max_by("close_price", "event_time").alias("actual_close"))


def _naive_predictions(daily: DataFrame) -> DataFrame:
    """Naive daily forecast: yesterday's close. One row per ticker and day is a
    bounded series (<= 366 rows per key and year), so a plain window is safe."""
    spec = Window.partitionBy("ticker").orderBy("feature_date")
    return daily.select("ticker", F.col("feature_date").alias("prediction_date"),
                        F.lag("actual_close").over(spec).alias("predicted_close"))


@register("actual_vs_pred", DAILY_CTE + """
SELECT d.ticker, d.feature_date, d.actual_close, p.predicted_close,
       d.actual_close - p.predicted_close AS error
FROM daily d LEFT JOIN naive p ON p.ticker = d.ticker AND p.prediction_date = d.feature_date""")
def q_actual_vs_pred(spark, d):
    daily = _daily(spark, d)
    pred = _naive_predictions(daily).withColumnRenamed("prediction_date", "feature_date")
    j = daily.join(pred, ["ticker", "feature_date"], "left")
    return j.select("ticker", "feature_date", "actual_close", "predicted_close",
                    (F.col("actual_close") - F.col("predicted_close")).alias("error"))


@register("predictions_upsert", DAILY_CTE + f""",
t AS (SELECT * FROM naive WHERE prediction_date < DATE '2024-01-20'),
s AS (SELECT ticker, feature_date AS prediction_date, actual_close AS predicted_close FROM daily
      WHERE feature_date >= DATE '2024-01-15')
SELECT COALESCE(t.ticker, s.ticker) AS ticker, COALESCE(t.prediction_date, s.prediction_date) AS prediction_date,
       CASE WHEN s.ticker IS NOT NULL THEN s.predicted_close ELSE t.predicted_close END AS predicted_close
FROM t FULL OUTER JOIN s ON t.ticker = s.ticker AND t.prediction_date = s.prediction_date""")
def q_predictions_upsert(spark, d):
    daily = _daily(spark, d)
    old = _naive_predictions(daily).filter(F.col("prediction_date") < F.lit("2024-01-20").cast("date"))
    new = daily.filter(F.col("feature_date") >= F.lit("2024-01-15").cast("date")).select(
        "ticker", F.col("feature_date").alias("prediction_date"), F.col("actual_close").alias("predicted_close"))
    return upsert(old, new, ["ticker", "prediction_date"])


@register("metrics_history", f"""
WITH {LAG_LEAD_CTE}
SELECT run_id, event_type, CAST(count(*) AS BIGINT) AS n,
       round(avg((next_value - value) * (next_value - value)), 6) AS mse,
       round(sqrt(avg((next_value - value) * (next_value - value))), 6) AS rmse,
       round(avg(abs(next_value - value)), 6) AS mae
FROM x, (SELECT 1 AS run_id UNION ALL SELECT 2) r WHERE next_value IS NOT NULL GROUP BY 1, 2""")
def q_metrics_history(spark, d):
    path = scratch_path(spark, "metrics_history")
    m = error_metrics(_lag_lead(spark, d), "event_type", "next_value", "value")
    for run in (1, 2):  # two runs appended to the same history table
        append(m.select(F.lit(run).alias("run_id"), "*"), path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- scans and sinks

def _land_events(spark, d, path: str) -> None:
    e = _events(spark, d)
    publish(e.withColumn("trade_date", F.to_date("ts")), path, ["trade_date"], mode="full", sort_by=["ts"])


@register("scan_partitioned", """
SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS trade_date FROM events""")
def q_scan_partitioned(spark, d):
    path = scratch_path(spark, "events_by_day")
    _land_events(spark, d, path)
    return scan_partitioned(spark, path).select("event_id", "ts", "user_id", "event_type", "value", "props",
                                                F.col("trade_date").cast("date"))


@register("scan_partition_window", """
SELECT event_id, ts, value, CAST(ts AS DATE) AS trade_date FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'""")
def q_scan_partition_window(spark, d):
    path = scratch_path(spark, "events_by_day")
    _land_events(spark, d, path)
    return read_window(spark, path, "trade_date", "2024-01-05", "2024-01-11").select(
        "event_id", "ts", "value", F.col("trade_date").cast("date"))


@register("scan_recursive", "SELECT event_id, ts, event_type, value FROM events")
def q_scan_recursive(spark, d):
    path = scratch_path(spark, "nested")
    e = _events(spark, d).select("event_id", "ts", "event_type", "value")
    # recursive lookup disables discovery: partition values are no columns of
    # the scan, so the type is in the files as well
    nested = e.withColumn("y", F.year("ts")).withColumn("m", F.month("ts")).withColumn("folder", F.col("event_type"))
    nested.write.partitionBy("y", "m", "folder").parquet(path)
    return scan_recursive(spark, path).select("event_id", "ts", "event_type", "value")


@register("path_key_recovery", """
SELECT event_id, replace(event_type, 'c', 'c ') AS ticker, ts, value FROM events""")
def q_path_key_recovery(spark, d):
    root = scratch_path(spark, "mixed_layout")
    e = _events(spark, d).select("event_id", "ts", "value",
                                 F.regexp_replace("event_type", "c", "c ").alias("ticker"),
                                 F.to_date("ts").alias("trade_date"))
    early = e.filter(F.col("trade_date") < F.lit("2024-01-15").cast("date"))
    late = e.filter(F.col("trade_date") >= F.lit("2024-01-15").cast("date"))
    # two historical layouts under one root: trade_date=/ticker=/ and ticker=/
    early.write.partitionBy("trade_date", "ticker").parquet(root)
    late.write.mode("append").partitionBy("ticker").parquet(f"{root}/legacy")
    return read_with_path_key(spark, root, key="ticker").select("event_id", "ticker", "ts", "value")


@register("partition_overwrite", """
SELECT event_id, ts, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN value + 1 ELSE value END AS value,
       CAST(ts AS DATE) AS trade_date FROM events""")
def q_partition_overwrite(spark, d):
    path = scratch_path(spark, "events_days")
    e = _events(spark, d).select("event_id", "ts", "value", F.to_date("ts").alias("trade_date"))
    publish(e, path, ["trade_date"], mode="full")
    # read-modify-write of one day of the table that is being written
    day = spark.read.parquet(path).filter(F.col("trade_date") == F.lit("2024-01-10").cast("date"))
    staged_overwrite(day.withColumn("value", F.col("value") + 1), path, ["trade_date"])
    return spark.read.parquet(path).select("event_id", "ts", "value", F.col("trade_date").cast("date"))


@register("bronze_land", """
SELECT upper(event_type) AS ticker, ts AS event_time, CAST(ts AS DATE) AS trade_date,
       CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-27' THEN value + 0.5 ELSE value END AS close,
       CAST(user_id AS BIGINT) AS volume
FROM events""")
def q_bronze_land(spark, d):
    root = scratch_path(spark, "bronze")
    e = _events(spark, d)
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")

    def delivery(bump: float, seq: int) -> DataFrame:
        return e.select(
            F.upper("event_type").alias("Ticker"), (micros * 1000).alias("Time"),
            *[(F.col("value") + bump).alias(c) for c in ("Open", "High", "Low", "Close")],
            F.col("user_id").alias("Volume"), F.to_date("ts").alias("Trade_date"), F.lit(seq).alias("_seq"))

    first = delivery(0.0, 1)
    refetch = delivery(0.5, 2).filter(F.col("Trade_date") >= F.lit("2024-01-27").cast("date"))  # daily 3-day overlap
    # raw events, not bars: a (day, key) is unbounded -> range clustering
    land_bronze(first.unionByName(refetch), root, delivery_order=["_seq"], cluster="range")
    back = silver.normalize_bronze(scan_partitioned(spark, root), zone="UTC")
    return back.select("ticker", "event_time", "trade_date", "close", "volume")


# ---------------------------------------------------------------- run windows

@register("ingest_window", """
SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n_events FROM events
WHERE ts >= TIMESTAMP '2024-01-27' AND ts < TIMESTAMP '2024-01-31' GROUP BY 1""")
def q_ingest_window(spark, d):
    lo, hi = ingest_window("daily", "2024-01-30")
    w = filter_time_window(_events(spark, d), "ts", lo, hi)
    return w.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).cast("long").alias("n_events"))


@register("load_window", """
SELECT min(CAST(o_orderdate AS DATE)) AS window_start, DATE '2000-12-31' AS window_end,
       CAST(count(*) FILTER (WHERE CAST(o_orderdate AS DATE) <= DATE '2000-12-31') AS BIGINT) AS n_rows
FROM orders""")
def q_load_window(spark, d):
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("full_date"))
    lo, hi = load_window(o, "full_date", None, "2000-12-31")  # two dates
    inside = o.filter(F.col("full_date").between(F.lit(str(lo)).cast("date"), F.lit(str(hi)).cast("date")))
    return inside.agg(F.lit(str(lo)).cast("date").alias("window_start"), F.lit(str(hi)).cast("date").alias("window_end"),
                      F.count(F.lit(1)).cast("long").alias("n_rows"))


@register("batch_slices", """
WITH x AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders),
     lo AS (SELECT min(d) AS lo FROM x)
SELECT CAST(floor(datediff('day', lo, d) / 93) AS INTEGER) AS slice_id,
       CAST(lo + CAST(floor(datediff('day', lo, d) / 93) AS INTEGER) * 93 AS DATE) AS slice_start,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT d) AS BIGINT) AS n_days
FROM x, lo GROUP BY 1, 2""")
def q_batch_slices(spark, d):
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("d"))
    lo, _ = load_window(o, "d")  # two dates
    x = o.withColumn("lo", F.lit(str(lo)).cast("date"))
    sid = slice_column("d", lo, 93)
    return x.groupBy(sid.alias("slice_id"), F.date_add("lo", sid * 93).alias("slice_start")).agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"), F.countDistinct("d").cast("long").alias("n_days"))


# ---------------------------------------------------------------- end-to-end pipelines (written tables)

GAP_BARS_CTE = """
bars AS (
  SELECT ticker, event_time,
         CASE WHEN hour(event_time) % 5 = 0 THEN NULL ELSE open END AS open,
         CASE WHEN hour(event_time) % 5 = 0 THEN NULL ELSE high END AS high,
         CASE WHEN hour(event_time) % 5 = 0 THEN NULL ELSE low END AS low,
         CASE WHEN hour(event_time) % 5 = 0 THEN NULL ELSE close END AS close, volume
  FROM (SELECT event_type AS ticker, date_trunc('hour', ts) AS event_time,
               arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
               arg_max(value, (ts, event_id)) AS close, count(*) AS volume
        FROM events GROUP BY 1, 2))"""
PIPE_SILVER_CTES = "WITH " + GAP_BARS_CTE + "," + _fill_ma_ctes("bars")
PIPE_GOLD_CTES = _gold_ctes("WITH " + GAP_BARS_CTE + "," + _fill_ma_ctes("bars", None))
RUN_TS = "2024-02-01T00:00:00Z"


def _land_events_bronze(spark, d, root: str, before: str | None = None, since: str | None = None) -> None:
    """Hourly bars of events landed as vendor bronze (naive ns time); a gap
    hour (hour % 5 == 0) is a bar whose four prices are all missing."""
    e = _events(spark, d)
    if before:
        e = e.filter(F.col("ts") < F.lit(before).cast("timestamp_ntz"))
    if since:
        e = e.filter(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    _land_bars(e, root)


def _land_bars(e: DataFrame, root: str) -> None:
    bars = build_bars(e, ["event_type"], "ts", "value", None, "1 hour", tie_break=["event_id"], bar_time="t")
    gap = F.hour("t") % 5 == 0
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', t)")
    land_bronze(bars.select(
        F.col("event_type").alias("Ticker"), (micros * 1000).alias("Time"),
        *[F.when(gap, F.lit(None).cast("double")).otherwise(F.col(c.lower())).alias(c)
          for c in ("Open", "High", "Low", "Close")],
        F.col("volume").alias("Volume"), F.to_date("t").alias("Trade_date")), root)


def _published_silver(spark, path: str) -> DataFrame:
    out = scan_partitioned(spark, path, types={"ticker": "string"})
    return out.select("ticker", "event_time", "open", "high", "low", "close", "volume",
                      *[F.round(f"ma{n}", 9).alias(f"ma{n}") for n in MAS], F.col("trade_date").cast("date"))


def _run_pipeline_silver(spark, d) -> str:
    root = scratch_path(spark, "pipeline")
    _land_events_bronze(spark, d, f"{root}/bronze")
    silver.run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/report", "full", "2024-01-30",
                      RUN_TS, zone="UTC")
    return root


@register("pipeline_silver_full", PIPE_SILVER_CTES + "\nSELECT * FROM silver")
def q_pipeline_silver_full(spark, d):
    """bronze landing -> run_silver(full): report, gate, static publish."""
    return _published_silver(spark, f"{_run_pipeline_silver(spark, d)}/silver")


@register("pipeline_silver_incremental", PIPE_SILVER_CTES + f"\nSELECT * FROM silver WHERE trade_date = DATE '{TARGET_DAY}'")
def q_pipeline_silver_incremental(spark, d):
    """Days before the target landed and published in full; then the target
    day lands and run_silver(incremental) carries context from the published
    table (dynamic overwrite of that day only)."""
    root = scratch_path(spark, "pipeline_inc")
    _land_events_bronze(spark, d, f"{root}/bronze", before=TARGET_DAY)
    silver.run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/report", "full", TARGET_DAY, RUN_TS,
                      zone="UTC")
    _land_events_bronze(spark, d, f"{root}/bronze", since=TARGET_DAY)
    silver.run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/report", "incremental", TARGET_DAY,
                      RUN_TS, zone="UTC", lookback_days=3)
    out = _published_silver(spark, f"{root}/silver")
    return out.filter(F.col("trade_date") == F.lit(TARGET_DAY).cast("date"))


@register("pipeline_silver_stream", PIPE_SILVER_CTES + "\nSELECT * FROM silver")
def q_pipeline_silver_stream(spark, d):
    """Structured Streaming silver: bronze before the target day lands and an
    availableNow stream publishes it; the target day and later land and the
    same stream (same checkpoint) picks up only the new files, recomputing
    silver from the earliest new day with context carried from published
    silver. The published table equals a full rebuild."""
    from .streaming import start_silver_stream

    root = scratch_path(spark, "pipeline_stream")
    ckpt = f"{root}/stream-checkpoint"
    for landing in ({"before": TARGET_DAY}, {"since": TARGET_DAY}):
        _land_events_bronze(spark, d, f"{root}/bronze", **landing)
        q = start_silver_stream(spark, f"{root}/bronze", f"{root}/silver", f"{root}/report", RUN_TS,
                                checkpoint=ckpt, zone="UTC", lookback_days=3)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return _published_silver(spark, f"{root}/silver")


@register("pipeline_gold_features", PIPE_GOLD_CTES + "\nSELECT * FROM features")
def q_pipeline_gold_features(spark, d):
    """run_silver(full) -> run_gold twice (second run upserts the same rows)
    -> feature view over the published gold tables."""
    root = _run_pipeline_silver(spark, d)
    for _ in range(2):
        gold.run_gold(spark, f"{root}/silver", f"{root}/gold", LOAD_TS, zone="UTC")
    dim_t = spark.read.parquet(f"{root}/gold/dim_ticker")
    dim_d = spark.read.parquet(f"{root}/gold/dim_date")
    fact = scan_partitioned(spark, f"{root}/gold/fact_prices").withColumn("date_key", F.col("date_key").cast("int"))
    return gold.feature_view(fact, dim_t, dim_d)


LATE_KEY, LATE_DAY = "click", "2024-01-12"


@register("pipeline_silver_late_key", PIPE_SILVER_CTES + "\nSELECT * FROM silver")
def q_pipeline_silver_late_key(spark, d):
    """One key's bars of one day land after silver was built: the key alone is
    computed anew, from that day until its averages meet the old ones. The
    published table equals a full rebuild."""
    root = scratch_path(spark, "pipeline_late")
    _land_events_bronze(spark, d, f"{root}/all")
    late = (F.col("Ticker") == LATE_KEY) & (F.to_date("Trade_date") == F.lit(LATE_DAY).cast("date"))
    args = (f"{root}/bronze", f"{root}/silver", f"{root}/report")
    for k, cond in enumerate((~late, late)):
        landed = scan_partitioned(spark, f"{root}/all").where(cond).withColumn("Trade_date", F.to_date("Trade_date"))
        land_bronze(landed, f"{root}/bronze")
        if k == 0:
            silver.run_silver(spark, *args, "full", "2024-01-30", RUN_TS, zone="UTC")
        else:
            changes = landed.select(F.col("Ticker").alias("ticker"), F.col("Trade_date").alias("trade_date")).distinct()
            silver.run_silver_changes(spark, *args, changes, RUN_TS, zone="UTC")
    return _published_silver(spark, f"{root}/silver")


THIN_KEY = f"concat(CASE WHEN user_id % 20 >= 17 AND ts >= TIMESTAMP '{TARGET_DAY}' THEN 'new-' ELSE '' END, CAST(user_id % 20 AS VARCHAR))"


@register("pipeline_silver_thin_keys", PIPE_SILVER_CTES.replace("event_type", THIN_KEY) + f"\nSELECT * FROM silver WHERE trade_date = DATE '{TARGET_DAY}'")
def q_pipeline_silver_thin_keys(spark, d):
    """Keys with few bars a day, and keys that begin on the target day: the
    incremental run takes their context from the series state, never from the
    history."""
    root = scratch_path(spark, "pipeline_thin")
    since = F.lit(TARGET_DAY).cast("timestamp_ntz")
    n = (F.col("user_id") % 20).cast("string")
    key = F.when((F.col("user_id") % 20 >= 17) & (F.col("ts") >= since), F.concat(F.lit("new-"), n)).otherwise(n)
    events = _events(spark, d).withColumn("event_type", key)
    args = (f"{root}/bronze", f"{root}/silver", f"{root}/report")
    for mode, part in (("full", F.col("ts") < since), ("incremental", F.col("ts") >= since)):
        _land_bars(events.where(part), f"{root}/bronze")
        silver.run_silver(spark, *args, mode, TARGET_DAY, RUN_TS, zone="UTC")
    out = _published_silver(spark, f"{root}/silver")
    return out.filter(F.col("trade_date") == F.lit(TARGET_DAY).cast("date"))


START_DAY = "2024-01-10"


@register("silver_start_bound", PIPE_SILVER_CTES.replace("FROM events GROUP BY 1, 2))", f"FROM events WHERE ts >= TIMESTAMP '{START_DAY}' GROUP BY 1, 2))") + """
SELECT * REPLACE (event_time - INTERVAL 7 HOUR AS event_time) FROM silver""")
def q_silver_start_bound(spark, d):
    """A full rebuild from a start date: the bound is a local trade date, so the
    first day is whole although its first hours are the day before in UTC."""
    root = scratch_path(spark, "pipeline_start")
    _land_events_bronze(spark, d, f"{root}/bronze")
    silver.run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/report", "full", "2024-01-30", RUN_TS,
                      start_date=START_DAY, zone="Asia/Ho_Chi_Minh")
    return _published_silver(spark, f"{root}/silver")


LEADING_CTE = GAP_BARS_CTE.replace("THEN NULL ELSE high END", "THEN NULL ELSE 1e6 END").replace("THEN NULL ELSE low END", "THEN NULL ELSE CAST(0 AS DOUBLE) END").replace("THEN NULL ELSE open END AS open", "OR (ticker <> 'click' AND event_time < TIMESTAMP '2024-01-24') THEN NULL ELSE open END AS open").replace(
    "THEN NULL ELSE close END AS close", "OR event_time >= TIMESTAMP '2024-01-25' THEN NULL ELSE close END AS close")


@register("silver_incremental_leading_nulls", "WITH " + LEADING_CTE + "," + _fill_ma_ctes("bars")
          + f"\nSELECT * FROM silver WHERE trade_date = DATE '{TARGET_DAY}'")
def q_silver_incremental_leading_nulls(spark, d):
    """Prices that begin at different times: open is missing until the day
    before the target, close from the target on. Silver left those early rows
    out, yet an incremental run equals a full rebuild."""
    root = scratch_path(spark, "pipeline_leading")

    def land(**bounds) -> None:
        _land_events_bronze(spark, d, f"{root}/raw", **bounds)
        raw = scan_partitioned(spark, f"{root}/raw")
        local = F.to_date("Trade_date")
        early = (F.col("Ticker") != "click") & (local < F.lit("2024-01-24").cast("date"))
        late = local >= F.lit(TARGET_DAY).cast("date")
        keep = raw.where(local >= F.lit(bounds["since"]).cast("date")) if "since" in bounds else raw
        wide = [F.when(F.col(c).isNotNull(), F.lit(v)).alias(c) for c, v in (("High", 1e6), ("Low", 0.0))]  # always bracket
        land_bronze(keep.select("Ticker", "Time", F.when(~early, F.col("Open")).alias("Open"), *wide,
                                F.when(~late, F.col("Close")).alias("Close"), "Volume", local.alias("Trade_date")), f"{root}/bronze")

    args = (f"{root}/bronze", f"{root}/silver", f"{root}/report")
    land(before=TARGET_DAY)
    silver.run_silver(spark, *args, "full", TARGET_DAY, RUN_TS, zone="UTC")
    land(since=TARGET_DAY)
    silver.run_silver(spark, *args, "incremental", TARGET_DAY, RUN_TS, zone="UTC", lookback_days=3)
    out = _published_silver(spark, f"{root}/silver")
    return out.filter(F.col("trade_date") == F.lit(TARGET_DAY).cast("date"))


@register("bronze_reference_layout", """
SELECT printf('%03d', CAST(user_id % 20 AS INTEGER)) AS ticker, ts AS event_time, CAST(ts AS DATE) AS trade_date,
       value AS close, user_id AS volume FROM events""")
def q_bronze_reference_layout(spark, d):
    """Lower-case day and key folders, keys with leading zeros, integer
    nanosecond times."""
    root = scratch_path(spark, "bronze_layout")
    e = _events(spark, d)
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    rows = e.select(F.to_date("ts").alias("trade_date"), F.format_string("%03d", (F.col("user_id") % 20).cast("int")).alias("ticker"),
                    (micros * 1000).alias("Time"), *[F.col("value").alias(c) for c in ("Open", "High", "Low", "Close")],
                    F.col("user_id").alias("Volume"))
    rows.repartition("trade_date").write.partitionBy("trade_date", "ticker").parquet(root)
    out = silver.normalize_bronze(silver.read_bronze(spark, root), zone="UTC")
    return out.select("ticker", "event_time", "trade_date", "close", "volume")


@register("fact_cross_day_upsert", """
WITH s AS (SELECT event_type AS ticker, CAST(ts AS DATE) AS day, max(value) AS v FROM events GROUP BY 1, 2),
     t AS (SELECT ticker, CAST(row_number() OVER (ORDER BY ticker) AS BIGINT) AS ticker_key FROM (SELECT DISTINCT ticker FROM s))
SELECT ticker_key, CAST(strftime(day + INTERVAL 1 DAY, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(day + INTERVAL 1 DAY AS TIMESTAMP) AS event_time, CAST(v AS DECIMAL(19,4)) AS close_price
FROM s JOIN t USING (ticker)""")
def q_fact_cross_day_upsert(spark, d):
    """A bar just before midnight, then one at midnight in a second load: they
    round to the same second and day, so the second replaces the first."""
    root = scratch_path(spark, "gold_midnight")
    days = _events(spark, d).groupBy(F.col("event_type").alias("ticker"), F.to_date("ts").alias("day")).agg(F.max("value").alias("v"))

    def load(at, bump: float, name: str) -> None:
        price = F.col("v") + bump
        rows = days.select("ticker", at.alias("event_time"), *[price.alias(c) for c in ("open", "high", "low", "close")],
                           F.lit(1).cast("long").alias("volume"), *[price.alias(f"ma{n}") for n in MAS], F.to_date(at).alias("trade_date"))
        publish(rows, f"{root}/{name}", ["trade_date"])
        gold.run_gold(spark, f"{root}/{name}", f"{root}/gold", LOAD_TS, zone="UTC")

    midnight = F.date_add("day", 1).cast("timestamp_ntz")
    load(midnight - F.expr("INTERVAL '0.3' SECOND"), 1.0, "before")
    load(midnight, 0.0, "at")
    return gold.read_table(spark, f"{root}/gold", "fact_prices").select("ticker_key", "date_key", "event_time", "close_price")
