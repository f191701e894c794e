"""Gold layer: date and ticker dimensions, the price fact and the feature
view, published as Parquet tables with idempotent upserts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import combine_one_row
from ..functions.time import date_attributes, round_to_second, to_price
from ..operators.clean import dedupe_keep_last
from ..operators.constraints import check_constraints, enforce_constraints
from ..operators.series import lead_target, pick_strategy
from ..operators.upsert import assign_keys, number_rows, upsert
from ..session import delete_path, staged, staging_scope
from ..sources.path_index import files_in_window, path_index
from ..sources.scan import dataset_exists, read_with_path_key, scan_partitioned
from ..sources.sinks import publish
from ..sources.versions import apply_pending as complete_silver
from .windows import EmptyWindow
from .windows import _date as as_date

#: Length of a ticker in the serving layer's schema.
TICKER_CHARS = 16
#: When a silver file was written, where a scan knows it (newer rows win).
WRITTEN = "_bl_written"

# Fixed gold table schemas (the serving layer's DDL, as Spark types).
DIM_TICKER_SCHEMA = T.StructType([
    T.StructField("ticker_key", T.LongType(), False),
    T.StructField("ticker", T.StringType(), False),
    T.StructField("sector", T.StringType(), True),
    T.StructField("exchange", T.StringType(), True),
    T.StructField("is_active", T.BooleanType(), False),
    T.StructField("created_at", T.TimestampNTZType(), False),
    T.StructField("updated_at", T.TimestampNTZType(), False),
])
DIM_DATE_SCHEMA = T.StructType([
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("full_date", T.DateType(), False),
    T.StructField("year", T.ShortType(), False),
    T.StructField("quarter", T.ByteType(), False),
    T.StructField("month", T.ByteType(), False),
    T.StructField("day", T.ByteType(), False),
    T.StructField("day_of_week", T.ByteType(), False),
    T.StructField("is_weekend", T.BooleanType(), False),
])
FACT_PRICES_SCHEMA = T.StructType([
    T.StructField("fact_price_key", T.LongType(), False),
    T.StructField("ticker_key", T.LongType(), False),
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("event_time", T.TimestampNTZType(), False),
    *[T.StructField(c, T.DecimalType(19, 4), False) for c in ("open_price", "high_price", "low_price", "close_price")],
    T.StructField("volume", T.LongType(), False),
    *[T.StructField(c, T.DecimalType(19, 4), True) for c in ("ma10", "ma20", "ma50", "ma200")],
    T.StructField("load_ts_utc", T.TimestampNTZType(), False),
])
#: The highest fact_price_key given out: a load need not read all facts to go on.
FACT_KEYS_SCHEMA = T.StructType([T.StructField("high", T.LongType(), False)])
SCHEMAS = {"dim_ticker": DIM_TICKER_SCHEMA, "dim_date": DIM_DATE_SCHEMA, "fact_prices": FACT_PRICES_SCHEMA, "fact_keys": FACT_KEYS_SCHEMA}


PARTITIONS = {"dim_ticker": [], "dim_date": [], "fact_prices": ["date_key"], "fact_keys": []}
SORTS = {"dim_ticker": [], "dim_date": [], "fact_prices": ["ticker_key", "event_time"], "fact_keys": []}
#: Second access path: files and row groups of a day without the ticker are skipped.
BLOOM = {"fact_prices": ["ticker_key"]}


def ensure_tables(spark: SparkSession, gold_root: str) -> dict[str, bool]:
    """Create each gold table as an empty Parquet dataset if it is absent
    (metadata-only existence check). Returns which ones were created."""
    created = {}
    for name, schema in SCHEMAS.items():
        path = f"{gold_root}/{name}"
        created[name] = not dataset_exists(spark, path)
        if created[name]:
            publish(spark.createDataFrame([], schema), path, PARTITIONS[name])
    return created


def read_table(spark: SparkSession, gold_root: str, name: str) -> DataFrame:
    """A gold table with its declared schema, also when it is empty."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{gold_root}/{name}").select(*SCHEMAS[name].names)


MEASURES = ["open_price", "high_price", "low_price", "close_price", "volume", "ma10", "ma20", "ma50", "ma200"]
FACT_COLUMNS = ["ticker_key", "date_key", "event_time", *MEASURES, "load_ts_utc"]
DIM_TICKER_COLUMNS = ["ticker_key", "ticker", "sector", "exchange", "is_active", "created_at", "updated_at"]
DIM_DATE_COLUMNS = ["date_key", "full_date", "year", "quarter", "month", "day", "day_of_week", "is_weekend"]


def load_silver(spark: SparkSession, path: str, layout: str = "canonical", start=None, end=None) -> DataFrame:
    """Silver rows, with the time their file was written.

    ``canonical``: silver partitioned by trade_date, so a filter on it becomes
    PartitionFilters. ``mixed``: historical mixed layouts, read recursively with
    the key recovered from the path; without a trade_date of their own the rows
    get none (no pruning possible)."""
    complete_silver(spark, path)  # a publish that was interrupted half-way
    if not dataset_exists(spark, path):
        raise EmptyWindow(f"no silver data at {path}")
    written = F.col("_metadata.file_modification_time").alias(WRITTEN)
    if layout == "canonical":
        rows = scan_partitioned(spark, path, types={"ticker": "string"})
        if "written_at" in rows.columns:  # a copy knows when its rows were written first
            return rows.withColumnRenamed("written_at", WRITTEN)
        return rows.select("*", written)
    if layout == "mixed":
        files = files_in_window(path_index(spark, path), start, end)
        if not files:
            raise EmptyWindow(f"no silver file in the window at {path}")
        return read_with_path_key(spark, *files, extra=[written])
    raise ValueError(f"unknown layout {layout!r}")


def gold_dates(silver: DataFrame, zone: str = "Asia/Ho_Chi_Minh") -> DataFrame:
    """The gold date (full_date) of every silver row: of its event time in
    ``zone``, rounded to the second."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col("event_time").cast("timestamp_ntz"))
    return silver.select(F.to_date(round_to_second(local)).alias("full_date"))


def canonical_copy(spark: SparkSession, path: str, out: str) -> str:
    """Mixed silver written once by trade date (of the event time's UTC day), so that
    any number of windows reads each of its files once. Returns ``out``."""
    rows = load_silver(spark, path, "mixed").withColumnRenamed(WRITTEN, "written_at")
    rows = rows.select(*[c for c in rows.columns if c.lower() != "trade_date"], F.to_date("event_time").alias("trade_date"))
    publish(rows, out, ["trade_date"], sort_by=["ticker", "event_time"])
    return out


def gold_base(silver: DataFrame, zone: str = "Asia/Ho_Chi_Minh") -> DataFrame:
    """Typed silver rows, one per (ticker, event_time): the event time is shown
    as wall clock in ``zone``, rounded to the second (what the serving layer
    stores); its date is taken after rounding, so a row next to midnight has one
    key whichever load it came with. Of duplicates the most recently written
    survives, then the one with the largest measures."""
    source = {"open_price": "open", "high_price": "high", "low_price": "low", "close_price": "close"}
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col("event_time").cast("timestamp_ntz"))
    typed = {"ticker": F.col("ticker").cast("string"), "event_time": round_to_second(local)}
    for name in MEASURES:
        typed[name] = F.col(source.get(name, name)).cast("long" if name == "volume" else "double")
    written = [WRITTEN] if WRITTEN in silver.columns else []
    base = silver.select(*[c.alias(n) for n, c in typed.items()], *written).withColumn("full_date", F.to_date("event_time"))
    base = base.na.drop(subset=["ticker", "event_time", "full_date"])
    return dedupe_keep_last(base, ["ticker", "event_time"], [*written, *MEASURES]).drop(*written)


def date_dim(df: DataFrame, date_col: str = "full_date") -> DataFrame:
    """Distinct dates with calendar attributes (date_key = yyyymmdd)."""
    return df.select(F.to_date(date_col).alias("_d")).na.drop().distinct().select(*date_attributes("_d"))


def ticker_dim(existing: DataFrame | None, tickers: DataFrame, now: str, exchange: str = "HOSE") -> DataFrame:
    """SCD-1 upsert of the ticker dimension: matched -> is_active = true and
    updated_at = now; new -> next surrogate key with default attributes.
    Nothing is deleted or deactivated."""
    now_ts = F.lit(now).cast("timestamp_ntz")
    members = tickers.select("ticker").na.drop().distinct()
    keyed = assign_keys(existing, members, "ticker", "ticker_key")
    source = members.join(keyed, "ticker").select(
        "ticker_key", "ticker",
        F.lit(None).cast("string").alias("sector"), F.lit(exchange).alias("exchange"),
        F.lit(True).alias("is_active"), now_ts.alias("created_at"), now_ts.alias("updated_at"),
    )
    if existing is None:
        return source.select(*DIM_TICKER_COLUMNS)
    return upsert(
        existing.select(*DIM_TICKER_COLUMNS), source, ["ticker"],
        on_match={
            "ticker_key": lambda t, s: t("ticker_key"),
            "sector": lambda t, s: t("sector"),
            "exchange": lambda t, s: t("exchange"),
            "is_active": lambda t, s: F.lit(True),
            "created_at": lambda t, s: t("created_at"),
            "updated_at": lambda t, s: s("updated_at"),
        },
    ).select(*DIM_TICKER_COLUMNS)


def fact_rows(base: DataFrame, dim_ticker: DataFrame, dim_date: DataFrame, load_ts: str) -> DataFrame:
    """Staged fact: inner joins to both dimensions (enforcing the foreign keys),
    decimal(19,4) measures; times are rounded already. Dimension sides
    are small relative to the fact (one row per ticker / per day); AQE turns the
    joins into broadcast hash joins when their measured size allows."""
    j = (
        base.join(dim_ticker.select("ticker", "ticker_key"), "ticker")
        .join(dim_date.select(F.col("full_date"), "date_key"), "full_date")
    )
    return j.select(
        F.col("ticker_key").cast("long"), F.col("date_key").cast("int"), "event_time",
        *[to_price(c).alias(c) for c in ("open_price", "high_price", "low_price", "close_price")],
        F.col("volume").cast("long"),
        *[to_price(c).alias(c) for c in ("ma10", "ma20", "ma50", "ma200")],
        F.lit(load_ts).cast("timestamp_ntz").alias("load_ts_utc"),
    )


def dedupe_fact(fact: DataFrame) -> DataFrame:
    """Rows that share the fact key: the one with the largest measures stays
    (:func:`gold_base` has chosen by recency before)."""
    return dedupe_keep_last(fact, ["ticker_key", "event_time"], [*MEASURES, "date_key"])


def upsert_fact(existing: DataFrame | None, staged: DataFrame) -> DataFrame:
    """MERGE on (ticker_key, event_time): matched -> all measures replaced."""
    staged = dedupe_fact(staged)
    if existing is None:
        return staged.select(*FACT_COLUMNS)
    return upsert(existing.select(*FACT_COLUMNS), staged, ["ticker_key", "event_time"]).select(*FACT_COLUMNS)


def with_fact_keys(facts: DataFrame, old: DataFrame, high: int) -> DataFrame:
    """``facts`` with fact_price_key: rows of ``old`` (by ticker and time) keep
    theirs, new ones go on from ``high`` in ranges by partition."""
    known = old.select("ticker_key", "event_time", "fact_price_key")
    keyed = staged(facts.join(known, ["ticker_key", "event_time"], "left"), "keyed_facts")
    new = number_rows(keyed.where("fact_price_key IS NULL").drop("fact_price_key"), "fact_price_key", high + 1)
    return keyed.where("fact_price_key IS NOT NULL").unionByName(new)


def highest_fact_key(spark: SparkSession, gold_root: str) -> int:
    """As recorded with the last load (one row); of tables from before that record,
    the largest in the facts."""
    high = read_table(spark, gold_root, "fact_keys").agg(F.max("high")).first()[0]
    if high is None:
        high = read_table(spark, gold_root, "fact_prices").agg(F.max("fact_price_key")).first()[0]
    return high or 0


def feature_rows(fact: DataFrame, dim_ticker: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The feature view's rows without the target: fact joined to both dimensions."""
    return (
        fact.join(dim_ticker.select("ticker_key", "ticker"), "ticker_key")
        .join(dim_date.select("date_key", F.col("full_date").alias("feature_date")), "date_key")
        .select("ticker", "feature_date", "event_time", "open_price", "high_price", "low_price",
                "close_price", "volume", "ma10", "ma20", "ma50", "ma200")
    )


def feature_view(fact: DataFrame, dim_ticker: DataFrame, dim_date: DataFrame, **kw) -> DataFrame:
    """Fact joined to both dimensions plus the next bar's close per ticker.
    ``auto``: the largest ticker series is counted on the fact's key column
    (an upper bound: the inner joins can only drop rows) and the one-exchange
    direct window is used only if it fits one chunk, else the chunked one."""
    if kw.get("strategy", "auto") == "auto":
        kw["strategy"] = pick_strategy(fact, ["ticker_key"], kw.get("chunk_rows"))
    base = feature_rows(fact, dim_ticker, dim_date)
    return lead_target(base, ["ticker"], ["event_time"], "close_price", "target_next_close", **kw)


def validation_snapshot(dim_ticker: DataFrame, dim_date: DataFrame, fact: DataFrame, view: DataFrame) -> DataFrame:
    """Row counts of the published gold tables as one row (4 partial counts)."""
    counts = [
        dim_ticker.agg(F.count(F.lit(1)).alias("dim_ticker_count")),
        dim_date.agg(F.count(F.lit(1)).alias("dim_date_count")),
        fact.agg(F.count(F.lit(1)).alias("fact_prices_count")),
        view.agg(F.count(F.lit(1)).alias("ml_feature_rows")),
    ]
    out = combine_one_row(*counts)
    return out.select(*[F.col(c).cast("long") for c in out.columns])


def check_staged(tables: dict[str, DataFrame]) -> DataFrame:
    """The serving layer's constraints on tables about to be published: unique
    keys, NOT NULL columns, foreign keys and the ticker's length."""
    required = {n: [f.name for f in schema.fields if not f.nullable] for n, schema in SCHEMAS.items()}
    ticker, date, fact = (tables[n] for n in ("dim_ticker", "dim_date", "fact_prices"))
    parts = [
        check_constraints(ticker, "dim_ticker", pk=["ticker_key"], not_null=required["dim_ticker"]),
        check_constraints(ticker, "dim_ticker", pk=["ticker"]),
        check_constraints(date, "dim_date", pk=["date_key"], not_null=required["dim_date"]),
        check_constraints(date, "dim_date", pk=["full_date"]),
        check_constraints(fact, "fact_prices", pk=["fact_price_key"]),
        check_constraints(fact, "fact_prices", pk=["ticker_key", "event_time"], not_null=required["fact_prices"],
                          fks={"ticker_key": (ticker, "ticker_key"), "date_key": (date, "date_key")}),
        ticker.agg(F.count_if(F.length("ticker") > TICKER_CHARS).alias("violations")).select(
            F.lit("dim_ticker").alias("table_name"), F.lit("length:ticker").alias("check_name"), "violations"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _pending(gold_root: str) -> str:
    return f"{gold_root.rstrip('/')}/_pending"


def apply_pending(spark: SparkSession, gold_root: str) -> bool:
    """Publish a load that was staged completely, dimensions first so that a fact
    row never references a missing key. Every step overwrites from the staged
    copy, so it can be repeated after a crash at any point; the copy goes last.
    A load that was not staged completely is discarded. Returns whether a load
    was published."""
    pending = _pending(gold_root)
    ready = dataset_exists(spark, f"{pending}/_READY")
    if ready:
        for name in SCHEMAS:
            if not dataset_exists(spark, f"{pending}/{name}"):
                continue  # staged before the table was introduced
            table = spark.read.schema(SCHEMAS[name]).parquet(f"{pending}/{name}")
            publish(table, f"{gold_root}/{name}", PARTITIONS[name], "incremental" if PARTITIONS[name] else "full", SORTS[name], BLOOM.get(name, ()))
        delete_path(spark, f"{pending}/_READY")
    if dataset_exists(spark, pending):
        delete_path(spark, pending)
    return ready


def run_gold(spark: SparkSession, silver_path: str, gold_root: str, load_ts: str,
             start=None, end=None, zone: str = "Asia/Ho_Chi_Minh", layout: str = "canonical") -> dict:
    """Load silver rows in [start, end] (default: all) into the gold tables.
    One set-based pass; only the date partitions that receive rows are
    rewritten in the fact table, so reruns are idempotent. EmptyWindow if no
    silver row falls into the window.

    The three tables are staged below ``gold_root/_pending``, checked there, and
    marked ready; only then are they published. A load that was interrupted
    while publishing is completed by the next one before it starts its own.

    ``canonical`` silver is pruned by trade_date, with one day of slack on each
    side: the gold date is the local date of the event, silver's trade_date the
    bronze date."""
    apply_pending(spark, gold_root)
    with staging_scope():
        slack = dt.timedelta(days=1)
        silver = load_silver(spark, silver_path, layout, as_date(start) - slack if start else None, as_date(end) + slack if end else None)
        if layout == "canonical" and start:
            silver = silver.filter(F.col("trade_date") >= F.date_sub(F.lit(str(start)).cast("date"), 1))
        if layout == "canonical" and end:
            silver = silver.filter(F.col("trade_date") <= F.date_add(F.lit(str(end)).cast("date"), 1))
        base = gold_base(silver, zone)
        if start:
            base = base.filter(F.col("full_date") >= F.lit(str(start)).cast("date"))
        if end:
            base = base.filter(F.col("full_date") <= F.lit(str(end)).cast("date"))
        base = staged(base, "gold_base")
        if base.isEmpty():
            raise EmptyWindow("no silver rows in the selected window")
        ensure_tables(spark, gold_root)
        pending = _pending(gold_root)

        def stage(df: DataFrame, name: str) -> DataFrame:
            publish(df.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[name].fields]), f"{pending}/{name}",
                    PARTITIONS[name], sort_by=[])
            return read_table(spark, pending, name)

        tickers = stage(ticker_dim(read_table(spark, gold_root, "dim_ticker"), base.select("ticker"), load_ts), "dim_ticker")
        dates = stage(upsert(read_table(spark, gold_root, "dim_date"), date_dim(base), ["date_key"]), "dim_date")
        rows = staged(fact_rows(base, tickers, dates, load_ts), "fact_rows")
        # The touched days are bounded by the calendar, so they become a literal
        # list: static PartitionFilters on date_key, no scan of other days.
        touched = [r[0] for r in rows.select("date_key").distinct().collect()]
        old = read_table(spark, gold_root, "fact_prices").where(F.col("date_key").isin(touched))
        high = highest_fact_key(spark, gold_root)
        facts = stage(with_fact_keys(upsert_fact(old, rows), old, high), "fact_prices")
        top = facts.agg(F.coalesce(F.greatest(F.max("fact_price_key"), F.lit(high)), F.lit(high)).alias("high"))
        stage(top, "fact_keys")
        checked = {"dim_ticker": tickers, "dim_date": dates, "fact_prices": facts}
        enforce_constraints(check_staged(checked))
        spark.range(0).write.parquet(f"{pending}/_READY")
        apply_pending(spark, gold_root)
    tickers, dates, facts = (read_table(spark, gold_root, n) for n in ("dim_ticker", "dim_date", "fact_prices"))
    # the view's row count needs no target window: count its joined rows
    snap = validation_snapshot(tickers, dates, facts, feature_rows(facts, tickers, dates))
    return snap.first().asDict()
