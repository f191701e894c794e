"""Late data, the series state and the crash-safe publish of silver: whatever happened
on the way, silver equals a full rebuild."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from barlake.plans import series_state, silver
from barlake.sources import sinks, versions
from barlake.sources.scan import scan_partitioned
from barlake.sources.sinks import land_bronze
from barlake.streaming import silver_stream

RUN_TS = "2024-02-01T00:00:00Z"
COLUMNS = ["ticker", "event_time", "open", "high", "low", "close", "volume", "ma10", "ma20", "ma50", "ma200", "trade_date"]


def land(spark, root, data):
    """(ticker, local time, close or None) landed as vendor bronze."""
    nanos = lambda t: int((t - dt.datetime(1970, 1, 1)).total_seconds()) * 10**9
    rows = [(k, nanos(t), *([float(p)] * 4 if p is not None else [None] * 4), 1, t.date()) for k, t, p in data]
    land_bronze(spark.createDataFrame(rows, "Ticker string, Time long, Open double, High double, Low double, Close double, Volume long, Trade_date date"), root)


def bars(keys, days, hours, seed=1):
    """Whole numbers: averages are exact in any order of addition."""
    rnd = random.Random(seed)
    return [(k, dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=h), rnd.choice([None, *range(1, 60)])) for k in keys for d in days for h in hours]


def silver_rows(spark, path, *cols):
    return sorted((tuple(r) for r in scan_partitioned(spark, path, types={"ticker": "string"}).select(*(cols or COLUMNS)).collect()), key=str)


def rebuilt(spark, root):
    silver.run_silver(spark, f"{root}/b", f"{root}/full", f"{root}/r_full", "full", "2024-03-30", RUN_TS)
    return silver_rows(spark, f"{root}/full")


def args(root):
    return f"{root}/b", f"{root}/s", f"{root}/r"


def pairs(spark, data):
    return spark.createDataFrame(sorted({(k, t.date()) for k, t, _ in data}), "ticker string, trade_date date")


def day_files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


@pytest.mark.parametrize("layout", [("trade_date",), ("trade_date", "ticker")])
def test_one_late_key_equals_a_rebuild_and_leaves_the_rest(spark, tmp_root, monkeypatch, layout):
    data = bars("ab", range(0, 40), range(0, 24, 1))
    late = [r for r in data if r[0] == "b" and r[1].date() == dt.date(2024, 1, 6)]
    land(spark, f"{tmp_root}/b", [r for r in data if r not in late])
    path = f"{tmp_root}/s"
    silver.run_silver(spark, *args(tmp_root), "full", "2024-03-30", RUN_TS, partition_by=layout)
    before = day_files(path)
    land(spark, f"{tmp_root}/b", late)
    reads, real = [], silver.read_bronze
    monkeypatch.setattr(silver, "read_bronze", lambda s, r, lo=None, hi=None: reads.append((lo, hi)) or real(s, r, lo, hi))
    metrics = silver.run_silver_changes(spark, f"{tmp_root}/b", path, f"{tmp_root}/r", pairs(spark, late), RUN_TS, first_days=5, partition_by=layout)
    monkeypatch.undo()
    assert metrics["total_rows"] and silver_rows(spark, path) == rebuilt(spark, tmp_root)
    # frames met the old rows again after some nine days of 24 bars: bronze is not read to its end
    assert reads == [(dt.date(2024, 1, 6), dt.date(2024, 1, 11)), (dt.date(2024, 1, 6), dt.date(2024, 1, 16))]
    after = day_files(path)
    stay = [f for f in before if (len(layout) == 1 and f.split("trade_date=")[1][:10] < "2024-01-06") or "ticker=a" in f
            or f.split("trade_date=")[1][:10] > str(reads[-1][1])]
    assert stay and all(after.get(f) == before[f] for f in stay)


def test_days_in_any_order_equal_a_rebuild(spark, tmp_root):
    """Landings in random order, each carried in by its own run, thin and new keys
    and late gaps included."""
    rnd = random.Random(7)
    data = bars(["busy"], range(0, 24), range(0, 16)) + bars(["thin"], [0, 1, 20, 22], [3]) + bars(["new"], range(21, 24), [1, 2], 4)
    days = sorted({r[1].date() for r in data})
    first = set(days[:12])
    land(spark, f"{tmp_root}/b", [r for r in data if r[1].date() in first])
    silver.run_silver(spark, *args(tmp_root), "full", "2024-01-12", RUN_TS)
    rest = days[12:]
    rnd.shuffle(rest)
    for k in range(0, len(rest), 4):
        late = [r for r in data if r[1].date() in rest[k:k + 4]]
        land(spark, f"{tmp_root}/b", late)
        silver.run_silver_changes(spark, *args(tmp_root), pairs(spark, late), RUN_TS)
    assert silver_rows(spark, f"{tmp_root}/s") == rebuilt(spark, tmp_root)
    # a re-delivered file with fewer bars takes rows away again
    gone = [r for r in data if r[0] == "busy" and r[1].date() == days[20]][:3]
    land(spark, f"{tmp_root}/b", gone)
    silver.run_silver_changes(spark, *args(tmp_root), pairs(spark, gone), RUN_TS)
    assert silver_rows(spark, f"{tmp_root}/s") == rebuilt(spark, tmp_root)


def test_incremental_runs_go_by_the_state_alone(spark, tmp_root, monkeypatch):
    data = bars(["busy"], range(0, 30), range(0, 12)) + bars(["thin"], [0, 1, 29], [3]) + bars(["new"], [29], [1, 2], 4)
    last = dt.date(2024, 1, 30)
    land(spark, f"{tmp_root}/b", [r for r in data if r[1].date() < last])
    silver.run_silver(spark, *args(tmp_root), "full", "2024-01-29", RUN_TS)
    land(spark, f"{tmp_root}/b", [r for r in data if r[1].date() == last])
    monkeypatch.setattr(silver, "carry_context", lambda *a, **k: pytest.fail("the history was read"))
    monkeypatch.setattr(silver, "_published", lambda *a, **k: pytest.fail("the history was read"))
    for _ in range(2):  # a rerun finds the state it needs as well
        silver.run_silver(spark, *args(tmp_root), "incremental", last, RUN_TS)
    monkeypatch.undo()
    assert silver_rows(spark, f"{tmp_root}/s") == rebuilt(spark, tmp_root)
    state = series_state.read_state(spark, f"{tmp_root}/s")
    assert state.where("ticker = 'busy'").count() <= 199 + 12 * 8 and state.where("ticker = 'thin'").count() == 3
    # a day before the horizon: the history is asked, and the state is right again afterwards
    silver.run_silver(spark, *args(tmp_root), "incremental", "2024-01-03", RUN_TS)
    assert silver_rows(spark, f"{tmp_root}/s") == rebuilt(spark, tmp_root)
    assert sorted(map(tuple, series_state.read_state(spark, f"{tmp_root}/s").drop("horizon").collect()), key=str) == sorted(
        map(tuple, series_state.read_state(spark, f"{tmp_root}/full").drop("horizon").collect()), key=str)


def failing_writes(monkeypatch, fail_at):
    """Every publish, deletion and mark of a run counts; number ``fail_at`` raises."""
    count = [0]

    def wrap(real):
        def step(*a, **k):
            count[0] += 1
            if count[0] == fail_at:
                raise RuntimeError("lost driver")
            return real(*a, **k)
        return step

    for name in ("publish", "delete_path", "mark_ready"):
        monkeypatch.setattr(versions, name, wrap(getattr(versions, name)))
    return count


def test_a_run_that_fails_at_any_write_loses_nothing(spark, tmp_root, monkeypatch):
    """Day 1 has a close and no open; only the rows that silver leaves out know it."""
    one, two, three = (dt.datetime(2024, 1, d, 3) for d in (1, 2, 3))
    row = lambda t, o, c: ("a", int((t - dt.datetime(1970, 1, 1)).total_seconds()) * 10**9, o, 99.0, 1.0, c, 1, t.date())
    schema = "Ticker string, Time long, Open double, High double, Low double, Close double, Volume long, Trade_date date"
    land_bronze(spark.createDataFrame([row(one, None, 10.0), row(two, 5.0, 20.0)], schema), f"{tmp_root}/b")
    for fail_at in range(1, 9):
        path = f"{tmp_root}/s{fail_at}"
        land_bronze(spark.createDataFrame([row(one, None, 10.0), row(two, 5.0, 20.0)], schema), f"{tmp_root}/b{fail_at}")
        silver.run_silver(spark, f"{tmp_root}/b{fail_at}", path, f"{tmp_root}/r", "full", "2024-01-02", RUN_TS)
        land_bronze(spark.createDataFrame([row(three, 5.0, 30.0)], schema), f"{tmp_root}/b{fail_at}")
        count = failing_writes(monkeypatch, fail_at)
        try:
            silver.run_silver(spark, f"{tmp_root}/b{fail_at}", path, f"{tmp_root}/r", "incremental", "2024-01-03", RUN_TS)
            failed = False
        except RuntimeError:
            failed = True
        monkeypatch.undo()
        assert failed == (count[0] >= fail_at)
        silver.run_silver(spark, f"{tmp_root}/b{fail_at}", path, f"{tmp_root}/r", "incremental", "2024-01-03", RUN_TS)
        assert [(r[0].day, r[1]) for r in silver_rows(spark, path, "trade_date", "ma10")] == [(2, 15.0), (3, 20.0)], fail_at
        assert not versions.dataset_exists(spark, f"{path}_pending")
        if not failed:
            break
    else:
        pytest.fail("more writes than were tried")
    history = versions.read_versions(spark, path).orderBy("version", "step").collect()
    assert [(r.version, r.dataset) for r in history][:3] == [(1, "rows"), (1, "leading"), (1, "state")]


def test_a_replayed_batch_takes_effect_once(spark, tmp_root, monkeypatch):
    from barlake.operators.quality import REPORT_SCHEMA

    data = bars("ab", range(0, 6), range(0, 4))
    land(spark, f"{tmp_root}/b", data)
    batch = pairs(spark, data).selectExpr("trade_date AS Trade_date", "ticker AS Ticker")
    ckpt = f"{tmp_root}/ckpt"
    failing_writes(monkeypatch, 3)  # the first try dies while it publishes
    with pytest.raises(RuntimeError):
        silver_stream.publish_batch(batch, 0, *args(tmp_root), ckpt)
    monkeypatch.undo()
    for _ in range(2):
        silver_stream.publish_batch(batch, 0, *args(tmp_root), ckpt)
    assert silver_rows(spark, f"{tmp_root}/s") == rebuilt(spark, tmp_root)
    assert spark.read.schema(REPORT_SCHEMA).parquet(f"{tmp_root}/r").count() == 1
    assert versions.last_version(spark, f"{tmp_root}/s") == 1
    assert silver_stream.publish_batch(batch, 1, *args(tmp_root), ckpt)  # another batch with the same rows


def test_landed_since_names_the_new_files(spark, tmp_root):
    land(spark, f"{tmp_root}/b", bars("a", [0, 1], [1]))
    old = max(day_files(f"{tmp_root}/b").values()) / 1e9
    land(spark, f"{tmp_root}/b", bars("z", [1], [1]))
    for f, at in day_files(f"{tmp_root}/b").items():
        if "=z/" not in f:
            os.utime(f, (old - 100, old - 100))
    since = dt.datetime.fromtimestamp(old - 50, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S+00:00")
    assert [tuple(r) for r in silver.landed_since(spark, f"{tmp_root}/b", since).collect()] == [("z", dt.date(2024, 1, 2))]


def test_no_landing_and_gate(spark, tmp_root):
    land(spark, f"{tmp_root}/b", bars("a", [0, 1], [1, 2]))
    silver.run_silver(spark, *args(tmp_root), "full", "2024-01-02", RUN_TS)
    before = silver_rows(spark, f"{tmp_root}/s")
    assert silver.run_silver_changes(spark, *args(tmp_root), pairs(spark, bars("a", [0], [1])).limit(0), RUN_TS) == {}
    bad = [("a", dt.datetime(2024, 1, 2, 5), -1.0)]
    land(spark, f"{tmp_root}/b", bad)
    with pytest.raises(ValueError):
        silver.run_silver_changes(spark, *args(tmp_root), pairs(spark, bad), RUN_TS)
    assert silver_rows(spark, f"{tmp_root}/s") == before
    assert spark.read.parquet(f"{tmp_root}/r").where(F.col("invalid_price_count") > 0).count() == 1
