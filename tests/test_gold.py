from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import START, rows_of, trade, trades
from marketspark.functions.durations import duration_seconds, resolve_window
from marketspark.operators.gold import (
    aggregate_all,
    aggregate_ohlc,
    aggregate_ohlc_multi,
    aggregate_trade_stats,
    aggregate_volume_profile,
)
from marketspark.schemas import GOLD, conform

DOUBLES = "symbol string, price double, quantity double, side string, event_time timestamp, trade_id string"


def test_ohlc_of_one_instant(spark):
    df = spark.createDataFrame([
        ("BTCUSDT", 68000.0, 0.1, "BUY", START, "1"),
        ("BTCUSDT", 68500.0, 0.2, "BUY", START, "2"),
        ("BTCUSDT", 67000.0, 0.1, "SELL", START, "3"),
        ("BTCUSDT", 68400.0, 0.3, "BUY", START, "4"),
    ], DOUBLES)
    row, = aggregate_ohlc(df, window_duration="1 minute").collect()
    assert (row.open_price, row.high_price, row.low_price, row.close_price) == (68000.0, 68500.0, 67000.0, 68400.0)
    assert row.trade_count == 4
    assert (row.window_start, row.window_end) == (START, START + timedelta(minutes=1))
    assert row.window_duration == "1 minute"


def test_symbols_are_separate(spark):
    df = trades(spark, trade("1"), trade("2", symbol="ETHUSDT"))
    assert {r.symbol for r in aggregate_ohlc(df).collect()} == {"BTCUSDT", "ETHUSDT"}


def test_volume_profile(spark):
    df = spark.createDataFrame([
        ("BTCUSDT", 68000.0, 0.5, "BUY", START, "1"),
        ("BTCUSDT", 68000.0, 0.3, "SELL", START, "2"),
    ], DOUBLES)
    row, = aggregate_volume_profile(df).collect()
    assert (row.total_volume, row.buy_volume, row.sell_volume) == (0.8, 0.5, 0.3)
    assert (row.buy_count, row.sell_count) == (1, 1)
    assert row.vwap == pytest.approx(68000.0)


def test_vwap_of_no_volume_is_null(spark):
    df = trades(spark, trade("1", quantity=Decimal("0")))
    assert aggregate_volume_profile(df).first().vwap is None


def test_trade_stats_follow_the_window_length(spark):
    df = spark.createDataFrame([
        ("BTCUSDT", 68000.0, 0.1, "BUY", START, "1"),
        ("BTCUSDT", 68000.0, 0.5, "BUY", START, "2"),
    ], DOUBLES)
    row, = aggregate_trade_stats(df).collect()
    assert (row.trade_count, row.max_trade_size, row.trades_per_second) == (2, 0.5, 2.0 / 60.0)
    assert aggregate_trade_stats(df, "5 minutes").first().trades_per_second == 2.0 / 300.0


def random_trades(n: int = 400) -> list[dict]:
    rng = random.Random(11)
    return [
        trade(
            str(i),
            seconds=rng.randrange(0, 9000),
            symbol=rng.choice(["A", "A", "A", "B"]),
            price=Decimal(rng.randrange(1, 500)),
            quantity=Decimal(rng.randrange(1, 9)),
            side=rng.choice(["BUY", "SELL"]),
            ingest_time=START + timedelta(seconds=rng.randrange(3)),
        )
        for i in range(n)
    ]


def brute_force_candles(rows: list[dict], seconds: int) -> dict:
    groups = defaultdict(list)
    for row in rows:
        epoch = (row["event_time"] - datetime(1970, 1, 1)).total_seconds()
        groups[row["symbol"], datetime(1970, 1, 1) + timedelta(seconds=epoch - epoch % seconds)].append(row)
    out = {}
    for key, group in groups.items():
        group.sort(key=lambda r: (r["event_time"], r["ingest_time"], r["trade_id"]))
        prices = [r["price"] for r in group]
        out[key] = (prices[0], max(prices), min(prices), prices[-1], sum(r["quantity"] for r in group), len(group))
    return out


def candles_of(df) -> dict:
    return {
        (r.symbol, r.window_start): (r.open_price, r.high_price, r.low_price, r.close_price, r.volume, r.trade_count)
        for r in df.collect()
    }


@pytest.mark.parametrize("duration", ["1 minute", "5 minutes", "15 minutes", "1 hour"])
def test_candles_equal_brute_force_in_any_input_order(spark, duration):
    rows = random_trades()
    expected = brute_force_candles(rows, duration_seconds(duration))
    assert candles_of(aggregate_ohlc(trades(spark, *rows), duration)) == expected
    shuffled = trades(spark, *reversed(rows)).repartition(5)
    assert candles_of(aggregate_ohlc(shuffled, duration)) == expected


def test_sizes_from_one_scan_equal_each_size_alone(spark):
    df = trades(spark, *random_trades())
    sizes = ["1 minute", "5 minutes", "15 minutes", "1 hour"]
    many = aggregate_ohlc_multi(df)
    for size in sizes:
        alone = aggregate_ohlc(df, size)
        assert rows_of(many.filter(F.col("window_duration") == size).select(*alone.columns)) == rows_of(alone)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Scan") == 1


def test_sizes_need_not_divide_each_other(spark):
    df = trades(spark, *random_trades())
    many = aggregate_ohlc_multi(df, ["2 minutes", "3 minutes"])
    for size in ("2 minutes", "3 minutes"):
        alone = aggregate_ohlc(df, size)
        assert rows_of(many.filter(F.col("window_duration") == size).select(*alone.columns)) == rows_of(alone)


def test_trades_without_price_do_not_open_or_close(spark):
    df = trades(spark, trade("1", price=None), trade("2", seconds=1), trade("3", seconds=2, price=None))
    row, = aggregate_ohlc(df).collect()
    assert (row.open_price, row.close_price, row.trade_count) == (Decimal("68000"), Decimal("68000"), 3)


def test_single_order_column_aggregates_by_hash(spark):
    df = trades(spark, *random_trades(50))
    plan = aggregate_ohlc(df, order_by=["event_time"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_all_measures_equal_the_single_datasets(spark):
    df = trades(spark, *random_trades())
    wide = aggregate_all(df)
    for dataset, aggregate in (
        ("ohlc", aggregate_ohlc),
        ("volume_profiles", aggregate_volume_profile),
        ("trade_stats", aggregate_trade_stats),
    ):
        assert rows_of(conform(wide, GOLD[dataset])) == rows_of(conform(aggregate(df), GOLD[dataset]))


def test_gold_contract_types(spark):
    golden = conform(aggregate_ohlc(trades(spark, trade())), GOLD["ohlc"])
    assert [f.dataType for f in golden.schema] == [f.dataType for f in GOLD["ohlc"]]


def test_durations():
    assert duration_seconds("15 minutes") == 900
    assert duration_seconds("1 day") == 86400
    assert duration_seconds("1 hour 30 minutes") == 5400 and duration_seconds("500 milliseconds") == 0.5
    for bad in ("", "0 minutes", "1 month", "minute"):
        with pytest.raises(ValueError):
            duration_seconds(bad)
    assert resolve_window("1h") == resolve_window("1 hour") == "1 hour"
    with pytest.raises(ValueError):
        resolve_window("2m")


@pytest.mark.parametrize(("duration", "starts"), [("500 milliseconds", [0, 0.5, 90]), ("1 hour 30 minutes", [-3600])])
def test_compound_and_short_windows(spark, duration, starts):
    rows = [trade("1"), trade("2", seconds=0.6), trade("3", seconds=90.2)]
    found = aggregate_ohlc(trades(spark, *rows), duration).orderBy("window_start").collect()
    assert [(r.window_start - START).total_seconds() for r in found] == starts
    length = {(r.window_end - r.window_start).total_seconds() for r in found}
    assert length == {duration_seconds(duration)}
