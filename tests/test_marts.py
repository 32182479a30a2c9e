from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from helpers import START, rows_of, trade, trades
from marketspark.operators.gold import aggregate_all, aggregate_ohlc, aggregate_volume_profile
from marketspark.operators.silver import with_partition_date
from marketspark.plans import marts, serving

DAY = datetime(2026, 5, 24)


def gold(spark):
    rows = [
        trade("1", symbol="A", price=Decimal("10"), quantity=Decimal("2")),
        trade("2", symbol="A", price=Decimal("30"), quantity=Decimal("1"), side="SELL", seconds=120),
        trade("3", symbol="A", price=Decimal("20"), quantity=Decimal("1"), seconds=240),
        trade("4", symbol="B", price=Decimal("5"), quantity=Decimal("9"), seconds=10),
        trade("5", symbol="A", price=Decimal("7"), quantity=Decimal("1"), seconds=86400),
    ]
    df = trades(spark, *rows)
    return aggregate_ohlc(df), aggregate_volume_profile(df)


def test_daily_summary(spark):
    ohlc, volume = gold(spark)
    found = {(r.symbol, r.trade_date): r for r in marts.build_daily_summary(ohlc, volume).collect()}
    assert len(found) == 3
    day = found["A", DAY]
    assert (day.open_price, day.high_price, day.low_price, day.close_price) == (10, 30, 10, 20)
    assert (day.volume, day.trade_count, day.buy_count, day.sell_count) == (4, 3, 2, 1)
    assert (day.buy_ratio, day.avg_vwap) == (0.75, 20.0)


def test_larger_windows_do_not_add_to_the_day(spark):
    ohlc, volume = gold(spark)
    df = trades(spark, trade("1", symbol="A"))
    both = ohlc.unionByName(aggregate_ohlc(df, "1 hour"))
    assert rows_of(marts.daily_ohlc(marts.stg_ohlc(both))) == rows_of(marts.daily_ohlc(marts.stg_ohlc(ohlc)))


def test_summary_keeps_one_sided_rows(spark):
    ohlc, volume = gold(spark)
    summary = marts.build_daily_summary(ohlc.filter("symbol = 'A'"), volume.filter("symbol = 'B'"))
    sides = {(r.symbol, r.volume is None, r.buy_volume is None) for r in summary.collect()}
    assert sides == {("A", False, True), ("B", True, False)}


def test_summary_join_reuses_the_grouping(spark):
    ohlc, volume = gold(spark)
    plan = marts.build_daily_summary(ohlc, volume)._jdf.queryExecution().executedPlan().toString()
    # Window and day grouping of each side; none for the join.
    assert plan.count("Exchange hashpartitioning") == 4


def test_performance_ranks_and_ratios(spark):
    ranked = {r.symbol: r for r in marts.symbol_performance(marts.build_daily_summary(*gold(spark))).collect()
              if r.trade_date == DAY}
    assert (ranked["B"].volume_rank, ranked["A"].volume_rank) == (1, 2)
    assert (ranked["A"].activity_rank, ranked["B"].activity_rank) == (1, 2)
    assert ranked["A"].volatility_pct == pytest.approx(100.0)
    assert ranked["A"].buy_ratio_pct == pytest.approx(75.0)


def test_volatility_over_seven_rows(spark):
    closes = [10.0, 12.0, 11.0, 15.0, 14.0, 13.0, 18.0, 17.0, 20.0]
    summary = spark.createDataFrame(
        [("A", DAY + timedelta(days=2 * i), c, 1.0) for i, c in enumerate(closes)],
        "symbol string, trade_date timestamp, close_price double, volume double",
    )
    rows = marts.volatility_metrics(summary).orderBy("trade_date").collect()
    assert rows[0].stddev_7d is None and rows[0].volatility_7d_pct is None
    for i, row in enumerate(rows[1:], 1):
        frame = closes[max(0, i - 6): i + 1]
        assert row.sma_7d == pytest.approx(mean(frame))
        assert row.stddev_7d == pytest.approx(stdev(frame))
        assert row.volatility_7d_pct == pytest.approx(stdev(frame) / mean(frame) * 100)


def test_market_activity(spark):
    rows = {r.trade_date: r for r in marts.market_activity(marts.build_daily_summary(*gold(spark))).collect()}
    day = rows[DAY]
    assert (day.active_symbols, day.total_volume, day.total_trades) == (2, 13, 4)
    assert (day.bullish_volume, day.bearish_volume) == (4, 0)
    assert day.avg_buy_ratio_pct == pytest.approx(87.5)


def test_latest_trades(spark):
    df = trades(spark, *[trade(f"{i:03}", seconds=i // 2) for i in range(20)])
    assert [r.trade_id for r in serving.latest_trades(df, 3).collect()] == ["018", "019", "016"]
    assert serving.latest_trades_of(df, "btcusdt", 5).count() == 5
    assert serving.latest_trades_of(df, "invalid").count() == 0
    for bad in (0, 1001):
        with pytest.raises(ValueError):
            serving.latest_trades(df, bad)
    plan = serving.latest_trades(df)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_latest_trades_of_stored_days(spark, tmp_path):
    path = str(tmp_path / "silver")
    df = trades(spark, *[trade(f"{d}-{i}", seconds=86400 * d + i) for d in range(5) for i in range(4)])
    with_partition_date(df).write.partitionBy("partition_date", "symbol").parquet(path)
    stored = spark.read.parquet(path)
    for limit in (1, 4, 5, 20, 100):
        latest = serving.latest_trades_of(stored, "btcusdt", limit)
        assert [r.trade_id for r in latest.collect()] == [r.trade_id for r in serving.latest_trades(df, limit).collect()]
    plan = serving.latest_trades(stored, 5, since="2026-05-27")._jdf.queryExecution().executedPlan().toString()
    assert "2026-05-27" in plan[plan.index("PartitionFilters"): plan.index("PushedFilters")]


def test_latest_trades_find_misfiled_rows(spark, tmp_path):
    path = str(tmp_path / "silver")
    df = with_partition_date(trades(spark, *[trade(str(d), seconds=86400 * d) for d in range(5)]))
    misfiled = df.withColumn("partition_date", F.when(F.col("trade_id") == "4", "2026-05-24").otherwise(F.col("partition_date")))
    misfiled.write.partitionBy("partition_date").parquet(path)
    assert [r.trade_id for r in serving.latest_trades(spark.read.parquet(path), 2).collect()] == ["4", "3"]


def test_daily_summary_of_windows_reads_trades_once(spark):
    df = trades(spark, *[trade(str(i), seconds=40 * i, side="BUY" if i % 3 else "SELL") for i in range(9)])
    joined = marts.build_daily_summary(aggregate_ohlc(df), aggregate_volume_profile(df))
    single = marts.daily_summary_of(aggregate_all(df))
    assert single.columns == joined.columns and single.collect() == joined.collect()
    count = [p._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for p in (single, joined)]
    assert count[0] < count[1]


def test_ranges_filter_by_label_and_time(spark):
    ohlc, volume = gold(spark)
    stored = ohlc.unionByName(ohlc.selectExpr("* EXCEPT (window_duration)", "'1 hour' AS window_duration"))
    end = START + timedelta(minutes=3)
    rows = serving.ohlc_range(stored, "a", "1m", START, end).collect()
    assert [r.window_start for r in rows] == [START + timedelta(minutes=2), START]
    assert serving.ohlc_range(stored, "a", "1h").count() == 4
    assert serving.ohlc_range(stored, "a", None).count() == 8
    assert serving.volume_range(volume, "A", end_time=end).count() == 2
    with pytest.raises(ValueError):
        serving.ohlc_range(stored, "a", "3m")


def test_time_bounds_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "ohlc")
    ohlc, _ = gold(spark)
    with_partition_date(ohlc, "window_end").write.partitionBy("partition_date").parquet(path)
    rows = serving.ohlc_range(spark.read.parquet(path), "a", "1m", START, START + timedelta(hours=1))
    assert rows.count() == 3
    plan = rows._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"): plan.index("PushedFilters")]
    assert "partition_date" in filters and ">=" in filters and "<=" in filters
    assert "EqualTo(symbol,A)" in plan


def test_summary_range(spark):
    summary = marts.build_daily_summary(*gold(spark))
    rows = serving.summary_range(summary, "2026-05-24", "2026-05-25").collect()
    assert [(r.symbol, r.trade_date.day) for r in rows] == [("A", 25), ("A", 24), ("B", 24)]
    assert serving.summary_range(summary, end_time="2026-05-24").count() == 2
