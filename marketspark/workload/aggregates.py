"""Queries over gold windows, marts and serving."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketspark.operators.gold import (
    aggregate_all,
    aggregate_ohlc,
    aggregate_ohlc_multi,
    aggregate_trade_stats,
    aggregate_volume_profile,
)
from marketspark.operators.silver import validate_business_rules
from marketspark.plans import marts, serving
from marketspark.plans.rebuild import rebuild, rebuild_changed_days, rebuild_gold, rebuild_silver
from marketspark.session import working_path
from marketspark.sinks.writers import StorageWriter
from marketspark.sources.file_index import latest_trades_indexed, refresh_file_bounds
from marketspark.sources.tables import Layout, read_bronze, read_gold, scan_union_by_name
from marketspark.workload import sql
from marketspark.workload.layers import REPEATED
from marketspark.workload.registry import query
from marketspark.workload.tables import AS_OF, corrected_trades, events, repeated_trades, shown, trades


def valid(spark, sf_dir):
    return validate_business_rules(trades(events(spark, sf_dir)), AS_OF)


def candles(spark, sf_dir):
    return aggregate_ohlc(valid(spark, sf_dir))


def profiles(spark, sf_dir):
    return aggregate_volume_profile(valid(spark, sf_dir))


def summary(spark, sf_dir):
    return marts.daily_summary_of(aggregate_all(valid(spark, sf_dir)))


@query("ohlc_1m", f"WITH {sql.GOLD} SELECT {sql.OHLC} FROM gold")
def _ohlc_1m(spark, sf_dir):
    return shown(candles(spark, sf_dir))


@query("ohlc_1h", f"WITH {sql.VALID}, {sql.windows('gold', 'valid', 3600, '1 hour')} SELECT {sql.OHLC} FROM gold")
def _ohlc_1h(spark, sf_dir):
    return shown(aggregate_ohlc(valid(spark, sf_dir), "1 hour"))


_SIZES = {"1 minute": 60, "5 minutes": 300, "15 minutes": 900, "1 hour": 3600}


@query("ohlc_multi", f"""
    WITH {sql.VALID}, {", ".join(sql.windows(f"w{s}", "valid", s, label) for label, s in _SIZES.items())}
    {" UNION ALL ".join(f"SELECT {sql.OHLC} FROM w{s}" for s in _SIZES.values())}""")
def _ohlc_multi(spark, sf_dir):
    return shown(aggregate_ohlc_multi(valid(spark, sf_dir)))


@query("volume_profile", f"WITH {sql.GOLD} SELECT {sql.PROFILE} FROM gold")
def _volume_profile(spark, sf_dir):
    return shown(profiles(spark, sf_dir))


@query("trade_stats", f"WITH {sql.GOLD} SELECT {sql.STATS} FROM gold")
def _trade_stats(spark, sf_dir):
    return shown(aggregate_trade_stats(valid(spark, sf_dir)), avg_trade_size=6, trades_per_second=9)


@query("read_gold", f"""
    WITH {sql.GOLD} SELECT {sql.OHLC}, strftime(window_end, '%Y-%m-%d') AS partition_date FROM gold""")
def _read_gold(spark, sf_dir):
    root = Layout(working_path(spark, "gold"))
    StorageWriter(spark, root.checkpoints).write_gold(candles(spark, sf_dir), "ohlc", root.gold("{dataset}"))
    stored = shown(read_gold(spark, "ohlc", root.gold("{dataset}")))
    return stored.withColumn("partition_date", F.date_format("partition_date", "yyyy-MM-dd"))


@query("scan_union_by_name", f"""
    WITH {sql.VALID}, {sql.windows('w60', 'valid', 60, '1 minute')}, {sql.windows('w3600', 'valid', 3600, '1 hour')}
    SELECT symbol, window_start, window_duration, volume, trade_count FROM w60
    UNION ALL SELECT symbol, window_start, window_duration, volume, NULL FROM w3600""")
def _scan_union_by_name(spark, sf_dir):
    root = Layout(working_path(spark, "union"))
    columns = ["symbol", "window_start", "window_duration", "volume"]
    trades_ = valid(spark, sf_dir)
    aggregate_ohlc(trades_).select("trade_count", *columns).write.parquet(root.gold("ohlc", "1 minute"))
    aggregate_ohlc(trades_, "1 hour").select(*columns).write.parquet(root.gold("ohlc", "1 hour"))
    both = scan_union_by_name(spark, root.gold("ohlc", "1 minute"), root.gold("ohlc", "1 hour"))
    return shown(both.select(*columns, "trade_count"))


_DAY = "date_trunc('day', window_start) AS trade_date"


@query("stg_ohlc", f"WITH {sql.GOLD} SELECT {sql.OHLC}, {_DAY} FROM gold")
def _stg_ohlc(spark, sf_dir):
    return shown(marts.stg_ohlc(candles(spark, sf_dir)))


@query("stg_volume_profiles", f"WITH {sql.GOLD} SELECT {sql.PROFILE}, {_DAY} FROM gold")
def _stg_volume_profiles(spark, sf_dir):
    return shown(marts.stg_volume_profiles(profiles(spark, sf_dir)))


@query("stg_trade_stats", f"WITH {sql.GOLD} SELECT {sql.STATS}, {_DAY} FROM gold")
def _stg_trade_stats(spark, sf_dir):
    staged = marts.stg_trade_stats(aggregate_trade_stats(valid(spark, sf_dir)))
    return shown(staged, avg_trade_size=6, trades_per_second=9)


@query("daily_ohlc", f"WITH {sql.MARTS} SELECT * FROM daily")
def _daily_ohlc(spark, sf_dir):
    return shown(marts.daily_ohlc(marts.stg_ohlc(candles(spark, sf_dir))))


@query("symbol_metrics", f"""
    WITH {sql.MARTS} SELECT symbol, trade_date, total_volume, buy_volume, sell_volume, buy_count, sell_count,
           avg_vwap, buy_ratio FROM metrics""")
def _symbol_metrics(spark, sf_dir):
    staged = marts.stg_volume_profiles(profiles(spark, sf_dir))
    return shown(marts.symbol_metrics(staged))


@query("daily_summary", f"WITH {sql.MARTS} SELECT {sql.SUMMARY} FROM summary")
def daily_summary(spark, sf_dir):
    return shown(summary(spark, sf_dir))


_ONE_SIDED = sql.MARTS.replace(
    "FROM gold GROUP BY 1, 2),\nmetrics", "FROM gold WHERE symbol <> 'CLICK' GROUP BY 1, 2),\nmetrics"
).replace("FROM gold GROUP BY 1, 2),\nsummary", "FROM gold WHERE symbol <> 'VIEW' GROUP BY 1, 2),\nsummary")


@query("daily_summary_joined", f"WITH {_ONE_SIDED} SELECT {sql.SUMMARY} FROM summary")
def _daily_summary_joined(spark, sf_dir):
    # Separate tables, each without one symbol: rows that only one side has must stay.
    priced, traded = candles(spark, sf_dir).filter("symbol <> 'CLICK'"), profiles(spark, sf_dir).filter("symbol <> 'VIEW'")
    return shown(marts.build_daily_summary(priced, traded))


@query("symbol_performance", f"""
    WITH {sql.MARTS} SELECT symbol, trade_date, volume, trade_count, close_price,
           round(high_price - low_price, 6) AS price_range,
           round((high_price - low_price) / nullif(close_price, 0) * 100, 9) AS volatility_pct,
           buy_ratio * 100 AS buy_ratio_pct,
           CAST(row_number() OVER (PARTITION BY trade_date ORDER BY volume DESC NULLS LAST, symbol) AS INTEGER)
             AS volume_rank,
           CAST(row_number() OVER (PARTITION BY trade_date ORDER BY trade_count DESC NULLS LAST, symbol) AS INTEGER)
             AS activity_rank
    FROM summary""")
def _symbol_performance(spark, sf_dir):
    ranked = marts.symbol_performance(summary(spark, sf_dir))
    return shown(ranked, price_range=6, volatility_pct=9)


@query("volatility_metrics", f"""
    WITH {sql.MARTS} SELECT symbol, trade_date, close_price, volume, round(avg(close_price) OVER w, 6) AS sma_7d,
           round(stddev(close_price) OVER w, 6) AS stddev_7d,
           round(stddev(close_price) OVER w / nullif(avg(close_price) OVER w, 0) * 100, 4) AS volatility_7d_pct
    FROM summary
    WINDOW w AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def _volatility_metrics(spark, sf_dir):
    return shown(
        marts.volatility_metrics(summary(spark, sf_dir)), sma_7d=6, stddev_7d=6, volatility_7d_pct=4
    )


@query("market_activity", f"""
    WITH {sql.MARTS} SELECT trade_date, count(DISTINCT symbol) AS active_symbols, sum(volume) AS total_volume,
           CAST(sum(trade_count) AS BIGINT) AS total_trades, round(avg(buy_ratio) * 100, 9) AS avg_buy_ratio_pct,
           sum(CASE WHEN close_price > open_price THEN volume ELSE 0 END) AS bullish_volume,
           sum(CASE WHEN close_price < open_price THEN volume ELSE 0 END) AS bearish_volume
    FROM summary GROUP BY trade_date""")
def _market_activity(spark, sf_dir):
    return shown(marts.market_activity(summary(spark, sf_dir)), avg_buy_ratio_pct=9)


@query("latest_trades", f"""
    WITH {sql.VALID} SELECT {sql.TRADE_COLUMNS} FROM valid ORDER BY event_time DESC, trade_id LIMIT 100""")
def _latest_trades(spark, sf_dir):
    return shown(serving.latest_trades(valid(spark, sf_dir)))


@query("latest_trades_stored", f"""
    WITH {sql.VALID} SELECT {sql.TRADE_COLUMNS} FROM valid ORDER BY event_time DESC, trade_id LIMIT 100""")
def _latest_trades_stored(spark, sf_dir):
    # A stored table in which every tenth trade lies in the partition of the first day; a tenth is not indexed yet.
    root = Layout(working_path(spark, "misfiled"))
    first = F.when(F.col("trade_id").cast("bigint") % 10 == 0, "2024-01-01").otherwise(F.date_format("event_time", "yyyy-MM-dd"))
    rows = valid(spark, sf_dir).withColumn("partition_date", first)
    new = F.col("trade_id").cast("bigint") % 10 == 7
    rows.filter(~new).repartition("partition_date").write.partitionBy("partition_date").parquet(root.silver)
    refresh_file_bounds(spark, root.silver, root.file_bounds("silver"))
    rows.filter(new).repartition("partition_date").write.mode("append").partitionBy("partition_date").parquet(root.silver)
    return shown(latest_trades_indexed(spark, root.silver, root.file_bounds("silver")).drop("partition_date"))


@query("latest_trades_symbol", f"""
    WITH {sql.VALID} SELECT {sql.TRADE_COLUMNS} FROM valid WHERE symbol = 'PURCHASE'
    ORDER BY event_time DESC, trade_id LIMIT 1000""")
def _latest_trades_symbol(spark, sf_dir):
    return shown(serving.latest_trades_of(valid(spark, sf_dir), "purchase", 1000))


_RANGE = "window_start >= TIMESTAMP '2024-01-03' AND window_end <= TIMESTAMP '2024-01-20 12:00:00'"


@query("ohlc_range", f"""
    WITH {sql.GOLD} SELECT {sql.OHLC} FROM gold WHERE symbol = 'CLICK' AND {_RANGE}
    ORDER BY window_start DESC LIMIT 500""")
def _ohlc_range(spark, sf_dir):
    return shown(serving.ohlc_range(candles(spark, sf_dir), "click", "1m", "2024-01-03", "2024-01-20T12:00:00"))


@query("volume_range", f"""
    WITH {sql.GOLD} SELECT {sql.PROFILE} FROM gold WHERE symbol = 'VIEW' AND {_RANGE}
    ORDER BY window_start DESC LIMIT 500""")
def _volume_range(spark, sf_dir):
    rows = serving.volume_range(profiles(spark, sf_dir), "view", "1m", "2024-01-03", "2024-01-20T12:00:00")
    return shown(rows)


@query("summary_range", f"""
    WITH {sql.MARTS} SELECT {sql.SUMMARY} FROM summary
    WHERE trade_date >= TIMESTAMP '2024-01-05' AND trade_date <= TIMESTAMP '2024-01-25'
    ORDER BY trade_date DESC, symbol LIMIT 200""")
def _summary_range(spark, sf_dir):
    return shown(serving.summary_range(summary(spark, sf_dir), "2024-01-05", "2024-01-25"))


@query("replay_gold", f"""
    WITH {REPEATED}, latest AS (
      SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY ingest_time DESC, event_time DESC) AS n
      FROM repeated WHERE {sql.HOLDS}),
    silver AS (SELECT * FROM latest WHERE n = 1), {sql.windows('gold', 'silver', 60, '1 minute')}
    SELECT {sql.OHLC} FROM gold""")
def _replay_gold(spark, sf_dir):
    source, target = Layout(working_path(spark, "replay-from")), Layout(working_path(spark, "replay-to"))
    StorageWriter(spark, source.checkpoints).write_bronze(repeated_trades(events(spark, sf_dir)), source.bronze)
    silver = rebuild_silver(spark, read_bronze(spark, source.bronze), target, AS_OF)
    return shown(rebuild_gold(spark, silver, target)["ohlc"].drop("partition_date"))


# What changes in bronze between two rebuilds: the events of two days, of which some go and the others have more quantity.
_CHANGED = ("2024-01-10", "2024-01-11")


@query("replay_changed_days", f"""
    WITH {sql.TRADES}, bronze AS (
      SELECT trade_id, symbol, price, side, event_id, schema_version, CAST(quantity + copy AS DECIMAL(18,8)) AS quantity,
             event_time + to_days(copy * 4) AS event_time, ingest_time + to_days(copy * 4) AS ingest_time
      FROM trades JOIN (VALUES (0), (1)) c(copy) ON copy = 0 OR event_id % 5 = 0),
    changed AS (
      SELECT * REPLACE (CAST(quantity + CASE WHEN strftime(event_time, '%Y-%m-%d') IN {_CHANGED} THEN 2 ELSE 0 END AS DECIMAL(18,8)) AS quantity)
      FROM bronze WHERE strftime(event_time, '%Y-%m-%d') NOT IN {_CHANGED} OR event_id % 3 <> 0),
    latest AS (
      SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY ingest_time DESC, event_time DESC) AS n
      FROM changed WHERE {sql.HOLDS}),
    silver AS (SELECT * FROM latest WHERE n = 1), {sql.windows('gold', 'silver', 60, '1 minute')}
    SELECT {sql.OHLC} FROM gold""")
def _replay_changed_days(spark, sf_dir):
    """A rebuild, then two days of bronze change, whose ids have copies on other days; only what they reach is replaced."""
    source, target = Layout(working_path(spark, "changed-from")), Layout(working_path(spark, "changed-to"))
    first = corrected_trades(events(spark, sf_dir), 4)
    StorageWriter(spark, source.checkpoints).write_bronze(first, source.bronze)
    rebuild(spark, source.bronze, target, AS_OF)
    on_days = F.date_format("event_time", "yyyy-MM-dd").isin(*_CHANGED)
    days = first.filter(on_days & (F.col("trade_id").cast("bigint") % 3 != 0)).withColumns({
        "quantity": (F.col("quantity") + 2).cast("decimal(18,8)"), "partition_date": F.date_format("event_time", "yyyy-MM-dd")})
    days.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("partition_date").parquet(source.bronze)
    rebuild_changed_days(spark, source.bronze, target, AS_OF)
    return shown(read_gold(spark, "ohlc", target.gold("{dataset}")).drop("partition_date"))
