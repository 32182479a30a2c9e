"""Daily marts over the gold datasets. Each model is a function of DataFrames, so Catalyst plans the whole chain.

Rolling frames count rows, not calendar days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketspark.schemas import GOLD

BASE_WINDOW = "1 minute"


def _stage(gold: DataFrame, dataset: str) -> DataFrame:
    """The dataset's contract columns, all of which must be there, and the partition where it is stored."""
    stored = [name for name in ("partition_date",) if name in gold.columns]
    return gold.select(*GOLD[dataset].fieldNames(), *stored, F.date_trunc("day", "window_start").alias("trade_date"))


def stg_ohlc(gold_ohlc: DataFrame) -> DataFrame:
    return _stage(gold_ohlc, "ohlc")


def stg_volume_profiles(gold_volume_profiles: DataFrame) -> DataFrame:
    return _stage(gold_volume_profiles, "volume_profiles")


def stg_trade_stats(gold_trade_stats: DataFrame) -> DataFrame:
    return _stage(gold_trade_stats, "trade_stats")


def create_staging_views(gold: dict[str, DataFrame]) -> None:
    """The staged datasets as temporary views, for SQL users."""
    for dataset, df in gold.items():
        _stage(df, dataset).createOrReplaceTempView(f"stg_{dataset}")


def daily_ohlc(staged_ohlc: DataFrame, base_window: str | None = BASE_WINDOW) -> DataFrame:
    """Daily candles. Only windows of ``base_window`` count, or volume would add up once per stored size."""
    if base_window:
        staged_ohlc = staged_ohlc.filter(F.col("window_duration") == base_window)
    return staged_ohlc.groupBy("symbol", "trade_date").agg(
        F.min("window_start").alias("first_window"),
        F.max("window_end").alias("last_window"),
        F.min_by("open_price", "window_start").alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", "window_start").alias("close_price"),
        F.sum("volume").alias("volume"),
        F.sum("trade_count").alias("trade_count"),
    )


def symbol_metrics(staged_volume_profiles: DataFrame, base_window: str | None = BASE_WINDOW) -> DataFrame:
    if base_window:
        staged_volume_profiles = staged_volume_profiles.filter(F.col("window_duration") == base_window)
    ratio = F.try_divide(F.sum("buy_volume").cast("double"), F.sum("total_volume").cast("double"))
    return staged_volume_profiles.groupBy("symbol", "trade_date").agg(
        F.sum("total_volume").alias("total_volume"),
        F.sum("buy_volume").alias("buy_volume"),
        F.sum("sell_volume").alias("sell_volume"),
        F.sum("buy_count").alias("buy_count"),
        F.sum("sell_count").alias("sell_count"),
        F.avg("vwap").cast("double").alias("avg_vwap"),
        ratio.alias("buy_ratio"),
    )


def daily_summary(daily: DataFrame, metrics: DataFrame) -> DataFrame:
    """Candle and volume side by side. Both inputs are grouped by the join keys, so the join adds no shuffle."""
    right = metrics.drop("total_volume")
    return daily.join(right, ["symbol", "trade_date"], "full_outer").select(
        "symbol",
        "trade_date",
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "volume",
        "trade_count",
        "buy_volume",
        "sell_volume",
        "buy_count",
        "sell_count",
        "avg_vwap",
        "buy_ratio",
    )


def build_daily_summary(
    gold_ohlc: DataFrame, gold_volume_profiles: DataFrame, base_window: str | None = BASE_WINDOW
) -> DataFrame:
    return daily_summary(
        daily_ohlc(stg_ohlc(gold_ohlc), base_window),
        symbol_metrics(stg_volume_profiles(gold_volume_profiles), base_window),
    )


def daily_summary_of(windows: DataFrame, base_window: str | None = BASE_WINDOW) -> DataFrame:
    """The daily summary of windows that hold the measures of candles and volume profiles side by side.

    One aggregate gives what ``build_daily_summary`` joins from two tables; a day without a priced window, or
    a window without volume, shows in the measures themselves.
    """
    rows = windows.withColumn("trade_date", F.date_trunc("day", "window_start"))
    if base_window:
        rows = rows.filter(F.col("window_duration") == base_window)
    ratio = F.try_divide(F.sum("buy_volume").cast("double"), F.sum("total_volume").cast("double"))
    return rows.groupBy("symbol", "trade_date").agg(
        F.min_by("open_price", "window_start").alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", "window_start").alias("close_price"),
        F.sum("volume").alias("volume"),
        F.sum("trade_count").alias("trade_count"),
        *[F.sum(name).alias(name) for name in ("buy_volume", "sell_volume", "buy_count", "sell_count")],
        F.avg("vwap").cast("double").alias("avg_vwap"),
        ratio.alias("buy_ratio"),
    )


def symbol_performance(summary: DataFrame) -> DataFrame:
    spread = F.col("high_price") - F.col("low_price")
    relative = F.try_divide(spread.cast("double"), F.col("close_price").cast("double"))

    def rank_by(measure: str):
        order = [F.col(measure).desc_nulls_last(), F.col("symbol").asc_nulls_last()]
        return F.row_number().over(Window.partitionBy("trade_date").orderBy(*order))

    return summary.select(
        "symbol",
        "trade_date",
        "volume",
        "trade_count",
        "close_price",
        spread.alias("price_range"),
        (relative * 100).alias("volatility_pct"),
        (F.col("buy_ratio") * 100).alias("buy_ratio_pct"),
        rank_by("volume").alias("volume_rank"),
        rank_by("trade_count").alias("activity_rank"),
    )


def volatility_metrics(summary: DataFrame, rows: int = 7) -> DataFrame:
    frame = Window.partitionBy("symbol").orderBy(F.col("trade_date").asc_nulls_last()).rowsBetween(1 - rows, 0)
    close = F.col("close_price").cast("double")
    mean, deviation = F.avg(close).over(frame), F.stddev_samp(close).over(frame)
    return summary.select(
        "symbol",
        "trade_date",
        "close_price",
        "volume",
        mean.alias("sma_7d"),
        deviation.alias("stddev_7d"),
        (F.try_divide(deviation, mean) * 100).alias("volatility_7d_pct"),
    )


def market_activity(summary: DataFrame) -> DataFrame:
    def volume_where(condition):
        return F.sum(F.when(condition, F.col("volume")).otherwise(0))

    return summary.groupBy("trade_date").agg(
        F.count_distinct("symbol").alias("active_symbols"),
        F.sum("volume").alias("total_volume"),
        F.sum("trade_count").alias("total_trades"),
        (F.avg("buy_ratio") * 100).alias("avg_buy_ratio_pct"),
        volume_where(F.col("close_price") > F.col("open_price")).alias("bullish_volume"),
        volume_where(F.col("close_price") < F.col("open_price")).alias("bearish_volume"),
    )


def build_marts(
    gold_ohlc: DataFrame, gold_volume_profiles: DataFrame, base_window: str | None = BASE_WINDOW
) -> dict[str, DataFrame]:
    summary = build_daily_summary(gold_ohlc, gold_volume_profiles, base_window)
    return {"daily_summary": summary, **marts_over(summary)}


def marts_over(summary: DataFrame) -> dict[str, DataFrame]:
    return {
        "symbol_performance": symbol_performance(summary),
        "volatility_metrics": volatility_metrics(summary),
        "market_activity": market_activity(summary),
    }
