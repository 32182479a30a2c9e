"""Event-time window aggregates per symbol: candles, volume profiles and trade statistics.

The aggregates reduce inside each task before the shuffle, so a symbol with a large share of all
trades sends one row per window and task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.functions.durations import WINDOW_LABELS, duration_micros, duration_seconds, duration_text

WATERMARK_KEY = "spark.watermarkDelayMs"

# First and last trade of a window. A single column here (unique event times) lets Spark aggregate by
# hashing; the full order needs a sort inside each task but keeps trades of one instant in a fixed order.
TRADE_ORDER = ("event_time", "ingest_time", "trade_id")


def apply_watermark(df: DataFrame, watermark_seconds: int = 60) -> DataFrame:
    """The event-time watermark, unless the stream already has one (it may be set only once)."""
    if WATERMARK_KEY in df.schema["event_time"].metadata:
        return df
    return df.withWatermark("event_time", duration_text(watermark_seconds))


def _order(df: DataFrame, columns: Sequence[str]) -> Column:
    present = [name for name in columns if name in df.columns]
    return F.col(present[0]) if len(present) == 1 else F.struct(*present)


def _ohlc(df: DataFrame, order_by: Sequence[str]) -> dict[str, Column]:
    order = _order(df, order_by)
    priced = F.when(F.col("price").isNotNull(), order)
    return {
        "open_price": F.min_by("price", priced),
        "high_price": F.max("price"),
        "low_price": F.min("price"),
        "close_price": F.max_by("price", priced),
        "volume": F.sum("quantity"),
        "trade_count": F.count("trade_id"),
    }


def _volume_profile() -> dict[str, Column]:
    def side_volume(side: str) -> Column:
        return F.sum(F.when(F.col("side") == side, F.col("quantity")).otherwise(0))

    return {
        "total_volume": F.sum("quantity"),
        "buy_volume": side_volume("BUY"),
        "sell_volume": side_volume("SELL"),
        "buy_count": F.count_if(F.col("side") == "BUY"),
        "sell_count": F.count_if(F.col("side") == "SELL"),
        "vwap": F.try_divide(F.sum(F.col("price") * F.col("quantity")), F.sum("quantity")),
    }


def _trade_stats(window_duration: str) -> dict[str, Column]:
    return {
        "trade_count": F.count("trade_id"),
        "avg_trade_size": F.avg("quantity"),
        "max_trade_size": F.max("quantity"),
        "trades_per_second": F.count("trade_id") / F.lit(float(duration_seconds(window_duration))),
    }


def _by_window(
    df: DataFrame, measures: dict[str, Column], window_duration: str, watermark_seconds: int
) -> DataFrame:
    # A stream closes windows by the window column itself. A batch groups by its start, a plain timestamp,
    # which is cheaper to sort and compare.
    window = F.col("_window")
    keys = [window] if df.isStreaming else [window["start"].alias("_start")]
    start = window["start"] if df.isStreaming else F.col("_start")
    length = F.expr(f"INTERVAL {duration_micros(window_duration)} MICROSECONDS")
    return (
        apply_watermark(df, watermark_seconds)
        .withColumn("_window", F.window("event_time", window_duration))
        .groupBy(*keys, "symbol")
        .agg(*[column.alias(name) for name, column in measures.items()])
        .select(
            "symbol",
            *measures,
            start.alias("window_start"),
            (start + length).alias("window_end"),
            F.lit(window_duration).alias("window_duration"),
        )
    )


def aggregate_ohlc(
    df: DataFrame,
    window_duration: str = "1 minute",
    watermark_seconds: int = 60,
    order_by: Sequence[str] = TRADE_ORDER,
) -> DataFrame:
    return _by_window(df, _ohlc(df, order_by), window_duration, watermark_seconds)


def aggregate_volume_profile(
    df: DataFrame, window_duration: str = "1 minute", watermark_seconds: int = 60
) -> DataFrame:
    return _by_window(df, _volume_profile(), window_duration, watermark_seconds)


def aggregate_trade_stats(
    df: DataFrame, window_duration: str = "1 minute", watermark_seconds: int = 60
) -> DataFrame:
    return _by_window(df, _trade_stats(window_duration), window_duration, watermark_seconds)


AGGREGATES: dict[str, Callable[..., DataFrame]] = {
    "ohlc": aggregate_ohlc,
    "volume_profiles": aggregate_volume_profile,
    "trade_stats": aggregate_trade_stats,
}


def aggregate_all(df: DataFrame, window_duration: str = "1 minute", order_by: Sequence[str] = TRADE_ORDER) -> DataFrame:
    """All gold measures of a window in one row, from one scan and one shuffle (batch)."""
    measures = {**_volume_profile(), **_trade_stats(window_duration), **_ohlc(df, order_by)}
    return _by_window(df, measures, window_duration, 60)


def roll_up_ohlc(candles: DataFrame, window_durations: Sequence[str]) -> DataFrame:
    """Larger candles from small ones (batch). Each size must be a multiple of the candles' own size."""
    micros = F.array(*[F.lit(duration_micros(d)) for d in window_durations])
    labels = F.array(*[F.lit(d) for d in window_durations])
    sized = candles.withColumn("_size", F.explode(F.arrays_zip(micros.alias("us"), labels.alias("d"))))
    # Windows are aligned to the epoch, as those of F.window are.
    start = F.unix_micros("window_start")
    length = F.col("_size.us").cast("bigint")
    return (
        sized.withColumn("_start", start - F.pmod(start, length))
        .groupBy("symbol", F.col("_size.d").alias("window_duration"), "_start", length.alias("_length"))
        .agg(
            F.min_by("open_price", "window_start").alias("open_price"),
            F.max("high_price").alias("high_price"),
            F.min("low_price").alias("low_price"),
            F.max_by("close_price", "window_start").alias("close_price"),
            F.sum("volume").alias("volume"),
            F.sum("trade_count").alias("trade_count"),
        )
        .select(
            "symbol",
            "open_price",
            "high_price",
            "low_price",
            "close_price",
            "volume",
            "trade_count",
            F.timestamp_micros("_start").alias("window_start"),
            F.timestamp_micros(F.col("_start") + F.col("_length")).alias("window_end"),
            "window_duration",
        )
    )


def aggregate_ohlc_multi(
    df: DataFrame,
    window_durations: Sequence[str] = tuple(WINDOW_LABELS.values()),
    order_by: Sequence[str] = TRADE_ORDER,
) -> DataFrame:
    """Candles of several sizes from one scan of the trades (batch).

    Trades are reduced to candles of the greatest common divisor of the sizes, and these to each size.
    """
    base = math.gcd(*[duration_micros(d) for d in window_durations])
    return roll_up_ohlc(aggregate_ohlc(df, f"{base} microseconds", order_by=order_by), window_durations)
