"""Serving queries as DataFrames: a filter that reaches the scan, then a top-k.

An empty result means "not found"; bad arguments raise ``ValueError``.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.functions.durations import resolve_window

# Result limits.
TRADES_DEFAULT, TRADES_MAX = 100, 1000
WINDOWS_LIMIT = 500
SUMMARIES_LIMIT = 200

Instant = datetime | str | None


def checked_limit(limit: int) -> int:
    if not 1 <= limit <= TRADES_MAX:
        raise ValueError(f"limit must be between 1 and {TRADES_MAX}, got {limit}")
    return limit


def _instant(value: datetime | date | str) -> Column:
    return F.lit(value).cast("timestamp")


def _of_symbol(df: DataFrame, symbol: str) -> DataFrame:
    # Stored symbols are upper-case: comparing the bare column keeps partition pruning and pushdown.
    return df.filter(F.col("symbol") == symbol.upper())


def _latest(trades: DataFrame, limit: int, since: Instant) -> DataFrame:
    if since and "partition_date" in trades.columns:
        trades = trades.filter(F.col("partition_date") >= _instant(since).cast("date"))
    return newest_first(trades, limit)


def newest_first(trades: DataFrame, limit: int) -> DataFrame:
    return trades.orderBy(F.col("event_time").desc_nulls_last(), F.col("trade_id").asc_nulls_last()).limit(limit)


def latest_trades(trades: DataFrame, limit: int = TRADES_DEFAULT, since: Instant = None) -> DataFrame:
    """The newest trades: each task keeps ``limit`` rows, and only those meet.

    Where partitions are known to be right (the partition check passes), ``since`` limits the days that are
    read; the caller then vouches that ``limit`` trades lie in them. No job runs before the result is asked for.
    ``latest_trades_indexed`` opens only the files of a stored layer that can hold them, misfiled rows or not.
    """
    return _latest(trades, checked_limit(limit), since)


def latest_trades_of(trades: DataFrame, symbol: str, limit: int = TRADES_DEFAULT, since: Instant = None) -> DataFrame:
    return _latest(_of_symbol(trades, symbol), checked_limit(limit), since)


def _windows(df: DataFrame, symbol: str, window: str | None, start_time: Instant, end_time: Instant) -> DataFrame:
    rows = _of_symbol(df, symbol)
    if window:
        rows = rows.filter(F.col("window_duration") == resolve_window(window))
    # partition_date is the day of window_end, so time bounds also bound the partitions to read.
    dated = "partition_date" in df.columns
    if start_time:
        rows = rows.filter(F.col("window_start") >= _instant(start_time))
        if dated:
            rows = rows.filter(F.col("partition_date") >= _instant(start_time).cast("date"))
    if end_time:
        rows = rows.filter(F.col("window_end") <= _instant(end_time))
        if dated:
            rows = rows.filter(F.col("partition_date") <= _instant(end_time).cast("date"))
    newest_first = [F.col("window_start").desc_nulls_last(), F.col("window_duration").asc_nulls_last()]
    return rows.orderBy(*newest_first).limit(WINDOWS_LIMIT)


def ohlc_range(
    candles: DataFrame, symbol: str, window: str | None = "1m", start_time: Instant = None, end_time: Instant = None
) -> DataFrame:
    return _windows(candles, symbol, window, start_time, end_time)


def volume_range(
    profiles: DataFrame, symbol: str, window: str | None = "1m", start_time: Instant = None, end_time: Instant = None
) -> DataFrame:
    return _windows(profiles, symbol, window, start_time, end_time)


def summary_range(summary: DataFrame, start_time: Instant = None, end_time: Instant = None) -> DataFrame:
    if start_time:
        summary = summary.filter(F.col("trade_date") >= _instant(start_time))
    if end_time:
        summary = summary.filter(F.col("trade_date") <= _instant(end_time))
    return summary.orderBy(
        F.col("trade_date").desc_nulls_last(), F.col("symbol").asc_nulls_last()
    ).limit(SUMMARIES_LIMIT)
