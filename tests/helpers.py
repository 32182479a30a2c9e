from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from marketspark.schemas import TRADE

START = datetime(2026, 5, 24, 10, 0, 0)
AS_OF = "2026-05-25 00:00:00"


def trade(trade_id: str | None = "1", seconds: float = 0, **changes) -> dict:
    at = START + timedelta(seconds=seconds)
    return {
        "trade_id": trade_id,
        "exchange": "binance",
        "symbol": "BTCUSDT",
        "price": Decimal("68000"),
        "quantity": Decimal("0.1"),
        "side": "BUY",
        "event_time": at,
        "ingest_time": at + timedelta(milliseconds=200),
        "schema_version": "1",
        **changes,
    }


def trades(spark: SparkSession, *rows: dict) -> DataFrame:
    return spark.createDataFrame([tuple(row[n] for n in TRADE.fieldNames()) for row in rows], TRADE)


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
