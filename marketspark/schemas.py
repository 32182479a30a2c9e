"""Table contracts, wire names and trade schemas by version."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

PRICE = DecimalType(18, 8)
VOLUME = DecimalType(24, 8)

# Names, defaults and labels that stored data and messages must carry.
DEFAULT_EXCHANGE = "binance"
EVENT_TYPE = "trade"
RAW_TOPIC = "raw.trades"
DEAD_LETTER_TOPIC = "dead-letter.trades"
PIPELINE_VERSION = "0.1.0"
DATE_PATTERN = "yyyy-MM-dd"
SIDES = ("BUY", "SELL")


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


TRADE = _struct(
    ("trade_id", StringType()),
    ("exchange", StringType()),
    ("symbol", StringType()),
    ("price", PRICE),
    ("quantity", PRICE),
    ("side", StringType()),
    ("event_time", TimestampType()),
    ("ingest_time", TimestampType()),
    ("schema_version", StringType()),
)

BRONZE = StructType([*TRADE.fields, StructField("partition_date", StringType(), True)])

ENRICHED_TRADE = StructType([
    *TRADE.fields,
    *_struct(
        ("processing_timestamp", TimestampType()),
        ("pipeline_version", StringType()),
        ("partition_date", StringType()),
    ).fields,
])

TOPIC_ROW = _struct(
    ("key", BinaryType()),
    ("value", BinaryType()),
    ("topic", StringType()),
    ("partition", IntegerType()),
    ("offset", LongType()),
    ("timestamp", TimestampType()),
)

_WINDOW_BOUNDS = (("symbol", StringType()), ("window_start", TimestampType()), ("window_end", TimestampType()))

GOLD = {
    "ohlc": _struct(
        *_WINDOW_BOUNDS,
        ("open_price", PRICE),
        ("high_price", PRICE),
        ("low_price", PRICE),
        ("close_price", PRICE),
        ("volume", VOLUME),
        ("trade_count", LongType()),
        ("window_duration", StringType()),
    ),
    "volume_profiles": _struct(
        *_WINDOW_BOUNDS,
        ("total_volume", VOLUME),
        ("buy_volume", VOLUME),
        ("sell_volume", VOLUME),
        ("buy_count", LongType()),
        ("sell_count", LongType()),
        ("vwap", PRICE),
        ("window_duration", StringType()),
    ),
    "trade_stats": _struct(
        *_WINDOW_BOUNDS,
        ("trade_count", LongType()),
        ("avg_trade_size", PRICE),
        ("max_trade_size", PRICE),
        ("trades_per_second", DoubleType()),
        ("window_duration", StringType()),
    ),
}


def camel_case(name: str) -> str:
    """Wire name of a table column."""
    head, *tail = name.split("_")
    return head + "".join(part.capitalize() for part in tail)


def to_wire_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({name: camel_case(name) for name in df.columns})


def from_wire_names(df: DataFrame, schema: StructType = TRADE) -> DataFrame:
    return df.withColumnsRenamed({camel_case(name): name for name in schema.fieldNames()})


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types. A value that does not fit its type raises."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


# Trade schemas by version, as readers take them. Later versions may only add optional columns; a column
# read from an older message takes the ``default`` kept in its field metadata, or NULL.
Versions = Mapping[int, StructType]
TRADE_VERSIONS: Versions = {1: TRADE}


def with_version(number: int, schema: StructType, versions: Versions = TRADE_VERSIONS) -> Versions:
    """``versions`` and one more. A number keeps its schema for good, and no column may go."""
    if number in versions:
        raise ValueError(f"version {number} has a schema, and stored messages rely on it")
    if gone := [name for name in newest(versions).fieldNames() if name not in schema.fieldNames()]:
        raise ValueError(f"version {number} lacks {', '.join(gone)}")
    return {**versions, number: schema}


def newest(versions: Versions = TRADE_VERSIONS) -> StructType:
    return versions[max(versions)]


def known_version(version: Column, versions: Versions = TRADE_VERSIONS) -> Column:
    return F.coalesce(version.try_cast("int").isin(*sorted(versions)), F.lit(False))
