"""The test tables read as trades, feed messages and topic rows.

Defects (bad JSON, unknown versions, odd casing, late arrival, copies) follow fixed rules on the event
id, so that the same rule can be stated in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from marketspark.operators.codec import encode_envelope, envelope_json, iso_utc, stable_uuid
from marketspark.schemas import RAW_TOPIC, TRADE
from marketspark.session import use_utc

AS_OF = "2024-02-01 00:00:00"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, all of it in one micro-batch."""
    # A stream reads folders or patterns, and the table may be a single file: a pattern that matches only it.
    return spark.readStream.schema(events(spark, sf_dir).schema).parquet(f"{sf_dir}/[e]vents.parquet")


def _side() -> Column:
    return (
        F.when(F.col("user_id") % 20 == 0, "HOLD").when(F.col("user_id") % 2 == 0, "BUY").otherwise("SELL")
    )


def _as_trades(source: DataFrame, *keep: str) -> DataFrame:
    event_time = F.col("ts").cast("timestamp")
    return source.select(
        F.col("event_id").cast("string").alias("trade_id"),
        F.lit("sim").alias("exchange"),
        F.upper("event_type").alias("symbol"),
        F.col("value").cast("decimal(18,8)").alias("price"),
        F.get_json_object("props", "$.k").cast("decimal(18,8)").alias("quantity"),
        _side().alias("side"),
        event_time.alias("event_time"),
        _plus_seconds(event_time, F.col("event_id") % 7).alias("ingest_time"),
        F.lit("1").alias("schema_version"),
        *keep,
    )


def _plus_seconds(instant: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(instant) + seconds.cast("bigint") * 1_000_000)


def trades(source: DataFrame) -> DataFrame:
    return _as_trades(source)


def messy_trades(source: DataFrame) -> DataFrame:
    """Trades with odd casing and blanks in symbol, side and exchange."""
    rows = _as_trades(source, "event_id")
    blank = F.lit("  ")
    return rows.withColumns({
        "symbol": F.when(F.col("event_id") % 3 == 0, F.concat(blank, F.lower("symbol"), blank)).otherwise(F.col("symbol")),
        "side": F.when(F.col("event_id") % 4 == 0, F.concat(F.lower("side"), blank)).otherwise(F.col("side")),
        "exchange": F.lit(" Sim "),
    }).drop("event_id")


def delayed_trades(source: DataFrame, seconds: int = 3600) -> DataFrame:
    """Trades of which every eleventh arrives so much later, an hour unless told otherwise."""
    rows = _as_trades(source, "event_id")
    late = _plus_seconds(F.col("ingest_time"), F.lit(seconds))
    return rows.withColumn(
        "ingest_time", F.when(F.col("event_id") % 11 == 0, late).otherwise(F.col("ingest_time"))
    ).drop("event_id")


def repeated_trades(source: DataFrame) -> DataFrame:
    """Trades of which every fifth is delivered again three seconds later with one more unit."""
    rows = _as_trades(source, "event_id")
    copies = F.when(F.col("event_id") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    copy = F.col("_copy")
    return (
        rows.withColumn("_copy", F.explode(copies))
        .withColumns({
            "quantity": (F.col("quantity") + copy).cast("decimal(18,8)"),
            "ingest_time": _plus_seconds(F.col("ingest_time"), copy * 3),
        })
        .drop("event_id", "_copy")
    )


def corrected_trades(source: DataFrame, days: int) -> DataFrame:
    """Trades of which every fifth is delivered again so many days later, with that event time and one more unit."""
    rows = _as_trades(source, "event_id")
    copies = F.when(F.col("event_id") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    later = F.col("_copy") * (days * 86_400)
    return (
        rows.withColumn("_copy", F.explode(copies))
        .withColumns({
            "quantity": (F.col("quantity") + F.col("_copy")).cast("decimal(18,8)"),
            "event_time": _plus_seconds(F.col("event_time"), later),
            "ingest_time": _plus_seconds(F.col("ingest_time"), later),
        })
        .drop("event_id", "_copy")
    )


def line_item_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trades; order and line number repeat, which gives copies of an id."""
    items = use_utc(spark).read.parquet(f"{sf_dir}/lineitem.parquet")
    return items.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trade_id"),
        F.col("l_shipdate").cast("timestamp").alias("ingest_time"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supplier_key"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )


def feed_messages(source: DataFrame) -> DataFrame:
    """Exchange feed messages, the odd ones keyed by ``event_id % 40``.

    0 a reply without data, 1 a free trade, 2 no symbol, 3 no maker flag, 4 cut off, 5 data that is no object,
    6 no JSON at all, 7 a maker flag of another type.
    """
    slot = F.col("event_id") % 40
    data = F.struct(
        F.lit("trade").alias("e"),
        F.when(slot != 2, F.col("event_type")).alias("s"),
        F.col("event_id").alias("t"),
        F.when(slot == 1, "0").otherwise(F.col("value").cast("decimal(18,8)").cast("string")).alias("p"),
        F.get_json_object("props", "$.k").alias("q"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("T"),
        F.when(slot != 3, F.col("user_id") % 2 == 1).alias("m"),
    )
    message = F.when(slot == 0, F.to_json(F.struct(F.lit(1).alias("id")))).otherwise(
        F.to_json(F.struct(F.concat(F.col("event_type"), F.lit("@trade")).alias("stream"), data.alias("data")))
    )
    broken = (
        F.when(slot == 4, F.substring(message, 1, 30))
        .when(slot == 5, '{"data": "oops"}')
        .when(slot == 6, "pong")
        .when(slot == 7, F.regexp_replace(message, '"m":(true|false)', '"m":"$1"'))
    )
    return source.select("event_id", F.coalesce(broken, message).alias("value"))


def wire_trades(source: DataFrame) -> DataFrame:
    """Trades as text fields with a UUID id; the defects are keyed by ``event_id % 50``.

    0 cut-off JSON (applied in ``topic_rows``), 1 blanks and lower case in the symbol, 2 negative price,
    3 no price, 4 price is no number, 5 no event time, 6 event time far ahead, 7 unknown version,
    8 nine decimals in the price.
    """
    rows = _as_trades(source, "event_id")
    slot = F.col("event_id") % 50
    price = F.col("price").cast("string")
    event_time = F.when(slot == 6, F.timestamp_micros(F.unix_micros("event_time") + F.lit(10**15))).otherwise(
        F.col("event_time")
    )
    return rows.select(
        "event_id",
        stable_uuid(F.col("trade_id")).alias("trade_id"),
        "exchange",
        F.when(slot == 1, F.concat(F.lit(" "), F.lower("symbol"))).otherwise(F.col("symbol")).alias("symbol"),
        F.when(slot == 2, F.concat(F.lit("-"), price))
        .when(slot == 3, F.lit(None))
        .when(slot == 4, "n/a")
        .when(slot == 8, F.concat(price, F.lit("1")))
        .otherwise(price)
        .alias("price"),
        F.col("quantity").cast("string").alias("quantity"),
        "side",
        F.when(slot != 5, iso_utc(event_time)).alias("event_time"),
        iso_utc(F.col("ingest_time")).alias("ingest_time"),
        F.when(slot == 7, "99").otherwise("1").alias("schema_version"),
        F.col("event_time").alias("_sent"),
    )


def topic_rows(source: DataFrame) -> DataFrame:
    """Topic rows of the wire trades, with message times up to 400 seconds after the event."""
    wire = wire_trades(source)
    created = F.lit(AS_OF).cast("timestamp")
    sent = _plus_seconds(F.col("_sent"), F.col("event_id") * 37 % 400)
    fields = {name: F.col(name) for name in TRADE.fieldNames()}
    value = envelope_json(fields, stable_uuid(F.lit("e"), F.col("trade_id")), created)
    cut = F.when(F.col("event_id") % 50 == 0, F.substring(value, 1, 40)).otherwise(value)
    return wire.select(
        F.encode("symbol", "UTF-8").alias("key"),
        F.encode(cut, "UTF-8").alias("value"),
        F.lit(RAW_TOPIC).alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 3).alias("offset"),
        sent.alias("timestamp"),
    )


def topic_messages(source: DataFrame) -> DataFrame:
    """Clean trades, encoded as they are published, ids and times fixed."""
    rows = _as_trades(source).withColumn("trade_id", stable_uuid(F.col("trade_id")))
    return encode_envelope(
        rows, stable_uuid(F.lit("e"), F.col("trade_id")), F.lit(AS_OF).cast("timestamp")
    )


def shown(df: DataFrame, **digits: int) -> DataFrame:
    """Comparable output: decimals as double, instants without zone, doubles rounded where asked."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        if field.name in digits:
            column = F.round(column, digits[field.name])
        columns.append(column.alias(field.name))
    return df.select(*columns)
