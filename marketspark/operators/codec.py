"""Trade messages: topic rows to columns, feed messages to trades, trades to topic rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType, StringType, StructField, StructType, TimestampType

from marketspark.functions.rules import (
    broken,
    contract_rules,
    decimal_value,
    instant,
    iso_timestamp,
    timestamp_value,
)
from marketspark.schemas import (
    DEFAULT_EXCHANGE,
    EVENT_TYPE,
    RAW_TOPIC,
    TRADE,
    TRADE_VERSIONS,
    Versions,
    camel_case,
    newest,
)

_BAD = "_bad"
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}

FEED_MESSAGE = StructType([
    StructField("data", StructType([
        StructField("s", StringType()),
        StructField("t", StringType()),
        StructField("p", StringType()),
        StructField("q", StringType()),
        StructField("T", StringType()),
        StructField("m", BooleanType()),
    ])),
    StructField(_BAD, StringType()),
])


# The feed tells its fields apart by case alone (t and T), which column names do not: rename by position.
_FEED_NAMES = (
    "struct<data: struct<symbol: string, number: string, price: string, quantity: string, millis: string, "
    f"maker: boolean>, {_BAD}: string>"
)


def envelope_schema(trade: StructType = TRADE) -> StructType:
    """The wire envelope. Payload values stay text, so that a rule can look at them before any cast."""
    payload = StructType([StructField(camel_case(name), StringType()) for name in trade.fieldNames()])
    return StructType([
        StructField("eventId", StringType()),
        StructField("eventType", StringType()),
        StructField("payload", payload),
        StructField("timestamp", StringType()),
        StructField("source", StringType()),
        StructField("partitionKey", StringType()),
        StructField(_BAD, StringType()),
    ])


def computed_once(df: DataFrame, value: Column, name: str, when: Column | None = None) -> DataFrame:
    """Add ``value`` as a column that filters and projections above do not compute again.

    Filters are pushed through a projection and repeat its expressions; they stop at a generator. Rows
    for which ``when`` does not hold are dropped.
    """
    values = F.array(value)
    return df.select("*", F.explode(values if when is None else F.when(when, values)).alias(name))


def _typed(raw: Column, field: StructField) -> Column:
    if isinstance(field.dataType, TimestampType):
        return iso_timestamp(raw)
    if isinstance(field.dataType, DecimalType):
        return raw.try_cast(field.dataType)
    if isinstance(field.dataType, StringType):
        return raw
    return raw.try_cast(field.dataType)


def read_envelopes(df: DataFrame, versions: Versions = TRADE_VERSIONS) -> DataFrame:
    """Add to topic rows ``raw`` (payload text), ``trade`` (typed payload) and ``readable``.

    A message is readable when it is UTF-8 JSON with a payload whose numbers and times, where given,
    parse, and which has an event time. Fields unknown to the latest schema are ignored, fields a
    message lacks take their default or NULL.
    """
    schema = newest(versions)
    text = F.col("value").cast("string")
    parsed = F.from_json(text, envelope_schema(schema), _PERMISSIVE)
    rows = computed_once(df, parsed, "_envelope")

    raw = {f.name: F.col("_envelope.payload")[camel_case(f.name)] for f in schema.fields}
    values, sound = [], F.lit(True)
    for field in schema.fields:
        value = _typed(raw[field.name], field)
        if not isinstance(field.dataType, StringType):
            sound = sound & (raw[field.name].isNull() | F.col(f"trade.{field.name}").isNotNull())
        values.append(value.alias(field.name))

    readable = (
        F.is_valid_utf8(text)
        & F.col(f"_envelope.{_BAD}").isNull()
        & F.col("_envelope.payload").isNotNull()
        & F.col("trade.event_time").isNotNull()
        & sound
    )
    defaults = {f.name: f.metadata["default"] for f in schema.fields if "default" in f.metadata}
    trade = F.col("trade")
    for name, default in {"schema_version": "1", **defaults}.items():
        filled = F.coalesce(trade[name], F.lit(default).cast(schema[name].dataType))
        trade = trade.withField(name, filled)
    return (
        rows.withColumns({
            "raw": F.struct(*[column.alias(name) for name, column in raw.items()]),
            "trade": F.struct(*values),
        })
        .withColumns({"trade": trade, "readable": F.coalesce(readable, F.lit(False))})
        .drop("_envelope")
    )


def decode_events(df: DataFrame, versions: Versions = TRADE_VERSIONS) -> DataFrame:
    """Topic rows to trades. Unreadable messages are left to the dead letters."""
    return computed_once(read_envelopes(df, versions), F.col("trade"), "_trade", F.col("readable")).select("_trade.*")


def stable_uuid(*parts: Column) -> Column:
    """A UUID-shaped id that is the same for the same parts."""
    digest = F.md5(F.concat_ws("|", *parts))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def iso_utc(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def envelope_json(fields: dict[str, Column], event_id: Column, created_at: Column) -> Column:
    """Envelope JSON around a trade given by column name. NULL fields are left out."""
    version = {"schema_version": fields["schema_version"].cast("int")} if "schema_version" in fields else {}
    payload = [column.alias(camel_case(name)) for name, column in {**fields, **version}.items()]
    return F.to_json(F.struct(
        event_id.alias("eventId"),
        F.lit(EVENT_TYPE).alias("eventType"),
        F.struct(*payload).alias("payload"),
        iso_utc(created_at).alias("timestamp"),
        fields["exchange"].alias("source"),
        fields["symbol"].alias("partitionKey"),
    ))


def encode_envelope(
    trades: DataFrame,
    event_id: Column | None = None,
    created_at: Column | None = None,
    topic: str = RAW_TOPIC,
) -> DataFrame:
    """Trades to keyed topic rows ``(key, value, topic)``: camel-case JSON in an envelope, key = symbol."""
    fields = {}
    for field in trades.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, TimestampType):
            column = iso_utc(column)
        elif isinstance(field.dataType, DecimalType):
            column = column.cast("string")
        fields[field.name] = column
    message = envelope_json(
        fields,
        F.uuid() if event_id is None else event_id,
        F.current_timestamp() if created_at is None else created_at,
    )
    return trades.select(
        F.encode("symbol", "UTF-8").alias("key"),
        F.encode(message, "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
    )


def read_feed(
    df: DataFrame,
    exchange: str = DEFAULT_EXCHANGE,
    id_mode: str = "random",
    ingest_time: Column | None = None,
) -> DataFrame:
    """Exchange feed messages (text in ``value``) to ``trade`` and ``failed_rules``, other columns kept.

    JSON objects without ``data``, such as subscription replies, are skipped. What is no readable JSON
    object, or holds a field of another type, breaks ``json_object`` alone. ``id_mode="exchange"``
    builds the trade id from exchange, symbol and the exchange's own number, so that a message delivered
    twice can be recognised; ``"random"`` gives each message a new id.
    """
    if id_mode not in ("random", "exchange"):
        raise ValueError(f"unknown id_mode {id_mode!r}")
    parsed = F.from_json(F.col("value").cast("string"), FEED_MESSAGE, _PERMISSIVE).cast(_FEED_NAMES)
    data = F.col("_feed.data")
    symbol = F.upper(F.trim(F.coalesce(data["symbol"], F.lit("UNKNOWN"))))
    price = F.coalesce(data["price"], F.lit("0"))
    quantity = F.coalesce(data["quantity"], F.lit("0"))
    side = F.when(data["maker"] == F.lit(False), "BUY").otherwise("SELL")
    millis = F.coalesce(data["millis"], F.lit("0")).try_cast("decimal(20,3)")
    event_time = F.timestamp_micros((millis * 1000).cast("bigint"))
    trade_id = F.uuid() if id_mode == "random" else stable_uuid(F.lit(exchange), symbol, data["number"])
    trade = F.struct(
        trade_id.alias("trade_id"),
        F.lit(exchange).alias("exchange"),
        symbol.alias("symbol"),
        decimal_value(price).alias("price"),
        decimal_value(quantity).alias("quantity"),
        side.alias("side"),
        event_time.alias("event_time"),
        (F.current_timestamp() if ingest_time is None else ingest_time).alias("ingest_time"),
        F.lit("1").alias("schema_version"),
    )
    rules = contract_rules({
        "trade_id": F.lit("00000000-0000-0000-0000-000000000000"),
        "symbol": symbol,
        "price": price,
        "quantity": quantity,
        "side": side,
        "event_time": millis.cast("string"),
        "ingest_time": F.lit(None).cast("string"),
        "schema_version": F.lit("1"),
    }, {"event_time": event_time})
    unreadable = F.col("_feed").isNull() | F.col(f"_feed.{_BAD}").isNotNull()
    failed = F.when(unreadable, F.array(F.lit("json_object"))).otherwise(broken(rules))
    rows = computed_once(df, parsed, "_feed").filter(unreadable | data.isNotNull())
    checked = computed_once(rows, F.struct(trade.alias("trade"), failed.alias("failed_rules")), "_checked")
    return checked.select(*df.columns, "_checked.*")


def parse_feed(df: DataFrame, **options) -> DataFrame:
    """Feed messages to the trades that keep the trade contract; options as in ``read_feed``."""
    return read_feed(df, **options).filter(F.size("failed_rules") == 0).select("trade.*")


def feed_errors(df: DataFrame, **options) -> DataFrame:
    """Feed messages that cannot be read, and those whose trade breaks the contract."""
    return read_feed(df, **options).filter(F.size("failed_rules") > 0).select("value", "failed_rules")


def validate_contract(df: DataFrame, column: str = "value", versions: Versions = TRADE_VERSIONS) -> DataFrame:
    """Trade JSON (camel or snake case) to typed columns plus ``failed_rules``; a valid trade has none.

    Defaults fill an absent exchange, ingest time and version; the symbol is trimmed and upper-cased.
    """
    schema = newest(versions)
    names = schema.fieldNames()
    wire = StructType([
        StructField(n, StringType()) for n in dict.fromkeys([*map(camel_case, names), *names])
    ] + [StructField(_BAD, StringType())])
    rows = computed_once(df, F.from_json(F.col(column).cast("string"), wire, _PERMISSIVE), "_trade")
    raw = {n: F.coalesce(F.col("_trade")[camel_case(n)], F.col("_trade")[n]) for n in names}
    read = {
        f.name: timestamp_value(raw[f.name]) if isinstance(f.dataType, TimestampType) else _typed(raw[f.name], f)
        for f in schema.fields
    }
    rows = rows.withColumns({
        "_raw": F.struct(*[raw[n].alias(n) for n in names]),
        "_read": F.struct(*[read[n].alias(n) for n in names]),
    })
    rules = {
        "json_object": F.col("_trade").isNotNull() & F.col(f"_trade.{_BAD}").isNull(),
        **contract_rules(
            {n: F.col(f"_raw.{n}") for n in names},
            {n: F.col(f"_read.{n}") for n in ("event_time", "ingest_time")},
        ),
    }
    typed = {n: F.col(f"_read.{n}") for n in names}
    typed["symbol"] = F.upper(F.trim(typed["symbol"]))
    defaults = {"exchange": F.lit(DEFAULT_EXCHANGE), "ingest_time": instant(None), "schema_version": F.lit("1")}
    for name, default in defaults.items():
        typed[name] = F.coalesce(typed[name], default)
    checked = F.struct(*[typed[n].alias(n) for n in names], broken(rules).alias("failed_rules"))
    return computed_once(rows, checked, "_checked").select(*[F.col(c) for c in df.columns], "_checked.*")
