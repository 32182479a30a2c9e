from __future__ import annotations

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from helpers import AS_OF, START, rows_of, trade, trades
from marketspark.operators.codec import (
    decode_events,
    encode_envelope,
    feed_errors,
    parse_feed,
    validate_contract,
)
from marketspark.operators.silver import (
    accepted,
    dead_letter_messages,
    dead_letters,
    split_by_version,
    triage,
)
from marketspark.schemas import (
    TRADE,
    TRADE_VERSIONS,
    from_wire_names,
    known_version,
    newest,
    with_version,
    to_wire_names,
)

UUID = "7f0c1a52-3d36-4b0e-9a43-0b1f7a1d2c3e"


def payload(**changes) -> dict:
    fields = {
        "tradeId": UUID,
        "exchange": "binance",
        "symbol": "BTCUSDT",
        "price": "68452.12",
        "quantity": "0.035",
        "side": "BUY",
        "eventTime": "2026-05-24T14:33:52.123456Z",
        "ingestTime": "2026-05-24T14:33:53Z",
        "schemaVersion": 1,
    }
    fields.update(changes)
    return {k: v for k, v in fields.items() if v is not ...}


def envelope(**changes) -> bytes:
    return json.dumps({"eventId": UUID, "eventType": "trade", "payload": payload(**changes)}).encode()


def topic(spark, *values: bytes):
    return spark.createDataFrame([(b"BTCUSDT", bytearray(v)) for v in values], "key binary, value binary")


def test_decode_good_message(spark):
    row, = decode_events(topic(spark, envelope())).collect()
    assert row.asDict() == {
        "trade_id": UUID,
        "exchange": "binance",
        "symbol": "BTCUSDT",
        "price": Decimal("68452.12000000"),
        "quantity": Decimal("0.03500000"),
        "side": "BUY",
        "event_time": datetime(2026, 5, 24, 14, 33, 52, 123456),
        "ingest_time": datetime(2026, 5, 24, 14, 33, 53),
        "schema_version": "1",
    }
    assert decode_events(topic(spark, envelope())).schema.simpleString() == TRADE.simpleString()


@pytest.mark.parametrize("value", [
    b"not valid json",
    b"",
    b"{}",
    b"null",
    b'{"payload": null}',
    b'{"payload": "text"}',
    b'[{"payload": {"eventTime": "2026-05-24T14:33:52Z"}}]',
    b'\xff\xfe{"payload": {}}',
    envelope(eventTime=...),
    envelope(eventTime="soon"),
    envelope(price="n/a"),
    envelope(ingestTime="12:30"),
])
def test_unreadable_messages_are_dead_letters(spark, value):
    rows = topic(spark, value)
    assert decode_events(rows).count() == 0
    letter, = dead_letters(triage(rows, AS_OF)).collect()
    assert letter.failure_reason == "deserialization_error"
    assert bytes(letter.value) == value


def test_decode_reads_offsets_numbers_and_gaps(spark):
    row, = decode_events(topic(spark, envelope(
        price=68452.12, quantity=..., eventTime="2026-05-24T16:00:00+02:00", ingestTime=..., schemaVersion=...
    ))).collect()
    assert row.price == Decimal("68452.12")
    assert row.quantity is None and row.ingest_time is None
    assert row.event_time == datetime(2026, 5, 24, 14, 0)
    assert row.schema_version == "1"


def test_message_is_parsed_once(spark):
    plan = decode_events(topic(spark, envelope()))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


@pytest.mark.parametrize(("changes", "reason", "rules"), [
    ({}, None, []),
    ({"price": "-10"}, "schema_validation_error", ["price_positive"]),
    ({"price": ...}, "schema_validation_error", ["price_decimal", "price_positive"]),
    ({"quantity": "0"}, "schema_validation_error", ["quantity_positive"]),
    ({"side": "buy"}, "schema_validation_error", ["side_known"]),
    ({"tradeId": "12"}, "schema_validation_error", ["trade_id_uuid"]),
    ({"schemaVersion": 99}, "unknown_schema_version", []),
    ({"eventTime": "2030-01-01T00:00:00Z"}, "business_rule_violation", ["event_time_not_in_future"]),
])
def test_triage_names_the_failing_stage(spark, changes, reason, rules):
    row = triage(topic(spark, envelope(**changes)), AS_OF).first()
    assert row.failure_reason == reason
    assert row.failed_rules == rules


def test_triage_loses_no_message(spark):
    values = [envelope(), b"x", envelope(price="-1"), envelope(schemaVersion=5), envelope(side=...)]
    triaged = triage(topic(spark, *values), AS_OF)
    assert accepted(triaged).count() == 1
    assert dead_letters(triaged).count() == 4


def test_dead_letter_headers(spark):
    letters = dead_letters(triage(topic(spark, envelope(price="-1")), AS_OF))
    message = dead_letter_messages(letters, "dead-letter.trades").first()
    headers = {h.key: bytes(h.value).decode() for h in message.headers}
    assert headers == {"failure_reason": "schema_validation_error", "failed_rules": "price_positive"}
    assert message.topic == "dead-letter.trades"


def test_encode_uses_wire_names_and_round_trips(spark):
    source = trades(spark, trade(UUID), trade(UUID, symbol="ETHUSDT", price=Decimal("0.00000001")))
    messages = encode_envelope(source)
    first = json.loads(bytes(messages.first().value))
    assert set(first) == {"eventId", "eventType", "payload", "timestamp", "source", "partitionKey"}
    assert first["eventType"] == "trade" and first["source"] == "binance"
    assert first["partitionKey"] == "BTCUSDT" == bytes(messages.first().key).decode()
    assert {"tradeId", "eventTime", "schemaVersion"} <= set(first["payload"])
    assert rows_of(decode_events(messages)) == rows_of(source)


def test_wire_names_round_trip(spark):
    source = trades(spark, trade())
    assert "tradeId" in to_wire_names(source).columns
    assert from_wire_names(to_wire_names(source)).columns == source.columns


def contract(spark, **changes):
    df = spark.createDataFrame([(json.dumps(payload(**changes)),)], "value string")
    return validate_contract(df).first()


@pytest.mark.parametrize(("changes", "rules"), [
    ({}, []),
    ({"price": "1234567890.12345678"}, []),
    ({"price": "1.100000000000"}, []),
    ({"price": "1e3"}, []),
    ({"price": "12345678901"}, ["price_decimal"]),
    ({"price": "1.123456789"}, ["price_decimal"]),
    ({"price": "1.00000000000000000000000000001"}, ["price_decimal"]),
    ({"price": ...}, ["price_decimal", "price_positive"]),
    ({"side": "INVALID"}, ["side_known"]),
    ({"price": -10.0}, ["price_positive"]),
    ({"quantity": 0}, ["quantity_positive"]),
    ({"tradeId": UUID.replace("-", "")}, []),
    ({"symbol": ...}, ["symbol_present"]),
    ({"eventTime": 1716561600}, []),
    ({"eventTime": "yesterday"}, ["event_time_timestamp"]),
    ({"schemaVersion": "one"}, ["schema_version_integer"]),
])
def test_contract_rules(spark, changes, rules):
    assert contract(spark, **changes).failed_rules == rules


def test_contract_defaults_and_case(spark):
    row = contract(spark, symbol=" btcusdt", exchange=..., ingestTime=..., eventTime="2026-05-24T14:33:52")
    assert (row.symbol, row.exchange, row.schema_version) == ("BTCUSDT", "binance", "1")
    assert row.ingest_time is not None
    assert row.event_time == datetime(2026, 5, 24, 14, 33, 52)


def test_contract_accepts_snake_case_and_refuses_other_json(spark):
    snake = {"trade_id": UUID, "symbol": "X", "price": "1", "quantity": "2", "side": "SELL",
             "event_time": "2026-05-24T00:00:00Z"}
    df = spark.createDataFrame([(json.dumps(snake),), ("[1]",), ("oops",)], "value string")
    good, other, broken = validate_contract(df).collect()
    assert good.failed_rules == [] and good.trade_id == UUID
    assert "json_object" in other.failed_rules and "json_object" in broken.failed_rules


def feed(spark, *messages: dict):
    return spark.createDataFrame([(json.dumps(m),) for m in messages], "value string")


def feed_trade(**changes) -> dict:
    data = {"e": "trade", "E": 1716561600000, "s": "btcusdt", "t": 12345, "p": "68452.12", "q": "0.035",
            "T": 1716561600123, "m": False, **changes}
    return {"stream": "btcusdt@trade", "data": {k: v for k, v in data.items() if v is not ...}}


def test_feed_message_becomes_a_trade(spark):
    row, = parse_feed(feed(spark, feed_trade())).collect()
    assert (row.symbol, row.side, row.exchange) == ("BTCUSDT", "BUY", "binance")
    assert row.price == Decimal("68452.12")
    assert row.event_time == datetime(2024, 5, 24, 14, 40, 0, 123000)
    assert row.ingest_time is not None


@pytest.mark.parametrize(("maker", "side"), [(False, "BUY"), (True, "SELL"), (..., "SELL"), (None, "SELL")])
def test_feed_side(spark, maker, side):
    assert parse_feed(feed(spark, feed_trade(m=maker))).first().side == side


def test_feed_skips_replies_and_reports_bad_trades(spark):
    df = feed(spark, {"result": None, "id": 1}, feed_trade(p=...), feed_trade(s=..., T=...))
    row, = parse_feed(df).collect()
    assert row.symbol == "UNKNOWN" and row.event_time == datetime(1970, 1, 1)
    error, = feed_errors(df).collect()
    assert error.failed_rules == ["price_positive"]


def test_feed_keeps_what_cannot_be_read(spark):
    good = feed_trade()
    texts = [good, '{"data":{"s":"BTC', "not json", '{"data":"oops"}', None, "", '{"result":null,"id":1}', "[]"]
    texts = [json.dumps(t) if isinstance(t, dict) else t for t in texts]
    texts.append(texts[0].replace('"m": false', '"m": "false"'))
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert parse_feed(df).count() == 1
    errors = feed_errors(df).collect()
    assert all(e.failed_rules == ["json_object"] for e in errors)
    assert {e.value for e in errors} == {*texts[1:6], *texts[7:]}


def test_feed_ids(spark):
    df = feed(spark, feed_trade(), feed_trade(), feed_trade(t=7))
    random_ids = {r.trade_id for r in parse_feed(df).collect()}
    stable_ids = [r.trade_id for r in parse_feed(df, id_mode="exchange").collect()]
    assert len(random_ids) == 3
    assert stable_ids[0] == stable_ids[1] != stable_ids[2]
    with pytest.raises(ValueError):
        parse_feed(df, id_mode="other")


def test_versions():
    assert newest() == TRADE == TRADE_VERSIONS[1]
    with pytest.raises(ValueError, match="version 1"):
        with_version(1, TRADE)
    with pytest.raises(ValueError, match="lacks schema_version"):
        with_version(2, StructType(TRADE.fields[:-1]))


def test_known_versions(spark):
    df = spark.createDataFrame([("1",), ("99",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(known_version(F.col("v"))).collect()] == [True, False, False, False]


def test_later_version_reads_old_and_new_messages(spark):
    commission = StructField("commission", DecimalType(18, 8), True, {"default": "0"})
    versions = with_version(2, StructType([*TRADE.fields, commission]))
    assert newest(versions).fieldNames()[-1] == "commission"
    rows = topic(spark, envelope(), envelope(schemaVersion=2, commission="0.25", other="ignored"))
    found = decode_events(rows, versions).orderBy("schema_version").collect()
    assert [r.commission for r in found] == [Decimal("0"), Decimal("0.25")]
    # A reader of version 1 ignores the new field.
    assert decode_events(rows).columns == TRADE.fieldNames()


def test_split_by_version(spark):
    df = trades(spark, trade("1"), trade("2", schema_version="99"), trade("3", schema_version=None))
    known, unknown = split_by_version(df)
    assert [r.trade_id for r in known.collect()] == ["1"]
    assert {r.failure_reason for r in unknown.collect()} == {"unknown_schema_version"}
    assert unknown.count() == 2


def test_topic_rows_keep_their_position(spark):
    df = topic(spark, b"x").withColumns({"offset": F.lit(5), "timestamp": F.lit(START)})
    letter = dead_letters(triage(df, AS_OF)).first()
    assert letter.offset == 5
