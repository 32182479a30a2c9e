from __future__ import annotations

import random
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, START, rows_of, trade, trades
from marketspark.operators import silver as silver_module
from marketspark.operators.silver import (
    anti_join_invalid,
    count_duplicates_dropped,
    count_invalid_events,
    deduplicate_by_trade_id,
    enrich_with_processing_metadata,
    filter_invalid_events,
    flag_business_rules,
    normalize_fields,
    to_silver,
    validate_business_rules,
)
from marketspark.schemas import ENRICHED_TRADE


def test_normalize_trims_and_cases(spark):
    df = spark.createDataFrame([(" btcusdt ", "BINANCE", "buy ")], "symbol string, exchange string, side string")
    row = normalize_fields(df).first()
    assert (row.symbol, row.exchange, row.side) == ("BTCUSDT", "binance", "BUY")


def test_rules_reject_bad_and_null_values(spark):
    df = trades(
        spark,
        trade("ok"),
        trade("price", price=Decimal("-10")),
        trade("quantity", quantity=Decimal("0")),
        trade("side", side="INVALID"),
        trade("future", seconds=6),
        trade("skew", seconds=5),
        trade("null", price=None),
    )
    now = START
    assert sorted(r.trade_id for r in validate_business_rules(df, now).collect()) == ["ok", "skew"]
    valid, invalid = filter_invalid_events(df, now)
    assert valid.count() + invalid.count() == df.count()
    failed = {r.trade_id: r.failed_rules for r in flag_business_rules(invalid, now).collect()}
    assert failed == {
        "price": ["price_positive"],
        "quantity": ["quantity_positive"],
        "side": ["side_known"],
        "future": ["event_time_not_in_future"],
        "null": ["price_positive"],
    }
    assert count_invalid_events(invalid) == 5


def test_current_time_is_the_default_clock(spark):
    df = trades(spark, trade("1")).withColumn("event_time", F.current_timestamp())
    later = df.withColumn("event_time", F.current_timestamp() + F.expr("INTERVAL 1 HOUR"))
    assert validate_business_rules(df).count() == 1
    assert validate_business_rules(later).count() == 0


def test_valid_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    trades(spark, trade()).write.parquet(path)
    plan = validate_business_rules(spark.read.parquet(path), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(price" in plan and "In(side" in plan


def test_anti_join_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [
        trade(rng.choice([None, "a", "b", "c", "d", "e"]), price=Decimal(rng.choice([-1, 1])), seconds=i)
        for i in range(60)
    ]
    valid_ids = {r["trade_id"] for r in rows if r["price"] > 0 and r["trade_id"] is not None}
    expected = [r for r in rows if r["trade_id"] not in valid_ids]
    found = anti_join_invalid(trades(spark, *rows), AS_OF)
    assert rows_of(found) == rows_of(trades(spark, *expected))


def test_dedup_keeps_latest_ingest_then_latest_event(spark):
    early, late = START, START + timedelta(hours=1)
    df = trades(
        spark,
        trade("a", ingest_time=early, price=Decimal("100")),
        trade("a", ingest_time=late, price=Decimal("101")),
        trade("b", ingest_time=late, event_time=early, price=Decimal("1")),
        trade("b", ingest_time=late, event_time=late, price=Decimal("2")),
        trade("c"),
    )
    kept = {r.trade_id: r.price for r in deduplicate_by_trade_id(df).collect()}
    assert kept == {"a": Decimal("101"), "b": Decimal("2"), "c": Decimal("68000")}
    assert count_duplicates_dropped(df) == 2
    assert count_duplicates_dropped(df, deduplicate_by_trade_id(df)) == 2


def test_dedup_on_three_columns(spark):
    df = spark.createDataFrame(
        [("abc", 100.0, START), ("abc", 101.0, START + timedelta(hours=1))],
        "trade_id string, price double, ingest_time timestamp",
    )
    assert [r.price for r in deduplicate_by_trade_id(df).collect()] == [101.0]


def test_null_ids_are_one_group_and_limited_before_the_shuffle(spark):
    df = trades(spark, *[trade(None, seconds=i) for i in range(50)], trade("x"))
    unique = deduplicate_by_trade_id(df)
    assert unique.count() == 2
    assert unique.filter("trade_id IS NULL").first().event_time == START + timedelta(seconds=49)
    assert count_duplicates_dropped(df) == 49
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_dedup_result_does_not_depend_on_input_order(spark):
    rng = random.Random(5)
    rows = [
        trade(str(rng.randrange(20)), seconds=rng.randrange(3), price=Decimal(rng.randrange(1, 4)),
              ingest_time=START + timedelta(seconds=rng.randrange(3)))
        for _ in range(300)
    ]
    first = rows_of(deduplicate_by_trade_id(trades(spark, *rows)))
    rng.shuffle(rows)
    assert rows_of(deduplicate_by_trade_id(trades(spark, *rows).repartition(7))) == first


def test_enrich_adds_metadata(spark):
    enriched = enrich_with_processing_metadata(trades(spark, trade()))
    assert enriched.columns == ENRICHED_TRADE.fieldNames()
    row = enriched.first()
    assert row.processing_timestamp is not None
    assert (row.pipeline_version, row.partition_date) == ("0.1.0", "2026-05-24")


def test_to_silver_chains_the_steps(spark):
    df = trades(
        spark,
        trade("1", symbol=" btcusdt", side="sell"),
        trade("1", symbol="BTCUSDT", side="SELL", ingest_time=START + timedelta(hours=2)),
        trade("2", price=Decimal("-1")),
    )
    row, = to_silver(df, AS_OF).collect()
    assert (row.trade_id, row.symbol, row.side, row.ingest_time) == ("1", "BTCUSDT", "SELL", START + timedelta(hours=2))


def stored_trades(spark, path, seed=3, n=300):
    rng = random.Random(seed)
    rows = [trade(rng.choice([None, *map(str, range(40))]), seconds=i, side=rng.choice(["BUY", "HOLD"]), price=Decimal(i)) for i in range(n)]
    trades(spark, *rows).repartition(3).write.parquet(path)
    return rows, spark.read.parquet(path)


@pytest.mark.parametrize("limit", [0, 500_000])
def test_anti_join_either_way(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(silver_module, "SUSPECTS_BROADCAST", limit)
    rows, df = stored_trades(spark, str(tmp_path / "t"))

    def valid(r):
        return r["side"] == "BUY" and r["price"] > 0

    ids = {r["trade_id"] for r in rows if valid(r) and r["trade_id"] is not None}
    expected = sorted((r["trade_id"] or "", r["price"]) for r in rows if r["trade_id"] not in ids)
    found = anti_join_invalid(df, AS_OF)
    # The pass that stored the suspects, and one more over the input.
    assert found._jdf.queryExecution().executedPlan().toString().count(f"{tmp_path}/t") == 1
    assert sorted((r.trade_id or "", r.price) for r in found.collect()) == expected and expected
