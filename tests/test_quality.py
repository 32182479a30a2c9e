from __future__ import annotations

import json
from collections import Counter
from datetime import timedelta
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from helpers import START, trade, trades
from marketspark.operators import quality as q
from marketspark.operators.gold import AGGREGATES, aggregate_ohlc, aggregate_volume_profile
from marketspark.operators.silver import with_partition_date
from marketspark.plans import marts
from marketspark.workload import checks  # noqa: F401  (register the queries)
from marketspark.workload.registry import QUERIES


def silver(df):
    return q.SILVER_TRADES_SUITE.report(df)


def failed(result):
    return [(r["expectation"], r.get("column")) for r in result["results"] if not r["success"]]


def test_valid_silver_passes(spark):
    result = silver(trades(spark, trade("1"), trade("2")))
    assert result["success"] is True and len(result["results"]) == 12
    assert result["suite"] == "silver.trades" and result["duration_seconds"] > 0 and result["timestamp"]
    unique = result["results"][-1]
    assert (unique["unique_count"], unique["total_count"]) == (2, 2)


def test_missing_column_fails_existence_and_not_null(spark):
    result = silver(trades(spark, trade("1"), trade("2")).drop("event_time"))
    assert failed(result) == [(q.COLUMN_EXISTS, "event_time"), (q.NOT_NULL, "event_time")]
    assert [r for r in result["results"] if r["expectation"] == q.NOT_NULL][1]["unexpected_count"] == 2


@pytest.mark.parametrize(("changes", "expected"), [
    ({"price": Decimal("-100")}, (q.BETWEEN, "price")),
    ({"price": Decimal("1000000.5")}, (q.BETWEEN, "price")),
    ({"side": "INVALID"}, (q.IN_SET, "side")),
    ({"side": None}, (q.IN_SET, "side")),
    ({"event_time": None}, (q.NOT_NULL, "event_time")),
    ({"trade_id": "1"}, (q.UNIQUE, "trade_id")),
])
def test_bad_values_fail(spark, changes, expected):
    assert failed(silver(trades(spark, trade("1"), {**trade("2"), **changes}))) == [expected]


def test_null_price_passes_between_and_null_ids_are_one_value(spark):
    assert silver(trades(spark, trade("1", price=None)))["success"]
    result = silver(trades(spark, trade(None), trade(None), trade("1")))
    assert (q.UNIQUE, "trade_id") in failed(result)
    assert (result["results"][-1]["unique_count"], result["results"][-1]["total_count"]) == (2, 3)


def test_empty_table_has_no_columns(spark):
    result = silver(trades(spark, trade()).limit(0))
    assert {kind for kind, _ in failed(result)} == {q.COLUMN_EXISTS}


def test_gold_suite(spark):
    candles = aggregate_ohlc(trades(spark, trade()))
    suite = q.GOLD_OHLC_SUITE
    assert suite.report(candles)["success"]
    negative = candles.selectExpr("* EXCEPT (volume)", "-1 AS volume")
    assert failed(suite.report(negative)) == [(q.BETWEEN, "volume")]


def test_other_expectations(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), "x")], "number double, text string")
    results = q.Suite("s", (
        (q.BETWEEN, {"column": "number", "max_value": 5}),
        (q.IN_SET, {"column": "text", "value_set": ["x", None]}),
        (q.IN_SET, {"column": "absent", "value_set": ["x"]}),
        (q.BETWEEN, {"column": "absent", "min_value": 0}),
        (q.UNIQUE, {"column": "absent"}),
        (q.ROW_COUNT, {"min_value": 1, "max_value": 1}),
        ("expect_the_moon", {}),
    )).report(df)["results"]
    assert [r["success"] for r in results] == [True, True, False, True, True, False, True]
    assert results[2]["unexpected_count"] == 2
    assert results[5]["row_count"] == 2
    assert "expect_the_moon" in results[6]["note"]
    unknown = q.Suite("nothing").report(df)
    assert unknown["success"] is True and unknown["results"] == []


def test_row_checks_share_one_aggregate_and_nothing_is_collected(spark):
    results = q.SILVER_TRADES_SUITE.results(trades(spark, trade()))
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    # One aggregate for the row checks; for uniqueness two over hashes, three over repeated ones, and their sum.
    assert plan.count("Aggregate") == 7


def test_check_counts(spark):
    results = q.SILVER_TRADES_SUITE.results(trades(spark, trade("1", price=Decimal("-1"))))
    assert [tuple(r) for r in q.check_counts(results).collect()] == [("silver.trades", 11, 1)]


@pytest.mark.parametrize("dataset", sorted(AGGREGATES))
def test_gold_contracts(spark, dataset):
    golden = AGGREGATES[dataset](trades(spark, trade("1"), trade("2", side="SELL")))
    suite = q.gold_contract_suite(dataset)
    assert suite.report(golden)["success"]
    column = q.GOLD_COUNTS[dataset][0]
    negative = golden.selectExpr(f"* EXCEPT ({column})", f"-1 AS {column}")
    assert failed(suite.report(negative)) == [(q.BETWEEN, column)]


def test_ohlc_invariants(spark):
    candles = aggregate_ohlc(trades(spark, trade("1"), trade("2", symbol="B")))
    suite = q.OHLC_INVARIANTS_SUITE
    assert suite.report(candles)["success"]
    broken = candles.selectExpr("* EXCEPT (high_price)", "IF(symbol = 'B', 1, high_price) AS high_price")
    result = suite.report(broken)
    assert [c for _, c in failed(result)] == list(q.OHLC_INVARIANTS[:3])
    rows = q.failing_rows(broken, q.CONDITION, {"condition": q.OHLC_INVARIANTS[0]}).collect()
    assert [r.symbol for r in rows] == ["B"]


def test_strict_silver(spark):
    df = with_partition_date(trades(spark, trade("1"), trade("2", quantity=Decimal("0"))))
    fresh = q.strict_silver_suite(as_of=START + timedelta(seconds=119))
    assert failed(fresh.report(df)) == [(q.CONDITION, "quantity > 0")]
    stale = q.strict_silver_suite(as_of=START + timedelta(seconds=121))
    result = stale.report(df.filter("quantity > 0"))
    assert failed(result) == [(q.FRESH, "event_time")]
    assert result["results"][-1]["lag_seconds"] == 121.0


def test_mart_tests_and_relationships(spark):
    df = trades(spark, trade("1"), trade("2", symbol="B"))
    ohlc = aggregate_ohlc(df)
    summary = marts.build_daily_summary(ohlc, aggregate_volume_profile(df))
    results = q.mart_tests({"daily_summary": summary, **marts.marts_over(summary)})
    assert results.count() == 14 and results.filter("NOT success").count() == 0
    doubled = q.mart_tests({"daily_summary": summary.unionAll(summary)})
    bad, = doubled.filter("NOT success").collect()
    assert (bad.expectation, bad.unexpected_count) == (q.UNIQUE_COMBINATION, 2)
    assert {r.copies for r in q.repeated_keys(summary.unionAll(summary), ["symbol", "trade_date"]).collect()} == {2}
    staged = marts.stg_ohlc(ohlc.filter("symbol = 'B'"))
    assert [r.symbol for r in q.orphans(summary, staged, ["symbol", "trade_date"]).collect()] == ["BTCUSDT"]


def test_stored_table_run_writes_results(spark, tmp_path):
    path, out = str(tmp_path / "silver"), str(tmp_path / "results")
    trades(spark, trade("1", price=Decimal("-1"))).write.parquet(path)
    result = q.validate_table(spark, q.SILVER_TRADES, path, out)
    with pytest.raises(q.ValidationFailed, match="price"):
        q.require(result)
    written = [json.loads(line) for f in (tmp_path / "results").glob("*.json") for line in f.read_text().splitlines()]
    assert len(written) == 12 and sum(not w["success"] for w in written) == 1
    assert all(w["suite"] == "silver.trades" and w["timestamp"] and w["duration_seconds"] > 0 for w in written)
    assert [(w["unique_count"], w["total_count"]) for w in written if w["expectation"] == q.UNIQUE] == [(1, 1)]
    with pytest.raises(ValueError):
        q.validate_table(spark, "other", path)


@pytest.mark.parametrize("width", [1, 2, 64])
def test_uniqueness_is_exact_where_hashes_collide(spark, monkeypatch, width):
    """Hashes of a few values only, so that other texts meet copies in one hash."""
    monkeypatch.setattr(q, "_key_hash", lambda column: F.pmod(F.xxhash64(column), F.lit(width)))
    for ids in (["a", "b", "c"], ["a", "a", "b"], [None, "a", None], [None], [], ["", " ", "a"]):
        df = spark.createDataFrame([(i,) for i in ids], "trade_id string").repartition(3)
        row, = q.Suite("ids", ((q.UNIQUE, {"column": "trade_id"}),)).results(df).collect()
        assert (row.unique_count, row.total_count, row.success) == (len(set(ids)), len(ids), len(set(ids)) == len(ids))


def test_uniqueness_of_texts_shuffles_hashes(spark):
    df = spark.createDataFrame([(str(i),) for i in range(2000)], "trade_id string")
    results = q.Suite("ids", ((q.UNIQUE, {"column": "trade_id"}),)).results(df)
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(_hash" in plan
    assert results.collect()[0].unique_count == 2000


def test_invariants_query_breaks_every_invariant(spark, tmp_path):
    """A trade an hour: the hours from three to nine are spoilt, volumes and counts among them."""
    rows = [(hour, START.replace(hour=hour, year=2024, month=1), 1, "click", 5.0, '{"k": 2}') for hour in range(12)]
    columns = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "events.parquet"))
    found = QUERIES["dq_ohlc_invariants"](spark, str(tmp_path)).orderBy("position").collect()
    assert [r.column for r in found] == [*q.OHLC_INVARIANTS] * 2
    assert [r.unexpected_count for r in found] == [1, 2, 2, 1, 1, 1] + [0] * 6
    assert [r.success for r in found] == [False] * 6 + [True] * 6


def test_failing_rows_of_a_suite(spark):
    df = spark.createDataFrame([(1, "a"), (7, None), (None, "b")], "number int, text string")
    suite = q.Suite("s", (
        (q.UNIQUE, {"column": "text"}),
        (q.CONDITION, {"condition": "number < 5"}),
        (q.NOT_NULL, {"column": "text"}),
        (q.NOT_NULL, {"column": "absent"}),
    ))
    rows = suite.failing_rows(df).collect()
    assert sorted(((r.position, r.expectation, r.column, tuple(r.row)) for r in rows), key=repr) == sorted([
        (1, q.CONDITION, "number < 5", (7, None)),
        (1, q.CONDITION, "number < 5", (None, "b")),
        (2, q.NOT_NULL, "text", (7, None)),
        *[(3, q.NOT_NULL, "absent", row) for row in ((1, "a"), (7, None), (None, "b"))],
    ], key=repr)
    counts = {r.position: r.unexpected_count for r in suite.results(df).collect() if r.unexpected_count}
    assert counts == {1: 2, 2: 1, 3: 3}
    assert q.Suite("nothing").failing_rows(df).collect() == [] and suite.failing_rows(df.limit(0)).collect() == []


def test_invariants_query_gives_the_rows_behind_its_counts(spark, tmp_path):
    """A trade an hour, and one without a symbol in the seventh: every candle that fails is there, whole."""
    rows = [(hour, START.replace(hour=hour, year=2024, month=1), 1, "click", 5.0, '{"k": 2}') for hour in range(12)]
    rows.append((12, START.replace(hour=7, year=2024, month=1), 1, None, 0.07, '{"k": 3}'))
    columns = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "events.parquet"))
    found = QUERIES["dq_ohlc_invariant_rows"](spark, str(tmp_path)).collect()
    assert sorted((r.position, r.column, r.window_start.hour) for r in found) == [
        (i, q.OHLC_INVARIANTS[i], hour) for i, hour in ((0, 6), (1, 6), (1, 8), (2, 6), (2, 9), (3, 3), (4, 4), (5, 7), (5, 7))]
    high, = [r for r in found if r.position == 0]
    assert (high.symbol, high.open_price, high.high_price, high.low_price, high.volume) == ("CLICK", 5.0, 4.0, 5.0, 2.0)
    assert {(r.symbol, r.close_price, r.volume, r.window_end == r.window_start) for r in found if r.position == 5} == {
        ("CLICK", 5.0, 2.0, True), (None, 0.07, 3.0, True)}
    counts = QUERIES["dq_ohlc_invariants"](spark, str(tmp_path)).collect()
    assert {r.position: r.unexpected_count for r in counts if not r.success} == dict(Counter(r.position for r in found))
