"""Quality suites and metric tables."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from marketspark.operators import quality
from marketspark.operators.silver import dead_letter_messages, dead_letters, triage, with_partition_date
from marketspark.plans import marts, metrics
from marketspark.schemas import DEAD_LETTER_TOPIC
from marketspark.session import working_path
from marketspark.workload import sql
from marketspark.workload.aggregates import candles, profiles, summary
from marketspark.workload.layers import REPEATED
from marketspark.workload.registry import query
from marketspark.workload.tables import AS_OF, delayed_trades, events, repeated_trades, shown, topic_rows, trades

_RESULT = ["position", "expectation", "column", "success", "unexpected_count", "unique_count", "total_count"]


def _result_sql(position: int, expectation: str, column: str, failing: str | None, source: str) -> str:
    """One result row. ``failing`` is the condition of a failing row; without it the column must exist."""
    count = f"count(CASE WHEN {failing} THEN 1 END)" if failing else "NULL"
    success = f"{count} = 0" if failing else "count(*) > 0"
    return (
        f"SELECT {position} AS position, '{expectation}' AS expectation, '{column}' AS \"column\", "
        f"{success} AS success, CAST({count} AS BIGINT) AS unexpected_count, "
        f"CAST(NULL AS BIGINT) AS unique_count, CAST(NULL AS BIGINT) AS total_count FROM {source}"
    )


def _exist_sql(columns: list[str], source: str) -> list[str]:
    return [_result_sql(i, quality.COLUMN_EXISTS, column, None, source) for i, column in enumerate(columns)]


@query("dq_silver_trades", f"WITH {REPEATED} " + " UNION ALL ".join([
    *_exist_sql(["trade_id", "symbol", "price", "quantity", "side", "event_time"], "repeated"),
    _result_sql(6, quality.NOT_NULL, "trade_id", "trade_id IS NULL", "repeated"),
    _result_sql(7, quality.NOT_NULL, "event_time", "event_time IS NULL", "repeated"),
    _result_sql(8, quality.BETWEEN, "price", "price < 0 OR price > 1000000", "repeated"),
    _result_sql(9, quality.BETWEEN, "quantity", "quantity < 0", "repeated"),
    _result_sql(10, quality.IN_SET, "side", "side NOT IN ('BUY', 'SELL') OR side IS NULL", "repeated"),
    f"""SELECT 11, '{quality.UNIQUE}', 'trade_id', count(DISTINCT trade_id) = count(*), CAST(NULL AS BIGINT),
        count(DISTINCT trade_id), count(*) FROM repeated""",
]))
def _dq_silver_trades(spark, sf_dir):
    table = repeated_trades(events(spark, sf_dir))
    return quality.SILVER_TRADES_SUITE.results(table).select(*_RESULT)


# Bad windows, keyed by the hour of their start, so that every check has rows to find.
_BAD_WINDOWS = {
    "volume": {3: "-volume - 1"},
    "trade_count": {4: "-1"},
    "symbol": {5: "NULL"},
    "high_price": {6: "low_price - 1"},
    "window_end": {7: "window_start"},
    "open_price": {8: "high_price + 1"},
    "close_price": {9: "low_price - 1"},
}
_WRONG = {
    name: f"CASE {' '.join(f'WHEN hour(window_start) = {h} THEN {value}' for h, value in cases.items())} ELSE {name} END"
    for name, cases in _BAD_WINDOWS.items()
}
_BAD_GOLD = f"{sql.GOLD}, bad AS (SELECT * REPLACE ({', '.join(f'{value} AS {name}' for name, value in _WRONG.items())}) FROM gold)"


def _bad_candles(spark, sf_dir):
    table = candles(spark, sf_dir)
    return table.select(*[F.expr(_WRONG[name]).alias(name) if name in _WRONG else name for name in table.columns])


@query("dq_gold_ohlc", f"WITH {_BAD_GOLD} " + " UNION ALL ".join([
    *_exist_sql(["symbol", "open_price", "high_price", "low_price", "close_price"], "bad"),
    _result_sql(5, quality.NOT_NULL, "symbol", "symbol IS NULL", "bad"),
    _result_sql(6, quality.BETWEEN, "volume", "volume < 0", "bad"),
    _result_sql(7, quality.BETWEEN, "trade_count", "trade_count < 0", "bad"),
]))
def _dq_gold_ohlc(spark, sf_dir):
    return quality.GOLD_OHLC_SUITE.results(_bad_candles(spark, sf_dir)).select(*_RESULT)


@query("dq_row_count", f"""
    WITH {sql.TRADES} SELECT 0 AS position, count(*) >= 1 AS success, count(*) AS row_count FROM trades
    UNION ALL SELECT 1, count(*) BETWEEN 0 AND 10, count(*) FROM trades""")
def _dq_row_count(spark, sf_dir):
    suite = quality.Suite("rows", ((quality.ROW_COUNT, {"min_value": 1}), (quality.ROW_COUNT, {"max_value": 10})))
    return suite.results(trades(events(spark, sf_dir))).select("position", "success", "row_count")


def _mart_sql(mart: str, position: int, expectation: str, column: str, count: str, source: str) -> str:
    return (
        f"SELECT '{mart}' AS mart, {position} AS position, '{expectation}' AS expectation, '{column}' AS \"column\", "
        f"{count} = 0 AS success, {count} AS unexpected_count FROM {source}"
    )


def _count_if(condition: str) -> str:
    return f"count(CASE WHEN {condition} THEN 1 END)"


_ACTIVITY = """activity AS (SELECT trade_date, sum(volume) AS total_volume FROM summary GROUP BY trade_date)"""
_COMBINATION = quality.UNIQUE_COMBINATION


# Bad rows of the daily summary, keyed by the day; rows of the seventh stand twice.
_BAD_SUMMARY = {
    "volume": "CASE day(trade_date) WHEN 3 THEN NULL WHEN 4 THEN -volume - 1 ELSE volume END",
    "trade_count": "CASE day(trade_date) WHEN 5 THEN NULL WHEN 6 THEN -1 ELSE trade_count END",
    "symbol": "CASE day(trade_date) WHEN 8 THEN NULL ELSE symbol END",
    "trade_date": "CASE WHEN day(trade_date) = 9 THEN NULL ELSE trade_date END",
}
_BAD_MARTS = sql.MARTS.replace("\nsummary AS (", "\ngood AS (") + f""", summary AS (
  SELECT * REPLACE ({', '.join(f'{value} AS {name}' for name, value in _BAD_SUMMARY.items())}) FROM good
  UNION ALL SELECT * FROM good WHERE day(trade_date) = 7)"""


@query("dq_marts", f"WITH {_BAD_MARTS}, {_ACTIVITY} " + " UNION ALL ".join([
    _mart_sql("daily_summary", 0, quality.NOT_NULL, "symbol", _count_if("symbol IS NULL"), "summary"),
    _mart_sql("daily_summary", 1, quality.NOT_NULL, "trade_date", _count_if("trade_date IS NULL"), "summary"),
    _mart_sql("daily_summary", 2, quality.NOT_NULL, "volume", _count_if("volume IS NULL"), "summary"),
    _mart_sql("daily_summary", 3, quality.BETWEEN, "volume", _count_if("volume < 0"), "summary"),
    _mart_sql("daily_summary", 4, quality.NOT_NULL, "trade_count", _count_if("trade_count IS NULL"), "summary"),
    _mart_sql("daily_summary", 5, quality.BETWEEN, "trade_count", _count_if("trade_count < 0"), "summary"),
    _mart_sql("daily_summary", 6, _COMBINATION, "symbol,trade_date", "count(*)",
              "(SELECT 1 FROM summary GROUP BY symbol, trade_date HAVING count(*) > 1)"),
    _mart_sql("symbol_performance", 0, quality.NOT_NULL, "symbol", _count_if("symbol IS NULL"), "summary"),
    _mart_sql("symbol_performance", 1, quality.BETWEEN, "volume", _count_if("volume < 0"), "summary"),
    _mart_sql("volatility_metrics", 0, quality.NOT_NULL, "symbol", _count_if("symbol IS NULL"), "summary"),
    _mart_sql("volatility_metrics", 1, quality.NOT_NULL, "trade_date", _count_if("trade_date IS NULL"), "summary"),
    _mart_sql("market_activity", 0, quality.NOT_NULL, "trade_date", _count_if("trade_date IS NULL"), "activity"),
    _mart_sql("market_activity", 1, _COMBINATION, "trade_date", "count(*)",
              "(SELECT 1 FROM activity GROUP BY trade_date HAVING count(*) > 1)"),
    _mart_sql("market_activity", 2, quality.BETWEEN, "total_volume", _count_if("total_volume < 0"), "activity"),
]))
def _dq_marts(spark, sf_dir):
    # As in production, the tests read stored marts rather than computing each mart once per test.
    path = working_path(spark, "dq-summary")
    good = summary(spark, sf_dir)
    changed = good.select(*[F.expr(_BAD_SUMMARY[name]).alias(name) if name in _BAD_SUMMARY else name for name in good.columns])
    changed.unionByName(good.filter("day(trade_date) = 7")).write.parquet(path)
    stored = spark.read.parquet(path)
    results = quality.mart_tests({"daily_summary": stored, **marts.marts_over(stored)})
    return results.select("mart", "position", "expectation", "column", "success", "unexpected_count")


@query("dq_relationships", f"""
    WITH {sql.MARTS}
    SELECT 0 AS position, 'symbol,trade_date' AS "column", count(*) = 0 AS success, count(*) AS unexpected_count
    FROM summary s WHERE NOT EXISTS (
      SELECT 1 FROM gold g WHERE g.symbol = s.symbol AND g.symbol <> 'CLICK' AND date_trunc('day', g.window_start) = s.trade_date)
    UNION ALL
    SELECT 1, 'symbol,window_start', count(*) = 0, count(*) FROM (
      SELECT DISTINCT symbol, window_start FROM gold g WHERE NOT EXISTS (
        SELECT 1 FROM gold p WHERE p.symbol = g.symbol AND p.window_start = g.window_start AND p.buy_count > 0))
    UNION ALL
    SELECT 2, 'symbol,window_start', count(*) = 0, count(*) FROM gold g WHERE NOT EXISTS (
      SELECT 1 FROM gold p WHERE p.symbol = g.symbol AND p.window_start = g.window_start)""")
def _dq_relationships(spark, sf_dir):
    staged = marts.stg_ohlc(candles(spark, sf_dir))
    bought = profiles(spark, sf_dir).filter("buy_count > 0")
    keys = ["symbol", "trade_date"]
    first = quality.Suite("summary", ((quality.RELATIONSHIP, {"columns": keys, "parent": staged.filter("symbol <> 'CLICK'")}),)).results(summary(spark, sf_dir))
    second = quality.Suite("windows", (
        ("expect_nothing", {}),
        (quality.RELATIONSHIP, {"columns": ["symbol", "window_start"], "parent": bought}),
        (quality.RELATIONSHIP, {"columns": ["symbol", "window_start"], "parent": profiles(spark, sf_dir)}),
    )).results(staged).filter("position > 0")
    return first.unionByName(second).select("position", "column", "success", "unexpected_count")


# The candles with bad windows, where every invariant is broken, and those as they are, so that both outcomes occur.
@query("dq_ohlc_invariants", f"WITH {_BAD_GOLD} " + " UNION ALL ".join(
    f"SELECT {i} AS position, '{condition}' AS \"column\", {_count_if(f'NOT ({condition})')} = 0 AS success, "
    f"{_count_if(f'NOT ({condition})')} AS unexpected_count FROM {source}"
    for i, (source, condition) in enumerate(product(("bad", "gold"), quality.OHLC_INVARIANTS))
))
def _dq_ohlc_invariants(spark, sf_dir):
    suite = quality.OHLC_INVARIANTS_SUITE
    sound = suite.results(candles(spark, sf_dir)).withColumn("position", F.col("position") + len(quality.OHLC_INVARIANTS))
    results = suite.results(_bad_candles(spark, sf_dir)).unionByName(sound)
    return results.select("position", "column", "success", "unexpected_count")


# Prices are rounded to the places they are stored with, as one less or more than a double need not be the nearest one.
_CANDLE = ", ".join(f"round({name}, 8) AS {name}" if name.endswith("_price") else name for name in sql.OHLC.split(", "))


# The candles behind the counts above, whole, once for each invariant they break. A table of their own: they grow with the input.
@query("dq_ohlc_invariant_rows", f"WITH {_BAD_GOLD} " + " UNION ALL ".join(
    f"SELECT {i} AS position, '{condition}' AS \"column\", {_CANDLE} FROM {source} WHERE ({condition}) IS NOT TRUE"
    for i, (source, condition) in enumerate(product(("bad", "gold"), quality.OHLC_INVARIANTS))
))
def _dq_ohlc_invariant_rows(spark, sf_dir):
    bad, sound = [
        quality.OHLC_INVARIANTS_SUITE.failing_rows(table).select("position", "column", "row.*")
        for table in (_bad_candles(spark, sf_dir), candles(spark, sf_dir))
    ]
    sound = sound.withColumn("position", F.col("position") + len(quality.OHLC_INVARIANTS))
    return shown(bad.unionByName(sound), open_price=8, high_price=8, low_price=8, close_price=8)


@query("dq_freshness", f"""
    WITH {sql.TRADES}, lag AS (SELECT epoch_us({sql.CLOCK}) - epoch_us(max(event_time)) AS us FROM trades)
    SELECT us / 1e6 <= 120 AS success, round(us / 1e6, 6) AS lag_seconds FROM lag""")
def _dq_freshness(spark, sf_dir):
    table = with_partition_date(trades(events(spark, sf_dir)))
    results = quality.strict_silver_suite(as_of=AS_OF).results(table)
    return shown(results.filter(F.col("expectation") == quality.FRESH).select("success", "lag_seconds"), lag_seconds=6)


@query("dq_partition_date", f"""
    WITH {sql.TRADES}, dated AS (
      SELECT *, CASE WHEN event_id % 100 = 0 THEN '2024-01-01' ELSE strftime(event_time, '%Y-%m-%d') END
        AS partition_date FROM trades)
    SELECT 0 AS position, {_count_if("quantity <= 0")} AS unexpected_count FROM dated
    UNION ALL SELECT 1, {_count_if("partition_date <> strftime(event_time, '%Y-%m-%d')")} FROM dated""")
def _dq_partition_date(spark, sf_dir):
    # Every hundredth row is filed under the first day.
    table = with_partition_date(trades(events(spark, sf_dir)))
    misfiled = F.when(F.col("trade_id").cast("bigint") % 100 == 0, "2024-01-01").otherwise(F.col("partition_date"))
    suite = quality.strict_silver_suite(as_of=AS_OF)
    results = suite.results(table.withColumn("partition_date", misfiled))
    return results.filter(F.col("expectation") == quality.CONDITION).select("position", "unexpected_count")


def _activity(spark, sf_dir, interval="1 hour"):
    return metrics.message_activity(triage(topic_rows(events(spark, sf_dir)), AS_OF), interval)


def _bucket(column: str, seconds: int = 3600) -> str:
    return f"time_bucket(INTERVAL {seconds} SECOND, {column})"


def _lag_sql(seconds: int = 3600) -> str:
    return f"""lag AS (
  SELECT {_bucket('sent', seconds)} AS window_start, 'raw.trades' AS topic,
         (epoch_us(max(sent)) - epoch_us(max(CASE WHEN readable THEN event_time END))) / 1e6 AS lag_seconds
  FROM triaged GROUP BY 1)"""


def _letters_sql(seconds: int = 3600) -> str:
    return f"""letters AS (
  SELECT {_bucket('sent', seconds)} AS window_start, failure_reason AS reason, count(*) AS events
  FROM triaged WHERE failure_reason IS NOT NULL GROUP BY 1, 2)"""


_LAG, _LETTERS = _lag_sql(), _letters_sql()


@query("metric_events_by_stage", f"""
    WITH {sql.TRIAGED}, counts AS (
      SELECT {_bucket('sent')} AS window_start, count(*) AS raw, {_count_if("readable")} AS bronze,
             {_count_if("failure_reason IS NULL")} AS silver, {_count_if("failure_reason IS NOT NULL")} AS dead_letter
      FROM triaged GROUP BY 1)
    """ + " UNION ALL ".join(
    f"SELECT window_start, '{stage}' AS stage, {stage} AS events FROM counts"
    for stage in ("raw", "bronze", "silver", "dead_letter")
))
def _metric_events_by_stage(spark, sf_dir):
    return shown(metrics.events_by_stage(_activity(spark, sf_dir)))


@query("metric_dlq_by_reason", f"WITH {sql.TRIAGED}, {_LETTERS} SELECT * FROM letters")
def _metric_dlq_by_reason(spark, sf_dir):
    return shown(metrics.dead_letters_by_reason(_activity(spark, sf_dir)))


@query("metric_lag", f"WITH {sql.TRIAGED}, {_LAG} SELECT window_start, topic, round(lag_seconds, 6) AS lag_seconds FROM lag")
def _metric_lag(spark, sf_dir):
    return shown(metrics.consumer_lag(_activity(spark, sf_dir)), lag_seconds=6)


@query("metric_ingest", f"""
    WITH {sql.TRADES} SELECT {_bucket('ingest_time', 60)} AS window_start, symbol, exchange, count(*) AS events
    FROM trades GROUP BY 1, 2, 3""")
def _metric_ingest(spark, sf_dir):
    return shown(metrics.ingested(trades(events(spark, sf_dir))))


def _breaches_sql(seconds: int, lag_warning: int, lag_critical: int, letters: int, letter_limit: float) -> str:
    """Rules of so many intervals each that fire in intervals of so many seconds."""
    return f"""
    WITH {sql.TRIAGED}, {_lag_sql(seconds)}, {_letters_sql(seconds)}, readings AS (
      SELECT window_start, 'ConsumerLagHigh' AS alert, 'warning' AS severity, topic AS label, lag_seconds AS value,
             120.0 AS lim, {lag_warning} AS intervals FROM lag
      UNION ALL SELECT window_start, 'ConsumerLagCritical', 'critical', topic, lag_seconds, 300.0, {lag_critical} FROM lag
      UNION ALL SELECT window_start, 'DeadLetterRateHigh', 'warning', 'all', CAST(sum(events) AS DOUBLE), {letter_limit}, {letters}
                FROM letters GROUP BY window_start),
    over_limit AS (SELECT * FROM readings WHERE value > lim)
    SELECT a.window_start, a.alert, a.severity, a.label, round(a.value, 6) AS value
    FROM over_limit a
    JOIN over_limit b ON b.alert = a.alert AND b.label = a.label
      AND b.window_start > a.window_start - to_seconds(a.intervals * {seconds}) AND b.window_start <= a.window_start
    GROUP BY a.window_start, a.alert, a.severity, a.label, a.value, a.intervals HAVING count(*) = a.intervals"""


def _fired(spark, sf_dir, interval: str, **limits):
    # The rules read the stored metric table, not the messages once per rule.
    path = working_path(spark, "activity")
    _activity(spark, sf_dir, interval).write.parquet(path)
    activity = spark.read.parquet(path)
    fired = metrics.breaches(metrics.consumer_lag(activity), metrics.dead_letters_by_reason(activity), interval, **limits)
    return shown(fired, value=6)


@query("metric_breaches", _breaches_sql(3600, 1, 1, 1, 1.0))
def _metric_breaches(spark, sf_dir):
    return _fired(spark, sf_dir, "1 hour", dead_letters_per_minute=1 / 60)


@query("metric_breaches_by_minute", _breaches_sql(60, 2, 5, 5, 10.0))
def _metric_breaches_by_minute(spark, sf_dir):
    """The rules at their own interval and limits: each has to be broken for several minutes on end."""
    return _fired(spark, sf_dir, "1 minute")


@query("metric_duplicates", f"""
    WITH {REPEATED}, ranked AS (
      SELECT ingest_time, row_number() OVER (PARTITION BY trade_id ORDER BY ingest_time DESC) AS n FROM repeated)
    SELECT {_bucket('ingest_time')} AS window_start, count(*) AS duplicates FROM ranked WHERE n > 1 GROUP BY 1""")
def _metric_duplicates(spark, sf_dir):
    return shown(metrics.duplicates_dropped(repeated_trades(events(spark, sf_dir)), "1 hour"))


@query("dead_letter_messages", f"""
    WITH {sql.TRIAGED}
    SELECT trade_id, CASE WHEN slot = 1 THEN ' ' || lower(upper(ltrim(symbol))) ELSE symbol END AS message_key,
           'dead-letter.trades' AS topic, failure_reason, CASE failure_reason WHEN 'schema_validation_error' THEN contract
           WHEN 'business_rule_violation' THEN 'event_time_not_in_future' ELSE '' END AS failed_rules
    FROM triaged WHERE failure_reason IN ('schema_validation_error', 'business_rule_violation')""")
def _dead_letter_messages(spark, sf_dir):
    letters = dead_letters(triage(topic_rows(events(spark, sf_dir)), AS_OF)).filter(
        F.col("failure_reason").isin("schema_validation_error", "business_rule_violation"))
    messages = dead_letter_messages(letters, DEAD_LETTER_TOPIC)
    return messages.select(
        F.get_json_object(F.col("value").cast("string"), "$.payload.tradeId").alias("trade_id"),
        F.col("key").cast("string").alias("message_key"), "topic",
        *[F.col("headers")[i]["value"].cast("string").alias(name) for i, name in enumerate(("failure_reason", "failed_rules"))])


@query("late_events", f"""
    WITH {sql.DELAYED}, batched AS (SELECT *, epoch_us(ingest_time) // 30000000 AS batch FROM delayed),
    newest AS (SELECT batch, max(event_time) AS newest FROM batched GROUP BY batch),
    marks AS (SELECT batch, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                - INTERVAL 60 SECOND AS watermark FROM newest)
    SELECT symbol, count(*) AS late_events FROM batched JOIN marks USING (batch)
    WHERE event_time < watermark GROUP BY symbol""")
def _late_events(spark, sf_dir):
    return metrics.late_events(delayed_trades(events(spark, sf_dir)))
