"""SQL fragments shared by the equivalents: the adapters of ``tables`` and the layers over them."""

from __future__ import annotations

from marketspark.workload.tables import AS_OF

CLOCK = f"TIMESTAMP '{AS_OF}'"
LATEST = f"({CLOCK} + INTERVAL 5 SECOND)"


def uuid_text(text: str) -> str:
    digest = f"md5({text})"
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr({digest}, {start}, {length})" for start, length in cuts)


TRADES = """trades AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS trade_id, 'sim' AS exchange, upper(event_type) AS symbol,
         CAST(value AS DECIMAL(18,8)) AS price,
         CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DECIMAL(18,8)) AS quantity,
         CASE WHEN user_id % 20 = 0 THEN 'HOLD' WHEN user_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side,
         ts AS event_time, ts + to_seconds(event_id % 7) AS ingest_time, '1' AS schema_version
  FROM events)"""

HOLDS = f"(price > 0 AND quantity > 0 AND side IN ('BUY', 'SELL') AND event_time <= {LATEST})"

VALID = f"{TRADES}, valid AS (SELECT * FROM trades WHERE {HOLDS})"

TRADE_COLUMNS = (
    "trade_id, exchange, symbol, CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity, side, "
    "event_time, ingest_time, schema_version"
)


# Decimals as whole units of their eighth place, so that quotients round exactly as decimals do.
_UNITS = "CAST(CAST({} AS DECIMAL(38,8)) * 100000000 AS HUGEINT)"


def windows(name: str, source: str, seconds: int, label: str) -> str:
    """All gold measures per window, as doubles."""
    return f"""{name} AS (
  SELECT symbol, window_start, window_start + INTERVAL {seconds} SECOND AS window_end,
         '{label}' AS window_duration,
         CAST(first(price ORDER BY event_time, ingest_time, trade_id) AS DOUBLE) AS open_price,
         CAST(max(price) AS DOUBLE) AS high_price, CAST(min(price) AS DOUBLE) AS low_price,
         CAST(last(price ORDER BY event_time, ingest_time, trade_id) AS DOUBLE) AS close_price,
         CAST(sum(quantity) AS DOUBLE) AS volume, count(trade_id) AS trade_count,
         CAST(sum(quantity) AS DOUBLE) AS total_volume,
         CAST(sum(CASE WHEN side = 'BUY' THEN quantity ELSE 0 END) AS DOUBLE) AS buy_volume,
         CAST(sum(CASE WHEN side = 'SELL' THEN quantity ELSE 0 END) AS DOUBLE) AS sell_volume,
         count(CASE WHEN side = 'BUY' THEN 1 END) AS buy_count,
         count(CASE WHEN side = 'SELL' THEN 1 END) AS sell_count,
         CAST((2 * sum({_UNITS.format("price")} * {_UNITS.format("quantity")}) + sum({_UNITS.format("quantity")}))
           // (2 * sum({_UNITS.format("quantity")})) AS DOUBLE) / 1e8 AS vwap,
         avg(CAST(quantity AS DOUBLE)) AS avg_trade_size, CAST(max(quantity) AS DOUBLE) AS max_trade_size,
         count(trade_id) / CAST({seconds} AS DOUBLE) AS trades_per_second
  FROM (SELECT *, time_bucket(INTERVAL {seconds} SECOND, event_time) AS window_start FROM {source})
  GROUP BY symbol, window_start)"""


OHLC = "symbol, open_price, high_price, low_price, close_price, volume, trade_count, window_start, window_end, window_duration"
PROFILE = (
    "symbol, total_volume, buy_volume, sell_volume, buy_count, sell_count, vwap, "
    "window_start, window_end, window_duration"
)
STATS = (
    "symbol, trade_count, round(avg_trade_size, 6) AS avg_trade_size, max_trade_size, "
    "round(trades_per_second, 9) AS trades_per_second, window_start, window_end, window_duration"
)

GOLD = f"{VALID}, {windows('gold', 'valid', 60, '1 minute')}"

MARTS = f"""{GOLD}, daily AS (
  SELECT symbol, date_trunc('day', window_start) AS trade_date, min(window_start) AS first_window,
         max(window_end) AS last_window, first(open_price ORDER BY window_start) AS open_price,
         max(high_price) AS high_price, min(low_price) AS low_price,
         last(close_price ORDER BY window_start) AS close_price,
         sum(volume) AS volume, CAST(sum(trade_count) AS BIGINT) AS trade_count
  FROM gold GROUP BY 1, 2),
metrics AS (
  SELECT symbol, date_trunc('day', window_start) AS trade_date, sum(total_volume) AS total_volume,
         sum(buy_volume) AS buy_volume, sum(sell_volume) AS sell_volume,
         CAST(sum(buy_count) AS BIGINT) AS buy_count, CAST(sum(sell_count) AS BIGINT) AS sell_count,
         CAST((20000 * sum(CAST(round(vwap * 1e8) AS HUGEINT)) + count(vwap)) // (2 * count(vwap)) AS DOUBLE) / 1e12
           AS avg_vwap, sum(buy_volume) / nullif(sum(total_volume), 0) AS buy_ratio
  FROM gold GROUP BY 1, 2),
summary AS (
  SELECT coalesce(o.symbol, s.symbol) AS symbol, coalesce(o.trade_date, s.trade_date) AS trade_date,
         o.open_price, o.high_price, o.low_price, o.close_price, o.volume, o.trade_count,
         s.buy_volume, s.sell_volume, s.buy_count, s.sell_count, s.avg_vwap, s.buy_ratio
  FROM daily o FULL OUTER JOIN metrics s ON o.symbol = s.symbol AND o.trade_date = s.trade_date)"""

SUMMARY = (
    "symbol, trade_date, open_price, high_price, low_price, close_price, volume, trade_count, buy_volume, "
    "sell_volume, buy_count, sell_count, avg_vwap, buy_ratio"
)

_WIRE = f"""{TRADES}, wire AS (
  SELECT event_id, event_id % 50 AS slot, {uuid_text("CAST(event_id AS VARCHAR)")} AS trade_id, exchange,
         CASE WHEN event_id % 50 = 1 THEN ' ' || lower(symbol) ELSE symbol END AS symbol,
         CASE event_id % 50 WHEN 2 THEN -price WHEN 3 THEN NULL ELSE price END AS price, quantity, side,
         CASE event_id % 50 WHEN 6 THEN event_time + to_seconds(1000000000) ELSE event_time END AS event_time,
         ingest_time, CASE WHEN event_id % 50 = 7 THEN '99' ELSE '1' END AS schema_version,
         event_time + to_seconds(event_id * 37 % 400) AS sent,
         event_id % 50 NOT IN (0, 4, 5) AS readable
  FROM trades)"""

# The text of slot 8 has one more decimal, so that even a zero price is above zero there.
NOT_POSITIVE = "(price IS NULL OR price < 0 OR price = 0 AND slot <> 8)"

TRIAGED = f"""{_WIRE}, ruled AS (
  SELECT *, concat_ws(',',
         CASE WHEN slot IN (3, 8) THEN 'price_decimal' END, CASE WHEN {NOT_POSITIVE} THEN 'price_positive' END,
         CASE WHEN quantity <= 0 THEN 'quantity_positive' END,
         CASE WHEN side NOT IN ('BUY', 'SELL') THEN 'side_known' END) AS contract
  FROM wire),
triaged AS (
  SELECT *, CASE WHEN NOT readable THEN 'deserialization_error'
                 WHEN slot = 7 THEN 'unknown_schema_version'
                 WHEN contract <> '' THEN 'schema_validation_error'
                 WHEN event_time > {LATEST} THEN 'business_rule_violation' END AS failure_reason
  FROM ruled)"""

DELAYED = f"""{TRADES}, delayed AS (
  SELECT trade_id, exchange, symbol, price, quantity, side, event_time, schema_version,
         CASE WHEN event_id % 11 = 0 THEN ingest_time + INTERVAL 1 HOUR ELSE ingest_time END AS ingest_time
  FROM trades)"""


def closed_windows(source: str) -> str:
    """Condition on ``window_end``: the windows an append stream has emitted when its one batch is done."""
    return f"window_end <= (SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 60 SECOND FROM {source})"
