"""Queries over messages, bronze and silver."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketspark.operators.codec import decode_events, parse_feed, read_feed, validate_contract
from marketspark.operators.silver import (
    accepted,
    anti_join_invalid,
    bronze_rows,
    dead_letters,
    deduplicate_by_trade_id,
    duplicate_count,
    enrich_with_processing_metadata,
    filter_invalid_events,
    flag_business_rules,
    invalid_count,
    normalize_fields,
    split_by_version,
    triage,
    validate_business_rules,
)
from marketspark.plans.rebuild import rebuild_silver
from marketspark.schemas import TRADE, camel_case
from marketspark.session import working_path
from marketspark.sinks.compaction import compact, file_counts
from marketspark.sinks.writers import StorageWriter
from marketspark.sources.tables import Layout, read_bronze, read_silver
from marketspark.workload import sql
from marketspark.workload.registry import query
from marketspark.workload.tables import (
    AS_OF,
    events,
    feed_messages,
    line_item_trades,
    messy_trades,
    repeated_trades,
    shown,
    topic_messages,
    topic_rows,
    trades,
    wire_trades,
)

REPEATED = f"""{sql.TRADES}, repeated AS (
  SELECT trade_id, exchange, symbol, price, CAST(quantity + copy AS DECIMAL(18,8)) AS quantity, side, event_time,
         ingest_time + to_seconds(copy * 3) AS ingest_time, schema_version
  FROM trades JOIN (VALUES (0), (1)) c(copy) ON copy = 0 OR event_id % 5 = 0)"""

_MESSY = f"""{sql.TRADES}, messy AS (
  SELECT trade_id, ' Sim ' AS exchange,
         CASE WHEN event_id % 3 = 0 THEN '  ' || lower(symbol) || '  ' ELSE symbol END AS symbol,
         price, quantity, CASE WHEN event_id % 4 = 0 THEN lower(side) || '  ' ELSE side END AS side,
         event_time, ingest_time, schema_version
  FROM trades)"""


@query("decode_events", f"WITH {sql.TRIAGED} SELECT {sql.TRADE_COLUMNS} FROM triaged WHERE readable")
def _decode_events(spark, sf_dir):
    return shown(decode_events(topic_rows(events(spark, sf_dir))))


@query("parse_feed", f"""
    WITH {sql.TRADES}, feed AS (
      SELECT event_id, event_id % 40 AS slot, CASE WHEN event_id % 40 = 2 THEN 'UNKNOWN' ELSE symbol END AS symbol,
             price, quantity, CASE WHEN slot <> 3 AND user_is_even THEN 'BUY' ELSE 'SELL' END AS side,
             date_trunc('milliseconds', event_time) AS event_time
      FROM (SELECT t.*, e.user_id % 2 = 0 AS user_is_even, t.event_id % 40 AS slot
            FROM trades t JOIN events e ON t.event_id = e.event_id))
    SELECT {sql.uuid_text("'binance|' || symbol || '|' || CAST(event_id AS VARCHAR)")} AS trade_id,
           'binance' AS exchange, symbol, CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity,
           side, event_time, {sql.CLOCK} AS ingest_time, '1' AS schema_version
    FROM feed WHERE slot NOT IN (0, 1, 4, 5, 6, 7) AND price > 0 AND quantity > 0""")
def _parse_feed(spark, sf_dir):
    messages = feed_messages(events(spark, sf_dir))
    return shown(parse_feed(messages, id_mode="exchange", ingest_time=F.lit(AS_OF).cast("timestamp")))


@query("feed_errors", f"""
    WITH {sql.TRADES}, feed AS (
      SELECT event_id, event_id % 40 AS slot, CASE WHEN event_id % 40 = 1 THEN 0 ELSE price END AS price, quantity FROM trades),
    ruled AS (
      SELECT event_id, slot, CASE WHEN slot BETWEEN 4 AND 7 THEN 'json_object' ELSE concat_ws(',',
        CASE WHEN price <= 0 THEN 'price_positive' END, CASE WHEN quantity <= 0 THEN 'quantity_positive' END) END AS failed_rules
      FROM feed WHERE slot <> 0)
    SELECT event_id, failed_rules FROM ruled WHERE failed_rules <> ''""")
def _feed_errors(spark, sf_dir):
    refused = read_feed(feed_messages(events(spark, sf_dir)), id_mode="exchange").filter(F.size("failed_rules") > 0)
    return refused.select("event_id", F.concat_ws(",", "failed_rules").alias("failed_rules"))


@query("feed_outcomes", f"""
    WITH {sql.TRADES}, feed AS (SELECT event_id % 40 AS slot, price, quantity FROM trades)
    SELECT count(*) AS messages, count(CASE WHEN slot = 0 THEN 1 END) AS replies,
           count(CASE WHEN slot IN (1, 4, 5, 6, 7) OR slot <> 0 AND (price <= 0 OR quantity <= 0) THEN 1 END) AS errors,
           count(CASE WHEN slot NOT IN (0, 1, 4, 5, 6, 7) AND price > 0 AND quantity > 0 THEN 1 END) AS trades FROM feed""")
def _feed_outcomes(spark, sf_dir):
    # Nothing may vanish: messages are replies, errors or trades.
    messages = feed_messages(events(spark, sf_dir))
    wrong = (F.size("failed_rules") > 0).cast("int")
    judged = read_feed(messages, id_mode="exchange").select(
        F.lit(0).alias("messages"), F.lit(-1).alias("replies"), wrong.alias("errors"), (1 - wrong).alias("trades"))
    sent = messages.select(F.lit(1).alias("messages"), F.lit(1).alias("replies"), F.lit(0).alias("errors"), F.lit(0).alias("trades"))
    return sent.unionByName(judged).agg(*[F.sum(name).alias(name) for name in sent.columns])


_JSON_TIME = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'"


@query("encode_envelope", f"""
    WITH {sql.TRADES}, message AS (
      SELECT *, {sql.uuid_text("CAST(event_id AS VARCHAR)")} AS id FROM trades)
    SELECT symbol AS message_key, 'raw.trades' AS topic,
           '{{"eventId":"' || {sql.uuid_text("'e|' || id")} || '","eventType":"trade","payload":{{"tradeId":"' || id
           || '","exchange":"sim","symbol":"' || symbol || '","price":"' || CAST(price AS VARCHAR)
           || '","quantity":"' || CAST(quantity AS VARCHAR) || '","side":"' || side
           || '","eventTime":"' || {_JSON_TIME.format("event_time")}
           || '","ingestTime":"' || {_JSON_TIME.format("ingest_time")}
           || '","schemaVersion":1}},"timestamp":"' || {_JSON_TIME.format(sql.CLOCK)}
           || '","source":"sim","partitionKey":"' || symbol || '"}}' AS message
    FROM message""")
def _encode_envelope(spark, sf_dir):
    messages = topic_messages(events(spark, sf_dir))
    return messages.select(
        F.col("key").cast("string").alias("message_key"), "topic", F.col("value").cast("string").alias("message")
    )


@query("envelope_roundtrip", f"""
    WITH {sql.TRADES} SELECT {sql.uuid_text("trades.trade_id")} AS trade_id,
           {sql.TRADE_COLUMNS.removeprefix("trade_id, ")} FROM trades""")
def _envelope_roundtrip(spark, sf_dir):
    return shown(decode_events(topic_messages(events(spark, sf_dir))))


@query("validate_contract", f"""
    WITH {sql.TRIAGED}
    SELECT trade_id, upper(trim(symbol)) AS symbol,
           CASE WHEN slot = 4 THEN NULL ELSE CAST(price AS DOUBLE) END AS price, side,
           CASE WHEN slot <> 5 THEN event_time END AS event_time,
           concat_ws(',', CASE WHEN slot IN (3, 4, 8) THEN 'price_decimal' END,
             CASE WHEN slot = 4 OR {sql.NOT_POSITIVE} THEN 'price_positive' END,
             CASE WHEN quantity <= 0 THEN 'quantity_positive' END,
             CASE WHEN side NOT IN ('BUY', 'SELL') THEN 'side_known' END,
             CASE WHEN slot = 5 THEN 'event_time_timestamp' END) AS failed_rules
    FROM triaged""")
def _validate_contract(spark, sf_dir):
    wire = wire_trades(events(spark, sf_dir))
    even = F.col("event_id") % 2 == 0
    # Half of the messages carry wire names, the others column names.
    names = TRADE.fieldNames()
    snake = F.to_json(F.struct(*names))
    camel = F.to_json(F.struct(*[F.col(n).alias(camel_case(n)) for n in names]))
    checked = validate_contract(wire.select(F.when(even, camel).otherwise(snake).alias("value")))
    return shown(checked.select(
        "trade_id", "symbol", "price", "side", "event_time", F.concat_ws(",", "failed_rules").alias("failed_rules")
    ))


@query("schema_version_split", f"""
    WITH {sql.TRIAGED}
    SELECT schema_version, CASE WHEN slot = 7 THEN 'unknown_schema_version' END AS failure_reason,
           count(*) AS rows
    FROM triaged WHERE readable GROUP BY 1, 2""")
def _schema_version_split(spark, sf_dir):
    known, unknown = split_by_version(decode_events(topic_rows(events(spark, sf_dir))))
    sides = known.withColumn("failure_reason", F.lit(None).cast("string")).unionByName(unknown)
    return sides.groupBy("schema_version", "failure_reason").agg(F.count(F.lit(1)).alias("rows"))


@query("normalize_fields", f"""
    WITH {_MESSY} SELECT trade_id, lower(trim(exchange)) AS exchange, upper(trim(symbol)) AS symbol,
           CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity, upper(trim(side)) AS side,
           event_time, ingest_time, schema_version
    FROM messy""")
def _normalize_fields(spark, sf_dir):
    return shown(normalize_fields(messy_trades(events(spark, sf_dir))))


@query("valid_trades", f"WITH {sql.VALID} SELECT {sql.TRADE_COLUMNS} FROM valid")
def _valid_trades(spark, sf_dir):
    return shown(validate_business_rules(trades(events(spark, sf_dir)), AS_OF))


@query("invalid_trades", f"""
    WITH {sql.TRADES} SELECT {sql.TRADE_COLUMNS},
           concat_ws(',', CASE WHEN price <= 0 THEN 'price_positive' END,
             CASE WHEN quantity <= 0 THEN 'quantity_positive' END,
             CASE WHEN side NOT IN ('BUY', 'SELL') THEN 'side_known' END) AS failed_rules
    FROM trades WHERE NOT {sql.HOLDS}""")
def _invalid_trades(spark, sf_dir):
    _, invalid = filter_invalid_events(trades(events(spark, sf_dir)), AS_OF)
    flagged = flag_business_rules(invalid, AS_OF)
    return shown(flagged.withColumn("failed_rules", F.concat_ws(",", "failed_rules")))


@query("anti_join_invalid", f"""
    WITH {REPEATED}, marked AS (SELECT *, {sql.HOLDS} AS holds FROM repeated)
    SELECT {sql.TRADE_COLUMNS} FROM marked m
    WHERE NOT EXISTS (SELECT 1 FROM marked v WHERE v.holds AND v.trade_id = m.trade_id)""")
def _anti_join_invalid(spark, sf_dir):
    return shown(anti_join_invalid(repeated_trades(events(spark, sf_dir)), AS_OF))


@query("dead_letter_rows", f"""
    WITH {sql.TRIAGED}
    SELECT symbol AS message_key, 'raw.trades' AS topic, CAST(event_id % 3 AS INTEGER) AS "partition",
           event_id // 3 AS "offset", sent AS "timestamp", failure_reason,
           CASE failure_reason WHEN 'schema_validation_error' THEN contract
             WHEN 'business_rule_violation' THEN 'event_time_not_in_future' ELSE '' END AS failed_rules
    FROM triaged WHERE failure_reason IS NOT NULL""")
def _dead_letter_rows(spark, sf_dir):
    letters = dead_letters(triage(topic_rows(events(spark, sf_dir)), AS_OF))
    return shown(letters.select(
        F.col("key").cast("string").alias("message_key"), "topic", "partition", "offset", "timestamp",
        "failure_reason", F.concat_ws(",", "failed_rules").alias("failed_rules"),
    ))


@query("enrich_trades", f"""
    WITH {sql.VALID} SELECT {sql.TRADE_COLUMNS}, '0.1.0' AS pipeline_version,
           strftime(event_time, '%Y-%m-%d') AS partition_date FROM valid""")
def _enrich_trades(spark, sf_dir):
    valid = validate_business_rules(trades(events(spark, sf_dir)), AS_OF)
    return shown(enrich_with_processing_metadata(valid).drop("processing_timestamp"))


@query("dedup_trades", """
    SELECT trade_id, ingest_time, part_key, supplier_key, quantity, price FROM (
      SELECT l_orderkey || '-' || l_linenumber AS trade_id, l_shipdate AS ingest_time, l_partkey AS part_key,
             l_suppkey AS supplier_key, l_quantity AS quantity, l_extendedprice AS price,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS n
      FROM lineitem) WHERE n = 1""")
def _dedup_trades(spark, sf_dir):
    return shown(deduplicate_by_trade_id(line_item_trades(spark, sf_dir)))


@query("count_invalid", f"WITH {sql.TRADES} SELECT count(*) AS invalid_count FROM trades WHERE NOT {sql.HOLDS}")
def _count_invalid(spark, sf_dir):
    return invalid_count(filter_invalid_events(trades(events(spark, sf_dir)), AS_OF)[1])


@query("count_duplicates", """
    SELECT count(*) - count(DISTINCT l_orderkey || '-' || l_linenumber) AS duplicates_dropped FROM lineitem""")
def _count_duplicates(spark, sf_dir):
    return duplicate_count(line_item_trades(spark, sf_dir))


@query("read_bronze", f"""
    WITH {sql.TRADES} SELECT {sql.TRADE_COLUMNS}, strftime(event_time, '%Y-%m-%d') AS partition_date FROM trades""")
def _read_bronze(spark, sf_dir):
    root = Layout(working_path(spark, "bronze"))
    StorageWriter(spark, root.checkpoints).write_bronze(trades(events(spark, sf_dir)), root.bronze)
    return _dated(shown(read_bronze(spark, root.bronze)))


def _dated(df):
    return df.withColumn("partition_date", F.date_format("partition_date", "yyyy-MM-dd"))


@query("read_silver", f"""
    WITH {REPEATED}, latest AS (
      SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY ingest_time DESC, event_time DESC) AS n
      FROM repeated WHERE {sql.HOLDS})
    SELECT {sql.TRADE_COLUMNS}, '0.1.0' AS pipeline_version, strftime(event_time, '%Y-%m-%d') AS partition_date
    FROM latest WHERE n = 1""")
def _read_silver(spark, sf_dir):
    root = Layout(working_path(spark, "silver"))
    rebuild_silver(spark, repeated_trades(events(spark, sf_dir)), root, AS_OF)
    return _dated(shown(read_silver(spark, root.silver).drop("processing_timestamp")))


@query("rebuild_equals_stream", f"""
    WITH {sql.TRIAGED} SELECT count(*) AS both, 0 AS stream_only, 0 AS rebuild_only
    FROM triaged WHERE failure_reason IS NULL""")
def _rebuild_equals_stream(spark, sf_dir):
    # One set of messages, once through the stages of the stream and once through stored bronze.
    messages = topic_rows(events(spark, sf_dir))
    source, target = Layout(working_path(spark, "judged-from")), Layout(working_path(spark, "judged-to"))
    StorageWriter(spark, source.checkpoints).write_bronze(bronze_rows(messages), source.bronze)
    rebuilt = rebuild_silver(spark, read_bronze(spark, source.bronze), target, AS_OF)
    names = TRADE.fieldNames()
    streamed = deduplicate_by_trade_id(validate_business_rules(normalize_fields(accepted(triage(messages, AS_OF))), AS_OF))
    sides = streamed.select(*names, F.lit(1).alias("side_bit")).unionByName(rebuilt.select(*names, F.lit(2).alias("side_bit")))
    rows = sides.groupBy(*names).agg(F.bit_or("side_bit").alias("found"))
    return rows.agg(
        F.count_if(F.col("found") == 3).alias("both"), F.count_if(F.col("found") == 1).alias("stream_only"),
        F.count_if(F.col("found") == 2).alias("rebuild_only"))


@query("rebuild_rejects", f"""
    WITH {sql.TRIAGED} SELECT failure_reason, count(*) AS refused FROM triaged
    WHERE readable AND failure_reason IS NOT NULL GROUP BY 1""")
def _rebuild_rejects(spark, sf_dir):
    source, target = Layout(working_path(spark, "rejects-from")), Layout(working_path(spark, "rejects-to"))
    StorageWriter(spark, source.checkpoints).write_bronze(bronze_rows(topic_rows(events(spark, sf_dir))), source.bronze)
    rebuild_silver(spark, read_bronze(spark, source.bronze), target, AS_OF)
    return spark.read.parquet(target.rejects).groupBy("failure_reason").agg(F.count(F.lit(1)).alias("refused"))


@query("compact_bronze", f"""
    WITH {sql.TRADES}
    SELECT strftime(event_time, '%Y-%m-%d') AS partition_date, count(*) AS rows,
           greatest(1, CAST(floor(count(*) * 500 / (0.05 * 1024 * 1024)) AS BIGINT)) AS files
    FROM trades GROUP BY 1""")
def _compact_bronze(spark, sf_dir):
    root = Layout(working_path(spark, "compaction-run"))
    StorageWriter(spark, root.checkpoints).write_bronze(trades(events(spark, sf_dir)), root.bronze)
    # A target of some kilobytes, so that a day has several files to fill.
    compact(spark, root.bronze, root.compacted, target_file_size_mb=0.05)
    return _dated(file_counts(spark.read.parquet(root.compacted)))
