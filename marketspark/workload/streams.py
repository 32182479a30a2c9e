"""Streaming queries: the events table as micro-batches, the sink read back.

Candles, deduplication and late events take the table in slices of rising time, one for each micro-batch, so that
state is kept, restored and evicted on the way; the others take it as one.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.operators.codec import decode_events
from marketspark.operators.gold import AGGREGATES, apply_watermark
from marketspark.operators.silver import deduplicate_stream, deduplicate_stream_by_id, validate_business_rules
from marketspark.schemas import GOLD, TRADE
from marketspark.session import working_path
from marketspark.sinks.writers import STATE_STORE, StorageWriter
from marketspark.sources.tables import Layout
from marketspark.sources.topics import replay_files
from marketspark.streaming.jobs import TradeStreams
from marketspark.streaming.late import LateEvents
from marketspark.streaming.progress import StageCounters
from marketspark.workload import sql
from marketspark.workload.layers import REPEATED
from marketspark.workload.registry import query
from marketspark.workload.tables import (
    AS_OF,
    corrected_trades,
    delayed_trades,
    event_stream,
    events,
    repeated_trades,
    shown,
    topic_rows,
    trades,
)


def _finish(running, batches: int = 1) -> None:
    running.awaitTermination()
    if running.exception() is not None:
        raise running.exception()
    if running.lastProgress["batchId"] + 1 < batches:
        raise RuntimeError(f"the replay took {running.lastProgress['batchId'] + 1} micro-batches, not {batches}")


@query("stream_replay", f"WITH {sql.TRIAGED} SELECT {sql.TRADE_COLUMNS} FROM triaged WHERE readable")
def _stream_replay(spark, sf_dir):
    root = Layout(working_path(spark, "stream-replay"))
    stored = working_path(spark, "topic")
    topic_rows(events(spark, sf_dir)).write.parquet(stored)
    writer = StorageWriter(spark, root.checkpoints, available_now=True)
    _finish(writer.write_bronze(decode_events(replay_files(spark, stored)), root.bronze))
    return shown(spark.read.parquet(root.bronze).select(*TRADE.fieldNames()))


SLICES = 5


def _files_a_slice(spark) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")) // SLICES)


def _stored_slices(spark, table: DataFrame, at: str, salt: str) -> str:
    """``table`` in ``SLICES`` equal spans of ``at``, written at once by many tasks, a fixed number of files for each.

    A replay takes files by the time they were written; that time is set by the slice.
    """
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    first, last = table.agg(F.min(micros), F.max(micros)).first()
    nth = F.floor((micros - first) / ((last - first) // SLICES + 1))
    path = working_path(spark, "slices")
    parts = table.withColumns({"slice": nth, "part": F.pmod(F.xxhash64(salt), F.lit(_files_a_slice(spark)))})
    parts.repartition("slice", "part").write.partitionBy("slice", "part").parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/slice=*/part=*/*.parquet")
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files = list(store.globStatus(target))
    if len(files) != SLICES * _files_a_slice(spark):
        raise RuntimeError(f"{len(files)} files for {SLICES} slices")
    began = min(f.getModificationTime() for f in files)
    for f in files:
        nth_slice = int(re.search(r"/slice=(\d+)/", f.getPath().toString())[1])
        store.setTimes(f.getPath(), began + 1000 * nth_slice, -1)
    return path


def _replayed(spark, path: str, schema, slices: str = "*") -> DataFrame:
    """Stored slices as a stream, one slice to a micro-batch."""
    return replay_files(spark, f"{path}/slice={slices}/part=*", schema, max_files_per_trigger=_files_a_slice(spark))


def _event_slices(spark, sf_dir) -> DataFrame:
    """The events as a stream of ``SLICES`` micro-batches in order of time."""
    table = events(spark, sf_dir)
    return _replayed(spark, _stored_slices(spark, table, "ts", "event_id"), table.schema)


def _valid_stream(spark, sf_dir, source=event_stream) -> DataFrame:
    return apply_watermark(validate_business_rules(trades(source(spark, sf_dir)), AS_OF))


def _gold_stream(spark, sf_dir, dataset: str, source=event_stream) -> DataFrame:
    root = Layout(working_path(spark, f"stream-{dataset}"))
    windows = AGGREGATES[dataset](_valid_stream(spark, sf_dir, source))
    # State of one row per symbol and window: the session's own state store will do.
    store = spark.conf.get(STATE_STORE)
    writer = StorageWriter(spark, root.checkpoints, available_now=True, state_store=store)
    running = writer.write_gold(windows, dataset, root.gold("{dataset}"))
    _finish(running, SLICES if source is _event_slices else 1)
    return spark.read.parquet(root.gold(dataset)).select(*GOLD[dataset].fieldNames())


_CLOSED = sql.closed_windows("valid")


@query("stream_ohlc", f"WITH {sql.GOLD} SELECT {sql.OHLC} FROM gold WHERE {_CLOSED}")
def _stream_ohlc(spark, sf_dir):
    return shown(_gold_stream(spark, sf_dir, "ohlc", _event_slices))


@query("stream_volume_profile", f"WITH {sql.GOLD} SELECT {sql.PROFILE} FROM gold WHERE {_CLOSED}")
def _stream_volume_profile(spark, sf_dir):
    return shown(_gold_stream(spark, sf_dir, "volume_profiles"))


@query("stream_trade_stats", f"WITH {sql.GOLD} SELECT {sql.STATS} FROM gold WHERE {_CLOSED}")
def _stream_trade_stats(spark, sf_dir):
    return shown(_gold_stream(spark, sf_dir, "trade_stats"), avg_trade_size=6, trades_per_second=9)


@query("stream_dedup", f"""
    WITH {REPEATED}, ranked AS (
      SELECT *, row_number() OVER (PARTITION BY trade_id, event_time ORDER BY ingest_time DESC) AS n FROM repeated)
    SELECT {sql.TRADE_COLUMNS} FROM ranked WHERE n = 1
      AND event_time <= (SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 60 SECOND FROM repeated)""")
def _stream_dedup(spark, sf_dir):
    root = Layout(working_path(spark, "stream-dedup"))
    source = apply_watermark(repeated_trades(_event_slices(spark, sf_dir)))
    writer = StorageWriter(spark, root.checkpoints, available_now=True)
    _finish(writer.write_silver(deduplicate_stream(source), root.silver), SLICES)
    return shown(spark.read.parquet(root.silver).select(*TRADE.fieldNames()))


CORRECTED_AFTER_DAYS, DEDUP_HORIZON_DAYS = 7, 8


@query("stream_dedup_by_id", f"""
    WITH {sql.TRADES}, corrected AS (
      SELECT trade_id, exchange, symbol, price, CAST(quantity + copy AS DECIMAL(18,8)) AS quantity, side,
             event_time + to_days(copy * {CORRECTED_AFTER_DAYS}) AS event_time,
             ingest_time + to_days(copy * {CORRECTED_AFTER_DAYS}) AS ingest_time, schema_version
      FROM trades JOIN (VALUES (0), (1)) c(copy) ON copy = 0 OR event_id % 5 = 0),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY ingest_time DESC, event_time DESC) AS n,
             max(event_time) OVER (PARTITION BY trade_id) AS newest FROM corrected)
    SELECT {sql.TRADE_COLUMNS} FROM ranked WHERE n = 1
      AND newest + INTERVAL {DEDUP_HORIZON_DAYS} DAY
          <= (SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 60 SECOND FROM corrected)""")
def _stream_dedup_by_id(spark, sf_dir):
    """Corrections come batches after the trade, with another event time; the query stops and starts on the way."""
    root = Layout(working_path(spark, "stream-dedup-by-id"))
    table = corrected_trades(events(spark, sf_dir), CORRECTED_AFTER_DAYS)
    path = _stored_slices(spark, table, "ingest_time", "trade_id")
    writer = StorageWriter(spark, root.checkpoints, available_now=True)
    for slices, batches in ((f"[0-{SLICES // 2}]", SLICES // 2 + 1), ("*", SLICES)):
        source = apply_watermark(_replayed(spark, path, table.schema, slices))
        _finish(writer.write_silver(deduplicate_stream_by_id(source, DEDUP_HORIZON_DAYS * 86_400), root.silver), batches)
    return shown(spark.read.parquet(root.silver).select(*TRADE.fieldNames()))


DELAYED_DAYS = 3


@query("stream_late_events", f"""
    WITH {sql.DELAYED.replace('INTERVAL 1 HOUR', f'INTERVAL {DELAYED_DAYS} DAY')}, span AS (
      SELECT min(epoch_us(ingest_time)) AS low, max(epoch_us(ingest_time)) AS high FROM delayed),
    batched AS (
      SELECT symbol, epoch_us(event_time) AS stamp, CAST((epoch_us(ingest_time) - low) // ((high - low) // {SLICES} + 1) AS INT) AS batch
      FROM delayed, span),
    newest AS (SELECT batch, max(stamp) AS newest FROM batched GROUP BY batch),
    marks AS (SELECT batch, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                // 1000 * 1000 - 60000000 AS mark FROM newest)
    SELECT batch, symbol, count(*) AS events, count(CASE WHEN stamp < mark THEN 1 END) AS late_events
    FROM batched JOIN marks USING (batch) GROUP BY batch, symbol""")
def _stream_late_events(spark, sf_dir):
    root = Layout(working_path(spark, "stream-late"))
    table = delayed_trades(events(spark, sf_dir), DELAYED_DAYS * 86_400)
    stream = _replayed(spark, _stored_slices(spark, table, "ingest_time", "trade_id"), table.schema)
    _finish(LateEvents(spark, root, available_now=True).start(stream), SLICES)
    return spark.read.parquet(root.late_events).select("batch", "symbol", "events", "late_events")


def _decoding(spark, sf_dir, name: str) -> TradeStreams:
    stored = working_path(spark, "topic")
    topic_rows(events(spark, sf_dir)).write.parquet(stored)
    return TradeStreams(
        spark, replay_files(spark, stored), Layout(working_path(spark, name)), available_now=True, as_of=AS_OF, decode_once=True)


@query("stream_decode_once", f"""
    WITH {sql.TRIAGED}, rows AS (
      SELECT 'bronze' AS layer, trade_id, symbol, contract AS detail FROM triaged WHERE readable
      UNION ALL SELECT 'silver', trade_id, upper(trim(symbol)), 'BUY SELL' FROM triaged WHERE failure_reason IS NULL
        AND event_time <= (SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 60 SECOND FROM triaged
                           WHERE failure_reason IS NULL)
      UNION ALL SELECT 'dead_letter', NULL, NULL, failure_reason FROM triaged WHERE failure_reason IS NOT NULL)
    SELECT layer, trade_id, symbol, detail, count(*) AS n FROM rows GROUP BY ALL""")
def _stream_decode_once(spark, sf_dir):
    """Bronze, silver and dead letters from messages that one query decoded."""
    jobs = _decoding(spark, sf_dir, "stream-decode-once")
    for running in jobs.run():
        _finish(running)
    layers = [
        spark.read.parquet(jobs.layout.bronze).select(F.lit("bronze").alias("layer"), "trade_id", "symbol", F.col("contract_failures").alias("detail")),
        spark.read.parquet(jobs.layout.silver).select(F.lit("silver").alias("layer"), "trade_id", "symbol", F.lit("BUY SELL").alias("detail")),
        spark.read.parquet(jobs.layout.dead_letters).select(
            F.lit("dead_letter").alias("layer"), F.lit(None).cast("string").alias("trade_id"), F.lit(None).cast("string").alias("symbol"),
            F.col("failure_reason").alias("detail")),
    ]
    rows = layers[0].unionByName(layers[1]).unionByName(layers[2])
    return rows.groupBy("layer", "trade_id", "symbol", "detail").agg(F.count(F.lit(1)).alias("n"))


@query("stream_stage_counts", f"""
    WITH {sql.TRIAGED}
    SELECT unnest(['raw', 'bronze', 'silver', 'dead_letter']) AS measure,
           CAST(unnest([count(*), count(*) FILTER (readable), count(*) FILTER (failure_reason IS NULL), count(failure_reason)]) AS DOUBLE) AS value
    FROM triaged
    UNION ALL SELECT failure_reason, count(*) FROM triaged WHERE failure_reason IS NOT NULL GROUP BY 1
    UNION ALL SELECT 'lag_seconds', round((epoch_us(max(sent)) - epoch_us(max(event_time) FILTER (readable))) / 1e6, 6) FROM triaged""")
def _stream_stage_counts(spark, sf_dir):
    """The counts that the decoding query reported of itself, one row for each measure."""
    running = _decoding(spark, sf_dir, "stream-stage-counts").decoded()
    _finish(running)
    counters = StageCounters()
    for progress in running.recentProgress:
        counters.take(progress)
    measures = {**counters.totals(), "lag_seconds": round(counters.lag_seconds(), 6)}
    return spark.createDataFrame([(name, float(value)) for name, value in measures.items()], "measure string, value double")
