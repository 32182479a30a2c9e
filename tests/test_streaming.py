from __future__ import annotations

import random
from datetime import timedelta
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, START, rows_of, trade, trades
from marketspark.operators.codec import encode_envelope, stable_uuid
from marketspark.operators.gold import WATERMARK_KEY, aggregate_ohlc, apply_watermark
from marketspark.operators.silver import deduplicate_by_trade_id, deduplicate_stream, deduplicate_stream_by_id, to_silver
from marketspark.schemas import GOLD, TOPIC_ROW, TRADE, conform
from marketspark.sinks.writers import StorageWriter
from marketspark.sources.tables import Layout
from marketspark.sources.topics import replay_files
from marketspark.streaming.jobs import TradeStreams
from marketspark.streaming.late import LateEvents, late_events_by_symbol
from marketspark.streaming.progress import ProgressCounters, StageCounters, late_rows


def publish(spark, path, *rows):
    """Append one file of topic rows."""
    df = trades(spark, *rows).withColumn("trade_id", stable_uuid(F.col("trade_id")))
    messages = encode_envelope(df)
    stored = messages.select(
        "key", "value", "topic", F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    stored.coalesce(1).write.mode("append").parquet(path)


def store(spark, path, *rows):
    trades(spark, *rows).coalesce(1).write.mode("append").parquet(path)


def finish(query):
    query.awaitTermination(120)
    if query.exception():
        raise query.exception()
    return query


def streams(spark, topic, lake, **options):
    return TradeStreams(spark, replay_files(spark, topic), lake, available_now=True, as_of=AS_OF, **options)


def test_watermark_is_set_once(spark):
    stream = apply_watermark(spark.readStream.format("rate").load().selectExpr("timestamp AS event_time"), 60)
    assert stream.schema["event_time"].metadata[WATERMARK_KEY] == 60_000
    assert apply_watermark(stream, 30).schema["event_time"].metadata[WATERMARK_KEY] == 60_000


def test_layers_equal_the_batch_functions(spark, tmp_path, lake):
    rng = random.Random(4)
    rows = [
        trade(str(i), seconds=i * 7, price=Decimal(rng.randrange(1, 99)), side=rng.choice(["BUY", "SELL", "HOLD"]),
              symbol=rng.choice(["AAA", "AAA", "BBB"]))
        for i in range(200)
    ]
    copies = [{**r, "ingest_time": r["ingest_time"] + timedelta(seconds=1)} for r in rows[::10]]
    topic = str(tmp_path / "topic")
    publish(spark, topic, *rows, *copies)
    spark.createDataFrame(
        [(b"x", bytearray(b"not json"), "raw.trades", 0, 0, START)], TOPIC_ROW
    ).write.mode("append").parquet(topic)

    jobs = streams(spark, topic, lake)
    jobs.run(datasets=["ohlc", "volume_profiles", "trade_stats"], window_durations=["1 minute", "5 minutes"])

    source = trades(spark, *rows, *copies).withColumn("trade_id", stable_uuid(F.col("trade_id")))
    bronze = spark.read.parquet(lake.bronze).select(*TRADE.fieldNames())
    assert rows_of(bronze) == rows_of(source)

    held = [r for r in rows + copies if r["side"] == "HOLD"]
    reasons = {r.failure_reason: r["count"] for r in
               spark.read.parquet(lake.dead_letters).groupBy("failure_reason").count().collect()}
    assert reasons == {"schema_validation_error": len(held), "deserialization_error": 1}

    silver = to_silver(source, AS_OF).select(*TRADE.fieldNames())
    newest = max(r["event_time"] for r in rows if r["side"] != "HOLD")
    mark = newest - timedelta(seconds=60)
    emitted = spark.read.parquet(lake.silver).select(*TRADE.fieldNames())
    assert rows_of(emitted) == rows_of(silver.filter(F.col("event_time") <= F.lit(mark)))

    for duration in ("1 minute", "5 minutes"):
        expected = conform(aggregate_ohlc(silver, duration), GOLD["ohlc"]).filter(F.col("window_end") <= F.lit(mark))
        found = jobs.read_gold("ohlc", [duration]).select(*GOLD["ohlc"].fieldNames())
        assert rows_of(found) == rows_of(expected) and found.count() > 0
    assert jobs.read_gold("trade_stats", ["1 minute", "5 minutes"]).select("window_duration").distinct().count() == 2


def test_state_store_is_set_for_the_query_only(spark, tmp_path, lake):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    source = str(tmp_path / "trades")
    store(spark, source, trade("1"))
    windows = aggregate_ohlc(replay_files(spark, source, TRADE))
    query = finish(StorageWriter(spark, lake.checkpoints, True).write_gold(windows, "ohlc", lake.gold("{dataset}")))
    assert spark.conf.get(key) == before
    assert any("rocksdb" in name for p in query.recentProgress for op in p["stateOperators"]
               for name in op["customMetrics"])


def test_restart_continues_without_copies(spark, tmp_path, lake):
    topic = str(tmp_path / "topic")
    publish(spark, topic, trade("1"), trade("2", seconds=1))
    finish(streams(spark, topic, lake).bronze())
    assert spark.read.parquet(lake.bronze).count() == 2
    finish(streams(spark, topic, lake).bronze())
    assert spark.read.parquet(lake.bronze).count() == 2
    publish(spark, topic, trade("3", seconds=2))
    finish(streams(spark, topic, lake).bronze())
    assert spark.read.parquet(lake.bronze).count() == 3


def test_state_survives_a_restart(spark, tmp_path, lake):
    """An open window is finished by the run that sees its end."""
    topic = str(tmp_path / "topic")
    publish(spark, topic, trade("1"), trade("2", seconds=10, price=Decimal("70000")))
    finish(streams(spark, topic, lake).gold("ohlc"))
    publish(spark, topic, trade("3", seconds=20, price=Decimal("60000")), trade("4", seconds=600))
    finish(streams(spark, topic, lake).gold("ohlc"))
    row, = spark.read.parquet(lake.gold("ohlc", "1 minute")).collect()
    assert (row.open_price, row.high_price, row.low_price, row.close_price, row.trade_count) == (
        68000, 70000, 60000, 60000, 3
    )


def late_stream(spark, tmp_path, lake, counters=None):
    source = str(tmp_path / "trades")
    # The watermark of a batch applies from the next one on.
    for rows in ([trade("1")], [trade("2", seconds=600)], [trade("3", seconds=700)],
                 [trade("late", seconds=5), trade("4", seconds=701)], [trade("5", seconds=1400)],
                 [trade("6", seconds=1401)]):
        store(spark, source, *rows)
    stream = replay_files(spark, source, TRADE, max_files_per_trigger=1)
    windows = aggregate_ohlc(apply_watermark(stream))
    writer = StorageWriter(spark, lake.checkpoints, available_now=True)
    return finish(writer.write_gold(windows, "ohlc", lake.gold("{dataset}")))


def test_late_rows_are_dropped_and_counted(spark, tmp_path, lake):
    query = late_stream(spark, tmp_path, lake)
    assert late_rows(query) == 1
    counts = {r.window_start: r.trade_count for r in spark.read.parquet(lake.gold("ohlc")).collect()}
    assert counts[START] == 1


def test_progress_listener(spark, tmp_path, lake):
    counters = ProgressCounters()
    spark.streams.addListener(counters)
    try:
        late_stream(spark, tmp_path, lake)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(counters)
    totals, = counters.snapshot().values()
    assert totals["input_rows"] == 7 and totals["late_rows"] == 1 and totals["batches"] >= 6


def dedup(spark, tmp_path, lake, keep):
    source = str(tmp_path / "trades")
    store(spark, source, trade("1", price=Decimal("1")), trade("2", seconds=1))
    store(spark, source, trade("1", price=Decimal("2"), ingest_time=START + timedelta(seconds=9)))
    store(spark, source, trade("end", seconds=900))
    stream = apply_watermark(replay_files(spark, source, TRADE, max_files_per_trigger=1))
    writer = StorageWriter(spark, lake.checkpoints, available_now=True)
    finish(writer.write_bronze(deduplicate_stream(stream, keep), lake.bronze))
    return {r.trade_id: r.price for r in spark.read.parquet(lake.bronze).collect()}


def test_latest_copy_wins_across_batches(spark, tmp_path, lake):
    assert dedup(spark, tmp_path, lake, "latest") == {"1": Decimal("2"), "2": Decimal("68000")}


def test_first_copy_wins_at_once(spark, tmp_path, lake):
    found = dedup(spark, tmp_path, lake, "first")
    assert found["1"] == Decimal("1") and set(found) == {"1", "2", "end"}
    with pytest.raises(ValueError):
        deduplicate_stream(trades(spark, trade()), "any")


def test_continuous_run_stops_on_timeout(spark, tmp_path, lake):
    topic = str(tmp_path / "topic")
    publish(spark, topic, trade("1"))
    jobs = TradeStreams(spark, replay_files(spark, topic), lake, as_of=AS_OF)
    queries = jobs.run(timeout=2)
    try:
        assert all(q.isActive for q in queries)
        queries[0].processAllAvailable()
        assert spark.read.parquet(lake.bronze).count() == 1
    finally:
        for query in queries:
            query.stop()


def by_id(spark, source, lake, horizon=1200):
    stream = apply_watermark(replay_files(spark, source, TRADE, max_files_per_trigger=1))
    writer = StorageWriter(spark, lake.checkpoints, available_now=True)
    finish(writer.write_silver(deduplicate_stream_by_id(stream, horizon), lake.silver))
    return {r.trade_id: (r.price, r.event_time) for r in spark.read.schema(TRADE).parquet(lake.silver).collect()}


def test_latest_wins_by_id_over_batches_and_a_restart(spark, tmp_path, lake):
    """Copies of one id with other event times, in five batches; the query stops after the second."""
    source = str(tmp_path / "trades")

    def copy(trade_id, seconds, price, arrived):
        return trade(trade_id, seconds=seconds, price=Decimal(price), ingest_time=START + timedelta(seconds=arrived))

    store(spark, source, copy("a", 0, 1, 0), copy("b", 10, 1, 10), copy("c", 20, 1, 90))
    store(spark, source, copy("a", 300, 2, 300), copy("c", 310, 2, 30))
    assert by_id(spark, source, lake) == {}
    store(spark, source, copy("a", 900, 3, 900), copy("d", 910, 1, 910))
    store(spark, source, copy("a", 880, 4, 1800), copy("e", 1800, 1, 1800))
    store(spark, source, copy("end", 9000, 1, 9000))
    found = by_id(spark, source, lake)
    assert found == {
        "a": (Decimal(4), START + timedelta(seconds=880)), "b": (Decimal(1), START + timedelta(seconds=10)),
        "c": (Decimal(1), START + timedelta(seconds=20)), "d": (Decimal(1), START + timedelta(seconds=910)),
        "e": (Decimal(1), START + timedelta(seconds=1800))}
    store(spark, source, copy("later", 20000, 1, 20000))
    assert set(by_id(spark, source, lake)) == {*found, "end"}
    assert spark.read.parquet(lake.silver).count() == 6


def test_by_id_keeps_what_the_batch_form_keeps(spark, tmp_path, lake):
    rng = random.Random(5)
    rows = [trade(rng.choice([None, *"abcdefgh"]), seconds=rng.randrange(500), price=Decimal(rng.randrange(1, 5)),
                  ingest_time=START + timedelta(seconds=rng.randrange(4))) for _ in range(120)]
    source = str(tmp_path / "trades")
    for k in range(0, 120, 30):
        store(spark, source, *rows[k:k + 30])
    store(spark, source, trade("end", seconds=9000))
    stream = replay_files(spark, source, TRADE, max_files_per_trigger=2).withWatermark("event_time", "1000 seconds")
    writer = StorageWriter(spark, lake.checkpoints, available_now=True)
    finish(writer.write_silver(deduplicate_stream_by_id(stream, 600), lake.silver))
    found = spark.read.parquet(lake.silver).select(*TRADE.fieldNames())
    assert rows_of(found) == rows_of(deduplicate_by_trade_id(trades(spark, *rows)))


def messages(spark, topic, n=120, copies=10):
    rng = random.Random(7)
    rows = [trade(str(i), seconds=i * 11, price=Decimal(rng.randrange(1, 99)), side=rng.choice(["BUY", "SELL", "HOLD"]))
            for i in range(n)]
    again = [{**r, "ingest_time": r["ingest_time"] + timedelta(seconds=1)} for r in rows[::copies]]
    publish(spark, topic, *rows, *again)
    bad = spark.createDataFrame([(b"x", bytearray(b"not json"), "raw.trades", 0, 0, START)], TOPIC_ROW)
    bad.write.mode("append").parquet(topic)
    return rows, again


def layers_of(spark, lake):
    return (
        rows_of(spark.read.parquet(lake.bronze).select(*TRADE.fieldNames(), "contract_failures")),
        sorted((r.failure_reason, bytes(r.value), tuple(r.failed_rules)) for r in spark.read.parquet(lake.dead_letters).collect()),
        rows_of(spark.read.parquet(lake.silver).select(*TRADE.fieldNames())),
    )


def test_layers_from_one_decoding_equal_layers_by_themselves(spark, tmp_path, lake):
    topic = str(tmp_path / "topic")
    messages(spark, topic)
    other = Layout(str(tmp_path / "other"))
    streams(spark, topic, other).run()
    jobs = streams(spark, topic, lake, decode_once=True)
    jobs.run(datasets=["ohlc", "trade_stats"])
    assert layers_of(spark, lake) == layers_of(spark, other)
    silver = spark.read.parquet(lake.silver)
    mark = silver.agg(F.max("event_time")).first()[0] - timedelta(seconds=60)
    expected = conform(aggregate_ohlc(silver), GOLD["ohlc"]).filter(F.col("window_end") <= F.lit(mark))
    assert rows_of(jobs.read_gold("ohlc").select(*GOLD["ohlc"].fieldNames())) == rows_of(expected) and expected.count() > 5
    assert spark.read.parquet(lake.decoded).filter("outcome = 'accepted'").select("value").distinct().collect() == [(None,)]


def test_only_the_decoding_query_parses_messages(spark, tmp_path, lake, capsys):
    topic = str(tmp_path / "topic")
    messages(spark, topic, 10)
    jobs = streams(spark, topic, lake, decode_once=True)
    plans = []
    for start in (jobs.decoded, jobs.bronze, jobs.dead_letters, jobs.silver, lambda: jobs.gold("ohlc")):
        finish(start()).explain()
        plans.append(capsys.readouterr().out.lower())
    assert ["from_json" in plan or "jsontostructs" in plan for plan in plans] == [True, False, False, False, False]
    assert plans[0].count("from_json") + plans[0].count("jsontostructs") == 1
    assert ["trade_id" in plan and "max_by" in plan for plan in plans[3:]] == [True, True]
    assert plans[4].count("statestoresave") == 1


def forget_last_commit(commits):
    """As if the query had ended between the write of its last batch and the commit."""
    last = max(int(p.name) for p in commits.glob("[0-9]*"))
    for name in (str(last), f".{last}.crc"):
        (commits / name).unlink(missing_ok=True)


def test_a_batch_that_runs_again_adds_no_row(spark, tmp_path, lake):
    topic = str(tmp_path / "topic")
    messages(spark, topic, 30)
    jobs = streams(spark, topic, lake, decode_once=True)
    counters = StageCounters()
    queries = jobs.run()
    before = layers_of(spark, lake)
    for name in ("decoded", "bronze", "dead-letter", "silver"):
        forget_last_commit(tmp_path / "lake" / "checkpoints" / name / "commits")
    for query in queries + streams(spark, topic, lake, decode_once=True).run():
        for progress in finish(query).recentProgress:
            counters.take(progress)
    assert layers_of(spark, lake) == before
    assert counters.totals()["raw"] == 34


def test_stage_counters(spark, tmp_path, lake):
    topic = str(tmp_path / "topic")
    rows, again = messages(spark, topic, 60)
    held = sum(r["side"] == "HOLD" for r in rows + again)
    counters = StageCounters()
    spark.streams.addListener(counters)
    try:
        finish(streams(spark, topic, lake, decode_once=True).decoded())
        publish(spark, topic, trade("x", seconds=5000))
        finish(streams(spark, topic, lake, decode_once=True).decoded())
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(counters)
    totals = counters.totals()
    assert totals["raw"] == 68 and totals["bronze"] == 67 and totals["silver"] == 67 - held
    assert totals["deserialization_error"] == 1 and totals["schema_validation_error"] == held and totals["dead_letter"] == held + 1
    assert counters.lag_seconds() is not None


def test_stage_counters_keep_sums_of_old_batches():
    counters = StageCounters()
    for batch in [*range(260), 258, 259]:
        counters.take(SimpleNamespace(id="q", batchId=batch, observedMetrics={
            "stages": SimpleNamespace(asDict=lambda b=batch: {"raw": 2, "newest_message": b * 1_000_000, "newest_event": None if b < 9 else 0})}))
    counters.take(SimpleNamespace(id="q", batchId=1, observedMetrics={}))
    assert counters.totals() == {"raw": 520} and counters.lag_seconds() == 259 and len(counters._batches) < 120


def test_late_events_by_symbol_over_batches_and_a_restart(spark, tmp_path, lake):
    source = str(tmp_path / "trades")

    def run():
        stream = replay_files(spark, source, TRADE, max_files_per_trigger=1)
        finish(LateEvents(spark, lake, available_now=True).start(stream))
        return {r.symbol: (r.events, r.late_events) for r in late_events_by_symbol(spark, lake).collect()}

    store(spark, source, trade("1"), trade("2", seconds=-500, symbol="B"))
    store(spark, source, trade("3", seconds=600), trade("4", seconds=-61), trade("5", seconds=-60, symbol="B"))
    assert run() == {"BTCUSDT": (3, 1), "B": (2, 0)}
    store(spark, source, trade("6", seconds=0, symbol="B"), trade("7", seconds=539), trade("8", seconds=540))
    store(spark, source, trade("9", seconds=541, symbol=None))
    assert run() == {"BTCUSDT": (5, 2), "B": (3, 1), None: (1, 0)}
    forget_last_commit(tmp_path / "lake" / "checkpoints" / "late-events" / "commits")
    assert run() == {"BTCUSDT": (5, 2), "B": (3, 1), None: (1, 0)}
    counter = LateEvents(spark, lake)
    counter.count(trades(spark), 4)
    assert counter._newest_before(spark, 5) == counter._newest_before(spark, 4)


def test_late_events_of_decoded_messages(spark, tmp_path, lake):
    topic = str(tmp_path / "topic")
    messages(spark, topic, 20)
    jobs = streams(spark, topic, lake, decode_once=True)
    finish(jobs.decoded())
    finish(jobs.late_events())
    accepted_rows = spark.read.parquet(lake.decoded).filter("outcome = 'accepted'").count()
    assert sum(r.events for r in late_events_by_symbol(spark, lake).collect()) == accepted_rows
