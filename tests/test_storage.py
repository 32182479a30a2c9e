from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, START, rows_of, trade, trades
from marketspark import session
from marketspark.operators.gold import aggregate_ohlc
from marketspark.operators.silver import with_partition_date
from marketspark.plans.rebuild import changed_days, rebuild, rebuild_changed_days
from marketspark.plans.serving import latest_trades, latest_trades_of
from marketspark.schemas import GOLD, TRADE
from marketspark.sinks import compaction
from marketspark.sinks.compaction import compact, file_counts, fingerprint
from marketspark.sinks.writers import StorageWriter
from marketspark.sources import file_index
from marketspark.sources.tables import Layout, read_bronze, read_gold, read_silver, scan_union_by_name
from marketspark.sources.topics import publishing_options, reading_options


def writer(spark, lake):
    return StorageWriter(spark, lake.checkpoints)


def test_bronze_round_trip_by_date(spark, lake):
    df = trades(spark, trade("1"), trade("2", symbol="ETHUSDT", side="SELL"), trade("3", seconds=86400))
    writer(spark, lake).write_bronze(df, lake.bronze)
    stored = read_bronze(spark, lake.bronze)
    assert rows_of(stored.select(*TRADE.fieldNames())) == rows_of(df)
    assert {r.partition_date for r in stored.select("partition_date").distinct().collect()} == {
        date(2026, 5, 24), date(2026, 5, 25)
    }


def test_bronze_contract(spark, lake):
    writer(spark, lake).write_bronze(trades(spark, trade()), lake.bronze)
    types = {f.name: f.dataType for f in read_bronze(spark, lake.bronze).schema}
    assert {f.name: f.dataType for f in TRADE}.items() <= types.items()


def test_bronze_is_append_only(spark, lake):
    for i in range(2):
        writer(spark, lake).write_bronze(trades(spark, trade(str(i))), lake.bronze)
    assert read_bronze(spark, lake.bronze).count() == 2


def test_silver_by_date_and_symbol_prunes(spark, lake):
    df = trades(spark, trade("1"), trade("2", symbol="ETHUSDT"), trade("3", seconds=86400))
    writer(spark, lake).write_silver(df, lake.silver)
    folders = {str(p.relative_to(lake.silver)) for p in Path(lake.silver).glob("*/*") if p.is_dir()}
    assert "partition_date=2026-05-24/symbol=ETHUSDT" in folders and len(folders) == 3
    one = read_silver(spark, lake.silver).filter("symbol = 'ETHUSDT' AND partition_date = '2026-05-24'")
    assert [r.trade_id for r in one.collect()] == ["2"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "symbol" in plan[plan.index("PartitionFilters"): plan.index("PushedFilters")]


def test_gold_partition_is_the_day_of_the_window_end(spark, lake):
    df = trades(spark, trade("1", event_time=datetime(2026, 5, 24, 23, 59, 30)))
    writer(spark, lake).write_gold(aggregate_ohlc(df), "ohlc", lake.gold("{dataset}"))
    row = read_gold(spark, "ohlc", lake.gold("{dataset}")).first()
    assert row.partition_date == date(2026, 5, 25)
    assert row.window_start == datetime(2026, 5, 24, 23, 59)


def test_union_by_name(spark, lake):
    spark.createDataFrame([("A", 1)], "symbol string, trade_count int").write.parquet(lake.gold("x", "a"))
    spark.createDataFrame([(2.5, "B")], "volume double, symbol string").write.parquet(lake.gold("x", "b"))
    spark.createDataFrame([("C", True)], "symbol string, extra boolean").write.mode("append").parquet(lake.gold("x", "b"))
    rows = {r.symbol: r for r in scan_union_by_name(spark, lake.gold("x", "a"), lake.gold("x", "b")).collect()}
    assert rows["A"].trade_count == 1 and rows["A"].volume is None
    assert rows["B"].volume == 2.5 and rows["B"].extra is None
    assert rows["C"].extra is True
    with pytest.raises(ValueError):
        scan_union_by_name(spark)


@pytest.mark.parametrize("files_per_job", [10_000, 5, 1])
def test_compaction_plans_files_per_partition_and_keeps_rows(spark, lake, files_per_job):
    days = {0: 400, 1: 90, 2: 1}
    rows = [trade(f"{d}-{i % 7}", seconds=86400 * d) for d, n in days.items() for i in range(n)]
    df = trades(spark, *rows)
    for part in df.randomSplit([0.5, 0.3, 0.2], 1):
        with_partition_date(part.repartition(6)).write.partitionBy("partition_date").mode("append").parquet(lake.bronze)
    source = read_bronze(spark, lake.bronze)
    target = 50_000
    report = compact(spark, lake.bronze, lake.compacted, target_file_size_mb=target / 1024 / 1024,
                     files_per_job=files_per_job)
    found = {r.partition_date: (r.rows, r.files) for r in file_counts(read_bronze(spark, lake.compacted)).collect()}
    start = date(2026, 5, 24)
    assert found == {
        start + timedelta(days=d): (n, max(1, n * 500 // target)) for d, n in days.items()
    }
    assert report["rows"] == 491 and report["files"] == 6
    assert fingerprint(read_bronze(spark, lake.compacted)).first() == fingerprint(source).first()


def stored_files(spark, path):
    """Rows of each file by partition value, and the tasks that wrote them."""
    files = spark.read.parquet(path).groupBy("partition_date", F.col("_metadata.file_name").alias("f")).count().collect()
    sizes = {}
    for row in files:
        sizes.setdefault(row.partition_date, []).append(row["count"])
    return sizes, {row.f.split("-")[1] for row in files}


def test_compaction_writes_many_files_in_a_task(spark, lake):
    """What the tasks report to the driver must not grow with the number of files."""
    days = {date(2026, 5, 24): 4037, date(2026, 5, 25): 2950}
    df = spark.range(sum(days.values())).selectExpr("id", "IF(id < 4037, '2026-05-24', '2026-05-25') AS partition_date")
    df.repartition(5).write.partitionBy("partition_date").parquet(lake.bronze)
    compact(spark, lake.bronze, lake.compacted, target_file_size_mb=50_000 / 1024 / 1024)
    sizes, tasks = stored_files(spark, lake.compacted)
    assert {day: len(s) for day, s in sizes.items()} == {day: n // 100 for day, n in days.items()}
    assert len(tasks) <= 4


@pytest.mark.parametrize("rows_per_file", [1, 2, 7.3, 40])
@pytest.mark.parametrize(("partitioned", "joined"), [(True, False), (False, True)])
def test_compaction_fills_exact_numbers_of_files(spark, lake, monkeypatch, rows_per_file, partitioned, joined):
    """Days of many sizes and without a date, in files of one day or of all; small tables joined with or without a hint."""
    numbers = [1, 2, 15, 83, 160, 301, 322, 716]
    if joined:
        monkeypatch.setattr(compaction, "FILES_PER_JOB", 0)
    df = spark.createDataFrame(
        [(i, None if day == 3 else date(2026, 5, 1 + day)) for day, n in enumerate(numbers) for i in range(n)],
        "id int, partition_date date").repartition(3)
    (df.write.partitionBy("partition_date") if partitioned else df.write).parquet(lake.bronze)
    compact(spark, lake.bronze, lake.compacted, target_file_size_mb=rows_per_file * 500 / 1024 / 1024)
    sizes, _ = stored_files(spark, lake.compacted)
    found = {None if day is None else day.day - 1: s for day, s in sizes.items()}
    for day, n in enumerate(numbers):
        files = max(1, int(n / rows_per_file))
        held = found[None if day == 3 else day]
        assert (sum(held), len(held)) == (n, files)
        assert max(held) <= 2 * min(held) or n < 2 * rows_per_file
    assert sorted(rows_of(spark.read.parquet(lake.compacted).select("id", "partition_date")), key=repr) == rows_of(df)


def test_compaction_spreads_a_partition_of_equal_rows(spark, lake):
    """Copies of one row must not end up in one file."""
    writer(spark, lake).write_bronze(trades(spark, *[trade("same")] * 1000), lake.bronze)
    compact(spark, lake.bronze, lake.compacted, target_file_size_mb=100_000 / 1024 / 1024)
    stored = read_bronze(spark, lake.compacted).select(F.col("_metadata.file_path").alias("f"))
    sizes = Counter(r.f for r in stored.collect())
    assert len(sizes) == 5 and max(sizes.values()) <= 201


def test_compaction_keeps_rows_without_a_date(spark, lake):
    writer(spark, lake).write_bronze(trades(spark, trade("1"), trade("2", event_time=None)), lake.bronze)
    assert compact(spark, lake.bronze, lake.compacted)["rows"] == 2
    assert read_bronze(spark, lake.compacted).filter("partition_date IS NULL").count() == 1


def test_compaction_of_an_empty_table(spark, lake):
    df = trades(spark, trade()).withColumn("partition_date", F.lit("2026-05-24")).limit(0)
    df.write.parquet(lake.bronze)
    assert compact(spark, lake.bronze, lake.compacted)["rows"] == 0


def test_rebuild_writes_every_layer(spark, lake, tmp_path):
    df = trades(
        spark,
        trade("1"),
        trade("1", ingest_time=START + timedelta(hours=1), price=Decimal("69000")),
        trade("2", symbol=" btcusdt ", side="sell", seconds=70),
        trade("3", price=Decimal("0")),
        trade("4", schema_version="9"),
    )
    writer(spark, lake).write_bronze(df, lake.bronze)
    target = Layout(str(tmp_path / "again"))
    out = rebuild(spark, lake.bronze, target, AS_OF, ("1 minute", "1 hour"))
    assert sorted((r.trade_id, r.price) for r in out["silver"].collect()) == [
        ("1", Decimal("69000")), ("2", Decimal("68000"))
    ]
    assert Counter(r.window_duration for r in out["ohlc"].collect()) == {"1 minute": 2, "1 hour": 1}
    assert out["volume_profiles"].count() == out["trade_stats"].count() == 3
    summary, = out["daily_summary"].collect()
    assert (summary.trade_count, summary.buy_count, summary.sell_count) == (2, 1, 1)
    assert spark.read.parquet(target.mart("market_activity")).count() == 1
    assert read_bronze(spark, lake.bronze).count() == 5
    refused = {r.trade_id: r.failure_reason for r in spark.read.parquet(target.rejects).collect()}
    assert refused == {"3": "business_rule_violation", "4": "unknown_schema_version"}
    # A second run takes the place of the first.
    again = rebuild(spark, lake.bronze, target, AS_OF, ("1 minute", "1 hour"))
    assert again["silver"].count() == 2 and again["ohlc"].count() == 3 and again["daily_summary"].count() == 1
    assert spark.read.parquet(target.rejects).count() == 2
    with pytest.raises(ValueError, match="another"):
        rebuild(spark, lake.bronze, lake, AS_OF)


def test_compaction_refuses_an_existing_target(spark, lake):
    df = trades(spark, trade()).withColumn("partition_date", F.lit("2026-05-24"))
    df.write.parquet(lake.bronze)
    compact(spark, lake.bronze, lake.compacted)
    with pytest.raises(ValueError, match="exists"):
        compact(spark, lake.bronze, lake.compacted)
    assert spark.read.parquet(lake.compacted).count() == 1


def test_sessions_are_sized_for_their_cores(spark):
    assert session.sized_for(100)["spark.sql.shuffle.partitions"] == "200"
    assert session._cores(spark) == spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    session.build_session(total_cores=40)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "320"
    if before is None:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    else:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", before)


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    path = session.working_path(spark, "x")
    assert path != session.working_path(spark, "x")
    if configured:
        assert path.startswith(configured.rstrip("/"))


def test_topic_options():
    options = reading_options("broker:9092", "raw.trades", "g")
    assert options["kafka.bootstrap.servers"] == "broker:9092"
    assert options["subscribe"] == "raw.trades"
    assert options["kafka.group.id"] == "g"
    assert options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false"
    assert options["kafka.isolation.level"] == "read_committed"
    assert options["kafka.max.poll.interval.ms"] == "600000"
    assert reading_options("b", maxOffsetsPerTrigger=5)["maxOffsetsPerTrigger"] == "5"
    producer = publishing_options("b", "c", **{"kafka.retries": 5, "kafka.request.timeout.ms": 60000})
    assert producer["kafka.acks"] == "all" and producer["kafka.enable.idempotence"] == "true"
    assert producer["kafka.compression.type"] == "snappy" and producer["kafka.retries"] == "5"
    assert producer["kafka.request.timeout.ms"] == "60000"


def test_object_store_options():
    options = session.object_store_options("http://store:9000", "key", "secret")
    assert options["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert options["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert options["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


def indexed(spark, lake, limit, symbol=None):
    found = file_index.latest_trades_indexed(spark, lake.silver, lake.file_bounds("silver"), limit, symbol)
    stored = spark.read.parquet(lake.silver)
    plain = latest_trades(stored, limit) if symbol is None else latest_trades_of(stored, symbol, limit)
    columns = [*TRADE.fieldNames(), "partition_date"]
    assert [tuple(r) for r in found.select(columns).collect()] == [tuple(r) for r in plain.select(columns).collect()]
    return len(found.inputFiles())


def test_latest_trades_open_only_files_that_can_hold_them(spark, lake):
    rows = [trade(f"{day}-{i}", seconds=86400 * day + 60 * i, symbol="A B" if i % 3 else "Z") for day in range(12) for i in range(9)]
    rows += [trade("none", event_time=None), trade("tie", seconds=86400 * 11 + 480)]
    for at in range(0, len(rows), 20):
        writer(spark, lake).write_silver(trades(spark, *rows[at:at + 20]).coalesce(1), lake.silver)
    assert file_index.refresh_file_bounds(spark, lake.silver, lake.file_bounds("silver")) >= 20
    assert file_index.refresh_file_bounds(spark, lake.silver, lake.file_bounds("silver")) == 0
    whole = len(spark.read.parquet(lake.silver).inputFiles())
    assert indexed(spark, lake, 3) <= 3 < 20 <= whole
    assert indexed(spark, lake, 25) < whole / 2
    assert indexed(spark, lake, 4, "a b") <= 2 and indexed(spark, lake, 10, "z") <= 5
    assert indexed(spark, lake, 1000) == whole and indexed(spark, lake, 5, "none") == 0
    with pytest.raises(ValueError):
        indexed(spark, lake, 0)


def test_the_file_index_may_be_behind(spark, lake, tmp_path):
    writer(spark, lake).write_silver(trades(spark, *[trade(str(i), seconds=86400 * i) for i in range(6)]), lake.silver)
    assert indexed(spark, lake, 2) == 6
    file_index.refresh_file_bounds(spark, lake.silver, lake.file_bounds("silver"))
    # A newer trade in a file that is not indexed, misfiled under the first day.
    misfiled = spark.read.parquet(lake.silver).limit(1).withColumns({
        "trade_id": F.lit("new"), "event_time": F.lit(START + timedelta(days=50)), "partition_date": F.lit("2026-05-24")})
    misfiled.write.mode("append").partitionBy("partition_date", "symbol").parquet(lake.silver)
    assert indexed(spark, lake, 2) <= 3
    newest = max(Path(str(tmp_path / "lake")).glob("silver/trades/partition_date=2026-05-29/**/*.parquet"))
    newest.rename(newest.with_name("moved-" + newest.name))
    assert indexed(spark, lake, 2) <= 4


def test_many_files_are_scanned_with_a_bound(spark, lake, monkeypatch):
    writer(spark, lake).write_silver(trades(spark, *[trade(str(i), seconds=86400 * i) for i in range(6)]), lake.silver)
    monkeypatch.setattr(file_index, "MOST_FILES", 2)
    assert file_index.refresh_file_bounds(spark, lake.silver, lake.file_bounds("silver")) == 6
    assert indexed(spark, lake, 1) == 1 and indexed(spark, lake, 5) == 6


def all_layers(spark, layout):
    names = {"silver": layout.silver, "rejects": layout.rejects, **{d: layout.gold(d) for d in GOLD},
             **{m: layout.mart(m) for m in ("daily_summary", "symbol_performance", "volatility_metrics", "market_activity")}}
    out = {}
    for name, path in names.items():
        df = spark.read.parquet(path)
        df = df.drop("processing_timestamp")
        out[name] = rows_of(df.select(*[F.col(c).cast("string") for c in sorted(df.columns)]))
    return out


def bronze_days(rng, days):
    rows = []
    for day in days:
        for i in range(12):
            rows.append(trade(rng.choice([f"{day}-{i}", f"id{rng.randrange(12)}"]), seconds=86400 * day + rng.choice([0, 60 * i, 85970, 50395]),
                              price=Decimal(rng.randrange(0, 40)), symbol=rng.choice(["A", "B/C", "D"]), side=rng.choice(["BUY", "SELL"])))
    return [{**r, "ingest_time": r["event_time"] + timedelta(days=rng.randrange(9))} for r in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_changed_days_equal_a_full_rebuild(spark, lake, tmp_path, seed):
    rng = random.Random(seed)
    durations = ("1 minute", "1 day")
    rows = bronze_days(rng, range(10))
    moved, whole = Layout(str(tmp_path / "moved")), Layout(str(tmp_path / "whole"))
    later = "2027-01-01 00:00:00"
    again = StorageWriter(spark, lake.checkpoints, replace=True)
    again.write_bronze(trades(spark, *rows), lake.bronze)
    rebuild(spark, lake.bronze, moved, later, durations)
    assert rebuild_changed_days(spark, lake.bronze, moved, later, durations) == []
    bronze = read_bronze(spark, lake.bronze).repartition(7)
    assert changed_days(bronze, moved).count() == 0

    def day(r):
        return (r["event_time"] - START.replace(hour=0)).days

    new = [r for r in rows if day(r) not in (2, 6)] + bronze_days(rng, [6]) + bronze_days(rng, [14])
    again.write_bronze(trades(spark, *new), lake.bronze)
    written = {p: p.stat().st_mtime_ns for p in (tmp_path / "moved").glob("silver/**/*.parquet")}
    days = rebuild_changed_days(spark, lake.bronze, moved, later, durations)
    rebuild(spark, lake.bronze, whole, later, durations)
    assert all_layers(spark, moved) == all_layers(spark, whole)
    assert set(days) >= {"2026-05-26", "2026-05-30", "2026-06-07"}
    kept = [p for p in written if not any(f"partition_date={d}/" in str(p) for d in days)]
    assert all(p.exists() and p.stat().st_mtime_ns == written[p] for p in kept)
    assert rebuild_changed_days(spark, lake.bronze, moved, later, durations) == []
    with pytest.raises(ValueError, match="divide"):
        rebuild_changed_days(spark, lake.bronze, moved, later, ("7 hours",))


def test_one_changed_day_leaves_the_others(spark, lake, tmp_path):
    """Ids of a day that are on no other day move that day alone."""
    rows = [trade(f"{d}-{i}", seconds=86400 * d + i) for d in range(5) for i in range(4)]
    target = Layout(str(tmp_path / "to"))
    again = StorageWriter(spark, lake.checkpoints, replace=True)
    again.write_bronze(trades(spark, *rows), lake.bronze)
    rebuild(spark, lake.bronze, target, "2027-01-01 00:00:00")
    again.write_bronze(trades(spark, *rows[:8], *rows[9:]), lake.bronze)
    written = {p: p.stat().st_mtime_ns for p in (tmp_path / "to").glob("[sg]*/**/*.parquet")}
    assert rebuild_changed_days(spark, lake.bronze, target, "2027-01-01 00:00:00") == ["2026-05-26"]
    days = ("2026-05-24", "2026-05-25", "2026-05-28")
    assert all(p.stat().st_mtime_ns == at for p, at in written.items() if any(f"={d}" in str(p) for d in days))
    assert sum(r.trade_count for r in spark.read.parquet(target.mart("daily_summary")).collect()) == 19
