"""Batch rebuild of silver, gold and marts from stored bronze: all of it into a new location, or the days that changed."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.functions.durations import duration_micros
from marketspark.operators.gold import aggregate_all
from marketspark.operators.silver import (
    deduplicate_by_trade_id,
    enrich_with_processing_metadata,
    judge,
    normalize_fields,
    with_partition_date,
)
from marketspark.plans.marts import build_daily_summary, marts_over
from marketspark.schemas import DATE_PATTERN, GOLD, conform
from marketspark.session import working_path
from marketspark.sinks.writers import StorageWriter
from marketspark.sources.tables import Layout

# The partition of rows without event time, as Spark names it.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def rebuild_silver(
    spark: SparkSession, bronze: DataFrame, layout: Layout, as_of: datetime | str | None = None
) -> DataFrame:
    """Silver by the rules of the stream. Refused rows are stored with their reason, so none goes unseen.

    Both tables take the place of what an earlier run left: a rebuild can be repeated.
    """
    judged = judge(normalize_fields(bronze.drop("partition_date")), as_of)
    writer = StorageWriter(spark, layout.checkpoints, replace=True)
    writer.write_dead_letters(judged.filter(F.col("failure_reason").isNotNull()), layout.rejects)
    trades = judged.filter(F.col("failure_reason").isNull()).drop("failure_reason", "failed_rules")
    writer.write_silver(deduplicate_by_trade_id(trades), layout.silver)
    return spark.read.parquet(layout.silver)


def rebuild_gold(
    spark: SparkSession, silver: DataFrame, layout: Layout, window_durations: Sequence[str] = ("1 minute",)
) -> dict[str, DataFrame]:
    """All gold datasets. Each window size scans silver once: one aggregate holds the measures of all
    datasets and is stored, and each dataset is a projection of it."""
    writer = StorageWriter(spark, layout.checkpoints, replace=True)
    paths = []
    for duration in window_durations:
        paths.append(working_path(spark, "windows"))
        aggregate_all(silver, duration).write.parquet(paths[-1])
    windows = spark.read.parquet(*paths)
    for dataset in GOLD:
        writer.write_gold(windows, dataset, layout.gold("{dataset}"))
    return {dataset: spark.read.parquet(layout.gold(dataset)) for dataset in GOLD}


def rebuild_marts(spark: SparkSession, gold: dict[str, DataFrame], layout: Layout) -> dict[str, DataFrame]:
    """Marts as tables. The summary is stored first and the others read it."""
    build_daily_summary(gold["ohlc"], gold["volume_profiles"]).write.mode("overwrite").parquet(
        layout.mart("daily_summary")
    )
    marts = {"daily_summary": spark.read.parquet(layout.mart("daily_summary"))}
    for name, mart in marts_over(marts["daily_summary"]).items():
        mart.write.mode("overwrite").parquet(layout.mart(name))
        marts[name] = spark.read.parquet(layout.mart(name))
    return marts


def rebuild(
    spark: SparkSession,
    bronze_path: str,
    layout: Layout,
    as_of: datetime | str | None = None,
    window_durations: Sequence[str] = ("1 minute",),
) -> dict[str, DataFrame]:
    """Bronze to marts. Bronze itself is only read; ``layout`` must be another location than its own, since
    silver, gold and marts there are replaced."""
    if bronze_path.rstrip("/") == layout.bronze:
        raise ValueError(f"{layout.root} is the root of this bronze; rebuild into another one")
    bronze = spark.read.parquet(bronze_path)
    silver = rebuild_silver(spark, bronze, layout, as_of)
    gold = rebuild_gold(spark, silver, layout, window_durations)
    built = {"silver": silver, **gold, **rebuild_marts(spark, gold, layout)}
    store_fingerprints(bronze, layout)
    return built


def day_fingerprints(bronze: DataFrame) -> DataFrame:
    """(partition_date, rows, total, mixed): the same for the same rows of a day, in whatever order and files.

    Sums and exclusive ors of row hashes, reduced in each task first; no row is shuffled.
    """
    row = F.xxhash64(*[F.col(name) for name in sorted(bronze.columns) if name != "partition_date"])
    return bronze.groupBy(F.col("partition_date").cast("string").alias("partition_date")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row.cast("decimal(38,0)")).alias("total"), F.bit_xor(row).alias("mixed"))


def store_fingerprints(bronze: DataFrame, layout: Layout) -> None:
    day_fingerprints(bronze).write.mode("overwrite").parquet(layout.fingerprints)


def changed_days(bronze: DataFrame, layout: Layout) -> DataFrame:
    """Days of bronze that are new, gone, or hold other rows than at the last rebuild."""
    now = day_fingerprints(bronze)
    before = bronze.sparkSession.read.parquet(layout.fingerprints)
    both = now.unionByName(before).groupBy("partition_date", "rows", "total", "mixed").agg(F.count(F.lit(1)).alias("n"))
    return both.filter("n = 1").select("partition_date").distinct()


def _kept(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = working_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folders(rows: DataFrame, keys: list[str]) -> set[tuple]:
    """The partitions that rows lie in: days, or days and symbols, whatever the number of rows."""
    return {tuple(row) for row in rows.select(*[F.coalesce(F.col(key).cast("string"), F.lit(NO_DAY)) for key in keys]).distinct().collect()}


def _replace_days(spark: SparkSession, rows: DataFrame, path: str, keys: list[str], days: list[str]) -> None:
    """Put ``rows``, all that ``days`` are to hold, in the place of what the table has there; other days stay untouched."""
    stale = _folders(spark.read.parquet(path).filter(_day().isin(days)), keys) - _folders(rows, keys)
    rows.hint("rebalance", *keys).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(*keys).parquet(path)
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for values in stale:
        folder = "/".join(f"{key}={escape(value)}" for key, value in zip(keys, values, strict=True))
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _day() -> Column:
    return F.coalesce(F.col("partition_date").cast("string"), F.lit(NO_DAY))


def rebuild_changed_silver(spark: SparkSession, bronze: DataFrame, layout: Layout, changed: list[str], as_of: datetime | str | None) -> list[str]:
    """Replace the days of silver that a change of these days of bronze reaches, and return them.

    An id of a changed day, as it is or as silver still has it, may have copies on other days, one of which may win
    now or have won before; those days are reached too. All rows of such ids are judged again; rows of other ids on
    the same days are as they were. Bronze has to be filed by the day of the event time, as its writer files it.
    """
    silver = spark.read.parquet(layout.silver)
    judged = judge(normalize_fields(bronze.filter(_day().isin(changed)).drop("partition_date")), as_of)
    ids = _kept(spark, bronze.filter(_day().isin(changed)).select("trade_id").unionByName(
        silver.filter(_day().isin(changed)).select("trade_id")).distinct(), "changed-ids")
    same = F.col("trade_id").eqNullSafe(F.col("_id"))
    ids = ids.toDF("_id")
    # Ids alone are looked for in all of bronze; whole rows are read on the days that have some.
    homes = bronze.select("trade_id", _day().alias("day")).join(ids, same, "left_semi").select("day").distinct()
    days = sorted({*changed, *(row.day for row in homes.collect())})
    touched = bronze.filter(_day().isin(days)).join(ids, same, "left_semi")
    again = judge(normalize_fields(touched.drop("partition_date")), as_of).filter("failure_reason IS NULL")
    enriched = enrich_with_processing_metadata(deduplicate_by_trade_id(again.drop("failure_reason", "failed_rules")))
    as_before = silver.filter(_day().isin(days)).join(ids, same, "left_anti").withColumns(
        {"partition_date": _day(), "symbol": F.col("symbol").cast("string")})
    _replace_days(
        spark, _kept(spark, enriched.unionByName(as_before), "changed-silver"), layout.silver, ["partition_date", "symbol"], days)
    refused = judged.filter(F.col("failure_reason").isNotNull())
    old = spark.read.schema(refused.schema).parquet(layout.rejects)
    elsewhere = old.filter(~F.coalesce(F.date_format("event_time", DATE_PATTERN), F.lit(NO_DAY)).isin(changed))
    StorageWriter(spark, layout.checkpoints, replace=True).write_dead_letters(
        _kept(spark, elsewhere.unionByName(refused), "changed-rejects"), layout.rejects)
    return days


def rebuild_changed_days(
    spark: SparkSession,
    bronze_path: str,
    layout: Layout,
    as_of: datetime | str | None = None,
    window_durations: Sequence[str] = ("1 minute",),
) -> list[str]:
    """Bring the layers of an earlier ``rebuild`` up to what bronze holds now, and return the days of silver that moved.

    Silver and gold get new partitions for the days that changed and those that a change reaches, by dynamic partition
    overwrite; no other partition is written. Gold is stored by the day of a window's end, so the day after is
    written too, from the days around. Of the daily summary only the moved days are computed; the marts over it,
    some of which look seven rows back, follow from the summary, which has a row for each symbol and day. A day of
    bronze is told by its rows' hashes, so new files with the same rows move nothing. Days without rows lose their
    partitions. Each window size must divide a day.
    """
    if any(86_400_000_000 % duration_micros(duration) for duration in window_durations):
        raise ValueError("a window that does not divide a day reaches over days; rebuild all")
    bronze = spark.read.parquet(bronze_path)
    changed = sorted(row.partition_date or NO_DAY for row in changed_days(bronze, layout).collect())
    if not changed:
        return []
    days = rebuild_changed_silver(spark, bronze, layout, changed, as_of)
    target = sorted({*days, *(_next_day(day, 1) for day in days if day != NO_DAY)})
    around = sorted({*target, *(_next_day(day, -1) for day in target if day != NO_DAY)})
    silver = spark.read.parquet(layout.silver).filter(_day().isin(around))
    paths = []
    for duration in window_durations:
        paths.append(working_path(spark, "windows"))
        aggregate_all(silver, duration).write.parquet(paths[-1])
    windows = with_partition_date(spark.read.parquet(*paths), "window_end").filter(_day().isin(target))
    for dataset, contract in GOLD.items():
        golden = with_partition_date(conform(windows, contract), "window_end")
        _replace_days(spark, golden, layout.gold(dataset), ["partition_date"], target)
    moved = F.date_format("trade_date", DATE_PATTERN).isin(days)
    summary = spark.read.parquet(layout.mart("daily_summary"))
    gold = {name: spark.read.parquet(layout.gold(name)).filter(_day().isin(target)) for name in ("ohlc", "volume_profiles")}
    fresh = build_daily_summary(gold["ohlc"], gold["volume_profiles"]).filter(moved)
    whole = _kept(spark, summary.filter(~moved).unionByName(fresh), "changed-summary")
    whole.write.mode("overwrite").parquet(layout.mart("daily_summary"))
    for name, mart in marts_over(whole).items():
        mart.write.mode("overwrite").parquet(layout.mart(name))
    store_fingerprints(bronze, layout)
    return days


def _next_day(day: str, by: int) -> str:
    return (date.fromisoformat(day) + timedelta(days=by)).isoformat()
