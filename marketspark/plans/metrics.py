"""Metric tables over stored messages and trades, and the threshold rules on them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketspark.functions.durations import duration_micros
from marketspark.operators.silver import UNREADABLE, deduplicate_by_trade_id

# Thresholds, and how long a breach has to last.
LAG_WARNING_SECONDS = 120
LAG_CRITICAL_SECONDS = 300
DEAD_LETTERS_PER_MINUTE = 10
WARNING_FOR_MINUTES = 2
CRITICAL_FOR_MINUTES = 5
DEAD_LETTERS_FOR_MINUTES = 5


def _interval(column: str, interval: str) -> Column:
    return F.window(column, interval).alias("_interval")


def _interval_start() -> Column:
    return F.col("_interval.start").alias("window_start")


def message_activity(triaged: DataFrame, interval: str = "1 minute") -> DataFrame:
    """One row per interval, topic and outcome: messages, newest message time, newest readable event time.

    The only pass over the messages; the stage, dead-letter and lag metrics are sums over these rows. Store
    it to feed several of them.
    """
    event_time = F.when(F.col("readable"), F.col("trade.event_time"))
    return (
        triaged.groupBy(_interval("timestamp", interval), "topic", "failure_reason")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.max("timestamp").alias("newest_message"),
            F.max(event_time).alias("newest_event"),
        )
        .select(_interval_start(), "topic", "failure_reason", "messages", "newest_message", "newest_event")
    )


def events_by_stage(activity: DataFrame) -> DataFrame:
    """Messages per interval that reached each stage: raw, bronze (readable), silver (accepted), dead_letter."""
    reason = F.col("failure_reason")
    reached = {
        "raw": F.lit(True),
        "bronze": ~reason.eqNullSafe(UNREADABLE),
        "silver": reason.isNull(),
        "dead_letter": reason.isNotNull(),
    }
    counts = activity.groupBy("window_start").agg(*[
        F.sum(F.when(condition, F.col("messages")).otherwise(0)).alias(stage) for stage, condition in reached.items()
    ])
    pairs = F.array(*[F.struct(F.lit(s).alias("stage"), F.col(s).alias("events")) for s in reached])
    return counts.select("window_start", F.inline(pairs))


def dead_letters_by_reason(activity: DataFrame) -> DataFrame:
    return (
        activity.filter(F.col("failure_reason").isNotNull())
        .groupBy("window_start", F.col("failure_reason").alias("reason"))
        .agg(F.sum("messages").alias("events"))
    )


def consumer_lag(activity: DataFrame) -> DataFrame:
    """Per topic and interval: newest message time less the newest event time among readable messages."""
    seconds = (F.unix_micros(F.max("newest_message")) - F.unix_micros(F.max("newest_event"))) / 1_000_000
    return activity.groupBy("window_start", "topic").agg(seconds.alias("lag_seconds"))


def ingested(trades: DataFrame, interval: str = "1 minute") -> DataFrame:
    return (
        trades.groupBy(_interval("ingest_time", interval), "symbol", "exchange")
        .agg(F.count(F.lit(1)).alias("events"))
        .select(_interval_start(), "symbol", "exchange", "events")
    )


def duplicates_dropped(trades: DataFrame, interval: str = "1 minute") -> DataFrame:
    """Rows per ingest interval that deduplication drops: all rows less the kept ones."""
    rows = trades.select("ingest_time", F.lit(1).alias("n"))
    kept = deduplicate_by_trade_id(trades).select("ingest_time", F.lit(-1).alias("n"))
    counts = rows.unionByName(kept).groupBy(_interval("ingest_time", interval)).agg(F.sum("n").alias("duplicates"))
    return counts.filter("duplicates > 0").select(_interval_start(), "duplicates")


def breaches(
    lag: DataFrame,
    dead_letter_counts: DataFrame,
    interval: str = "1 minute",
    dead_letters_per_minute: float = DEAD_LETTERS_PER_MINUTE,
) -> DataFrame:
    """Intervals in which a threshold rule fires: over its limit in each interval of the time it asks for.

    Rules are stated by the minute. The interval decides how many intervals that time has, one at least, and
    how many dead letters an interval may hold.
    """
    minutes = duration_micros(interval) / 60_000_000

    def lasting(time: int) -> int:
        return max(1, math.ceil(time / minutes))

    lag_values = lag.select("window_start", F.col("topic").alias("label"), F.col("lag_seconds").alias("value"))
    letters = dead_letter_counts.groupBy("window_start").agg(F.sum("events").cast("double").alias("value"))
    letter_values = letters.select("window_start", F.lit("all").alias("label"), "value")

    def rule(alert: str, severity: str, limit: float, intervals: int) -> Column:
        return F.struct(
            F.lit(alert).alias("alert"),
            F.lit(severity).alias("severity"),
            F.lit(float(limit)).alias("limit"),
            F.lit(intervals).alias("intervals"),
        )

    lag_rules = F.array(
        rule("ConsumerLagHigh", "warning", LAG_WARNING_SECONDS, lasting(WARNING_FOR_MINUTES)),
        rule("ConsumerLagCritical", "critical", LAG_CRITICAL_SECONDS, lasting(CRITICAL_FOR_MINUTES)),
    )
    letter_rules = F.array(
        rule("DeadLetterRateHigh", "warning", dead_letters_per_minute * minutes, lasting(DEAD_LETTERS_FOR_MINUTES)))
    over = (
        lag_values.select("*", F.inline(lag_rules))
        .unionByName(letter_values.select("*", F.inline(letter_rules)))
        .filter(F.col("value") > F.col("limit"))
    )
    # Each breach counts for its own interval and the following ones that look back on it; a rule fires in
    # a breaching interval for which all the intervals it looks back on count.
    back = F.col("_back")
    later = F.unix_micros("window_start") + back.cast("bigint") * duration_micros(interval)
    return (
        over.withColumn("_back", F.explode(F.sequence(F.lit(0), F.col("intervals") - 1)))
        .groupBy(F.timestamp_micros(later).alias("window_start"), "alert", "severity", "label", "intervals")
        .agg(F.count(F.lit(1)).alias("_breaches"), F.max(F.when(back == 0, F.col("value"))).alias("value"))
        .filter((F.col("_breaches") == F.col("intervals")) & F.col("value").isNotNull())
        .select("window_start", "alert", "severity", "label", "value")
    )


def ingest_watermarks(bronze: DataFrame, watermark_seconds: int = 60, batch_seconds: int = 30) -> DataFrame:
    """The watermark each ingest batch meets: newest event of all earlier batches, less the delay.

    Batches are reduced to one row each, the running maximum is taken inside a day, and only the
    maxima of whole days (one row per day) are carried across days.
    """
    batch = _batch_number(batch_seconds)
    newest = (
        bronze.groupBy(batch.alias("batch"))
        .agg(F.max("event_time").alias("newest"))
        .filter(F.col("batch").isNotNull())
        .withColumn("day", F.floor(F.col("batch") * batch_seconds / 86400))
    )
    earlier_batches = Window.partitionBy("day").orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    earlier_days = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = newest.groupBy("day").agg(F.max("newest").alias("_day_newest"))
    carried = days.select("day", F.max("_day_newest").over(earlier_days).alias("_carried"))
    before = F.greatest(F.max("newest").over(earlier_batches), F.col("_carried"))
    return (
        newest.join(carried, "day")
        .select("batch", (before - F.expr(f"INTERVAL {watermark_seconds} SECONDS")).alias("watermark"))
    )


def _batch_number(batch_seconds: int) -> Column:
    return F.floor(F.unix_seconds("ingest_time") / batch_seconds)


def late_events(bronze: DataFrame, watermark_seconds: int = 60, batch_seconds: int = 30) -> DataFrame:
    """Events per symbol that arrived after the watermark had passed them (batch, over bronze).

    No job runs before the result is asked for. The watermarks, one row for each ingest batch, come out of a shuffle
    whose size tells adaptive execution whether to broadcast them; where it does not, it splits a batch with a
    large share of the rows.
    """
    watermarks = ingest_watermarks(bronze, watermark_seconds, batch_seconds).filter(F.col("watermark").isNotNull())
    rows = bronze.select("symbol", "event_time", _batch_number(batch_seconds).alias("batch"))
    late = rows.join(watermarks, "batch").filter(F.col("event_time") < F.col("watermark"))
    return late.groupBy("symbol").agg(F.count(F.lit(1)).alias("late_events"))
