"""Late rows of a running stream, by symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketspark.sources.tables import Layout


class LateEvents:
    """Counts, for each micro-batch and symbol, the rows and those that the batch's watermark had passed.

    The watermark that a batch meets is the newest event of all batches before it less the delay, in whole
    milliseconds, as Spark moves it. A batch stores that newest event with its counts under its number and takes it
    from the batch before, so a restart goes on where the last run ended, and a batch that runs again replaces its
    own rows. The driver holds one instant; the counts are one small table a batch.
    """

    def __init__(self, spark: SparkSession, layout: Layout, watermark_seconds: int = 60, available_now: bool = False) -> None:
        self.spark = spark
        self.path = layout.late_events
        self.checkpoint = f"{layout.checkpoints}/late-events"
        self.delay = watermark_seconds * 1_000_000
        self.available_now = available_now

    def start(self, trades: DataFrame, trigger_seconds: int = 30) -> StreamingQuery:
        trigger = {"availableNow": True} if self.available_now else {"processingTime": f"{trigger_seconds} seconds"}
        return (
            trades.select("symbol", "event_time").writeStream.foreachBatch(self.count)
            .option("checkpointLocation", self.checkpoint).queryName("late-events").trigger(**trigger).start()
        )

    def count(self, batch: DataFrame, number: int) -> None:
        """One micro-batch: its rows are read once, and reduced to one row for each symbol before the shuffle."""
        spark = batch.sparkSession
        earlier = self._newest_before(spark, number)
        mark = None if earlier is None else earlier // 1000 * 1000 - self.delay
        at = F.unix_micros("event_time")
        late = F.count_if(F.lit(False) if mark is None else at < mark)
        path = f"{self.path}/batch={number}"
        counts = batch.groupBy("symbol").agg(F.count(F.lit(1)).alias("events"), late.alias("late_events"), F.max(at).alias("newest"))
        counts.withColumn("watermark", F.timestamp_micros(F.lit(mark).cast("long"))).write.mode("overwrite").parquet(path)
        newest = [x for x in (earlier, spark.read.parquet(path).agg(F.max("newest")).first()[0]) if x is not None]
        carried = spark.createDataFrame([(max(newest, default=None),)], "newest long")
        carried.write.mode("overwrite").parquet(f"{self.path}-newest/batch={number}")

    def _newest_before(self, spark: SparkSession, number: int) -> int | None:
        """The newest event time of all batches before, in microseconds."""
        return spark.read.parquet(f"{self.path}-newest/batch={number - 1}").first()[0] if number else None


def late_events_by_symbol(spark: SparkSession, layout: Layout) -> DataFrame:
    """All late rows counted so far, by symbol; a symbol without any has 0."""
    return spark.read.parquet(layout.late_events).groupBy("symbol").agg(
        F.sum("events").alias("events"), F.sum("late_events").alias("late_events"))
