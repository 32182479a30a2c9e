"""Layer sinks: append-only Parquet by date (bronze, gold) and by date and symbol (silver).

A batch frame is appended at once; a streaming frame starts a query with a checkpoint of its own.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketspark.operators.silver import enrich_with_processing_metadata, with_partition_date
from marketspark.schemas import GOLD, conform
from marketspark.session import ROCKSDB_STATE_STORE

ROWS_PER_FILE = 5_000_000
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


_STATE_STORE_LOCK = threading.Lock()


def _writers(spark: SparkSession) -> int:
    return max(4, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)


class StorageWriter:
    """``replace`` lets a batch frame take the place of what its path holds; without it the rows are added.

    ``available_now`` makes the streaming sinks take what is there and stop, instead of running on.

    ``state_store`` is the provider of the started queries; the default keeps state on disk, off the JVM
    heap, since deduplication holds every trade until the watermark passes it.
    """

    def __init__(
        self,
        spark: SparkSession,
        checkpoint_base: str,
        available_now: bool = False,
        state_store: str = ROCKSDB_STATE_STORE,
        replace: bool = False,
    ) -> None:
        self.spark = spark
        self.checkpoint_base = checkpoint_base.rstrip("/")
        self.available_now = available_now
        self.state_store = state_store
        self.replace = replace

    def write_bronze(self, df: DataFrame, path: str, trigger_seconds: int = 30) -> StreamingQuery | None:
        return self._append(with_partition_date(df), path, "bronze", ["partition_date"], trigger_seconds)

    def write_silver(
        self, df: DataFrame, path: str, trigger_seconds: int = 30, writers_per_partition: int | None = None
    ) -> StreamingQuery | None:
        """``writers_per_partition`` tasks share a date and symbol in each micro-batch, a quarter of the
        shuffle width unless given: a symbol with much of the traffic then has a share of the cluster."""
        writers_per_partition = writers_per_partition or _writers(self.spark)
        enriched = enrich_with_processing_metadata(df)
        keys = ["partition_date", "symbol"]
        if df.isStreaming:
            writer = F.pmod(F.xxhash64("trade_id", "event_time"), F.lit(writers_per_partition))
            enriched = enriched.repartition(*keys, writer)
        return self._append(enriched, path, "silver", keys, trigger_seconds)

    def write_gold(
        self,
        df: DataFrame,
        dataset: str,
        path_template: str,
        trigger_seconds: int = 60,
        checkpoint: str | None = None,
        writers_per_partition: int = 4,
    ) -> StreamingQuery | None:
        """Conforms to the dataset's contract. The partition is the day of the window's end.

        A streaming query owns its path, so streams of several window sizes need a path and checkpoint each.
        """
        golden = with_partition_date(conform(df, GOLD[dataset]), "window_end")
        if df.isStreaming:
            writer = F.pmod(F.xxhash64("symbol", "window_start"), F.lit(writers_per_partition))
            golden = golden.repartition("partition_date", writer)
        path = path_template.format(dataset=dataset)
        return self._append(golden, path, checkpoint or f"gold/{dataset}", ["partition_date"], trigger_seconds)

    def write_dead_letters(self, df: DataFrame, path: str, trigger_seconds: int = 30) -> StreamingQuery | None:
        return self._append(df, path, "dead-letter", ["failure_reason"], trigger_seconds)

    def write_decoded(self, df: DataFrame, path: str, trigger_seconds: int = 30) -> StreamingQuery | None:
        """Decoded messages by outcome, so that streams of accepted and of refused ones read their own files. The raw
        bytes of accepted ones are left out."""
        refused = F.col("failure_reason").isNotNull()
        kept = df.withColumns({"value": F.when(refused, F.col("value")), "outcome": F.when(refused, "refused").otherwise("accepted")})
        return self._append(kept, path, "decoded", ["outcome"], trigger_seconds)

    def _append(
        self, df: DataFrame, path: str, name: str, partitions: Sequence[str], trigger_seconds: int
    ) -> StreamingQuery | None:
        if not df.isStreaming:
            # Rebalancing brings a partition's rows together and splits the large ones by size.
            balanced = df.hint("rebalance", *partitions)
            balanced.write.option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(*partitions).mode(
                "overwrite" if self.replace else "append").parquet(path)
            return None
        trigger = {"availableNow": True} if self.available_now else {"processingTime": f"{trigger_seconds} seconds"}
        stream = (
            df.writeStream.outputMode("append")
            .format("parquet")
            .option("path", path)
            .option("maxRecordsPerFile", ROWS_PER_FILE)
            .option("checkpointLocation", f"{self.checkpoint_base}/{name}")
            .partitionBy(*partitions)
            .queryName(f"{name}-{uuid.uuid4().hex[:8]}")
            .trigger(**trigger)
        )
        # A query copies the session's settings when it starts; two threads must not mix theirs.
        with _STATE_STORE_LOCK:
            before = self.spark.conf.get(STATE_STORE)
            self.spark.conf.set(STATE_STORE, self.state_store)
            try:
                return stream.start()
            finally:
                self.spark.conf.set(STATE_STORE, before)
