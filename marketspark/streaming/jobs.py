"""The streaming jobs: topic to bronze and dead letters, bronze rows to silver, silver trades to gold."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from marketspark.operators.gold import AGGREGATES, apply_watermark
from marketspark.operators.silver import (
    accepted,
    bronze_of,
    bronze_rows,
    dead_letter_messages,
    dead_letters,
    decoded_rows,
    deduplicate_stream,
    deduplicate_stream_by_id,
    enrich_with_processing_metadata,
    normalize_fields,
    triage,
    validate_business_rules,
)
from marketspark.schemas import DEAD_LETTER_TOPIC
from marketspark.sinks.writers import StorageWriter
from marketspark.sources.tables import Layout, scan_union_by_name
from marketspark.sources.topics import publish
from marketspark.streaming.late import LateEvents
from marketspark.streaming.progress import observe_stages


class TradeStreams:
    """Queries over one source of topic rows. Each has its own checkpoint and resumes from it.

    With ``decode_once`` one query reads and judges the messages and stores what it found; bronze, dead letters and
    silver go on from its files, and gold from the files of silver, so that no message is parsed and no trade
    deduplicated twice. Spark's file sink lists what each batch committed, so a batch that runs again adds no row.
    Else every query reads the source by itself and none waits for another's files.
    """

    def __init__(
        self,
        spark: SparkSession,
        source: DataFrame,
        layout: Layout,
        watermark_seconds: int = 60,
        available_now: bool = False,
        as_of: datetime | str | Column | None = None,
        publishing: dict[str, str] | None = None,
        decode_once: bool = False,
        dedup_horizon_seconds: int | None = None,
    ) -> None:
        self.spark = spark
        self.source = source
        self.layout = layout
        self.watermark_seconds = watermark_seconds
        self.as_of = as_of
        self.publishing = publishing
        self.decode_once = decode_once
        self.dedup_horizon_seconds = dedup_horizon_seconds
        self.writer = StorageWriter(spark, layout.checkpoints, available_now)

    def decoded(self) -> StreamingQuery:
        """Every message, read and judged, with the counts of its stages among the query's observed metrics."""
        return self.writer.write_decoded(observe_stages(decoded_rows(self.source, self.as_of)), self.layout.decoded)

    def _judged(self) -> DataFrame:
        if not self.decode_once:
            return triage(self.source, self.as_of)
        schema = decoded_rows(self.source, self.as_of).schema.add("outcome", "string")
        return self._files(self.layout.decoded, schema).drop("outcome")

    def _files(self, path: str, schema: StructType) -> DataFrame:
        """What another query writes to ``path``, as a stream; the folder may be empty yet."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(target)
        # Without the metadata of columns, of which a watermark that another query has set is part.
        plain = StructType([StructField(f.name, f.dataType) for f in schema.fields])
        return self.spark.readStream.schema(plain).parquet(path)

    def bronze(self) -> StreamingQuery:
        """Every readable message, as it came, with the contract rules its text breaks."""
        rows = bronze_of(self._judged()) if self.decode_once else bronze_rows(self.source)
        return self.writer.write_bronze(rows, self.layout.bronze)

    def dead_letters(self) -> StreamingQuery:
        """Every message that some stage refuses, with its raw bytes: to the dead-letter topic where
        ``publishing`` gives its options, else to a table."""
        letters = dead_letters(self._judged())
        if self.publishing:
            return publish(
                dead_letter_messages(letters, DEAD_LETTER_TOPIC), self.publishing, f"{self.layout.checkpoints}/dead-letter-topic")
        return self.writer.write_dead_letters(letters, self.layout.dead_letters)

    def valid_trades(self) -> DataFrame:
        """Accepted trades, normalised, with the watermark that all later stages share."""
        trades = validate_business_rules(normalize_fields(accepted(self._judged())), self.as_of)
        return apply_watermark(trades, self.watermark_seconds)

    def _deduplicated(self, keep: str = "latest") -> DataFrame:
        if self.dedup_horizon_seconds is not None:
            return deduplicate_stream_by_id(self.valid_trades(), self.dedup_horizon_seconds)
        return deduplicate_stream(self.valid_trades(), keep)

    def silver(self, keep: str = "latest") -> StreamingQuery:
        """One row per trade id within ``dedup_horizon_seconds`` where given, else per trade id and event time."""
        return self.writer.write_silver(self._deduplicated(keep), self.layout.silver)

    def late_events(self) -> StreamingQuery:
        """Rows of each micro-batch, and those its watermark had passed, by symbol."""
        return LateEvents(self.spark, self.layout, self.watermark_seconds, self.writer.available_now).start(
            normalize_fields(accepted(self._judged())))

    def gold(self, dataset: str, window_duration: str = "1 minute", deduplicate: bool = True) -> StreamingQuery:
        """Windows of a dataset, appended as the watermark closes them; one query per window size."""
        if self.decode_once and deduplicate:
            schema = enrich_with_processing_metadata(self._deduplicated()).schema
            trades = apply_watermark(self._files(self.layout.silver, schema), self.watermark_seconds)
        else:
            trades = self.valid_trades()
            if deduplicate:
                trades = deduplicate_stream(trades)
        windows = AGGREGATES[dataset](trades, window_duration, self.watermark_seconds)
        path = self.layout.gold("{dataset}", window_duration)
        return self.writer.write_gold(
            windows, dataset, path, checkpoint=path.format(dataset=dataset).removeprefix(self.layout.root)
        )

    def read_gold(self, dataset: str, window_durations: Sequence[str] = ("1 minute",)) -> DataFrame:
        """What the gold queries of a dataset have committed, all sizes together."""
        return scan_union_by_name(self.spark, *[self.layout.gold(dataset, d) for d in window_durations])

    def run(
        self, datasets: Sequence[str] = (), window_durations: Sequence[str] = ("1 minute",), timeout: int | None = None
    ) -> list[StreamingQuery]:
        """Start bronze, dead letters, silver and the asked gold datasets; return when one of them ends.

        Streams that take what is there and stop run one after the other where one reads what another wrote.
        """
        layers = [self.bronze, self.dead_letters, self.silver]
        golden = [partial(self.gold, dataset, duration) for dataset in datasets for duration in window_durations]
        rounds = [[self.decoded], layers, golden] if self.decode_once else [layers + golden]
        queries = []
        for starts in rounds:
            started = [start() for start in starts]
            queries += started
            if self.writer.available_now:
                for query in started:
                    query.awaitTermination(timeout)
        if not self.writer.available_now:
            self.spark.streams.awaitAnyTermination(timeout)
        return queries
