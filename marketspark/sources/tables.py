"""Readers of the stored layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Layout:
    """Where the layers of a lake are stored, under any Hadoop path."""

    root: str

    def _under(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._under("bronze", "trades")

    @property
    def compacted(self) -> str:
        return self._under("bronze", "compacted")

    @property
    def silver(self) -> str:
        return self._under("silver", "trades")

    @property
    def dead_letters(self) -> str:
        return self._under("dead-letter", "trades")

    @property
    def decoded(self) -> str:
        """Messages read and judged once, from which streams of all layers go on."""
        return self._under("decoded", "messages")

    @property
    def late_events(self) -> str:
        """Late rows of each micro-batch by symbol."""
        return self._under("metrics", "late-events")

    def file_bounds(self, layer: str) -> str:
        """The index of the files of ``bronze``, ``silver`` or another layer."""
        return self._under("file-bounds", layer)

    @property
    def fingerprints(self) -> str:
        """What bronze held, day by day, when the layers were last rebuilt from it."""
        return self._under("fingerprints", "bronze")

    @property
    def rejects(self) -> str:
        """Stored trades that a rebuild refused, with the reason."""
        return self._under("rejects", "trades")

    def gold(self, dataset: str, window_duration: str | None = None) -> str:
        """A dataset, or the tree one streaming query keeps for one window size."""
        sizes = [window_duration.replace(" ", "_")] if window_duration else []
        return self._under("gold", dataset, *sizes)

    def mart(self, name: str) -> str:
        return self._under("marts", name)

    @property
    def checkpoints(self) -> str:
        return self._under("checkpoints")


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_gold(spark: SparkSession, dataset: str, path_template: str) -> DataFrame:
    """A gold dataset; ``path_template`` holds ``{dataset}``."""
    return spark.read.parquet(path_template.format(dataset=dataset))


def scan_union_by_name(spark: SparkSession, *paths: str) -> DataFrame:
    """The Parquet trees below the paths, columns matched by name and partition folders read as columns.

    A column that a file or a tree lacks reads as NULL.
    """
    out = None
    for path in paths:
        tree = spark.read.option("mergeSchema", "true").parquet(path)
        out = tree if out is None else out.unionByName(tree, allowMissingColumns=True)
    if out is None:
        raise ValueError("no path given")
    return out
