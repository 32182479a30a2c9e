"""What the operators of this subpackage share: picking columns, working tables, batches of bounded text."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.session import working_path

BATCH_CHARS = 1 << 20


@functools.cache
def _ship(application: str) -> None:
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="marketspark-")) / "marketspark.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    SparkContext.getOrCreate().addPyFile(str(archive))


def with_package(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Sends this package to the executors with the first call of an application.

    Tasks import it by name; a session that was not started with it on their path would fail.
    """

    @functools.wraps(function)
    def call(spark: SparkSession, *arguments: object) -> DataFrame:
        _ship(spark.sparkContext.applicationId)
        return function(spark, *arguments)

    return call


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def picked(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Only the id and the text, as ``doc_id`` and ``text``: other columns cannot clash with results."""
    return df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written as a table in the shared folder and read again, which cuts lineage for good."""
    path = working_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``BATCH_CHARS`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if held and held + size > BATCH_CHARS:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_if_small(df: DataFrame, rows: int = 500_000, size: int = 1 << 26) -> DataFrame:
    """``df`` with a broadcast hint if it has at most so many rows and bytes, which are counted; else as it is.

    For stored tables: they are read to add up their bytes, as JSON, if their rows are few.
    """
    if df.count() > rows:
        return df
    held = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0]
    return F.broadcast(df) if (held or 0) <= size else df


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over the others."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))
