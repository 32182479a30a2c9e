"""An index of a stored layer's files: lowest and highest event time of each file and symbol.

Parquet footers hold the same bounds, but every footer has to be opened to read them, and partition folders are no
bound where rows are misfiled. The index is one small table beside the layer. It may be behind: a file it does not
know is read, and one that is gone is passed over, so that results do not depend on when it was refreshed.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketspark.plans.serving import TRADES_DEFAULT, checked_limit, newest_first

BOUNDS = "file string, symbol string, lowest timestamp, highest timestamp, dated bigint, rows bigint"
# Beyond so many files the layer is scanned with a bound on the event time, instead of being named file by file.
MOST_FILES = 10_000


def _file() -> Column:
    return F.col("_metadata.file_path").alias("file")


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """The files of a layer, listed and not opened."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return listing.load(path).select(_file())


def file_bounds(spark: SparkSession, index_path: str) -> DataFrame:
    if not _exists(spark, index_path):
        return spark.createDataFrame([], BOUNDS)
    return spark.read.schema(BOUNDS).parquet(index_path)


def _named(files: list[str]) -> list[str]:
    """Names as the reader takes them: decoded, with marks of patterns escaped."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(name)) for name in files]


def _read_files(spark: SparkSession, path: str, schema: StructType, files: list[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*_named(files))


def refresh_file_bounds(spark: SparkSession, path: str, index_path: str) -> int:
    """Add the files that the index does not know, which alone are read; returns their number."""
    new = [row.file for row in files_of(spark, path).join(file_bounds(spark, index_path).select("file"), "file", "left_anti").collect()]
    schema = spark.read.parquet(path).schema if new else None
    for at in range(0, len(new), MOST_FILES):
        rows = _read_files(spark, path, schema, new[at:at + MOST_FILES])
        bounds = rows.select(_file(), "symbol", "event_time").groupBy("file", "symbol").agg(
            F.min("event_time").alias("lowest"), F.max("event_time").alias("highest"),
            F.count("event_time").alias("dated"), F.count(F.lit(1)).alias("rows"))
        bounds.write.mode("append").parquet(index_path)
    return len(new)


def latest_trades_indexed(
    spark: SparkSession, path: str, index_path: str, limit: int = TRADES_DEFAULT, symbol: str | None = None,
) -> DataFrame:
    """``latest_trades`` (``latest_trades_of`` with ``symbol``) of a stored layer, from the files that can hold them.

    The files of highest lower bound that hold ``limit`` dated rows together, at most ``limit`` of them, give an event
    time that every wanted row reaches; files whose highest event time is before it are not opened. With fewer rows
    than ``limit`` every file counts, for rows without event time too. The driver holds file names alone.
    """
    checked_limit(limit)
    files = files_of(spark, path)
    bounds = file_bounds(spark, index_path)
    known = bounds.join(files, "file", "left_semi")
    if symbol is not None:
        known = known.filter(F.col("symbol") == symbol.upper())
    held, since = 0, None
    for row in known.filter("dated > 0").orderBy(F.col("lowest").desc()).select(F.unix_micros("lowest").alias("at"), "dated").limit(limit).collect():
        held += row.dated
        if held >= limit:
            since = F.timestamp_micros(F.lit(row.at))
            break
    reaching = known if since is None else known.filter(F.col("highest") >= since)
    unknown = files.join(bounds.select("file"), "file", "left_anti")
    chosen = reaching.select("file").distinct().unionByName(unknown)
    names = [row.file for row in chosen.limit(MOST_FILES + 1).collect()]
    layer = spark.read.parquet(path)
    trades = layer if len(names) > MOST_FILES else _read_files(spark, path, layer.schema, names)
    if since is not None:
        trades = trades.filter(F.col("event_time") >= since)
    return newest_first(trades if symbol is None else trades.filter(F.col("symbol") == symbol.upper()), limit)
