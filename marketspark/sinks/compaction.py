"""Small-file compaction of a partitioned Parquet table into a new path."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

# Default file size and the assumed stored size of a row.
TARGET_FILE_SIZE_MB = 128
BYTES_PER_ROW = 500

FILES_PER_JOB = 10_000

# A task writes no more files than this, nor more rows than a file of the default size has.
FILES_PER_TASK = 100
ROWS_PER_TASK = TARGET_FILE_SIZE_MB * 1024 * 1024 // BYTES_PER_ROW


def input_files(rows: DataFrame, partition_column: str) -> DataFrame:
    """Rows of each partition value in each input file, and how many of the value are in files before it.

    ``whole`` says that the file holds no rows of another value, so that a row's place in it is its place among them.
    """
    counts = rows.groupBy(partition_column, F.col("_metadata.file_path").alias("_path")).agg(
        F.count(F.lit(1)).alias("held"), F.max("_metadata.row_index").alias("last"))
    before = Window.partitionBy(partition_column).orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        partition_column, "_path", "held", (F.col("last") + 1 == F.col("held")).alias("whole"),
        F.coalesce(F.sum("held").over(before), F.lit(0)).alias("_start"))


def plan_files(inputs: DataFrame, target_file_size_mb: float, partition_column: str) -> DataFrame:
    """Rows of each partition value, the number of files they are to fill, and that of the files they are in."""
    target = target_file_size_mb * 1024 * 1024
    files = F.greatest(F.lit(1), F.floor(F.col("rows") * BYTES_PER_ROW / F.lit(float(target)))).cast("int")
    return inputs.groupBy(partition_column).agg(
        F.sum("held").alias("rows"), F.count(F.lit(1)).alias("inputs"), F.bool_and("whole").alias("whole"),
    ).withColumn("files", files)


def _jobs(plan: list[Row], files_per_job: int) -> Iterator[list[Row]]:
    """Partition values in groups of about so many files. Values of one group differ in files by less than twice,
    and so have files of about the same rows: the share that does not fill a file is spread over like numbers of them."""
    job, size = [], 0
    for row in sorted(plan, key=lambda row: row.files.bit_length()):
        if job and (size + row.files > files_per_job or row.files.bit_length() != job[0].files.bit_length()):
            yield job
            job, size = [], 0
        job.append(row)
        size += row.files
    if job:
        yield job


def _files_per_task(row: Row, most: int) -> int:
    """Neighbouring files of a partition value that one task may write, closing each after ``most`` rows.

    Then only the last of them has fewer rows. It lacks what all of them together lack, which is kept at a quarter.
    """
    spare = most * row.files - row.rows
    bound = max(1, min(FILES_PER_TASK, ROWS_PER_TASK // most))
    return max(1, min(bound, most * row.files // (4 * spare))) if spare else bound


def fingerprint(df: DataFrame) -> DataFrame:
    """One row that is equal for tables with the same rows in any order."""
    row = F.xxhash64(*[F.col(name) for name in sorted(df.columns)])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(row).alias("xor"),
        F.sum(F.pmod(row, F.lit(2**31))).alias("total"),
    )


def compact(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    target_file_size_mb: float = TARGET_FILE_SIZE_MB,
    partition_column: str = "partition_date",
    files_per_job: int = FILES_PER_JOB,
    verify: bool = True,
) -> dict[str, Any]:
    """Rewrite a table with ``max(1, rows * 500 / target)`` files per partition and the same rows.

    Only the plan, one row per partition value, comes to the driver. Each job rewrites some partition
    values whole, about ``files_per_job`` files. The rows of a value are numbered by input file and place
    in it, which a repeated task computes alike, and cut into files of equal numbers of rows. A task writes
    several neighbouring files of a value, and may do so for several values, so that the tasks and what they
    report to the driver are far fewer than the files. What a job broadcasts has a row per partition value
    and input file; with many input files it is joined without. ``verify`` reads both tables once more and
    compares their rows. ``output_path`` must be new.
    """
    if not _absent(spark, output_path):
        raise ValueError(f"{output_path} exists; compact into a new path")
    rows = spark.read.parquet(input_path)
    inputs = input_files(rows, partition_column).persist()
    try:
        plan = plan_files(inputs, target_file_size_mb, partition_column).orderBy(partition_column).collect()
        for job in _jobs(plan, files_per_job):
            _rewrite(rows, inputs, job, partition_column, output_path)
    finally:
        inputs.unpersist()
    if plan and verify:
        written = spark.read.schema(rows.schema).parquet(output_path)
        if fingerprint(written).first() != fingerprint(rows).first():
            raise RuntimeError(f"{output_path} does not hold the rows of {input_path}")
    return {
        "input_path": input_path,
        "output_path": output_path,
        "rows": sum(row.rows for row in plan),
        "files": sum(row.files for row in plan),
    }


def _rewrite(rows: DataFrame, inputs: DataFrame, job: list[Row], partition_column: str, output_path: str) -> None:
    """Writes the partition values of one job."""
    kind = rows.schema[partition_column].dataType
    values = [row[partition_column] for row in job]
    most = max(-(-row.rows // row.files) for row in job)
    each = [_files_per_task(row, most) for row in job]
    shares = [-(-row.files // n) for row, n in zip(job, each)]
    # A task has no two shares of one value: their files would run together.
    tasks = max(*shares, -(-sum(row.files for row in job) // max(each)))
    layout = rows.sparkSession.createDataFrame(
        [(value, row.rows, row.files, n, first) for value, row, n, first in zip(values, job, each, accumulate(shares, initial=0))],
        StructType([
            StructField("_value", kind), StructField("_rows", LongType()), StructField("_files", IntegerType()),
            StructField("_each", IntegerType()), StructField("_first", LongType()),
        ]),
    )
    places = inputs.select(F.col(partition_column).alias("_of"), F.col("_path").alias("_in"), "_start").join(
        F.broadcast(layout), F.col("_of").eqNullSafe(F.col("_value")))
    if sum(row.inputs for row in job) <= FILES_PER_JOB:
        places = F.broadcast(places)
    chosen = F.col(partition_column).isin(*[v for v in values if v is not None])
    if None in values:
        chosen = chosen | F.col(partition_column).isNull()
    place = F.col("_row")
    if not all(row.whole for row in job):
        place = F.row_number().over(Window.partitionBy(partition_column, "_path").orderBy("_row")) - 1
    (
        rows.filter(chosen)
        .select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
        .withColumn("_place", place)
        .join(places, (F.col("_path") == F.col("_in")) & F.col(partition_column).eqNullSafe(F.col("_value")))
        .withColumn("_file", F.expr("(_start + _place) * _files div _rows"))
        .withColumn("_task", F.expr(f"(_first + _file div _each) % {tasks}").cast("int"))
        .repartitionById(tasks, F.col("_task"))
        .select(*rows.columns)
        .write.partitionBy(partition_column)
        .option("maxRecordsPerFile", most)
        .mode("append")
        .parquet(output_path)
    )


def _absent(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def file_counts(df: DataFrame, partition_column: str = "partition_date") -> DataFrame:
    """Rows and files per partition of a table read from Parquet."""
    return df.groupBy(partition_column).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("_metadata.file_path").alias("files")
    )
