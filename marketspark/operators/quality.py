"""Data-quality suites: one aggregate over the table per suite, plus one per uniqueness check."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, FloatType, StringType

from marketspark.functions.rules import instant
from marketspark.schemas import DATE_PATTERN, GOLD, SIDES

# Expectation names used in suites and results.
COLUMN_EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
UNIQUE = "expect_column_values_to_be_unique"
ROW_COUNT = "expect_table_row_count_to_be_between"

# Checks beyond the basic set.
CONDITION = "expect_rows_to_satisfy"
FRESH = "expect_column_max_to_be_recent"
UNIQUE_COMBINATION = "expect_column_combination_to_be_unique"
RELATIONSHIP = "expect_keys_to_exist_in_parent"

SILVER_TRADES = "silver.trades"
GOLD_OHLC = "gold.ohlc"

RESULT_SCHEMA = (
    "position int, expectation string, column string, success boolean, unexpected_count bigint, "
    "unique_count bigint, total_count bigint, row_count bigint, lag_seconds double, note string"
)
_EXTRA_FIELDS = ("unexpected_count", "unique_count", "total_count", "row_count", "lag_seconds", "note")


def _outside(df: DataFrame, column: str, low: Any, high: Any) -> Column:
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < F.lit(low))
    if high is not None:
        outside = outside | (F.col(column) > F.lit(high))
    if isinstance(df.schema[column].dataType, (DoubleType, FloatType)):
        outside = outside & ~F.isnan(column)
    return outside


def _unexpected(df: DataFrame, kind: str, kwargs: dict[str, Any]) -> Column:
    """Condition of a failing row. A missing column reads as NULL in every row."""
    column = kwargs.get("column", "")
    present = column in df.columns
    if kind == NOT_NULL:
        return F.col(column).isNull() if present else F.lit(True)
    if kind == IN_SET:
        values = list(kwargs.get("value_set", []))
        null_allowed = F.lit(None in values)
        if not present:
            return ~null_allowed
        member = F.col(column).isin(*[v for v in values if v is not None])
        return ~F.coalesce(member, null_allowed)
    if kind == BETWEEN:
        if not present:
            return F.lit(False)
        return _outside(df, column, kwargs.get("min_value"), kwargs.get("max_value"))
    if kind == CONDITION:
        return ~F.coalesce(F.expr(kwargs["condition"]), F.lit(bool(kwargs.get("null_passes", False))))
    raise ValueError(kind)


_ROW_KINDS = {NOT_NULL, IN_SET, BETWEEN, CONDITION}


@dataclass(frozen=True)
class Suite:
    """A named list of (expectation, arguments), checked over a whole table on the executors."""

    name: str
    checks: tuple[tuple[str, dict[str, Any]], ...] = ()

    def results(self, df: DataFrame) -> DataFrame:
        """One row per expectation; no rows for a suite without any."""
        measures: list[Column] = [F.count(F.lit(1)).alias("rows")]
        rows: list[Column] = []
        separate: list[DataFrame] = []
        for position, (kind, kwargs) in enumerate(self.checks):
            column = kwargs.get("column")
            measure = f"m{position}"
            if kind in _ROW_KINDS:
                failing = F.count_if(_unexpected(df, kind, kwargs))
                measures.append(failing.alias(measure))
                rows.append(_row(position, kind, column or kwargs.get("condition"), F.col(measure) == 0,
                                 unexpected_count=F.col(measure)))
            elif kind == COLUMN_EXISTS:
                rows.append(_row(position, kind, column, F.lit(column in df.columns) & (F.col("rows") > 0)))
            elif kind == ROW_COUNT:
                low, high = kwargs.get("min_value", 0), kwargs.get("max_value")
                within = F.col("rows") >= low
                if high is not None:
                    within = within & (F.col("rows") <= high)
                rows.append(_row(position, kind, None, within, row_count=F.col("rows")))
            elif kind == FRESH:
                measures.append(F.max(column).alias(measure))
                now = instant(kwargs.get("as_of"))
                lag = (F.unix_micros(now) - F.unix_micros(F.col(measure).cast("timestamp"))) / 1_000_000
                fresh = F.coalesce(lag <= F.lit(kwargs.get("max_lag_seconds", 120)), F.lit(False))
                rows.append(_row(position, kind, column, fresh, lag_seconds=lag))
            elif kind == UNIQUE:
                separate.append(_unique(df, position, column))
            elif kind == UNIQUE_COMBINATION:
                separate.append(_unique_combination(df, position, kwargs))
            elif kind == RELATIONSHIP:
                separate.append(_relationship(df, position, kwargs))
            else:
                rows.append(_row(position, kind, column, F.lit(True),
                                 note=F.lit(f"{kind} is no known expectation and counts as passed")))
        parts = separate
        if rows:
            parts = [df.agg(*measures).select(F.inline(F.array(*rows))), *separate]
        if not parts:
            parts = [df.sparkSession.createDataFrame([], RESULT_SCHEMA)]
        return reduce(DataFrame.unionByName, parts).withColumn("suite", F.lit(self.name))

    def failing_rows(self, df: DataFrame) -> DataFrame:
        """The rows behind the unexpected counts, whole in ``row``, once for each row check they fail; one scan for all checks.

        Checks of the table as a whole (existence, uniqueness, relationships and the like) have no rows here.
        """
        failing = [
            F.when(_unexpected(df, kind, kwargs), F.struct(
                F.lit(position), F.lit(kind), F.lit(kwargs.get("column") or kwargs.get("condition"))))
            for position, (kind, kwargs) in enumerate(self.checks) if kind in _ROW_KINDS
        ]
        failed = F.array_compact(F.array(*failing).cast("array<struct<position:int,expectation:string,column:string>>"))
        return df.select(F.inline(failed), F.struct("*").alias("row"))

    def report(self, df: DataFrame) -> dict[str, Any]:
        """The results as a document. Only they, one row per expectation, come to the driver."""
        began = time.monotonic()
        rows = self.results(df).orderBy("position").collect()
        optional = ("column", *_EXTRA_FIELDS)
        entries = [
            {"expectation": row.expectation, "success": row.success}
            | {name: row[name] for name in optional if row[name] is not None}
            for row in rows
        ]
        # The names of the document's fields.
        return {
            "suite": self.name,
            "success": all(row.success for row in rows),
            "results": entries,
            "duration_seconds": time.monotonic() - began,
            "timestamp": datetime.now(timezone.utc).isoformat(),
        }


def _row(position: int, kind: str, column: str | None, success: Column, **values: Column) -> Column:
    types = dict(item.split() for item in RESULT_SCHEMA.split(", "))
    fields = {
        "position": F.lit(position),
        "expectation": F.lit(kind),
        "column": F.lit(column),
        "success": success,
        **values,
    }
    return F.struct(*[
        fields.get(name, F.lit(None)).cast(kind_).alias(name) for name, kind_ in types.items()
    ])


def _key_hash(column: Column) -> Column:
    return F.xxhash64(column)


def _unique(df: DataFrame, position: int, column: str) -> DataFrame:
    """Distinct values against rows, NULL being one value. Reads and shuffles only this column.

    Texts are counted by their 8-byte hashes first. A hash that only one row has stands for one value; only the rows
    whose hash is repeated, by copies or by chance, are compared as texts, so the count is exact.
    """
    if column not in df.columns:
        counts = df.agg(F.lit(0).alias("values"), F.lit(0).alias("total"))
    elif isinstance(df.schema[column].dataType, (StringType, BinaryType)):
        hashed = df.select(_key_hash(F.col(column)).alias("_hash"), column)
        groups = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("copies"))
        alone = groups.agg(F.count_if(F.col("copies") == 1).alias("values"), F.coalesce(F.sum("copies"), F.lit(0)).alias("total"))
        repeated = hashed.join(groups.filter("copies > 1"), "_hash", "left_semi").select(column).distinct()
        compared = repeated.agg(F.count(F.lit(1)).alias("values"), F.lit(0).cast("bigint").alias("total"))
        counts = alone.unionByName(compared).agg(F.sum("values").alias("values"), F.sum("total").alias("total"))
    else:
        groups = df.groupBy(column).agg(F.count(F.lit(1)).alias("copies"))
        counts = groups.agg(
            F.count(F.lit(1)).alias("values"), F.coalesce(F.sum("copies"), F.lit(0)).alias("total")
        )
    row = _row(position, UNIQUE, column, F.col("values") == F.col("total"),
               unique_count=F.col("values"), total_count=F.col("total"))
    return counts.select(F.inline(F.array(row)))


def repeated_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def _unique_combination(df: DataFrame, position: int, kwargs: dict[str, Any]) -> DataFrame:
    columns = list(kwargs["columns"])
    source = df.dropna(subset=columns) if kwargs.get("ignore_nulls") else df
    count = repeated_keys(source, columns).agg(F.count(F.lit(1)).alias("n"))
    row = _row(position, UNIQUE_COMBINATION, ",".join(columns), F.col("n") == 0, unexpected_count=F.col("n"))
    return count.select(F.inline(F.array(row)))


def orphans(df: DataFrame, parent: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct keys of ``df`` that ``parent`` lacks."""
    return df.select(*columns).distinct().join(parent.select(*columns).distinct(), columns, "left_anti")


def _relationship(df: DataFrame, position: int, kwargs: dict[str, Any]) -> DataFrame:
    columns = list(kwargs["columns"])
    count = orphans(df, kwargs["parent"], columns).agg(F.count(F.lit(1)).alias("n"))
    row = _row(position, RELATIONSHIP, ",".join(columns), F.col("n") == 0, unexpected_count=F.col("n"))
    return count.select(F.inline(F.array(row)))


def failing_rows(df: DataFrame, expectation_type: str, kwargs: dict[str, Any]) -> DataFrame:
    """The rows behind an unexpected count."""
    return df.filter(_unexpected(df, expectation_type, kwargs))


_SILVER_COLUMNS = ("trade_id", "symbol", "price", "quantity", "side", "event_time")
_OHLC_COLUMNS = ("symbol", "open_price", "high_price", "low_price", "close_price")

SILVER_TRADES_SUITE = Suite(SILVER_TRADES, (
    *((COLUMN_EXISTS, {"column": column}) for column in _SILVER_COLUMNS),
    *((NOT_NULL, {"column": column}) for column in ("trade_id", "event_time")),
    (BETWEEN, {"column": "price", "min_value": 0, "max_value": 1_000_000}),
    (BETWEEN, {"column": "quantity", "min_value": 0}),
    (IN_SET, {"column": "side", "value_set": list(SIDES)}),
    (UNIQUE, {"column": "trade_id"}),
))

GOLD_OHLC_SUITE = Suite(GOLD_OHLC, (
    *((COLUMN_EXISTS, {"column": column}) for column in _OHLC_COLUMNS),
    (NOT_NULL, {"column": "symbol"}),
    *((BETWEEN, {"column": column, "min_value": 0}) for column in ("volume", "trade_count")),
))


OHLC_INVARIANTS = (
    "high_price >= low_price",
    "open_price BETWEEN low_price AND high_price",
    "close_price BETWEEN low_price AND high_price",
    "volume >= 0",
    "trade_count >= 0",
    "window_start < window_end",
)


OHLC_INVARIANTS_SUITE = Suite(GOLD_OHLC, tuple((CONDITION, {"condition": condition}) for condition in OHLC_INVARIANTS))


# Measures a gold contract bounds at zero.
GOLD_COUNTS = {
    "ohlc": ["trade_count"],
    "volume_profiles": ["buy_count", "sell_count"],
    "trade_stats": ["trade_count", "trades_per_second"],
}


def gold_contract_suite(dataset: str) -> Suite:
    """What the contract of a gold dataset asks: every field given, counts and rates not negative."""
    return Suite(f"gold.{dataset}", (
        *((NOT_NULL, {"column": column}) for column in GOLD[dataset].fieldNames()),
        *((BETWEEN, {"column": column, "min_value": 0}) for column in GOLD_COUNTS[dataset]),
    ))


def strict_silver_suite(as_of: Any = None, max_lag_seconds: int = 120) -> Suite:
    """What the silver contract asks beyond the basic suite: positive quantity, partition date, freshness."""
    return Suite(SILVER_TRADES, (
        (CONDITION, {"condition": "quantity > 0"}),
        (CONDITION, {"condition": f"CAST(partition_date AS STRING) = date_format(event_time, '{DATE_PATTERN}')"}),
        (FRESH, {"column": "event_time", "as_of": as_of, "max_lag_seconds": max_lag_seconds}),
    ))


# Expectations on each mart, as (type, arguments).
MART_TESTS: dict[str, list[tuple[str, dict[str, Any]]]] = {
    "daily_summary": [
        (NOT_NULL, {"column": "symbol"}),
        (NOT_NULL, {"column": "trade_date"}),
        (NOT_NULL, {"column": "volume"}),
        (BETWEEN, {"column": "volume", "min_value": 0}),
        (NOT_NULL, {"column": "trade_count"}),
        (BETWEEN, {"column": "trade_count", "min_value": 0}),
        (UNIQUE_COMBINATION, {"columns": ["symbol", "trade_date"]}),
    ],
    "symbol_performance": [
        (NOT_NULL, {"column": "symbol"}),
        (BETWEEN, {"column": "volume", "min_value": 0}),
    ],
    "volatility_metrics": [
        (NOT_NULL, {"column": "symbol"}),
        (NOT_NULL, {"column": "trade_date"}),
    ],
    "market_activity": [
        (NOT_NULL, {"column": "trade_date"}),
        (UNIQUE_COMBINATION, {"columns": ["trade_date"], "ignore_nulls": True}),
        (BETWEEN, {"column": "total_volume", "min_value": 0}),
    ],
}


def mart_tests(marts: dict[str, DataFrame]) -> DataFrame:
    """Results of the mart tests, one row per mart and test."""
    known = [name for name in MART_TESTS if name in marts]
    if not known:
        raise ValueError(f"no known mart among {sorted(marts)}")
    parts = [Suite(name, tuple(MART_TESTS[name])).results(marts[name]) for name in known]
    return reduce(DataFrame.unionByName, parts).withColumnRenamed("suite", "mart")


def check_counts(results: DataFrame) -> DataFrame:
    """Passed and failed checks per suite."""
    return results.groupBy("suite").agg(
        F.count_if("success").alias("passed"), F.count_if(~F.col("success")).alias("failed")
    )


SUITES = {suite.name: suite for suite in (SILVER_TRADES_SUITE, GOLD_OHLC_SUITE)}

_WRITTEN = (
    "suite string, success boolean, expectation string, column string, unexpected_count bigint, unique_count bigint, "
    "total_count bigint, row_count bigint, lag_seconds double, note string, duration_seconds double, timestamp string"
)


def validate_table(spark: SparkSession, suite_name: str, path: str, output: str | None = None) -> dict[str, Any]:
    """Run a suite over a stored table and optionally append the whole result document as JSON lines."""
    if suite_name not in SUITES:
        raise ValueError(f"no suite is called {suite_name!r}")
    result = SUITES[suite_name].report(spark.read.parquet(path))
    if output:
        run = {name: result[name] for name in ("suite", "duration_seconds", "timestamp")}
        names = [field.split()[0] for field in _WRITTEN.split(", ")]
        rows = [tuple((entry | run).get(name) for name in names) for entry in result["results"]]
        spark.createDataFrame(rows, _WRITTEN).coalesce(1).write.mode("append").json(output)
    return result


class ValidationFailed(Exception):
    """Raised by ``require`` for a suite that did not pass."""


def require(result: dict[str, Any]) -> dict[str, Any]:
    if not result["success"]:
        failed = [f"{r['expectation']}({r.get('column', '')})" for r in result["results"] if not r["success"]]
        raise ValidationFailed(f"{result['suite']}: {', '.join(failed)}")
    return result
