"""Bronze to silver: normalise, check, split, deduplicate, enrich, and route what fails."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from marketspark.functions.durations import duration_text
from marketspark.functions.rules import all_hold, any_broken, broken, business_rules, contract_rules
from marketspark.operators.codec import computed_once, read_envelopes
from marketspark.schemas import DATE_PATTERN, PIPELINE_VERSION, TRADE_VERSIONS, Versions, known_version, newest
from marketspark.session import working_path

# Reasons stored with dead letters.
UNREADABLE = "deserialization_error"
UNKNOWN_VERSION = "unknown_schema_version"
CONTRACT_BROKEN = "schema_validation_error"
RULE_BROKEN = "business_rule_violation"

Clock = datetime | str | Column | None

# Invalid rows of so many ids at most are broadcast: an id is a UUID of 36 bytes.
SUSPECTS_BROADCAST = 500_000


def normalize_fields(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "symbol": F.upper(F.trim("symbol")),
        "side": F.upper(F.trim("side")),
        "exchange": F.lower(F.trim("exchange")),
    })


def validate_business_rules(df: DataFrame, as_of: Clock = None) -> DataFrame:
    return df.filter(all_hold(business_rules(as_of)))


def flag_business_rules(df: DataFrame, as_of: Clock = None) -> DataFrame:
    """Every row, with the names of the rules it breaks in ``failed_rules``."""
    return df.withColumn("failed_rules", broken(business_rules(as_of)))


def filter_invalid_events(df: DataFrame, as_of: Clock = None) -> tuple[DataFrame, DataFrame]:
    """Valid and invalid rows. Each row is judged on its own, so this holds for streams as well."""
    rules = business_rules(as_of)
    return df.filter(all_hold(rules)), df.filter(any_broken(rules))


def anti_join_invalid(df: DataFrame, as_of: Clock = None) -> DataFrame:
    """Rows whose trade id belongs to no valid row (batch).

    A valid row with an id always finds itself, so only invalid rows and rows without id can remain. One pass
    stores them in the shared folder; their number decides how the other pass, over the ids of valid rows, meets
    them. Few ids of invalid rows are broadcast and pick the valid rows that share one. Of many, each task first
    reduces its rows to one for each id with whether any is valid, and only ids that have both kinds go on.
    """
    rules = business_rules(as_of)
    spark = df.sparkSession
    path = working_path(spark, "suspects")
    df.filter(any_broken(rules) | F.col("trade_id").isNull()).write.parquet(path)
    suspects = spark.read.schema(df.schema).parquet(path)
    identified = suspects.filter(F.col("trade_id").isNotNull())
    valid = df.filter(all_hold(rules) & F.col("trade_id").isNotNull()).select("trade_id", F.lit(True).alias("_valid"))
    if identified.count() <= SUSPECTS_BROADCAST:
        cleared = valid.join(F.broadcast(identified.select("trade_id").distinct()), "trade_id", "left_semi").select("trade_id").distinct()
    else:
        both = valid.unionByName(identified.select("trade_id", F.lit(False).alias("_valid")))
        cleared = both.groupBy("trade_id").agg(F.bool_or("_valid").alias("_any"), F.bool_and("_valid").alias("_all")).filter(
            "_any and not _all").select("trade_id")
    unmatched = identified.join(cleared, "trade_id", "left_anti").select(*df.columns)
    return unmatched.unionByName(suspects.filter(F.col("trade_id").isNull()).select(*df.columns))


def _tie_break(df: DataFrame, used: set[str]) -> list[str]:
    """The remaining sortable columns: rows equal in all of them are interchangeable."""
    return [f.name for f in df.schema.fields if f.name not in used and isinstance(f.dataType, AtomicType)]


def deduplicate_by_trade_id(df: DataFrame) -> DataFrame:
    """One row per trade id: latest ingest time, then latest event time, then a fixed order (batch).

    Rows without id form one group. Spark limits each group to its first row before the shuffle, so
    a heavily repeated id sends one row per task.
    """
    first = [name for name in ("ingest_time", "event_time") if name in df.columns]
    order = first + _tie_break(df, {"trade_id", *first})
    latest = Window.partitionBy("trade_id").orderBy(*[F.col(name).desc_nulls_last() for name in order])
    return df.withColumn("_position", F.row_number().over(latest)).filter("_position = 1").drop("_position")


def deduplicate_stream(df: DataFrame, keep: str = "latest") -> DataFrame:
    """Streaming form over copies of one event (same id and event time), within the watermark.

    ``latest`` emits the copy with the latest ingest time once the watermark passes the event;
    ``first`` emits the first copy at once. Copies with another event time are merged by
    ``deduplicate_stream_by_id``, which holds its state for longer.
    """
    keys = ["trade_id", "event_time"]
    if keep == "first":
        return df.dropDuplicatesWithinWatermark(keys)
    if keep != "latest":
        raise ValueError(f"unknown keep {keep!r}")
    rest = [name for name in df.columns if name not in keys]
    order = F.struct("ingest_time", *_tie_break(df, {*keys, "ingest_time"}))
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), order).alias("_latest"))
        .select(*[F.col(n) if n in keys else F.col(f"_latest.{n}").alias(n) for n in df.columns])
    )


def deduplicate_stream_by_id(df: DataFrame, horizon_seconds: int = 300) -> DataFrame:
    """One row per trade id on a stream, whatever event times its copies have: the one that ``deduplicate_by_trade_id``
    keeps.

    Copies are merged while no more than ``horizon_seconds`` of event time lie between one and the next; state is
    kept for so long past the newest copy, and then the row is emitted once. Of the copies of a later session the
    rebuild from bronze keeps one. Rows without id form one group, as in the batch form.
    """
    rest = [name for name in df.columns if name != "trade_id"]
    first = [name for name in ("ingest_time", "event_time") if name in rest]
    order = F.struct(*first, *_tie_break(df, {"trade_id", *first}))
    session = F.session_window("event_time", duration_text(horizon_seconds)).alias("_session")
    return (
        df.groupBy("trade_id", session)
        .agg(F.max_by(F.struct(*rest), order).alias("_latest"))
        .select(*[F.col(n) if n == "trade_id" else F.col(f"_latest.{n}").alias(n) for n in df.columns])
    )


def with_partition_date(df: DataFrame, time_column: str = "event_time") -> DataFrame:
    return df.withColumn("partition_date", F.date_format(time_column, DATE_PATTERN))


def enrich_with_processing_metadata(df: DataFrame, version: str = PIPELINE_VERSION) -> DataFrame:
    stamped = df.withColumns({
        "processing_timestamp": F.current_timestamp(),
        "pipeline_version": F.lit(version),
    })
    return with_partition_date(stamped)


def to_silver(trades: DataFrame, as_of: Clock = None) -> DataFrame:
    """Batch silver from bronze trades: normalised, valid, one row per trade id, enriched."""
    valid = validate_business_rules(normalize_fields(trades), as_of)
    return enrich_with_processing_metadata(deduplicate_by_trade_id(valid))


def split_by_version(df: DataFrame, versions: Versions = TRADE_VERSIONS) -> tuple[DataFrame, DataFrame]:
    """Rows with a registered schema version, and the others with their failure reason."""
    known = known_version(F.col("schema_version"), versions)
    return df.filter(known), df.filter(~known).withColumn("failure_reason", F.lit(UNKNOWN_VERSION))


def bronze_rows(topic_rows: DataFrame, versions: Versions = TRADE_VERSIONS) -> DataFrame:
    """Readable messages as trades, with the contract rules that their text breaks in ``contract_failures``.

    Bronze keeps that judgement because typed columns no longer show it: a price is rounded to its type.
    """
    rows = read_envelopes(topic_rows, versions).filter("readable")
    raw = {name: F.col(f"raw.{name}") for name in newest(versions).fieldNames()}
    parsed = {name: F.col(f"trade.{name}") for name in ("event_time", "ingest_time")}
    failures = F.concat_ws(",", broken(contract_rules(raw, parsed)))
    return computed_once(rows, F.struct("trade", failures.alias("contract_failures")), "_row").select(
        "_row.trade.*", "_row.contract_failures")


def judge(trades: DataFrame, as_of: Clock = None, versions: Versions = TRADE_VERSIONS) -> DataFrame:
    """Stored trades with ``failure_reason`` (NULL when accepted) and ``failed_rules``: the stages of ``triage``
    that follow reading. Trades stored without ``contract_failures`` are not held to the contract again."""
    business = broken(business_rules(as_of))
    contract = F.array().cast("array<string>")
    if "contract_failures" in trades.columns:
        stored = F.coalesce("contract_failures", F.lit(""))
        contract = F.when(stored == "", contract).otherwise(F.split(stored, ","))
    reason, failed = _first_failure(F.lit(True), known_version(F.col("schema_version"), versions), contract, business)
    kept = [F.col(name) for name in trades.columns if name != "contract_failures"]
    return trades.select(*kept, reason.alias("failure_reason"), failed.alias("failed_rules"))


def _first_failure(readable: Column, known: Column, contract: Column, business: Column) -> tuple[Column, Column]:
    """The reason of the first stage that fails, and its broken rules."""
    reason = (
        F.when(~readable, UNREADABLE)
        .when(~known, UNKNOWN_VERSION)
        .when(F.size(contract) > 0, CONTRACT_BROKEN)
        .when(F.size(business) > 0, RULE_BROKEN)
    )
    failed = F.when(reason == CONTRACT_BROKEN, contract).when(reason == RULE_BROKEN, business)
    return reason, F.coalesce(failed, F.array().cast("array<string>"))


def decoded_rows(topic_rows: DataFrame, as_of: Clock = None, versions: Versions = TRADE_VERSIONS) -> DataFrame:
    """``triage`` with the contract rules that a message's text breaks in ``contract_failures``, as bronze keeps them.

    All that any layer needs of a message: stored once, it spares the layers from parsing the text again.
    """
    rows = read_envelopes(topic_rows, versions)
    raw = {name: F.col(f"raw.{name}") for name in newest(versions).fieldNames()}
    parsed = {name: F.col(f"trade.{name}") for name in ("event_time", "ingest_time")}
    known = known_version(F.col("trade.schema_version"), versions)
    judged = rows.withColumns({
        "_contract": broken(contract_rules(raw, parsed)),
        "_business": broken(business_rules(as_of, parent="trade")),
    })
    reason, failed = _first_failure(F.col("readable"), known, F.col("_contract"), F.col("_business"))
    outcome = F.struct(
        "trade", "readable", reason.alias("failure_reason"), failed.alias("failed_rules"),
        F.concat_ws(",", "_contract").alias("contract_failures"))
    return computed_once(judged, outcome, "_outcome").select(*topic_rows.columns, "_outcome.*")


def triage(topic_rows: DataFrame, as_of: Clock = None, versions: Versions = TRADE_VERSIONS) -> DataFrame:
    """Topic rows with the decoded ``trade``, ``failure_reason`` (NULL when accepted) and ``failed_rules``.

    The first stage that fails names the reason: reading, schema version, trade contract, business rules.
    """
    return decoded_rows(topic_rows, as_of, versions).drop("contract_failures")


def bronze_of(decoded: DataFrame) -> DataFrame:
    """The rows of ``bronze_rows`` from decoded messages."""
    return decoded.filter("readable").select("trade.*", "contract_failures")


def accepted(triaged: DataFrame) -> DataFrame:
    return triaged.filter(F.col("failure_reason").isNull()).select("trade.*")


def dead_letters(triaged: DataFrame) -> DataFrame:
    """The untouched message with the reason and the broken rules."""
    kept = [c for c in triaged.columns if c not in ("trade", "readable", "contract_failures")]
    return triaged.filter(F.col("failure_reason").isNotNull()).select(*kept)


def dead_letter_messages(letters: DataFrame, topic: str) -> DataFrame:
    """Dead letters as topic rows: raw bytes, and the failure in message headers."""

    def header(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("key"), F.encode(value, "UTF-8").alias("value"))

    return letters.select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        F.array(
            header("failure_reason", F.col("failure_reason")),
            header("failed_rules", F.concat_ws(",", "failed_rules")),
        ).alias("headers"),
    )


def invalid_count(invalid: DataFrame) -> DataFrame:
    return invalid.agg(F.count(F.lit(1)).alias("invalid_count"))


def count_invalid_events(df: DataFrame) -> int:
    return invalid_count(df).first()[0]


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that deduplication drops, in one pass: all rows less the distinct ids, NULL being one id."""
    ids = df.groupBy("trade_id").agg(F.count(F.lit(1)).alias("copies"))
    return ids.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_dropped"))


def count_duplicates_dropped(original: DataFrame, deduplicated: DataFrame | None = None) -> int:
    """Number of rows deduplication drops from ``original``.

    With the deduplicated rows given, the difference of both counts, taken in a single job.
    """
    if deduplicated is None:
        return duplicate_count(original).first()[0]
    sides = original.select(F.lit(1).alias("n")).unionAll(deduplicated.select(F.lit(-1).alias("n")))
    return sides.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
