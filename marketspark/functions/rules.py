"""Named row rules. Each rule is a boolean column; NULL counts as broken."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketspark.schemas import SIDES

CLOCK_SKEW = "INTERVAL 5 SECONDS"

# Any of the spellings of a UUID that parsers accept: plain, hyphenated, braced or as a URN.
_UUID = r"^(urn:uuid:)?\{?[0-9a-fA-F]{8}-?([0-9a-fA-F]{4}-?){3}[0-9a-fA-F]{12}\}?$"
_ISO_DATE = r"^\s*\d{4}-\d{2}-\d{2}"
_EPOCH = r"^\s*-?\d+(\.\d+)?\s*$"
_CONTRACT_DECIMAL = r"^[+-]?\d{1,10}(\.\d{1,8}0*)?$"
# No sign but plus, and a digit other than zero before any exponent.
_POSITIVE = r"^\s*\+?[0-9.]*[1-9]"
# Beyond this many seconds an epoch number is in milliseconds.
_EPOCH_MILLIS_FROM = 20_000_000_000


def instant(as_of: datetime | str | Column | None) -> Column:
    """The clock used by time rules: the query's own timestamp unless one is given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def business_rules(as_of: datetime | str | Column | None = None, parent: str | None = None) -> dict[str, Column]:
    """The trade rules on top-level columns, or on the fields of the struct column ``parent``."""

    def field(name: str) -> Column:
        return F.col(f"{parent}.{name}" if parent else name)

    return {
        "price_positive": field("price") > 0,
        "quantity_positive": field("quantity") > 0,
        "side_known": field("side").isin(*SIDES),
        "event_time_not_in_future": field("event_time") <= instant(as_of) + F.expr(CLOCK_SKEW),
    }


def all_hold(rules: dict[str, Column]) -> Column:
    """A plain conjunction for filters: NULL drops the row, and each part can reach the scan by itself."""
    return reduce(Column.__and__, rules.values())


def any_broken(rules: dict[str, Column]) -> Column:
    return ~F.coalesce(all_hold(rules), F.lit(False))


def broken(rules: dict[str, Column]) -> Column:
    """Names of the broken rules, in rule order."""
    names = F.concat_ws(",", *[
        F.when(F.coalesce(rule, F.lit(False)), F.lit(None)).otherwise(F.lit(name)) for name, rule in rules.items()
    ])
    return F.when(names == "", F.array().cast("array<string>")).otherwise(F.split(names, ","))


def decimal_value(raw: Column) -> Column:
    return raw.try_cast("decimal(18,8)")


def timestamp_value(raw: Column) -> Column:
    """ISO text or an epoch number; text without an offset is UTC."""
    number = raw.try_cast("decimal(26,6)")
    seconds = F.when(F.abs(number) > _EPOCH_MILLIS_FROM, number / 1000).otherwise(number)
    return (
        F.when(raw.rlike(_ISO_DATE), raw.try_cast("timestamp"))
        .when(raw.rlike(_EPOCH), F.timestamp_micros((seconds * 1_000_000).try_cast("bigint")))
    )


def iso_timestamp(raw: Column) -> Column:
    return F.when(raw.rlike(_ISO_DATE), raw.try_cast("timestamp"))


def fits_contract_decimal(raw: Column) -> Column:
    """At most 18 digits, 8 of them after the point, trailing zeros not counted.

    Plain numbers are judged by their form. Others, such as numbers with an exponent, are read with 28
    decimals and must not change when cut to 8; text with more significant decimals than that is refused.
    """
    wide = raw.try_cast("decimal(38,28)")
    unchanged = (wide == wide.try_cast("decimal(18,8)")) & ~raw.rlike(r"\.\d{28}\d*[1-9]")
    return raw.rlike(_CONTRACT_DECIMAL) | unchanged


def contract_rules(raw: dict[str, Column], parsed: dict[str, Column] | None = None) -> dict[str, Column]:
    """The trade contract on raw text fields, keyed by column name.

    ``parsed`` may give the times already read from ``raw``, so that they are not read again.
    """
    times = {name: timestamp_value(raw[name]) for name in ("event_time", "ingest_time")} | (parsed or {})
    rules = {
        "trade_id_uuid": raw["trade_id"].rlike(_UUID),
        "symbol_present": raw["symbol"].isNotNull(),
    }
    for name in ("price", "quantity"):
        rules[f"{name}_decimal"] = fits_contract_decimal(raw[name])
        rules[f"{name}_positive"] = raw[name].rlike(_POSITIVE)
    rules["side_known"] = raw["side"].isin(*SIDES)
    rules["event_time_timestamp"] = times["event_time"].isNotNull()
    rules["ingest_time_timestamp"] = raw["ingest_time"].isNull() | times["ingest_time"].isNotNull()
    rules["schema_version_integer"] = (
        raw["schema_version"].isNull() | raw["schema_version"].try_cast("int").isNotNull()
    )
    return rules
