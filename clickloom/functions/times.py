"""Date and time expressions. The session time zone decides; jobs run it at UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The text formats of the data model.
DAY_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_KEY_FORMAT = "yyyyMMdd"
MINUTE_FORMAT = "yyyyMMddHHmm"
HOUR_KEY_FORMAT = "yyyy-MM-dd_HH"
ACCESS_LOG_FORMAT = "dd/MM/yyyy:HH:mm:ss"

# One H reads both `5:03:07` and `05:03:07`.
LENIENT_TIME_FORMAT = "yyyy-MM-dd H:mm:ss"


def parse_time(col: Column) -> Column:
    """Text to timestamp, null where it does not parse."""
    return F.try_to_timestamp(col, F.lit(LENIENT_TIME_FORMAT))


def parse_day_key(col: Column) -> Column:
    return F.try_to_date(col, DAY_KEY_FORMAT)


def parse_access_time(col: Column) -> Column:
    return F.try_to_timestamp(col, F.lit(ACCESS_LOG_FORMAT))


def day_text(col: Column) -> Column:
    return F.date_format(col, DAY_FORMAT)


def time_text(col: Column) -> Column:
    return F.date_format(col, TIME_FORMAT)


def day_key(col: Column) -> Column:
    return F.date_format(col, DAY_KEY_FORMAT)


def minute_text(col: Column) -> Column:
    return F.date_format(col, MINUTE_FORMAT)


def hour_key(col: Column) -> Column:
    """`yyyy-MM-dd_HH`, the key of the hourly counts."""
    return F.date_format(col, HOUR_KEY_FORMAT)


def before(a: Column, b: Column) -> Column:
    return a < b


def after(a: Column, b: Column) -> Column:
    return a > b


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole seconds from `earlier` to `later`, cut towards zero."""
    millis = F.unix_millis(later) - F.unix_millis(earlier)
    return ((millis - F.sign(millis).cast("bigint") * F.pmod(F.abs(millis), F.lit(1000))) / 1000).cast("bigint")


def today() -> Column:
    return day_text(F.current_date())


def yesterday() -> Column:
    return day_text(F.date_sub(F.current_date(), 1))


def from_epoch_seconds(col: Column) -> Column:
    return F.timestamp_seconds(col)


def from_epoch_millis(col: Column) -> Column:
    """Epoch milliseconds, number or text, to timestamp; null where it is no number."""
    return F.timestamp_millis(col.try_cast("bigint"))


def as_timestamp(df: DataFrame, name: str) -> Column:
    """The column as a zoned timestamp, whatever of text or timestamp it is stored as."""
    kind = df.schema[name].dataType.typeName()
    return parse_time(F.col(name)) if kind == "string" else F.col(name).cast("timestamp")


def as_text(df: DataFrame, name: str) -> Column:
    """The column as time text; text stays as it is."""
    kind = df.schema[name].dataType.typeName()
    return F.col(name) if kind == "string" else time_text(F.col(name))
