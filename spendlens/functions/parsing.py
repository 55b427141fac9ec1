"""Column expressions that read the loosely typed fields of the raw documents.

Every one gives null, never an error, on a value it cannot read.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The printed date form is "E MMM dd HH:mm:ss Z yyyy", with the zone either
# a name or an offset. Spark has no parser for E, so the weekday prefix is cut off.
PRINTED_DATE_PATTERNS = ["MMM d HH:mm:ss z yyyy", "MMM d HH:mm:ss xx yyyy"]
WEEKDAY_PREFIX = r"^\s*\p{Alpha}+\s+"

# The years 1 to 9999, which a timestamp holds, in milliseconds.
MIN_EPOCH_MS = -62135596800000
MAX_EPOCH_MS = 253402300799999


def ntz_literal(moment: datetime) -> Column:
    """A TIMESTAMP_NTZ literal; unlike F.lit it does not pass through a time zone."""
    if moment.tzinfo is not None:
        raise ValueError("window bounds are UTC wall-clock times without a zone")
    return F.expr(f"TIMESTAMP_NTZ'{moment.isoformat(sep=' ', timespec='microseconds')}'")


def _since_epoch(seconds: Column) -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )


def utc(instant: Column) -> Column:
    """The UTC wall-clock time of a zoned timestamp, whatever the session time zone."""
    return _since_epoch(F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1000000))


def printed_date(text: Column) -> Column:
    """``Thu Jan 11 00:00:05 UTC 2024`` -> 2024-01-11 00:00:05 UTC."""
    rest = F.regexp_replace(text, WEEKDAY_PREFIX, "")
    weekday = text.rlike(WEEKDAY_PREFIX)
    parsed = F.coalesce(*[F.try_to_timestamp(rest, F.lit(p)) for p in PRINTED_DATE_PATTERNS])
    return F.when(weekday, utc(parsed))


def epoch_ms(value: Column) -> Column:
    """Epoch milliseconds, as a number or as its text (``1.4204124E12``)."""
    millis = value.try_cast("double").try_cast("bigint")
    in_range = millis.between(F.lit(MIN_EPOCH_MS), F.lit(MAX_EPOCH_MS))
    return F.when(in_range, _since_epoch(millis.cast("decimal(20,0)") / F.lit(1000)))


def any_time(value: Column, data_type: T.DataType) -> Column:
    """Read a time field of any form found in the inputs as UTC TIMESTAMP_NTZ."""
    if isinstance(data_type, T.TimestampNTZType):
        return value
    if isinstance(data_type, T.TimestampType):
        return utc(value)
    if isinstance(data_type, T.StringType):
        return F.coalesce(epoch_ms(value), printed_date(value))
    return epoch_ms(value)


def iso_day(text: Column) -> Column:
    """The day of an ISO date-time: the part before ``T``."""
    return F.substring_index(text, "T", 1).try_cast("date")


def coerce_double(value: Column) -> Column:
    return value.try_cast("double")


def coerce_int(value: Column) -> Column:
    """Numeric text to int by truncation: ``2.9`` -> 2, ``1`` and ``1.0`` -> 1."""
    return value.try_cast("double").try_cast("int")


def json_field(document: Column, data_type: T.DataType, field: str) -> Column:
    """A field of a nested document, given as a struct or as JSON text."""
    if isinstance(data_type, T.StructType):
        return document.getField(field)
    return F.get_json_object(document, f"$.{field}")


def path_safe(name: Column) -> Column:
    """Spaces to underscores, for names used in paths."""
    return F.regexp_replace(name, " ", "_")
