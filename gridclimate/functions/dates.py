"""Date parsing, date columns and calendars."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: accepted and refused date shapes -------------------------------
SLASH_DATE = r"^\d{1,2}/\d{1,2}/\d{2,4}$"
COMPACT_DAY = r"^\d{8}$"
ZONED_TEXT = r"\d:\d\d.*(Z|[+-]\d\d:?\d\d)$"
# --- end of fixed values ----------------------------------------------------------

NTZ = "timestamp_ntz"


def date_key_timestamp(key: Column) -> Column:
    """`YYYYMMDD` or `YYYYMMDDHH` to a timestamp; NULL when it is not a real date."""
    iso = F.concat(key.substr(1, 4), F.lit("-"), key.substr(5, 2), F.lit("-"), key.substr(7, 2),
                   F.lit(" "), F.when(F.length(key) == 10, key.substr(9, 2)).otherwise(F.lit("00")),
                   F.lit(":00:00"))
    # The cast itself refuses anything but digits in these places.
    return F.when(F.length(key).isin(8, 10), iso.try_cast(NTZ))


def date_key(stamp: Column, hourly: bool = False) -> Column:
    """Timestamp to its wire key; reads the naive clock, so no zone is involved."""
    text = stamp.cast(NTZ).cast("string")
    day = F.concat(text.substr(1, 4), text.substr(6, 2), text.substr(9, 2))
    return F.concat(day, text.substr(12, 2)) if hourly else day


def clock_micros(stamp: Column, kind: T.DataType) -> Column:
    """Microseconds on a time line: instants for zoned stamps, the naive clock otherwise."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(stamp)
    naive = stamp.cast(NTZ)
    seconds = F.unix_date(naive.cast("date")) * F.lit(86_400).cast("bigint") + F.hour(naive) * 3600 + F.minute(naive) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), naive) * 1_000_000).cast("bigint")


def parse_text_date(text: Column) -> Column:
    """ISO date, ISO timestamp or compact date to a timestamp; slash dates give NULL."""
    trimmed = F.trim(text)
    return (F.when(trimmed.rlike(SLASH_DATE), F.lit(None).cast(NTZ))
            .when(trimmed.rlike(COMPACT_DAY), date_key_timestamp(trimmed))
            .when(trimmed.rlike(ZONED_TEXT), utc_naive(trimmed.try_cast("timestamp")))
            .otherwise(trimmed.try_cast(NTZ)))


def utc_naive(ts: Column) -> Column:
    """Zoned timestamp to the naive UTC wall clock, whatever the session zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.lit("1970-01-01").cast(NTZ))


def iso_bound(bound) -> str:
    """A window bound given by the caller as ISO text; slash dates are refused."""
    text = str(bound).strip()
    if re.match(SLASH_DATE, text):
        raise ValueError(f"ambiguous date {text!r}; use YYYY-MM-DD")
    if re.match(COMPACT_DAY, text):
        text = f"{text[:4]}-{text[4:6]}-{text[6:]}"
    datetime.fromisoformat(text)
    return text


def parse_dates(df: DataFrame, column: str, out: str = "date") -> DataFrame:
    """Add `out` and `out_error`: `ambiguous date`, `unreadable date` or NULL."""
    text = F.col(column)
    parsed = parse_text_date(text)
    return df.withColumns({
        out: parsed,
        f"{out}_error": F.when(F.trim(text).rlike(SLASH_DATE), F.lit("ambiguous date"))
                         .when(parsed.isNull(), F.lit("unreadable date")),
    })


def ensure_date_column(df: DataFrame, name: str = "date", *, candidates: Iterable[str] | None = None,
                       normalize: bool = False, strip_timezone: bool = True) -> DataFrame:
    """Guarantee a timestamp column `name`, taken from `name` or the first candidate present.

    A candidate column is dropped once renamed. Unreadable text stops the query.
    """
    source = next((c for c in [name, *(candidates or [])] if c in df.columns), None)
    if source is None:
        raise ValueError(f"no date column {name!r} and none of the candidates {list(candidates or [])}")
    kind, value = df.schema[source].dataType, F.col(source)
    if isinstance(kind, T.StringType):
        parsed = F.coalesce(F.when(F.trim(value).rlike(COMPACT_DAY), date_key_timestamp(F.trim(value))),
                            F.when(F.trim(value).rlike(ZONED_TEXT), utc_naive(F.trim(value).try_cast("timestamp"))),
                            F.trim(value).try_cast(NTZ))
        stamp = F.when(value.isNotNull() & parsed.isNull(),
                       F.raise_error(F.concat(F.lit("unreadable date: "), value)).cast(NTZ)).otherwise(parsed)
    elif isinstance(kind, T.TimestampType):
        stamp = utc_naive(value) if strip_timezone else value
    else:
        stamp = value.cast(NTZ)
    if normalize:
        stamp = stamp.cast("date").cast(NTZ)
    keep = [c for c in df.columns if c not in (name, source)]
    if source == name:
        return df.select(*[stamp.alias(name) if c == name else F.col(c) for c in df.columns])
    return df.select(*keep, stamp.alias(name))


def calendar(df: DataFrame, start: str, end: str, temporal: str = "daily", out: str = "obs_ts") -> DataFrame:
    """Repeat every row once per day or hour from `start` to `end`, both included."""
    step = F.expr("interval 1 hour" if temporal == "hourly" else "interval 1 day")
    stamps = F.sequence(F.col(start).cast(NTZ), F.col(end).cast(NTZ), step)
    return df.withColumn(out, F.explode(stamps))
