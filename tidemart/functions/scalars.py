"""Column expressions. All of them are built-in functions inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = "yyyy-MM-dd"
SECOND = "yyyy-MM-dd HH:mm:ss"
MONEY = "decimal(16,2)"


def epoch_seconds_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds, as number or text; text that is no number gives null."""
    return F.timestamp_seconds(seconds.try_cast("bigint"))


def epoch_ms_to_timestamp(millis: Column) -> Column:
    return F.timestamp_millis(millis.try_cast("bigint"))


def epoch_ms_to_date(millis: Column) -> Column:
    return F.date_format(epoch_ms_to_timestamp(millis), DAY)


def epoch_ms_to_datetime(millis: Column) -> Column:
    return F.date_format(epoch_ms_to_timestamp(millis), SECOND)


def date_to_epoch_ms(text: Column, full: bool = False, offset: str = "+08:00") -> Column:
    """Text of a day, or of a day and time when ``full``, read at a fixed zone offset."""
    moment = text if full else F.concat(text, F.lit(" 00:00:00"))
    instant = F.try_to_timestamp(F.concat(moment, F.lit(offset)), F.lit(SECOND + "XXX"))
    return F.unix_millis(instant)


def format_day(text: Column) -> Column:
    """Day of a date-time text; unreadable text gives null."""
    return F.date_format(text.try_cast("timestamp"), DAY)


def window_bounds(window: Column) -> tuple[Column, Column]:
    return (F.date_format(window["start"], SECOND).alias("stt"),
            F.date_format(window["end"], SECOND).alias("edt"))


def multiply_as_text(a: Column, b: Column) -> Column:
    """Product of two money texts, written out with scale 4."""
    return (a.try_cast(MONEY) * b.try_cast(MONEY)).cast("string")


def cart_delta(kind: Column, now: Column, before: Column) -> Column:
    """Quantity put into the cart: all of it on insert, else the increase."""
    increase = (now.try_cast("int") - before.try_cast("int")).cast("string")
    return F.when(kind == "insert", now).otherwise(increase)


def route_key(source_table: Column, source_type: Column | None = None) -> Column:
    """Key of a routing row: the table, or the table and the operation type."""
    if source_type is None:
        return source_table
    return F.concat_ws("_", source_table, source_type)


def keep_listed(payload: Column, listed: Column) -> Column:
    """Entries of a map whose key is in a comma separated list."""
    names = F.split(listed, ",")
    return F.map_filter(payload, lambda k, v: F.array_contains(names, k))


def without_nulls(payload: Column) -> Column:
    """A map without its null values, so that JSON output leaves them out."""
    return F.map_filter(payload, lambda k, v: v.isNotNull())


def map_to_json(payload: Column) -> Column:
    return F.to_json(without_nulls(payload))


def json_to_map(text: Column) -> Column:
    return F.from_json(text, "map<string,string>")


def write_second() -> Column:
    """Epoch second of the write; one value per batch."""
    return F.unix_timestamp()


def write_time() -> Column:
    """Time of the write; one value per batch."""
    return F.current_timestamp()
