"""Scalar helpers.  Every one is a native Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LONG_MIN = -(2**63)
LONG_MAX = 2**63 - 1
SECONDS_PER_DAY = 86400
SECONDS_PER_WEEK = 7 * SECONDS_PER_DAY
# 1970-01-05, the first Monday of the epoch.
FIRST_MONDAY = 4 * SECONDS_PER_DAY
# 9999-12-31T23:59:59Z, the last second a DATE partition can name.
LAST_DATED_SECOND = 253402300799


def integer_or_zero(text: Column) -> Column:
    """Decimal text as a long: 0 for anything that is not an integer.

    Digits beyond the 64-bit range saturate instead of becoming 0.
    """
    saturated = F.when(text.startswith("-"), F.lit(LONG_MIN)).otherwise(F.lit(LONG_MAX))
    return F.when(
        text.rlike(r"\A[+-]?[0-9]+\z"), F.coalesce(text.try_cast("bigint"), saturated)
    ).otherwise(F.lit(0).cast("bigint"))


def numeric_text(x: Column) -> Column:
    """A double as plain decimal text: 60.0 -> ``60``, 1.0E-7 -> ``0.0000001``."""
    short = x.cast("string")
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    magnitude = F.ltrim(F.regexp_replace(short, "^-", ""))
    mantissa = F.split_part(magnitude, F.lit("E"), F.lit(1))
    exponent = F.split_part(magnitude, F.lit("E"), F.lit(2)).try_cast("int")
    whole = F.split_part(mantissa, F.lit("."), F.lit(1))
    fraction = F.regexp_replace(F.split_part(mantissa, F.lit("."), F.lit(2)), "0+$", "")
    digits = F.concat(whole, fraction)
    # Position of the decimal point inside ``digits``.
    point = F.length(whole) + exponent
    expanded = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= F.length(digits), F.rpad(digits, point, "0"))
        .otherwise(F.concat(digits.substr(F.lit(1), point), F.lit("."),
                            digits.substr(point + 1, F.length(digits))))
    )
    is_small_integer = (x == F.floor(x)) & (F.abs(x) < F.lit(1e15))
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(is_small_integer, x.cast("bigint").cast("string"))
        .when(F.instr(short, "E") > 0, F.concat(sign, expanded))
        .otherwise(F.regexp_replace(short, r"(\.\d*?)0+$", "$1"))
    )


def parse_timestamp(text: Column) -> Column:
    """Epoch digits or one of four date layouts as epoch seconds, else 0.

    Layouts: ``Y-m-d H:M:S``, ``Y-m-dTH:M:S``, ``Y-m-d H:M`` and ``Y-m-d``.
    A fraction after the seconds is accepted and dropped.
    """
    epoch = F.when(text.rlike(r"\A[+-]?[0-9]+\z"), text.try_cast("bigint"))
    layout = (
        r"\A(\d{4})-(\d{2})-(\d{2})"
        r"(?:(?: (\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?)|(?:T(\d{1,2}):(\d{2}):(\d{2})(?:[.,]\d+)?))?\z"
    )

    def part(*groups: int) -> Column:
        found = [F.nullif(F.regexp_extract(text, layout, g), F.lit("")) for g in groups]
        return F.coalesce(*found, F.lit("0")).cast("int")

    second = part(6, 9)
    moment = F.try_make_timestamp(
        part(1), part(2), part(3), part(4, 7), part(5, 8), second.cast("decimal(16,6)"),
        F.lit("UTC"),
    )
    dated = F.when(text.rlike(layout) & (second < 60), F.unix_timestamp(moment))
    return F.coalesce(epoch, dated, F.lit(0).cast("bigint"))


def start_of_week(epoch: Column) -> Column:
    """Epoch seconds of the Monday 00:00 UTC at or before ``epoch``."""
    return epoch - F.pmod(epoch - F.lit(FIRST_MONDAY), F.lit(SECONDS_PER_WEEK))


def day_windows(start: Column, end: Column) -> Column:
    """Contiguous ``[start, end)`` windows of at most a day, as an array of structs."""
    start, end = start.cast("bigint"), end.cast("bigint")
    starts = F.when(
        start < end, F.sequence(start, end - 1, F.lit(SECONDS_PER_DAY).cast("bigint"))
    ).otherwise(F.array().cast("array<bigint>"))
    return F.transform(
        starts,
        lambda s: F.struct(s.alias("start"), F.least(s + SECONDS_PER_DAY, end).alias("end")),
    )


def valid_window(start: Column, end: Column) -> Column:
    """A window is valid when it is not empty and at most one day long."""
    return (start < end) & (end - start <= SECONDS_PER_DAY)


def epoch_to_timestamp(epoch: Column) -> Column:
    return F.timestamp_seconds(epoch)


def record_date(epoch: Column) -> Column:
    """The UTC day of a record, NULL outside 1970..9999 (garbage clocks)."""
    return F.when(
        epoch.between(0, LAST_DATED_SECOND),
        F.date_from_unix_date(F.floor(epoch / SECONDS_PER_DAY).cast("int")),
    )


def sha256_hex(data: Column) -> Column:
    return F.sha2(data, 256)


def nullif_zero(x: Column) -> Column:
    return F.when(x != 0, x)


def nullif_empty(s: Column) -> Column:
    return F.when(s != "", s)


def sanitize_name(s: Column) -> Column:
    """Lower case, with blanks and dashes turned into underscores."""
    return F.translate(F.lower(s), " -", "__")


def millis_to_seconds(ms: Column) -> Column:
    """Integer division by 1000, truncating toward zero."""
    return ((ms - ms % 1000) / 1000).cast("bigint")


def confidence_percent(confidence: Column) -> Column:
    return F.round(confidence * 100).cast("int")


def equal_fold(a: Column, b: Column) -> Column:
    return F.lower(a) == F.lower(b)


def text_before(s: Column, separator: str) -> Column:
    """The text before the first separator, '' when there is none."""
    return F.when(F.instr(s, separator) > 0, F.substring_index(s, separator, 1)).otherwise("")


def strip_suffix(s: Column, suffix: str) -> Column:
    """``s`` without one trailing ``suffix``."""
    return F.when(s.endswith(suffix), F.left(s, F.length(s) - len(suffix))).otherwise(s)


def first_matching(items: Column, allowed: list[str]) -> Column:
    """The first element, in array order, that is one of ``allowed``."""
    return F.get(F.filter(items, lambda x: x.isin(allowed)), F.lit(0))
