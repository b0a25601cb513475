"""Which days a batch touches, in a form of fixed size."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400
# Days that a bitmap can name: 1970-01-01 to 2059-09-18.
NUMBERED_DAYS = 32768
EPOCH_ORDINAL = date(1970, 1, 1).toordinal()


def day_bitmap(ts: Column) -> Column:
    """Aggregate: the days that occur, as one bitmap of 4 KB however many rows there are."""
    day = F.floor(ts / SECONDS_PER_DAY)
    return F.bitmap_construct_agg(
        F.bitmap_bit_position(F.when(day.between(0, NUMBERED_DAYS - 1), day + 1))
    )


def outside_days(ts: Column) -> Column:
    """Aggregate: rows whose day no bitmap can name."""
    return F.count_if(~ts.between(0, NUMBERED_DAYS * SECONDS_PER_DAY - 1))


def listed_days(bitmap: bytes | None) -> list[date]:
    return [
        date.fromordinal(EPOCH_ORDINAL + 8 * i + bit)
        for i, byte in enumerate(bitmap or b"")
        for bit in range(8)
        if byte >> bit & 1
    ]


def day_filter(dt: Column, bitmap: bytes | None, outside: bool) -> Column:
    """Partition filter for the days of a bitmap.

    ``outside`` adds what a bitmap cannot name: later days and invalid ones.
    """
    days = listed_days(bitmap)
    wanted = dt.isin(days) if days else F.lit(False)
    if outside:
        last = date.fromordinal(EPOCH_ORDINAL + NUMBERED_DAYS - 1)
        wanted = wanted | (dt > last) | dt.isNull()
    return wanted
