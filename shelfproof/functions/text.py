"""Text and number formatting, keyed hashes and date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(value: Column) -> Column:
    """Two decimals as text, without the thousands separator of format_number."""
    return value.cast("decimal(12,2)").cast("string")


def whole(value: Column) -> Column:
    """No decimals, ties to even."""
    return F.bround(value, 0).cast("long").cast("string")


def percent(value: Column) -> Column:
    """0.984 -> '98.4%'."""
    return F.concat((value * 100).cast("decimal(12,1)").cast("string"), F.lit("%"))


def padded(prefix: str, number: Column, width: int) -> Column:
    """Prefix and zero-padded number; longer numbers keep all their digits."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)),
                                          F.lit("0")))


def keyed_hash(seed: int, tag: str, *keys: Column) -> Column:
    """Hex md5 of seed, tag and keys: the same draw on every engine and every retry."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(tag), *[k.cast("string") for k in keys]))


def hash_slice(hex_hash: Column, start: int, digits: int = 7) -> Column:
    """`digits` hex digits from 1-based position `start`, as a long."""
    return F.conv(F.substring(hex_hash, start, digits), 16, 10).cast("long")


def hash_unit(hex_hash: Column, start: int) -> Column:
    """A draw in [0, 1) from seven hex digits."""
    return hash_slice(hex_hash, start).cast("double") / F.lit(float(16 ** 7))


def snap_to_thursday(day: Column) -> Column:
    """The day itself if a Thursday, else the next one."""
    return F.next_day(F.date_sub(day, 1), "THU")


def weeks_after(start: Column, weeks: Column) -> Column:
    """Last day of a run of whole weeks that begins on `start`."""
    return F.date_add(start, (weeks * 7 - 1).cast("int"))
