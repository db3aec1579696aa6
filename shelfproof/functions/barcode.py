"""EAN-13 as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digit(code: Column, position: int) -> Column:
    return F.ascii(F.substring(code, position, 1)) - F.lit(ord("0"))


def check_digit(body: Column) -> Column:
    """Check digit (int) of a column of twelve-digit bodies."""
    odd = reduce(add, [_digit(body, p) for p in range(1, 13, 2)])
    even = reduce(add, [_digit(body, p) for p in range(2, 13, 2)])
    return (10 - (odd + 3 * even) % 10) % 10


def number_check_digit(prefix: int, number: Column) -> Column:
    """Check digit of a two-digit prefix followed by a number of up to ten digits."""
    tens, ones = divmod(prefix, 10)
    # The number's last digit stands at position 12, which weighs 3.
    terms = [(F.floor(number / F.lit(10 ** i)) % 10) * (3 if i % 2 == 0 else 1) for i in range(10)]
    return ((10 - (F.lit(tens + 3 * ones) + reduce(add, terms)) % 10) % 10).cast("int")


def numbered(prefix: int, number: Column, digit: Column) -> Column:
    """Prefix, the number in ten digits, and a check digit; null if the number is longer."""
    code = F.lit(prefix * 10 ** 11) + number * 10 + digit
    return F.when(number.between(0, 10 ** 10 - 1), code.cast("string"))


def is_valid(code: Column) -> Column:
    """True for thirteen ASCII digits with a right check digit; null and anything else is false."""
    well_formed = (F.length(code) == 13) & code.rlike("[0-9]{13}")
    return F.when(F.coalesce(well_formed, F.lit(False)),
                  check_digit(code) == _digit(code, 13)).otherwise(F.lit(False))
