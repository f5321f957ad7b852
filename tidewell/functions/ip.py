"""IPv4 address arithmetic as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.text import column, split_on

MAX_IPV4 = (1 << 32) - 1

_OCTET = r"(?:\d{1,2}|[01]\d\d|2[0-4]\d|25[0-5])"
_DOTTED = rf"^{_OCTET}(?:\.{_OCTET}){{3}}\z"
_DIGITS = r"^\d{1,10}\z"


def is_ip(c: Column | str) -> Column:
    """Four groups of one to three digits, each at most 255."""
    return column(c).rlike(_DOTTED)


def ip_to_long(c: Column | str) -> Column:
    """Dotted quad to a number in 0..2^32-1.

    Text of digits only passes as the number itself. Anything else, including
    short forms and out-of-range numbers, is NULL.
    """
    c = column(c)
    octets = split_on(c, ".")
    number = F.aggregate(octets, F.lit(0).cast("bigint"), lambda n, octet: n * 256 + octet.try_cast("bigint"))
    plain = c.try_cast("bigint")
    return F.when(is_ip(c), number).when(c.rlike(_DIGITS) & (plain <= MAX_IPV4), plain)


def long_to_ip(c: Column | str) -> Column:
    """Number to dotted quad; a signed 32-bit value gives the same address."""
    c = column(c).cast("bigint")
    octets = [F.shiftright(c, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8)]
    return F.concat_ws(".", *octets, c.bitwiseAND(F.lit(255)).cast("string"))


def unsigned(c: Column | str) -> Column:
    """Signed 32-bit value to its unsigned form."""
    return column(c).cast("bigint").bitwiseAND(F.lit(MAX_IPV4).cast("bigint"))
