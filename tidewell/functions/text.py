"""Splitting, trimming, safe casts and small predicates on text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_REGEX_CHARS = set(r"\.[]{}()<>*+-=!?^$|")


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_on(c: Column | str, separator: str) -> Column:
    """Split on a literal separator; empty parts are kept."""
    pattern = "".join("\\" + ch if ch in _REGEX_CHARS else ch for ch in separator)
    return F.split(column(c), pattern)


def part(parts: Column | str, index: int) -> Column:
    """Array element by position, NULL when the array is shorter."""
    return F.get(column(parts), F.lit(index))


def strip_spaces(c: Column | str) -> Column:
    return F.trim(column(c))


def strip_all(c: Column | str) -> Column:
    """Remove whitespace of every kind from both ends."""
    return F.btrim(column(c), F.lit(WHITESPACE))


def words_of(c: Column | str, strip: str = "none") -> Column:
    """Words of a line, split on one space; ``strip`` is none, spaces or all."""
    if strip == "spaces":
        c = strip_spaces(c)
    elif strip == "all":
        c = strip_all(c)
    elif strip != "none":
        raise ValueError(f"strip must be none, spaces or all, not {strip!r}")
    return split_on(c, " ")


def to_int(c: Column | str) -> Column:
    return column(c).try_cast("int")


def to_bigint(c: Column | str) -> Column:
    return column(c).try_cast("bigint")


def to_decimal(c: Column | str, precision: int = 10, scale: int = 2) -> Column:
    return column(c).try_cast(f"decimal({precision},{scale})")


def to_text(c: Column | str) -> Column:
    return column(c).cast("string")


def to_time(c: Column | str, pattern: str | None = None) -> Column:
    """Text to TIMESTAMP, NULL when unparsable."""
    if pattern is None:
        return F.try_to_timestamp(column(c))
    return F.try_to_timestamp(column(c), F.lit(pattern))


def log_day(c: Column | str) -> Column:
    """``18/Oct/2022:19:40:51`` to ``2022-10-18``; other text is returned as it is."""
    c = column(c)
    day = F.date_format(to_time(c, "d/MMM/yyyy:H:m:s"), "yyyy-MM-dd")
    return F.coalesce(day, c)


def joined(separator: str, *columns: Column | str) -> Column:
    return F.concat_ws(separator, *columns)


def row_json(*columns: Column | str) -> Column:
    """The given columns as one JSON object, or all columns when none is given."""
    return F.to_json(F.struct(*columns) if columns else F.struct("*"))


# -- predicates ---------------------------------------------------------------


def contains(c: Column | str, text: str) -> Column:
    return column(c).contains(text)


def longer_than(c: Column | str, n: int) -> Column:
    return F.length(column(c)) > n


def not_empty(c: Column | str) -> Column:
    """True for non-empty text; NULL (hence dropped by a filter) for NULL."""
    return F.length(column(c)) > 0


def has_fields(c: Column | str, n: int, separator: str = ",") -> Column:
    return F.size(split_on(c, separator)) == n


def equals_int(c: Column | str, n: int) -> Column:
    """Compare text with a number; non-numeric text is NULL instead of an error."""
    return to_int(c) == n


def below(c: Column | str, n: int) -> Column:
    return column(c) < n


def one_of(c: Column | str, values: list) -> Column:
    return column(c).isin(values)
