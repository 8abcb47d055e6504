"""Key codec and raw-value cleaning (I-4 .. I-8, I-12)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARKER = "\\N"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def digits_only(c: Column | str) -> Column:
    """Keep the digits of a text: ``qlz2018-08-10 00:20:00`` -> ``20180810002000``."""
    return F.regexp_replace(_c(c), "[^0-9]", "")


def letters_only(c: Column | str) -> Column:
    """Drop the digits of a text: ``qlz20180810004000`` -> ``qlz``."""
    return F.regexp_replace(_c(c), "[0-9]", "")


def key_encode(*parts: Column | str) -> Column:
    """Row key = concatenation of the parts (abbr + [id] + 14-digit time)."""
    return F.concat(*[_c(p).cast("string") for p in parts])


def key_head(key: Column | str, tail: int = 14) -> Column:
    """All but the last ``tail`` characters (the station abbreviation)."""
    k = _c(key)
    return F.when(F.length(k) >= tail, F.left(k, F.length(k) - F.lit(tail)))


def key_tail(key: Column | str, tail: int = 14) -> Column:
    """The last ``tail`` characters (the 14-digit time)."""
    return F.right(_c(key), F.lit(tail))


def strip_ext(name: Column | str) -> Column:
    """File name without its extension (``.txt``)."""
    return F.regexp_replace(_c(name), r"\.[^.]*$", "")


def clean_value(value: Column | str) -> Column:
    """Raw text reading -> DOUBLE; null marker, empty, junk, missing and what isn't finite -> 0."""
    v = _c(value).try_cast("double")
    return F.when(F.abs(v) < float("inf"), v).otherwise(F.lit(0.0))  # NaN is above every number


def pad3(n: Column | str) -> Column:
    """Zero-padded 3-digit number text (``%03d``)."""
    return F.format_string("%03d", _c(n))
