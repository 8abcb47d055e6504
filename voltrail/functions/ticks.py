"""Tick arithmetic as Column expressions (I-1 .. I-3, F-4).

A tick is a 20-minute boundary.  Internally ticks are TIMESTAMPs (session time
zone UTC) plus an integer ``seq`` = epoch seconds / 1200, which makes "previous
tick" and "72 ticks back" plain integer offsets usable in range windows and
equi-joins.  The 14-digit ``yyyyMMddHHmmss`` text is used only at file and key
boundaries.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltrail.params import TICK_SECONDS

TICK_FORMAT = "yyyyMMddHHmmss"


def _ts(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    # TIMESTAMP_NTZ inputs (driver tables) are read as UTC wall-clock time.
    return c.cast("timestamp")


def tick_seq(ts: Column | str) -> Column:
    """Integer tick number of the 20-minute bucket containing ``ts``."""
    return F.floor(F.unix_seconds(_ts(ts)) / F.lit(TICK_SECONDS)).cast("bigint")


def seq_to_tick(seq: Column | str) -> Column:
    seq = F.col(seq) if isinstance(seq, str) else seq
    return F.timestamp_seconds(seq * F.lit(TICK_SECONDS))


def tick_floor(ts: Column | str) -> Column:
    """Floor a timestamp to its 20-minute tick (I-1)."""
    return seq_to_tick(tick_seq(ts))


def shift_ticks(tick: Column | str, n: int) -> Column:
    """tick + n * 20 minutes (I-2); n may be negative."""
    return _ts(tick) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(20 * n), F.lit(0))


def tick_text(tick: Column | str) -> Column:
    """14-digit text form used in file names and keys."""
    return F.date_format(_ts(tick), TICK_FORMAT)


def parse_tick(text: Column | str) -> Column:
    """Validate-and-parse a 14-digit tick text (I-3); NULL when malformed."""
    text = F.col(text) if isinstance(text, str) else text
    ok = text.rlike(r"^[0-9]{14}$")
    return F.when(ok, F.try_to_timestamp(text, F.lit(TICK_FORMAT)))


def tick_number(text: str) -> int:
    """Tick number of a job's 14-digit tick argument (I-3); malformed, impossible or uneven ticks are errors."""
    if not re.fullmatch(r"[0-9]{14}", text):
        raise ValueError(f"a tick has 14 digits: {text!r}")
    seconds = (dt.datetime.strptime(text, "%Y%m%d%H%M%S") - dt.datetime(1970, 1, 1)).total_seconds()
    if seconds % TICK_SECONDS:
        raise ValueError(f"a tick is a multiple of {TICK_SECONDS // 60} minutes: {text!r}")
    return int(seconds // TICK_SECONDS)
