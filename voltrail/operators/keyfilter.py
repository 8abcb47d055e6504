"""Row filters written as expressions over the text key, as predicates on the typed columns (C-14).

A row's key is its station's abbreviation, which holds no digits, and the 14 digits of its time.  A filter is a
regular expression that a part of the key must match.  From the expression are derived, for each of its
alternatives, what the station must be or begin with and the first and last time the digits allow; these are
predicates on station, date and time that partitions and row groups are pruned by.  They hold for every key that the
expression matches, and the expression itself is applied to what they leave, so the result is exact for any expression.

Read are literals, escapes, classes, ``.``, groups, alternatives and counted repeats; a repeat without a fixed
count is any text.  Of an expression with anything else (flags, look-around, back-references), or with over
``MOST`` alternatives, nothing is derived, and every key is matched.
"""

from __future__ import annotations

import calendar
import datetime as dt
import string
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltrail.functions.codec import key_encode
from voltrail.functions.ticks import tick_text

MOST = 1024
DIGITS = frozenset(string.digits)
TIME = 14
#: An item of an alternative: the characters that may stand there, or one of these.
ANY, GAP, START, END = "any", "gap", "start", "end"


class Unread(ValueError):
    """The expression has a part that isn't read."""


class _Reader:
    """An expression's alternatives, each a list of items."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def take(self) -> str:
        c = self.peek()
        if not c:
            raise Unread("the expression ends early")
        self.at += 1
        return c

    def either(self) -> list[list]:
        out = self.sequence()
        while self.peek() == "|":
            self.at += 1
            out = out + self.sequence()
        return self.bounded(out)

    def bounded(self, alternatives: list) -> list:
        if len(alternatives) > MOST:
            raise Unread("too many alternatives")
        return alternatives

    def sequence(self) -> list[list]:
        out: list[list] = [[]]
        while self.peek() and self.peek() not in "|)":
            item = self.repeated(self.one())
            self.bounded(range(len(out) * len(item)))
            out = [a + b for a, b in product(out, item)]
        return out

    def one(self) -> list[list]:
        c = self.take()
        if c == "(":
            if self.peek() == "?":
                if self.text[self.at:self.at + 2] != "?:":
                    raise Unread("a group of another kind")
                self.at += 2
            inner = self.either()
            if self.take() != ")":
                raise Unread("a group isn't closed")
            return inner
        if c in "*+?{}])":
            raise Unread(f"{c!r} stands alone")
        return [[{"^": START, "$": END, ".": ANY}[c] if c in "^$." else self.group() if c == "[" else self.escape() if c == "\\" else frozenset(c)]]

    def escape(self) -> frozenset:
        c = self.take()
        if c == "d":
            return DIGITS
        if c.isalnum():
            raise Unread(f"\\{c}")
        return frozenset(c)

    def group(self) -> frozenset:
        found: set[str] = set()
        if self.peek() == "^":
            raise Unread("a negated class")
        while self.peek() != "]":
            c = self.take()
            if c in "[&":
                raise Unread("a class within a class")
            chars = self.escape() if c == "\\" else frozenset(c)
            if self.peek() == "-" and self.text[self.at + 1:self.at + 2] not in ("]", ""):
                self.at += 1
                last = self.take()
                if len(chars) > 1 or last in "[\\":
                    raise Unread("a range of classes")
                chars = frozenset(map(chr, range(ord(next(iter(chars))), ord(last) + 1)))
            found |= chars
        self.at += 1
        if not found:
            raise Unread("an empty class")
        return frozenset(found)

    def repeated(self, item: list[list]) -> list[list]:
        times = 1
        c = self.peek()
        if c and c in "*+?":
            self.at += 1
            times = -1
        elif c == "{":
            end = self.text.find("}", self.at)
            inside = self.text[self.at + 1:end] if end > 0 else ""
            if not inside.replace(",", "", 1).isdigit():
                raise Unread("a repeat")
            self.at = end + 1
            times = int(inside) if inside.isdigit() else -1
        if c and c in "*+?{" and self.peek() and self.peek() in "?+":  # lazy or possessive: no more keys match
            self.at += 1
        if c and c in "*+?{" and self.peek() and self.peek() in "*+?{":
            raise Unread("a repeat of a repeat")
        if times < 0:
            return [[GAP]]
        out: list[list] = [[]]
        for _ in range(times):
            self.bounded(range(len(out) * len(item)))
            out = [a + b for a, b in product(out, item)]
            if len(out[0]) > 1000:
                raise Unread("a long repeat")
        return out


def alternatives(expression: str) -> list[list]:
    reader = _Reader(expression)
    out = reader.either()
    if reader.peek():
        raise Unread("a bracket too many")
    for items in out:
        if START in items[1:] or END in items[:-1]:
            raise Unread("an anchor within")
    return out


@dataclass(frozen=True)
class Bound:
    """What one alternative asks of a key: a whole station or its beginning, and the first and last time (None: any)."""

    station: str | None = None
    begins: str = ""
    first: dt.datetime | None = None
    last: dt.datetime | None = None


def near(digits: str) -> dt.datetime:
    """The time of 14 digits; where a part is out of its range, the nearest time from there."""
    part = [int(digits[:4]), *(int(digits[i:i + 2]) for i in range(4, TIME, 2))]
    low, high = [1, 1, 1, 0, 0, 0], [9999, 12, 31, 23, 59, 59]
    for i in range(6):
        if i == 2:
            high[2] = calendar.monthrange(part[0], part[1])[1]
        if part[i] < low[i]:
            part[i:] = low[i:]
        elif part[i] > high[i]:
            part[i:] = high[i:]
            if i < 2:
                part[2] = calendar.monthrange(part[0], part[1])[1]
        else:
            continue
        break
    return dt.datetime(*part)


def fixed_runs(items: list) -> list[list]:
    """Stretches of an alternative between gaps, anchors left out."""
    runs: list[list] = [[]]
    for x in items:
        if x == GAP:
            runs.append([])
        elif x not in (START, END):
            runs[-1].append(x)
    return runs


def digit(x) -> bool:
    return isinstance(x, frozenset) and x <= DIGITS


def letter(x) -> bool:
    return isinstance(x, frozenset) and not x & DIGITS


def time_begins(run: list, at_end: bool) -> int | None:
    """Where in a run the time's first digit stands (below 0: before the run), if the run tells.

    It does by a digit right after a character that is none, by 14 digits in a row, or by the key's end."""
    for i, x in enumerate(run):
        if digit(x) and i and letter(run[i - 1]):
            return i
        if all(map(digit, run[i:i + TIME])) and len(run) >= i + TIME:
            return i
    return len(run) - TIME if at_end else None


def bounds_of(items: list) -> list[Bound] | None:
    """What an alternative asks for; None if no key can match it."""
    starts, ends = START in items, END in items
    runs = fixed_runs(items)
    chars: list = [None] * TIME
    stations, begins = None, ""
    for n, run in enumerate(runs):
        first = starts and n == 0
        at = time_begins(run, ends and n == len(runs) - 1)
        head = run if at is None else run[:max(0, at)]
        if at is not None:
            if len(run) - at > TIME:
                return None
            for i, x in enumerate(run[max(0, at):], max(0, -at)):
                if isinstance(x, frozenset):
                    chars[i] = x & DIGITS if chars[i] is None else chars[i] & x
            if any(isinstance(x, frozenset) and x <= DIGITS for x in head):
                return None
        if first and at is not None and at >= 0 and all(map(letter, head)):
            whole = 1
            for x in head:
                whole *= len(x)
            if whole <= MOST:
                stations = sorted("".join(x) for x in product(*map(sorted, head)))
        if first and stations is None:
            for x in head:
                if not letter(x) or len(x) > 1:
                    break
                begins += next(iter(x))
    if any(x is not None and not x for x in chars):
        return None
    first = last = None
    if chars[0] is not None:
        # Known digits up to the first unknown one bound the time on both sides.
        known = next((i for i, x in enumerate(chars) if x is None), TIME)
        first = near("".join(min(x) for x in chars[:known]).ljust(TIME, "0"))
        last = near("".join(max(x) for x in chars[:known]).ljust(TIME, "9"))
    return [Bound(s, begins, first, last) for s in (stations or [None])]


def derive(expression: str) -> list[Bound] | None:
    """The bounds of an expression's alternatives, no key outside them matches; None if nothing can be said."""
    try:
        found = [bounds_of(items) for items in alternatives(expression)]
    except Unread:
        return None
    out = list(dict.fromkeys(b for f in found if f for b in f))
    return out if len(out) <= MOST else None


def spans(bounds: list[Bound]) -> list[tuple[dt.datetime, dt.datetime]] | None:
    """The bounds' times as few spans; None if one has none."""
    if any(b.first is None for b in bounds):
        return None
    out: list[list[dt.datetime]] = []
    for a, b in sorted((x.first, x.last) for x in bounds if x.first <= x.last):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def any_of(tests: list[Column]) -> Column:
    """OR of the tests, halved so that many of them don't make a deep expression."""
    if len(tests) < 2:
        return tests[0] if tests else F.lit(False)
    return any_of(tests[:len(tests) // 2]) | any_of(tests[len(tests) // 2:])


def within(c: Column, found: list[tuple[str, str]], kind: str) -> Column:
    """Whether a column lies in one of the spans: one membership test for the single values, a comparison for each other span."""
    def lit(x: str) -> Column:
        return F.lit(x).cast(kind)

    single = [lit(a) for a, b in found if a == b]
    return any_of(([c.isin(*single)] if single else []) + [c.between(lit(a), lit(b)) for a, b in found if a != b])


def predicates(bounds: list[Bound], station: str, tick: str, date: str | None) -> list[Column]:
    out = []
    if bounds and all(b.station is not None for b in bounds):
        out.append(F.col(station).isin(*sorted({b.station for b in bounds})))
    elif bounds and all(b.station is not None or b.begins for b in bounds):
        begins = sorted({b.begins if b.station is None else b.station for b in bounds})
        out.append(any_of([F.col(station).startswith(x) for x in begins]))
    times = spans(bounds)
    if times is not None:
        # The key's text leaves out fractions of a second.
        out.append(within(F.col(tick), [(a.isoformat(" "), b.isoformat(" ") + ".999999") for a, b in times], "timestamp"))
        if date is not None:
            days = dict.fromkeys((a.date().isoformat(), b.date().isoformat()) for a, b in times)
            out.append(within(F.col(date), list(days), "date"))
    return out


def key_filter(df: DataFrame, expression: str, station: str = "station_abbr", tick: str = "tick") -> DataFrame:
    """Rows whose key (station and 14-digit time) holds a match of the expression; a ``date`` column, if any, is the tick's."""
    bounds = derive(expression)
    out = df
    if bounds is not None:
        if not bounds:
            return df.filter(F.lit(False))
        for p in predicates(bounds, station, tick, "date" if "date" in df.columns else None):
            out = out.filter(p)
    return out.filter(key_encode(station, tick_text(tick)).rlike(expression))
