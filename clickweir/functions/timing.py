"""Time helpers: the load instant, ISO text, window widths and their labels."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDTH = re.compile(r"(?P<count>[0-9]*[1-9][0-9]*)(?P<unit>[hms]?)")
DAY_SECONDS = 86400


def instant(as_of: datetime | str | Column | None) -> Column:
    """The moment a run counts as "now"; the clock of the query when none is given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def iso_text(ts: Column, suffix: str = "") -> Column:
    """ISO-8601 text, with microseconds only where there are some."""
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.when(micros > 0, F.format_string(".%06d", micros)).otherwise("")
    return F.concat(seconds, fraction, F.lit(suffix))


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def window_seconds(label: str | int) -> int:
    """Seconds of a width: a positive whole number of hours, minutes or seconds (``2h``, ``5m``, ``90s``),
    or of seconds without a unit. Anything else is refused."""
    match = _WIDTH.fullmatch(str(label).strip().lower())
    if match is None:
        raise ValueError(f"a window width is a positive number of h, m or s, not {label!r}")
    return int(match["count"]) * {"h": 3600, "m": 60}.get(match["unit"], 1)


def window_label(seconds: int) -> str:
    """The label of a width: the number of the largest units that it is a whole number of."""
    hours, minutes = divmod(seconds, 3600), divmod(seconds, 60)
    if seconds <= 0:
        raise ValueError(f"a window width is positive, not {seconds}")
    return f"{hours[0]}h" if not hours[1] else f"{minutes[0]}m" if not minutes[1] else f"{seconds}s"


def tumbling(ts: str, seconds: int, slide: int | None = None) -> Column:
    """Epoch-aligned event-time window; sliding when ``slide`` is given."""
    width = f"{seconds} seconds"
    return F.window(ts, width, f"{slide} seconds") if slide else F.window(ts, width)


def days_in(start: str, end: str) -> list[str]:
    """The dates from ``start`` to ``end``, both included, as ``yyyy-MM-dd``."""
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    return [(first + timedelta(days=n)).isoformat() for n in range((last - first).days + 1)]
