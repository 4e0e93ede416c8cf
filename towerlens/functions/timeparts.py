"""Calendar parts, ingest partition text, hour labels and range bounds.

All of these are defined in UTC (the session zone set by
``towerlens.session.apply_job_conf``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Length of one live micro-batch (the live job's trigger window).
MICRO_BATCH_SECONDS = 100

_UNIT_HOURS = {"hour": 1, "hours": 1, "h": 1, "day": 24, "days": 24, "d": 24,
               "week": 168, "weeks": 168}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_utc_timestamp_col(c: str | Column) -> Column:
    """TIMESTAMP_NTZ (wall time in UTC) → TIMESTAMP; identity for TIMESTAMP."""
    return _col(c).cast("timestamp")


def calendar_parts(ts: str | Column, prefix: str = "") -> list[Column]:
    """year, month, day, hour as INT."""
    t = _col(ts)
    return [F.year(t).alias(f"{prefix}year"), F.month(t).alias(f"{prefix}month"),
            F.dayofmonth(t).alias(f"{prefix}day"), F.hour(t).alias(f"{prefix}hour")]


def zero_padded_parts(ts: str | Column) -> list[Column]:
    """Zero-padded text parts: 'yyyy', 'MM', 'dd', 'HH'."""
    t = _col(ts)
    return [F.date_format(t, "yyyy"), F.date_format(t, "MM"),
            F.date_format(t, "dd"), F.date_format(t, "HH")]


def ingest_parts(ts: str | Column) -> list[Column]:
    names = ["ingest_year", "ingest_month", "ingest_day", "ingest_hour"]
    return [c.alias(n) for c, n in zip(zero_padded_parts(ts), names)]


def check_window(seconds: int) -> None:
    """A window length must divide an hour, or windows would straddle ingest hours."""
    if seconds < 1 or 3600 % seconds:
        raise ValueError(f"window of {seconds} s: a divisor of 3600 is needed")


def batch_window(ts: str | Column, seconds: int = MICRO_BATCH_SECONDS) -> Column:
    """Id of the fixed-length arrival window (micro-batch) a record falls in."""
    micros = F.unix_micros(to_utc_timestamp_col(ts))
    return F.floor(micros / F.lit(seconds * 1_000_000)).cast("bigint")


def hour_label(prefix: str = "ingest_") -> Column:
    """'yyyy-MM-dd HH:00:00' from the four text partition columns."""
    return F.concat(F.col(f"{prefix}year"), F.lit("-"), F.col(f"{prefix}month"),
                    F.lit("-"), F.col(f"{prefix}day"), F.lit(" "),
                    F.col(f"{prefix}hour"), F.lit(":00:00"))


def parse_range_hours(text: str, mode: str = "interval") -> int:
    """Range choice → number of hours.

    ``interval`` (default) reads the unit: "7 days" → 168.
    ``reference`` keeps only the leading number as hours: "7 days" → 7.
    """
    m = re.fullmatch(r"\s*(\d+)\s*([A-Za-z]*)\s*", text)
    if not m:
        raise ValueError(f"unrecognised range {text!r}")
    n, unit = int(m.group(1)), (m.group(2) or "hours").lower()
    if mode == "reference":
        return n
    if mode != "interval":
        raise ValueError(f"unknown range mode {mode!r}")
    if unit not in _UNIT_HOURS:
        raise ValueError(f"unknown range unit {unit!r}")
    return n * _UNIT_HOURS[unit]


def range_bound_text(as_of: str | None, hours: int) -> Column:
    """'yyyy-MM-dd HH:mm:ss' of (as_of − hours); as_of None = now.

    A constant expression: Catalyst folds it, so a comparison with the hour
    label over partition columns becomes a partition filter.
    """
    base = (F.current_timestamp().cast("timestamp_ntz") if as_of is None
            else F.lit(as_of).cast("timestamp_ntz"))
    return F.date_format(base - F.make_dt_interval(F.lit(0), F.lit(hours)),
                         "yyyy-MM-dd HH:mm:ss")


def interval_seconds(text: str) -> int:
    """Seconds of ``"<n> second(s) | minute(s) | hour(s) | day(s)"``."""
    found = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", text)
    if not found:
        raise ValueError(f"not an interval: {text!r}")
    return int(found[1]) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[found[2]]
