"""Time-bucket and calendar functions (all JVM-side, codegen friendly).

Timestamps are handled as TIMESTAMP_NTZ holding UTC wall-clock time, which
is what the test Parquet files carry and what makes every function below
independent of the session time zone.  A TIMESTAMP (local time zone) input
is cast to NTZ first; with the UTC session this library pins, that is a
lossless change of type.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bucket origin of the reference's time_bucket for widths
# below one month (a Monday), and the weekday labels of to_char(ts, 'Dy').
BUCKET_ORIGIN = "2000-01-03 00:00:00"
WEEKDAYS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]

_UNIT_SECONDS = {
    "microsecond": 1e-6, "millisecond": 1e-3,
    "second": 1, "sec": 1, "s": 1,
    "minute": 60, "min": 60, "m": 60,
    "hour": 3600, "h": 3600,
    "day": 86400, "d": 86400,
    "week": 7 * 86400, "w": 7 * 86400,
}


def parse_width(width) -> timedelta:
    """'10 minutes', '1 hour', '1 day', '01:00:00', 600, or a timedelta."""
    if isinstance(width, timedelta):
        return width
    if isinstance(width, (int, float)):
        return timedelta(seconds=width)
    text = str(width).strip().lower()
    m = re.fullmatch(r"(\d+):(\d{2}):(\d{2})", text)
    if m:
        h, mi, s = (int(g) for g in m.groups())
        return timedelta(hours=h, minutes=mi, seconds=s)
    total = 0.0
    for num, unit in re.findall(r"([\d.]+)\s*([a-z]+)", text):
        key = unit.rstrip("s") if unit.rstrip("s") in _UNIT_SECONDS else unit
        if key not in _UNIT_SECONDS:
            raise ValueError(f"unknown interval unit in {width!r}")
        total += float(num) * _UNIT_SECONDS[key]
    if total <= 0:
        raise ValueError(f"cannot parse interval {width!r}")
    return timedelta(seconds=total)


def _micros(width) -> int:
    td = parse_width(width)
    return td.days * 86_400_000_000 + td.seconds * 1_000_000 + td.microseconds


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal; constant-folded, so filters on it reach the scan."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def as_ntz(ts) -> Column:
    return _col(ts).cast("timestamp_ntz")


def time_bucket(ts, width, origin: str = BUCKET_ORIGIN) -> Column:
    """Start of the fixed-width bucket holding ``ts`` (UTC aligned).

    Plain arithmetic on microseconds since ``origin`` - unlike ``window()``
    it can be used several times in one projection and adds no struct.
    """
    w = _micros(width)
    t = as_ntz(ts)
    since = F.timestamp_diff("MICROSECOND", ntz_literal(origin), t)
    return F.timestamp_add("MICROSECOND", -F.pmod(since, F.lit(w)), t)


def at_time_zone(ts, tz: str) -> Column:
    """``ts AT TIME ZONE tz`` for an instant: the local wall-clock time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), as_ntz(ts))


def from_local(local_ts, tz: str) -> Column:
    """Inverse of :func:`at_time_zone` (an ambiguous local time maps to the
    earlier instant)."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), as_ntz(local_ts))


def local_bucket(ts, width, tz: str, origin: str = BUCKET_ORIGIN) -> Column:
    """time_bucket(width, ts, tz): bucket on local wall-clock time, returned
    as the UTC instant where the local bucket starts."""
    return from_local(time_bucket(at_time_zone(ts, tz), width, origin), tz)


def bucket(ts, width, tz: str | None = None) -> Column:
    return local_bucket(ts, width, tz) if tz else time_bucket(ts, width)


def weekday_abbrev(ts) -> Column:
    """to_char(ts, 'Dy'): 'Sun' .. 'Sat'."""
    return F.date_format(as_ntz(ts), "E")


def hour_of_day(ts) -> Column:
    return F.hour(as_ntz(ts))


def hour_interval(ts) -> Column:
    """extract(HOUR FROM ts) * interval '1 hour'."""
    return F.make_dt_interval(F.lit(0), hour_of_day(ts))


def month_start(ts) -> Column:
    return F.date_trunc("month", as_ntz(ts))


def epoch_seconds(ts) -> Column:
    return F.timestamp_diff("SECOND", ntz_literal("1970-01-01 00:00:00"), as_ntz(ts))


def from_epoch_seconds(secs) -> Column:
    """Epoch seconds → TIMESTAMP_NTZ in UTC (utcfromtimestamp)."""
    return F.timestamp_add("SECOND", _col(secs), ntz_literal("1970-01-01 00:00:00"))


def ntz_to_instant(ts) -> Column:
    """UTC wall-clock (TIMESTAMP_NTZ) → TIMESTAMP instant, independent of the
    session time zone (a plain cast would apply the session offset)."""
    micros = F.timestamp_diff("MICROSECOND", ntz_literal("1970-01-01 00:00:00"), as_ntz(ts))
    return F.timestamp_micros(micros)


def instant_to_ntz(ts) -> Column:
    """TIMESTAMP instant → UTC wall-clock TIMESTAMP_NTZ, session-independent."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)),
                           ntz_literal("1970-01-01 00:00:00"))


def trailing(ts, as_of, span, inclusive: bool = False) -> Column:
    """``ts > as_of - span`` (``>=`` when inclusive), as_of a datetime/str."""
    lo = ntz_literal(as_of_dt(as_of) - parse_width(span))
    return as_ntz(ts) >= lo if inclusive else as_ntz(ts) > lo


def as_of_dt(as_of) -> datetime:
    if isinstance(as_of, datetime):
        return as_of
    return datetime.fromisoformat(str(as_of))


# Python-side bucket arithmetic for refresh windows (scalars, not rows).
_ORIGIN_DT = datetime.fromisoformat(BUCKET_ORIGIN)


def bucket_floor(t: datetime, width) -> datetime:
    w = parse_width(width)
    return t - ((t - _ORIGIN_DT) % w)


def bucket_ceil(t: datetime, width) -> datetime:
    f = bucket_floor(t, width)
    return f if f == t else f + parse_width(width)


def earliest_time_for_bucket(lo: datetime, width, inclusive: bool) -> datetime:
    """Smallest time whose bucket satisfies ``bucket >= lo`` (inclusive) or
    ``bucket > lo``: the implied raw-time bound of a bucket predicate, which
    can be pushed into the scan where the bucket predicate cannot."""
    first = bucket_ceil(lo, width)
    if not inclusive and first == lo:
        first = first + parse_width(width)
    return first
