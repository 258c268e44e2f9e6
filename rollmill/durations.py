"""ISO-8601 durations and intervals, as they appear in job settings."""

from __future__ import annotations

import calendar
import re
from datetime import datetime, timedelta, timezone

_DURATION = re.compile(
    r"^P(?:(?P<years>\d+)Y)?(?:(?P<months>\d+)M)?(?:(?P<weeks>\d+)W)?(?:(?P<days>\d+)D)?"
    r"(?:T(?:(?P<hours>\d+)H)?(?:(?P<minutes>\d+)M)?(?:(?P<seconds>\d+(?:\.\d+)?)S)?)?$"
)


def _fields(text: str) -> dict[str, float]:
    found = _DURATION.match(text.strip())
    if not found or text.strip() in ("P", "PT"):
        raise ValueError(f"not an ISO-8601 duration: {text!r}")
    return {k: float(v) if v else 0.0 for k, v in found.groupdict().items()}


def duration_millis(text: str) -> int:
    """Length in whole seconds, as milliseconds. Calendar units have no fixed length and are refused."""
    f = _fields(text)
    if f["years"] or f["months"]:
        raise ValueError(f"years and months have no fixed length: {text!r}")
    span = timedelta(
        weeks=f["weeks"], days=f["days"], hours=f["hours"], minutes=f["minutes"], seconds=f["seconds"]
    )
    if span.microseconds:
        raise ValueError(f"not in whole seconds: {text!r}")
    return int(span.total_seconds()) * 1000


def shift(start: datetime, text: str, sign: int = 1) -> datetime:
    """Add (or subtract) a duration, counting months on the calendar."""
    f = _fields(text)
    months = start.year * 12 + start.month - 1 + sign * int(f["years"] * 12 + f["months"])
    year, month = divmod(months, 12)
    day = min(start.day, calendar.monthrange(year, month + 1)[1])
    span = timedelta(
        weeks=f["weeks"], days=f["days"], hours=f["hours"], minutes=f["minutes"], seconds=f["seconds"]
    )
    return start.replace(year=year, month=month + 1, day=day) + sign * span


def _instant(text: str) -> datetime:
    found = datetime.fromisoformat(text)
    return found.replace(tzinfo=timezone.utc) if found.tzinfo is None else found.astimezone(timezone.utc)


def interval_bounds(text: str) -> tuple[datetime, datetime]:
    """``start/end``, ``start/duration`` or ``duration/end`` as UTC bounds, end excluded."""
    left, slash, right = text.partition("/")
    if not slash:
        raise ValueError(f"not an ISO-8601 interval: {text!r}")
    if left.startswith("P"):
        end = _instant(right)
        return shift(end, left, -1), end
    start = _instant(left)
    return start, (shift(start, right) if right.startswith("P") else _instant(right))
