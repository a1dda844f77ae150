"""Zone transition tables: a clock's offsets by UTC and by local second, from the installed time zone release."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta
from functools import cache
from zoneinfo import ZoneInfo

import numpy as np

FIRST, LAST = -2208988800, 4102444800  # 1900 to 2100


@cache
def version() -> str:
    """The release of the zone tables in use."""
    for path in ("/usr/share/zoneinfo/tzdata.zi", "/usr/share/zoneinfo/+VERSION"):
        try:
            with open(path) as f:
                return f.readline().removeprefix("# version").strip()
        except OSError:
            continue
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        return "unknown"


@cache
def transitions(zone: str) -> tuple[np.ndarray, np.ndarray] | None:
    """UTC seconds at which the zone's offset changes, and the offset from each on; None for an unknown zone."""
    try:
        info = ZoneInfo(zone)
    except Exception:
        return None

    def offset(t: int) -> int:
        at = datetime(1970, 1, 1, tzinfo=UTC) + timedelta(seconds=t)
        return int(at.astimezone(info).utcoffset().total_seconds())

    at, offsets, step = [FIRST], [offset(FIRST)], 14 * 86400
    for t in range(FIRST, LAST, step):
        lo, hi = t, t + step
        while offset(hi) != offsets[-1]:
            a, b = lo, hi
            while b - a > 1:
                m = (a + b) // 2
                a, b = (m, b) if offset(m) == offsets[-1] else (a, m)
            at.append(b)
            offsets.append(offset(b))
            lo = b
    return np.array(at, np.int64), np.array(offsets, np.int64)


def local_to_utc(local: np.ndarray, zone: str) -> np.ndarray | None:
    """UTC seconds of clock seconds; a clock time that occurs twice means the earlier instant.

    One that the clock skips is read by the offset before the skip.
    """
    table = transitions(zone)
    if table is None:
        return None
    at, offsets = table
    # The clock shows local times up to at[i] + offsets[i-1] by the old offset.
    until = at[1:] + offsets[:-1]
    until = np.maximum(until, at[1:] + offsets[1:])
    return local - offsets[np.searchsorted(until, local, side="right")]
