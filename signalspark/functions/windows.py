"""Time-window helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the velocity window set ---
WINDOWS = {"1m": "1 minute", "5m": "5 minutes", "1h": "1 hour"}
# --- end of fixed values ---

_UNIT_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000,
}


#: label symbols, largest unit first
_SYMBOLS = [("d", "day"), ("h", "hour"), ("m", "minute"), ("s", "second"), ("ms", "millisecond"), ("us", "microsecond")]


def window_label(window: str) -> str:
    """A short name from the window's length, in the largest unit that divides it: 300 s is ``5m``.

    Lengths without a fixed size (months, years) have no label and are refused.
    """
    length = interval_micros(window)
    return next(f"{length // _UNIT_US[u]}{symbol}" for symbol, u in _SYMBOLS if length % _UNIT_US[u] == 0)


def interval_micros(window: str) -> int:
    """Length of a fixed interval string such as ``"10 minutes"`` in microseconds."""
    n, unit = window.split()
    unit = unit.lower().rstrip("s")
    return int(float(n) * _UNIT_US[unit])


def window_end(ts: Column | str, window: str) -> Column:
    """End of the epoch-aligned tumbling window holding ``ts`` (start-inclusive).

    Same value as ``window(ts, w).end`` but plain arithmetic, so several
    window sizes can be computed in one projection.
    """
    s = interval_micros(window)
    us = F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(s)) + F.lit(s))


def window_end_sql(ts: str, window: str) -> str:
    """DuckDB text for :func:`window_end`."""
    s = interval_micros(window)
    return f"make_timestamp((epoch_us({ts}) // {s} + 1) * {s})"
