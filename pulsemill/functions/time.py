"""Epoch numbers and bin starts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since the epoch, truncated. Accepts timestamps without a zone (read as UTC)."""
    return F.unix_millis(ts.cast("timestamp"))


def epoch_us(ts: Column) -> Column:
    """Microseconds since the epoch."""
    return F.unix_micros(ts.cast("timestamp"))


def duration_us(start: Column, end: Column) -> Column:
    """Microseconds from ``start`` to ``end``."""
    return epoch_us(end) - epoch_us(start)


def bin_start(ms: Column, width_ms: int | Column = 60_000) -> Column:
    """Start of the bin that holds ``ms``; integer division truncates toward zero."""
    width = F.lit(width_ms) if isinstance(width_ms, int) else width_ms
    return ms - ms % width
