"""Time expressions shared by batch and streaming plans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def naive(moment: dt.datetime) -> Column:
    """A naive UTC constant; a plain literal would be read in the Python process's own zone."""
    return F.lit(moment.isoformat()).cast("timestamp_ntz")


def now_millis() -> Column:
    """The query's (or micro-batch's) clock as a naive UTC stamp in milliseconds."""
    return F.date_trunc("MILLISECOND", F.current_timestamp()).cast("timestamp_ntz")


def whole_seconds_between(start: str, end: str) -> Column:
    """Whole seconds elapsed, truncated towards zero."""
    return F.timestamp_diff("SECOND", F.col(start), F.col(end))


def tumble(time_column: str, size: str) -> Column:
    return F.window(F.col(time_column), size)
