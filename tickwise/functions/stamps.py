"""Run stamps as columns, the same instant whatever zone the driver is in."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc)


def as_utc(run_ts: _dt.datetime) -> _dt.datetime:
    """A stamp without a zone is UTC."""
    if run_ts.tzinfo is None:
        return run_ts.replace(tzinfo=_dt.timezone.utc)
    return run_ts.astimezone(_dt.timezone.utc)


def stamp(run_ts: _dt.datetime | Column | None) -> Column:
    """The stamp as a timestamp column, the query's start if there is none.

    Written as text with its offset: a plain datetime literal would be read in
    the driver's own zone.
    """
    if run_ts is None:
        return F.current_timestamp()
    if isinstance(run_ts, Column):
        return run_ts
    return F.lit(as_utc(run_ts).isoformat()).cast("timestamp")
