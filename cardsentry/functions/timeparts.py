"""Time-zone-free helpers for TIMESTAMP_NTZ columns and literals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_literal(value: str | dt.datetime | dt.date) -> Column:
    """A TIMESTAMP_NTZ literal from text, ``datetime`` or ``date``."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = f"{value.isoformat()} 00:00:00"
    return F.lit(value).cast("timestamp_ntz")
