from __future__ import annotations

from pyspark.sql import Column, functions as F

from annolink._util import col_of


def epoch_ms_to_iso(ms) -> Column:
    """Epoch milliseconds -> ``yyyy-MM-ddTHH:mm:ss`` in the session time zone (no
    fraction, no zone suffix).  Jobs pin the session zone to UTC."""
    return F.date_format(F.timestamp_millis(col_of(ms)), "yyyy-MM-dd'T'HH:mm:ss")
