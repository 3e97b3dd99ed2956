"""Late cycles of model archives merged as a stream: one row for each station and time, then its day, once both are closed.

A time's rows may stand in several files, and come in any order.  Two stateful operators follow each other: the first keeps, for
each station and time, the first value of each column by cycle, and lets it go when the watermark has passed the time; the
second takes these rows into their days.  Both states are built-in aggregates of fixed size, so no row is kept, and a restart
goes on from the checkpoint.  Rows later than ``late`` are dropped, as their time has been given out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from skyledger.operators.temporal import prepare_gdas
from skyledger.streaming.daily import daily_stream


def stitched_stream(rows: DataFrame, *, late: str = "2 days") -> DataFrame:
    """What prepare_gdas gives for a batch, for a stream of canonical rows whose times come out once they are closed."""
    return prepare_gdas(rows.withWatermark("datetime_utc", late))


def stitched_days_stream(rows: DataFrame, *, value: str = "tair", required: int = 18, late: str = "2 days") -> DataFrame:
    """Station days of the stitched rows; a reading that several cycles hold counts once."""
    return daily_stream(stitched_stream(rows, late=late), value=value, required=required, late=None)
