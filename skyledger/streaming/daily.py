"""Daily aggregation and incremental update as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skyledger.operators.daily import coverage


def daily_stream(rows: DataFrame, *, station: str = "station_key", ts: str = "datetime_utc", value: str = "value", required: int = 18, late: str | None = "2 days") -> DataFrame:
    """Station days of a stream of readings: tumbling UTC days with a watermark (None: the rows have one).  Hours are counted by a bit mask, which
    is a constant-size state, as streams know no distinct counts."""
    aggs = coverage(F.col(ts), required)
    day = F.window(F.col(ts), "1 day")
    out = (rows.withWatermark(ts, late) if late else rows).groupBy(day.alias("w"), F.col(station).alias("station_key")).agg(
        F.max(value).alias("tmax"), F.min(value).alias("tmin"), F.avg(value).alias("tmean"), *(c.alias(n) for n, c in aggs.items())
    )
    return out.select("station_key", F.to_date("w.start").alias("date"), "tmax", "tmin", "tmean", *aggs)


def run_available(spark: SparkSession, path: str, schema: T.StructType, transform, sink: str, checkpoint: str, *, mode: str = "append", files: int = 64) -> StreamingQuery:
    """Processes what is new under ``path`` since the checkpoint, then stops: the incremental update."""
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    q = transform(source).writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint)
    query = q.format("parquet").option("path", sink).start() if mode == "append" else q.format("memory").queryName(sink).start()
    query.awaitTermination()
    return query
