"""Facts of Parquet files from their footers: rows, and the first and last value of a column, without reading its pages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import date, datetime

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACTS = "path string, n_rows long, low timestamp, high timestamp, pages_read boolean"
KINDS = pa.schema([("path", pa.string()), ("n_rows", pa.int64()), ("low", pa.timestamp("us", "UTC")), ("high", pa.timestamp("us", "UTC")), ("pages_read", pa.bool_())])


def _open(uri: str) -> pq.ParquetFile:
    where, path = arrow_fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))
    return pq.ParquetFile(where.open_input_file(path))


def _time(x: date | datetime | None) -> datetime | None:
    return datetime(x.year, x.month, x.day) if isinstance(x, date) and not isinstance(x, datetime) else x


def facts_of(file: pq.ParquetFile, column: str | None) -> tuple[int, datetime | None, datetime | None, bool]:
    """(rows, low, high, whether the column had to be read: its statistics are missing in files of an old kind of times)."""
    meta = file.metadata
    at = next((k for k in range(meta.num_columns) if meta.row_group(0).column(k).path_in_schema == column), None) if column and meta.num_row_groups else None
    if at is None:
        return meta.num_rows, None, None, False
    lows, highs = [], []
    for g in range(meta.num_row_groups):
        chunk = meta.row_group(g).column(at)
        s = chunk.statistics
        if s is not None and s.has_min_max and isinstance(s.min, (date, datetime)):
            lows.append(s.min)
            highs.append(s.max)
        elif s is None or not s.has_null_count or s.null_count < chunk.num_values:
            span = pc.min_max(file.read(columns=[column]).column(0))
            return meta.num_rows, _time(span["min"].as_py()), _time(span["max"].as_py()), True
    return meta.num_rows, _time(min(lows, default=None)), _time(max(highs, default=None)), False


def file_statistics(spark: SparkSession, root: str, column: str | None = None) -> DataFrame:
    """(path, n_rows, low, high, pages_read) of each Parquet file under a root, low and high of a column of dates or times; files
    that cannot be opened are left out.  One footer a file is read, on executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for uri in batch.column(0).to_pylist():
                try:
                    found.append((uri, *facts_of(_open(uri), column)))
                except (OSError, pa.ArrowException):
                    continue
            cols = zip(*found) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(cols, KINDS)], schema=KINDS)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    return files.select(F.col("_metadata.file_path").alias("path")).mapInArrow(run, FACTS)
