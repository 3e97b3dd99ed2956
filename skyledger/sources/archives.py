"""Archives of whole files as Spark data sources: files outside the asked time are never opened, rows outside the asked box
never leave the decoder.

``spark.read.format("madis_archive").load(root)`` (hourly netCDF files) and ``"gdas_archive"`` (day archives, with a BUFR decoder
named by the caller) give the native rows, with ``file_key`` (the file's day or day_hour, from its name), ``path`` and ``error``.
Filters are written as on any DataFrame.  Comparisons of ``file_key`` choose files when the scan is planned; those of numbers
are applied to a file's arrays before rows are made of them.  Partitions hold neighbouring files of about ``partitionBytes``.
A file that cannot be decoded is one row with its error, unless a comparison of numbers is asked for, which null never meets.
"""

from __future__ import annotations

import importlib
import operator
import re
from collections.abc import Iterator
from datetime import datetime
from typing import Any

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skyledger.sources import readers

PARTITION_BYTES = 32 << 20
COMPARE = {D.EqualTo: operator.eq, D.GreaterThan: operator.gt, D.GreaterThanOrEqual: operator.ge, D.LessThan: operator.lt, D.LessThanOrEqual: operator.le}


class Files(D.InputPartition):
    def __init__(self, files: list[tuple[str, str]]):
        self.files = files  # (key, path), in order


class ArchiveReader(D.DataSourceReader):
    """Lists, prunes and decodes files; what a format adds is its key, its suffixes and how a file becomes columns."""

    key_pattern, suffixes = r"(\d{8}_\d{4})", (".gz", ".nc")

    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema = schema
        self.root, self.most = options["path"], int(options.get("partitionBytes", PARTITION_BYTES))
        self.numbers = {f.name for f in schema if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.LongType, T.IntegerType))}
        self.key_tests: list[tuple[Any, Any]] = []
        self.tests: list[tuple[str, Any, Any]] = []  # (column, comparison, value); IsNotNull compares with nothing

    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            compare = COMPARE.get(type(f))
            if name == "file_key" and isinstance(f, D.IsNotNull):
                pass
            elif name == "file_key" and compare and isinstance(f.value, str):
                self.key_tests.append((compare, f.value))
            elif name in self.numbers and isinstance(f, D.IsNotNull):
                self.tests.append((name, None, None))
            elif name in self.numbers and compare and isinstance(f.value, (int, float)) and f.value == f.value:
                self.tests.append((name, compare, f.value))
            else:
                yield f

    def partitions(self) -> list[Files]:
        where, root = arrow_fs.FileSystem.from_uri(self.root if "://" in self.root else re.sub("^file:", "", self.root))
        listed = where.get_file_info(arrow_fs.FileSelector(root, recursive=True))
        found = []
        for x in listed:
            hit = re.search(self.key_pattern, x.base_name)
            if x.is_file and hit and x.base_name.endswith(self.suffixes) and all(test(hit[1], value) for test, value in self.key_tests):
                found.append((hit[1], x.path, x.size))
        parts, held = [], 0
        for key, path, size in sorted(found):
            if not parts or held + size > self.most:
                parts.append([])
                held = 0
            parts[-1].append((key, path))
            held += size
        return [Files(p) for p in parts]

    def columns(self, path: str, content: bytes) -> pa.Table:
        """A file's rows that meet the tests, without file_key, path and error."""
        raise NotImplementedError

    def met(self, values: dict[str, np.ndarray], n: int) -> np.ndarray:
        """Which rows meet the tests; a missing number (NaN) meets none."""
        ok = np.ones(n, bool)
        for name, compare, value in self.tests:
            x = values.get(name)
            ok &= np.zeros(n, bool) if x is None else ~np.isnan(x) if compare is None else compare(x, value)
        return ok

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(self.schema)
        where, _ = arrow_fs.FileSystem.from_uri(self.root if "://" in self.root else re.sub("^file:", "", self.root))
        for key, path in partition.files:
            error = None
            try:
                with where.open_input_stream(path, compression=None) as f:
                    rows = self.columns(path, f.read())
            except Exception as e:  # noqa: BLE001
                if self.tests:
                    continue
                rows, error = pa.table({self.schema.names[0]: pa.nulls(1)}), f"{type(e).__name__}: {e}"
            n = len(rows)
            same = {"file_key": key, "path": path, "error": error}
            arrays = [pa.array([same[f.name]] * n, f.type) if f.name in same else rows.column(f.name).cast(f.type) if f.name in rows.column_names else pa.nulls(n, f.type) for f in kinds]
            yield from pa.table(arrays, schema=kinds).to_batches()


class MadisReader(ArchiveReader):
    def columns(self, path: str, content: bytes) -> pa.Table:
        return pa.table(readers.madis_columns(path, content, self.met))


class GdasReader(ArchiveReader):
    key_pattern, suffixes = r"(\d{8})", (".tar.gz", ".tar", ".tgz")

    def __init__(self, schema: T.StructType, options: dict[str, str]):
        super().__init__(schema, options)
        module, _, name = options["decoder"].partition(":")
        self.decode = getattr(importlib.import_module(module), name)

    def columns(self, path: str, content: bytes) -> pa.Table:
        kinds = pa.schema([f for f in to_arrow_schema(self.schema) if f.name not in ("file_key", "path", "error")])
        rows = pa.Table.from_pylist([r for _, hour, data in readers.archive_members(path, content) for r in self.decode(data, hour)], kinds)
        values = {name: rows.column(name).cast(pa.float64()).to_numpy() for name, _, _ in self.tests}
        return rows.filter(pa.array(self.met(values, len(rows))))


class MadisArchive(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "madis_archive"

    def schema(self) -> str:
        return f"{readers.MADIS_FIELDS}, file_key string, path string, error string"

    def reader(self, schema: T.StructType) -> ArchiveReader:
        return MadisReader(schema, self.options)


class GdasArchive(D.DataSource):
    """Options: decoder (module:function of bytes and the cycle's hour, to rows as dicts) and fields (their columns)."""

    @classmethod
    def name(cls) -> str:
        return "gdas_archive"

    def schema(self) -> str:
        return f"{self.options['fields']}, file_key string, path string, error string"

    def reader(self, schema: T.StructType) -> ArchiveReader:
        return GdasReader(schema, self.options)


def register(spark: SparkSession) -> SparkSession:
    """Makes the formats known to a session, and lets filters reach them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (MadisArchive, GdasArchive):
        spark.dataSource.register(source)
    return spark


def scan_archive(
    spark: SparkSession, name: str, root: str, *, start: datetime | None = None, end: datetime | None = None, bounds: tuple[float, float, float, float] | None = None, **options: str
) -> DataFrame:
    """Native rows of an archive, of the files from start to end (their hours or days, both included), in a half-open box."""
    df = register(spark).read.format(name).options(**options).load(root)
    form = "%Y%m%d_%H%M" if name == "madis_archive" else "%Y%m%d"
    if start:
        df = df.where(F.col("file_key") >= start.strftime(form))
    if end:
        df = df.where(F.col("file_key") <= end.strftime(form))
    return readers.in_bounds(df, *bounds) if bounds else df


def read_madis_archive(spark: SparkSession, root: str, *, qcr_mask: int = 115, run_id: str | None = None, **how) -> DataFrame:
    """Canonical rows; how: as for scan_archive."""
    return readers.extract_madis(scan_archive(spark, "madis_archive", root, **how), qcr_mask=qcr_mask, run_id=run_id)


def read_gdas_archives(spark: SparkSession, root: str, decoder: str, fields: str, *, run_id: str | None = None, **how) -> DataFrame:
    """Canonical rows of day archives."""
    df = scan_archive(spark, "gdas_archive", root, decoder=decoder, fields=fields, **how)
    return readers.normalize_gdas(df.where("error is null").withColumnRenamed("path", "__file"), run_id)
