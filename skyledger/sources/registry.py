"""The registered sources, key discovery and acquisition addresses."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources import acquire
from skyledger.sources import readers as R


@dataclass(frozen=True)
class Source:
    name: str
    read: Callable[..., DataFrame]
    keys: str  # days, stems, year_files
    suffixes: tuple[str, ...]
    daily: bool = False
    parallel: bool = True
    note: str = ""
    #: For files that are decoded as wholes: their native rows with (path, error), and what makes canonical rows of these.
    scan: Callable[[SparkSession, R.Paths], DataFrame] | None = None
    shape: Callable[..., DataFrame] | None = None

    def fetch_raw(self, jobs: list[acquire.Job], **how) -> list[tuple[str, str, str]]:
        """(key, state, message) of the files that are had from the source's addresses."""
        return acquire.run_jobs(jobs, threads=how.pop("threads", 8 if self.parallel else 1), **how)

    def output_filename(self, key: str) -> str:
        return f"{key.removesuffix('.gz').replace('/', '_')}.parquet"


def _has(spark: SparkSession, path: R.Paths, suffix: str = ".parquet") -> bool:
    """Whether there are files of a kind: among the named ones, or in the folder, of any file system."""
    if not isinstance(path, str):
        return any(p.endswith(suffix) for p in path)
    if path.endswith(suffix):
        return True
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return not names.where(F.col("path").endswith(suffix)).isEmpty()


def _snotel(spark: SparkSession, path: R.Paths, run_id: str | None = None) -> DataFrame:
    """Answers of the service or hourly Parquet where there are any, else the daily CSV."""
    if _has(spark, path, ".json"):
        return R.read_snotel_json(spark, path, run_id)
    hourly = _has(spark, path)
    return (R.read_snotel_hourly if hourly else R.read_snotel_daily)(spark, path, run_id)


def _ndbc(spark: SparkSession, path: R.Paths, run_id: str | None = None) -> DataFrame:
    parsed = _has(spark, path)
    return (R.read_ndbc_parquet if parsed else R.read_ndbc_text)(spark, path, run_id)


def _raws(spark: SparkSession, path: R.Paths, run_id: str | None = None) -> DataFrame:
    return (R.read_raws_html if _has(spark, path, ".html") else R.read_raws)(spark, path, run_id)


_ALL = {
    s.name: s
    for s in (
        Source("madis", R.read_madis, "days", (".gz", ".nc"), scan=R.scan_madis, shape=R.extract_madis), Source("isd", R.read_isd, "year_files", (".gz", ""), note="superseded by ghcnh", scan=R.scan_text, shape=R.isd_of_text), Source("ghcnh", R.read_ghcnh, "stems", (".psv",)),
        Source("ghcnd", R.read_ghcnd, "stems", (".csv",), daily=True), Source("gdas", R.read_gdas_parquet, "days", (".parquet",)), Source("raws", _raws, "stems", (".csv", ".parquet", ".html"), daily=True, parallel=False),
        Source("ndbc", _ndbc, "stems", (".parquet", ".txt", ".txt.gz")), Source("snotel", _snotel, "stems", (".parquet", ".csv", ".json")), Source("eccc", R.read_eccc, "stems", (".csv",)),
    )
}


def list_sources() -> list[str]:
    return sorted(_ALL)


def get_source(name: str) -> Source:
    if name not in _ALL:
        raise KeyError(f"unknown source {name!r}; known: {', '.join(list_sources())}")
    return _ALL[name]


def register(source: Source) -> None:
    _ALL[source.name] = source


def discover_keys(name: str, root: str, start: date | None = None, end: date | None = None) -> list[str]:
    """Days from start to end, file stems, or year/file, by source."""
    s = get_source(name)
    if s.keys == "days":
        if not (start and end):
            raise ValueError("start and end are needed")
        return [f"{start + timedelta(k):%Y%m%d}" for k in range((end - start).days + 1)]
    base = Path(root)
    files = sorted(f for f in base.rglob("*") if f.is_file() and (f.name.endswith(tuple(x for x in s.suffixes if x)) or ("" in s.suffixes and not f.suffix)))
    if s.keys == "year_files":
        return [f"{f.parent.name}/{f.name}" for f in files if not start or not f.parent.name.isdigit() or start.year <= int(f.parent.name) <= (end or start).year]
    if name == "eccc":
        return sorted({m[1].upper() for f in files if (m := re.search(r"_([A-Za-z]{2}_[0-9A-Za-z]+)_[^_]*$", f.name))})
    stems = {f.name.split(".")[0] for f in files if "inventory" not in f.name}
    return sorted({x.upper() for x in stems} if name == "ndbc" else stems)
