"""Incremental update: from what the manifest has as done to new normalised rows and the station days that they touch.

Rows carry the raw file that they came from and are appended under the run that wrote them; they count once the manifest
names that run for their file's key.  So a run that breaks off leaves nothing behind that is read, a key that is processed
again replaces its old rows, and rows of a day that stand in the next day's file count with that file.  The manifest also
keeps the size and time of the files that it has seen: a key is pending if it is not done, or if a file of it is new or has
changed, wherever the high-water mark stands.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import schema
from skyledger.operators import daily, manifest, rules
from skyledger.sources import readers, registry

# The first day of each source's record.
SOURCE_START = {
    "madis": date(2001, 7, 1), "ghcnh": date(1900, 1, 1), "ghcnd": date(1840, 1, 1), "gdas": date(1997, 1, 1), "raws": date(1990, 1, 1), "ndbc": date(1970, 1, 1), "snotel": date(1980, 1, 1),
}
FILES_AT_ONCE = 20_000  # raw files of one step: so many names are held by the driver
LOG_FILES = 64  # files of the manifest's logs from which they are made one
HOURLY = ("madis", "ghcnh", "gdas", "ndbc")  # sources whose days are built


def key_of(source: str, path: Column) -> Column:
    """The key of a raw file: its day, year and name, province and station, or station."""
    kind = registry.get_source(source).keys
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    if kind == "days":
        return F.nullif(F.regexp_extract(name, r"(\d{8})", 1), F.lit(""))
    if kind == "year_files":
        return F.regexp_extract(path, r"([^/]*/[^/]*)$", 1)
    if source == "eccc":
        return F.upper(F.nullif(F.regexp_extract(name, r"_([A-Za-z]{2}_[0-9A-Za-z]+)_[^_]*$", 1), F.lit("")))
    stem = F.when(~name.contains("inventory"), F.substring_index(name, ".", 1))
    if source == "raws":
        return F.regexp_replace(stem, r"_\d{8}$", "")
    if source == "ndbc":
        return F.upper(F.regexp_replace(stem, r"(_latest|h\d{4})$", ""))
    return readers.snotel_station(name) if source == "snotel" else stem


def raw_files(spark: SparkSession, source: str, root: str) -> DataFrame:
    """(source, key, path, uri, length, modified) of the raw files under a root of any file system; no file is opened."""
    s = registry.get_source(source)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    files = files.select("path", F.col("_metadata.file_path").alias("uri"), "length", F.col("modificationTime").alias("modified"))
    named = [x for x in s.suffixes if x]
    fits = F.lit("" in s.suffixes)
    for x in named:
        fits = fits | F.col("path").endswith(x)
    files = files.where(fits).withColumn("key", key_of(source, F.col("path"))).where("key is not null")
    return files.select(F.lit(source).alias("source"), "key", "path", "uri", "length", "modified")


def pending_files(files: DataFrame, state: manifest.Manifest, *, start: date | None = None, end: date | None = None) -> DataFrame:
    """The files of each key that is not done, or has a file that is new or has changed since.  Of keys that are days those
    from start to end, and those before that the log knows: what failed or has changed there is taken up again."""
    log, seen = state.log(), state.files()
    by = ["source", "key"]
    known = files.join(seen.select(*by, "uri", "length", "modified"), [*by, "uri", "length", "modified"], "left_semi")
    fresh = files.join(known.select(*by, "uri"), [*by, "uri"], "left_anti").select(*by)
    keys = manifest.pending(files.select(*by), log).union(fresh).distinct()
    if start or end:
        day = F.coalesce(F.col("key").rlike(r"^\d{8}$"), F.lit(False))
        inside = (F.col("key") >= f"{start or date(1, 1, 1):%Y%m%d}") & (F.col("key") <= f"{end or date(9999, 12, 31):%Y%m%d}")
        entered = manifest.latest(log).select(*by).withColumn("entered", F.lit(True))
        keys = keys.join(entered, by, "left").where(~day | inside | F.coalesce("entered", F.lit(False))).select(*by)
    return files.join(keys, by, "left_semi")


def latest_day(log: DataFrame, source: str) -> date | None:
    """The high-water mark: the last day that is done."""
    top = manifest.done_keys(log, source).where(F.col("key").rlike(r"^\d{8}$")).agg(F.max("key")).first()[0]
    return date(int(top[:4]), int(top[4:6]), int(top[6:])) if top else None


def counted(rows: DataFrame, log: DataFrame) -> DataFrame:
    """The rows (raw_source, raw_key, run, ...) that count: those of the last run that did their file's key.  A later run that
    failed takes nothing away."""
    done = manifest.latest(log.where("state = 'done'")).select("source", "key", "run_id").withColumnsRenamed({"source": "raw_source", "key": "raw_key", "run_id": "run"})
    return rows.join(done, ["raw_source", "raw_key", "run"], "left_semi")


def committed(spark: SparkSession, out: str, log: DataFrame) -> DataFrame:
    """The normalised rows that the manifest counts."""
    return counted(spark.read.parquet(out), log)


@dataclass
class Done:
    """What an update did for a source."""

    source: str
    start: date
    end: date
    todo: int
    failed: int
    run_id: str


def _take(spark: SparkSession, source: str, files: DataFrame, out: str, state: manifest.Manifest, run: str, qcr: int) -> int:
    """Normalises files of whole keys; returns how many keys failed.  Each file is decoded once."""
    s, paths = registry.get_source(source), [r.path for r in files.select("path").collect()]  # FILES_AT_ONCE or so
    staged, corrupt = f"{out}_staged/{run}", spark.conf.get("spark.sql.files.ignoreCorruptFiles", "false")
    if s.scan:
        s.scan(spark, paths).write.mode("overwrite").parquet(staged)  # good rows and failures by one pass over the files
        native = spark.read.parquet(staged)
        failures = readers.decode_failures(native, source)
        df = s.shape(native.where("error is null"), run_id=run)
    else:
        failures, df = None, s.read(spark, paths, run_id=run)
    df = rules.apply_pipeline(df, rules.default_pipeline(source, qcr_mask=qcr), source=source)
    day = F.col("date") if "date" in df.columns else F.to_date("datetime_utc")
    rows = df.withColumns({"raw_source": F.lit(source), "raw_key": key_of(source, F.col(readers.RAW)), "run": F.lit(run), "obs_date": day})
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", str(s.scan is None).lower())
    try:
        rows.write.mode("append").partitionBy("raw_source", "run").parquet(out)
    finally:
        spark.conf.set("spark.sql.files.ignoreCorruptFiles", corrupt)
    if failures is None:  # files that gave no row are looked at: broken, or without any
        got = spark.read.parquet(out).where((F.col("raw_source") == source) & (F.col("run") == run)).select(F.col(readers.RAW).alias("uri")).distinct()
        silent = [r.path for r in files.join(got, "uri", "left_anti").select("path").collect()]
        failures = readers.decode_failures(readers.probed(spark, silent), source) if silent else spark.createDataFrame([], schema.FAILURE)
    report = f"{out}_failures/source={source}/run={run}"
    failures.select(*schema.FAILURE.names).write.mode("append").json(report)
    failures = spark.read.schema(schema.FAILURE).json(report)
    bad = failures.groupBy(key_of(source, F.col("input_file")).alias("key")).agg(F.min("error").alias("error"))
    states = files.select("source", "key").distinct().join(bad, "key", "left")
    states = states.select("source", "key", F.when(F.col("error").isNull(), "done").otherwise("failed").alias("state"), F.coalesce("error", F.lit("")).alias("message"))
    failed = states.where("state = 'failed'").count()
    state.saw(files, run)
    state.append(states, run)
    if s.scan:
        _delete(spark, staged)
    return failed


def normalize_pending(
    spark: SparkSession, source: str, raw: str, out: str, state: manifest.Manifest, *, start: date | None = None, end: date | None = None, profile: str = "strict", mask: int | None = None, again: bool = False, dry_run: bool = False,
    files_at_once: int = FILES_AT_ONCE,
) -> Done:
    """Normalises the raw files whose keys are not done or have changed (``again``: all of them) and writes rows, failures and
    states, some files at a time, so that what was done stays done if the rest breaks off."""
    start, end = start or SOURCE_START.get(source, date(1800, 1, 1)), end or date.today()
    files, run = raw_files(spark, source, raw), uuid.uuid4().hex[:12]
    todo = pending_files(files, state, start=start, end=end) if not again else files
    if dry_run:
        return Done(source, start, end, todo.select("key").distinct().count(), 0, run)
    listed = f"{out}_todo/{run}"  # listed once: the log changes while the files are taken
    todo.write.parquet(listed)
    todo = spark.read.schema(todo.schema).parquet(listed)
    n, keys, failed = todo.count(), todo.select("key").distinct().count(), 0
    parts = -(-n // files_at_once)
    for k in range(parts):
        part = todo.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == k)
        if not part.isEmpty():
            failed += _take(spark, source, part, out, state, run if parts == 1 else f"{run}-{k}", mask or rules.QCR_PROFILES[profile])
    _delete(spark, listed)
    return Done(source, start, end, keys, failed, run)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def build_days(spark: SparkSession, source: str, out: str, days_out: str, log: DataFrame, run: str) -> None:
    """Builds anew the days of the keys that a run did, those of their earlier rows too, from all rows that count.  Days
    that no row is left of are removed."""
    everything = spark.read.parquet(out).where(F.col("raw_source") == source)
    did = log.where((F.col("source") == source) & (F.col("state") == "done") & F.substring_index("run_id", "-", 1).eqNullSafe(run)).select(F.col("key").alias("raw_key")).distinct()
    days = everything.join(did, "raw_key", "left_semi").select("obs_date").distinct()
    touched = counted(everything, log).join(F.broadcast(days), "obs_date", "left_semi")  # a row a day
    built = schema.conform_daily(daily.aggregate_daily_wide(daily.drop_failed(touched), source=source))
    kept = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        built.withColumns({"raw_source": F.lit(source), "obs_date": F.col("date")}).write.mode("overwrite").partitionBy("raw_source", "obs_date").parquet(days_out)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", kept)
    for (day,) in days.join(daily.drop_failed(touched).select("obs_date").distinct(), "obs_date", "left_anti").collect():  # days
        _delete(spark, f"{days_out}/raw_source={source}/obs_date={day}")


def update(
    spark: SparkSession, raw: dict[str, str], out: str, manifest_path: str, *, days_out: str | None = None, profile: str = "permissive", end: date | None = None, dry_run: bool = False
) -> list[Done]:
    """For each source and its raw folder: what is new since the high-water mark, normalised; then its days."""
    state, did = manifest.Manifest(spark, manifest_path), []
    for source, root in raw.items():
        start = latest_day(state.log(), source) if registry.get_source(source).keys == "days" else None
        done = normalize_pending(spark, source, root, out, state, start=start, end=end, profile=profile, dry_run=dry_run)
        did.append(done)
        if days_out and source in HOURLY and done.todo > done.failed and not dry_run:
            build_days(spark, source, out, days_out, state.log(), done.run_id)
    if not dry_run:
        state.compact(LOG_FILES)
    return did

