"""Processing state by (source, key): an append-only log; the last entry counts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import schema


def latest(log: DataFrame, *, keys: tuple[str, ...] = ("source", "key")) -> DataFrame:
    """The last state of each key; of entries of one time the greatest run and state."""
    rest = [c for c in log.columns if c not in keys]
    best = F.max(F.struct("updated_utc", *(c for c in rest if c != "updated_utc"))).alias("b")
    return log.groupBy(*keys).agg(best).select(*keys, *(F.col(f"b.{c}").alias(c) for c in rest))


def pending(keys: DataFrame, log: DataFrame) -> DataFrame:
    """Keys (source, key) that are not done."""
    return keys.join(latest(log).where("state = 'done'").select("source", "key"), ["source", "key"], "left_anti")


def done_keys(log: DataFrame, source: str) -> DataFrame:
    return latest(log).where((F.col("source") == source) & (F.col("state") == "done")).select("key")


def summary(log: DataFrame) -> DataFrame:
    return latest(log).groupBy("source", "state").agg(F.count(F.lit(1)).alias("n"))


class Manifest:
    """The log at a path.  Updates append a file each; compact() makes one of them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def log(self) -> DataFrame:
        return self._read(self.path, schema.MANIFEST)

    def _read(self, path: str, kind: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(kind).parquet(path)
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], kind)
            raise

    def update(self, rows: list[tuple[str, str, str, str]], run_id: str | None = None) -> None:
        """rows: (source, key, state, message)."""
        for _, _, state, _ in rows:
            if state not in schema.MANIFEST_STATES:
                raise ValueError(f"invalid state {state!r}")
        run = run_id or uuid.uuid4().hex[:12]
        self.append(self.spark.createDataFrame(rows, "source string, key string, state string, message string"), run)

    def append(self, df: DataFrame, run: str) -> None:
        """Rows (source, key, state, message) of any number."""
        df = df.withColumns({"updated_utc": F.current_timestamp(), "run_id": F.lit(run)}).select(*schema.MANIFEST.names)
        df.coalesce(1).write.mode("append").parquet(self.path)

    def files(self) -> DataFrame:
        """The raw files that runs have seen: (source, key, uri, length, modified, run_id)."""
        return self._read(f"{self.path}_files", schema.RAW_FILE)

    def saw(self, files: DataFrame, run: str) -> None:
        files.select("source", "key", "uri", "length", "modified", F.lit(run).alias("run_id")).coalesce(1).write.mode("append").parquet(f"{self.path}_files")

    def get_state(self, source: str, key: str) -> str | None:
        row = latest(self.log()).where((F.col("source") == source) & (F.col("key") == key)).first()
        return row["state"] if row else None

    def compact(self, most_files: int = 0) -> bool:
        """Leaves of each key its last entry and the last that is done, and of the files seen each once; only where a log has more
        than so many files.  The smaller log is moved in before the old files go, and entries that stand twice count once, so
        a reader or a run that breaks off in between finds all of it."""
        log = self.log()
        small = latest(log).unionByName(latest(log.where("state = 'done'"))).select(*schema.MANIFEST.names).distinct()
        return any([self._replace(self.path, log, small, most_files), self._replace(f"{self.path}_files", self.files(), self.files().distinct(), most_files)])

    def _replace(self, path: str, log: DataFrame, small: DataFrame, most_files: int) -> bool:
        old = log.inputFiles()  # a file a run, since the last time
        if len(old) <= max(most_files, 1):
            return False
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = hadoop(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        aside = f"{path}.{uuid.uuid4().hex}"
        small.coalesce(1).write.parquet(aside)
        for f in fs.globStatus(hadoop(f"{aside}/part-*")):
            fs.rename(f.getPath(), hadoop(f"{path}/{f.getPath().getName()}"))
        for f in old:
            fs.delete(hadoop(f), False)
        fs.delete(hadoop(aside), True)
        return True
