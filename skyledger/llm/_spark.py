"""Spark plumbing shared by the operators."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(texts: DataFrame) -> int:
    """UTF-8 bytes of the column text."""
    return texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0


LEAST_BUCKETS = 64  # of a small input, so that all cores have some
BUCKET_BYTES = 2 << 20  # of text a bucket


def buckets_of(size: int, each: int = BUCKET_BYTES) -> int:
    """Buckets for so many bytes of text: their number follows the input, whatever the session's settings."""
    return max(LEAST_BUCKETS, -(-size // each))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a local one where that is unset
    (single-machine runs and tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        import tempfile

        at = f"file://{tempfile.gettempdir()}/skyledger-checkpoints"
    return at


ID_SHARE = 8  # tables of ids are small beside the texts: so many shuffle partitions of theirs make one file


def stored(df: DataFrame, spark: SparkSession, *, ids: bool = False) -> DataFrame:
    """df written as a table in the shared folder and read again: it survives lost executors and is computed once.
    ids: rows of a few numbers, in fewer files."""
    return Scratch(spark).stored(df, ids=ids)


class Scratch:
    """The stored tables of one operator; those that its result does not read are deleted at the end."""

    def __init__(self, spark: SparkSession):
        self.spark, self._tables = spark, []

    def stored(self, df: DataFrame, *, ids: bool = False, by: str | None = None) -> DataFrame:
        """by: a column that the rows are written into folders by."""
        path = f"{shared_dir(self.spark)}/skyledger-{uuid.uuid4().hex}"
        if ids:
            df = df.coalesce(max(8, shuffle_partitions(self.spark) // ID_SHARE))
        df.write.parquet(path, partitionBy=by)
        out = (self.spark.read.schema(df.schema) if by else self.spark.read).parquet(path)
        self._tables.append((path, out))
        return out

    def close(self, *kept: DataFrame) -> None:
        for path, df in self._tables:
            if not any(df is k for k in kept):
                delete(self.spark, path)
        self._tables = [(p, d) for p, d in self._tables if any(d is k for k in kept)]


def delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m; the rule that holds out labels."""
    return F.crc32(doc_id.cast("string").cast("binary")) % m


def columns(batch: pa.RecordBatch, *names: str) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(n)) for n in names]
