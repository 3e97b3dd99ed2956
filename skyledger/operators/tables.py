"""Co-located tables: rows dealt out over buckets by a key and sorted in them, so that joins and groupings by that key, or
by it and more, move no row.

Files carry their bucket in their names, so a table can be attached again by another session, from its folder alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 100  # fixed value: buckets that stations are dealt out over, unless the caller has more


def quoted(*names: str) -> str:
    return ", ".join(f"`{n}`" for n in names)


def write(df: DataFrame, table: str, path: str, key: str, *, sort: tuple[str, ...] = (), buckets: int = BUCKETS) -> DataFrame:
    """df as a bucketed table at a path, one file a bucket; returns it as it is read back."""
    df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key, *sort).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def attach(spark: SparkSession, table: str, path: str, key: str, *, sort: tuple[str, ...] = (), buckets: int = BUCKETS) -> DataFrame:
    """A table that ``write`` made, known to this session under a name; its files are not touched."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({quoted(key)}) SORTED BY ({quoted(key, *sort)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def misplaced(spark: SparkSession, path: str, key: str, *, buckets: int = BUCKETS) -> DataFrame:
    """(path, bucket, rows): rows of a table's files that do not belong into the bucket of the file's name; none if it is sound."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"), F.pmod(F.hash(key), F.lit(buckets)).alias("own"))
    named = F.regexp_extract("file", r"_(\d{5})(?:\.c\d+)?\.[^_]*$", 1).cast("int")
    return rows.where(~named.eqNullSafe(F.col("own"))).groupBy("file", F.col("own").alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
