"""Operator 12: erasure of a client's rows that cascades through tables of sorted files and rewrites only those that hold them.

Layout: a table is sorted once by ranges; ranks are a file's offset plus the row's place in it, so no window gathers rows.
Runs of consecutive ranks become the final files, each written whole by one task that streams it in order.

Erasure: victims go down from masters to clients, to their clicks and sales, to these sales' lines, as semi-joins of ids.  Each
table's distinct pairs of file and key are joined to the victims, so a key that fills many files costs one row a file.  Files
without a victim are not read again but for their first and money columns.  The others meet their exact keys file by file in
a cogrouped Python function: one side the file's rows with their ranks, the other its victims' keys; ``isin`` of pandas
filters, the survivors are written anew, statistics and all, and their hash is returned.  The function takes Arrow tables
(``cogroup().applyInArrow``): ``applyInPandas`` would hand over numbers with nulls as doubles and nulls of doubles as NaN, which
could not be written back as they were.

Tasks write to a folder of their own under unique names, so a task that runs twice or breaks off leaves nothing behind; when
all are done the driver moves the new files in and deletes the old (by file, ``files`` a table and not by row).

Edge cases: null keys have no victims; a sale or client id that repeats is joined by its smallest client or by each of its
masters; rows that repeat are sorted side by side and erased together; NaN and infinite amounts count as 0 cents, like null; an
empty table has no files; further columns are sorted, written and kept like the rest, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm._spark import Scratch, delete, shared_dir, shuffle_partitions


@dataclass(frozen=True)
class Kind:
    """A table of the cascade: the column that victims are known by, and the one that is summed up."""

    key: str
    money: str


KINDS = {"clients": Kind("master_id", "balance"), "clicks": Kind("client_id", "value"), "sales": Kind("client_id", "total"), "sale_lines": Kind("sale_id", "amount")}
MOVERS = 8
TABLES_AT_ONCE = 4
REPORT = "file_no long, n_rows long, n_erased long, cents long, ids_sha256 string, staged string"


def fresh(name: str, taken: Iterable[str]) -> str:
    """name, or one like it that is not taken, in any case of letters."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_crc(x: Column) -> Column:
    """crc32 of a number's decimal text; null is empty."""
    return F.crc32(F.coalesce(x.cast("string"), F.lit("")).cast("binary"))


def cents(x: Column) -> Column:
    x = x.cast("double")
    return F.when(F.abs(x) < float("inf"), F.floor(100 * x + 0.5)).otherwise(F.lit(0)).cast("long")


class Files:
    """The files of one table, in a folder of their own: rows in order, ``rows`` consecutive ones each."""

    def __init__(self, spark: SparkSession, path: str, df: DataFrame):
        self.spark, self.path, self.schema = spark, path, df.schema
        self.at, self.rank = fresh("file_no", df.columns), fresh("rank", df.columns)
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._hadoop(path))

    def name(self, file_no: int, rewritten: bool = False) -> str:
        return f"{self.path}/{file_no:06d}{'-rewritten' * rewritten}.parquet"

    def move(self, source: str, to: str) -> None:
        if not self._fs.rename(self._hadoop(source), self._hadoop(to)):
            raise OSError(f"{source} can't be moved to {to}")

    def remove(self, path: str) -> None:
        self._fs.delete(self._hadoop(path), False)

    def read(self, *file_nos: int) -> DataFrame:
        """All rows, or those of some files, with the file's number and the place in it."""
        paths = [self.name(k) for k in file_nos] or [self.path]
        df = self.spark.read.schema(self.schema).parquet(*paths)
        return df.select("*", F.substring(F.col("_metadata.file_name"), 1, 6).cast("long").alias(self.at), F.col("_metadata.row_index").alias(self.rank))

    def write(self, df: DataFrame, first: Column, files: int) -> None:
        """df in the order of first, then of this table's columns, as files of 1 + floor(n / files) consecutive rows."""
        names = self.schema.names
        scratch, moved = Scratch(self.spark), f"{shared_dir(self.spark)}/skyledger-{uuid.uuid4().hex}"
        by = fresh("first", df.columns)
        ordered = df.withColumn(by, first).orderBy(F.col(by), *(F.col(f"`{c}`").asc_nulls_first() for c in names)).select(*(f"`{c}`" for c in names))
        placed = scratch.stored(ordered)
        sizes = sorted(tuple(r) for r in placed.groupBy(F.col("_metadata.file_name").alias("name")).count().collect())  # one row a sorting task
        n = sum(k for _, k in sizes)
        offsets, before = [], 0
        for name, k in sizes:
            offsets.append((name, before))
            before += k
        if n:
            offset, source = fresh("offset", df.columns), fresh("source", df.columns)
            starts = self.spark.createDataFrame(offsets, f"{source} string, {offset} long")
            rows = placed.withColumns({source: F.col("_metadata.file_name"), self.rank: F.col("_metadata.row_index")}).join(F.broadcast(starts), source)
            rows = rows.withColumn(self.rank, F.col(self.rank) + F.col(offset)).withColumn(self.at, F.floor(F.col(self.rank) / (1 + n // files)))
            rows = rows.repartition(min(files, shuffle_partitions(self.spark)), self.at).sortWithinPartitions(self.at, self.rank).select(*(f"`{c}`" for c in names), self.at)
            rows.write.option("maxRecordsPerFile", 0).partitionBy(self.at).parquet(moved)
            found = [f.getPath().toString() for f in self._fs.globStatus(self._hadoop(f"{moved}/*/part-*"))]
            with ThreadPoolExecutor(MOVERS) as pool:  # a file system answers slowly, but many at a time
                list(pool.map(lambda p: self.move(p, self.name(int(p.split("/")[-2].rpartition("=")[2]))), found))
            delete(self.spark, moved)
        scratch.close()


def qualified(spark: SparkSession, path: str) -> str:
    """path with its file system, in the form that Arrow's file systems take too."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    parts = urlsplit(full)
    return f"file://{parts.path}" if parts.scheme == "file" else full


def _digest(ids: pa.ChunkedArray) -> str:
    out = hashlib.sha256()
    for k, chunk in enumerate(ids.cast(pa.string()).fill_null("").chunks):
        out.update(b"," * (k > 0) + ",".join(chunk.to_pylist()).encode())
    return out.hexdigest()


def _report(file_no: int, kept: pa.Table, erased: int, first: str, amount: str, staged: str | None) -> pa.Table:
    numbers = {"file_no": file_no, "n_rows": len(kept), "n_erased": erased, "cents": pc.sum(kept.column(amount)).as_py() or 0}
    texts = {"ids_sha256": _digest(kept.column(first)), "staged": staged}
    return pa.table({k: pa.array([v], pa.int64()) for k, v in numbers.items()} | {k: pa.array([v], pa.string()) for k, v in texts.items()})


def _rewrite(names: list[str], key: str, rank: str, amount: str, to: str) -> Callable:
    """Writes a file's rows that are not victims, in order, under a name of its own; null path if none is left."""

    def run(group: tuple, rows: pa.Table, victims: pa.Table) -> pa.Table:
        rows = rows.sort_by(rank)
        gone = rows.column(key).to_pandas(types_mapper=pd.ArrowDtype).isin(victims.column("key").to_pandas(types_mapper=pd.ArrowDtype))
        kept = rows.filter(pa.array(~gone.to_numpy(bool)))
        staged = None
        if len(kept):
            staged = f"{to}/{uuid.uuid4().hex}.parquet"
            where, path = arrow_fs.FileSystem.from_uri(staged)
            pq.write_table(kept.select(names), path, filesystem=where)
        return _report(group[0].as_py(), kept, len(rows) - len(kept), names[0], amount, staged)

    return run


def _describe(first: str, rank: str, amount: str) -> Callable:
    def run(group: tuple, rows: pa.Table) -> pa.Table:
        return _report(group[0].as_py(), rows.sort_by(rank), 0, first, amount, None)

    return run


def rewrite(files: Files, victims: DataFrame, kind: Kind, scratch: Scratch, staging: str) -> DataFrame:
    """Rewrites the files that hold victims (a column ``key``) and reports on all that are left."""
    spark, names, at = files.spark, files.schema.names, files.at
    amount = fresh("cents", [*names, at, files.rank])
    pairs = files.read().select(F.col(at), F.col(kind.key).alias("key")).where("key IS NOT NULL").distinct()
    pairs = scratch.stored(pairs.join(victims, "key", "left_semi"), ids=True)
    touched = sorted(r[0] for r in pairs.select(at).distinct().collect())  # at most as many as there are files
    first = F.col(names[0])
    rest = files.read().where(~F.col(at).isin(touched)).select(F.col(at), F.col(files.rank), first, cents(F.col(kind.money)).alias(amount))
    report = rest.groupBy(at).applyInArrow(_describe(names[0], files.rank, amount), REPORT).withColumn("rewritten", F.lit(False))
    if touched:
        rows = files.read(*touched).withColumn(amount, cents(F.col(kind.money)))
        new = rows.groupBy(at).cogroup(pairs.groupBy(at)).applyInArrow(_rewrite(names, kind.key, files.rank, amount, staging), REPORT)
        report = report.union(new.withColumn("rewritten", F.lit(True)))
    report = scratch.stored(report)
    for file_no, staged in report.where("rewritten").select("file_no", "staged").collect():
        if staged:
            files.move(staged, files.name(file_no, True))
        files.remove(files.name(file_no))
    path = F.concat(F.lit(f"{files.path}/"), F.lpad(F.col("file_no").cast("string"), 6, "0"), F.when(F.col("rewritten"), "-rewritten").otherwise(""), F.lit(".parquet"))
    return report.where("n_rows > 0").select("file_no", "n_rows", "n_erased", "cents", "rewritten", "ids_sha256", F.lit(",".join(names)).alias("columns"), path.alias("path"))


def victim_masters(clients: DataFrame, clicks: DataFrame, one_in: int) -> DataFrame:
    """Masters whose crc is divisible by one_in, and the one whose clients have most clicks (the smallest of equal ones)."""
    owners = clients.select("client_id", "master_id").where("master_id IS NOT NULL")
    counts = clicks.where("client_id IS NOT NULL").groupBy("client_id").agg(F.count(F.lit(1)).alias("n"))
    busy = owners.distinct().join(counts, "client_id").groupBy("master_id").agg(F.sum("n").alias("n"))
    most = busy.orderBy(F.desc("n"), "master_id").select("master_id").head() or owners.agg(F.min("master_id")).first()
    chosen = (F.crc32(F.col("master_id").cast("string").cast("binary")) % one_in == 0) | (F.col("master_id") == F.lit(most[0]))
    return owners.where(chosen).select(F.col("master_id").alias("key")).distinct()


def cascading_erasure(clients: DataFrame, clicks: DataFrame, sales: DataFrame, sale_lines: DataFrame, spark: SparkSession, *, files: int = 350, one_in: int = 400) -> DataFrame:
    """(table_name, file_no, n_rows, n_erased, cents, rewritten, ids_sha256, columns, path) of each file in the end, in a new folder
    under the shared one; files: by which a table's rows are divided; one_in: the share of masters that are victims."""
    scratch = Scratch(spark)
    folder = qualified(spark, f"{shared_dir(spark)}/erasure-{uuid.uuid4().hex}")
    staging = qualified(spark, f"{shared_dir(spark)}/skyledger-{uuid.uuid4().hex}")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)
    owner = scratch.stored(sales.where("sale_id IS NOT NULL").groupBy(F.col("sale_id").alias("__sale")).agg(F.min("client_id").alias("__client")), ids=True)
    tables = {"clients": clients, "clicks": clicks, "sales": sales, "sale_lines": sale_lines}
    laid = {name: Files(spark, f"{folder}/{name}", df) for name, df in tables.items()}

    def lay(name: str) -> None:
        df, client = tables[name], "client_id"
        if name == "sale_lines":
            sale, client = fresh("sale", df.columns), fresh("client", df.columns)
            df = df.join(owner.select(F.col("__sale").alias(sale), F.col("__client").alias(client)), F.col("sale_id") == F.col(sale), "left")
        laid[name].write(df, text_crc(F.col(client)), files)


    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:  # jobs of several tables fill each other's gaps
        list(pool.map(lay, tables))
    masters = scratch.stored(victim_masters(clients, clicks, one_in), ids=True)
    gone = clients.select(F.col("master_id").alias("key"), "client_id").join(masters, "key", "left_semi")
    gone = scratch.stored(gone.where("client_id IS NOT NULL").select(F.col("client_id").alias("key")).distinct(), ids=True)
    sold = sales.select(F.col("client_id").alias("key"), "sale_id").join(gone, "key", "left_semi")
    sold = scratch.stored(sold.where("sale_id IS NOT NULL").select(F.col("sale_id").alias("key")).distinct(), ids=True)
    victims = {"clients": masters, "clicks": gone, "sales": gone, "sale_lines": sold}

    def erase(name: str) -> DataFrame:
        return rewrite(laid[name], victims[name], KINDS[name], scratch, staging).withColumn("table_name", F.lit(name))

    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        out = scratch.stored(reduce(DataFrame.union, pool.map(erase, tables)).coalesce(1))
    delete(spark, staging)
    scratch.close(out)
    return out
