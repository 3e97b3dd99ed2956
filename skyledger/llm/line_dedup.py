"""Operator 11: lines that several documents share stay in one of them, by levelled sorted runs of line hashes.

Every document's distinct keys (128-bit hashes of the stripped, lower-cased lines that are long enough) are written once, and
taken up batch by batch.  A run is a table of (key, documents, largest id), bucketed and sorted by key, so all runs lie
alike and a batch meets each by a merge join that does not move the run.  A batch counts its own keys, drops by anti-joins with each run those that a run
already knows to be in enough documents and in a larger id, and is written as a run of level 0; ``fan`` runs of a level are
merged into one of the next, so a key is written once a level.  At the end the runs are merged and leave the keys that are
repeated, with the largest id of each.  Lines find their verdict by a join in which the keys of very many lines are dealt
out over parts; documents find their lines by id and a hash of the text, where a clash is harmless as verdicts rest on the
id and the key alone.

Edge cases: a null or empty text is one empty line; each row is a document, and rows that repeat an id share the rule
(all of them keep a line if their id is the largest that holds it); a null id is less than all others; lines that repeat
within a document count once and go or stay together; an empty table gives an empty result; further columns do not matter.
Keys are told apart by 128 bits of BLAKE2 and not by their bytes.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import _text as X
from skyledger.llm._spark import Scratch, columns, delete, shared_dir

BLANKS = b" \t\n\x0b\x0c\r"
FOLLOWING = bytes(range(0x80, 0xC0))  # bytes that begin no code point
SLOTS = 64  # folders that tasks write their lines to; batches are made of whole ones
BATCH_ROWS = 1 << 26  # lines of a batch, as long as SLOTS batches do
BUCKET_ROWS = 1 << 22  # lines whose keys go to one bucket of a run, about
RUN = "hi long, lo long, n long, top long"
SPREAD = 32  # parts that the lines of a hot key are dealt out over
MOST_HOT = 4096  # hot keys at most: each has more than its share of all lines, so there cannot be more


def line_key(line: bytes, least: int) -> bytes | None:
    """The hash of a line that A-Z of was lower-cased, or None if it is too short to count."""
    k = line.strip(BLANKS)
    if len(k) < least or (len(k) < 4 * least and len(k.translate(None, FOLLOWING)) < least):
        return None
    return hashlib.blake2b(k, digest_size=16).digest()


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    data, at = X.view(columns(batch, "text")[0])
    for a, b in X.slices(at):
        raw = data[at[a] : at[b]].tobytes()
        for i in range(a, b):
            yield i, raw[at[i] - at[a] : at[i + 1] - at[a]]


def _lines(least: int):
    """(doc_id, sig, hi, lo) for each document's distinct keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, keys = [], []
            for i, text in _texts(batch):
                own = {k for line in text.lower().split(b"\n") if (k := line_key(line, least))}
                keys += own
                row += [i] * len(own)
            h = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            ids, sig = (c.take(pa.array(row, pa.int64())) for c in columns(batch, "doc_id", "sig"))
            yield pa.RecordBatch.from_arrays([ids, sig, pa.array(h[:, 0]), pa.array(h[:, 1])], ["doc_id", "sig", "hi", "lo"])

    return run


class LineRuns:
    """Levelled sorted runs of (hi, lo, n, top): a key, in how many documents it is, and the largest id of these."""

    def __init__(self, spark: SparkSession, *, buckets: int, fan: int = 4, enough: int = 3):
        self.spark, self.buckets, self.fan, self.enough = spark, buckets, fan, enough
        self.levels: list[list[str]] = []
        self._base, self._paths = f"{shared_dir(spark)}/skyledger-runs-{uuid.uuid4().hex}", {}

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        path = f"{self._base}/{name}"
        df.repartition(self.buckets, "hi", "lo").write.bucketBy(self.buckets, "hi", "lo").sortBy("hi", "lo").option("path", path).saveAsTable(name)
        self._paths[name] = path
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete(self.spark, self._paths.pop(name))

    def _merged(self, names: list[str]) -> DataFrame:
        """Runs as one.  They are read as plain files and dealt out anew, as Spark takes a union of bucketed tables for bucketed
        itself but does not read it so when the scans are columnar: keys would not meet."""
        both = self.spark.read.schema(RUN).parquet(*(self._paths[n] for n in names)).repartition(self.buckets, "hi", "lo")
        return both.groupBy("hi", "lo").agg(F.sum("n").alias("n"), F.max("top").alias("top"))

    def unknown(self, lines: DataFrame) -> DataFrame:
        """The keys of a batch of (doc_id, hi, lo) that no run knows well enough, as the rows of a run."""
        own = lines.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("top")).repartition(self.buckets, "hi", "lo").alias("own")
        for name in (n for level in self.levels for n in level):
            run = self.spark.table(name).where(F.col("n") >= self.enough).hint("merge").alias("run")
            known = (F.col("own.hi") == F.col("run.hi")) & (F.col("own.lo") == F.col("run.lo")) & (F.col("own.top").isNull() | (F.col("run.top") >= F.col("own.top")))
            own = own.join(run, known, "left_anti").alias("own")
        return own

    def add(self, lines: DataFrame) -> None:
        """A batch becomes a run of what the runs do not know."""
        self._put(self._write(self.unknown(lines)), 0)

    def _put(self, name: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fan:
            full, self.levels[level] = self.levels[level], []
            merged = self._write(self._merged(full))
            for n in full:
                self._drop(n)
            self._put(merged, level + 1)

    def repeated(self) -> DataFrame:
        """Keys in enough documents: (hi, lo, n, top).  Reads the runs, which stay until close()."""
        names = [n for level in self.levels for n in level]
        return self._merged(names).where(F.col("n") >= self.enough)

    def close(self) -> None:
        for name in list(self._paths):
            self._drop(name)
        delete(self.spark, self._base)


def dropped_lines(lines: DataFrame, repeated: DataFrame, total: int) -> DataFrame:
    """(doc_id, sig, hi, lo) of the lines to drop: those of repeated keys outside the largest document that holds the key."""
    hot = repeated.where(F.col("n") > max(total // MOST_HOT, 1)).select("hi", "lo").withColumn("hot", F.lit(True))
    lines = lines.join(F.broadcast(hot), ["hi", "lo"], "left").withColumn("part", F.when(F.col("hot"), F.pmod(F.xxhash64("sig"), F.lit(SPREAD)).cast("int")).otherwise(F.lit(0)))
    parts = F.when(F.col("n") > max(total // MOST_HOT, 1), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    keys = repeated.select("hi", "lo", "top", F.explode(parts).alias("part"))
    return lines.join(keys.hint("merge"), ["hi", "lo", "part"]).where(~F.col("doc_id").eqNullSafe(F.col("top"))).select("doc_id", "sig", "hi", "lo")


def _finish(least: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, gone = columns(batch, "doc_id", "gone")
            out = []
            for i, text in _texts(batch):
                lines = text.split(b"\n")
                drop = gone[i].as_py()
                kept = lines
                if drop:
                    raw = np.array([(d["hi"], d["lo"]) for d in drop], "<i8").tobytes()
                    keys = {raw[k : k + 16] for k in range(0, len(raw), 16)}
                    kept = [line for line in lines if line_key(line.lower(), least) not in keys]
                text = b"\n".join(kept)
                out.append((len(lines), len(lines) - len(kept), hashlib.sha256(text).hexdigest(), text.decode("utf-8", "replace") if keep_text else None))
            cols = list(zip(*out)) if out else [[]] * 4
            arrays = [pa.array(v, k) for v, k in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([ids, *arrays[: 4 if keep_text else 3]], ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text"][: 5 if keep_text else 4])

    return run


def line_dedup(
    docs: DataFrame, spark: SparkSession, *, id_col: str = "doc_id", text_col: str = "text", least: int = 20, enough: int = 3, batches: int | None = None, fan: int = 4, keep_text: bool = True
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256[, kept_text]) for each row of docs.

    least: code points that a key has at least; enough: documents that make a key repeated; batches: by default as many as
    BATCH_ROWS lines each make, 4 to SLOTS; fan: runs of a level that are merged into one of the next."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("sig", F.xxhash64("text"))
    scratch = Scratch(spark)
    lines = docs.mapInArrow(_lines(least), "doc_id long, sig long, hi long, lo long").withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(SLOTS)))
    lines = scratch.stored(lines, by="slot")
    total = lines.count()
    n = batches or min(max(ceil(total / BATCH_ROWS), 4), SLOTS)
    runs = LineRuns(spark, buckets=max(8, ceil(total / BUCKET_ROWS)), fan=fan, enough=enough)
    for k in range(n):
        runs.add(lines.where(F.pmod("slot", F.lit(n)) == k))
    repeated = scratch.stored(runs.repeated())
    runs.close()
    gone = dropped_lines(lines, repeated, total).groupBy("doc_id", "sig").agg(F.collect_set(F.struct("hi", "lo")).alias("gone"))
    gone = scratch.stored(gone)
    scratch.close(gone)
    a, b = docs.alias("a"), gone.alias("b")
    found = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.sig") == F.col("b.sig")), "left").select("a.doc_id", "text", "gone")
    return found.mapInArrow(_finish(least, keep_text), "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + ", kept_text string" * keep_text)
