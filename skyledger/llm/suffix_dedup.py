"""Operator 10: removal of bytes in 100-byte strings that start earlier, by suffix order in buckets.

A merged sketch drops the strings whose least 44-byte gram occurs once: those are unique.  What is left goes, as runs of
strings with one least gram, to the bucket of that gram; a partition sends equal runs once, for the earliest, and marks the
others.  One bucket at a time is held: equal runs are settled whole, and the suffixes of the others are sorted, blockwise
by their leading bytes, with ties resolved by precomputed ranks of a difference cover (``_suffixes``).  Equal strings are
then neighbours, and the first of them by (document, place) stays.  Results never rest on a hash.

Edge cases: null and empty texts, and texts of under 100 bytes, lose nothing; rows that repeat an id are one document
to this rule, and a string at the same place of them is no repeat of itself; a row with a null id is never marked and
marks nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import _segments as S
from skyledger.llm import _text as X
from skyledger.llm._marks import MARKS, cover, marked_starts, with_marks
from skyledger.llm._sketch import OFTEN, Sketch, log_cells_for, sketch
from skyledger.llm._spark import buckets_of, columns, text_bytes
from skyledger.llm._suffixes import Suffixes

U64 = X.U64
SHARE = 0.035  # least grams for each byte, about


def _gram(window: int) -> int:
    return max(1, window * 44 // 100)


def _slices(texts: pa.Array, window: int):
    data, at = X.view(texts)
    g = _gram(window)
    for a, b in X.slices(at):
        part, rows = data[at[a] : at[b]], at[a : b + 1] - at[a]
        codes = X.byte_codes(10)[part]
        grams = X.gram_hashes(codes, g, seed=100)
        valid = X.inside_rows(rows, window, len(part))
        low, places = X.minima(grams, valid, window - g + 1)
        yield a, part, rows, codes, grams, valid, low, places


def _grams(window: int):
    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for *_, grams, _, _, places in _slices(columns(batch, "text")[0], window):
            yield grams[places]

    return hashes


def _runs(window: int, shared, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Sketch = shared.value
        for batch in batches:
            ids, texts = columns(batch, "doc_id", "text")
            ids = ids.cast(pa.int64())
            known, ids = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            parts = []
            for a, part, rows, codes, _, valid, low, _ in _slices(texts, window):
                if not valid.any():
                    continue
                s, n = S.runs_of(low, valid)
                row = np.searchsorted(rows, s, "right") - 1
                ok = counts.may_repeat(low[s]) & known[row + a]
                s, n = s[ok], n[ok]
                s, n, single = S.singly(s, n, counts.may_be_often(low[s]))
                row = np.searchsorted(rows, s, "right") - 1
                sums, down = X.prefix_sums(codes, X.P_BYTE)
                end = s + n + window - 1
                name = X.mix((sums[end] - sums[s]) * down[s], 101)
                parts.append(S.Segments(np.where(single, name, low[s]), ids[row + a], s - rows[row], n, name, s, end, part))
            yield from S.send(parts, buckets, across=False)

    return run


def _windows(window: int):
    """What repeats among the different runs of a bucket, by suffix order."""

    def run(bucket: S.Bucket) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        size, n = bucket.b - bucket.a, bucket.n
        base = np.cumsum(size) - size
        suffixes = Suffixes(bucket.data[np.repeat(bucket.a - base, size) + np.arange(size.sum())], window)
        first = np.cumsum(n) - n
        places = np.repeat(base - first, n) + np.arange(n.sum())
        for some in suffixes.buckets(places):
            order, same = suffixes.order(places[some])
            tied = np.flatnonzero(same | np.concatenate((same[1:], [False])))
            if not len(tied):
                continue
            i = some[order[tied]]
            run_ = np.searchsorted(first, i, "right") - 1
            doc, start = bucket.doc[run_], bucket.start[run_] + i - first[run_]
            later = S.first_of(doc, start, same[tied], across=False)
            yield doc[later], start[later], np.ones(int(later.sum()), np.int64)

    return run


def _finish(window: int, keep_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, starts, lengths = columns(batch, "doc_id", "text", "starts", "lengths")
            data, at = X.view(texts)
            out = []
            for i, (s, l) in enumerate(zip(starts.to_pylist(), lengths.to_pylist())):
                part = data[at[i] : at[i + 1]]
                n_removed = spans = 0
                if s:
                    gone = cover(*marked_starts(s, l), window, len(part))
                    n_removed, spans = int(gone.sum()), len(X.runs(gone)[0])
                    kept = part[~gone].tobytes()
                else:
                    kept = part.tobytes()
                out.append((len(part), n_removed, spans, hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
            cols = list(zip(*out)) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            arrays = [pa.array(v, k) for v, k in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), *arrays[: 5 if keep_bytes else 4]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"][: 6 if keep_bytes else 5])

    return run


def suffix_dedup(
    docs: DataFrame, spark: SparkSession, *, window: int = 100, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = True, log_cells: int | None = None, often: int = OFTEN
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept_bytes]) for each row of docs."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = docs.select("text")
    size = text_bytes(texts)
    buckets = buckets_of(size)
    counts = spark.sparkContext.broadcast(sketch(texts, _grams(window), log_cells or log_cells_for(size, SHARE), often))
    rows = docs.mapInArrow(_runs(window, counts, buckets), S.ROW)
    marks = rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(S.settle(_windows(window), across=False), MARKS)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_bytes binary" * keep_bytes
    return with_marks(docs, marks).select("doc_id", "text", "starts", "lengths").mapInArrow(_finish(window, keep_bytes), schema)
