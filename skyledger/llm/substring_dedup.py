"""Operator 7: removal of words in windows that an earlier document holds, with a count-min prefilter.

First pass: partitions count the least 5-word gram of each 13-word window into sketches that are merged.  Equal windows
have equal least grams, so the count of a window's least gram overestimates that of the window, and a window whose least
gram occurs once is unique.  Second pass: runs of windows whose least gram may be repeated go, as their words, to the
bucket of that gram; there equal runs are settled whole and the windows of the others are grouped by a hash and compared
word by word, so results never rest on a hash.  A partition sends equal runs once, for the smallest document, and marks
those of other documents there and then, so a passage that a third of all documents hold costs one entry for each partition
batch.  The smallest document's further places of a run go with it, without its words.

Edge cases: a null or empty text has no words; texts shorter than a window lose nothing; repeats within one document
do not count, but all of them go where a smaller document has the window; rows that repeat an id are one document to this rule; a row with a null id is never marked and marks
nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import _segments as S
from skyledger.llm import _text as X
from skyledger.llm._marks import MARKS, cover, marked_starts, with_marks
from skyledger.llm._sketch import OFTEN, Sketch, log_cells_for, sketch
from skyledger.llm._spark import buckets_of, columns, text_bytes

U64 = X.U64
SHARE = 0.05  # least grams for each byte, about


def _gram(window: int) -> int:
    return min(5, window)


def _slices(texts: pa.Array, window: int):
    """For each slice: first row, bytes, words' starts and ends, word hashes, offsets of rows' words, whether a window
    starts at each word, least grams, their places."""
    data, at = X.view(texts)
    g = _gram(window)
    for a, b in X.slices(at):
        part = data[at[a] : at[b]]
        starts, ends, rows = X.words(part, at[a : b + 1] - at[a], X.SPACED)
        w = X.word_hashes(part, starts, ends, 7)
        valid = X.inside_rows(rows, window, len(w))
        low, places = X.minima(X.gram_hashes(w, g, seed=70), valid, window - g + 1)
        yield a, part, starts, ends, w, rows, valid, low, places


def _grams(window: int):
    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for *_, w, _, _, _, places in _slices(columns(batch, "text")[0], window):
            yield X.gram_hashes(w, _gram(window), seed=70)[places]

    return hashes


def _spaced(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with one blank after each, and where each begins."""
    size = ends - starts + 1
    at = np.concatenate(([0], np.cumsum(size)))
    out = part[np.minimum(np.repeat(starts - at[:-1], size) + np.arange(at[-1]), max(len(part) - 1, 0))] if len(starts) else part[:0]
    out[at[1:] - 1] = 32
    return out, at


def _runs(window: int, shared, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Sketch = shared.value
        for batch in batches:
            ids, texts = columns(batch, "doc_id", "text")
            ids = ids.cast(pa.int64())
            known, ids = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            parts = []
            for a, part, starts, ends, w, rows, valid, low, _ in _slices(texts, window):
                if not valid.any():
                    continue
                s, n = S.runs_of(low, valid)
                row = np.searchsorted(rows, s, "right") - 1
                ok = counts.may_repeat(low[s]) & known[row + a]
                s, n = s[ok], n[ok]
                s, n, single = S.singly(s, n, counts.may_be_often(low[s]))
                row = np.searchsorted(rows, s, "right") - 1
                sums, down = X.prefix_sums(w, X.P_BYTE)
                name = X.mix((sums[s + n + window - 1] - sums[s]) * down[s], 71)
                text, at = _spaced(part, starts, ends)
                parts.append(S.Segments(np.where(single, name, low[s]), ids[row + a], s - rows[row], n, name, at[s], at[s + n + window - 1] - 1, text))
            yield from S.send(parts, buckets, across=True)

    return run


def _hash_windows(words: np.ndarray, window: int) -> np.ndarray:
    return X.gram_hashes(words, window, seed=71)


def _windows(window: int, hash_of: Callable[[np.ndarray, int], np.ndarray]):
    """What repeats among the different runs of a bucket: windows grouped by hash, ties compared by their bytes."""

    def run(bucket: S.Bucket) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        data, size = bucket.data, bucket.b - bucket.a
        cut = np.concatenate(([0], np.cumsum(size)))
        cols: list[tuple] = []
        lo = 0
        while lo < len(size):  # blocks of runs
            hi = max(int(np.searchsorted(cut, cut[lo] + X.SLICE_BYTES, "right")) - 1, lo + 1)
            rows = cut[lo : hi + 1] - cut[lo]
            part = data[np.repeat(bucket.a[lo:hi] - rows[:-1], size[lo:hi]) + np.arange(rows[-1])]
            starts, ends, of = X.words(part, rows, X.SPACED)
            at = np.flatnonzero(X.inside_rows(of, window, len(starts)))
            r = np.searchsorted(of, at, "right") - 1
            begin = bucket.a[lo + r] + starts[at] - rows[r]
            cols.append((hash_of(X.word_hashes(part, starts, ends, 7), window)[at], bucket.doc[lo + r], bucket.start[lo + r] + at - of[r], begin, ends[at + window - 1] - starts[at]))
            lo = hi
        h, doc, start, begin, size = (np.concatenate(x) for x in zip(*cols))
        order = np.lexsort((size, h))
        h, doc, start, begin, size = (x[order] for x in (h, doc, start, begin, size))
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (size[1:] == size[:-1])
        tied = np.flatnonzero(same)
        good = X.equal_stretches(data, begin[tied], begin[tied - 1], size[tied])
        if not good.all():  # different windows share a hash: those hashes are settled by their bytes alone
            clash = np.flatnonzero(np.isin(h, h[tied[~good]]))
            raw, number = data.tobytes(), {}
            text = np.zeros(len(h), np.int64)
            text[clash] = [number.setdefault(raw[x : x + k], len(number)) for x, k in zip(begin[clash].tolist(), size[clash].tolist())]
            order = np.lexsort((text, size, h))
            h, doc, start, size, text = (x[order] for x in (h, doc, start, size, text))
            same[1:] = (h[1:] == h[:-1]) & (size[1:] == size[:-1]) & (text[1:] == text[:-1])
        later = S.first_of(doc, start, same, across=True)
        yield doc[later], start[later], np.ones(int(later.sum()), np.int64)

    return run


def repeated_windows(
    docs: DataFrame, spark: SparkSession, *, window: int = 13, log_cells: int | None = None, often: int = OFTEN, hash_of: Callable[[np.ndarray, int], np.ndarray] = _hash_windows
) -> DataFrame:
    """Marks (doc_id, starts, lengths): runs of window starts whose words also start in a smaller document."""
    texts = docs.select("text")
    size = text_bytes(texts)
    buckets = buckets_of(size)
    counts = spark.sparkContext.broadcast(sketch(texts, _grams(window), log_cells or log_cells_for(size, SHARE), often))
    rows = docs.select("doc_id", "text").mapInArrow(_runs(window, counts, buckets), S.ROW)
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(S.settle(_windows(window, hash_of), across=True), MARKS)


def _finish(window: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, starts, lengths = columns(batch, "doc_id", "text", "starts", "lengths")
            data, at = X.view(texts)
            starts, lengths = starts.to_pylist(), lengths.to_pylist()
            out = []
            for a, b in X.slices(at):
                part = data[at[a] : at[b]]
                ws, we, rows = X.words(part, at[a : b + 1] - at[a], X.SPACED)
                raw = part.tobytes()
                for i in range(a, b):
                    lo, hi = rows[i - a], rows[i - a + 1]
                    s, e = ws[lo:hi], we[lo:hi]
                    gone = cover(*marked_starts(starts[i], lengths[i]), window, hi - lo)
                    if gone.any():
                        s, e = s[~gone], e[~gone]
                    kept = b" ".join([raw[x:y] for x, y in zip(s.tolist(), e.tolist())])
                    out.append((hi - lo, int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if keep_text else None))
            cols = list(zip(*out)) if out else [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            arrays = [pa.array(v, k) for v, k in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), *arrays[: 4 if keep_text else 3]], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"][: 5 if keep_text else 4])

    return run


def substring_dedup(
    docs: DataFrame, spark: SparkSession, *, window: int = 13, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True, **how
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]) for each row of docs; how: as for repeated_windows."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marks = repeated_windows(docs, spark, window=window, **how)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text
    return with_marks(docs, marks).select("doc_id", "text", "starts", "lengths").mapInArrow(_finish(window, keep_text), schema)
