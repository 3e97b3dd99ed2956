"""Marks of repeated places: one sorted list of runs of places for each document."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import _text as X

MARKS = "doc_id long, starts binary, lengths binary"


def joined_runs(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs sorted by (doc, start), with those of a document that touch or overlap made one."""
    if not len(doc):
        return doc, start, end
    number = np.concatenate(([0], np.cumsum(doc[1:] != doc[:-1])))
    span = int(end.max()) + 1
    if (int(number[-1]) + 1) * span >= 1 << 62:  # the sums below would not fit: by halves of the documents
        cut = int(np.searchsorted(number, number[-1] // 2 + 1))
        halves = (joined_runs(doc[s], start[s], end[s]) for s in (slice(0, cut), slice(cut, None)))
        return tuple(np.concatenate(x) for x in zip(*halves))
    base = number * np.int64(span)  # ends grow from document to document, so their running maximum never crosses one
    top = np.maximum.accumulate(end + base) - base
    heads = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (start[1:] > top[:-1]))))
    tails = np.concatenate((heads[1:], [len(doc)])) - 1
    return doc[heads], start[heads], top[tails]


def mark_rows(doc: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.RecordBatch:
    """One row for each document: runs of marked starts, joined where they meet."""
    order = np.lexsort((start, doc))
    doc, start, end = joined_runs(doc[order], start[order].astype(np.int64), (start + length)[order].astype(np.int64))
    by, cut = X.groups(doc)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[by][cut[:-1]]), X.blobs(start[by].astype(np.uint32), cut), X.blobs((end - start)[by].astype(np.uint32), cut)], ["doc_id", "starts", "lengths"]
    )


def with_marks(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """docs with array columns starts and lengths of binary runs (null where nothing is marked)."""
    lists = marks.groupBy("doc_id").agg(F.collect_list("starts").alias("starts"), F.collect_list("lengths").alias("lengths"))
    return docs.join(lists, "doc_id", "left")


def marked_starts(starts: list[bytes] | None, lengths: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.frombuffer(b"".join(starts), np.uint32).astype(np.int64), np.frombuffer(b"".join(lengths), np.uint32).astype(np.int64)


def cover(starts: np.ndarray, lengths: np.ndarray, window: int, total: int) -> np.ndarray:
    """Which of total items windows cover that start anywhere in the runs."""
    d = np.zeros(total + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, np.minimum(starts + lengths + window - 1, total), -1)
    return np.cumsum(d[:-1]) > 0
