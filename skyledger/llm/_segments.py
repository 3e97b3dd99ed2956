"""Segments: runs of windows with one least gram, dealt out to buckets by that gram with the bytes that they span.

Equal windows have equal least grams, so they meet in one bucket.  A partition batch sends equal segments once, for the
first place, and marks the others.  Where only smaller documents count, the smallest document's further places are sent too,
without bytes: another batch may hold a still smaller document, for which all of them go.  The windows of a gram that the sketch counts very often (a line that many documents
share) are segments of their own and dealt out by their own hash, so no bucket holds all that surrounds a hot gram.
Hashes only bring together; what is marked has the same bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from skyledger.llm import _text as X
from skyledger.llm._marks import mark_rows

U64 = X.U64
ROW = "bucket int, gram binary, doc binary, start binary, n binary, size binary, bytes binary"
NAMES = ["bucket", "gram", "doc", "start", "n", "size", "bytes"]
KINDS = (U64, np.int64, np.uint32, np.uint32, np.uint32)
TOGETHER = 64  # buckets in one Arrow batch


@dataclass
class Segments:
    """Segments of one stretch of bytes: keys, document, first window and number of windows, hash, and bytes [a, b)."""

    gram: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    n: np.ndarray
    name: np.ndarray
    a: np.ndarray
    b: np.ndarray
    data: np.ndarray


def runs_of(low: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First windows and lengths of the runs of valid windows with one least gram; a row's last windows are not valid."""
    change = np.ones(len(valid) + 1, bool)
    change[1:-1] = (low[1:] != low[:-1]) | (valid[1:] != valid[:-1])
    cut = np.flatnonzero(change)
    s, n = cut[:-1], np.diff(cut)
    return s[valid[s]], n[valid[s]]


def singly(s: np.ndarray, n: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs with those that are often parted into single windows; and which these are."""
    if not often.any():
        return s, n, often
    k = np.where(often, n, 1)
    first = np.repeat(np.cumsum(k) - k, k)
    out = np.repeat(s, k) + np.where(np.repeat(often, k), np.arange(len(first)) - first, 0)
    return out, np.where(np.repeat(often, k), 1, np.repeat(n, k)), np.repeat(often, k)


def send(parts: list[Segments], buckets: int, across: bool) -> Iterator[pa.RecordBatch]:
    """Rows of the segments of a batch.  across: a place repeats only places of smaller documents."""
    if not parts:
        return
    gram, doc, start, n, name, a, b = (np.concatenate([getattr(p, k) for p in parts]) for k in ("gram", "doc", "start", "n", "name", "a", "b"))
    which = np.repeat(np.arange(len(parts)), [len(p.gram) for p in parts])
    bucket = (gram % U64(buckets)).astype(np.int64)
    order = np.lexsort((start, doc, n, name, gram, bucket))
    gram, doc, start, n, name, a, b, which, bucket = (x[order] for x in (gram, doc, start, n, name, a, b, which, bucket))
    size = b - a
    alike = np.zeros(len(order), bool)
    alike[1:] = (gram[1:] == gram[:-1]) & (name[1:] == name[:-1]) & (n[1:] == n[:-1]) & (size[1:] == size[:-1])
    raw = lambda i: parts[which[i]].data[a[i] : b[i]]
    for i in np.flatnonzero(alike).tolist():
        alike[i] = np.array_equal(raw(i), raw(i - 1))
    head = np.maximum.accumulate(np.where(alike, 0, np.arange(len(order)))) if len(order) else order
    later = alike & ((doc > doc[head]) if across else (doc > doc[head]) | (start > start[head]))
    # The first document's further places, without bytes, behind the first; rows that repeat an id repeat its places.
    again = alike & ~later & across
    again[1:] &= (doc[1:] != doc[:-1]) | (start[1:] != start[:-1])
    size = np.where(again, 0, size)
    out = np.flatnonzero(~alike | again)
    heads = np.flatnonzero(np.diff(bucket[out], prepend=-1))  # only buckets that the batch has: their number is the input's
    cut = np.append(heads, len(out))
    ends = np.concatenate(([0], np.cumsum(size[out]))).astype(np.int64)
    data = np.concatenate([np.zeros(0, np.uint8), *(raw(i) for i in out[~again[out]].tolist())])
    for lo in range(0, len(heads), TOGETHER):
        c = cut[lo : lo + TOGETHER + 1]
        x, e, c = out[c[0] : c[-1]], ends[c], c - c[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[x[c[:-1]]].astype(np.int32)), *(X.blobs(v[x].astype(k), c) for v, k in zip((gram, doc, start, n, size), KINDS)), X.blobs(data[e[0] : e[-1]], e - e[0])], NAMES
        )
    if later.any():  # marks, under negative buckets
        m = mark_rows(doc[later], start[later], n[later])
        d, k = m.column(0).to_numpy(), m.num_rows
        none = pa.array(np.full(k, b"", object), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array((d % buckets - buckets).astype(np.int32)), none, X.blobs(d, np.arange(k + 1)), m.column(1), m.column(2), none, none], NAMES)


@dataclass
class Bucket:
    """Segments of a bucket that differ, or are of one document, by (doc, start): windows, and where their bytes begin and end in data."""

    doc: np.ndarray
    start: np.ndarray
    n: np.ndarray
    a: np.ndarray
    b: np.ndarray
    data: np.ndarray


def _distinct(rows: list[tuple], across: bool) -> tuple[Bucket | None, tuple]:
    """The segments of a bucket that repeat none whole, and the marks of the others."""
    gram, doc, start, n, size = (np.frombuffer(b"".join(x), k) for x, k in zip(zip(*(r[:5] for r in rows)), KINDS))
    start, n, size = (x.astype(np.int64) for x in (start, n, size))
    raw = b"".join(r[5] for r in rows)
    lead = np.maximum.accumulate(np.where(size > 0, np.arange(len(size)), 0))  # places without bytes have those before them
    a, size = (np.cumsum(size) - size)[lead], size[lead]
    # A gram's only segment repeats nothing, but where a longer one repeats within itself and that counts.
    by, cut = X.groups(gram)
    alone = np.repeat(np.diff(cut) == 1, np.diff(cut))
    live = by[~alone] if across else by[~alone | (n[by] > 1)]
    live = live[np.lexsort((start[live], doc[live]))]
    doc, start, n, a, b = doc[live], start[live], n[live], a[live], (a + size)[live]
    first: dict[bytes, int] = {}
    head = np.array([first.setdefault(raw[x:y], i) for i, (x, y) in enumerate(zip(a.tolist(), b.tolist()))], np.int64)
    later = (doc > doc[head]) if across else (doc > doc[head]) | (start > start[head])
    keep = ~later if across else head == np.arange(len(head))
    marks = (doc[later], start[later], n[later])
    rest = Bucket(*(x[keep] for x in (doc, start, n, a, b)), np.frombuffer(raw, np.uint8)) if keep.any() else None
    return rest, marks


def settle(windows: Callable[[Bucket], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]], across: bool):
    """For mapInArrow over rows sorted by bucket: the marks, one bucket at a time.  windows(bucket) yields the
    (doc, start, length) of what repeats among segments that differ."""
    def one(bucket: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if bucket < 0:
            _, docs, starts, lengths, *_ = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(docs), np.int64)), pa.array(starts, pa.binary()), pa.array(lengths, pa.binary())], ["doc_id", "starts", "lengths"])
            return
        rest, marks = _distinct(rows, across)
        if len(marks[0]):
            yield mark_rows(*marks)
        if rest is not None:
            for found in windows(rest):
                if len(found[0]):
                    yield mark_rows(*found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for bucket, *blobs in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if bucket != now:
                    if held:
                        yield from one(now, held)
                    now, held = bucket, []
                held.append(tuple(blobs))
        if held:
            yield from one(now, held)

    return run


def first_of(doc: np.ndarray, start: np.ndarray, same: np.ndarray, across: bool) -> np.ndarray:
    """For windows in an order in which equal ones are neighbours (same: as the one before): which come after the first."""
    heads = np.flatnonzero(~same)
    run = np.cumsum(~same) - 1
    least = np.minimum.reduceat(doc, heads)[run]
    if across:
        return doc > least
    place = np.where(doc == least, start, np.iinfo(np.int64).max)
    return (doc > least) | (start > np.minimum.reduceat(place, heads)[run])

