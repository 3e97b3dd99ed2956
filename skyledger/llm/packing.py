"""Operator 6: packed token-id rows by best-fit decreasing.

Documents are dealt out by a hash of id and text over groups of some ``group_bytes`` of text each, whose number follows
the whole input, so which documents share a row does not depend on how the input is split.  In a group, documents become
ids (byte-level BPE) and are packed into rows of ``length`` ids.  A document longer than a row is cut into whole rows and a
rest, so nothing is lost.  Pieces go, longest first, to the fullest row that still has room, found by a segment tree over
the room that rows have left.  One group is held at a time; one shuffle.

Edge cases: null and empty texts have no ids and are in no row; pieces of one size keep the order of id, then text, then
place; repeated rows are packed each; a null id comes first and is carried as null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm._spark import columns
from skyledger.llm.bpe import codec


class RoomTree:
    """Stacks of rows by the room they have left; finds the least room of at least a size in log(length) steps."""

    def __init__(self, length: int):
        self.width = 1 << length.bit_length()
        self.count = [0] * (2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def _add(self, room: int, by: int) -> None:
        i = room + self.width
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, row) of the fullest row with room for size, taken out; None if there is none."""
        i = size + self.width
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.width:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.width
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows as lists of item numbers, each of at most length in all."""
    tree, rows = RoomTree(length), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = tree.take(sizes[i])
        if found is None:
            rows.append([i])
            room, row = length, len(rows) - 1
        else:
            room, row = found
            rows[row].append(i)
        if room - sizes[i]:
            tree.put(room - sizes[i], row)
    return rows


SCHEMA = "bin int, row int, n_tokens int, doc_ids array<long>, doc_offsets array<int>, cu_seqlens array<int>, ids binary, positions binary"
TYPES = (pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary())
NAMES = tuple(x.split()[0] for x in SCHEMA.split(", "))
GROUP_BYTES = 16 << 20
OUT_ROWS = 512  # packed rows in one Arrow batch


def _rows(group: int, docs: list, pieces: list[tuple[int, int, np.ndarray]], length: int, pad: int) -> Iterator[pa.RecordBatch]:
    """The packed rows of a group: id and position rows as little-endian 32-bit integers."""
    out = []
    for row, items in enumerate(best_fit_decreasing([len(p[2]) for p in pieces], length)):
        mine = [pieces[i] for i in items]
        cu = np.concatenate(([0], np.cumsum([len(p[2]) for p in mine])))
        full = np.full(length, pad, "<u4")
        full[: cu[-1]] = np.concatenate([p[2] for p in mine])
        # Positions begin anew with each piece, and with the padding.
        marks = np.concatenate((cu, [length])) if cu[-1] < length else cu
        positions = (np.arange(length) - np.repeat(marks[:-1], np.diff(marks))).astype("<i4")
        out.append((group, row, int(cu[-1]), [docs[p[0]] for p in mine], [p[1] for p in mine], cu.tolist(), full.tobytes(), positions.tobytes()))
        if len(out) == OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), TYPES)], NAMES)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), TYPES)], NAMES)


def _pack(path: str, length: int, pad: int):
    """For mapInArrow over rows sorted by group, id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, now, docs, pieces = codec(path), None, [], []
        for batch in batches:
            group, doc, texts = columns(batch, "group", "doc_id", "text")
            group, doc = group.to_numpy(), doc.to_pylist()
            cut = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
            for lo, hi in zip(cut, cut[1:]):
                if lo == hi:
                    continue
                if group[lo] != now:
                    yield from _rows(now, docs, pieces, length, pad)
                    now, docs, pieces = int(group[lo]), [], []
                for first, ids, rows in c.encode(texts.slice(lo, hi - lo)):
                    ids = ids.astype("<u4")
                    for i, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
                        pieces += [(len(docs) + first + i, k - a, ids[k : min(k + length, b)]) for k in range(a, b, length)]
                docs += doc[lo:hi]
        yield from _rows(now, docs, pieces, length, pad)

    return run


def pack_tokens(
    docs: DataFrame, path: str, *, length: int = 2048, pad: int = 50256, id_col: str = "doc_id", text_col: str = "text", group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """One row per packed row: its documents, where each piece begins in its document (in ids) and in the row
    (cumulative lengths), and the id and position rows."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text <> ''")
    groups = -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 1) // group_bytes)
    rows = docs.withColumn("group", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int"))
    return rows.repartition("group").sortWithinPartitions("group", "doc_id", "text").mapInArrow(_pack(path, length, pad), SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """The packed rows as Parquet: matrices of ids and positions as binary rows, with their cumulative lengths."""
    packed.write.mode("overwrite").parquet(path)


def digests(packed: DataFrame) -> DataFrame:
    """The packed rows with the SHA-256 of their ids and positions in place of these."""
    return packed.select(*NAMES[:-2], *(F.sha2(c, 256).alias(f"{c}_sha256") for c in NAMES[-2:]))
