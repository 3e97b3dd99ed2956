"""Count-min sketch merged from partitions: which hashes may occur twice, and which may occur very often.

Each partition sends the cells that it touches with their counts, as 16-bit places within blocks of 65,536 cells; blocks
merge on executors, one at a time, and come back as bits.  The number of cells follows the input between two bounds
(2 rows of 2^20 to 2^29 cells, a bit each: 128 MB at most, sent packed; cells that are touched very often are a list, which
holds less than one for OFTEN of the input's hashes).  It overestimates, so no repeated hash is lost; a sketch
that is too small only lets more through to the exact pass.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import _text as X
from skyledger.llm._spark import columns

ROWS = 2
LEAST_LOG, MOST_LOG = 20, 29
CELLS_EACH = 4  # cells for each hash that is expected
OFTEN = 1 << 16  # counts from which a hash is dealt out by its surroundings
U64 = X.U64


def _cells(h: np.ndarray, row: int, log_cells: int) -> np.ndarray:
    """Cells of hashes in a row of the sketch: disjoint bits of a mixed hash."""
    h = X.mix(h, 0xC0FFEE)
    return ((h >> U64(row * 32)) & U64((1 << log_cells) - 1)).astype(np.uint32)


@dataclass
class Sketch:
    repeated: np.ndarray  # one bit a cell
    often: np.ndarray  # the sorted numbers of cells
    log_cells: int

    def __getstate__(self) -> tuple[bytes, np.ndarray, int]:
        return zlib.compress(self.repeated.tobytes(), 1), self.often, self.log_cells

    def __setstate__(self, state: tuple[bytes, np.ndarray, int]) -> None:
        self.repeated, self.often, self.log_cells = np.frombuffer(zlib.decompress(state[0]), np.uint8), state[1], state[2]

    def may_repeat(self, h: np.ndarray) -> np.ndarray:
        ok = np.ones(len(h), bool)
        for row in range(ROWS):
            cell = _cells(h, row, self.log_cells)
            at = (cell >> np.uint32(3)).astype(np.int64) + ((row << self.log_cells) >> 3)
            ok &= (self.repeated[at] >> (cell & np.uint32(7)).astype(np.uint8)) & 1 > 0
        return ok

    def may_be_often(self, h: np.ndarray) -> np.ndarray:
        ok = np.full(len(h), len(self.often) > 0)
        for row in range(ROWS if len(self.often) else 0):
            cell = _cells(h, row, self.log_cells).astype(np.int64) + (row << self.log_cells)
            ok &= self.often[np.minimum(np.searchsorted(self.often, cell), len(self.often) - 1)] == cell
        return ok


def log_cells_for(size: int, share: float) -> int:
    """For so many bytes of text, of which so many hashes a byte are expected."""
    return int(np.clip(np.ceil(np.log2(max(size * share * CELLS_EACH, 1))), LEAST_LOG, MOST_LOG))


def _touch(hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], log_cells: int):
    blocks = 1 << (log_cells - 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.concatenate([np.zeros(0, U64), *hashes(batch)])
            for row in range(ROWS):
                cell = np.sort(_cells(h, row, log_cells))
                heads = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, np.int64)
                n = np.diff(np.concatenate((heads, [len(cell)])))
                cell = cell[heads]
                cut = np.searchsorted(cell, np.arange(blocks + 1, dtype=np.int64) << 16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(blocks, dtype=np.int32) + row * blocks), X.blobs((cell & 0xFFFF).astype(np.uint16), cut), X.blobs(np.minimum(n, 0xFFFF).astype(np.uint16), cut)], ["block", "cells", "counts"]
                ).filter(pa.array(np.diff(cut) > 0))

    return run


def _merge(often: int):
    def bits(total: np.ndarray) -> tuple[bytes, bytes]:
        packed = zlib.compress(np.packbits(total > 1, bitorder="little").tobytes(), 1)
        return packed, np.flatnonzero(total >= often).astype(np.uint16).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, done = None, None, []
        for batch in batches:
            for block, cells, counts in zip(*(c.to_pylist() for c in columns(batch, "block", "cells", "counts"))):
                if block != now:
                    if now is not None:
                        done.append((now, *bits(total)))
                    now, total = block, np.zeros(1 << 16, np.int64)
                total[np.frombuffer(cells, np.uint16)] += np.frombuffer(counts, np.uint16)
        if now is not None:
            done.append((now, *bits(total)))
        cols = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.binary(), pa.binary()))], ["block", "repeated", "often"])

    return run


def sketch(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], log_cells: int, often: int = OFTEN) -> Sketch:
    """The merged sketch over the hashes of each batch of df."""
    rows = df.mapInArrow(_touch(hashes, log_cells), "block int, cells binary, counts binary").repartition("block").sortWithinPartitions("block")
    rows = rows.mapInArrow(_merge(often), "block int, repeated binary, often binary")
    size = (ROWS << log_cells) >> 3
    out, many = np.zeros(size, np.uint8), [np.zeros(0, np.int64)]
    for block, bits, hot in rows.collect():  # a bit a cell at most, and few cells
        out[block << 13 : (block + 1) << 13] = np.frombuffer(zlib.decompress(bits), np.uint8)
        many.append(np.frombuffer(hot, np.uint16).astype(np.int64) + (block << 16))
    return Sketch(out, np.sort(np.concatenate(many)), log_cells)
