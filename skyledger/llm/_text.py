"""Vectorised text primitives shared by the operators: byte views of Arrow columns, words, hashes, minima.

Everything works on slices of a few MB (or one document, if longer), so memory follows the slice and the
longest document, never the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U64 = np.uint64
TOP = U64(0xFFFFFFFFFFFFFFFF)
# Odd multipliers of the polynomial hashes; any odd 64-bit numbers serve.
P_BYTE, P_GRAM = 0x9E3779B97F4A7C55, 0xD6E8FEB86659FD93


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Invertible 64-bit finaliser (xor-shift-multiply), so that all bits depend on all bits."""
    x = x ^ U64(seed)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


@lru_cache(maxsize=4)
def byte_codes(seed: int) -> np.ndarray:
    """A random 64-bit code for each byte."""
    return mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15), seed)


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n; kept for the usual slice length only."""
    have = _powers.get(base)
    if have is not None and len(have[0]) >= n:
        return have[0][:n], have[1][:n]
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.full(n, U64(b))
        p[:1] = 1
        out.append(np.cumprod(p, dtype=U64))
    if n <= SLICE_BYTES + (1 << 17):
        _powers[base] = (out[0], out[1])
    return out[0], out[1]


def prefix_sums(codes: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of codes[i]*base^i (one longer than codes) and base^-i."""
    up, down = powers(base, len(codes) + 1)
    sums = np.zeros(len(codes) + 1, U64)
    np.cumsum(codes * up[:-1], out=sums[1:])
    return sums, down


def gram_hashes(codes: np.ndarray, n: int, base: int = P_GRAM, seed: int = 0) -> np.ndarray:
    """Hash of codes[i:i+n] for each i; len(codes)-n+1 values (none if too short)."""
    if len(codes) < n:
        return np.zeros(0, U64)
    sums, down = prefix_sums(codes, base)
    m = len(codes) - n + 1
    return mix((sums[n:] - sums[:m]) * down[:m], seed)


def view(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and n+1 offsets into them; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    kind = pa.large_binary() if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else pa.large_string()
    texts = texts.cast(kind).fill_null(b"" if kind == pa.large_binary() else "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return bytes_[at[0] : at[-1]], at - at[0]


def slices(at: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of rows of at most ``most`` bytes, or a single longer row."""
    a, n = 0, len(at) - 1
    while a < n:
        b = int(np.searchsorted(at, at[a] + most, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def lower_ascii(b: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all else unchanged."""
    return np.where((b >= 65) & (b <= 90), b + np.uint8(32), b)


def _class(lo_hi: list[tuple[int, int]]) -> np.ndarray:
    out = np.ones(256, bool)
    for lo, hi in lo_hi:
        out[lo : hi + 1] = False
    return out


#: Bytes of words `[^\x20\x09-\x0D]+`, and of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
SPACED = _class([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = _class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def words(b: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in bytes b, and n+1 offsets of each row's words. Words never cross rows."""
    ok = np.zeros(len(b) + 2, bool)
    ok[1:-1] = inside[b]
    edge = np.zeros(len(b) + 1, bool)
    edge[at] = True
    starts = np.flatnonzero(ok[1:] & (~ok[:-1] | edge))
    ends = np.flatnonzero(ok[:-1] & (~ok[1:] | edge))
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word."""
    sums, down = prefix_sums(byte_codes(seed)[b], P_BYTE)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64), seed)


def row_of(at: np.ndarray) -> np.ndarray:
    """The row of each item, for n+1 offsets."""
    return np.repeat(np.arange(len(at) - 1), np.diff(at))


def inside_rows(at: np.ndarray, n: int, total: int) -> np.ndarray:
    """Whether n items from i on lie in one row, for i < total-n+1."""
    m = total - n + 1
    if m <= 0:
        return np.zeros(0, bool)
    end = np.repeat(at[1:], np.diff(at))[:m]
    return np.arange(m) + n <= end


def sliding(x: np.ndarray, w: int, op=np.minimum) -> np.ndarray:
    """op over each w neighbours; len(x)-w+1 values, by doubling."""
    have = 1
    while have < w:
        step = min(have, w - have)
        x = op(x[: len(x) - step], x[step:])
        have += step
    return x


def minima(h: np.ndarray, valid: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """h: hash of the gram at each place; valid: whether the window that starts there stays in its row (its w
    grams start at i..i+w-1).  Returns each window's least gram hash, and the places of grams that are least
    in some valid window.  Both depend on nothing outside the window, so equal windows have equal minima:
    the least grams cover the windows."""
    if len(valid) == 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    low = sliding(h, w)[: len(valid)]
    padded = np.zeros(len(h) + w - 1, U64)
    padded[w - 1 : w - 1 + len(low)] = np.where(valid, low, U64(0))
    most = sliding(padded, w, np.maximum)[: len(h)]
    return low, np.flatnonzero((most == h) & (most != 0))


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true."""
    d = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def covered(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of total items lie in a window of n from one of the starts."""
    d = np.zeros(total + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, np.minimum(starts + n, total), -1)
    return np.cumsum(d[:-1]) > 0


def equal_stretches(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether data[a:a+size] and data[b:b+size] agree, for arrays of places and sizes of one byte at least."""
    out = np.zeros(len(a), bool)
    cut = np.concatenate(([0], np.cumsum(size)))
    lo = 0
    while lo < len(a):  # some quarter of a MB at a time
        hi = max(int(np.searchsorted(cut, cut[lo] + (1 << 18), "right")) - 1, lo + 1)
        at = cut[lo:hi] - cut[lo]
        step = np.arange(cut[hi] - cut[lo]) - np.repeat(at, size[lo:hi])
        same = data[np.repeat(a[lo:hi], size[lo:hi]) + step] == data[np.repeat(b[lo:hi], size[lo:hi]) + step]
        out[lo:hi] = np.logical_and.reduceat(same, at)
        lo = hi
    return out


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order that sorts keys, and n+1 offsets of the runs of equal keys in it."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    cut = np.flatnonzero(s[1:] != s[:-1]) + 1
    return order, np.concatenate(([0], cut, [len(s)])) if len(s) else np.zeros(1, np.int64)


def array_of(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(values, type=kind)


def blobs(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """A binary column: row i holds the bytes of data[at[i]:at[i+1]]."""
    size = data.dtype.itemsize
    raw = np.ascontiguousarray(data)
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at * size, np.int64)), pa.py_buffer(raw)]).cast(pa.binary())


def unblob(column: pa.Array | pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of blobs."""
    data, at = view(column)
    size = np.dtype(dtype).itemsize
    return np.frombuffer(np.ascontiguousarray(data).tobytes(), dtype), at // size
