"""The classic netCDF format (versions 1 and 2), read from bytes without a library.

After the magic number and the number of records come three lists (dimensions, attributes, variables); numbers are
big-endian and names are padded to four bytes.  Variables whose first dimension is the unlimited one lie interleaved by record.
"""

from __future__ import annotations

import struct

import numpy as np

# Types by number.
TYPES = {1: "i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}


class _Header:
    def __init__(self, data: bytes):
        self.data, self.at = data, 4
        if data[:3] != b"CDF" or data[3] not in (1, 2):
            raise ValueError("not a classic netCDF file")
        self.wide = data[3] == 2

    def number(self, kind: str = ">i") -> int:
        (x,) = struct.unpack_from(kind, self.data, self.at)
        self.at += struct.calcsize(kind)
        return x

    def skip(self, n: int) -> bytes:
        out = self.data[self.at : self.at + n]
        self.at += -(-n // 4) * 4
        return out

    def name(self) -> str:
        return self.skip(self.number()).decode("utf-8", "replace")

    def count(self) -> int:
        """The length of a list, after its tag."""
        self.number()
        return self.number()

    def attributes(self) -> dict[str, np.ndarray]:
        out = {}
        for _ in range(self.count()):
            name, kind = self.name(), np.dtype(TYPES[self.number()])
            n = self.number()
            out[name] = np.frombuffer(self.skip(n * kind.itemsize), kind)
        return out


def variables(data: bytes) -> dict[str, np.ndarray]:
    """Arrays by name; fill values of floating-point variables are NaN, and the last dimension of text is joined."""
    h = _Header(data)
    records = h.number()
    dims = [(h.name(), h.number()) for _ in range(h.count())]
    h.attributes()
    listed = []
    for _ in range(h.count()):
        name = h.name()
        ids = [h.number() for _ in range(h.number())]
        own = h.attributes()
        kind, size, begin = np.dtype(TYPES[h.number()]), h.number(">I"), h.number(">q" if h.wide else ">i")
        listed.append((name, ids, own, kind, size, begin))
    unlimited = {i for i, (_, n) in enumerate(dims) if n == 0}
    by_record = [v for v in listed if v[1] and v[1][0] in unlimited]
    step = sum(v[4] for v in by_record)
    if len(by_record) == 1:  # a single record variable is not padded
        _, ids, _, kind, _, _ = by_record[0]
        step = kind.itemsize * int(np.prod([dims[i][1] for i in ids[1:]], dtype=np.int64))
    if records < 0:
        records = (len(data) - min(v[5] for v in by_record)) // step if by_record else 0
    out = {}
    for name, ids, own, kind, _, begin in listed:
        if ids and ids[0] in unlimited:
            shape = (records, *(dims[i][1] for i in ids[1:]))
            strides = [kind.itemsize]
            for n in reversed(shape[2:]):
                strides.insert(0, strides[0] * n)
            x = np.ndarray(shape, kind, data, begin, (step, *strides[: len(shape) - 1]))
        else:
            shape = tuple(dims[i][1] for i in ids)
            x = np.ndarray(shape, kind, data, begin)
        if kind.kind == "S":
            x = np.ascontiguousarray(x)
            x = x.view(f"S{x.shape[-1]}").reshape(x.shape[:-1]) if x.ndim > 1 else x
        elif kind.kind == "f":
            x = x.astype(float)
            for fill in (own.get("_FillValue"), own.get("missing_value")):
                if fill is not None and len(fill):
                    x[x == float(fill[0])] = np.nan
        out[name] = x
    return out
