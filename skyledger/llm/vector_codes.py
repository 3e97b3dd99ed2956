"""Operator 13: compression of vectors to a byte a part, by codebooks of integer k-means with annular norm pruning.

Components become whole numbers, floor(scale * x), so sums and distances are exact and no order of adding changes them.  A
round is one pass: tasks assign their vectors and add up what each entry gets, one row for each entry and task; the sums
meet in a grouping with map-side merging and only the new codebooks (``entries`` rows a part) reach the driver and are sent
out.  The search for the nearest entry sorts a part's entries by norm.  A vector's distance to the entries next to it in
norm bounds its best distance d; by the triangle inequality nothing outside the norms [n - d, n + d] can be nearer or as
near, so a binary search finds this annulus, and only it, both ends included, is evaluated.  Vectors are taken in blocks of
neighbours in norm, which share one matrix product over the union of their annuli.

Edge cases: rows whose vector is null or holds null, NaN or infinite components are dropped; rows that repeat an id are each
coded; the first codebook takes each id once, with its least vector, and no null id; with fewer than ``entries`` ids the
codebooks are as small as these; ties go to the lower index; null labels are one label; an empty table gives an empty
result; further columns do not matter.  Vectors of several lengths, or of one that is no multiple of ``parts``, are an
error.  Components so large that distances leave the whole numbers a double holds are computed with Python's integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm._spark import columns, stored

BLOCK = 256  # vectors of neighbouring norms that are searched together
NEAR = 8  # entries next to a block in norm, on either side, that give the first bound
SLACK = 1e-9  # of a norm: more than the rounding of square roots and sums
FEW_LABELS = 1 << 16  # so many sums by label are broadcast; more are joined by a shuffle


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are numbers."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as doubles that hold whole numbers."""
    return np.floor(values.astype(np.float64) * scale)


def exact_kind(dim: int, *arrays: np.ndarray) -> type:
    """float64 where all sums of dim products of differences are whole numbers that a double holds, else object."""
    most = max((float(np.abs(a).max()) for a in arrays if a.size), default=0.0)
    return np.float64 if 4 * max(dim, 1) * most * most < 2.0**53 else object


def _as(kind: type, a: np.ndarray) -> np.ndarray:
    return a if kind is np.float64 else np.array([[int(x) for x in row] for row in a], object).reshape(a.shape)


class Annuli:
    """The entries of one part's codebook, ready to be searched."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.norm = np.sqrt((entries.astype(np.float64) ** 2).sum(1))
        self.by_norm = np.argsort(self.norm, kind="stable")
        self.sorted = self.norm[self.by_norm]
        self.evaluated = 0  # distances, for tests

    def _distances(self, x: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Exact squared distances of x to the entries of places lo to hi in norm, and the entries' indexes, ascending."""
        at = np.sort(self.by_norm[lo:hi])
        kind = exact_kind(x.shape[1], x, self.entries)
        a, c = _as(kind, x), _as(kind, self.entries[at])
        self.evaluated += len(a) * len(at)
        return (a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)[None, :], at

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of each row's nearest entry, the lower of equal ones, and its squared distance."""
        norm = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        code, error = np.zeros(len(x), np.int64), np.zeros(len(x), object)
        order = np.argsort(norm, kind="stable")
        for k in range(0, len(x), BLOCK):
            rows = order[k : k + BLOCK]
            n, part = norm[rows], x[rows]
            lo = max(int(np.searchsorted(self.sorted, n[0])) - NEAR, 0)
            hi = min(int(np.searchsorted(self.sorted, n[-1])) + NEAR, len(self.sorted))
            bound = np.sqrt(self._distances(part, lo, hi)[0].min(1).astype(np.float64))
            slack = SLACK * (n + bound) + SLACK
            lo = int(np.searchsorted(self.sorted, (n - bound - slack).min(), "left"))
            hi = int(np.searchsorted(self.sorted, (n + bound + slack).max(), "right"))
            d, at = self._distances(part, lo, hi)
            best = d.argmin(1)  # entries ascend by index, so the first of equal distances is the lower index
            code[rows], error[rows] = at[best], d[np.arange(len(rows)), best]
        return code, error


def _vectors(batch: pa.RecordBatch, dim: int, scale: int) -> np.ndarray:
    (column,) = columns(batch, "v")
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes != dim).any():
        raise ValueError(f"vectors of {dim} and of {int(sizes[sizes != dim][0])} components")
    return whole(column.flatten().to_numpy(zero_copy_only=False), scale).reshape(len(column), dim)


def _cut(x: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.split(x, parts, axis=1)


def _sums(books: list[np.ndarray], dim: int, scale: int):
    """What each entry gets from a task: (part, entry, n, s0, s1, ...), one row an entry."""
    parts, width = len(books), dim // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Annuli(b) for b in books]
        n = np.zeros((parts, len(books[0])), np.int64)
        total = np.zeros((parts, len(books[0]), width), np.int64)
        for batch in batches:
            for p, x in enumerate(_cut(_vectors(batch, dim, scale), parts)):
                code, _ = search[p].nearest(x)
                n[p] += np.bincount(code, minlength=n.shape[1])
                np.add.at(total[p], code, x.astype(np.int64))
        part, entry = np.nonzero(n)
        cols = [part.astype(np.int32), entry.astype(np.int32), n[part, entry], *total[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["part", "entry", "n", *(f"s{k}" for k in range(width))])

    return run


def _codes(books: list[np.ndarray], dim: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Annuli(b) for b in books]
        for batch in batches:
            x = _vectors(batch, dim, scale)
            found = [search[p].nearest(part) for p, part in enumerate(_cut(x, len(books)))]
            raw = np.column_stack([c for c, _ in found]).astype(np.uint8)
            error = sum((e for _, e in found), np.zeros(len(x), object))
            ids, labels = columns(batch, "vec_id", "label")
            code = pa.array([r.tobytes().hex() for r in raw], pa.string())
            yield pa.RecordBatch.from_arrays([ids, labels, code, pa.array([int(e) for e in error], pa.int64())], ["vec_id", "label", "code", "error"])

    return run


def first_books(kept: DataFrame, parts: int, entries: int, scale: int) -> list[np.ndarray]:
    """The vectors of the smallest ids, cut into parts: ``entries`` rows at most."""
    ids = [r[0] for r in kept.where("vec_id IS NOT NULL").select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
    rows = sorted(kept.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("v").alias("v")).collect()) if ids else []
    dims = {len(r.v) for r in rows}
    if len(dims) > 1 or any(d % parts for d in dims):
        raise ValueError(f"vectors of {sorted(dims)} components, to be cut into {parts} parts")
    x = whole(np.array([r.v for r in rows], np.float64), scale)
    return _cut(x.reshape(len(rows), dims.pop() if dims else 0), parts)


def train(kept: DataFrame, books: list[np.ndarray], *, rounds: int, scale: int) -> list[np.ndarray]:
    """The codebooks after so many rounds of assigning all vectors and moving entries to floor(sum / count)."""
    width = books[0].shape[1]
    names = [f"s{k}" for k in range(width)]
    schema = ", ".join(["part int", "entry int", "n long", *(f"{s} long" for s in names)])
    for _ in range(rounds):
        sums = kept.select("v").mapInArrow(_sums(books, width * len(books), scale), schema)
        books = [b.copy() for b in books]
        for part, entry, n, *s in sums.groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in ("n", *names))).collect():
            books[part][entry] = [x // n for x in s]
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def vector_codes(
    vectors: DataFrame, spark: SparkSession, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024
) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) for each vector that is kept; the codes are a table in the shared folder."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is a byte: 1 to 256 entries")
    v = F.col(vector_col)
    kept = vectors.where(finite(v)).select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), v.cast("array<double>").alias("v"))
    books = first_books(kept, parts, entries, scale)
    if not len(books[0]) and not kept.isEmpty():
        raise ValueError("no vector has an id to begin a codebook from")
    books = train(kept, books, rounds=rounds, scale=scale)
    dim = books[0].shape[1] * parts
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    coded = stored(kept.mapInArrow(_codes(books, dim, scale), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"), spark)
    sums = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), spark, ids=True)
    few = len(sums.select("label").head(FEW_LABELS + 1)) <= FEW_LABELS
    out = coded.join(F.broadcast(sums) if few else sums.hint("merge"), coded["label"].eqNullSafe(sums["label"]))
    return out.select(F.col("vec_id").alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
