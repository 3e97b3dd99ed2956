"""Operator 2: exact Jaccard join of word shingles by prefix filters under several global token orders.

A set of n tokens that reaches the similarity with another must share one of its first n-ceil(pct*n/100)+1 tokens
with it under *any* order of all tokens.  Order A puts tokens last that repeat within partitions (lossy counts of all
documents in a sketch of fixed size), and B and C are two orders by hash.  Sets that share a prefix token under A meet
in a group; within it the filters under B and C are intersected, first on signatures (the prefixes' hashes), so that
only texts with a pair that passes both are sent to be verified.

Sets that are equal fall into one class first.  The classes of a token form a group under the name of the least of
them, so tokens with nearly the same classes make one group, and a class comes to it once.  A group is split into
parts of bounded sets and tokens.  First each part is searched by itself; then, where the links so far have not joined
a group of several parts into one component, each two of its parts are, for pairs of different components.  Overlaps
in a part are counted by matrix products, and only edges of a spanning forest leave it, so rows grow with the classes
and not with the pairs.  No component is missed and no count is capped.

One task groups all classes of a token, but for tokens that the sketch counts more than MOST_CLASSES times: theirs
stay rows of a table, the least is found by an aggregation with partial results, and the join that names the group is
salted.  The sketch leaves out a token that occurs once in a batch, so a task holds MOST_CLASSES of a token and one
more for each batch at most.

Tokens are 64-bit hashes of the words' bytes; a class is known by a 64-bit sum and its size.  Edge cases: null and
empty texts have no shingles and link with nothing; texts of fewer words than the shingle form one shingle; rows
that repeat an id are one document: linked if one of its texts is, though each row shows the component of its own text
and a tile holds one of its sets; a null id takes the component of equal texts and links no others; an empty table gives
an empty result; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import _text as X
from skyledger.llm._spark import Scratch, buckets_of, columns, text_bytes
from skyledger.llm.components import connected_components

U64 = X.U64
ORDER_CELLS = 24  # log2 of the sketch's cells: 16 MB, whatever the input
MOST_SETS, MOST_TOKENS = 2048, 1 << 21  # of a part, about; a longer set is a part by itself
MOST_CLASSES = 1 << 20  # of a token that one task groups; those of more are dealt out over SALTS
SALTS = 64
ORDERS = (11, 12)  # seeds of the orders B and C
NEAR = 8  # classes of a token that are held against one another by place
FEW = 6  # sets up to which pairs are compared one by one
BLOCK = 1024  # columns of a matrix product


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, at = X.view(texts)
    for a, b in X.slices(at):
        part = X.lower_ascii(data[at[a] : at[b]])
        starts, ends, rows = X.words(part, at[a : b + 1] - at[a], X.SPACED)
        w = X.word_hashes(part, starts, ends, 2)
        grams = X.gram_hashes(w, size)
        for i in range(b - a):
            lo, hi = rows[i], rows[i + 1]
            if hi - lo >= size:
                yield np.unique(grams[lo : hi - size + 1])
            elif hi > lo:
                yield X.gram_hashes(w[lo:hi], int(hi - lo), seed=int(hi - lo))
            else:
                yield w[:0]


def _fingerprint(s: np.ndarray) -> np.int64:
    return np.int64(np.bitwise_xor.reduce(X.mix(s, 77)).view(np.int64) ^ np.add.reduce(X.mix(s, 78)).view(np.int64)) if len(s) else np.int64(0)


def _prefix(n: int, pct: int) -> int:
    return n - (pct * n + 99) // 100 + 1


def _first(s: np.ndarray, pct: int, seed: int) -> np.ndarray:
    """The prefix of a set under an order by hash."""
    p = _prefix(len(s), pct)
    return np.partition(X.mix(s, seed), p - 1)[:p]


def _describe(size: int, pct: int):
    """Size and name of each set, and 32 bits of each token of its prefixes under B, then C."""

    def signature(s: np.ndarray) -> bytes:
        return b"".join(_first(s, pct, k).astype(np.uint32).tobytes() for k in ORDERS) if len(s) else b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = columns(batch, "doc_id", "text")
            sets = [(len(s), _fingerprint(s), signature(s)) for s in shingle_sets(texts, size)]
            n, fp, signs = zip(*sets) if sets else ((), (), ())
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(np.array(n, np.int64)), pa.array(np.array(fp, np.int64)), pa.array(signs, pa.binary())], ["doc_id", "n", "fp", "signature"])

    return run


def _repeated(size: int, cells: int):
    """Tokens that several different sets of the partition hold, as counts by cell of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, kept = set(), []
            for s in shingle_sets(columns(batch, "text")[0], size):
                if len(s) and (key := (len(s), int(_fingerprint(s)))) not in seen:
                    seen.add(key)
                    kept.append(s)
            tokens, counts = np.unique(np.concatenate(kept) if kept else np.zeros(0, U64), return_counts=True)
            tokens, counts = tokens[counts > 1], counts[counts > 1].astype(np.int64)
            cell = (tokens & U64((1 << cells) - 1)).astype(np.int64)
            order = np.argsort(cell, kind="stable")
            cell, counts = cell[order], np.minimum(counts[order], 0xFFFF)
            cut = np.searchsorted(cell >> 16, np.arange((1 << max(cells - 16, 0)) + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(cut) - 1, dtype=np.int32)), X.blobs((cell & 0xFFFF).astype(np.uint16), cut), X.blobs(counts.astype(np.uint16), cut)], ["block", "cell", "count"]
            ).filter(pa.array(np.diff(cut) > 0))

    return run


def _merge_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, cell, count in zip(*(c.to_pylist() for c in columns(batch, "block", "cell", "count"))):
            into = total.setdefault(block, np.zeros(1 << 16, np.int64))
            np.add.at(into, np.frombuffer(cell, np.uint16), np.frombuffer(count, np.uint16))
    logs = [np.minimum(np.log2(1.0 + v) * 4, 255).astype(np.uint8).tobytes() for v in total.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(logs, pa.binary())], ["block", "logs"])


def _token_order(docs: DataFrame, size: int, cells: int) -> np.ndarray:
    parts = docs.select("text").mapInArrow(_repeated(size, cells), "block int, cell binary, count binary")
    rows = parts.repartition("block").mapInArrow(_merge_counts, "block int, logs binary").collect()  # at most 2^cells bytes
    out = np.zeros(max(1 << cells, 1 << 16), np.uint8)
    for block, logs in rows:
        out[block << 16 : (block + 1) << 16] = np.frombuffer(logs, np.uint8)
    return out


def _order_a(s: np.ndarray, logs: np.ndarray) -> np.ndarray:
    return (logs[(s & U64(len(logs) - 1)).astype(np.int64)].astype(U64) << U64(56)) | (s >> U64(8))


def _level(count: int) -> int:
    """The sketch's logarithm of a count."""
    return int(min(np.log2(1.0 + count) * 4, 255))


def _prefix_tokens(batch: pa.RecordBatch, size: int, pct: int, logs: np.ndarray, level: int, hot: bool) -> tuple[np.ndarray, ...]:
    """(token, fp, n, place): the prefix tokens under A of each different set of the batch, either the hot ones or the
    others; place: how far along the prefix a token stands, in 255ths, rounded down."""
    seen, tokens, fps, ns, places = set(), [np.zeros(0, U64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.uint8)]
    for s in shingle_sets(columns(batch, "text")[0], size):
        n, fp = len(s), _fingerprint(s)
        if not n or (n, int(fp)) in seen:
            continue
        seen.add((n, int(fp)))
        p = _prefix(n, pct)
        key = np.sort(np.partition(_order_a(s, logs), p - 1)[:p])
        place = (np.searchsorted(key, key) * 255 // p).astype(np.uint8)
        some = (key >> U64(56) > U64(level)) == hot
        key = key[some]
        tokens.append(X.mix(key, 5))
        fps.append(np.full(len(key), fp))
        ns.append(np.full(len(key), min(n, 0xFFFFFFFF), np.uint32))
        places.append(place[some])
    return np.concatenate(tokens), np.concatenate(fps), np.concatenate(ns), np.concatenate(places)


def _emit_hot(size: int, pct: int, order, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, fp, n, _ = _prefix_tokens(batch, size, pct, order.value, level, True)
            yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(fp), pa.array(n.astype(np.int64))], ["token", "fp", "n"])

    return run


def _hot_groups(docs: DataFrame, size: int, pct: int, order, level: int) -> DataFrame:
    """Rows (fp, n, pfp, pn) as of _buckets for the hot tokens, without one task that sees all classes of one."""
    rows = docs.select("text").mapInArrow(_emit_hot(size, pct, order, level), "token long, fp long, n long").distinct()
    least = rows.groupBy("token").agg(F.min(F.struct("fp", "n")).alias("p"))
    least = least.select("token", F.col("p.fp").alias("pfp"), F.col("p.n").alias("pn"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("fp", "n"), F.lit(SALTS)).cast("int"))
    return salted.hint("merge").join(least, ["token", "salt"]).select("fp", "n", "pfp", "pn")


def _emit(size: int, pct: int, order, level: int, buckets: int):
    """The prefix tokens under A of each different set of the batch, dealt out by token; hot ones are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, fp, n, place = _prefix_tokens(batch, size, pct, order.value, level, False)
            if not len(t):
                continue
            bucket = ((t >> U64(32)) % U64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            heads = np.flatnonzero(np.diff(bucket[by], prepend=-1))
            cut = np.append(heads, len(by))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[by[heads]].astype(np.int32)), X.blobs(t[by].astype(np.uint32), cut), X.blobs(fp[by], cut), X.blobs(n[by], cut), X.blobs(place[by], cut)], ["bucket", "token", "fp", "n", "place"]
            )

    return run


def _each_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The arrays of one bucket at a time, from rows sorted by bucket."""
    now, held = None, []
    for batch in batches:
        for bucket, *blobs in zip(*(c.to_pylist() for c in columns(batch, "bucket", "token", "fp", "n", "place"))):
            if bucket != now and held:
                yield held
                held = []
            now = bucket
            held.append(tuple(np.frombuffer(x, d) for x, d in zip(blobs, (np.uint32, np.int64, np.uint32, np.uint8))))
    if held:
        yield held


def _buckets(pct: int):
    """From tokens to groups: rows (fp, n, pfp, pn), the classes that share a token and the least class among them.
    Sizes with a gap that no link can cross are apart.  In a group of up to NEAR classes, one stays only if the token can
    be the first under A that it shares with another: what follows the token in both must be enough for a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _each_bucket(batches):
            t, fp, n, place = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((place, fp, n, t))  # of a class's places the first stays, should two of its tokens share t
            t, fp, n, place = t[order], fp[order], n[order].astype(np.int64), place[order]
            fresh = np.ones(len(t), bool)
            fresh[1:] = (t[1:] != t[:-1]) | (fp[1:] != fp[:-1]) | (n[1:] != n[:-1])
            t, fp, n, place = t[fresh], fp[fresh], n[fresh], place[fresh]
            new = np.concatenate(([True], (t[1:] != t[:-1]) | (n[:-1] * 100 < n[1:] * pct)))
            run_ = np.cumsum(new) - 1
            count = np.bincount(run_)[run_]
            # Tokens from this one on, at most: place is rounded down.
            rest = n - -(-place.astype(np.int64) * (n - -(-pct * n // 100) + 1) // 255)
            kept = count > NEAR
            for d in range(1, min(NEAR, len(n))):
                need = -(-pct * (n[d:] + n[:-d]) // (100 + pct))
                pair = np.flatnonzero((run_[d:] == run_[:-d]) & (rest[d:] >= need) & (rest[:-d] >= need))
                kept[pair] = kept[pair + d] = True
            kept &= count > 1
            fp, n, run_ = fp[kept], n[kept], run_[kept]
            if not len(fp):
                continue
            rank = X.mix(fp.view(U64) ^ n.view(U64), 31)
            order = np.lexsort((rank, run_))
            fp, n, run_ = fp[order], n[order], run_[order]
            heads = np.flatnonzero(np.concatenate(([True], run_[1:] != run_[:-1])))
            pivot = np.repeat(heads, np.diff(np.concatenate((heads, [len(fp)]))))
            rows = np.unique(np.column_stack((fp, n, fp[pivot], n[pivot])), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, k])) for k in range(4)], ["fp", "n", "pfp", "pn"])

    return run


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The size of the intersection of each two sets: products of indicator columns for tokens of many sets, pair by
    pair for the others."""
    k = len(sets)
    row = np.repeat(np.arange(k), [len(s) for s in sets])
    _, col, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    dense = df > max(k // 8, 1)
    out = np.zeros((k, k), np.int32)
    at = np.cumsum(dense) - 1
    here = dense[col]
    c, r = at[col[here]], row[here]
    order = np.argsort(c, kind="stable")
    c, r = c[order], r[order]
    for lo in range(0, int(dense.sum()), BLOCK):
        i, j = np.searchsorted(c, (lo, lo + BLOCK))
        m = np.zeros((k, BLOCK), np.float32)
        m[r[i:j], c[i:j] - lo] = 1
        out += (m @ m.T).astype(np.int32)
    here = (df[col] > 1) & ~here
    c, r = col[here], row[here]
    order = np.argsort(c, kind="stable")
    c, r = c[order], r[order]
    start = np.searchsorted(c, c)
    size, flat = df[c], out.reshape(-1)
    cut = np.concatenate(([0], np.cumsum(size)))
    lo = 0
    while lo < len(c):  # some two million pairs at a time
        hi = max(int(np.searchsorted(cut, cut[lo] + (1 << 21), "right")) - 1, lo + 1)
        first = np.repeat(r[lo:hi], size[lo:hi])
        other = r[np.repeat(start[lo:hi] - cut[lo:hi] + cut[lo], size[lo:hi]) + np.arange(len(first))]
        np.add.at(flat, first * k + other, 1)
        lo = hi
    return out


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges (from, to) of a spanning forest of a symmetric matrix of links."""
    out, free = [], np.ones(len(linked), bool)
    for i in np.flatnonzero(linked.any(0)).tolist():
        if not free[i]:
            continue
        free[i], front = False, [i]
        while front:
            j = front.pop()
            new = np.flatnonzero(linked[j] & free).tolist()
            free[new] = False
            out += [(j, x) for x in new]
            front += new
    return out


def _candidates(n: np.ndarray, prefixes: list[list[np.ndarray]], apart: np.ndarray, pct: int) -> np.ndarray:
    """The symmetric matrix of pairs of interest whose sizes allow a link and that share a token in each list of prefixes."""
    ok = apart & (np.minimum.outer(n, n) * 100 >= np.maximum.outer(n, n) * pct)
    np.fill_diagonal(ok, False)
    for under in prefixes:
        kept = np.flatnonzero(ok.any(0))
        if len(kept) > FEW:
            ok[np.ix_(kept, kept)] &= _overlaps([under[i] for i in kept]) > 0
        else:
            for x, i in enumerate(kept):
                for j in kept[:x]:
                    if ok[i, j] and not len(np.intersect1d(under[i], under[j])):
                        ok[i, j] = ok[j, i] = False
    return ok


def _links(sets: list[np.ndarray], apart: np.ndarray, pct: int) -> list[tuple[int, int]]:
    """Links of a part that span its components.  apart: the pairs that are of interest, symmetric."""
    n = np.array([len(s) for s in sets], np.int64)
    ok = _candidates(n, [[_first(s, pct, k) for s in sets] for k in ORDERS], apart, pct)
    kept = np.flatnonzero(ok.any(0))
    if not len(kept):
        return []
    if int(ok.sum()) > FEW * len(kept):
        common = _overlaps([sets[i] for i in kept])
        ok[np.ix_(kept, kept)] &= 100 * common >= pct * (n[kept][:, None] + n[kept] - common)
    else:
        for i, j in np.argwhere(np.triu(ok)):
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            ok[i, j] = ok[j, i] = 100 * common >= pct * (n[i] + n[j] - common)
    return _forest(ok)


def _tiles(batches: Iterator[pa.RecordBatch], values) -> Iterator[tuple[tuple, list[tuple], np.ndarray]]:
    """(key, rows, apart) of the runs of equal keys (pfp, pn, x, y): the part or the two parts x < y of a group.  A row
    is (a, part, c, value), c the component known so far; a repeated id is one document.  apart: the pairs of different
    components and, of two parts, across them."""

    def tile(key: tuple, held: dict) -> tuple:
        rows = list(held.values())
        part, c = (np.array([r[k] for r in rows], np.int64) for k in (1, 2))
        apart = c[:, None] != c
        return key, rows, apart & (part[:, None] != part) if key[2] != key[3] else apart

    now, held = None, {}
    for batch in batches:
        *key, ids, parts, known = (v.to_pylist() for v in columns(batch, "pfp", "pn", "x", "y", "a", "part", "c"))
        for key, a, part, c, v in zip(zip(*key), ids, parts, known, values(batch)):
            if key != now:
                if len(held) > 1:
                    yield tile(now, held)
                now, held = key, {}
            held[a] = (a, part, c, v)
    if len(held) > 1:
        yield tile(now, held)


def _sift(pct: int, apart_: bool):
    """The rows (pfp, pn, x, y, a, part, c) that have a candidate in their tile, by the orders B and C.  A few sets go under
    their least id (pn -1), so that what several groups share is sent once; apart_: under all their ids (pn below -1)."""

    def values(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        for n, sign in zip(*(v.to_pylist() for v in columns(batch, "n", "signature"))):
            yield n, np.frombuffer(sign, np.uint32).reshape(len(ORDERS), -1)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = zip(*rows) if rows else ((),) * len(_TILE)
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, _TILE.types)], schema=_TILE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for key, rows, apart in _tiles(batches, values):
            n = np.array([r[3][0] for r in rows], np.int64)
            ok = _candidates(n, [[r[3][1][k] for r in rows] for k in range(len(ORDERS))], apart, pct)
            kept = [rows[i] for i in np.flatnonzero(ok.any(0))]
            if key[2] == key[3] and 0 < len(kept) <= FEW:
                ids = np.sort(np.array([r[0] for r in kept], np.int64))
                name = -2 - int(X.gram_hashes(ids.view(U64), len(ids), seed=13)[0] >> U64(2)) if apart_ else -1
                out += [(int(ids[0]), name, 0, 0, a, 0, c) for a, _, c, _ in kept]
            else:
                out += [(*key, *r[:3]) for r in kept]
            if len(out) > MOST_SETS:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    return run


_TILE = pa.schema([("pfp", pa.int64()), ("pn", pa.int64()), ("x", pa.int32()), ("y", pa.int32()), ("a", pa.int64()), ("part", pa.int32()), ("c", pa.int64())])


def _search(size: int, pct: int):
    """The links (a, b) of the sets of each tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for _, rows, apart in _tiles(batches, lambda b: shingle_sets(columns(b, "text")[0], size)):
            out += [(rows[i][0], rows[j][0]) for i, j in _links([r[3] for r in rows], apart, pct)]
            if len(out) > MOST_SETS:
                yield _pairs(out)
                out = []
        yield _pairs(out)

    return run


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def jaccard_components(docs: DataFrame, spark: SparkSession, *, pct: int = 90, size: int = 3, id_col: str = "doc_id", text_col: str = "text", most_classes: int = MOST_CLASSES) -> DataFrame:
    """(doc_id, n_shingles, component_id): links join texts whose shingle sets have 100*|A and B| >= pct*|A or B|;
    component_id is the smallest doc_id that links reach."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    buckets = buckets_of(text_bytes(docs))
    logs, level = _token_order(docs, size, ORDER_CELLS), _level(most_classes)
    order = spark.sparkContext.broadcast(logs)

    scratch = Scratch(spark)
    stored = scratch.stored
    described = stored(docs.mapInArrow(_describe(size, pct), "doc_id long, n long, fp long, signature binary"))
    classes = stored(described.where("n > 0").groupBy("n", "fp").agg(F.min("doc_id").alias("id")), ids=True)
    members = docs.select("text").mapInArrow(_emit(size, pct, order, level, buckets), "bucket int, token binary, fp binary, n binary, place binary")
    members = members.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_buckets(pct), "fp long, n long, pfp long, pn long")
    if logs.max() > level:
        members = members.union(_hot_groups(docs, size, pct, order, level))
    members = stored(members.distinct())

    groups = members.groupBy("pfp", "pn").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("tokens")).where("k > 1")
    parts = F.ceil(F.greatest(F.col("k") / MOST_SETS, F.col("tokens") / MOST_TOKENS)).cast("int")
    groups = stored(groups.select("pfp", "pn", parts.alias("parts")), ids=True)  # so that the join can split a large group
    rows = members.join(groups, ["pfp", "pn"]).join(classes.withColumnRenamed("id", "a"), ["fp", "n"])
    rows = stored(rows.select("a", "n", "pfp", "pn", "parts", F.pmod(F.xxhash64("fp", F.lit(5)), "parts").cast("int").alias("part")), ids=True)

    def search(named: DataFrame) -> DataFrame:
        """Links (a, b) of rows (a, n, pfp, pn, x, y, part, c).  The orders B and C sift by signature first, so that texts
        go to the tiles of candidates only.  Neither side has a proven bound: both joins shuffle."""
        key = ["pfp", "pn", "x", "y"]
        signed = named.hint("merge").join(described.select(F.col("doc_id").alias("a"), "signature"), "a").select(*_TILE.names, "n", "signature")
        kinds = "pfp long, pn long, x int, y int, a long, part int, c long"
        dealt = signed.repartition(*key).sortWithinPartitions(*key)
        sifted = stored(dealt.mapInArrow(_sift(pct, False), kinds).distinct())
        # An id that is the least of very many small groups has them apart, so that no tile grows with their number.
        large = stored(sifted.where("pn = -1").groupBy("pfp", "pn").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > MOST_SETS), ids=True)
        if not large.isEmpty():
            again = dealt.mapInArrow(_sift(pct, True), kinds).where("pn < -1").join(large.select("pfp"), "pfp", "left_semi").distinct()
            sifted = stored(sifted.join(large, ["pfp", "pn"], "left_anti").select(*_TILE.names).union(again.select(*_TILE.names)))
        full = sifted.hint("merge").join(docs.select(F.col("doc_id").alias("a"), "text"), "a").select(*_TILE.names, "text")
        return stored(full.repartition(*key).sortWithinPartitions(*key).mapInArrow(_search(size, pct), "a long, b long"))

    links = search(rows.withColumn("x", F.col("part")).withColumn("y", F.col("part")).withColumn("c", F.col("a")))
    component = connected_components(links, spark)
    split = rows.where("parts > 1").join(component.withColumnRenamed("node", "a"), "a", "left").withColumn("c", F.coalesce("component", "a"))
    mixed = split.groupBy("pfp", "pn").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("pfp", "pn")
    split = stored(split.join(mixed, ["pfp", "pn"]).drop("component"), ids=True)
    if not split.isEmpty():
        other = split.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("o <> part")
        links = links.union(search(other.withColumn("x", F.least("o", "part")).withColumn("y", F.greatest("o", "part"))))
        component = connected_components(links, spark)

    scratch.close(described, classes)
    named = classes.join(component.select(F.col("node").alias("id"), "component"), "id", "left").select("n", "fp", F.coalesce("component", "id").alias("component_id"))
    return described.join(named, ["n", "fp"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, spark: SparkSession, *, pct: int = 80, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the near copies: of each component the smallest id stays, with all its columns.  An id's rows go if a
    component with a smaller id holds one of them; rows of a null id stay."""
    found = jaccard_components(docs, spark, pct=pct, size=size, id_col=id_col, text_col=text_col)
    dropped = found.where("component_id <> doc_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(dropped, id_col, "left_anti")
