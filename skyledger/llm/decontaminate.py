"""Operator 3: benchmark decontamination by suffix arrays over the training words.

Each slice of documents gets a suffix array of its words (ranks of 1, 2, 4, 8, ... words by doubling; suffixes end with
their document).  Each different window of the benchmark is searched in it by bisection, once however many items have it;
all places that share the window are hit, and extended to the longest verbatim match by bisection among the items' suffixes
that begin with the window.  A document has each place once a window length, and names of items as sets: neither equal
items nor a passage that repeats within a text are multiplied with one another.
``longest_matches`` searches the other suffixes, too, and lists the longest match of each.  Documents are not shuffled.
The benchmark goes out in blocks of a checked size: one broadcast as a rule, and one pass for each block where it is larger.

Edge cases: null and empty texts have no words, hit nothing and are clean; items without words never occur; an item of
fewer words than the window is one window; items with equal texts count each; an item with a null id hits words, but has
no name to be listed or counted; repeated rows, and rows of a null id, are judged each by their own text; an empty
benchmark or table gives clean rows or none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import _text as X
from skyledger.llm._spark import columns, stored

U64 = X.U64
BLOCK_BYTES = 32 << 20  # of benchmark text in one broadcast


class SuffixArray:
    """Words of several rows, their suffixes in order of the words' hashes to ``depth`` words at least."""

    def __init__(self, words: np.ndarray, rows: np.ndarray, depth: int):
        self.words, self.rows, self.n = words, rows, len(words)
        self.end = np.repeat(rows[1:], np.diff(rows))  # where each word's row ends
        self.ranks: dict[int, np.ndarray] = {1: np.unique(words, return_inverse=True)[1].astype(np.int64) + 1}
        h = 1
        while h < depth:
            r = self.ranks[h]
            then = np.zeros(self.n, np.int64)
            inside = np.flatnonzero(np.arange(self.n) + h < self.end)
            then[inside] = r[inside + h]
            h *= 2
            self.ranks[h] = np.unique((r << 32) | then, return_inverse=True)[1].astype(np.int64) + 1
        self.depth = h
        self.order = np.argsort(self.ranks[h], kind="stable")

    def _less(self, at: np.ndarray, query: np.ndarray, q: np.ndarray, q_end: np.ndarray) -> np.ndarray:
        """Whether the suffixes at ``at`` come before the query suffixes q..q_end, by depth words."""
        out = np.zeros(len(at), bool)
        open_ = np.arange(len(at))
        for k in range(self.depth):
            a, b = at[open_] + k, q[open_] + k
            a_in, b_in = a < self.end[at[open_]], b < q_end[open_]
            x = self.words[np.where(a_in, a, 0)]
            y = query[np.where(b_in, b, 0)]
            less = (~a_in & b_in) | (a_in & b_in & (x < y))
            out[open_[less]] = True
            open_ = open_[a_in & b_in & (x == y)]
            if not len(open_):
                break
        return out

    def search(self, query: np.ndarray, q: np.ndarray, q_end: np.ndarray) -> np.ndarray:
        """For each query suffix, the place in the order of the first suffix that does not come before it."""
        lo, hi = np.zeros(len(q), np.int64), np.full(len(q), self.n, np.int64)
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._less(self.order[mid], query, q[open_], q_end[open_])
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        return lo

    def common(self, place: np.ndarray, query: np.ndarray, q: np.ndarray, q_end: np.ndarray, most: int) -> np.ndarray:
        """Words that the suffixes at places of the order share with the queries; 0 where there is no such place."""
        out = np.zeros(len(q), np.int64)
        open_ = np.flatnonzero((place >= 0) & (place < self.n))
        at = self.order[place[open_]]
        for k in range(most):
            ok = (at + k < self.end[at]) & (q[open_] + k < q_end[open_])
            open_, at = open_[ok], at[ok]
            same = self.words[at + k] == query[q[open_] + k]
            open_, at = open_[same], at[same]
            if not len(open_):
                break
            out[open_] = k + 1
        return out

    def equal_runs(self, m: int) -> np.ndarray:
        """For each place of the order, the run of suffixes that share its first m words (m <= depth)."""
        h = 1 << (m.bit_length() - 1)
        head = self.ranks[h][self.order]
        tail = np.where(self.order + m <= self.end[self.order], self.ranks[h][np.minimum(self.order + m - h, self.n - 1)], -1 - self.order)
        return np.concatenate(([0], np.cumsum((head[1:] != head[:-1]) | (tail[1:] != tail[:-1]))))


class Items:
    """A block of benchmark items as word hashes."""

    def __init__(self, rows: list[tuple]):
        data, at = X.view(pa.array([r[1] or "" for r in rows], pa.large_string()))
        data = X.lower_ascii(data)
        starts, ends, self.rows = X.words(data, at, X.ALNUM)
        self.words = X.word_hashes(data, starts, ends, 3)
        self.ids = [None if r[0] is None else str(r[0]) for r in rows]
        self.item = X.row_of(self.rows).astype(np.int32)  # of each word
        self.end = np.repeat(self.rows[1:], np.diff(self.rows)).astype(np.int32)


class Windows:
    """The different windows of a block of items: where one of each begins, its words, its range among the different
    suffixes of the items in order (empty if it is a whole item), and the set of names of items that have it."""

    def __init__(self, items: Items, window: int):
        self.words, self.end = items.words, items.end
        size = np.diff(items.rows)
        need = np.repeat(np.minimum(size, window), size)
        starts = np.flatnonzero(np.arange(len(need)) + need <= items.end)
        rank = _full_ranks(items.words, items.end)
        self.suffixes = np.unique(rank, return_index=True)[1].astype(np.int32)  # of equal ones the first
        run = self._runs(window)
        whole = need[starts] < window
        name = np.where(whole, len(self.suffixes) + rank[starts], run[rank[starts]])
        kinds, first, kind = np.unique(name, return_index=True, return_inverse=True)
        self.starts, self.need = starts[first].astype(np.int32), need[starts[first]].astype(np.int32)
        self.lo, self.hi = (np.searchsorted(run, kinds, side).astype(np.int32) for side in ("left", "right"))
        self.names, number = np.unique(np.array([x or "" for x in items.ids], object), return_inverse=True) if items.ids else (np.zeros(0, object), np.zeros(0, np.int64))
        named = np.array([x is not None for x in items.ids], bool)[items.item[starts]]
        pairs = np.unique((kind[named].astype(np.int64) << 32) | number[items.item[starts[named]]])
        cut = np.searchsorted(pairs >> 32, np.arange(len(kinds) + 1))
        lists = (pairs & 0xFFFFFFFF).astype(np.int32)
        sets: dict[bytes, int] = {}
        self.set = np.array([sets.setdefault(lists[i:j].tobytes(), len(sets)) for i, j in zip(cut.tolist(), cut[1:].tolist())], np.int32)
        self.sets = [np.frombuffer(x, np.int32) for x in sets]

    def _runs(self, window: int) -> np.ndarray:
        """Of the different suffixes in order, a number for those that share their first ``window`` words."""
        s = self.suffixes.astype(np.int64)
        same = self.end[s] - s >= window
        same[1:] &= same[:-1]
        same[:1] = False
        for k in range(window):
            i = np.flatnonzero(same)
            same[i] = self.words[s[i] + k] == self.words[s[i - 1] + k]
        return np.cumsum(~same) - 1


def _full_ranks(words: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The rank of each suffix, from 0, equal ones the same: by doubling, until longer prefixes tell no more apart."""
    rank, h = np.unique(words, return_inverse=True)[1].astype(np.int64), 1
    while len(words):
        then = np.zeros(len(words), np.int64)
        inside = np.flatnonzero(np.arange(len(words)) + h < end)
        then[inside] = rank[inside + h] + 1
        finer = np.unique((rank << 32) | then, return_inverse=True)[1].astype(np.int64)
        if finer.max() == rank.max():
            break
        rank, h = finer, 2 * h
    return rank


def _slices(texts: pa.Array, depth: int):
    data, at = X.view(texts)
    for a, b in X.slices(at):
        part = X.lower_ascii(data[at[a] : at[b]])
        starts, ends, rows = X.words(part, at[a : b + 1] - at[a], X.ALNUM)
        yield a, b, SuffixArray(X.word_hashes(part, starts, ends, 3), rows, depth) if len(starts) else None, rows


def _occurrences(sa: SuffixArray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(word place, index of the window) of all occurrences of the different windows: at most one of each length a place."""
    q, need = windows.starts.astype(np.int64), windows.need.astype(np.int64)
    if not len(q):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = sa.search(windows.words, q, q + need)
    found = np.flatnonzero(sa.common(place, windows.words, q, q + need, int(need.max())) >= need)
    at, which = [], []
    for m in np.unique(need[found]).tolist():
        some = found[need[found] == m]
        run = sa.equal_runs(m)
        cut = np.searchsorted(run, np.arange(run[-1] + 2))
        r = run[place[some]]
        size = cut[r + 1] - cut[r]
        index = np.repeat(cut[r] - np.concatenate(([0], np.cumsum(size)))[:-1], size) + np.arange(size.sum())
        at.append(sa.order[index])
        which.append(np.repeat(some, size))
    return (np.concatenate(at), np.concatenate(which)) if at else (np.zeros(0, np.int64),) * 2


def _extend(sa: SuffixArray, windows: Windows, at: np.ndarray, q: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Words that the document suffixes at ``at`` share with the item suffixes q, of which n are known to agree."""
    n = n.copy()
    open_ = np.arange(len(at))
    while len(open_):
        x, y = at[open_] + n[open_], q[open_] + n[open_]
        ok = (x < sa.end[at[open_]]) & (y < windows.end[q[open_]])
        open_ = open_[ok][sa.words[x[ok]] == windows.words[y[ok]]]
        n[open_] += 1
    return n


def _longest_at(sa: SuffixArray, windows: Windows, at: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Words of the longest match of each occurrence: its suffix is searched among those of the items that begin with the
    window, and the suffixes that bisection looks at have the nearest two among them."""
    lo, hi = windows.lo[which].astype(np.int64), windows.hi[which].astype(np.int64)
    known = windows.need[which].astype(np.int64)
    best = known.copy()
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) >> 1
        p, q = at[open_], windows.suffixes[mid].astype(np.int64)
        n = _extend(sa, windows, p, q, known[open_])
        best[open_] = np.maximum(best[open_], n)
        more, left = p + n < sa.end[p], q + n < windows.end[q]
        less = more & (~left | (windows.words[np.where(left, q + n, 0)] < sa.words[np.where(more, p + n, 0)]))
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]
    return best


def _depth(window: int) -> int:
    return 1 << (window - 1).bit_length()


STATE = ("hit_bits", "hit_items", "hit_longest", "hit_at")  # of a document, from one block to the next
STATE_TYPES = (pa.binary(), pa.list_(pa.string()), pa.int64(), pa.int64())
VERDICT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest", "longest_at")
VERDICT_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64())


def _states(windows: Windows, window: int, texts: pa.Array, before: list[tuple]) -> list[tuple]:
    """For each text (words, hit words as flags, names of items, length and place of the longest match), with what is
    known before."""
    out = []
    for a, b, sa, rows in _slices(texts, _depth(window)):
        gone = np.zeros(int(rows[-1]), bool)
        met: dict[int, list[np.ndarray]] = {}
        best: dict[int, tuple[int, int]] = {}
        if sa is not None:
            at, which = _occurrences(sa, windows)
            if len(at):
                n = _longest_at(sa, windows, at, which)
                d = np.zeros(sa.n + 1, np.int64)
                np.add.at(d, at, 1)
                np.add.at(d, at + windows.need[which], -1)
                gone = np.cumsum(d[:-1]) > 0
                row = np.searchsorted(rows, at, "right") - 1
                seen = np.unique((row << 32) | windows.set[which])
                for r, k in zip((seen >> 32).tolist(), (seen & 0xFFFFFFFF).tolist()):
                    met.setdefault(r, []).append(windows.sets[k])
                order = np.lexsort((at, -n, row))
                r, first = np.unique(row[order], return_index=True)
                first = order[first]
                best = {i: (k, p) for i, k, p in zip(r.tolist(), n[first].tolist(), (at[first] - rows[row[first]]).tolist())}
        for r in range(b - a):
            mine = gone[rows[r] : rows[r + 1]]
            bits, names, longest, place = before[a + r]
            if bits:
                mine = mine | np.unpackbits(np.frombuffer(bits, np.uint8), count=len(mine)).astype(bool)
            known = (longest or 0, place)
            now = best.get(r, (0, None))
            better = max((known, now), key=lambda x: (x[0], -(x[1] or 0)))
            out.append((len(mine), mine, sorted({*(names or ()), *(windows.names[np.unique(np.concatenate(met[r]))] if r in met else ())}), *better))
    return out


def _judge(block, window: int, percent: int, text: str, state: list[str], last: str | None):
    """Adds a block's hits to what is known of each row, in the columns ``state``.  last: None carries it on, "verdict" gives the verdict's
    columns after the id, "filter" keeps the rows that are clean."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: Windows = block.value
        for batch in batches:
            before = list(zip(*(c.to_pylist() for c in columns(batch, *state))))
            found = _states(windows, window, columns(batch, text)[0].cast(pa.string()), before)
            bad = [bool(m.any()) and 100 * int(m.sum()) >= percent * n for n, m, *_ in found]
            own = batch.select([c for c in batch.schema.names if c not in state])
            if last == "filter":
                yield own.filter(pa.array(np.logical_not(np.array(bad, bool))))
                continue
            if last == "verdict":
                rows = [(n, int(m.sum()), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), x, k, p) for (n, m, names, k, p), x in zip(found, bad)]
                own, names_, types = batch.select(["doc_id"]), VERDICT, VERDICT_TYPES
            else:
                rows = [(np.packbits(m).tobytes(), names, k, p) for _, m, names, k, p in found]
                names_, types = state, STATE_TYPES
            cols = list(zip(*rows)) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([*own.columns, *(pa.array(v, t) for v, t in zip(cols, types))], [*own.schema.names, *names_])

    return run


def _blocks(benchmark: DataFrame, block_bytes: int, item_col: str, text_col: str) -> list[DataFrame]:
    """The items in blocks of at most ``block_bytes`` of text, or of one longer item: parts by hash, halved until they fit."""
    b = benchmark.select(F.col(item_col).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.xxhash64(item_col, text_col).alias("h"))
    out, todo = [], [(1, 0)]
    while todo:
        k, i = todo.pop()
        part = b.where(F.pmod("h", F.lit(k)) == i)
        size, kinds = part.agg(F.sum(F.octet_length("text")), F.count_distinct("h")).first()
        if (size or 0) <= block_bytes or kinds < 2:
            if size is not None or not out and not todo:
                out.append(part)
        else:
            todo += [(2 * k, i), (2 * k, i + k)]
    return out


def _items(part: DataFrame) -> Items:
    return Items([tuple(r) for r in part.select("item", "text").collect()])  # of a checked size


def _through_blocks(df: DataFrame, benchmark: DataFrame, spark: SparkSession, text: str, window: int, percent: int, item_col: str, item_text_col: str, block_bytes: int, last: str) -> DataFrame:
    kinds = ("binary", "array<string>", "long", "long")
    own = df.schema
    taken = {c.lower() for c in df.columns}
    mark = next(m for n in range(len(taken) + 1) if not taken & {f"{c}{(m := '_' * n)}" for c in STATE})
    state = [f"{c}{mark}" for c in STATE]  # names that the table does not have
    df = df.withColumns({c: F.lit(None).cast(k) for c, k in zip(state, kinds)})
    blocks = _blocks(benchmark, block_bytes, item_col, item_text_col)
    for i, part in enumerate(blocks):
        block = spark.sparkContext.broadcast(Windows(_items(part), window))
        if i == len(blocks) - 1:
            schema = own if last == "filter" else "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest long, longest_at long"
            return df.mapInArrow(_judge(block, window, percent, text, state, last), schema)
        df = stored(df.mapInArrow(_judge(block, window, percent, text, state, None), df.schema), spark)
        block.unpersist()
    raise AssertionError


def contamination(
    docs: DataFrame, benchmark: DataFrame, spark: SparkSession, *, window: int = 13, percent: int = 5, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest, longest_at) for each row of docs:
    contaminated if words are hit and they are percent of the document's words or more; longest is the words of the longest
    verbatim match (0 if none), longest_at the document's word, from 0, where the first such match begins."""
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _through_blocks(df, benchmark, spark, "text", window, percent, item_col, item_text_col, block_bytes, "verdict")


def _longest(block, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = block.value
        q = np.arange(len(items.words))
        longest = int(np.diff(items.rows).max()) if len(items.words) else 1
        for batch in batches:
            ids, texts = columns(batch, "doc_id", "text")
            ids = ids.to_pylist()
            for a, _, sa, rows in _slices(texts, max(longest, least)):
                if sa is None or not len(q):
                    continue
                place = sa.search(items.words, q, items.end)
                before, after = (sa.common(p, items.words, q, items.end, longest) for p in (place - 1, place))
                best = np.where(before >= after, place - 1, place)
                n = np.maximum(before, after)
                some = np.flatnonzero(n >= least)
                at = sa.order[best[some]]
                row = np.searchsorted(rows, at, "right") - 1
                cols = ([items.ids[i] for i in items.item[some].tolist()], (some - items.rows[items.item[some]]).tolist(), [ids[a + r] for r in row.tolist()], (at - rows[row]).tolist(), n[some].tolist())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, (pa.string(), *[pa.int64()] * 4))], ["item", "item_word", "doc_id", "doc_word", "n_words"])

    return run


def longest_matches(docs: DataFrame, benchmark: DataFrame, spark: SparkSession, *, least: int = 13, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item, item_word, doc_id, doc_word, n_words): for each suffix of each item and each shard of documents the longest
    verbatim match of at least ``least`` words, where it begins in the item and in a document that has it."""

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = []
    for part in _blocks(benchmark, block_bytes, "item_id", "text"):
        block = spark.sparkContext.broadcast(_items(part))
        found.append(docs.mapInArrow(_longest(block, least), "item string, item_word long, doc_id long, doc_word long, n_words long"))
    return reduce(DataFrame.unionAll, found)


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, spark: SparkSession, *, window: int = 13, percent: int = 5, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """docs without the rows whose text the benchmark contaminates.  No shuffle."""
    return _through_blocks(docs, benchmark, spark, text_col, window, percent, item_col, item_text_col, block_bytes, "filter")
