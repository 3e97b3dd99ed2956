"""Operator 4: toxicity by noisy-channel restoration of disguised words.

A character language model (four letters at a time, with word borders) is counted over all documents.  Words that look
disguised - letters mixed with look-alike signs, letters drawn out three times or more, letters set apart by blanks -
become lattices in which each sign may stand for a letter, be dropped, or draw out the letter before it; Viterbi's
algorithm finds the likeliest letters (by bigrams within a word).  In a run of single letters each blank may be dropped
or be a word border; each word found is a feature, and so is the run as one word.  Two words
of which the model says that the blank between them was put into a word are a feature as one, too.  A linear model on the
distinct restored words scores each document.  Letters beyond a to z are one class to the model, and themselves in features.

Labels of rows whose crc32(doc_id as text) mod 4 is 2 are held out; labels, lang, source and id are no features.  The
fit uses at most ``most_rows`` labelled rows and ``most_bytes`` of their features, and leaves out features that fewer
than ``least`` of them have; language model and scores cover all rows and whole texts.  Each document is counted by
itself, so the language model does not depend on how the input is split.

Edge cases: null and empty texts have no words and get the score of the bias; without labels every score is 0.5;
null labels are ignored; rows that repeat an id are scored each; a null id is never held out, and ``drop_toxic`` judges
each row of a null id, and of an id that repeats, by its own text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import _linear as L
from skyledger.llm import _text as X
from skyledger.llm._spark import columns, crc_mod

MOST_ROWS = 12_000
TOGETHER, CELLS = 2048, 1 << 18  # words, and signs about, whose lattices are held at once
LEAST = 3  # rows of the fit that a feature must be met in
A = 28  # border, a-z, all bytes of other scripts

# Signs and the letters that they imitate.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "gq",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "#": "h", "&": "a", "%": "x", "*": "aeiou",
}
SWAP, DROP, DROP_DIGIT, DRAWN = -1.5, -3.0, -14.0, -3.0  # log costs of the channel
SPLIT, JOIN, CUT = -1.6, -0.2, -3.0  # of a blank between single letters as a border or as none, and of one put into a word


def _letters() -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[97:123] = out[65:91] = np.arange(1, 27)
    out[128:] = 27
    return out


LETTER = _letters()
SIGN = np.zeros(256, bool)
SIGN[[ord(c) for c in LOOK_ALIKES]] = True
ALONE = (LETTER > 0) & (np.arange(256) < 128) | SIGN


def _channel() -> tuple[np.ndarray, np.ndarray]:
    """Log cost of a sign for a letter, and of dropping it."""
    emit, drop = np.full((256, A), -1e9, np.float32), np.full(256, -1e9, np.float32)
    for b in range(256):
        if LETTER[b]:
            emit[b, LETTER[b]] = 0
        else:
            drop[b] = 0 if chr(b) not in LOOK_ALIKES else DROP_DIGIT if 48 <= b < 58 else DROP
    for sign, letters in LOOK_ALIKES.items():
        emit[ord(sign), [ord(c) - 96 for c in letters]] = SWAP - np.log(len(letters))
    return emit, drop


EMIT, DROPPED = _channel()
_WAYS = [[(int(c), float(EMIT[b, c])) for c in np.flatnonzero(EMIT[b] > -1e8)] for b in range(256)]


BEFORE = 4  # borders before each row: one that ends the row before, and three that no letters cross


def _stream(part: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters with one border after each word and BEFORE more before each row and at the end; the place of each byte's
    letter or border."""
    c = np.zeros(len(part) + BEFORE * len(rows), np.int64)
    place = np.arange(len(part)) + BEFORE * (X.row_of(rows) + 1)
    c[place] = LETTER[part]
    keep = np.ones(len(c), bool)
    keep[place] = (c[place] > 0) | (c[place - 1] > 0)
    return c[keep], (np.cumsum(keep) - 1)[place]


def letter_counts(docs: DataFrame) -> np.ndarray:
    """Counts of four letters or borders in a row, over all documents, each by itself (before its first letter: borders)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(A**4, np.int64)
        for batch in batches:
            data, at = X.view(columns(batch, "text")[0])
            for a, b in X.slices(at):
                c, _ = _stream(data[at[a] : at[b]], at[a : b + 1] - at[a])
                e = np.flatnonzero((c[1:] > 0) | (c[:-1] > 0)) + 1  # letters, and the borders that follow them
                total += np.bincount(((c[e - 3] * A + c[e - 2]) * A + c[e - 1]) * A + c[e], minlength=A**4)
        gram = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(gram.astype(np.int32)), pa.array(total[gram])], ["gram", "n"])

    got = docs.select("text").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()  # A**4 rows at most
    out = np.zeros(A**4, np.int64)
    out[got["gram"].to_numpy()] = got["n"].to_numpy()
    return out.reshape(A, A, A, A)


def language_model(counts: np.ndarray) -> np.ndarray:
    p = counts + 0.5
    return np.log(p / p.sum(1, keepdims=True)).astype(np.float32)


def long_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a letter after three, each order mixed with the one below."""
    p = np.full(A, 1 / A)
    for k in (3, 2, 1, 0):
        c = counts.sum(tuple(range(k)))
        p = (c + 4 * p) / (c.sum(-1, keepdims=True) + 4)
    return np.log(p).astype(np.float32)


def split(run: bytes, lm: memoryview) -> list[bytes]:
    """The likeliest words behind signs set apart by blanks, of which each may be a border; lm: the flat long model."""
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}  # by the last three letters; the letters so far, last first
    for o in run:
        then: dict[int, tuple[float, tuple | None]] = {}
        ways = [(0, SPLIT)] if o == 32 else _WAYS[o]
        stay = JOIN if o == 32 else float(DROPPED[o])
        for ctx, (score, chain) in states.items():
            last = ctx % A
            for c, cost in ways:
                new, key = score + lm[ctx * A + c] + cost, ctx * A % A**3 + c
                if key not in then or new > then[key][0]:
                    then[key] = (new, (c, chain))
            same = max(stay, float(EMIT[o, last]) + DRAWN) if last else stay
            if same > -1e8 and (ctx not in then or score + same > then[ctx][0]):
                then[ctx] = (score + same, chain)
        states = then
    chain = max(((score + lm[ctx * A], chain) for ctx, (score, chain) in states.items()), key=lambda x: x[0])[1]
    letters = bytearray()
    while chain is not None:
        c, chain = chain
        letters.append(96 + c if c else 32)
    return bytes(reversed(letters)).split()


def _cut_words(c: np.ndarray, lm: np.ndarray) -> np.ndarray:
    """Whether each border of a stream is likelier to have been put into a word than to part two."""
    out = np.zeros(len(c), bool)
    at = np.flatnonzero(c[3:-3] == 0) + 3
    a, b, d, e, f, g = (c[at + k] for k in (-3, -2, -1, 1, 2, 3))
    one = lm[a, b, d, e] + lm[b, d, e, f] + lm[d, e, f, g]
    two = lm[a, b, d, 0] + lm[b, d, 0, e] + lm[d, 0, e, f] + lm[0, e, f, g]
    out[at] = (one + CUT > two) & (d > 0) & (e > 0)
    return out


def _restored(words: list[bytes], lm: np.ndarray) -> list[list[tuple[int, int]]]:
    """The likeliest letters behind each word, each with the place of its sign, last first: Viterbi's algorithm, column by
    column for some words of like length at a time."""
    out: list[list[tuple[int, int]]] = [[] for _ in words]
    order = sorted((i for i, w in enumerate(words) if w), key=lambda i: -len(words[i]))
    lo = 0
    while lo < len(order):
        some = order[lo : lo + min(TOGETHER, max(CELLS // len(words[order[lo]]), 1))]
        lo += len(some)
        n = np.array([len(words[i]) for i in some])
        grid = np.zeros((len(some), int(n[0])), np.uint8)
        for r, i in enumerate(some):
            grid[r, : n[r]] = np.frombuffer(words[i], np.uint8)
        score = np.full((len(some), A), -1e9, np.float32)
        score[:, 0] = 0
        back = np.zeros((int(n[0]), len(some), A), np.int8)  # the letter before; -1: the same letter, nothing new
        for j in range(int(n[0])):
            k = int(np.searchsorted(-n, -j, "left"))
            s, o = score[:k], grid[:k, j]
            best = (s[:, :, None] + lm[None]).argmax(1)
            new = np.take_along_axis(s, best, 1) + lm[best, np.arange(A)] + EMIT[o]
            # A letter that the sign may stand for can be drawn out; a sign can be dropped.
            stay = s + np.maximum(DROPPED[o][:, None], np.where((EMIT[o] > -1e8) & (o < 128)[:, None], EMIT[o] + DRAWN, -1e9))
            same = stay > new
            back[j, :k] = np.where(same, -1, best)
            score[:k] = np.where(same, stay, new)
        at = (score + lm[:, 0]).argmax(1)
        for j in range(int(n[0]) - 1, -1, -1):
            k = int(np.searchsorted(-n, -j, "left"))
            b = back[j, np.arange(k), at[:k]]
            for r in np.flatnonzero(b >= 0).tolist():
                out[some[r]].append((j, int(at[r])))
                at[r] = b[r]
    return out


def restore(words: list[bytes], lm: np.ndarray) -> list[bytes]:
    """The likeliest letters behind each word, of any length (bytes of other scripts stay as they are)."""
    return [bytes(96 + c if c < 27 else w[j] for j, c in reversed(letters) if c) for w, letters in zip(words, _restored(words, lm))]


def _hash_letters(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the letters of each word, signs around and between them left out of account."""
    c = LETTER[part]
    sums, down = X.prefix_sums(np.where(c > 0, X.byte_codes(40)[np.where(c < 27, c, part)], X.U64(0)), X.P_BYTE)
    place = np.flatnonzero(c > 0)
    first = np.searchsorted(place, starts)
    at = place[np.minimum(first, max(len(place) - 1, 0))] if len(place) else starts
    none = (first >= len(place)) | (at >= ends) if len(place) else np.ones(len(starts), bool)
    return np.where(none, X.U64(0), X.mix((sums[ends] - sums[starts]) * down[np.where(none, starts, at)], 41))


def _joined(part, starts, ends, of) -> list[tuple[int, int]]:
    """Runs [i, j) of three or more words of one sign each, with one blank between, in one row."""
    single = (ends - starts == 1) & ALONE[part[starts]] if len(starts) else np.zeros(0, bool)
    near = np.zeros(len(starts), bool)
    near[1:] = single[1:] & single[:-1] & (starts[1:] - ends[:-1] == 1)
    near[of[:-1][of[:-1] < len(starts)]] = False
    a, b = X.runs(near)
    return [(i - 1, j) for i, j in zip(a.tolist(), b.tolist()) if j - i >= 2]


def _cut(part, rows, starts, ends, row, lm) -> tuple[np.ndarray, np.ndarray]:
    """First and last words of what is likelier one word with blanks put in: each two, and each longer row of them."""
    if len(starts) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c, place = _stream(part, rows)
    near = (row[1:] == row[:-1]) & (starts[1:] - ends[:-1] == 1) & (LETTER[part[ends[:-1] - 1]] > 0) & (LETTER[part[starts[1:]]] > 0)
    near &= _cut_words(c, lm)[place[ends[:-1]]]
    two = np.flatnonzero(near)
    a, b = X.runs(near)
    more = b - a > 1
    return np.concatenate((two, a[more])), np.concatenate((two + 1, b[more]))


def word_features(lm: np.ndarray, shared):
    """Features of texts by the bigrams and a broadcast long model."""

    def features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        far, flat = shared.value, memoryview(shared.value.ravel())
        data, at = X.view(pc.utf8_lower(texts))
        for a, b in X.slices(at):
            part, rows = data[at[a] : at[b]], at[a : b + 1] - at[a]
            starts, ends, of = X.words(part, rows, X.SPACED)
            h = _hash_letters(part, starts, ends)
            low = X.lower_ascii(part)
            letters, signs = (np.concatenate(([0], np.cumsum(m))) for m in (LETTER[part] > 0, SIGN[part]))
            drawn = np.zeros(len(part), bool)
            if len(part) > 2:
                drawn[2:] = (LETTER[part[2:]] > 0) & (low[2:] == low[1:-1]) & (low[2:] == low[:-2]) & (part[2:] < 128)
            draws = np.concatenate(([0], np.cumsum(drawn)))
            n = ends - starts
            odd = (letters[ends] > letters[starts]) & ((signs[ends] > signs[starts]) | (draws[ends] > draws[np.minimum(starts + 2, ends)]))
            which = np.flatnonzero(odd)
            raw = X.word_hashes(low, starts[which], ends[which], 42)
            _, one, back = np.unique(raw, return_index=True, return_inverse=True)
            lowered = low.tobytes()
            words = [lowered[starts[i] : ends[i]] for i in which[one].tolist()]
            runs = _joined(part, starts, ends, of)
            runs_of = [b" ".join(lowered[starts[k] : ends[k]] for k in range(i, j)) for i, j in runs]
            # A run as one word, and as the words that it may hold.
            extra = [(r, w.replace(b" ", b"")) for (r, _), w in zip(runs, runs_of)]
            parted = {w: split(w, flat) for w in set(runs_of)}
            found = [(r, w) for (r, _), run in zip(runs, runs_of) for w in set(parted[run])]
            fixed = restore(words + [w for _, w in extra], lm) + [w for _, w in found]
            flat_letters = np.frombuffer(b"".join(fixed), np.uint8)
            cut = np.concatenate(([0], np.cumsum([len(w) for w in fixed]))).astype(np.int64)
            hashes = _hash_letters(flat_letters, cut[:-1], cut[1:]) if len(flat_letters) else np.zeros(len(fixed), np.uint64)
            h = h.copy()
            h[which] = hashes[: len(one)][back] if len(which) else h[which]
            row_of = X.row_of(of)
            i, j = _cut(part, rows, starts, ends, row_of, far)
            joined = _hash_letters(part[LETTER[part] > 0], letters[starts[i]], letters[ends[j]])
            row = np.concatenate((row_of, row_of[np.array([r for r, _ in extra + found], np.int64)], row_of[i])).astype(np.int64)
            h = np.concatenate((h, hashes[len(one) :], joined))
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            keep = h != 0
            keep[1:] &= (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            row, h = row[keep], h[keep]
            yield a, h, np.searchsorted(row, np.arange(b - a + 1))

    return features


def toxicity_scores(docs: DataFrame, labels: DataFrame, spark: SparkSession, *, id_col: str = "doc_id", text_col: str = "text", most_rows: int = MOST_ROWS, least: int = LEAST) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs."""
    docs, model, features = _fitted(docs, labels, spark, id_col, text_col, most_rows, least)
    return L.verdicts(L.score(docs, model, features, spark), 4, 2)


def _fitted(docs: DataFrame, labels: DataFrame, spark: SparkSession, id_col: str, text_col: str, most_rows: int, least: int):
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = letter_counts(docs)
    features = word_features(language_model(counts.sum((0, 1))), spark.sparkContext.broadcast(long_model(counts)))
    model = L.train(docs, labels, "toxic", crc_mod(F.col("doc_id"), 4) == 2, features, spark, most_rows=most_rows, least=least)
    return docs, model, features


def drop_toxic(
    docs: DataFrame, labels: DataFrame, spark: SparkSession, *, id_col: str = "doc_id", text_col: str = "text", most_rows: int = MOST_ROWS, least: int = LEAST, threshold: float = 0.3
) -> DataFrame:
    """docs without the rows whose text is predicted toxic.  No shuffle of the documents."""
    _, model, features = _fitted(docs, labels, spark, id_col, text_col, most_rows, least)
    return L.keep_below(docs, model, features, spark, text_col, threshold)
