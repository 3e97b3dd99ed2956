"""Operator 8: byte-level BPE by a lazily determinised transducer, and streaming decoding.

The vocabulary's strings form an automaton whose moves are determinised as they are met; a register holds the last token
of each text up to a place that later tokens may still reach.  The last token of a prefix is the one that would not
merge otherwise with the token before it, which makes the sequence the one that rank-by-rank merging gives.  Tokens
leave once every way to the places within reach of the longest token passes through them (short pretokens: at their
end).  The distinct pretokens of a slice run through the tables side by side.

Edge cases: null and empty texts give no ids; any string can be encoded, pretokens of any length included; an empty
table gives an empty result; repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import _text as X
from skyledger.llm._spark import columns

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
SLICE = 2 << 20  # bytes whose distinct pretokens are encoded together
LONG = 48  # bytes from which a pretoken runs by itself


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each code point for the splitting pattern."""
    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\p{White_Space}")):
        out[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return out


def pretokens(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Byte places at which the matches of the splitting pattern start, over all rows.

    The pattern: the contractions 's 't 're 've 'm 'll 'd; letters, numbers, or other signs, each with one blank before;
    white space up to the last before a non-space; white space.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    first = np.zeros(len(cp) + 4, bool)
    first[np.searchsorted(lead, at)] = True  # rows start here; the end counts as one
    first[len(cp) :] = True
    kind = np.concatenate((_classes()[cp], np.full(4, 255, np.uint8)))
    n = len(cp)
    start = first[:n].copy()
    start[1:] |= kind[1:n] != kind[: n - 1]
    # A run that follows white space takes a blank with it; other white space before it stands alone.
    i = np.flatnonzero(start[1:] & (kind[1:n] != SPACE) & (kind[: n - 1] == SPACE) & ~first[1:n]) + 1
    start[i - 1] = True
    start[i] = cp[i - 1] != 32
    i = np.flatnonzero((cp == 39) & start)
    i = i[(kind[i + 1] == LETTER) & ~first[i + 1]]
    if len(i):
        pad = np.concatenate((cp, np.zeros(4, np.uint32)))
        a, b = pad[i + 1], np.where(first[i + 2], 0, pad[i + 2])
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ~one & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        start[i[one | two] + 1] = False
        for some, skip in ((one, 2), (two, 3)):
            j = i[some] + skip
            start[j[(kind[j] == LETTER) & ~first[j]]] = True
    return lead[start]


class Transducer:
    """Bytes of one pretoken to ids.

    A state is the longest end of the bytes read that begins some token; ``move`` holds the moves met so far.
    ``last`` of a place is the final token of the text up to it: of the tokens that end there, longest first, the one
    that stays apart from the last token of the text before it.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.vocab = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self._begins = {b[:k] for b in ranks for k in range(1, len(b) + 1)}
        most = max(self.vocab) + 1
        self.size = np.zeros(most, np.int64)
        for i, b in self.vocab.items():
            self.size[i] = len(b)
        self.shorter = np.full(most, -2, np.int64)  # of a token: the next shorter one that it ends with
        self._grown: dict[int, tuple[list, list]] = {}
        self._key = np.zeros(1 << 20, np.uint64)  # pairs met, by slot
        self._ok = np.zeros(1 << 20, bool)
        self._states: list[bytes] = [b""]
        self._index: dict[bytes, int] = {b"": 0}
        self.move = np.full(1 << 16, -1, np.int32)
        self.ends = np.zeros(1 << 8, np.int64)  # of a state: the longest token that it ends with

    def merge(self, piece: bytes) -> list[int]:
        """Rank-by-rank merging: the definition."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if best[0] == 1 << 60:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _edges(self, t: int) -> tuple[list, list]:
        """How the first and the last part of a token grow while it is merged: (part, rank at which it ends)."""
        if t not in self._grown:
            piece = self.vocab[t]
            parts = [piece[i : i + 1] for i in range(len(piece))]
            heads, tails = [], []
            while len(parts) > 1:
                rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
                if i == 0:
                    heads.append((parts[0], rank))
                if i == len(parts) - 2:
                    tails.append((parts[-1], rank))
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self._grown[t] = [*heads, (piece, 1 << 60)], [*tails, (piece, 1 << 60)]
        return self._grown[t]

    def stays(self, a: int, b: int) -> bool:
        """Whether a next to b is left alone: no two parts that meet at the border merge before one of them grows.
        At equal rank the left place merges first."""
        tails, heads = self._edges(a)[1], self._edges(b)[0]
        i = j = 0
        while True:
            (x, x_end), (y, y_end) = tails[i], heads[j]
            rank = self.ranks.get(x + y, 1 << 60)
            if rank < x_end and rank <= y_end and rank != 1 << 60:
                return False
            if x_end == y_end == 1 << 60:
                return True
            if x_end <= y_end:
                i += 1
            else:
                j += 1

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """stays() of many pairs; what was met before comes from the table."""
        key = (a.astype(np.uint64) << np.uint64(32)) | (b.astype(np.uint64) + np.uint64(1))
        slot = (X.mix(key) & np.uint64(len(self._key) - 1)).astype(np.int64)
        out = self._ok[slot]
        new = np.flatnonzero(self._key[slot] != key)
        if len(new):
            pairs, back = np.unique(key[new], return_inverse=True)
            known = np.array([self.stays(k >> 32, (k & 0xFFFFFFFF) - 1) for k in pairs.tolist()], bool)
            out[new] = known[back]
            at = (X.mix(pairs) & np.uint64(len(self._key) - 1)).astype(np.int64)
            self._key[at], self._ok[at] = pairs, known
            lost = self._key[at] != pairs  # slots that two of the new pairs share keep the last, with its own flag
            self._key[at[lost]] = 0
        return out

    def _token_at_end(self, s: bytes) -> int:
        while s not in self.ranks:
            s = s[1:]
        return self.ranks[s]

    def _next_shorter(self, t: int) -> int:
        if self.shorter[t] == -2:
            self.shorter[t] = self._token_at_end(self.vocab[t][1:])
        return int(self.shorter[t])

    def _step(self, key: int) -> None:
        v = self._states[key >> 8] + bytes((key & 255,))
        while v not in self._begins:
            v = v[1:]
        if v not in self._index:
            k = self._index[v] = len(self._states)
            self._states.append(v)
            if k >= len(self.ends):
                self.move = np.concatenate((self.move, np.full(len(self.move), -1, np.int32)))
                self.ends = np.concatenate((self.ends, np.zeros(len(self.ends), np.int64)))
            self.ends[k] = self._token_at_end(v)
        self.move[key] = self._index[v]

    def encode(self, piece: bytes) -> list[int]:
        """Ids of a piece of any length.  Only the places that the longest token may still span are held; what all
        ways from them share is emitted."""
        ids: list[int] = []
        last: list[int] = []  # of the places held
        before, state = -1, 0  # the token before them
        for n, c in enumerate(piece):
            key = (state << 8) | c
            if self.move[key] < 0:
                self._step(key)
            state = int(self.move[key])
            t = int(self.ends[state])
            while True:
                i = len(last) + 1 - int(self.size[t])
                prev = before if i == 0 else last[i - 1] if i > 0 else None
                if prev is not None and (prev < 0 or self.stays(prev, t)):
                    break
                t = self._next_shorter(t)
            last.append(t)
            if len(last) >= 8 * self.longest and n + 1 < len(piece):
                # Later tokens start at one of the last places: emit what the ways to all of them have in common.
                ways = {len(last) - k for k in range(len(self._states[state]) + 1)}
                while len(ways) > 1:
                    far = max(ways)
                    ways.remove(far)
                    ways.add(far - int(self.size[last[far - 1]]))
                cut = ways.pop()
                if cut > 0:
                    ids += self._trace(last, cut)
                    before, last = last[cut - 1], last[cut:]
        return ids + self._trace(last, len(last))

    def _trace(self, last: list[int], i: int) -> list[int]:
        out = []
        while i > 0:
            out.append(last[i - 1])
            i -= int(self.size[last[i - 1]])
        return out[::-1]

    def encode_all(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and n+1 offsets: the shorter pieces side by side, byte by byte."""
        order = np.argsort(-lengths, kind="stable")
        s, n = starts[order], lengths[order]
        n_long = int(np.searchsorted(-n, -LONG, "right"))
        longs = [self.encode(data[a : a + k].tobytes()) for a, k in zip(s[:n_long].tolist(), n[:n_long].tolist())]
        s, n = s[n_long:], n[n_long:]
        steps = int(n[0]) if len(n) else 0
        last = np.full((steps + 1, len(s)), -1, np.int32)  # row j+1: the last token of the first j+1 bytes
        state = np.zeros(len(s), np.int64)
        for j in range(steps):
            k = int(np.searchsorted(-n, -j, "left"))  # pieces longer than j
            key = (state[:k] << 8) | data[s[:k] + j]
            for x in np.unique(key[self.move[key] < 0]).tolist():
                self._step(x)
            state[:k] = self.move[key]
            some, t = np.arange(k), self.ends[state[:k]]
            while len(some):
                prev = last[j + 1 - self.size[t], some]
                ok = prev < 0
                inner = np.flatnonzero(~ok)
                ok[inner] = self._apart(prev[inner], t[inner])
                last[j + 1, some[ok]] = t[ok]
                some, t = some[~ok], t[~ok]
                for x in np.unique(t[self.shorter[t] == -2]).tolist():
                    self._next_shorter(x)
                t = self.shorter[t]
        # Back from the ends.
        place, some, found = n.copy(), np.arange(len(s)), []
        counts = np.zeros(len(s), np.int64)
        while len(some):
            t = last[place[some], some]
            found.append((some, t))
            counts[some] += 1
            place[some] -= self.size[t]
            some = some[place[some] > 0]
        cut = np.concatenate(([0], np.cumsum(counts)))
        ids = np.zeros(int(cut[-1]), np.uint32)
        for r, (some, t) in enumerate(found):
            ids[cut[some + 1] - 1 - r] = t
        counts = np.concatenate(([len(x) for x in longs], counts)).astype(np.int64)
        ids = np.concatenate([np.array([i for x in longs for i in x], np.uint32), ids])
        cut = np.concatenate(([0], np.cumsum(counts)))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return take_lists(ids, cut, back)


def take_lists(values: np.ndarray, cut: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists values[cut[i]:cut[i+1]] for each i of which, end to end, and their offsets."""
    sizes = (cut[1:] - cut[:-1])[which]
    at = np.concatenate(([0], np.cumsum(sizes)))
    index = np.repeat(cut[which] - at[:-1], sizes) + np.arange(at[-1])
    return values[index], at


class Codec:
    """Texts to ids and back by a rank file (base64 token, blank, rank in each line)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.machine = Transducer(ranks)
        most = max(ranks.values()) + 1
        tokens = [self.machine.vocab.get(i, b"") for i in range(most)]
        self._cut = np.concatenate(([0], np.cumsum([len(t) for t in tokens])))
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.odd = {b: i for b, i in ranks.items() if len(b) > 1 and self.machine.merge(b) != [i]}

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each slice of rows: its first row, ids, and offsets of each row's ids."""
        data, at = X.view(texts)
        for a, b in X.slices(at, SLICE):
            part, rows = data[at[a] : at[b]], at[a : b + 1] - at[a]
            starts = pretokens(part, rows)
            ends = np.concatenate((starts[1:], [len(part)])) if len(starts) else starts
            h = X.word_hashes(part, starts, ends, 8)
            one, which = self._distinct(part, starts, ends - starts, h)
            ids, cut = self.machine.encode_all(part, starts[one], (ends - starts)[one])
            if self.odd:
                ids, cut = self._fix(part, starts[one], (ends - starts)[one], ids, cut)
            ids, cut = take_lists(ids, cut, which)
            yield a, ids, cut[np.searchsorted(starts, rows)]

    @staticmethod
    def _distinct(part: np.ndarray, starts: np.ndarray, size: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One pretoken of each text, and which of them each is: by hash, and by the bytes where a hash is shared."""
        _, one, which = np.unique(h, return_index=True, return_inverse=True)
        same = size == size[one[which]]
        at = np.flatnonzero(same & (size > 0))
        same[at] = X.equal_stretches(part, starts[at], starts[one[which[at]]], size[at])
        if not same.all():
            number: dict[bytes, int] = {}
            which = np.array([number.setdefault(part[a : a + n].tobytes(), len(number)) for a, n in zip(starts.tolist(), size.tolist())], np.int64)
            one = np.unique(which, return_index=True)[1]
        return one, which

    def _fix(self, part, starts, lengths, ids, cut):
        pieces = [part[s : s + n].tobytes() for s, n in zip(starts.tolist(), lengths.tolist())]
        lists = [[self.odd[p]] if p in self.odd else ids[cut[i] : cut[i + 1]].tolist() for i, p in enumerate(pieces)]
        return np.array([x for l in lists for x in l], np.uint32), np.concatenate(([0], np.cumsum([len(l) for l in lists])))

    def bytes_of(self, ids: np.ndarray) -> bytes:
        return take_lists(self._bytes, self._cut, ids)[0].tobytes() if len(ids) else b""


class StreamDecoder:
    """Text of ids that come in pieces.  The state is the unfinished character: at most three bytes, of which the lead
    byte says how many are to follow."""

    def __init__(self, codec: Codec):
        self._codec, self._rest = codec, b""

    def feed(self, ids: np.ndarray) -> str:
        data = self._rest + self._codec.bytes_of(ids)
        whole = len(data) - self._unfinished(data)
        self._rest = data[whole:]
        return data[:whole].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self._rest = self._rest, b""
        return rest.decode("utf-8", "replace")

    @staticmethod
    def _unfinished(data: bytes) -> int:
        for k in range(1, min(3, len(data)) + 1):
            c = data[-k]
            if c & 0xC0 == 0x80:
                continue
            needs = 2 if c & 0xE0 == 0xC0 else 3 if c & 0xF0 == 0xE0 else 4 if c & 0xF8 == 0xF0 else 1
            return k if needs > k else 0
        return 0


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a rank file, once for each worker."""
    return Codec(path)


CHUNK = 1 << 16  # ids that the decoder is fed at once


def _run(path: str, keep: tuple[str, ...]):
    """A batch for each slice of texts, so that what is held follows the slice."""
    kinds = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(), "ids": pa.binary(), "decoded": pa.string()}
    names = [n for n in kinds if n in keep or n not in KEPT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            doc, texts = columns(batch, "doc_id", "text")
            doc = doc.cast(pa.int64())
            for first, ids, rows in c.encode(texts):
                raw = ids.astype("<u4")
                out: dict[str, list] = {n: [] for n in names}
                for lo, hi in zip(rows[:-1].tolist(), rows[1:].tolist()):
                    mine, decoder, digest, pieces = raw[lo:hi], StreamDecoder(c), hashlib.sha256(), []
                    for k in range(0, hi - lo, CHUNK):
                        pieces.append(decoder.feed(mine[k : k + CHUNK]))
                        digest.update(pieces[-1].encode())
                    pieces.append(decoder.close())
                    digest.update(pieces[-1].encode())
                    out["n_tokens"].append(hi - lo)
                    out["ids_sha256"].append(hashlib.sha256(mine.tobytes()).hexdigest())
                    out["decoded_sha256"].append(digest.hexdigest())
                    if "ids" in keep:
                        out["ids"].append(mine.tobytes())
                    if "decoded" in keep:
                        out["decoded"].append("".join(pieces))
                yield pa.RecordBatch.from_arrays([doc.slice(first, len(rows) - 1), *(pa.array(out[n], kinds[n]) for n in names)], ["doc_id", *names])

    return run


KEPT = ("ids", "decoded")  # what is returned besides the counts and digests, unless it is not asked for


def bpe_round_trip(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = KEPT) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids][, decoded]): ids as little-endian unsigned 32-bit integers.
    No shuffle; ``path`` is a rank file that every worker can read."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * ("ids" in keep) + ", decoded string" * ("decoded" in keep)
    return docs.mapInArrow(_run(path, keep), schema)
