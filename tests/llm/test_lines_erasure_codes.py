"""Operators 11 to 13 against brute force, on small tables with nulls, ties, repeats, clashing columns and long texts."""

import collections
import datetime
import hashlib
import os
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from skyledger.llm import erasure, line_dedup, vector_codes

BLANKS = " \t\n\x0b\x0c\r"


# Operator 11


def line_corpus(spark, seed=5):
    r = random.Random(seed)
    common = ["Über den Wolken, " * 2, "  ALL rights reserved by us\t", "all RIGHTS reserved by us", "é" * 19, "é" * 20, "x" * 19, "short"]
    texts = [None, "", "\n\n", "\r\n" * 3, ("a line of its own that is long enough\n" * 700) + "end", "no break " * 9000]
    for k in range(60):
        lines = [r.choice(common) if r.random() < 0.6 else f"line {r.randint(0, 30)} of some document" for _ in range(r.randint(1, 9))]
        texts.append("\n".join(lines))
    rows = [(i, t, str(i)) for i, t in enumerate(texts)]
    r.shuffle(rows)
    return rows + [(7, "all rights reserved by us\nline 1 of some document", "again"), (None, "all rights reserved by us", "null"), (None, common[1] + "\n" + common[0], "null")]


def lines_brute(rows, least=20, enough=3):
    key = lambda s: "".join(c.lower() if c.isascii() else c for c in s.strip(BLANKS))
    holds = collections.defaultdict(list)
    for i, t, _ in rows:
        for k in {key(s) for s in (t or "").split("\n")}:
            if len(k) >= least:
                holds[k].append(-1 if i is None else i)
    top = {k: max(v) for k, v in holds.items() if len(v) >= enough}
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = "\n".join(s for s in lines if top.get(key(s), i if i is not None else -1) == (i if i is not None else -1))
        gone = sum(top.get(key(s), -1 if i is None else i) != (-1 if i is None else i) for s in lines)
        out.append((i, len(lines), gone, hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches,fan,hot", [(1, 4, 4096), (5, 2, 4096), (9, 3, 1 << 40)])
def test_line_dedup(spark, monkeypatch, batches, fan, hot):
    """However many batches and levels there are, and with every repeated key dealt out over parts."""
    monkeypatch.setattr(line_dedup, "MOST_HOT", hot)
    rows = line_corpus(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, sig string").repartition(12)
    got = line_dedup.line_dedup(docs, spark, batches=batches, fan=fan)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text"]
    assert sorted(map(tuple, got.collect()), key=str) == lines_brute(rows)
    assert spark.sql("SHOW TABLES").where("tableName LIKE 'line_run_%'").isEmpty()


def test_line_dedup_empty(spark):
    docs = spark.createDataFrame([], "text string, doc_id int")
    assert line_dedup.line_dedup(docs, spark, keep_text=False).collect() == []


def test_line_runs_know_what_is_repeated(spark):
    """A key that a run knows well enough is not written again; runs of a level become one of the next; joins move no run."""
    runs = line_dedup.LineRuns(spark, buckets=4, fan=3)
    try:
        add = lambda *rows: runs.add(spark.createDataFrame(rows, "doc_id long, hi long, lo long"))
        add((9, 1, 1), (8, 1, 1), (7, 1, 1), (5, 2, 2))
        add((6, 1, 1), (4, 2, 2))
        assert [spark.table(n).count() for n in runs.levels[0]] == [2, 1]  # key 1 was left out of the second
        add((10, 1, 1), (3, 2, 2))
        assert [len(x) for x in runs.levels] == [0, 1]
        assert sorted(map(tuple, runs.repeated().collect())) == [(1, 1, 4, 10), (2, 2, 3, 5)]
        met = runs.unknown(spark.createDataFrame([(2, 2, 2)], "doc_id long, hi long, lo long"))
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and plan.count("Bucketed: true") == 1 and plan.count("Exchange") <= 2  # the batch's own
        assert met.collect() == []
    finally:
        runs.close()


# Operator 12


def shop(seed=2):
    r = random.Random(seed)
    t = lambda: datetime.datetime(2024, 1, 1) + datetime.timedelta(microseconds=r.randrange(10**12))
    maybe = lambda x: None if r.random() < 0.1 else x
    clients = [(i, maybe(i if r.random() < 0.6 else r.randrange(400)), r.choice(["Ä", "a", "Z", None]), r.choice([1.005, -2.675, None, 0.0])) for i in range(400)]
    clients += [(None, 5, "none", 1.0), (3, 777, "repeated", 2.0)]
    clicks = [(i, t(), maybe(min(int(r.expovariate(0.02)), 420)), maybe(r.uniform(-5, 5)), r.choice(["x", None])) for i in range(1500)]
    clicks += clicks[:7] + [(2**60 + 1, None, 1, float("nan"), "n"), (None, t(), None, float("inf"), "i"), (2**60 + 3, None, None, None, None)]
    sales = [(i, maybe(r.randrange(430)), t(), maybe(round(r.uniform(0, 99), 2))) for i in range(800)] + [(None, 4, None, 1.0)]
    lines = [(maybe(min(int(r.expovariate(0.005)), 900)), k, maybe(round(r.uniform(0, 9), 3)), "f") for k in range(2500)]
    lines += lines[:11]
    return clients, clicks, sales, lines


KINDS = {
    "clients": "client_id long, master_id long, rank string, balance double",
    "clicks": "click_id long, ts timestamp_ntz, client_id long, value double, cents string",
    "sales": "sale_id long, client_id long, sold_at timestamp_ntz, total double",
    "sale_lines": "sale_id long, line_no int, amount double, file_no string",
}
KEY, MONEY = {"clients": 1, "clicks": 2, "sales": 1, "sale_lines": 0}, {"clients": 3, "clicks": 3, "sales": 3, "sale_lines": 2}


def erase_brute(tables, files, one_in):
    clients, clicks, sales, lines = tables
    crc = lambda x: zlib.crc32(b"" if x is None else str(x).encode())

    def order(v):
        if v is None:
            return (0,)
        if isinstance(v, str):
            return (1, v.encode())
        return (2,) if v != v else (1, v)

    masters = {m for _, m, *_ in clients if m is not None}
    own = {(c, m) for c, m, *_ in clients if c is not None and m is not None}
    n = collections.Counter(c for _, _, c, *_ in clicks if c is not None)
    most = collections.Counter({m: 0 for m in masters})
    for c, m in own:
        most[m] += n[c]
    gone = {m for m in masters if crc(m) % one_in == 0} | {min(masters, key=lambda m: (-most[m], m))} if masters else set()
    ids = {c for c, m in own if m in gone}
    sold = {s for s, c, *_ in sales if c in ids and s is not None}
    client = {}
    for s, c, *_ in sales:
        if s is not None:
            client[s] = c if client.get(s) is None else client[s] if c is None else min(c, client[s])
    first = {"clients": lambda r: r[0], "clicks": lambda r: r[2], "sales": lambda r: r[1], "sale_lines": lambda r: client.get(r[0])}
    victims = {"clients": gone, "clicks": ids, "sales": ids, "sale_lines": sold}
    out = {}
    for name, rows in zip(KINDS, tables):
        rows = sorted(rows, key=lambda r: (crc(first[name](r)), [order(v) for v in r]))
        m = 1 + len(rows) // files
        for k in range(0, len(rows), m):
            part = rows[k : k + m]
            kept = [r for r in part if r[KEY[name]] not in victims[name]]
            money = [r[MONEY[name]] for r in kept]
            cents = sum(int(np.floor(100 * x + 0.5)) for x in money if x is not None and np.isfinite(x))
            sha = hashlib.sha256(",".join("" if r[0] is None else str(r[0]) for r in kept).encode()).hexdigest()
            if kept:
                out[name, k // m] = (len(kept), len(part) - len(kept), cents, len(kept) < len(part), sha, kept)
    return out


def same(a, b):
    return a == b or (a is not None and b is not None and a != a and b != b)


@pytest.mark.parametrize("files,one_in", [(350, 400), (20, 7)])
def test_cascading_erasure(spark, files, one_in):
    tables = shop()
    frames = [spark.createDataFrame(rows, kind).repartition(3) for rows, kind in zip(tables, KINDS.values())]
    got = erasure.cascading_erasure(*frames, spark, files=files, one_in=one_in).collect()
    want = erase_brute(tables, files, one_in)
    assert {(r.table_name, r.file_no) for r in got} == set(want)
    assert any(r.rewritten for r in got) and not all(r.rewritten for r in got)
    folders = {os.path.dirname(r.path.removeprefix("file://")) for r in got}
    assert {r.path.removeprefix("file://") for r in got} == {os.path.join(d, f) for d in folders for f in os.listdir(d) if f.endswith(".parquet")}
    for r in got:
        n, erased, cents, rewritten, sha, rows = want[r.table_name, r.file_no]
        assert (r.n_rows, r.n_erased, r.cents, r.rewritten, r.ids_sha256) == (n, erased, cents, rewritten, sha)
        file = pq.ParquetFile(r.path.removeprefix("file://"))
        table = file.read()
        assert ",".join(table.column_names) == r.columns == ",".join(x.split()[0] for x in KINDS[r.table_name].split(", "))
        assert all(same(a, b) for x, y in zip(zip(*(c.to_pylist() for c in table.columns)), rows, strict=True) for a, b in zip(x, y, strict=True))
        low = file.metadata.row_group(0).column(0).statistics
        known = [x[0] for x in rows if x[0] is not None]
        if known:
            assert (low.min, low.max) == (min(known), max(known)) and low.null_count == n - len(known)
    again = spark.read.parquet(f"{os.path.dirname(got[0].path)}")  # what Spark wrote and what was rewritten read alike
    assert again.count() == sum(r.n_rows for r in got if r.table_name == got[0].table_name)


def test_cascading_erasure_of_empty_tables(spark):
    frames = [spark.createDataFrame([], kind) for kind in KINDS.values()]
    assert erasure.cascading_erasure(*frames, spark).collect() == []
    no_clicks = [frames[0].sparkSession.createDataFrame([(1, 8, "", 1.0), (2, 6, "", 2.0)], KINDS["clients"]), *frames[1:]]
    got = erasure.cascading_erasure(*no_clicks, spark, one_in=1 << 40).collect()
    assert [(r.table_name, r.n_rows, r.n_erased, r.rewritten) for r in got] in ([("clients", 1, 0, False)], [("clients", 1, 1, True)])  # the tie at 0: master 6
    assert pq.read_table(got[0].path.removeprefix("file://")).column("client_id").to_pylist() == [1]


# Operator 13


def codes_brute(rows, parts, entries, rounds, scale):
    """With Python's integers only."""
    kept = [(i, lab, [int(np.floor(np.float64(x) * scale)) for x in v]) for i, v, lab in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    first = {}
    for i, _, v in sorted((x for x in kept if x[0] is not None), key=lambda x: (x[0], x[2])):
        first.setdefault(i, v)
    w = len(kept[0][2]) // parts
    cut = lambda v: [v[p * w : (p + 1) * w] for p in range(parts)]
    books = [[cut(first[i])[p] for i in sorted(first)[:entries]] for p in range(parts)]

    def assign(v):
        return [min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p])) for p, x in enumerate(cut(v))]

    for _ in range(rounds):
        got = collections.defaultdict(list)
        for _, _, v in kept:
            for p, (_, k) in enumerate(assign(v)):
                got[p, k].append(cut(v)[p])
        for (p, k), xs in got.items():
            books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [(i, lab, "".join(f"{k:02x}" for _, k in a), sum(d for d, _ in a)) for i, lab, v in kept for a in [assign(v)]]
    by = collections.Counter()
    for _, lab, _, e in out:
        by[lab] += e
    return sorted(((i, c, e, by[lab], sha) for i, lab, c, e in out), key=str)


@pytest.mark.parametrize("scale,entries,size", [(1024, 256, 1.0), (1024, 9, 1.0), (4, 9, 0.5), (1 << 16, 5, 2e3)])
def test_vector_codes(spark, scale, entries, size):
    """Ties (a coarse scale), few entries, and components beyond what doubles can sum up."""
    r = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in np.float32(r.normal(size=8) * size * r.choice([0.1, 1, 3]))], int(r.integers(3))) for i in r.permutation(90)]
    rows += [(500, None, 1), (501, [None] + [0.0] * 7, 1), (502, [float("nan")] * 8, 2), (503, [float("inf")] * 8, 2), (504, [0.0] * 8, None), (505, [0.0] * 8, None)]
    rows += [(None, [0.25] * 8, 1), rows[0], rows[0], (2, [0.5] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("code", F.lit("own")).repartition(4)
    got = vector_codes.vector_codes(df, spark, entries=entries, scale=scale)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == codes_brute(rows, 4, entries, 4, scale)


def test_vector_codes_edges(spark, monkeypatch):
    kind = "vec_id long, embedding array<float>, label int"
    assert vector_codes.vector_codes(spark.createDataFrame([], kind), spark).collect() == []
    assert vector_codes.vector_codes(spark.createDataFrame([(1, None, 1)], kind), spark).collect() == []
    monkeypatch.setattr(vector_codes, "FEW_LABELS", 1)  # sums by label joined by a shuffle
    rows = [(k, [float(k % 5), 0.0, 1.0, float(k)], k % 3 or None) for k in range(40)]
    got = vector_codes.vector_codes(spark.createDataFrame(rows, kind), spark, entries=4).collect()
    assert sorted(map(tuple, got), key=str) == codes_brute(rows, 4, 4, 4, 1024)
    for bad in ([(1, [1.0, 2.0], 1)], [(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)]):
        with pytest.raises(Exception, match="components"):
            vector_codes.vector_codes(spark.createDataFrame(bad, kind), spark).collect()


def test_annulus_leaves_entries_out_and_loses_none():
    """Where norms differ much most entries are never evaluated, and the nearest is found all the same."""
    r = np.random.default_rng(1)
    entries = np.floor(r.normal(size=(256, 16)) * np.exp(r.normal(size=(256, 1)) * 2) * 100)
    entries[17] = entries[3]
    x = np.floor(entries[r.integers(0, 256, 4000)] * (1 + 0.01 * r.normal(size=(4000, 16))))
    search = vector_codes.Annuli(entries)
    code, error = search.nearest(x)
    d = ((x[:, None, :] - entries[None]) ** 2).sum(2)
    assert (code == d.argmin(1)).all() and (error.astype(np.float64) == d.min(1)).all()
    assert search.evaluated < 0.5 * d.size
