"""Operator 9: quality classifier (naive Bayes support vectors).

Features are the distinct word unigrams and bigrams and byte trigrams of the lower-cased text.  Labels of rows whose
crc32(doc_id as text) mod 5 is 0 are held out; labels, lang, source and id are no features.  The fit uses at most
``most_rows`` labelled rows (those of the least hash of their id) and 256 MB of their features, and leaves out features
that fewer than ``least`` of them have; everything is scored, on whole texts.

Edge cases: null and empty texts have no features and get the score of the bias; without labels every score is 0.5;
null labels are ignored; rows that repeat an id are scored each; a null id is never held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import _linear as L
from skyledger.llm import _text as X
from skyledger.llm._spark import crc_mod

MOST_ROWS = 5000
LEAST = 3  # rows of the fit that a feature must be met in


def features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    data, at = X.view(texts)
    for a, b in X.slices(at):
        part, rows = X.lower_ascii(data[at[a] : at[b]]), at[a : b + 1] - at[a]
        starts, ends, of = X.words(part, rows, X.SPACED)
        one = X.word_hashes(part, starts, ends, 90)
        two = X.mix(one[:-1] * X.U64(X.P_GRAM) + one[1:], 91) if len(one) else one
        ok = X.inside_rows(of, 2, len(one))
        p = part.astype(np.uint64)
        three = (p[:-2] << X.U64(16)) | (p[1:-1] << X.U64(8)) | p[2:] if len(p) > 2 else p[:0]
        fine = X.inside_rows(rows, 3, len(part))
        parts, sizes = [], []
        for i in range(b - a):
            w = slice(of[i], of[i + 1])
            v = slice(of[i], max(of[i + 1] - 1, of[i]))
            t = three[rows[i] : max(rows[i + 1] - 2, rows[i])][fine[rows[i] : max(rows[i + 1] - 2, rows[i])]]
            f = np.unique(np.concatenate((one[w], two[v][ok[v]], t)))
            parts.append(f)
            sizes.append(len(f))
        yield a, np.concatenate([np.zeros(0, np.uint64), *parts]), np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def quality_scores(docs: DataFrame, labels: DataFrame, spark: SparkSession, *, id_col: str = "doc_id", text_col: str = "text", most_rows: int = MOST_ROWS, least: int = LEAST) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = L.train(docs, labels, "quality", crc_mod(F.col("doc_id"), 5) == 0, features, spark, most_rows=most_rows, least=least)
    return L.verdicts(L.score(docs, model, features, spark), 5, 0)
