"""Operator 1: exact deduplication by 128-bit content hash, compared byte by byte inside each group.

Native DataFrame operations only.  Copies are merged on the map side, so a group that holds a third of all rows
sends one row for each task; its rows find their group's verdict by a join that deals the few large groups out over
SALTS parts and leaves all others in one.  Edge cases: a null text counts as empty, and empty texts are copies of one another; rows that repeat an id
count in ``group_size`` and share its decision in ``exact_groups``, while ``drop_copies`` leaves one of them; a null id
is less than all others, in both; an empty table gives an empty result; further columns, of any type, do not matter
but to choose between rows of one id and text in ``drop_copies``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


SALTS = 32  # parts that a large group is dealt out over
MOST_LARGE = 1 << 16  # large groups at most: each has more than its share of all rows, so there cannot be more
LEAST_LARGE = 10_000  # rows of a large group at least


def _ordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _ordered(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_ordered(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", hash128: Callable[[Column], Column] = md5_128, least_large: int = LEAST_LARGE,
) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256.

    Texts that share the 128-bit hash are grouped again by their bytes, so a collision of the hash never merges
    two texts.  Rows find their group by the 128-bit hash and SHA-256 together; should two different texts agree
    in both, the query fails rather than answers wrongly.
    """
    if keep not in ("min", "max"):
        raise ValueError(f"keep is 'min' or 'max', not {keep!r}")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("__t"), hash128(text).alias("__h"))
    sha = F.unhex(F.sha2(F.col("__t").cast("binary"), 256))
    best = (F.min if keep == "min" else F.max)(F.struct("__id"))
    by_bytes = rows.groupBy("__h", "__t").agg(F.count(F.lit(1)).alias("__n"), best.alias("__best"))
    groups = by_bytes.select("__h", sha.alias("__s"), "__n", "__best").groupBy("__h", "__s").agg(F.first("__n").alias("group_size"), F.first("__best").alias("__best"), F.count(F.lit(1)).alias("__texts"))
    size = F.when(F.col("__texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts share both hashes")).cast("long"))
    # A large group is in all parts, and each of its rows in one by its id.
    most = max(docs.count() // MOST_LARGE, least_large)
    large = F.broadcast(rows.groupBy("__h").agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > most).select("__h", F.lit(True).alias("__large")))
    parts = F.when(F.col("__large"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    groups = groups.join(large, "__h", "left").select("__h", "__s", size.alias("group_size"), F.col("__best.__id").alias("keep_id"), F.explode(parts).alias("__part"))
    part = F.when(F.col("__large"), F.pmod(F.xxhash64("__id"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    members = rows.select("__id", "__h", sha.alias("__s")).join(large, "__h", "left").select("__id", "__h", "__s", part.alias("__part"))
    return members.hint("merge").join(groups, ["__h", "__s", "__part"]).select(
        F.col("__id").alias(id_col), "keep_id", "group_size", F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("__s")).alias("text_sha256")
    )


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", hash128: Callable[[Column], Column] = md5_128) -> DataFrame:
    """docs with one row for each text, all its columns as they were: that of the smallest (or largest) id, by the
    other columns among equal ids.  One shuffle of the distinct texts."""
    if keep not in ("min", "max"):
        raise ValueError(f"keep is 'min' or 'max', not {keep!r}")
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    kinds = {f.name: f.dataType for f in docs.schema}
    row = F.struct(F.col(id_col).alias("i"), F.col(text_col).isNotNull().alias("given"), *(F.col(c).alias(f"c{k}") for k, c in enumerate(rest)))
    pick = F.min if keep == "min" else F.max
    if all(map(_ordered, (kinds[c] for c in rest))):
        best = pick(row)
    else:  # maps have no order: their text has
        order = F.struct(F.col(id_col), F.col(text_col).isNotNull(), *(F.col(c) if _ordered(kinds[c]) else F.to_json(F.struct(c)) for c in rest))
        best = (F.min_by if keep == "min" else F.max_by)(row, order)
    one = docs.groupBy(hash128(text).alias("__h"), text.alias("__t")).agg(best.alias("__row"))
    back = {id_col: F.col("__row.i"), text_col: F.when(F.col("__row.given"), F.col("__t"))} | {c: F.col(f"__row.c{k}") for k, c in enumerate(rest)}
    return one.select(*(back[c].alias(c) for c in docs.columns))
