"""Helpers that several operators share: column expressions, lineage cuts, checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsieve.operators.spread import HOT_PARTS, cut, join_spread, remove, shared_dir, small  # noqa: F401  operators take them from here

#: ASCII white space: space and U+0009 to U+000D.
WS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands for a null doc_id where rows are grouped or compared by id; below every real id.
NO_ID = -(2**63)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """Runs of non-white-space characters; an empty array for null, empty or blank text."""
    t = F.btrim(F.coalesce(c, F.lit("")), F.lit(WS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, r"[\x20\x09-\x0D]+"))


def let(value: Column, body) -> Column:
    """body(value) with value computed once: inside a lambda Spark would compute it again for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def doc_key(id_col: str = "row.doc_id") -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("did")


def text_key(text_col: str = "row.text") -> list[Column]:
    """A 128-bit key of a whole text (null as empty)."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    return [F.xxhash64(t).alias("t1"), F.xxhash64(t, F.lit(1)).alias("t2")]


def small_bytes(df: DataFrame, size: Column, max_bytes: int) -> tuple[DataFrame, bool]:
    """df with a broadcast hint if the sizes of its rows come to at most max_bytes, else as it is; df should be cut."""
    few = (df.agg(F.sum(size)).first()[0] or 0) <= max_bytes
    return (F.broadcast(df) if few else df), few


def pack(df: DataFrame) -> DataFrame:
    """df as one struct column ``row``: whatever its columns are called, they clash with no name that an operator uses."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpack(df: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns of ``row`` with the new ones in place of or after them."""
    return df.select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in columns], *[v.alias(k) for k, v in new.items() if k not in columns])
