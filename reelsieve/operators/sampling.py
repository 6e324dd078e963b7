"""Random choices that depend on a seed and the rows' keys alone: the same at any partitioning, and merged from parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(key: Column, seed: int) -> Column:
    """A number in (0, 1) for each key: the first 52 bits of a hash."""
    h = F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), key.cast("string")), 256), 1, 13)
    return (F.conv(h, 16, 10).cast("double") + 0.5) / float(1 << 52)


def sample(rows: DataFrame, by: list[str], key: str, k: int, seed: int = 0, weight: str | None = None) -> DataFrame:
    """k rows of each group without replacement, all of a smaller one. weight: chances in proportion to it (the row with the
    least exponential time of that rate comes first); rows of a null weight, or of none, are never drawn. Rows of equal
    keys have equal chances and come by their other columns, which must be ones that sort. Before the shuffle each task keeps k rows a group."""
    u = draw(F.col(key), seed)
    rank = u if weight is None else -F.log(u) / F.col(weight)
    drawn = rows if weight is None else rows.filter(F.col(weight) > 0)
    order = [F.col("_u"), *[F.col(f"`{c}`") for c in rows.columns]]
    return drawn.withColumn("_u", rank).withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_n") <= k).drop("_u", "_n")


def shuffled(rows: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """rows in a random order, by a sort over ranges of the draws."""
    return rows.withColumn("_u", draw(F.col(key), seed)).orderBy("_u", key).drop("_u")
