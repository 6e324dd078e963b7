"""Keyed tables without a storage engine: merges that give the next state of a table as a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def insert_absent(store: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of new to append: the first of each key that the store does not have."""
    first = new.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter("_n = 1").drop("_n")
    return first.join(store.select(key).distinct(), key, "left_anti")


def overwrite_matched(store: DataFrame, changes: DataFrame, key: str, columns: list[str], order: str | None = None) -> DataFrame:
    """store with the columns taken from changes where a key matches, nulls included. Of a key's changes the last one by
    ``order`` counts; of equal ones, and without an order, the greatest."""
    new = F.struct(*columns)
    side = changes.groupBy(key).agg(F.max(F.struct(F.col(order).alias("_o") if order else F.lit(0).alias("_o"), new.alias("_c")))["_c"].alias("_c"))
    joined = store.join(side, key, "left")
    return joined.select(*[F.when(F.col("_c").isNotNull(), F.col(f"_c.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in store.columns])


def raise_flag(store: DataFrame, changes: DataFrame, key: str, flag: str) -> DataFrame:
    """store with a flag that only rises."""
    side = changes.groupBy(key).agg(F.max(flag).alias("_f"))
    return store.join(side, key, "left").select(*[F.greatest(F.col(flag), F.coalesce("_f", F.col(flag))).alias(flag) if c == flag else F.col(c) for c in store.columns])


def last_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))).filter("_n = 1").drop("_n")


def add_columns(df: DataFrame, schema: str) -> DataFrame:
    """df with the columns of a DDL string that it lacks, as nulls."""
    lacking = [x.strip().split(" ", 1) for x in schema.split(",") if x.strip().split(" ", 1)[0] not in df.columns]
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in lacking])


def unique_names(rows: DataFrame, base: str, order: str, out: str = "name") -> DataFrame:
    """base, base_1, base_2 ... for rows of the same base."""
    n = F.row_number().over(Window.partitionBy(base).orderBy(order)) - 1
    return rows.withColumn(out, F.when(n == 0, F.col(base)).otherwise(F.concat_ws("_", base, n.cast("string"))))


def _moved(path: Column, old: str, new: str) -> Column:
    return F.replace(path, F.lit(f"/{old}/"), F.lit(f"/{new}/"))


def same_label_relabel(rows: DataFrame, label: str, path: str, old: str, new: str) -> DataFrame:
    """rows with a label and its folder in the path renamed."""
    hit = F.col(label) == old
    return rows.withColumns({path: F.when(hit, _moved(F.col(path), old, new)).otherwise(F.col(path)), label: F.when(hit, F.lit(new)).otherwise(F.col(label))})


def merge_plan(rows: DataFrame, files: DataFrame, path: str, label: str, old: str, new: str) -> DataFrame:
    """action, source, target: what merging a label into another does, before anything is done. rows: the table (path,
    label); files (path): what lies in the old label's folder. 'move' for rows with a file, 'relabel' for rows without
    one, 'unknown' for files that no row names; a target that another row has already is 'taken'."""
    mine = rows.filter(F.col(label) == old).select(F.col(path).alias("source")).distinct()
    there = files.select(F.col(path).alias("source"), F.lit(True).alias("found")).distinct()
    both = mine.withColumn("named", F.lit(True)).join(there, "source", "full")
    plan = both.withColumn("target", _moved(F.col("source"), old, new))
    taken = rows.filter(F.col(label) == new).select(F.col(path).alias("target"), F.lit(True).alias("taken")).distinct()
    action = F.when(F.col("named").isNull(), "unknown").when(F.col("taken"), "taken").when(F.col("found"), "move").otherwise("relabel")
    return plan.join(taken, "target", "left").select(action.alias("action"), "source", "target")


def append_unseen(store: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of new whose key an earlier output doesn't hold, to be appended to it."""
    return new.join(store.select(key).distinct(), key, "left_anti")
