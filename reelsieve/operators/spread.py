"""What operators at scale share: lineage cuts in the shared folder, checked broadcasts, joins that deal out hot keys."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share. Only where the session names none (tests, one
    machine) a temporary one is taken."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(path)
        return path
    known = sc._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="spark-")
    sc.setCheckpointDir(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    jvm = spark._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


#: With it Spark removes the shuffle files of an execution that has ended; a checkpoint needs them no more.
_REMOVE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder: a lost executor costs no recomputation of what is above, and the
    shuffle files that led to it are removed."""
    spark = df.sparkSession
    shared_dir(spark)
    before = spark.conf.get(_REMOVE, "false")
    spark.conf.set(_REMOVE, "true")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set(_REMOVE, before)


def small(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """df with a broadcast hint if it was counted to have at most max_rows rows, else as it is; df should be cut."""
    few = df.limit(max_rows + 1).count() <= max_rows
    return (F.broadcast(df) if few else df), few


#: A key is hot if it has over one in so many of the rows; hence no more hot keys than this.
HOT_PARTS = 1000


def join_spread(left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame, salt: list[Column]) -> DataFrame:
    """left outer join with right, which has one row per key; hot holds what right has for left's hot keys, nulls for
    nothing. These are at most HOT_PARTS and broadcast. left's rows with a hot key are dealt by a hash of salt, so that they never meet in one task;
    what that hash might match by chance is passed over for the row of hot. Without hot keys it is a plain join. left's keys are longs or strings; some are longs."""
    new = [c for c in right.columns if c not in keys]
    if not hot.count():
        return left.join(right, keys, "left").select(*[F.col(f"`{c}`") for c in [*left.columns, *new]])
    longs = [f.name for f in left.schema.fields if f.name in keys and f.dataType.typeName() == "long"]
    marked = left.join(F.broadcast(hot.select(*keys, F.struct(*new).alias("_hot"))), keys, "left")
    dealt = F.xxhash64(*salt)
    marked = marked.select("*", *[(F.when(F.col("_hot").isNull(), F.col(k)).otherwise(dealt) if k in longs else F.col(k)).alias(f"_k{i}") for i, k in enumerate(keys)])
    met = marked.join(right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*new).alias("_new")), [f"_k{i}" for i in range(len(keys))], "left")
    return met.select(*[F.col(f"`{c}`") for c in left.columns], *[F.when(F.col("_hot").isNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_hot.{c}")).alias(c) for c in new])
