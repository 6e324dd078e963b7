"""A linear probe over embeddings, trained and measured through MLlib."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_folds(rows: DataFrame, group: str, folds: int) -> DataFrame:
    """rows with fold: all rows of a group are in one, by its hash."""
    return rows.withColumn("fold", F.pmod(F.xxhash64(group), F.lit(folds)).cast("int"))


def class_balance(rows: DataFrame, label: str, file: str) -> DataFrame:
    """label, rows, files: rows and distinct files of each class."""
    return rows.groupBy(label).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(file).alias("files"))


def fit(rows: DataFrame, features: str, label: str):
    return LogisticRegression(maxIter=50, regParam=0.01).fit(rows.select(array_to_vector(F.col(features).cast("array<double>")).alias("features"), F.col(label).cast("double").alias("label")))


def cross_validate(rows: DataFrame, features: str, label: str, group: str, folds: int = 5) -> DataFrame:
    """metric, mean, std over folds that keep groups together: accuracy, precision and recall of a 0/1 label."""
    parts = group_folds(rows, group, folds)
    scored = None
    for k in range(folds):  # a few models
        model = fit(parts.filter(F.col("fold") != k), features, label)
        held = parts.filter(F.col("fold") == k).select(array_to_vector(F.col(features).cast("array<double>")).alias("features"), F.col(label).cast("int").alias("y"), "fold")
        some = model.transform(held).select("fold", "y", F.col("prediction").cast("int").alias("p"))
        scored = some if scored is None else scored.unionByName(some)
    hit = lambda c: F.sum(c.cast("double"))
    y, p = F.col("y"), F.col("p")
    each = scored.groupBy("fold").agg((hit(y == p) / F.count("y")).alias("accuracy"), F.try_divide(hit((y == 1) & (p == 1)), hit(p == 1)).alias("precision"), F.try_divide(hit((y == 1) & (p == 1)), hit(y == 1)).alias("recall"))
    long = each.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in ("accuracy", "precision", "recall")])).alias("x")).select("x.*")
    return long.groupBy("metric").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))
