"""Scheduling: label order by deficit, back-off after fruitless visits, quotas, turns, layered settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsieve.functions.media import backoff_hours


def label_order(labels: DataFrame, counts: DataFrame, state: DataFrame, now: float, target: int = 0) -> DataFrame:
    """label, n, deferred, position: deferred last (backed off or at the target), then few videos, then long unseen."""
    joined = labels.join(counts, "label", "left").join(state, "label", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    full = (F.col("n") >= target) if target else F.lit(False)
    joined = joined.withColumn("deferred", F.when((F.coalesce("backoff_until", F.lit(0.0)) > now) | full, 1).otherwise(0))
    # the labels are a fixed list of a few dozen: one task orders them
    w = Window.orderBy("deferred", "n", F.coalesce("last_visit", F.lit(0.0)), "label")
    return joined.select("label", "n", "deferred", F.row_number().over(w).alias("position"))


def visit_state(visits: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """State of each key after its visits (got, at): visits, streak of fruitless ones, back-off end, last video."""
    last_hit = F.max(F.when(F.col("got"), F.struct(*order)))
    after = visits.groupBy(*keys).agg(last_hit.alias("hit"))
    tail = F.col("hit").isNull() | (F.struct(*order) > F.col("hit"))
    out = visits.join(after, keys).groupBy(*keys).agg(
        F.count("at").alias("visits"), F.max("at").alias("last_visit"), F.max(F.when(F.col("got"), F.col("at"))).alias("last_video_at"),
        F.sum(tail.cast("int")).cast("int").alias("empty_streak"))
    return out.withColumn("backoff_until", F.coalesce(F.col("last_visit") + backoff_hours(F.col("empty_streak")) * 3600, F.lit(0.0)))


def within_quota(rows: DataFrame, label: str, order: str, room: str) -> DataFrame:
    """The first ``room`` rows of each label, room being a column."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(label).orderBy(order))).filter(F.col("_n") <= F.col(room)).drop("_n")


def next_in_turn(items: DataFrame, ring: str, order: str, out: str = "next") -> DataFrame:
    """Each item's successor within its ring; the last one's is the first."""
    w = Window.partitionBy(ring).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return items.withColumn(out, F.coalesce(F.lead(order).over(w), F.first(order).over(whole)))


def action_for(outcome: Column, group: Column, rules: Column, default: str) -> Column:
    """Rule for the outcome, else its group, else '*', else the default. rules: a map column."""
    return F.coalesce(F.try_element_at(rules, outcome), F.when(group.isNotNull(), F.try_element_at(rules, F.coalesce(group, F.lit("")))), F.try_element_at(rules, F.lit("*")), F.lit(default))


def overlay(*layers: Column) -> Column:
    """Value of the last layer that has one; layers from general to special."""
    return F.coalesce(*reversed(layers))
