"""The bookkeeping of a crawl: reject rules, what waits, what is to be deleted, what the store doesn't know, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsieve.operators.spread import HOT_PARTS, cut, join_spread
from reelsieve.plans.catalog import REJECT_GROUP

#: Keys that a reject rule can have: reasons, groups of reasons, and everything else.
RULE_KEYS = tuple(dict.fromkeys([*REJECT_GROUP, *REJECT_GROUP.values(), "*"]))
ACTIONS = ("move", "delete")


def reject_rules(text: Column, default: str = "move") -> Column:
    """A map of actions by key from a JSON object; '*' is the default unless it is given. Spaces and case of actions don't count; unknown
    keys and other actions are left out, and so is what isn't an object."""
    if default not in ACTIONS:
        raise ValueError(f"an action is one of {ACTIONS}, not {default!r}")
    given = F.map_entries(F.coalesce(F.from_json(text, "map<string,string>"), F.create_map().cast("map<string,string>")))
    tidy = F.transform(given, lambda e: F.struct(e["key"].alias("key"), F.lower(F.trim(e["value"])).alias("value")))
    sound = F.filter(tidy, lambda e: e["key"].isin(*RULE_KEYS) & e["value"].isin(*ACTIONS))
    rest = F.filter(F.array(F.struct(F.lit("*").alias("key"), F.lit(default).alias("value"))), lambda e: ~F.exists(sound, lambda s: s["key"] == "*"))
    return F.map_from_entries(F.concat(sound, rest))


def ignored_rules(text: Column) -> Column:
    """The keys of a JSON object that ``reject_rules`` leaves out, in order."""
    given = F.map_entries(F.coalesce(F.from_json(text, "map<string,string>"), F.create_map().cast("map<string,string>")))
    bad = F.filter(given, lambda e: ~(e["key"].isin(*RULE_KEYS) & F.coalesce(F.lower(F.trim(e["value"])).isin(*ACTIONS), F.lit(False))))
    return F.array_sort(F.transform(bad, lambda e: e["key"]))


def with_events_judged(rows: DataFrame, label: Column, is_normal: Column) -> DataFrame:
    """rows (is_event) with outcome of the event filter: 'skipped' for rows of the label Normal, which it would reject one and
    all, else 'error' without a verdict, 'no_event' or 'event'."""
    said = F.when(F.col("is_event").isNull(), "error").when(F.col("is_event"), "event").otherwise("no_event")
    return rows.withColumn("event_filter", F.when(F.coalesce(is_normal, F.lit(False)) & label.isNotNull(), "skipped").otherwise(said))


def pending(rows: DataFrame, limit: int, status: str = "status", order: str = "id") -> DataFrame:
    """The first rows that wait."""
    return rows.filter(F.col(status) == "pending").orderBy(order).limit(limit)


def fingerprint_rows(accepted: DataFrame, store: DataFrame, key: str = "url") -> DataFrame:
    """Rows to append to the store of fingerprints, in its columns: those of accepted videos that it has none of yet, one for
    each; what they lack is null."""
    new = accepted.dropDuplicates([key]).join(store.select(key).distinct(), key, "left_anti")
    return new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in new.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in store.schema.fields])


def unknown_files(files: DataFrame, store: DataFrame, path: str = "path") -> DataFrame:
    """Files that no row of the store names."""
    return files.join(store.select(path).filter(F.col(path).isNotNull()).distinct(), path, "left_anti")


def delete_plan(members: DataFrame, group: str = "root", item: str = "node", size: str = "size") -> DataFrame:
    """members with action: 'keep' for the largest file of each group of duplicates (of equal ones the greatest item), 'delete'
    for the others, 'unreadable' for files of unknown size, and 'missing' for all of a group in which no file can be read. Groups
    of one are left out. Rows of the store stay either way. The keeper is an aggregate, so no group is gathered."""
    best = cut(members.groupBy(group).agg(F.count(item).alias("_n"), F.max(F.when(F.col(size).isNotNull(), F.struct(size, item)))[item].alias("_keeper")).filter("_n > 1"))
    total = best.agg(F.sum("_n")).first()[0] or 0
    met = join_spread(members, best, [group], best.filter(F.col("_n") > total / HOT_PARTS), [F.col(item)]).filter("_n IS NOT NULL")
    action = F.when(F.col("_keeper").isNull(), "missing").when(F.col(size).isNull(), "unreadable").when(F.col(item) == F.col("_keeper"), "keep").otherwise("delete")
    return met.withColumn("action", action).drop("_n", "_keeper")


def match_counts(matches: DataFrame, by: list[str], new: str, old: str) -> DataFrame:
    """by, n: how many of either side's frames match, the lesser number."""
    return matches.groupBy(*by).agg(F.least(F.countDistinct(new), F.countDistinct(old)).alias("n"))


def totals(rows: DataFrame, by: str, unknown: str = "unknown") -> DataFrame:
    """by, n: rows of each value, the most first; nulls under a name of their own."""
    return rows.groupBy(F.coalesce(F.col(by), F.lit(unknown)).alias(by)).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), by)


def truth_beside(outcomes: DataFrame, sidecars: DataFrame) -> DataFrame:
    """stem, outcome, truth, agrees: outcomes (path, outcome) beside the hand labels (stem, truth) of files of that name; null
    where there is none."""
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    hand = sidecars.groupBy("stem").agg(F.max("truth").alias("truth"))
    return outcomes.select(stem.alias("stem"), "outcome").join(hand, "stem", "left").withColumn("agrees", F.col("outcome") == F.col("truth"))
