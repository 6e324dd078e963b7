"""What to search for: labels in use, keywords by label, and the plan of searches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsieve.functions.text import clean_line, to_hashtag, valid_phrase


def _no_space(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def _named(labels: DataFrame, wanted: DataFrame) -> DataFrame:
    """pos, label of the items of wanted that name a label."""
    item = F.lower(F.trim("item"))
    asked = wanted.select("pos", F.explode(F.array_distinct(F.array(item, _no_space(item)))).alias("key"), item.alias("whole")).filter("whole <> ''")
    keys = labels.select("ord", "label", F.explode(F.array_distinct(F.array(F.lower("label"), F.lower("display")))).alias("key"), F.lower("label").alias("name"))
    # a display name fits only as it was written
    fits = asked.join(keys, "key").filter((F.col("key") == F.col("whole")) | (F.col("key") == F.col("name")))
    return fits.groupBy("pos").agg(F.min_by("label", "ord").alias("label")).select(F.col("pos").cast("long").alias("pos"), "label")


def enabled_labels(labels: DataFrame, wanted: DataFrame) -> DataFrame:
    """pos, label: labels (ord, label, display) named by wanted (pos, item) by name, display name or name without spaces,
    whatever the case, at the place of the wish; all labels in their order if none is named."""
    named = _named(labels, wanted)
    none = named.agg(F.count("pos").alias("n")).filter("n = 0")
    every = labels.join(F.broadcast(none), F.lit(True)).select(F.col("ord").cast("long").alias("pos"), "label")
    return named.unionByName(every)


def unknown_labels(labels: DataFrame, wanted: DataFrame) -> DataFrame:
    """The items, but for blank ones, that name no label."""
    return wanted.filter(F.length(F.trim("item")) > 0).select(F.col("pos").cast("long").alias("pos"), "item").join(_named(labels, wanted), "pos", "left_anti")


def distinct_by_case(items: Column) -> Column:
    """The items of an array in order, each the first of those that are equal but for case."""
    first = lambda xs, low: F.filter(xs, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)
    both = F.array(F.struct(items.alias("xs")))  # bound to a name, or both would be made anew for each item
    both = F.transform(both, lambda b: F.struct(b["xs"].alias("xs"), F.transform(b["xs"], F.lower).alias("low")))
    return F.element_at(F.transform(both, lambda b: first(b["xs"], b["low"])), 1)


def _pieces(tail: Column) -> Column:
    return F.filter(F.transform(F.split(tail, "[|]"), lambda x: clean_line(x)), lambda x: x != "")


def listed_phrases(tail: Column, hashtags: bool = False) -> Column:
    """The valid phrases (or tags) of 'a | b | c', each once."""
    if hashtags:
        return distinct_by_case(F.filter(F.transform(_pieces(tail), lambda x: to_hashtag(x)), lambda x: x.isNotNull()))
    return distinct_by_case(F.filter(_pieces(tail), lambda x: valid_phrase(x)))


def lists_any(tail: Column, hashtags: bool = False) -> Column:
    """Whether there is one."""
    return F.exists(_pieces(tail), lambda x: to_hashtag(x).isNotNull() if hashtags else valid_phrase(x))


def parse_per_label(lines: DataFrame, labels: DataFrame, most: int, hashtags: bool = False) -> DataFrame:
    """lines (no, line) of the form 'Label: a | b' -> label, items (``most`` at most). A line names a label by name, display
    name, or display name without spaces; of a label's lines the last one with an item counts, and only that is read in full."""
    head = F.lower(clean_line(F.split_part("line", F.lit(":"), F.lit(1))))
    tail = F.substring(F.col("line"), F.instr("line", ":") + 1, F.length("line"))
    some = lines.filter(F.contains("line", F.lit(":")) & lists_any(tail, hashtags))
    rows = some.groupBy(head.alias("key")).agg(F.max(F.struct("no", "line")).alias("last"))
    display = F.lower("display")
    keys = labels.select("label", F.explode(F.array_distinct(F.array(F.lower("label"), display, _no_space(display)))).alias("key"))
    last = rows.join(keys, "key").groupBy("label").agg(F.max("last").alias("last")).select("label", "last.line")
    return last.select("label", F.slice(listed_phrases(tail, hashtags), 1, most).alias("items"))


def merge_keywords(active: DataFrame, generated: DataFrame, static: DataFrame, most: int, override: list[str] | None = None) -> DataFrame:
    """label, items: of active labels the generated items, else the first static ones; labels without any are left out. An
    override takes the place of all, under no label."""
    if override:
        spark = active.sparkSession
        return spark.createDataFrame([(None, override)], "label string, items array<string>").select("label", F.filter(F.transform("items", lambda x: clean_line(x)), lambda x: x != "").alias("items"))
    has = lambda c: F.when(F.size(c) > 0, F.col(c))
    both = active.select("label").join(generated.select("label", F.col("items").alias("made")), "label", "left").join(static.select("label", F.col("items").alias("fixed")), "label", "left")
    return both.select("label", F.coalesce(has("made"), F.slice(has("fixed"), 1, most)).alias("items")).filter("items IS NOT NULL")


def search_plan(keywords: DataFrame, platform: str, scopes: list[str]) -> DataFrame:
    """keywords (label, items) -> label, keyword, scope, source, step: every keyword in every scope ('all' for everywhere, else
    a community), the widest first. Scopes are a few settings, beside each row."""
    at = F.posexplode(F.array(*map(F.lit, scopes)))
    rows = keywords.select("label", F.posexplode("items").alias("k", "keyword")).select("label", "k", "keyword", at.alias("s", "scope"))
    name = F.when(F.col("scope") == "all", F.lit("all")).otherwise(F.concat(F.lit("r/"), F.col("scope")))
    return rows.select("label", "keyword", "scope", F.concat_ws(":", F.lit(platform), name, "keyword").alias("source"), (F.col("k") * len(scopes) + F.col("s")).alias("step"))
