"""Rules by domain: a rule holds for its domain and all below it, and the longest one counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsieve.operators.spread import HOT_PARTS, cut, join_spread, small


def bare_domain(domain: Column) -> Column:
    return F.regexp_replace(F.lower(domain), r"^\.+", "")


def parents(host: Column) -> Column:
    """The host and every domain above it, the longest first."""
    labels = F.split(bare_domain(host), r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))


def match_domains(rows: DataFrame, host: str, rules: DataFrame, domain: str, broadcast_rows: int = 100_000) -> DataFrame:
    """rows with rule: of the rules that fit the row's host the longest one's row as a struct, null for none. Case and leading
    dots don't count; of rules for one domain the least row stays; null and empty hosts and domains fit nothing.

    Each distinct host looks its few parents up once, so a domain that many hosts share costs no more than these hosts.
    Rules are broadcast while they are few; beyond that, parents that very many hosts have (``com``) are dealt out. The
    rows of a very common host are dealt out too."""
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), bare_domain(F.col(host)).alias("host"))
    hosts = packed.filter("host <> ''").groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    hosts = cut(hosts)
    one = cut(rules.filter(F.col(domain).isNotNull()).groupBy(bare_domain(F.col(domain)).alias("parent")).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rules.columns])).alias("rule")).filter("parent <> ''"))
    above = hosts.select("host", "n", F.explode(parents(F.col("host"))).alias("parent"))
    few, is_few = small(one, broadcast_rows)
    if is_few:
        met = above.join(few, "parent")
    else:
        often = above.groupBy("parent").agg(F.count(F.lit(1)).alias("hosts"))
        most = hosts.count() / HOT_PARTS
        hot = one.join(often.filter(F.col("hosts") > most), "parent", "left_semi")
        met = join_spread(above, one, ["parent"], cut(hot), [F.col("host")]).filter("rule IS NOT NULL")
    best = cut(met.groupBy("host", "n").agg(F.max_by("rule", F.length("parent")).alias("rule")))
    total = hosts.agg(F.sum("n")).first()[0] or 0
    hot = best.filter(F.col("n") > total / HOT_PARTS).drop("n")
    salt = F.xxhash64(F.to_json("row"))
    return join_spread(packed, best.drop("n"), ["host"], hot, [salt]).select("row.*", "rule")
