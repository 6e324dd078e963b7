"""Graph operators as joins and pre-aggregated minima: components, and the first-accepted-wins resolution."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsieve.operators.spread import HOT_PARTS, cut, join_spread


def components(edges: DataFrame) -> DataFrame:
    """edges (two long columns) -> (node, root): root is the least node that can be reached. Loops and empty edges give
    no rows.

    In each round a node takes the least label of itself and its neighbours (a pre-aggregated minimum, so a hub's
    neighbours don't meet in one task), then the label of its label; the nodes of a label with over a thousandth of all
    are dealt out. Labels only fall, so the rounds end; their sum tells when none fell."""
    u, v = (F.col(f"`{c}`") for c in edges.columns)
    both = edges.select(u.alias("u"), v.alias("v")).unionByName(edges.select(v.alias("u"), u.alias("v"))).filter("u <> v")
    links = cut(both.distinct())
    labels = cut(links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("root")))
    total = F.sum(F.col("root").cast("decimal(38,0)"))
    last, nodes = labels.agg(total, F.count("node")).first()
    if last is None:
        return labels
    while True:
        near = links.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("root").alias("m"))
        low = cut(labels.join(near.withColumnRenamed("u", "node"), "node").select("node", F.least("root", "m").alias("root")))
        jump = low.select(F.col("node").alias("root"), F.col("root").alias("far"))
        many = low.groupBy("root").count().filter(F.col("count") > nodes / HOT_PARTS).select("root")
        met = join_spread(low, jump, ["root"], jump.join(F.broadcast(many), "root"), [F.col("node")])
        labels = cut(met.select("node", F.least("root", "far").alias("root")))
        now = labels.agg(total).first()[0]
        if now == last:
            return labels
        last = now


def _in_order(pairs: pd.DataFrame) -> set:
    """The accepted ones among the nodes of edges (earlier, later), all eligible."""
    before: dict = {}
    for a, b in zip(pairs["earlier"].tolist(), pairs["later"].tolist()):
        before.setdefault(a, [])
        before.setdefault(b, []).append(a)
    taken: set = set()
    for n in sorted(before):
        if not any(p in taken for p in before[n]):
            taken.add(n)
    return taken


def _by_component(among: DataFrame, roots: DataFrame) -> DataFrame:
    """seq, accepted of the nodes of whole components (roots: node, root)."""

    def settle(part: pd.DataFrame) -> pd.DataFrame:
        taken = _in_order(part)
        nodes = sorted({*part["earlier"].tolist(), *part["later"].tolist()})
        return pd.DataFrame({"seq": nodes, "accepted": [n in taken for n in nodes]})

    tagged = among.join(roots.withColumnRenamed("node", "earlier"), "earlier")
    return tagged.groupBy("root").applyInPandas(settle, "seq long, accepted boolean")


def first_accepted(nodes: DataFrame, edges: DataFrame, rounds: int = 4, most_edges: int = 200_000) -> DataFrame:
    """nodes (seq, eligible), edges (earlier, later): seq, accepted, blocked_by.

    In order of seq, an eligible node is accepted unless an accepted earlier one has an edge to it. In rounds: undecided
    nodes without an undecided earlier neighbour are accepted, then their later neighbours are blocked. After each
    ``rounds`` rounds, components of what is undecided with ``most_edges`` edges at most are walked in order, each in a
    task, so that a long chain takes no round for each link; larger ones go on in rounds. A node that is not eligible
    blocks nothing; blocked_by is the least accepted earlier neighbour, for such nodes too."""
    open_nodes = cut(nodes.filter("eligible").select(F.col("seq").cast("long").alias("seq")).distinct())
    links = edges.filter("earlier < later").select(F.col("earlier").cast("long").alias("earlier"), F.col("later").cast("long").alias("later"))
    ends = lambda rows, side: rows.withColumnRenamed("seq", side)
    within = lambda rows, some: rows.join(ends(some, "earlier"), "earlier", "left_semi").join(ends(some, "later"), "later", "left_semi")
    among = cut(within(links, open_nodes).distinct())
    accepted: list[DataFrame] = []
    turn = 0
    while True:
        turn += 1
        fresh = cut(open_nodes.join(among.select(F.col("later").alias("seq")).distinct(), "seq", "left_anti"))
        accepted.append(fresh)
        blocked = among.join(ends(fresh, "earlier"), "earlier", "left_semi").select(F.col("later").alias("seq"))
        open_nodes = cut(open_nodes.join(fresh.unionByName(blocked).distinct(), "seq", "left_anti"))
        if open_nodes.isEmpty():
            break
        among = cut(within(among, open_nodes))
        if turn % rounds:
            continue
        roots = components(among)
        sizes = among.join(roots.withColumnRenamed("node", "earlier"), "earlier").groupBy("root").agg(F.count(F.lit(1)).alias("n"))
        few = cut(roots.join(sizes.filter(F.col("n") <= most_edges), "root").select("node", "root"))
        settled = cut(_by_component(among, few))
        accepted.append(settled.filter("accepted").select("seq"))
        open_nodes = cut(open_nodes.join(settled.select("seq"), "seq", "left_anti"))
        if open_nodes.isEmpty():
            break
        among = cut(among.join(few.select(F.col("node").alias("earlier")), "earlier", "left_anti"))
    taken = accepted[0]
    for part in accepted[1:]:
        taken = taken.unionByName(part)
    taken = cut(taken)
    hit = links.join(ends(taken, "earlier"), "earlier", "left_semi").groupBy("later").agg(F.min("earlier").alias("blocked_by"))
    out = nodes.select("seq").join(taken.withColumn("accepted", F.lit(True)), "seq", "left").join(hit.withColumnRenamed("later", "seq"), "seq", "left")
    return out.select("seq", F.coalesce("accepted", F.lit(False)).alias("accepted"), F.when(F.col("accepted").isNull(), F.col("blocked_by")).alias("blocked_by"))
