"""Joins that a plain equality does not give: first match, intervals, Hamming distance. None is a nested loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsieve.functions.hashing import hamming, mean_distance
from reelsieve.operators.spread import HOT_PARTS, cut, join_spread


def first_match(new: DataFrame, store: DataFrame, keys: list[str], id_col: str = "id", value: str = "url", out: str = "match") -> DataFrame:
    """new with the value of the store's row of least id that has equal keys, else null. Null keys match nothing."""
    best = store.dropna(subset=keys).groupBy(*keys).agg(F.min_by(value, id_col).alias(out))
    return new.join(best, keys, "left")


def _bucket(c: Column, share: float) -> Column:
    """Number of the logarithmic bucket of a positive value; values within the share are in the same or neighbours."""
    return F.floor(F.log(F.greatest(c.cast("double"), F.lit(1e-9))) / F.log(F.lit(1 + share)))


def share_join(a: DataFrame, b: DataFrame, x: str, y: str, share: float, both: bool = True, extra: list[str] | None = None) -> DataFrame:
    """Pairs with y in [(1-share) x, (1+share) x] (both) or x <= y <= (1+share) x. One side is dealt to the buckets that
    the interval can reach, so the join is on equality; a residual condition decides. Zero pairs with zero alone.
    extra: further columns to match on. Columns must have different names but for those."""
    reach = range(-2, 3) if both else range(0, 3)
    left = a.withColumn("_b", F.explode(F.array(*[_bucket(F.col(x), share) + F.lit(d) for d in reach])))
    right = b.withColumn("_b", _bucket(F.col(y), share))
    joined = left.join(right, ["_b", *(extra or [])]).drop("_b")
    low = F.col(x) * (1 - share) if both else F.col(x)
    return joined.filter((F.col(y) >= low) & (F.col(y) <= F.col(x) * (1 + share)))


def share_buckets(c: Column, share: float, reach: int = 0) -> Column:
    """Array of the numbers of the logarithmic buckets up to ``reach`` from a value's own. Values whose ratio is between 1 - share
    and 1 + share are at most two buckets apart."""
    return F.array(*[_bucket(c, share) + F.lit(d) for d in range(-reach, reach + 1)])


def _cuts(radius: int) -> tuple[list[int], int]:
    """Where the parts of 64 bits begin and end, and how many bits may differ in a part that two values within the radius
    are sure to have: none in one of four parts, or one where there are half as many parts as bits may differ."""
    n, slack = (radius + 1 if radius < 4 else radius // 2 + 1), int(radius >= 4)
    n = max(n, 4)
    return [64 * i // n for i in range(n + 1)], slack


def _part(packed: Column, lo: int, hi: int) -> Column:
    return F.shiftrightunsigned(packed, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))


def bands(packed: Column, radius: int, probe: bool = False) -> Column:
    """Array of structs (no, bits): the parts of 64 bits; with probe also what a part is with one bit changed, if one may differ."""
    cuts, slack = _cuts(radius)
    out = []
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        part = _part(packed, lo, hi)
        flips = [0, *(1 << k for k in range(hi - lo))] if probe and slack else [0]
        out += [F.struct(F.lit(i).alias("no"), part.bitwiseXOR(F.lit(f).cast("long")).alias("bits")) for f in flips]
    return F.array(*out)


def hamming_join(a: DataFrame, b: DataFrame, x: str, y: str, radius: int, also: list[str] | None = None) -> DataFrame:
    """All pairs with at most radius differing bits, and their distance. Rows meet by parts of their hashes of 12 bits or
    more, of which one may differ (of radius 7: four parts of 16 bits, so a pair of random hashes meets once in 960). A pair
    that meets in several parts is kept for the first of them, with no distinct. also: columns of both sides that are to
    be equal, such as a bucket."""
    also = also or []
    cuts, slack = _cuts(radius)
    left = a.filter(F.col(x).isNotNull()).select("*", F.inline(bands(F.col(x), radius, probe=True)))
    right = b.filter(F.col(y).isNotNull()).select("*", F.inline(bands(F.col(y), radius)))
    met = left.join(right, ["no", "bits", *also]).withColumn("distance", hamming(F.col(x), F.col(y))).filter(F.col("distance") <= radius)
    differ = F.col(x).bitwiseXOR(F.col(y))
    first = F.coalesce(*[F.when(F.bit_count(_part(differ, lo, hi)) <= slack, i) for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))])
    return met.filter(F.col("no") == first).drop("no", "bits")


def hamming_links(rows: DataFrame, id_col: str, h: str, radius: int) -> DataFrame:
    """Edges (u, v) of ids whose components are those of all pairs with at most radius differing bits. Equal hashes (black
    frames, title cards) are one node: each of their rows gets an edge to the least id, and only distinct hashes meet."""
    known = cut(rows.filter(F.col(h).isNotNull()).groupBy(F.col(h).alias("h")).agg(F.min(id_col).alias("low"), F.count(F.lit(1)).alias("n")))
    total = known.agg(F.sum("n")).first()[0] or 0
    hot = known.filter(F.col("n") > total / HOT_PARTS).select("h", "low")
    copies = join_spread(rows.select(F.col(id_col).alias("id"), F.col(h).alias("h")).filter("h IS NOT NULL"), known.select("h", "low"), ["h"], hot, [F.col("id")])
    side = lambda n: known.select(F.col("low").alias(f"{n}_id"), F.col("h").alias(n))
    near = hamming_join(side("x"), side("y"), "x", "y", radius).filter("x_id < y_id").select(F.col("x_id").alias("u"), F.col("y_id").alias("v"))
    return copies.filter("id <> low").select(F.col("id").alias("u"), F.col("low").alias("v")).unionByName(near)


def fingerprint_join(a: DataFrame, b: DataFrame, below: int, share: float) -> DataFrame:
    """new_id, old_id, mean: pairs of a and b (id, dur, fp: an array of hashes by place) with durations in the share and a mean
    distance of the frames that both have of less than ``below``. Then a frame is within below - 1 of the other's at its
    place, so candidates come from the frames' hashes; the whole fingerprints decide."""
    frame = lambda df, n, h: df.select(F.col("id").alias(f"{n}_id"), F.col("dur").alias(f"{n}_dur"), F.posexplode("fp").alias("pos", h))
    new = frame(a, "new", "x").withColumn("bucket", F.explode(share_buckets(F.col("new_dur"), share)))
    old = frame(b, "old", "y").withColumn("bucket", F.explode(share_buckets(F.col("old_dur"), share, 2)))
    met = hamming_join(new, old, "x", "y", below - 1, ["pos", "bucket"])
    met = met.filter(F.col("old_dur").between(F.col("new_dur") * (1 - share), F.col("new_dur") * (1 + share))).select("new_id", "old_id").distinct()
    one, two = (df.select(F.col("id").alias(f"{n}_id"), F.col("fp").alias(f"{n}_fp")) for df, n in ((a, "new"), (b, "old")))
    both = met.join(one, "new_id").join(two, "old_id")
    return both.select("new_id", "old_id", mean_distance(F.col("new_fp"), F.col("old_fp")).alias("mean")).filter(F.col("mean") < below)
