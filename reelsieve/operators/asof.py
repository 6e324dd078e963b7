"""The last row at or before a time, in pieces of time: a long series is no single group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsieve.plans.catalog import FRAME_POSITIONS, LOW_EDGE


def latest_before(targets: DataFrame, rows: DataFrame, series: str, at: str, ts: str, tie: str, bucket: float, out: str = "found") -> DataFrame:
    """targets with ``out``: the last row of the same series whose ts is at or before the target's at, as a struct, null if
    there is none; of equal ts the one with the greatest tie. Targets without series or time find nothing.

    Both sides are dealt out by series and piece of time; a target meets the rows of its own piece, and else the last row of
    the nearest earlier piece that has any. Of those pieces a series gives one row each to a second window."""
    found = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    kinds = {"_row": targets.select(F.struct(*[F.col(f"`{c}`") for c in targets.columns])).schema[0].dataType, "_f": rows.select(found).schema[0].dataType}

    def side(df: DataFrame, time: str, kind: int, last, **given) -> DataFrame:
        cols = [given.get(c, F.lit(None)).cast(t).alias(c) for c, t in kinds.items()]
        return df.select(F.col(series).alias("_s"), F.floor(F.col(time) / bucket).alias("_b"), F.col(time).cast("double").alias("_t"), F.lit(kind).alias("_k"), last.alias("_o"), *cols)

    asked = side(targets, at, 1, F.lit(None).cast(rows.schema[tie].dataType), _row=F.struct(*[F.col(f"`{c}`") for c in targets.columns]))
    there = side(rows, ts, 0, F.col(tie), _f=found).filter("_s IS NOT NULL AND _t IS NOT NULL")
    known = asked.filter("_s IS NOT NULL AND _t IS NOT NULL").unionByName(there)
    inside = Window.partitionBy("_s", "_b").orderBy("_t", "_k", "_o").rowsBetween(Window.unboundedPreceding, 0)
    met = known.withColumn("_in", F.last("_f", ignorenulls=True).over(inside)).filter("_k = 1")
    ends = known.groupBy("_s", "_b").agg(F.max_by("_f", F.when(F.col("_k") == 0, F.struct("_t", "_o"))).alias("_e"))
    before = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_s", "_b", F.last("_e", ignorenulls=True).over(before).alias("_p"))
    joined = met.join(carried, ["_s", "_b"]).select("_row.*", F.coalesce("_in", "_p").alias(out))
    none = asked.filter("_s IS NULL OR _t IS NULL").select("_row.*", F.lit(None).cast(kinds["_f"]).alias(out))
    return joined.unionByName(none)


def sampled_fingerprints(videos: DataFrame, frames: DataFrame, bucket: float = 600.0, least: int = 3) -> DataFrame:
    """id, thumbnail, fingerprint, informative. videos: id, duration (of several rows of an id the longest counts); frames:
    id, no, at (seconds), h (16 hex digits or null where a frame could not be hashed), edge (mean difference of neighbouring
    pixels). A frame is taken at each tenth named in the catalog: the last one at or before that time. Frames without a hash
    are left out; fewer than ``least`` give no fingerprint and no flags. A video under half a second has none of the three."""
    long = videos.groupBy("id").agg(F.max("duration").alias("duration"))
    places = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(p).alias("p")) for k, p in enumerate(FRAME_POSITIONS)])
    targets = long.filter("duration >= 0.5").select("id", "duration", F.explode(places).alias("x")).select("id", "x.k", (F.col("duration") * F.col("x.p")).alias("t"))
    met = latest_before(targets, frames.select("id", "no", "at", "h", "edge"), "id", "t", "at", "no", bucket)
    shot = F.struct("k", F.col("found.h").alias("h"), F.coalesce(F.col("found.edge") >= LOW_EDGE, F.lit(False)).alias("fine"))
    taken = met.groupBy("id").agg(F.array_sort(F.collect_list(F.when(F.col("found.h").isNotNull(), shot))).alias("x"))
    enough = F.coalesce(F.size("x") >= least, F.lit(False))
    middle = F.get(F.filter("x", lambda s: s["k"] == FRAME_POSITIONS.index(0.5)), F.lit(0))["h"]
    none = F.array().cast("array<boolean>")
    return long.join(taken, "id", "left").select("id", middle.alias("thumbnail"), F.when(enough, F.array_join(F.transform("x", lambda s: s["h"]), ":")).alias("fingerprint"), F.when(enough, F.transform("x", lambda s: s["fine"])).otherwise(none).alias("informative"))
