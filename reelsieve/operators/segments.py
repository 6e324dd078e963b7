"""Segments of frame series: differences, shots, merged intervals, windows, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsieve.functions import media as M
from reelsieve.plans.catalog import CUT_LEVEL, HI, LO, MERGE_GAP_S, MIN_SECONDS


def frame_deltas(frames: DataFrame, series: str, order: list[str], value: str, out: str = "delta") -> DataFrame:
    """Absolute difference to the frame before; 0 for the first."""
    before = F.lag(value).over(Window.partitionBy(series).orderBy(*order))
    return frames.withColumn(out, F.coalesce(F.abs(F.col(value) - before), F.lit(0.0)))


def shot_cuts(deltas: Column, min_len: int, level: float = CUT_LEVEL) -> Column:
    """First frames of shots: a cut where the difference reaches the level at least min_len after the last cut. A fold
    over the array: it depends on the cut before, which no window can say."""
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(deltas) - 1, F.lit(1))), F.array(F.lit(0)), lambda cuts, i: F.when((F.get(deltas, i) >= level) & (i - F.element_at(cuts, -1) >= min_len), F.concat(cuts, F.array(i))).otherwise(cuts))


def shot_ends(frames: DataFrame, series: str, place: str, value: str, min_len: int, level: float = CUT_LEVEL, chunk: int = 4096) -> DataFrame:
    """series, shots, last_cut: the number of shot_cuts and the last of them. place counts from 0 in each series. Each
    chunk of frames is folded for every distance that the last cut before it can have (min_len stands for all beyond),
    and of a whole series only these folds meet."""

    def last(at, n):
        return F.struct(at.cast("long").alias("last"), n.cast("long").alias("n"))

    begin = F.col("_c") * chunk
    cut = F.when((F.col(value) >= level) & (F.col(place) >= 1), F.col(place).cast("long"))
    chunks = frames.groupBy(series, F.floor(F.col(place) / chunk).alias("_c")).agg(F.array_sort(F.collect_list(cut)).alias("_xs"))
    folds = [F.aggregate("_xs", last(begin - age, F.lit(0)), lambda acc, x: F.when(x - acc["last"] >= min_len, last(x, acc["n"] + 1)).otherwise(acc)) for age in range(min_len + 1)]
    whole = chunks.groupBy(series).agg(F.array_sort(F.collect_list(F.struct("_c", F.array(*folds).alias("f")))).alias("_fs"))

    def step(acc, c):
        f = F.get(c["f"], F.least(c["_c"] * chunk - acc["last"], F.lit(min_len)).cast("int"))
        return F.when(f["n"] > 0, last(f["last"], acc["n"] + f["n"])).otherwise(acc)

    return whole.withColumn("_s", F.aggregate("_fs", last(F.lit(0), F.lit(1)), step)).select(series, F.col("_s.n").cast("int").alias("shots"), F.col("_s.last").alias("last_cut"))


def merge_intervals(segments: DataFrame, series: str, start: str, end: str, prob: str, gap: float = MERGE_GAP_S) -> DataFrame:
    """series, start, end, prob of runs of segments that begin less than gap after the furthest end so far."""
    w = Window.partitionBy(series).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col(start) - reach < gap, 0).otherwise(1)
    runs = segments.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w))
    return runs.groupBy(series, "_run").agg(F.min(start).alias(start), F.max(end).alias(end), F.max(prob).alias(prob)).drop("_run")


def repeat_rate(deltas: DataFrame, series: str, value: str, fps: float) -> DataFrame:
    """dup_ratio and eff_fps of each series; null for too few frames or almost no motion."""
    stats = deltas.groupBy(series).agg(F.count(value).alias("n"), F.expr(f"percentile({value}, 0.75)").alias("p75"))
    joined = deltas.join(stats, series).groupBy(series, "n", "p75").agg(F.avg((F.col(value) < 0.15 * F.col("p75")).cast("double")).alias("dup"))
    fine = (F.col("n") >= max(10, fps)) & (F.col("p75") >= 0.4)
    return joined.select(series, "n", F.when(fine, F.col("dup")).alias("dup_ratio"), F.when(fine, fps * (1 - F.col("dup"))).alias("eff_fps"))


def video_verdict(segments: DataFrame, series: str, hi: float = HI, lo: float = LO, seconds: float = MIN_SECONDS) -> DataFrame:
    """series, cctv_seconds, max_prob, label from (prob, duration) of segments."""
    out = segments.groupBy(series).agg(F.coalesce(F.sum(F.when(F.col("prob") >= hi, F.col("duration"))), F.lit(0.0)).alias("cctv_seconds"), F.coalesce(F.max("prob"), F.lit(0.0)).alias("max_prob"))
    return out.withColumn("label", F.when(F.col("cctv_seconds") >= seconds, "cctv").when(F.col("max_prob") > lo, "uncertain").otherwise("not_cctv"))


def top_rows(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(rank) <= k)


def streak_cut(items: DataFrame, series: str, order: str, known: str, limit: int) -> DataFrame:
    """Items up to and with the one that completes the first run of ``limit`` known items in a row."""
    w = Window.partitionBy(series).orderBy(order)
    runs = items.withColumn("_run", F.sum(F.when(F.col(known), 0).otherwise(1)).over(w))
    in_run = Window.partitionBy(series, "_run").orderBy(order)
    counted = runs.withColumn("_n", F.sum(F.when(F.col(known), 1).otherwise(0)).over(in_run))
    stop = F.max(F.when(F.col("_n") >= limit, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return counted.withColumn("_stop", F.coalesce(stop, F.lit(0))).filter("_stop = 0").drop("_run", "_n", "_stop")


def clock_consistent(reads: DataFrame, series: str) -> DataFrame:
    """reads (series, at seconds, clock seconds): whether two reads at least 1 s apart show a clock that runs on."""
    a = reads.select(series, F.col("at").alias("ta"), F.col("clock").alias("x"))
    b = reads.select(series, F.col("at").alias("tb"), F.col("clock").alias("y"))
    dv, dy = F.col("tb") - F.col("ta"), F.col("y") - F.col("x")
    hits = a.join(b, series).filter((dv >= 1) & (dy > 0) & (dy <= 4 * dv + 2)).select(series).distinct()
    return reads.select(series).distinct().join(hits.withColumn("consistent", F.lit(True)), series, "left").select(series, F.coalesce("consistent", F.lit(False)).alias("consistent"))


def centroids(vectors: DataFrame, label: str, vec: str) -> DataFrame:
    """label, pos, value: the mean of the unit vectors of each label, made a unit vector."""
    norm = F.sqrt(F.aggregate(F.col(vec), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    flat = vectors.select(label, F.posexplode(F.transform(vec, lambda x: x.cast("double") / norm)).alias("pos", "x"))
    mean = flat.groupBy(label, "pos").agg(F.avg("x").alias("m"))
    size = F.sqrt(F.sum(F.col("m") * F.col("m")).over(Window.partitionBy(label)))
    return mean.select(label, "pos", (F.col("m") / size).alias("value"))


def segment_means(frames: DataFrame, keys: list[str], gray_below: float = 12.0) -> DataFrame:
    """keys, p_visual, gray_ratio: the mean of the frames' p_visual, and the share of them with less saturation."""
    return frames.groupBy(*keys).agg(F.avg("p_visual").alias("p_visual"), F.avg((F.col("saturation") < gray_below).cast("double")).alias("gray_ratio"))


def needs_reading(p_visual: Column, eff_fps: Column, gray_ratio: Column, least: float = 0.3) -> Column:
    """Whether a segment's frames are worth reading for a clock."""
    return F.coalesce(p_visual >= least, F.lit(False)) | F.coalesce(eff_fps <= 16, F.lit(False)) | F.coalesce(gray_ratio >= 0.5, F.lit(False))


def timestamp_scores(samples: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ts_score of sampled frames (i from 0, at in seconds, text read from it): 1 where a clock in the picture goes with
    the video (up to four times as fast), 0.75 for time and date, 0.4 for one of them, 0 for none or where the middle
    frame shows neither. A segment's samples are a handful."""
    one = F.struct("i", "at", M.clock_seconds(F.col("text")).alias("times"), M.has_date(F.col("text")).alias("dated"))
    groups = samples.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("xs"))
    xs = F.col("xs")
    middle = F.get(xs, F.floor(F.size(xs) / 2).cast("int"))
    blank = (F.size(middle["times"]) == 0) & ~middle["dated"]
    goes = lambda x, y: F.exists(x["times"], lambda a: F.exists(y["times"], lambda b: (b > a) & (b - a <= 4 * (y["at"] - x["at"]) + 2)))
    runs = F.exists(xs, lambda x: F.exists(xs, lambda y: (y["i"] > x["i"]) & (y["at"] - x["at"] >= 1.0) & goes(x, y)))
    time, date = F.exists(xs, lambda x: F.size(x["times"]) > 0), F.exists(xs, lambda x: x["dated"])
    score = F.when(blank, 0.0).when(runs, 1.0).when(time & date, 0.75).when(time | date, 0.4).otherwise(0.0)
    return groups.select(*keys, score.alias("ts_score"))


def score_segments(segments: DataFrame, probe: bool = False) -> DataFrame:
    """segments (p_visual, ts_score, eff_fps, fps, gray_ratio) with prob, label and reasons: what speaks for a surveillance
    camera, each with its weight."""
    p, ts, eff, fps, gray = (F.col(c) for c in ("p_visual", "ts_score", "eff_fps", "fps", "gray_ratio"))
    said = lambda text, v: F.concat(text, F.format_string(" (%+.1f)", v))
    clock = F.when(ts >= 1, "clock goes with the video (+4.0)").when(ts >= 0.75, "date and time (+3.0)").when(ts >= 0.4, "date or time (+1.5)")
    slow = F.when((fps >= 23) & (eff <= 16), F.format_string("true rate about %.0f (+1.5)", eff))
    reasons = F.array(said(F.format_string("looks like a camera %.2f", p), F.lit(8.0 if probe else 5.0) * (p - 0.5)), clock, slow, F.when(gray >= 0.5, "no colour (+0.5)"))
    prob = M.segment_prob(M.segment_evidence(p, ts, eff, fps, gray, probe))
    return segments.withColumns({"prob": prob, "label": M.segment_label(prob), "reasons": F.array_join(F.array_compact(reasons), "; ")})


def middle_first(place: Column, size: Column) -> Column:
    """Sort key: the middle one, then the others in order."""
    return F.struct((place != F.floor(size / 2)).cast("int").alias("other"), place.alias("place"))


def empty_streak_stop(rows: DataFrame, key: str, order: str, new: str, limit: int) -> DataFrame:
    """rows up to the ``limit``-th fruitless one in a row (``new`` = 0), which ends a scan."""
    w = Window.partitionBy(key).orderBy(order)
    hits = rows.withColumn("_h", F.sum((F.col(new) > 0).cast("int")).over(w))
    streak = hits.withColumn("_s", F.sum((F.col(new) <= 0).cast("int")).over(Window.partitionBy(key, "_h").orderBy(order)))
    ended = F.coalesce(F.max((F.col("_s") >= limit).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return streak.withColumn("_e", ended).filter("_e = 0").drop("_h", "_s", "_e")


def even_subsample(rows: DataFrame, key: str, place: str, k: int) -> DataFrame:
    """Of each key's rows, numbered by place from 0, k evenly spread ones with the first and the last; all where there are fewer."""
    counted = rows.withColumn("_c", F.count(place).over(Window.partitionBy(key)))
    steps = [F.bround(F.lit(j) * (F.col("_c") - 1) / F.lit(max(1, k - 1)), 0) for j in range(k)]
    return counted.filter((F.col("_c") <= k) | F.array_contains(F.array(*steps), F.col(place).cast("double"))).drop("_c")
