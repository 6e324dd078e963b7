"""Structured Streaming twins: event-time windows, first-seen rows, the funnel by micro-batch, keyed visit state."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from reelsieve.functions.text import broadcast_key
from reelsieve.operators.asof import latest_before
from reelsieve.operators.spread import cut
from reelsieve.plans.catalog import BACKOFF_HOURS, BACKOFF_MAX_HOURS, STREAK_LIMIT


def event_time(df: DataFrame, ts: str, late: str) -> DataFrame:
    """ts as an event time with a watermark (a timestamp without zone is taken as UTC, the session's zone)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def tumbling(df: DataFrame, ts: str, size: str, by: list[str], slide: str | None = None) -> DataFrame:
    """start, by, n, total of value: tumbling windows, or sliding ones with slide. The same for batches and streams."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return df.groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), *by, "n", "total")


def sessions(df: DataFrame, ts: str, gap: str, key: str) -> DataFrame:
    return df.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_seen(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key within the watermark."""
    return df.dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)


def unseen(batch: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return batch.dropDuplicates([key]).join(known.select(key), key, "left_anti")


def by_batch(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """step(batch, number) for each micro-batch; once: for what is there now, then end."""
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


VISIT_STATE = "visits int, empty_streak int, backoff_until double, last_visit double, last_video_at double"


def visit_states(visits: DataFrame) -> DataFrame:
    """Stream of visits (platform, label, got, at) -> state rows after each micro-batch, kept by platform and label."""

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, streak, until, last, video = state.get if state.exists else (0, 0, 0.0, 0.0, 0.0)
        rows = pd.concat(list(parts)).sort_values(["at", "got"])
        for got, at in zip(rows["got"], rows["at"]):
            n, last = n + 1, float(at)
            if got:
                streak, until, video = 0, 0.0, float(at)
            else:
                streak += 1
                if streak >= STREAK_LIMIT:
                    until = at + 3600.0 * min(BACKOFF_HOURS * 2 ** min(streak - STREAK_LIMIT, 30), BACKOFF_MAX_HOURS)
        state.update((n, streak, float(until), last, video))
        yield pd.DataFrame([[*key, n, streak, float(until), last, video]], columns=["platform", "label", "visits", "empty_streak", "backoff_until", "last_visit", "last_video_at"])

    return visits.groupBy("platform", "label").applyInPandasWithState(update, f"platform string, label string, {VISIT_STATE}", VISIT_STATE, "update", GroupStateTimeout.NoTimeout)


def _passing(runs: DataFrame, key: str, at: str, seconds: float) -> DataFrame:
    """key, at of the events let through in runs (key, run, at), by pointer doubling: each event points to the first one that
    would be let through after it, and in each round twice as many of a run's are reached."""
    w = Window.partitionBy(key, "run").orderBy(at)
    nodes = cut(runs.select(F.to_json(F.struct(key, "run")).alias("s"), key, at, F.row_number().over(w).alias("n")))
    asked = nodes.select("s", "n", (-(F.col(at) + seconds)).alias("t"))
    there = nodes.select("s", (-F.col(at)).alias("t"), (-F.col("n")).alias("no"))
    jump = latest_before(asked, there, "s", "t", "t", "no", 8 * seconds).filter("found IS NOT NULL").select("s", "n", (-F.col("found.no")).alias("m"))
    jump, reached = cut(jump), nodes.filter("n = 1").select("s", "n")
    while True:
        new = cut(reached.join(jump, ["s", "n"]).select("s", F.col("m").alias("n")).join(reached, ["s", "n"], "left_anti"))
        if new.isEmpty():
            return nodes.join(reached, ["s", "n"], "left_semi").select(key, at)
        reached = cut(reached.unionByName(new))
        jump = cut(jump.join(jump.select("s", F.col("n").alias("m"), F.col("m").alias("far")), ["s", "m"]).select("s", "n", F.col("far").alias("m")))


def cooled_down(events: DataFrame, key: str, at: str, seconds: float, fold_rows: int = 100_000) -> DataFrame:
    """Events of a key, as (key, at), that are let through: the first one, and each that comes ``seconds`` or more after the
    last one let through. For a stream the time is kept by key, for a table it is folded in order, a
    key with over ``fold_rows`` events by its runs without a pause, and a run of over so many found by pointer doubling; rows come in order of time. A throttle of messages and the pause of a camera after a hit are this."""

    def step(rows: pd.DataFrame, last: float | None) -> tuple[list[float], float | None]:
        passed = []
        for t in sorted(rows[at].tolist()):
            if last is None or t >= last + seconds:
                passed.append(t)
                last = t
        return passed, last

    schema = f"{key} {events.schema[key].dataType.simpleString()}, {at} double"
    rows = events.select(key, F.col(at).cast("double").alias(at))

    def update(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        passed, last = step(pd.concat(list(parts)), state.get[0] if state.exists else None)
        if last is not None:
            state.update((last,))
        yield pd.DataFrame({key: [k[0]] * len(passed), at: passed})

    if rows.isStreaming:
        return rows.groupBy(key).applyInPandasWithState(update, schema, "last double", "append", GroupStateTimeout.NoTimeout)
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = batch.column(1).value_lengths().to_numpy(zero_copy_only=False).cumsum().tolist()
            times = batch.column(1).flatten().to_numpy(zero_copy_only=False).tolist()
            owner, passed, i = [], [], 0
            for no, end in enumerate(ends):
                while i < end:
                    owner.append(no)
                    passed.append(times[i])
                    i = bisect_left(times, times[i] + seconds, i + 1, end)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), pa.array(passed, pa.float64())], [key, at])

    def folded(part: DataFrame, by: list[str]) -> DataFrame:
        """Each group is one row, its times in order: many small groups are folded in one batch."""
        return part.groupBy(*by).agg(F.sort_array(F.collect_list(at)).alias("ts")).select(key, "ts").mapInArrow(fold, schema)

    many = cut(rows.groupBy(key).agg(F.count(at).alias("n")).filter(F.col("n") > fold_rows).select(key))
    if many.isEmpty():
        return folded(rows, [key])
    mine = F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}"))
    few = folded(rows.alias("a").join(many.alias("b"), mine, "left_anti"), [key])
    # after a pause of that length the next event is let through whatever came before: the runs of a key with many events
    # between such pauses are folded on their own
    w = Window.partitionBy(key).orderBy(at)
    fresh = F.coalesce(F.col(at) - F.lag(at).over(w) >= seconds, F.lit(True)).cast("long")
    runs = cut(rows.alias("a").join(many.alias("b"), mine, "left_semi").filter(F.col(at).isNotNull()).withColumn("run", F.sum(fresh).over(w)))
    long = cut(runs.groupBy(key, "run").agg(F.count(at).alias("n")).filter(F.col("n") > fold_rows).select(key, "run"))
    same = mine & (F.col("a.run") == F.col("b.run"))
    short = folded(runs.alias("a").join(long.alias("b"), same, "left_anti"), [key, "run"])
    if long.isEmpty():
        return few.unionByName(short)
    return few.unionByName(short).unionByName(_passing(runs.alias("a").join(long.alias("b"), same, "left_semi"), key, at, seconds))


def new_broadcasts(batch: DataFrame, known: DataFrame) -> DataFrame:
    """batch (url, channel, title) with status: 'known' for a url that was checked before, 'duplicate_broadcast' for a
    channel that showed this title before, else 'new'. Within the batch the first url of a broadcast is new."""
    mine = batch.dropDuplicates(["url"]).withColumn("key", broadcast_key(F.col("channel"), F.col("title")))
    urls = known.select("url", F.lit(True).alias("seen")).distinct()
    shown = known.select(broadcast_key(F.col("channel"), F.col("title")).alias("key")).filter("key IS NOT NULL").distinct().withColumn("shown", F.lit(True))
    first = mine.join(urls, "url", "left_anti").filter("key IS NOT NULL").groupBy("key").agg(F.min("url").alias("first"))
    joined = mine.join(urls, "url", "left").join(shown, "key", "left").join(first, "key", "left")
    again = F.col("shown") | (F.col("key").isNotNull() & (F.col("url") != F.col("first")))
    return joined.select("url", "channel", "title", F.when(F.col("seen"), "known").when(again, "duplicate_broadcast").otherwise("new").alias("status"))
