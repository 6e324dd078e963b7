"""Keyed operators with timers and kept rows, for streams; each has a batch form that gives the same rows.

Rows of a key are kept until the watermark has passed them and then taken in order, so a stream gives what its rows give in
order of time, however they are split into micro-batches and wherever it is stopped and started again. Rows behind the
watermark are dropped by Spark, as in every stream with one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from reelsieve.plans.catalog import RETRY_FIRST_S, RETRY_MOST_S

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_in_rocksdb(spark: SparkSession) -> None:
    """The state store that kept lists and timers need, for streams started from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


# --- capture retries ---------------------------------------------------------------------------------------------------

#: outcome: 'captured', 'failed' (pause: milliseconds until the next try), 'early' (before it, not tried) or 'due' (a try is due at this time).
RETRY = "camera string, at long, outcome string, pause long, tries int"
_FIRST, _MOST = RETRY_FIRST_S * 1000, RETRY_MOST_S * 1000


class Retry:
    """One camera's tries. A failed one is repeated after a pause that doubles up to its most; a try that long after the
    first failure starts over with the first pause, and counts anew. A success ends the tries. Times are milliseconds."""

    def __init__(self, since: int = -1, pause: int = _FIRST, due: int = -1, tries: int = 0):
        self.since, self.pause, self.due, self.tries = since, pause, due, tries

    @property
    def kept(self) -> tuple:
        return self.since, self.pause, self.due, self.tries

    def pass_time(self, now: int) -> list[tuple]:
        """Rows (at, outcome, pause, tries) that the clock alone gives up to now."""
        if 0 <= self.due <= now:
            at, self.due = self.due, -1
            return [(at, "due", None, self.tries)]
        return []

    def take(self, at: int, ok: bool) -> list[tuple]:
        out = self.pass_time(at)
        if self.due > at:
            return [*out, (at, "early", self.due - at, self.tries)]
        if self.since < 0 or at - self.since >= _MOST:
            self.since, self.pause, self.tries = at, _FIRST, 0
        self.tries += 1
        if ok:
            out.append((at, "captured", None, self.tries))
            self.since, self.tries = -1, 0
            return out
        self.due = at + self.pause
        out.append((at, "failed", self.pause, self.tries))
        self.pause = min(2 * self.pause, _MOST)
        return out


def _retry_rows(camera, out: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({"camera": [camera] * len(out), "at": [r[0] for r in out], "outcome": [r[1] for r in out], "pause": pd.array([r[2] for r in out], dtype="Int64"), "tries": [r[3] for r in out]})


class RetryProcessor(StatefulProcessor):
    """Kept: rows that the watermark hasn't passed, and where the tries stand. Timers: the next kept row, the next due try,
    and, after a longest pause without anything, the end of the camera's state (a later failure starts over anyway)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "at long, ok boolean")
        self.tries = handle.getValueState("tries", "since long, pause long, due long, tries int")

    def _set_timer(self, at: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(at)

    def _advance(self, key, rows: list[tuple], now: int) -> Iterator[pd.DataFrame]:
        retry = Retry(*map(int, self.tries.get())) if self.tries.exists() else Retry()
        passed, left = [r for r in rows if r[0] <= now], [r for r in rows if r[0] > now]
        out = [x for at, ok in sorted(passed) for x in retry.take(at, ok)] + retry.pass_time(now)
        if passed or len(left) != len(rows):
            self.rows.put(left) if left else self.rows.clear()
        self.tries.update(retry.kept)
        times = [r[0] for r in left] + [retry.due] * (retry.due > now)
        if times:
            self._set_timer(min(times))
        elif out:
            self._set_timer(now + _MOST)
        else:
            self.tries.clear()
        if out:
            yield _retry_rows(key[0], out)

    def _kept_rows(self) -> list[tuple]:
        return [(int(a), bool(k)) for a, k in self.rows.get()] if self.rows.exists() else []

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [(int(a.value // 10**6), bool(k)) for part in rows for a, k in zip(pd.to_datetime(part["at"]), part["ok"])]
        self.rows.appendList(new)
        self._set_timer(min([a for a, _ in new] + [int(t) for t in self.handle.listTimers()]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, self._kept_rows(), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def capture_retries(attempts: DataFrame) -> DataFrame:
    """camera, at (milliseconds), outcome, pause, tries from attempts (camera, at: timestamp, ok). Null ok counts as a failure;
    rows without camera or time are left out; of equal times failures come first. A table gives the rows of a stream that
    ends with its last try: what is due after a camera's last row is not said."""
    rows = attempts.filter("camera IS NOT NULL AND at IS NOT NULL").select("camera", "at", F.coalesce("ok", F.lit(False)).alias("ok"))
    if rows.isStreaming:
        return rows.groupBy("camera").transformWithStateInPandas(RetryProcessor(), RETRY, "Append", "EventTime")
    ms = rows.select("camera", F.unix_millis(F.col("at").cast("timestamp")).alias("t"), "ok")
    # a success ends a camera's tries if it isn't early, and a gap of the longest pause starts them over: after such a gap a
    # run begins, and it is folded on its own
    w = Window.partitionBy("camera").orderBy("t", "ok")
    fresh = F.coalesce(F.col("t") - F.lag("t").over(w) >= _MOST, F.lit(True)).cast("long")
    runs = ms.withColumn("run", F.sum(fresh).over(w)).withColumn("next", F.lead("t").over(w))

    def fold(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        retry, out = Retry(), []
        for at, ok in sorted(zip(part["t"].tolist(), part["ok"].tolist())):
            out += retry.take(int(at), bool(ok))
        after = part.sort_values(["t", "ok"])["next"].iloc[-1]
        if not pd.isna(after):
            out += retry.pass_time(int(after))
        return _retry_rows(key[0], out)

    return runs.groupBy("camera", "run").applyInPandas(fold, RETRY)


# --- batches of a fixed size -----------------------------------------------------------------------------------------

#: pos counts a source's new urls from 0. A row without batch and url marks the end of a source's scan, pos being its urls.
BATCHES = "source string, batch long, pos long, url string, last boolean"


class BatchProcessor(StatefulProcessor):
    """Kept: urls met, rows that the watermark hasn't passed, urls waiting for a whole batch, and the counts."""

    def __init__(self, size: int, stop: int, idle_ms: int):
        self.size, self.stop, self.idle = size, stop, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.met = handle.getMapState("met", "url string", "one boolean")
        self.rows = handle.getListState("rows", "at long, no long, url string, known boolean")
        self.waiting = handle.getListState("waiting", "url string")
        self.counts = handle.getValueState("counts", "given long, streak int, ended boolean")

    def _set_timer(self, at: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.counts.exists() and self.counts.get()[2]:
            return
        new = [(int(a.value // 10**6), int(n), u, bool(k)) for part in rows for a, n, u, k in zip(pd.to_datetime(part["at"]), part["no"], part["url"], part["known"])]
        self.rows.appendList(new)
        self._set_timer(min([r[0] for r in new] + [int(t) for t in self.handle.listTimers()]))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        rows = [(int(a), int(n), u, bool(k)) for a, n, u, k in self.rows.get()] if self.rows.exists() else []
        given, streak, ended = self.counts.get() if self.counts.exists() else (0, 0, False)
        waiting = [r[0] for r in self.waiting.get()] if self.waiting.exists() else []
        passed, left = sorted(r for r in rows if r[0] <= now), [r for r in rows if r[0] > now]
        for _, _, url, known in passed:
            if self.met.containsKey((url,)):
                continue
            self.met.updateValue((url,), (True,))
            streak = streak + 1 if known else 0
            if not known:
                waiting.append(url)
            if streak >= self.stop:
                ended = True
                break
        quiet = not passed and not left  # the timer was that of a quiet source
        whole = len(waiting) if ended or quiet else len(waiting) // self.size * self.size
        out = waiting[:whole]
        if out:
            pos = list(range(given, given + whole))
            # a quiet source's part of a batch is filled up by what comes later
            yield pd.DataFrame({"source": key[0], "batch": pd.array([p // self.size for p in pos], dtype="Int64"), "pos": pos, "url": out, "last": False})
        given += whole
        if ended:
            yield pd.DataFrame({"source": [key[0]], "batch": pd.array([None], dtype="Int64"), "pos": [given], "url": [None], "last": [True]})
        waiting = waiting[whole:]
        self.counts.update((given, int(streak), bool(ended)))
        self.waiting.put([(u,) for u in waiting]) if waiting else self.waiting.clear()
        self.rows.put(left) if left and not ended else self.rows.clear()
        if ended:
            self.met.clear()
        elif left:
            self._set_timer(min(r[0] for r in left))
        elif waiting and not quiet:
            self._set_timer(max(now, passed[-1][0] if passed else now) + self.idle)

    def close(self) -> None:
        pass


def fixed_batches(links: DataFrame, size: int = 100, stop: int = 5, idle_seconds: int = 30) -> DataFrame:
    """source, batch, pos, url, last from links (source, at, no, url, known) in order of at and no: each new url of a source
    once, cut to batches of exactly ``size``. The scan of a source ends with the ``stop``-th known url in a row: what waits
    then is its last batch, which may be smaller, and a row marks the end. A source that is quiet for ``idle_seconds`` gives
    what waits, and goes on filling the same batch. Repeated urls count once; rows without source, time or url are left
    out, a null ``known`` is false."""
    rows = links.filter("source IS NOT NULL AND at IS NOT NULL AND url IS NOT NULL").select("source", "at", "no", "url", F.coalesce("known", F.lit(False)).alias("known"))
    if rows.isStreaming:
        return rows.groupBy("source").transformWithStateInPandas(BatchProcessor(size, stop, idle_seconds * 1000), BATCHES, "Append", "EventTime")
    first = rows.groupBy("source", "url").agg(F.min(F.struct(F.unix_millis(F.col("at").cast("timestamp")).alias("t"), "no", "known")).alias("f")).select("source", "url", "f.*")
    w = Window.partitionBy("source").orderBy("t", "no", "url")
    runs = first.withColumn("run", F.sum((~F.col("known")).cast("long")).over(w))
    in_run = Window.partitionBy("source", "run").orderBy("t", "no", "url")
    streaks = runs.withColumn("stops", F.sum(F.col("known").cast("long")).over(in_run) >= stop)
    past = F.coalesce(F.max("stops").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    kept = streaks.withColumn("past", past).filter("NOT past")
    new = kept.filter("NOT known").select("source", (F.row_number().over(w) - 1).cast("long").alias("pos"), "url")
    ends = kept.groupBy("source").agg(F.count(F.when(~F.col("known"), 1)).alias("pos"), F.max("stops").alias("last")).filter("last")
    given = new.select("source", F.floor(F.col("pos") / size).alias("batch"), "pos", "url", F.lit(False).alias("last"))
    return given.unionByName(ends.select("source", F.lit(None).cast("long").alias("batch"), "pos", F.lit(None).cast("string").alias("url"), "last"))
