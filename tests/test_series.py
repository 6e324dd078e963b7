"""As-of joins, state machines, keyed streams, stored pages and staged writes against plain Python and their batch forms."""

import datetime as dt
import os
import random
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reelsieve.operators import asof, machine
from reelsieve.sources import paged, staged
from reelsieve.streaming import keyed

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(ms):
    return T0 + dt.timedelta(milliseconds=ms)


@pytest.mark.parametrize("bucket", [0.5, 7.0, 1e6])
def test_latest_before(spark, bucket):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", "hot", "hot", None]), rng.choice([None, *[float(x) for x in range(40)]]), i) for i in range(200)]
    targets = [(rng.choice(["a", "b", "hot", "none", None]), rng.choice([None, -1.0, 0.0, 3.5, 17.0, 39.0, 100.0]), i) for i in range(60)]
    got = asof.latest_before(spark.createDataFrame(targets, "s string, t double, id int"), spark.createDataFrame(rows, "s string, ts double, no int"), "s", "t", "ts", "no", bucket)
    assert got.columns == ["s", "t", "id", "found"]
    got = {r.id: r.found and (r.found.ts, r.found.no) for r in got.collect()}
    for s, t, i in targets:
        fits = [(u, n) for k, u, n in rows if k == s and None not in (k, u, t) and u <= t]
        assert got[i] == max(fits, default=None)
    assert len(got) == len(targets)


def test_sampled_fingerprints(spark):
    h = "{:016x}".format
    frames = [(1, i, float(i), h(i), 9.0 if i % 2 else 1.0) for i in range(10)]
    frames += [(2, i, float(i), None if i < 6 else h(i), None) for i in range(10)] + [(3, 0, 0.0, h(1), 9.0)] + [(4, i, 8.0 + i, h(i), 5.0) for i in range(3)]
    videos = [(1, 10.0), (1, 4.0), (2, 10.0), (3, 0.49), (4, 10.0), (5, 10.0), (6, None)]
    df = spark.createDataFrame(frames, "id int, no int, at double, h string, edge double")
    got = {r.id: (r.thumbnail, r.fingerprint, r.informative) for r in asof.sampled_fingerprints(spark.createDataFrame(videos, "id int, duration double"), df, bucket=3.0).collect()}
    assert got[1] == (h(5), ":".join(h(i) for i in (1, 3, 5, 7, 9)), [True] * 5)
    assert got[2] == (None, None, []) and got[3] == (None, None, []) and got[5] == (None, None, []) and got[6] == (None, None, [])
    assert got[4] == (None, None, [])  # one frame at 90 %
    three = asof.sampled_fingerprints(spark.createDataFrame([(2, 20.0)], "id int, duration double"), df).first()
    assert three.fingerprint == ":".join([h(6), h(9), h(9), h(9)]) and three.informative == [False] * 4 and three.thumbnail == h(9)


@pytest.mark.parametrize("per_part", [100_000, 9])
def test_machine(spark, per_part):
    rng = random.Random(6)
    m = machine.Machine(("a", "b", "c", "end"), {"x": {"a": "b", "b": "c", "c": "end"}, "y": {"b": "a", "c": "a"}, "z": {"a": "c"}})
    rows = [(rng.choice(["hot", "hot", "k1", "k2", None]), rng.randrange(300), rng.choice(["x", "y", "z", "?", None]), i) for i in range(400)] + [("one", 1, "x", 400)]
    got = machine.run(spark.createDataFrame([(*r, "old") for r in rows], "k string, t int, x string, id int, before string").repartition(3), m, "k", ["t"], "x", per_part)
    assert got.columns == ["k", "t", "x", "id", "before", "after"]
    seen = {}
    for r in got.collect():
        seen.setdefault(r.k, []).append(r)
    assert sum(map(len, seen.values())) == len(rows)
    for k, mine in seen.items():
        state, want = "a", Counter()
        for _, t, x in sorted(((x is not None, t, x or "") for kk, t, x, _ in rows if kk == k), key=lambda r: (r[1], r[0], r[2])):
            after = m.moves.get(x, {}).get(state, state)
            want[t, x, state, after] += 1
            state = after
        assert Counter((r.t, r.x or "", r.before, r.after) for r in mine) == want


def test_machine_of_no_rows(spark):
    assert machine.login_states(spark.createDataFrame([], "platform string, at long, outcome string")).collect() == []


def _stream(spark, tmp_path, parts, schema, op, out_schema, late="2 hours"):
    """Rows of op over a stream of the parts, a file each, with a new start after every second one."""
    here, made = f"{tmp_path}/in", f"{tmp_path}/out"
    os.makedirs(here)
    keyed.keep_in_rocksdb(spark)
    for i in range(0, len(parts), 2):
        for k, part in enumerate(parts[i : i + 2]):
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(here)
        df = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(here).withWatermark("at", late)
        op(df).writeStream.format("parquet").option("path", made).option("checkpointLocation", f"{tmp_path}/progress").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out_schema).parquet(made)


def _plain_retries(rows):
    out, by = [], {}
    for camera, t, ok in rows:
        by.setdefault(camera, []).append((t, ok))
    for camera, mine in by.items():
        since, pause, due, tries = None, 600_000, None, 0
        for t, ok in sorted(mine):
            if due is not None and due <= t:
                out.append((camera, due, "due", None, tries))
                due = None
            if due is not None:
                out.append((camera, t, "early", due - t, tries))
                continue
            if since is None or t - since >= 43_200_000:
                since, pause, tries = t, 600_000, 0
            if ok:
                out.append((camera, t, "captured", None, tries + 1))
                since, tries = None, 0
            else:
                tries, due = tries + 1, t + pause
                out.append((camera, t, "failed", pause, tries))
                pause = min(2 * pause, 43_200_000)
    return out


def test_capture_retries(spark, tmp_path):
    rng = random.Random(8)
    hours = 3_600_000
    rows = [(c, t, rng.random() < 0.15) for c, span in (("a", 40), ("b", 400), ("c", 2000)) for t in rng.sample(range(0, span * hours, 60_000), 90)]
    rows += [("fails", k * 600_000, False) for k in range(300)]
    schema = "camera string, at timestamp, ok boolean"
    batch = keyed.capture_retries(spark.createDataFrame([(c, at(t), ok) for c, t, ok in rows] + [(None, at(0), True), ("x", None, True)], schema)).collect()
    base = int(T0.timestamp() * 1000)
    want = sorted((c, t, o, p or 0, n) for c, t, o, p, n in _plain_retries(rows))
    assert sorted((r.camera, r.at - base, r.outcome, r.pause or 0, r.tries) for r in batch) == want
    assert {r.outcome for r in batch} == {"captured", "failed", "early", "due"}

    # the same as a stream in files of an hour-wise jumble, a late row that is dropped, and a last row that moves the watermark
    line = sorted(((c, at(t), ok) for c, t, ok in rows), key=lambda r: r[1] + dt.timedelta(minutes=rng.randrange(50)))
    parts = [line[k : k + 120] for k in range(0, len(line), 120)]
    parts.insert(3, [*parts.pop(3), ("late", at(0), True)])
    parts += [[("zz", at(9000 * hours), True)], [("zz", at(9100 * hours), True)]]
    got = _stream(spark, tmp_path, parts, schema, keyed.capture_retries, keyed.RETRY).filter("camera <> 'zz'").collect()
    ends = {c: max(t for k, t, _ in rows if k == c) for c in {r[0] for r in rows}}
    # the clock goes on after a table's last rows
    assert sorted((r.camera, r.at - base, r.outcome, r.pause or 0, r.tries) for r in got if not (r.outcome == "due" and r.at - base > ends[r.camera])) == want
    assert "late" not in {r.camera for r in got}


def _plain_batches(rows, size, stop):
    by = {}
    for s, t, no, url, known in rows:
        by.setdefault(s, []).append((t, no, url, known))
    out = []
    for s, mine in by.items():
        met, given, streak = set(), 0, 0
        for _, _, url, known in sorted(mine):
            if url in met:
                continue
            met.add(url)
            streak = streak + 1 if known else 0
            if not known:
                out.append((s, given // size, given, url, False))
                given += 1
            if streak >= stop:
                out.append((s, None, given, None, True))
                break
    return sorted(map(repr, out))


def test_fixed_batches(spark, tmp_path):
    rng = random.Random(12)
    rows = [(s, 60_000 * k, k, f"u{rng.randrange(150)}", rng.random() < p) for s, p in (("a", 0.3), ("b", 0.6), ("c", 0.0), ("d", 1.0)) for k in range(200)]
    schema = "source string, at timestamp, no long, url string, known boolean"
    data = [(s, at(t), n, u, k) for s, t, n, u, k in rows]
    for size, stop in ((10, 3), (7, 5), (1000, 100)):
        got = keyed.fixed_batches(spark.createDataFrame(data + [(None, at(0), 0, "u", False), ("e", at(0), 0, None, False)], schema), size, stop).collect()
        assert sorted(repr(tuple(r)) for r in got) == _plain_batches(rows, size, stop)
    parts = [sorted(data, key=lambda r: r[1])[k : k + 130] for k in range(0, len(data), 130)]
    parts += [[("zz", at(10**9), 0, "u", False)], [("zz", at(2 * 10**9), 1, "v", False)]]
    got = _stream(spark, tmp_path, parts, schema, lambda df: keyed.fixed_batches(df, 10, 3), keyed.BATCHES, "1 minute").filter("source <> 'zz'").collect()
    assert sorted(repr(tuple(r)) for r in got) == _plain_batches(rows, 10, 3)


def test_paged_listing(spark, tmp_path):
    store, made = f"{tmp_path}/store", f"{tmp_path}/made"

    def add(ids, url):
        spark.createDataFrame([(i, url(i)) for i in ids], "page_id long, url string").write.mode("append").parquet(store)

    def scan(**more):
        df = paged.paged_listing(spark, stream=True, path=store, key="page_id", same="url", columns="page_id long, url string", size="10", **more)
        df.writeStream.format("parquet").option("path", made).option("checkpointLocation", f"{tmp_path}/progress").trigger(availableNow=True).start().awaitTermination()
        return sorted((r.page, r.page_id) for r in spark.read.schema(df.schema).parquet(made).collect())

    add(range(35), lambda i: f"u{i}")
    first = [(i // 10, i) for i in range(30)]  # the fourth page is not whole yet
    assert scan() == first
    add(range(35, 40), lambda i: f"u{i}")
    add(range(40, 60), lambda i: f"u{i % 10 + 30}")  # the site repeats its last page
    want = [(i // 10, i) for i in range(40)]
    assert scan() == want and scan() == want
    add(range(60, 65), lambda i: f"u{i}")
    assert scan() == want
    whole = paged.paged_listing(spark, path=store, key="page_id", same="url", columns="page_id long, url string", size="10", tail="true")
    assert sorted(r.page_id for r in whole.collect()) == [*range(40), *range(60, 65)]


def test_staged_write(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "id long, x string"
    assert staged.published(spark, path, schema).collect() == []
    staged.publish(spark.range(100).select("id", F.lit("a").alias("x")).repartition(3), path)
    assert staged.published(spark, path, schema).count() == 100

    fails = spark.range(10).select("id", F.when(F.col("id") == 9, F.raise_error(F.lit("no"))).otherwise("b").alias("x"))
    with pytest.raises(Exception):
        staged.publish(fails, path)
    assert staged.published(spark, path, schema).count() == 100 and os.listdir(f"{path}/_staging") == []
    staged.publish(spark.createDataFrame([], schema), path)
    staged.publish(spark.range(5).select("id", F.lit("c").alias("x")), path)
    assert Counter(r.x for r in staged.published(spark, path, schema).collect()) == {"a": 100, "c": 5}
    assert spark.read.schema(schema).parquet(path).count() == 105  # and nothing else lies there


def test_staged_write_survives_a_failed_task(tmp_path):
    """A task that fails after it wrote leaves no rows; its next attempt's are there once."""
    code = f"""
import os
from pyspark.sql import functions as F
from reelsieve.session import session
from reelsieve.sources import staged
spark = session("local[2,3]", 2)
def rows(batches):
    from pyspark import TaskContext
    for b in batches:
        yield b
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
        raise ValueError("first attempt")
df = spark.range(0, 1000, 1, 3).mapInArrow(rows, "id long")
staged.publish(df, "{tmp_path}/t")
got = staged.published(spark, "{tmp_path}/t", "id long")
assert got.count() == 1000 == got.distinct().count()
assert os.listdir("{tmp_path}/t/_staging") == []
print("as it should be")
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env=os.environ)
    assert "as it should be" in done.stdout, done.stderr[-2000:]
