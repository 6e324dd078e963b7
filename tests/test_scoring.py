"""Scores, domain rules, samples, slanted crops, enrichment and the tracker's tables against plain Python."""

import math
import random
import sqlite3
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelsieve.functions import geometry
from reelsieve.operators import domains, sampling, scoring
from reelsieve.sources import enrich, tracker


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_zero_shot(spark, block_bytes):
    rng = random.Random(3)
    vec = lambda: [rng.gauss(0, 1) for _ in range(6)]
    prompts = [(f"c{k % 9}", vec()) for k in range(40)] + [("c1", None), ("c2", [0.0] * 6)]
    protos = scoring.prototypes(spark.createDataFrame(prompts, "c string, v array<double>"), "c", "v")
    known = {r.cls: np.array(r.vector) for r in protos.collect()}
    for c, p in known.items():
        unit = [np.array(v) / np.linalg.norm(v) for k, v in prompts if k == c and v and any(v)]
        mean = np.mean(unit, axis=0)
        assert np.allclose(p, mean / np.linalg.norm(mean))
    rows = [(i, vec()) for i in range(50)] + [(50, None), (51, [1.0] * 5), (52, [0.0] * 6), (53, [None] + [1.0] * 5)]
    twice = protos.unionByName(protos.filter("cls = 'c0'").withColumn("cls", F.lit("c00")))  # a tie
    got = {r.id: r.scores for r in scoring.zero_shot(spark.createDataFrame([(*r, 1) for r in rows], "id int, v array<double>, SCORES int").repartition(3), "v", twice, 30.0, 4, block_bytes).collect()}
    known["c00"] = known["c0"]
    for i, v in rows:
        if i >= 50:
            assert got[i] is None
            continue
        x = np.array(v) / np.linalg.norm(v)
        e = {c: math.exp(30 * float(x @ p)) for c, p in known.items()}
        want = sorted(((-s / sum(e.values()), c) for c, s in e.items()))[:4]
        assert [s.cls for s in got[i]] == [c for _, c in want] and all(abs(s.prob + p) < 1e-9 for s, (p, _) in zip(got[i], want))
    assert all(r.scores is None for r in scoring.zero_shot(spark.createDataFrame(rows[:3], "id int, v array<double>"), "v", protos.limit(0)).collect())


def test_probe_prob(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],), (None,)], "v array<double>")
    assert [r[0] and round(r[0], 9) for r in df.select(scoring.probe_prob(F.col("v"), [0.5, -1.0], 0.25)).collect()] == [round(1 / (1 + math.exp(1.25)), 9), None, None]


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_match_domains(spark, broadcast_rows):
    rng = random.Random(5)
    hosts = [".".join(rng.choice("abc") for _ in range(rng.randrange(1, 4))) + ".com" for _ in range(300)] + ["A.COM"] * 200 + [None, "", ".", "com", "xcom", "b.net"]
    rules = [("com", 1), (".a.com", 2), ("A.com", 3), ("b.c.com", 4), ("a.b.c.com", 5), (None, 6), ("", 7), (".", 8), ("net", None)]
    got = domains.match_domains(spark.createDataFrame(list(enumerate(hosts)), "id int, h string"), "h", spark.createDataFrame(rules, "domain string, n int"), "domain", broadcast_rows)
    assert got.columns == ["id", "h", "rule"]
    got = {r.id: r.rule for r in got.collect()}
    assert len(got) == len(hosts)
    for i, h in enumerate(hosts):
        bare = (h or "").lower().lstrip(".")
        fits = [(len(d.lstrip(".")), d, n) for d, n in rules if d and d.lstrip(".") and bare and (bare == d.lower().lstrip(".") or bare.endswith("." + d.lower().lstrip(".")))]
        best = max((f[0] for f in fits), default=None)
        assert (got[i] and tuple(got[i])) == min((f[1:] for f in fits if f[0] == best), default=None)


def test_sample(spark):
    rows = [(f"g{i % 3}", i, float(i % 5)) for i in range(300)] + [("small", 900, 1.0), (None, 901, 1.0), ("g0", 902, None)]
    df = spark.createDataFrame(rows, "g string, id int, w double")
    for weight in (None, "w"):
        one = sampling.sample(df.repartition(1), ["g"], "id", 10, 4, weight)
        assert one.columns == df.columns
        sets = [sorted(map(repr, x.collect())) for x in (one, sampling.sample(df.repartition(7), ["g"], "id", 10, 4, weight))]
        assert sets[0] == sets[1] and Counter(r.g for r in one.collect()) == {"g0": 10, "g1": 10, "g2": 10, "small": 1, None: 1}
    assert not [r for r in sampling.sample(df, ["g"], "id", 100, 4, "w").collect() if not r.w]
    heavy = spark.createDataFrame([(s, i, 9.0 if i < 10 else 1.0) for s in range(200) for i in range(100)], "g int, i int, w double").withColumn("id", F.col("g") * 1000 + F.col("i"))
    first = sampling.sample(heavy, ["g"], "id", 1, 1, "w").filter("i < 10").count()
    assert 75 <= first <= 125  # half of the weight
    order = [r.id for r in sampling.shuffled(df, "id", 3).collect()]
    assert sorted(order) == sorted(r[1] for r in rows) and order != sorted(order) and order == [r.id for r in sampling.shuffled(df.repartition(5), "id", 3).collect()]


def test_homography(spark):
    rng = random.Random(7)
    quads = [[(x + rng.uniform(-3, 3), y + rng.uniform(-3, 3)) for x, y in ((0, 0), (w, 0), (w, h), (0, h))] for w, h in [(40, 20), (20, 60), (33, 33)] * 5]
    quads += [[(0, 0), (10, 0), (10, 5), (0, 5)], [(0, 0), (1, 1), (2, 2), (3, 3)], [(5, 5)] * 4]
    df = spark.createDataFrame([(i, [tuple(map(float, p)) for p in q]) for i, q in enumerate(quads)], "id int, p array<struct<x:double,y:double>>")
    sized = df.withColumn("s", geometry.crop_size(F.col("p"))).withColumn("m", geometry.homography(F.col("p"), F.col("s"))).withColumn("turned", geometry.is_upright_text(F.when(F.col("s.width") > 0, F.col("s"))))
    for r in sized.collect():
        q = np.array(quads[r.id], float)
        side = lambda a, b: np.linalg.norm(q[a] - q[b])
        w, h = int(max(side(0, 1), side(2, 3))), int(max(side(0, 3), side(1, 2)))
        assert (r.s.width, r.s.height) == (w, h)
        if r.id >= len(quads) - 2:
            assert r.m is None
            continue
        assert r.turned == (h / w >= 1.5)
        target = [(0, 0), (w, 0), (w, h), (0, h)]
        rows, right = [], []
        for (x, y), (u, v) in zip(q, target):
            rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
            right += [u, v]
        assert np.allclose(r.m, [*np.linalg.solve(np.array(rows), np.array(right)), 1], atol=1e-9)


def test_in_chunks(spark, tmp_path):
    log = f"{tmp_path}/log"

    def fetch(ids):
        with open(log, "a") as f:
            f.write(f"{len(ids)} {ids[0] if ids else ''}\n")
        if 25 in ids:
            raise TimeoutError
        return {i: {"even": i % 2 == 0} for i in ids if i != 3}

    rows = [(i, i * 10) for i in range(47)] + [(None, 470)]
    df = spark.createDataFrame([(*r, "x") for r in random.Random(1).sample(rows, 48)], "id long, at int, EVEN string").drop("EVEN").repartition(5)
    got = enrich.in_chunks(df, "id", fetch, "even boolean", ["at"], size=10)
    assert got.columns == ["id", "at", "even", "checked"]
    rows_out = {r.id: (r.even, r.checked) for r in got.collect()}
    assert rows_out == {i: (None, False) if i is not None and 20 <= i < 30 else (None if i in (3, None) else i % 2 == 0, True) for i, _ in rows}
    assert sorted(open(log).read().split("\n")[:-1]) == ["10 0", "10 10", "10 20", "10 30", "7 40"]
    # of the first 3 * 6 keys the even ones, all of a failed request, and never more than asked for
    first = enrich.first_kept(df.unionByName(df), "id", fetch, "even boolean", "even", ["at"], limit=6, size=10).collect()
    assert [r.id for r in first] == [0, 2, 4, 6, 8, 10]
    assert [r.id for r in enrich.first_kept(df.filter("id >= 20"), "id", fetch, "even boolean", "even", ["at"], limit=12, size=10).collect()] == [*range(20, 30), 30, 32]
    assert enrich.in_chunks(df.limit(0), "id", fetch, "even boolean", ["at"]).collect() == []


def test_tracker(spark, tmp_path):
    path = f"{tmp_path}/t.db"
    db = sqlite3.connect(path)
    db.execute("CREATE TABLE urls (id INTEGER PRIMARY KEY, url TEXT, status TEXT, size REAL)")
    db.executemany("INSERT INTO urls VALUES (?, ?, ?, ?)", [(i * 3, f"u{i}", ["new", "done", None][i % 3], i / 2) for i in range(100)])
    db.commit()
    db.close()
    cols = "id long, url string, status string, size double"
    df = tracker.tracker(spark, path, "urls", cols, parts=4)
    assert df.count() == 100 and df.rdd.getNumPartitions() == 4
    some = df.filter("status = 'done' AND id > 30 AND url LIKE '%4%' AND size <= 40").select("url")
    want = sorted(f"u{i}" for i in range(100) if i % 3 == 1 and i * 3 > 30 and "4" in f"u{i}" and i / 2 <= 40)
    assert sorted(r.url for r in some.collect()) == want
    reader = tracker.TrackerReader({"path": path, "table": "urls"}, ["url"])
    assert list(reader.pushFilters([tracker.EqualTo(("status",), "done"), tracker.In(("id",), (3, 12)), tracker.IsNotNull(("url",))])) == []
    assert sorted(r for p in reader.partitions() for r in reader.read(p)) == [("u1",), ("u4",)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter" in plan and "status" not in plan.split("Filter")[1].split("\n")[0]  # the database answers that part
    assert df.filter("status IS NULL").count() == 33
    for p, t, c in ((f"{tmp_path}/none.db", "urls", cols), (path, "absent", cols), (path, "urls", "id long, missing string")):
        got = tracker.tracker(spark, p, t, c)
        assert got.count() == 0 or c != cols and [r.missing for r in got.limit(1).collect()] in ([], ["missing"])
