"""Table-driven cases, properties against plain Python, and streams against their batch twins."""

import random

import pytest
from pyspark.sql import functions as F

from reelsieve.functions import hashing as H
from reelsieve.functions import identity as I
from reelsieve.functions import media as M
from reelsieve.functions import text as X
from reelsieve.operators import detection, graph, joins, scheduling, segments
from reelsieve.sources import adapters, paged, readers, sinks
from reelsieve.streaming import streams

URLS = [
    ("https://facebook.com/watch?v=123", ("facebook", "video", "123")),
    ("https://facebook.com/groups/g/videos/123/?ido=g", ("facebook", "video", "123")),
    ("https://facebook.com/reel/123", ("facebook", "reel", "123")),
    ("https://youtube.com/watch?v=dQw4w9WgXcQ", ("youtube", "video", "dQw4w9WgXcQ")),
    ("https://youtube.com/shorts/dQw4w9WgXcQ", ("youtube", "short", "dQw4w9WgXcQ")),
    ("https://tiktok.com/@user/video/7123456789", ("tiktok", "video", "7123456789")),
    ("https://instagram.com/reel/AbC-1_x", ("instagram", "reel", "AbC-1_x")),
    ("https://x.com/user/status/1789", ("x", "post", "1789")),
    ("https://reddit.com/r/sub/comments/1a2b3c/title", ("reddit", "post", "1a2b3c")),
    ("https://vimeo.com/123456", ("vimeo", "video", "123456")),
    ("https://dailymotion.com/video/x8abcd", ("dailymotion", "video", "x8abcd")),
    ("https://evil.com/?ref=facebook.com", None),
    (None, None),
]


def test_canonical_ids(spark):
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(URLS)], "i int, u string")
    got = {r.i: r for r in I.with_identity(df, "u").collect()}
    for i, (_, want) in enumerate(URLS):
        assert (got[i].platform, got[i].object_type, got[i].object_id) == (want or (None, None, None))


def test_labels_and_hashtags(spark):
    pairs = [("Road Accident", "RoadAccident", True), ("GunRobber", "Gun-toting robber", True), ("Smok", "Smoke", True), ("Riot", "Arson", False), ("", "Arson", False)]
    df = spark.createDataFrame(pairs, "a string, b string, want boolean")
    assert all(r.got == r.want for r in df.select("want", X.same_label(F.col("a"), F.col("b")).alias("got")).collect())
    tags = spark.createDataFrame([("CCTV Trộm Cửa Hàng",), ("กล้องวงจรปิด ขโมย",), ("viral",), (None,)], "t string")
    assert [r[0] for r in tags.select(X.to_hashtag("t")).collect()] == ["cctvtromcuahang", "กล้องวงจรปิดขโมย", None, None]


def test_hashes(spark):
    df = spark.createDataFrame([("ffffffffffffffff", "0000000000000000"), ("zz", "0000000000000000"), (None, "00")], "a string, b string")
    assert [r[0] for r in df.select(H.hash_distance(F.col("a"), F.col("b"))).collect()] == [64, 64, 64]
    fps = spark.createDataFrame([("ff00000000000000:zz:0000000000000001",)], "f string")
    r = fps.select(F.size(H.parse_fingerprint(F.col("f"))), H.parse_fingerprint(F.col("f"), strict=True)).first()
    assert r[0] == 2 and r[1] is None


def test_cross_matches(spark):
    df = spark.sql("SELECT array(0L, 255L, 1L) AS a, array(true, true, false) AS ok, array(3L, 1023L, -1L) AS b")
    assert df.select(H.cross_matches(F.col("a"), F.col("ok"), F.col("b"), 2)).first()[0] == 2


@pytest.mark.parametrize("radius", [0, 3, 6, 7, 9, 12])
def test_hamming_join_is_exact(spark, radius):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(30)]
    values = [b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(radius + 3))) & (2**64 - 1) for b in base for _ in range(6)]
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    df = spark.createDataFrame(list(enumerate(signed)), "i int, v long")
    got = joins.hamming_join(df.select(F.col("i").alias("a"), F.col("v").alias("x")), df.select(F.col("i").alias("b"), F.col("v").alias("y")), "x", "y", radius).filter("a < b")
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if bin(values[i] ^ values[j]).count("1") <= radius}
    rows = [(r.a, r.b) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_share_join(spark):
    df = spark.createDataFrame([(i, float(d)) for i, d in enumerate([0, 1, 5, 80, 95, 100, 119, 121, 500])], "i int, d double")
    got = joins.share_join(df.select(F.col("i").alias("a"), F.col("d").alias("x")), df.select(F.col("i").alias("b"), F.col("d").alias("y")), "x", "y", 0.2)
    ds = [r.d for r in df.orderBy("i").collect()]
    assert {(r.a, r.b) for r in got.collect()} == {(i, j) for i, x in enumerate(ds) for j, y in enumerate(ds) if 0.8 * x <= y <= 1.2 * x}


def test_graph(spark):
    rng = random.Random(5)
    edges = sorted({tuple(sorted(rng.sample(range(60), 2))) for _ in range(45)})
    root = list(range(60))
    for _ in range(60):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: root[n] for e in edges for n in e}
    able = {n: n % 7 > 0 for n in range(60)}
    accepted = set()
    for n in range(60):
        if able[n] and not any(a in accepted for a, b in edges if b == n):
            accepted.add(n)
    nodes = spark.createDataFrame(list(able.items()), "seq long, eligible boolean")
    rows = graph.first_accepted(nodes, spark.createDataFrame(edges, "earlier long, later long")).collect()
    assert {r.seq for r in rows if r.accepted} == accepted
    assert all(r.blocked_by == min((a for a, b in edges if b == r.seq and a in accepted), default=None) for r in rows if not r.accepted)


def test_long_chains(spark):
    """A chain takes no round for each link; larger components than one task takes go on in rounds."""
    nodes = spark.range(3000).select(F.col("id").alias("seq"), F.lit(True).alias("eligible"))
    chain = spark.range(2999).select(F.col("id").alias("earlier"), (F.col("id") + 1).alias("later"))
    assert [r.seq for r in graph.first_accepted(nodes, chain).filter("accepted").orderBy("seq").collect()] == list(range(0, 3000, 2))
    few = chain.filter("earlier < 25")
    rows = graph.first_accepted(nodes.filter("seq < 26"), few, rounds=3, most_edges=6).filter("accepted").orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(0, 26, 2))
    assert graph.components(few).agg(F.max("root")).first()[0] == 0


def test_empty_graph(spark):
    none = spark.createDataFrame([], "a long, b long")
    assert graph.components(none).count() == 0


def test_scores_and_rates(spark):
    r = spark.sql("SELECT '30000/1001' AS a, '0/0' AS b, '500/1' AS c").select(F.round(M.parse_rate(F.col("a")), 2), M.parse_rate(F.col("b")), M.parse_rate(F.col("c")), M.frame_rate(F.col("b"), F.col("c"))).first()
    assert tuple(r) == (29.97, None, None, 25.0)
    hours = spark.createDataFrame([(n,) for n in (2, 3, 4, 5, 6, 7)], "n int").select(M.backoff_hours(F.col("n"))).collect()
    assert [h[0] for h in hours] == [None, 6.0, 12.0, 24.0, 48.0, 48.0]
    assert spark.sql("SELECT 1920 AS w, 1080 AS h, 1080 AS w2, 1920 AS h2").select(M.is_portrait(F.col("w"), F.col("h")), M.is_portrait(F.col("w2"), F.col("h2"))).first() == (False, True)


def test_visits_batch_equals_stream(spark, tmp_path):
    rng = random.Random(2)
    rows = [("p", f"l{rng.randrange(4)}", rng.random() < 0.2, float(t)) for t in range(60)]
    df = spark.createDataFrame(rows, "platform string, label string, got boolean, at double")
    batch = {r.label: (r.visits, r.empty_streak) for r in scheduling.visit_state(df.withColumn("event_id", F.col("at")), ["platform", "label"], ["at", "event_id"]).collect()}
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = streams.visit_states(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("visits").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination(90)
    assert {r.label: (r.visits, r.empty_streak) for r in spark.table("visits").collect()} == batch


def test_funnel_by_batch(spark, tmp_path):
    spark.range(20).select(F.concat(F.lit("u"), (F.col("id") % 7).cast("string")).alias("url")).coalesce(1).write.parquet(str(tmp_path / "in"))
    known, out = spark.createDataFrame([("u1",)], "url string"), str(tmp_path / "out")
    s = spark.readStream.schema("url string").parquet(str(tmp_path / "in"))
    q = streams.by_batch(s, lambda b, n: streams.unseen(b, known, "url").write.mode("append").parquet(out), str(tmp_path / "cp"))
    q.awaitTermination(90)
    assert {r.url for r in spark.read.parquet(out).collect()} == {f"u{i}" for i in range(7)} - {"u1"}


def test_sources(spark, tmp_path):
    (tmp_path / "live.tsv").write_text("u1\ti1\tt1\tc1\nu2\ti2\tt2\n")
    rows = readers.read_tsv(spark, str(tmp_path / "live.tsv"), readers.LIVE).orderBy("url").collect()
    assert [r.channel_id for r in rows] == ["c1", ""]
    (tmp_path / "cams.txt").write_text("# note\n\n'rtsp://a'\nrtsp://b\n")
    assert sorted(r.line for r in readers.read_lines(spark, str(tmp_path / "cams.txt")).collect()) == ["rtsp://a", "rtsp://b"]
    values = spark.createDataFrame([('{"a": 1}',), ("{'a': 1}",), ("garbage(",)], "v string")
    assert [r.decoded for r in readers.decode_values(values, "v").collect()] == ['{"a": 1}', '{"a": 1}', None]
    spark.range(25).select(F.col("id").alias("position"), (F.lit(30.0) + 17 * F.col("id")).alias("duration")).write.parquet(f"{tmp_path}/listing")
    stored = paged.paged_listing(spark, path=f"{tmp_path}/listing", key="position", same="position", columns="position long, duration double", size="10", limit="15")
    assert stored.rdd.getNumPartitions() == 2 and stored.count() == 15
    page = stored.filter("duration <= 100 AND page < 9")
    assert page.count() == 5 and "duration" not in page._jdf.queryExecution().executedPlan().toString().split("Filter")[1].split("\n")[0]
    measured = adapters.measure(page.select("position"), lambda r: {"half": 10 // (r["position"] - 1)}, "half long").orderBy("position").collect()
    assert measured[1].half is None and "ZeroDivisionError" in measured[1].error and measured[2].half == 10
    with pytest.raises(ValueError):
        adapters.classifier("none")


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "downloaded", "Riot"), (2, "dup_l2", "Arson")], "id int, outcome string, category string")
    sinks.write_routed(rows, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).filter("outcome = 'dup_l2'").first().id == 2
    assert sinks.markdown(rows.orderBy("id")).splitlines()[2] == "| 1 | downloaded | Riot |"
    boxes = spark.createDataFrame([("a", 2, 1, 0.5, 0.5, 0.1, 0.1), ("a", 1, 0, 0.25, 0.5, 0.1, 0.1)], "image string, no int, cls int, x double, y double, w double, h double")
    assert sinks.label_lines(boxes, "image").first().text.splitlines()[0] == "0 0.250000 0.500000 0.100000 0.100000"


def test_class_condition_errors(spark):
    with pytest.raises(ValueError):
        detection.class_condition(F.array(F.lit(1)), [])


def test_streak_cut(spark):
    items = spark.createDataFrame([("s", i, k) for i, k in enumerate([True, True, False, True, True, True, False])], "s string, i int, k boolean")
    assert [r.i for r in segments.streak_cut(items, "s", "i", "k", 3).orderBy("i").collect()] == [0, 1, 2, 3, 4, 5]


@pytest.mark.parametrize("chunk", [1, 3, 7, 4096])
@pytest.mark.parametrize("min_len", [1, 3, 5])
def test_shot_ends_by_chunks(spark, chunk, min_len):
    """Chunks of any size give what a fold over the whole series gives, and no longer list is collected."""
    rng = random.Random(17)
    series = {k: [rng.choice([0.0, 50.0, 60.0, 90.0, None]) if k else 99.0 for _ in range(rng.randrange(1, 60))] for k in range(25)}
    want = set()
    for k, vs in series.items():
        cuts = [0]
        for i, v in enumerate(vs):
            if i and v is not None and v >= 60 and i - cuts[-1] >= min_len:
                cuts.append(i)
        want.add((k, len(cuts), cuts[-1]))
    df = spark.createDataFrame([(k, i, v) for k, vs in series.items() for i, v in enumerate(vs)], "k long, i int, v double")
    assert {tuple(r) for r in segments.shot_ends(df, "k", "i", "v", min_len, 60.0, chunk).collect()} == want


def test_state_round_trip(spark, tmp_path):
    """A broken or missing file is empty state, a string is the older form, a save takes the file's place whole."""
    from reelsieve.sources import state

    assert state.read_state(spark, f"{tmp_path}/none.json").count() == 0
    path = tmp_path / "s.json"
    path.write_text("{broken")
    assert state.read_state(spark, str(path)).count() == 0
    path.write_text('{"x": {"current": "Riot", "labels": {"Riot": {"empty_streak": 4, "backoff_until": 9000.0}, "Smoke": {}}}, "reddit": "Abuse"}')
    for _ in range(2):
        got = state.read_state(spark, str(path))
        assert sorted((r.platform, r.current, len(r.labels)) for r in got.collect()) == [("reddit", "Abuse", 0), ("x", "Riot", 2)]
        assert [(r.label, r.empty_streak) for r in state.labels_of(got).filter("empty_streak > 0").collect()] == [("Riot", 4)]
        assert [tuple(r) for r in state.hours_left(got, 1800.0).collect()] == [("x", "Riot", 2.0)]
        state.save_state(got, str(path))
    assert path.is_file() and not (tmp_path / "s.json.tmp").exists()


def test_cooled_down_stream_equals_batch(spark, tmp_path):
    rng = random.Random(12)
    rows = sorted(((k, float(rng.randrange(400))) for k in "abc" for _ in range(40)), key=lambda r: r[1])
    want = set()
    for k in "abc":
        last = None
        for t in sorted(t for q, t in rows if q == k):
            if last is None or t >= last + 60:
                want.add((k, t))
                last = t
    df = spark.createDataFrame(rows, "cam string, at double")
    for fold_rows in (100_000, 5):
        assert sorted(tuple(r) for r in streams.cooled_down(df, "cam", "at", 60, fold_rows).collect()) == sorted(want)
    for i in range(3):
        spark.createDataFrame(rows[40 * i : 40 * i + 40], "cam string, at double").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    out = set()
    source = spark.readStream.schema("cam string, at double").option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    q = streams.by_batch(streams.cooled_down(source, "cam", "at", 60), lambda b, _: out.update(tuple(r) for r in b.collect()), f"{tmp_path}/ck")
    q.awaitTermination()
    assert out == want


def test_middle_first_and_crops(spark):
    rows = spark.range(5).select(F.col("id").alias("i")).orderBy(segments.middle_first(F.col("i"), F.lit(5)))
    assert [r.i for r in rows.collect()] == [2, 0, 1, 3, 4]
    d = spark.createDataFrame([("a", 0, 1, 0.5, 0.5, 0.2, 0.2), ("a", 1, 1, 0.51, 0.5, 0.2, 0.2), ("a", 2, 2, 0.1, 0.1, 0.1, 0.1), ("a", 3, 1, 0.99, 0.99, 0.3, 0.3)], "image string, no int, cls int, x double, y double, w double, h double")
    sizes = spark.createDataFrame([("a", 100, 200)], "image string, width int, height int")
    got = detection.crop_boxes(d, sizes, "image", [1], 0.7, (10, 10), (1, 2, 3, 4)).orderBy("no").collect()
    assert [tuple(r) for r in got] == [("a", 0, 37, 79, 64, 122), ("a", 3, 81, 167, 100, 200)]


def test_dct_hash_brute_force(spark):
    import math

    rng = random.Random(14)
    tiles = [[rng.uniform(0, 255) for _ in range(1024)] for _ in range(6)] + [[float(k % 32 * 8) for k in range(1024)]]
    rows = [(i, t) for i, t in enumerate(tiles)] + [(90, None), (91, [1.0] * 10)]
    got = {r.i: r.h for r in spark.createDataFrame(rows, "i int, p array<double>").select("i", H.dct_hash(F.col("p")).alias("h")).collect()}
    assert got[90] is None and got[91] is None
    for i, t in enumerate(tiles[:6]):
        low = [sum(t[32 * y + x] * math.cos(math.pi * (2 * y + 1) * u / 64) * math.cos(math.pi * (2 * x + 1) * v / 64) for y in range(32) for x in range(32)) for u in range(8) for v in range(8)]
        middle = (sorted(low)[31] + sorted(low)[32]) / 2
        bits = "".join("1" if x > middle else "0" for x in low)
        assert got[i] == f"{int(bits, 2):016x}"
    near = [v + rng.uniform(-2, 2) for v in tiles[0]]
    h = spark.createDataFrame([(near,)], "p array<double>").select(H.dct_hash(F.col("p"))).first()[0]
    assert bin(int(h, 16) ^ int(got[0], 16)).count("1") <= 6 < bin(int(got[1], 16) ^ int(got[0], 16)).count("1")


def test_cross_validation_measures_what_it_holds_out(spark):
    from reelsieve.operators import probe

    rng = random.Random(15)
    rows = [([rng.gauss(4.0 * (i % 2), 1), rng.gauss(0, 1)], i % 2, i // 4) for i in range(400)]
    df = spark.createDataFrame(rows, "v array<double>, y int, file int")
    got = {r.metric: (r.mean, r["std"]) for r in probe.cross_validate(df, "v", "y", "file").collect()}
    assert set(got) == {"accuracy", "precision", "recall"} and all(0.93 <= m <= 1 and s < 0.06 for m, s in got.values())
    noise = spark.createDataFrame([(v, rng.randrange(2), f) for v, _, f in rows], "v array<double>, y int, file int")
    assert 0.35 <= {r.metric: r.mean for r in probe.cross_validate(noise, "v", "y", "file").collect()}["accuracy"] <= 0.65
    folds = probe.group_folds(df, "file", 5)
    assert folds.groupBy("file").agg(F.countDistinct("fold").alias("n")).filter("n > 1").count() == 0


def test_overwrite_by_the_last_change(spark):
    from reelsieve.operators import tables

    store = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "k int, x string, n int")
    changes = spark.createDataFrame([(1, "old", 10, 1), (1, None, 11, 2), (2, "z", None, 5), (9, "q", 0, 1)], "k int, x string, n int, at int")
    got = tables.overwrite_matched(store, changes, "k", ["x", "n"], "at")
    assert sorted(map(tuple, got.collect())) == [(1, None, 11), (2, "z", None), (3, "c", 3)]
    assert tables.overwrite_matched(store, changes, "k", ["x"]).count() == 3


def test_hamming_links(spark):
    rng = random.Random(16)
    seeds = [rng.getrandbits(63) for _ in range(12)]
    rows = [(i, seeds[0] if i < 60 else rng.choice(seeds) ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(5)))) for i in range(150)] + [(900, None)]
    edges = joins.hamming_links(spark.createDataFrame(rows, "id long, h long"), "id", "h", 3)
    got = {r.node: r.root for r in graph.components(edges).collect()}
    root = {i: i for i, _ in rows}
    for _ in range(len(rows)):
        for i, a in rows:
            for j, b in rows:
                if None not in (a, b) and bin(a ^ b).count("1") <= 3:
                    root[i] = root[j] = min(root[i], root[j])
        if all(root[root[i]] == root[i] for i in root):
            break
    assert all(got.get(i, i) == root[i] for i in root) and edges.count() < 500
