"""Queries with an SQL twin on tables with keys, repeats and sums that the test data has not."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F
from test_queries import TABLES, plain

from reelsieve.plans import registry


@pytest.fixture
def tables(sf, tmp_path):
    """Writes a folder of tables, some of them replaced by SQL over the others."""

    def make(**changed: str) -> str:
        c = duckdb.connect()
        for t in TABLES:
            if os.path.exists(f"{sf}/{t}.parquet"):
                c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
                if t not in changed:
                    os.symlink(f"{sf}/{t}.parquet", tmp_path / f"{t}.parquet")
        for t, sql in changed.items():
            c.execute(f"COPY ({sql}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        return str(tmp_path)

    return make


def same_as_sql(spark, folder: str, name: str) -> list:
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{folder}/{t}.parquet"):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    df, twin = registry.queries()[name](spark, folder), c.sql(registry.oracle_sql()[name])
    cols = sorted(df.columns)
    ours = sorted(repr(tuple(map(plain, r))) for r in df.select(*cols).collect())
    theirs = sorted(repr(tuple(map(plain, r))) for r in twin.project(", ".join(f'"{x}"' for x in cols)).fetchall())
    assert ours == theirs
    return ours


def test_sizes_beyond_a_terabyte(spark, tables):
    folder = tables(orders="SELECT * REPLACE (o_custkey + 900000 AS o_custkey) FROM orders")
    assert any(re.search(r"\d{4}\.\d GB", r) for r in same_as_sql(spark, folder, "formats"))


def test_pages_of_one_url(spark, tables):
    """A third of the pages are known, and others have their urls."""
    folder = tables(pages="SELECT page_id + i * 1000001 AS page_id, url, html FROM pages, range(3) r(i)")
    assert len(same_as_sql(spark, folder, "fingerprint_append")) == 100


def test_a_busy_slot(spark, tables):
    """Orders enough for the slot to be busy for over half of the time."""
    folder = tables(orders="SELECT (o_orderkey + i * 100000) * 3 AS o_orderkey, o_custkey - o_custkey % 600 + 599 AS o_custkey, o_orderstatus, o_totalprice, TIMESTAMP '1997-01-01' AS o_orderdate, o_orderpriority FROM orders, range(700) r(i)")
    assert any("'idle'" in r for r in same_as_sql(spark, folder, "report_warnings"))


PARTS = "SELECT p_partkey + i * 1000001 AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part, range(3) r(i)"


def test_phrases_are_read_in_full_once_for_a_label(spark, tables):
    from reelsieve.plans.discovery_queries import parse_per_label

    folder = tables(part=PARTS)
    assert same_as_sql(spark, folder, "parse_per_label")
    plan = parse_per_label(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("Aggregate") :]
    assert "array_position" in plan and "array_position" not in below  # repeats are looked for above the last line of each label


def test_labels_are_split_once_for_a_name(spark, tables):
    from reelsieve.plans.identity_queries import same_label_join

    folder = tables(part=PARTS)
    assert same_as_sql(spark, folder, "same_label_join")
    plan = same_label_join(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    pairs = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "array_except" in pairs and "(?<=[a-z])" not in pairs and "Generate" not in plan


def test_crops_over_batches(spark, tables):
    """The same corners by the map that is solved in columns; none for corners in a line or with a null."""
    from reelsieve.functions import geometry

    folder = tables(lineitem="SELECT * REPLACE (l_orderkey + i * 1000001 AS l_orderkey) FROM lineitem, range(3) r(i)")
    assert same_as_sql(spark, folder, "slanted_crops")
    names = [("ax", "ay"), ("bx", "b_y"), ("cx", "cy"), ("dx", "dy")]
    rows = [(1, 0.0, 0.0, 9.0, 1.0, 8.0, 7.0, 1.0, 6.0), (2, 0.0, 0.0, 1.0, 1.0, 2.0, 2.0, 3.0, 3.0), (3, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), (4, None, 0.0, 9.0, 1.0, 8.0, 7.0, 1.0, 6.0)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} double" for xy in names for c in xy))
    points = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in names])
    m = geometry.homography(points, geometry.crop_size(points))
    back = [F.bround(geometry.project(m, F.col(x), F.col(y))[c], 6).cast("long") for x, y in names for c in ("x", "y")]
    want = {r.id: r.b for r in df.select("id", F.array(*back).alias("b")).collect()}
    got = {r.id: r.corners for r in geometry.corners_in_crop(df, ["id"], names).collect()}
    assert got == want and want[2] == [None] * 8 and want[1][0] == 0


def test_overlaps_of_images_of_any_size(spark):
    """Against a plain scan, images of over 256 boxes too, which are settled box by box."""
    import random

    from reelsieve.operators.detection import priority_overlap
    from reelsieve.plans.catalog import CLASS_PRIORITY

    rng = random.Random(5)
    names = [*CLASS_PRIORITY, "person"]
    rows = [(i, rng.choice(names), float(rng.randrange(60)), float(rng.randrange(30)), 8.0 + rng.randrange(4), 8.0 + rng.randrange(4), rng.randrange(20) / 20) for i, n in enumerate([1, 2, 7, 40, 256, 257, 400]) for _ in range(n)]

    def ratio(a, b):
        wide, high = (max(0.0, min(a[c] + a[s] / 2, b[c] + b[s] / 2) - max(a[c] - a[s] / 2, b[c] - b[s] / 2)) for c, s in ((2, 4), (3, 5)))
        return wide * high / (a[4] * a[5] + b[4] * b[5] - wide * high)

    want = []
    for image in {r[0] for r in rows}:
        kept = []
        for r in sorted((r for r in rows if r[0] == image), key=lambda r: (-r[6], *r[1:6])):
            hit = next((k for k in kept if ratio(r, k) > 0.4), None)
            if hit is not None:
                mine, theirs = CLASS_PRIORITY.get(r[1], 0), CLASS_PRIORITY.get(hit[1], 0)
                if mine < theirs or mine == theirs and r[6] <= hit[6]:
                    continue
                kept.remove(hit)
            kept.append(r)
        want += kept
    df = spark.createDataFrame(rows, "image int, class_name string, x double, y double, w double, h double, conf double")
    assert sorted(map(tuple, priority_overlap(df, "image", 0.4).collect())) == sorted(want)


def test_small_groups_of_a_throttle_are_folded_together(spark):
    from reelsieve.streaming import streams

    df = spark.createDataFrame([(k, float(t)) for k in range(300) for t in (0, 3, 5, 5, 9, 20)] + [(None, 1.0), (None, 2.0)], "k int, at double")
    out = streams.cooled_down(df, "k", "at", 5.0)
    got = sorted((-1 if r.k is None else r.k, r.at) for r in out.collect())
    assert got == [(-1, 1.0)] + [(k, t) for k in range(300) for t in (0.0, 5.0, 20.0)]
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().optimizedPlan().toString()
