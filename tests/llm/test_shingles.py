"""Near copies in large bands, against plain sets."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from reelsieve.llm import shingles


def test_large_bands_lose_no_link(spark, monkeypatch):
    """Texts of two kinds share every band, and link within their kind only: a star links those of one centre's kind."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for kind in range(4):
        for i in range(15):
            rows.append((len(rows), [*base, *(f"k{kind}x{j}" for j in range(14)), f"own{rng.random()}"]))
    df = spark.createDataFrame([(n, " ".join(ws)) for n, ws in rows], "node long, text string")
    monkeypatch.setattr(shingles, "band_keys", lambda texts, width: texts.select("node", F.size(F.split("text", " ")).alias("n"), F.lit(1).cast("long").alias("band")))
    monkeypatch.setattr(shingles, "TILE", 16)
    links = {(r.u, r.v) for r in shingles.similar_pairs(df, 3, 0.8).collect()}
    where = {n: n for n, _ in rows}
    for u, v in sorted(links):
        old, new = where[u], where[v]
        where = {n: new if c == old else c for n, c in where.items()}
    assert len(set(where.values())) == 4
    assert all(where[a] == where[b] for a in where for b in where if a // 15 == b // 15)


def test_tiles_give_a_forest_not_pairs(spark, monkeypatch):
    """300 texts of one band, none linked to the star's centre, but each alike to all others of its kind: links grow with
    the texts, not with the square, and tile by tile they connect the same texts as all pairs do."""
    base = [f"w{i}" for i in range(30)]
    texts = [[f"c{i}" for i in range(60)]] + [[*base, *(f"k{kind}x{j}" for j in range(30)), f"own{i}"] for kind in range(3) for i in range(100)]
    df = spark.createDataFrame([(n, " ".join(ws)) for n, ws in enumerate(texts)], "node long, text string")
    large = df.select(F.lit(1).cast("long").alias("band"), "node", F.col("node").alias("root"), F.size(F.split("text", " ")).alias("n"))
    nothing = large.select("node", "root").limit(0)
    for tile in (512, 64):
        monkeypatch.setattr(shingles, "TILE", tile)
        links = [(r.u, r.v) for r in shingles._apart(df, large, nothing, 3, 0.8).collect()]
        tiles = -(-len(texts) // tile)
        assert len(links) < len(texts) * tiles
        where = list(range(len(texts)))
        for u, v in links:
            where = [where[v] if c == where[u] else c for c in where]
        assert all((where[i] == where[j]) == (i == j or min(i, j) > 0 and (i - 1) // 100 == (j - 1) // 100) for i in range(len(texts)) for j in range(len(texts)))


def test_forest_against_plain_sets():
    import numpy as np

    rng = np.random.default_rng(5)
    for turn in range(40):
        core = rng.integers(0, 60, 30)
        sets = [np.unique(np.r_[core[: rng.integers(20, 31)], rng.integers(0, 60, rng.integers(0, 6))]).astype(np.int64) for _ in range(20)]
        root, ours = rng.integers(0, 12, 20), rng.random(20) < 0.5
        theirs = ours if turn % 2 else ~ours
        pairs = {(i, j) for i in range(20) for j in range(20) if i != j and ours[i] and theirs[j] and root[i] != root[j]}
        pairs = {(i, j) for i, j in pairs if (n := len(np.intersect1d(sets[i], sets[j]))) >= 0.8 * (len(sets[i]) + len(sets[j]) - n)}
        u, v = shingles.near_forest(sets, root, ours, theirs, 0.8)
        got = list(zip(u.tolist(), v.tolist()))
        assert all((i, j) in pairs or (j, i) in pairs for i, j in got)
        labels = []
        for links in (pairs, got):
            where = list(range(20))
            for i, j in links:
                where = [where[j] if c == where[i] else c for c in where]
            labels.append({frozenset(k for k in range(20) if where[k] == w) for w in where})
        assert labels[0] == labels[1]
