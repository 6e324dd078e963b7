"""Merkle manifests against a plain tree, for groups of every ragged size, nulls, repeats and many partitions."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from reelsieve.llm import merkle

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    texts = [None if v is None else str(v) for v in values]
    return h("-" if t is None else f"{len(t.encode())}:{t}" for t in texts)


def tree(nodes, fan):
    """The root, and for each node its path: place and others of each level."""
    under, paths = [[k] for k in range(len(nodes))], [[] for _ in nodes]
    while len(nodes) > 1:
        runs = [range(a, min(a + fan, len(nodes))) for a in range(0, len(nodes), fan)]
        for run in runs:
            for k in run:
                for x in under[k]:
                    paths[x].append((k - run[0], "".join(nodes[j] for j in run if j != k)))
        nodes, under = [h(nodes[k] for k in run) for run in runs], [[x for k in run for x in under[k]] for run in runs]
    return nodes[0], paths


def plain(rows, fan=8):
    groups = {}
    for d, s, lang, n, t in rows:
        groups.setdefault(lang, []).append((d is not None, d or 0, leaf(d, s, lang, n, t), d))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops = {}
    for g in order:
        groups[g].sort(key=lambda r: r[:3])
        tops[g] = tree([r[2] for r in groups[g]], fan)
    root, above = tree([tops[g][0] for g in order], fan)
    return sorted((repr(r[3]), r[2], tops[g][0], root, repr(p + up)) for g, up in zip(order, above) for r, p in zip(groups[g], tops[g][1]))


def corpus():
    rng = random.Random(5)
    sizes = {"en": 700, "de": 65, "fr": 64, "eé": 9, "Z": 8, None: 7, "": 1, "a": 2, "b": 1, "c": 1, "d": 1}
    rows = [(None, f"s{i % 3}" if i % 5 else None, g, None if i % 7 == 0 else i, None if i % 11 == 0 else "Text é " * (i % 4)) for g, n in sizes.items() for i in range(n)]
    ids = rng.sample(range(-1000, 5000), len(rows))
    rows = [(None if i % 50 == 3 else d, *r[1:]) for i, (d, r) in enumerate(zip(ids, rows))]
    return rows + [rows[0]] * 40 + [(None, None, None, None, None)] * 3


@pytest.mark.parametrize("fan, per_part", [(8, 100_000), (8, 40), (3, 7)])
def test_manifest(spark, fan, per_part):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS + ", LEAF string, root int").repartition(5)
    got = merkle.manifest(df, keep=("doc_id", "lang", "LEAF", "root"), fan=fan, rows_per_part=per_part)
    assert got.columns == ["doc_id", "lang", "leaf", "subroot", "root", "proof"]
    checked = got.select("*", merkle.fold(F.col("leaf"), F.col("proof")).alias("up"), merkle.proof_digest(F.col("proof")).alias("said")).collect()
    assert sorted((repr(r.doc_id), r.leaf, r.subroot, r.root, repr([(s.at, s.others) for s in r.proof])) for r in checked) == plain(rows, fan)
    assert all(r.up == r.root and r.said == h(s.others for s in r.proof) for r in checked)


def test_tampering(spark, tmp_path):
    rows = [(i, "s", "en" if i % 3 else None, i, t) for i, t in enumerate(["Ab", "ab", None, "", "ÉA"] * 8)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in merkle.query(spark, str(tmp_path)).collect()}
    for i, _, _, _, t in rows:
        hit = zlib.crc32(str(i).encode()) % 3 == 0 and (t or "") != (t or "").replace("A", "a")
        assert got[i].verified == (not hit) == (got[i].folded_root == got[i].root)


def test_empty_and_one(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS)).collect() == []
    (r,) = merkle.manifest(spark.createDataFrame([(1, None, "en", 0, "x" * 300_000)], DOCS)).collect()
    assert r.leaf == r.subroot == r.root == leaf(1, None, "en", 0, "x" * 300_000) and r.proof == []
