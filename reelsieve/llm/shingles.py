"""Near-copies by exact similarity: texts whose sets of word shingles have a Jaccard similarity of a bound or more.

Candidates share a band of ``ROWS`` least hashes, of ``BANDS``: a pair of similarity 0.8 is missed by 3 in a million. Up to
``FEW`` texts of a band are paired with each other, more first with one of them that a hash chooses anew in each band; of
these all pairs that the links found so far do not join within three steps follow, in tiles of bounded size, which give back
a spanning forest. Sets are compared whole, and only pairs that reach the bound link. Words are runs between ASCII white space, A-Z
lower-cased; a text of fewer words than the width is one shingle, texts without words (or null) are alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsieve.llm.common import HOT_PARTS, cut, join_spread

#: Bytes with A-Z lower-cased.
LOW = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

BANDS, ROWS, FEW = 24, 4, 8
#: Of a large band about so many texts meet as many in a task; fewer, if they come to more than so many shingles.
TILE, TILE_SHINGLES = 512, 1 << 19
#: Shingles that are counted at once.
COLUMNS = 4096


def shingle_hashes(text: str | None, width: int):
    """Distinct hashes of a text's shingles."""
    import numpy as np
    import xxhash

    ws = (text or "").encode("utf-8", "surrogatepass").translate(LOW).split()
    shingles = map(b" ".join, zip(*(ws[i:] for i in range(width)))) if len(ws) >= width else [b" ".join(ws)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles), np.uint64))


def band_keys(texts: DataFrame, width: int) -> DataFrame:
    """node, text -> node, n (its shingles), band (a hash of its number and values): each text's bands."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        rng = np.random.default_rng(7)
        mask, factor = (rng.integers(0, 2**63, BANDS * ROWS, np.uint64) for _ in range(2))
        factor = factor * np.uint64(2) + np.uint64(1)
        for batch in batches:
            keys, sizes = [], []
            for t in batch.column(1).to_pylist():
                h, least = shingle_hashes(t, width), None
                sizes.append(len(h))
                for at in range(0, len(h), 1 << 12):
                    low = ((h[at : at + (1 << 12)] ^ mask[:, None]) * factor[:, None]).min(1)
                    least = low if least is None else np.minimum(least, low)
                keys += [xxhash.xxh64_intdigest(least[ROWS * i : ROWS * (i + 1)].tobytes(), i) for i in range(BANDS)]
            offsets = pa.array(np.arange(0, len(keys) + 1, BANDS), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(np.array(keys, np.uint64).view(np.int64)))], ["node", "n", "bands"])

    return cut(texts.select("node", "text").mapInArrow(rows, "node long, n int, bands array<long>")).select("node", "n", F.explode("bands").alias("band"))


def similar_pairs(texts: DataFrame, width: int, similarity: float, known: DataFrame | None = None) -> DataFrame:
    """Edges (u, v) between nodes of texts (node, text; each node once) that reach the similarity, and connect what all such
    pairs do. known: t1, root of each node; pairs of one root are passed over."""
    bands = band_keys(texts, width)
    if known is not None:
        bands = bands.join(known.select(F.col("t1").alias("node"), "root"), "node")
    else:
        bands = bands.withColumn("root", F.col("node"))
    one = F.min_by(F.struct("node", "root"), F.xxhash64("node", "band"))
    heads = bands.groupBy("band").agg(F.count("node").alias("times"), one.alias("head"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    met = join_spread(bands, heads.select("band", "times", "head"), ["band"], _hot(heads, bands), [F.col("node")]).filter("times IS NOT NULL")
    star = met.filter((F.col("times") > FEW) & (F.col("root") != F.col("head.root"))).select(F.col("head.node").alias("u"), F.col("node").alias("v"))
    held = met.filter(F.col("times") <= FEW).groupBy("band").agg(F.collect_list(F.struct("node", "root")).alias("xs"))
    all_pairs = held.select("xs", F.explode("xs").alias("x")).select("x", F.explode("xs").alias("y")).filter("x.root <> y.root").select(F.col("x.node").alias("u"), F.col("y.node").alias("v"))
    pairs = cut(star.unionByName(all_pairs).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    near = cut(_compared(texts, pairs, width, similarity))
    large = cut(met.filter(F.col("times") > FEW).select("band", "node", "root", "n"))
    if large.isEmpty():
        return near
    ends = near.join(known.select(F.col("t1").alias("u"), F.col("root").alias("a")), "u").join(known.select(F.col("t1").alias("v"), F.col("root").alias("b")), "v") if known is not None else near.withColumns({"a": F.col("u"), "b": F.col("v")})
    joined = _joined(ends.filter("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")))
    return near.unionByName(cut(_apart(texts, large, joined, width, similarity)))


def _joined(edges: DataFrame, rounds: int = 2) -> DataFrame:
    """node, root: the least node within a few links. Nodes of one root are in one component; those of different roots can be
    too, which costs comparisons but no link, so there is no need for all rounds of ``components``."""
    links = cut(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    low = links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("root"))
    for _ in range(rounds):
        near = links.join(low.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("root").alias("m"))
        low = low.join(near.withColumnRenamed("u", "node"), "node").select("node", F.least("root", "m").alias("root"))
    return cut(low)


def _apart(texts: DataFrame, large: DataFrame, joined: DataFrame, width: int, similarity: float) -> DataFrame:
    """Edges (u, v) that reach the similarity and connect what all such pairs do, of those in a band of large (band, node, root,
    n) whose roots joined (node, root) leaves apart. A band's rows are dealt to tiles by hash, each with its shingles, and
    each pair of tiles meets in a group of its own, which gives back a spanning forest, never all pairs."""
    placed = cut(large.join(joined.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("band", "node", "n", F.coalesce("to", "root").alias("root")))
    size = F.greatest(F.ceil(F.count("node") / TILE), F.ceil(F.sum("n") / TILE_SHINGLES))
    tiles = placed.groupBy("band").agg(size.cast("int").alias("tiles"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    rows = cut(placed.join(tiles.select("band", "tiles"), "band").withColumn("mine", F.pmod(F.xxhash64("node", "band"), F.col("tiles")).cast("int")))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hs = [shingle_hashes(t, width).view("int64") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hs, pa.list_(pa.int64()))], ["node", "hs"])

    sets = texts.select("node", "text").join(rows.select("node").distinct(), "node", "left_semi").mapInArrow(hashed, "node long, hs array<long>")
    dealt = rows.select("band", "mine", "node", "root", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    dealt = dealt.select("band", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "root").join(sets, "node")
    groups = dealt.select("band", "i", "j", "mine", "node", "root", "hs").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "mine", "node")
    return groups.mapInArrow(lambda batches: _linked(batches, similarity), "u long, v long").distinct()


def _linked(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Rows (band, i, j, mine, node, root, hs), those of a pair of tiles side by side -> u, v."""
    import numpy as np

    def settle(key: tuple, held: list) -> pa.RecordBatch:
        mine, node, root = (np.concatenate([x[k] for x in held]) for k in range(3))
        u, v = near_forest([h for x in held for h in x[3]], root, mine == key[1], mine == key[2], similarity)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(node[u], node[v])), pa.array(np.maximum(node[u], node[v]))], ["u", "v"])

    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([c.to_numpy() for c in batch.columns[:3]])
        mine, node, root = (c.to_numpy() for c in batch.columns[3:6])
        hs, ends = batch.column(6).values.to_numpy(), batch.column(6).offsets.to_numpy()
        edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            here = tuple(keys[:, lo].tolist())
            if here != key and held:
                yield settle(key, held)
                held = []
            key = here
            held.append((mine[lo:hi].copy(), node[lo:hi].copy(), root[lo:hi].copy(), [hs[ends[r] : ends[r + 1]].copy() for r in range(lo, hi)]))
    if held:
        yield settle(key, held)


def near_forest(sets: list, root, ours, theirs, similarity: float):
    """(u, v), places of sets of distinct hashes: a spanning forest of the pairs of one of ours and one of theirs (masks) whose
    roots differ and that reach the similarity."""
    import numpy as np

    sizes = np.array([len(x) for x in sets])
    who = np.repeat(np.arange(len(sets)), sizes)
    _, word, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[word] > 1  # others are in no intersection
    who, (words, word) = who[shared], np.unique(word[shared], return_inverse=True)
    order = np.argsort(word, kind="stable")
    who, word = who[order], word[order]
    a, b = np.flatnonzero(ours), np.flatnonzero(theirs)
    both = np.zeros((len(a), len(b)), np.float32)  # counts of shingles are whole numbers below 2 ** 24
    for at in range(0, len(words), COLUMNS):
        lo, hi = np.searchsorted(word, [at, at + COLUMNS])
        held = np.zeros((len(sets), min(COLUMNS, len(words) - at)), np.float32)
        held[who[lo:hi], word[lo:hi] - at] = 1
        both += held[a] @ held[b].T
    both = both.astype(np.float64)
    near = np.zeros((len(sets), len(sets)), bool)
    near[np.ix_(a, b)] = (both >= similarity * (sizes[a][:, None] + sizes[b] - both)) & (root[a][:, None] != root[b])
    near |= near.T
    left, us, vs = np.ones(len(sets), bool), [a[:0]], [a[:0]]
    for start in range(len(sets)):
        queue = [start] if left[start] else []
        left[start] = False
        while queue:
            u = queue.pop()
            found = np.flatnonzero(near[u] & left)
            left[found] = False
            us.append(np.full(len(found), u))
            vs.append(found)
            queue += found.tolist()
    return np.concatenate(us), np.concatenate(vs)


def _compared(texts: DataFrame, pairs: DataFrame, width: int, similarity: float) -> DataFrame:
    """Those of the pairs (u, v) whose texts reach the similarity."""
    one, two = (texts.select(F.col("node").alias(n), F.col("text").alias(t)) for n, t in (("u", "a"), ("v", "b")))
    both = pairs.join(one, "u").join(two, "v")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            near = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = shingle_hashes(a, width), shingle_hashes(b, width)
                both = len(np.intersect1d(x, y, assume_unique=True))
                near.append(both >= similarity * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), ["u", "v"]).filter(pa.array(near, pa.bool_()))

    return both.select("u", "v", "a", "b").mapInArrow(rows, "u long, v long")


def _hot(heads: DataFrame, bands: DataFrame) -> DataFrame:
    """The heads of bands with over one in HOT_PARTS of all rows."""
    return heads.filter(F.col("times") > bands.count() / HOT_PARTS).select("band", "times", "head")
