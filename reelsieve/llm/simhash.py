"""SimHash near-duplicates: 64-bit fingerprints, all pairs within a radius by tiled exact comparison, components.

Distinct fingerprints are put in tiles by the population counts of their four 16-bit quarters; a cell with many is split
into tiles of a bounded size. Two fingerprints within the radius have quarter counts that differ by at most the radius
in sum, so tile pairs further apart are skipped and the rest compared whole with exclusive-or and bit counts. Each pair
of tiles gives back a spanning forest of its links, never all pairs, and equal fingerprints are one node, so a group of
thousands of copies costs no more than its distinct fingerprints.

Null text is empty; texts without words have fingerprint zero and link like any other. Rows with null ids take part; a
component's id is its least id (null only where all ids are). Other columns pass through; ties don't arise.

Five-word shingles that are alike by 0.8 give fingerprints some ten bits apart, where tiles can't skip much. So with a
similarity the groups of the tiled comparison are joined by an exact check of whole shingle sets (``shingles.py``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsieve.llm import shingles
from reelsieve.llm.common import HOT_PARTS, cut, join_spread, text_key, unpack
from reelsieve.operators.graph import components

_LOW = shingles.LOW


def fingerprint(text: str, width: int = 3, seed: int = 42) -> int:
    import numpy as np
    import xxhash

    ws = text.encode("utf-8", "surrogatepass").translate(_LOW).split()
    if not ws:
        return 0
    shingles = map(b" ".join, zip(*(ws[i:] for i in range(width)))) if len(ws) >= width else [b" ".join(ws)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, seed) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bits of a block at a time
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(packed: DataFrame, width: int = 3) -> DataFrame:
    """row, id, t1, text -> row, id, t1, fp (the fingerprint's 64 bits as a long)."""
    schema = T.StructType([*packed.select("row", "id", "t1").schema.fields, T.StructField("fp", T.LongType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            fps = np.array([fingerprint(t or "", width) for t in batch.column(3).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps, pa.int64())], ["row", "id", "t1", "fp"])

    return packed.select("row", "id", "t1", "text").mapInArrow(rows, schema)


def _quarters(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(4)]


def _cell(qs: list[Column]) -> Column:
    return qs[0] + 32 * qs[1] + 1024 * qs[2] + 32768 * qs[3]


def forest(i, j, n: int):
    """Edges (node, root) that connect what the pairs i[k]-j[k] connect, among nodes 0..n-1."""
    import numpy as np

    label = np.arange(n)
    while True:
        low = label.copy()
        m = np.minimum(label[i], label[j])
        np.minimum.at(low, i, m)
        np.minimum.at(low, j, m)
        np.minimum.at(low, label[i], m)
        np.minimum.at(low, label[j], m)
        low = low[low]
        if (low == label).all():
            nodes = np.flatnonzero(label != np.arange(n))
            return nodes, label[nodes]
        label = low


def compare_tiles(a, b, same: bool, radius: int):
    """Edges as fingerprints (u, v) that connect what lies within the radius of each other in a and b."""
    import numpy as np

    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
    i, j = np.nonzero(np.triu(near, 1) if same else near)
    if not len(i):
        return a[:0], a[:0]
    both = a if same else np.concatenate([a, b])
    if not same:
        j = j + len(a)
    if len(i) > 2 * len(both):
        i, j = forest(i, j, len(both))
    return both[i], both[j]


def links(fps: DataFrame, radius: int = 3, tile: int = 1024) -> DataFrame:
    """Distinct fingerprints fp -> edges (u, v) whose components are those of all pairs within the radius."""
    cells = fps.select("fp", _cell(_quarters(F.col("fp"))).alias("cell"))
    counts = cut(cells.groupBy("cell").count())  # 17 ** 4 cells at most
    sized = counts.select("cell", F.ceil(F.col("count") / tile).cast("int").alias("parts"))
    tiles = cells.join(F.broadcast(sized), "cell").select("cell", "parts", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part"), "fp")
    tiles = cut(tiles.groupBy("cell", "parts", "part").agg(F.collect_list("fp").alias("fps")))
    # half of the neighbourhood: each pair of cells once
    near = [d for d in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, d)) <= radius and d >= (0, 0, 0, 0)]
    shift = F.array(*[F.struct(*[F.lit(x).alias(f"d{k}") for k, x in enumerate(d)]) for d in near])
    q = [F.shiftright(F.col("cell"), 5 * k).bitwiseAND(F.lit(31)) for k in range(4)]
    there = [q[k] + F.col(f"d.d{k}") for k in range(4)]
    other = sized.select(F.col("cell").alias("to"), F.col("parts").alias("to_parts"))
    left = tiles.select("*", F.explode(shift).alias("d")).filter(F.greatest(*there) <= 16).filter(F.least(*there) >= 0).select(F.col("fps").alias("a"), "cell", "part", _cell(there).alias("to"))
    left = left.join(F.broadcast(other), "to").select("a", "cell", "part", "to", F.explode(F.sequence(F.lit(0), F.col("to_parts") - 1)).alias("to_part")).filter((F.col("to") != F.col("cell")) | (F.col("to_part") >= F.col("part")))
    right = tiles.select(F.col("fps").alias("b"), F.col("cell").alias("to"), F.col("part").alias("to_part"))
    pairs = left.join(right, ["to", "to_part"]).select("a", "b", ((F.col("cell") == F.col("to")) & (F.col("part") == F.col("to_part"))).alias("same"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def array(x) -> np.ndarray:
            return x.values.to_numpy(zero_copy_only=False).view(np.uint64)

        for batch in batches:
            us, vs = [], []
            for a, b, same in zip(*batch.columns):
                u, v = compare_tiles(array(a), array(b), same.as_py(), radius)
                us.append(u)
                vs.append(v)
            if us:
                u, v = (np.concatenate(x).view(np.int64) for x in (us, vs))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return pairs.mapInArrow(rows, "u long, v long")


def _similar(texts: DataFrame, edges: DataFrame, width: int, similarity: float) -> DataFrame:
    """Edges (u, v) between fingerprints of texts (t1, fp, text) that reach the similarity. Pairs whose fingerprints have
    the same least neighbour in edges are linked already and not compared."""
    ends = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = ends.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("fp"), F.least("u", "m").alias("least"))
    placed = cut(texts.select("t1", "fp").join(least, "fp", "left").select("t1", "fp", F.coalesce("least", "fp").alias("root")))
    pairs = shingles.similar_pairs(texts.select(F.col("t1").alias("node"), "text"), width, similarity, placed.select("t1", "root"))
    return pairs.join(placed.select(F.col("t1").alias("u"), F.col("fp").alias("a")), "u").join(placed.select(F.col("t1").alias("v"), F.col("fp").alias("b")), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", radius: int = 3, width: int = 3, similarity: float | None = None) -> DataFrame:
    """Columns of docs but the text, with fp, component (a fingerprint that stands for it), component_id and component_rows.
    Columns of these names, in any case, are replaced. similarity: if given, texts whose sets of ``width``-word shingles are alike by it link too, though their
    fingerprints differ by more than the radius (at 0.8, most do)."""
    gone = {text_col.lower(), "fp", "component", "component_id", "component_rows"}
    out = [c for c in docs.columns if c.lower() not in gone]
    packed = docs.select(F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`") for c in out]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), text_key(f"`{text_col}`")[0], F.col(f"`{text_col}`").alias("text"))
    prints = cut(fingerprints(packed, width))
    nodes = cut(prints.groupBy("fp").agg(F.min("id").alias("low"), F.count("fp").alias("rows")))
    edges = links(nodes.select("fp"), radius)
    if similarity is not None:
        edges = cut(edges)
        of = prints.groupBy("t1").agg(F.first("fp").alias("fp"))
        texts = packed.groupBy("t1").agg(F.first("text").alias("text")).join(of, "t1")
        edges = edges.unionByName(_similar(texts, edges, width, similarity))
    roots = components(edges)
    roots = nodes.select("fp").join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    placed = cut(nodes.join(roots, "fp"))
    groups = cut(placed.groupBy("root").agg(F.min("low").alias("component_id"), F.sum("rows").alias("component_rows"), F.count("fp").alias("prints")))
    total, distinct = groups.agg(F.sum("component_rows"), F.sum("prints")).first()
    hot = groups.filter(F.col("prints") > (distinct or 0) / HOT_PARTS).drop("prints")
    known = cut(join_spread(placed, groups.drop("prints"), ["root"], hot, [F.col("fp")]).select("fp", "rows", F.col("root").alias("component"), "component_id", "component_rows"))
    hot = known.filter(F.col("rows") > (total or 0) / HOT_PARTS).drop("rows")
    met = join_spread(prints.select("row", "id", "fp"), known.drop("rows"), ["fp"], hot, [F.col("id")])
    return unpack(met, out, fp=F.col("fp"), component=F.col("component"), component_id=F.col("component_id"), component_rows=F.col("component_rows"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
