"""Benchmark decontamination: which short test items stand inside which documents, by containment of word shingles.

Native. Items are partitioned by size (powers of two of their distinct shingles). An item keeps as its MinHash sketch its
k least shingle hashes, k being more than the shingles an item of its partition may miss: a document that contains the
threshold's share of an item therefore holds a hash of its sketch, however long the document is. Sketch hashes fetch
candidate documents; the exact containment of all of the item's shingles in the candidate decides.

Documents are not sketched: all their shingles are looked up in the items' sketches, so, other than with a sketch on
both sides, no item is missed. A document or item of fewer words than a shingle is one shingle, its whole sequence.

Texts are lower-cased and cut into runs of letters and digits. Texts without a word, or null, have no shingles and match
nothing. Equal documents and equal items each give their own rows; null ids are returned as null. Other columns of either
table are ignored by ``leaks`` and passed through by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsieve.llm.common import NO_ID, cut, doc_key, let, pack, small, small_bytes, text_key


def shingle_hashes(text: Column, width: int = 5) -> Column:
    """Distinct hashes of a text's word shingles."""
    ws = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    none = F.array().cast("array<bigint>")

    def of(w: Column) -> Column:
        return F.when(F.size(w) == 0, none).when(F.size(w) < width, F.array(F.xxhash64(F.concat_ws(" ", w)))).otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)])))

    return F.array_distinct(let(ws, of))


def item_sketches(items: DataFrame, threshold: float, width: int) -> DataFrame:
    """iid, hs (all shingle hashes), sketch (the k least) of each distinct item id and text."""
    one = pack(items).select(F.col("row.item_id").alias("iid"), F.array_sort(shingle_hashes(F.col("row.text"), width)).alias("hs")).filter(F.size("hs") > 0).distinct()
    most = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("hs").cast("double"))))  # the partition's largest size
    k = F.floor(most * (1 - threshold) + 1e-9).cast("int") + 1
    return one.select("iid", "hs", F.slice("hs", F.lit(1), F.least(k, F.size("hs"))).alias("sketch"))


def leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.8, width: int = 5, broadcast_rows: int = 1_000_000) -> DataFrame:
    """did, t1, t2, iid, n_shared, n_shingles of each document and item whose containment reaches the threshold.
    Sketch rows (16 bytes each) are broadcast when they count at most ``broadcast_rows``, whole items when their hashes come
    to at most 64 bytes for each of these; else both are joined by a shuffle."""
    sketches = cut(item_sketches(items, threshold, width).withColumn("item", F.monotonically_increasing_id()))  # ids may be null or equal
    index, _ = small(cut(sketches.select("item", F.explode("sketch").alias("h"))), broadcast_rows)
    packed = pack(docs)
    keyed = packed.select(doc_key(), *text_key(), F.col("row.text").alias("text"))
    probes = keyed.select("did", "t1", "t2", F.explode(shingle_hashes(F.col("text"), width)).alias("h"))
    found = cut(probes.join(index, "h").select("did", "t1", "t2", "item").distinct())
    # the texts of candidates only: a semi-join, which Spark turns into a filter at the scan when the sides differ much
    texts = keyed.join(found.select("did", "t1", "t2").distinct(), ["did", "t1", "t2"], "left_semi").dropDuplicates(["did", "t1", "t2"])
    full, _ = small_bytes(sketches.select("item", "iid", "hs"), 8 * F.size("hs") + 50, 64 * broadcast_rows)
    pairs = found.join(full, "item").join(texts.select("did", "t1", "t2", shingle_hashes(F.col("text"), width).alias("ds")), ["did", "t1", "t2"])
    shared = pairs.select("did", "t1", "t2", "iid", F.size(F.array_intersect("ds", "hs")).cast("long").alias("n_shared"), F.size("hs").cast("long").alias("n_shingles"))
    return shared.filter(F.col("n_shared") >= threshold * F.col("n_shingles") - 1e-9)


def clean(docs: DataFrame, items: DataFrame, threshold: float = 0.8, width: int = 5) -> DataFrame:
    """docs without the documents that contain an item."""
    hit = cut(leaks(docs, items, threshold, width).select("did", "t1", "t2").distinct())
    keyed = pack(docs).select("row", doc_key(), *text_key())
    return keyed.join(hit, ["did", "t1", "t2"], "left_anti").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return leaks(docs, items).select(F.when(F.col("did") != NO_ID, F.col("did")).alias("doc_id"), F.col("iid").alias("item_id"), "n_shared", "n_shingles", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


_SHINGLES = "CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END"
_WORDS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
ORACLE = f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents), iw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
d AS (SELECT doc_id, unnest({_SHINGLES}) AS s FROM dw), i AS (SELECT item_id, unnest({_SHINGLES}) AS s FROM iw),
n AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id),
j AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
FROM j JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_shingles - 1e-9
"""
