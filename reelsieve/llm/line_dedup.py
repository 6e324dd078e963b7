"""Line deduplication across documents: a long enough line that several documents hold stays in one of them.

Native: explode lines, hash their keys, count distinct documents per key (pre-aggregated before each shuffle),
find the lines to drop, and put each document together again by line position. A key with over a thousandth of all
held lines is settled by a broadcast of at most a thousand rows, so that its lines never meet in one task.
Null or empty text is one empty line. A null doc_id counts as one document, below all others. Rows with equal
doc_id and text are one document and get the same result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsieve.llm.common import HOT_PARTS, WS, ascii_lower, cut, doc_key, join_spread, let, pack, text_key, unpack


def shared_lines(packed: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """did, t1, t2, drop (positions of the lines that go), for documents that lose a line."""
    lines = packed.select(doc_key(), *text_key(), F.posexplode(F.split(F.coalesce("row.text", F.lit("")), "\n")).alias("pos", "line"))
    key = ascii_lower(F.btrim("line", F.lit(WS)))
    lines = lines.withColumn("key", key).filter(F.length("key") >= min_chars).select(
        "did", "t1", "t2", "pos", F.xxhash64("key").alias("k1"), F.xxhash64("key", F.lit(1)).alias("k2"))
    held = cut(
        lines.groupBy("k1", "k2", "did").agg(F.lit(1).alias("one"))
        .groupBy("k1", "k2").agg(F.count("one").alias("n"), F.max("did").alias("keeper"))
        .filter(F.col("n") >= min_docs)
    )
    total = held.agg(F.sum("n")).first()[0] or 0
    hot = held.filter(F.col("n") > total / HOT_PARTS).drop("n")
    met = join_spread(lines, held.drop("n"), ["k1", "k2"], hot, [F.col("did"), F.col("pos")])
    gone = met.filter(F.col("did") < F.col("keeper"))
    return gone.groupBy("did", "t1", "t2").agg(F.collect_set("pos").alias("drop"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """docs with text (the kept lines), n_lines and n_dropped."""
    packed = pack(docs)
    joined = packed.select("row", doc_key(), *text_key()).join(shared_lines(packed, min_chars, min_docs), ["did", "t1", "t2"], "left")
    text = F.coalesce("row.text", F.lit(""))
    kept = let(F.split(text, "\n"), lambda ls: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("drop")), lambda i: F.get(ls, i)), "\n"))
    return unpack(
        joined, docs.columns, text=F.when(F.col("drop").isNull(), text).otherwise(kept),
        n_lines=F.size(F.split(text, "\n")).cast("long"), n_dropped=F.coalesce(F.size("drop"), F.lit(0)).cast("long"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_STRIP = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {_STRIP}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
h AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, h.keeper IS NOT NULL AND k.doc_id <> h.keeper AS gone FROM k LEFT JOIN h USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
