"""The training-data pipeline: stages over documents, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsieve.llm import bpe, decontaminate, line_dedup, quality, simhash
from reelsieve.llm.common import pack, remove, shared_dir, text_key

#: None: fingerprints and tokens are not expressible in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    """docs with n_chars, if it has such a column, following the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that too many documents of their source hold."""
    return _counted(quality.clean(docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a later document also holds; n_chars follows the text."""
    return _counted(line_dedup.dedup_lines(docs).select(*docs.columns))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates (SimHash within 3 bits, or sets of five-word shingles alike by 0.8 or more)
    the document with the least id (a null id only where there is no other; of equal ids, one text). Rows equal in id and
    text become one."""
    last = F.lit(2**63 - 1)
    packed = pack(docs).select("row", F.coalesce(F.col("row.doc_id").cast("long"), last).alias("doc_id"), *text_key())
    groups = simhash.near_duplicates(packed.select("doc_id", "t1", "t2", F.col("row.text").alias("text")), width=5, similarity=0.8)
    stay = groups.groupBy("component").agg(F.min(F.struct("doc_id", "t1", "t2")).alias("s")).select("s.*")
    return packed.join(stay, ["doc_id", "t1", "t2"], "left_semi").dropDuplicates(["doc_id", "t1", "t2"]).select("row.*")


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their tokens (n_tokens, token_ids) and the decoded text."""
    return bpe.encode(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("BPE encoding and decoding", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the result is read from the last stage's files in the shared folder. The files
    of a stage are deleted once the next one's are written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        path = f"{base}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if i:
            remove(spark, f"{base}/{i - 1}")
    return docs
