"""Token counts per document of flat token files that have no index, from the end-of-document identifiers alone.

A file is a run of little-endian unsigned integers; each document's tokens are followed by the separator. Files are cut
into blocks of fixed size, each searched by one vectorised comparison in some task. A block knows its separators' places,
but not how many documents ended before it or where its first one began: a prefix scan over the blocks' sums (two numbers
a block) gives both, whatever number of blocks a document spans. Tokens after a file's last separator are one document
that is not terminated; an empty document counts 0; an empty file has none.

``write_token_files`` makes such files from documents (null text: no tokens) in a folder that all executors share; a file
written by a task that was lost or repeated isn't named by the manifest and so not counted.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsieve.llm.bpe import default_path, tokenizer
from reelsieve.llm.common import cut, remove, shared_dir

#: The public vocabulary's end-of-text identifier; its ids fit 16 bits.
SEPARATOR, DTYPE = 49407, "<u2"


def _open(uri: str):
    """pyarrow's file system for a URI or path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else uri.replace("file:", "file://", 1))


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, dtype: str = DTYPE, separator: int = SEPARATOR, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One file for each partition of docs; the manifest (file, nth, doc_id), computed once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        tok = tokenizer(path or default_path())
        files, base = _open(folder)
        files.create_dir(base, recursive=True)
        name, nth = f"{uuid.uuid4().hex}.bin", 0
        with files.open_output_stream(f"{base}/{name}") as out:
            for batch in batches:
                for text in batch.column(1).to_pylist():
                    ids = np.frombuffer(tok.encode(text or "", special=False), "<u4")
                    if (ids > np.iinfo(dtype).max).any() or (ids == separator).any():
                        raise ValueError(f"a token's identifier is the separator or doesn't fit {dtype}")
                    out.write(ids.astype(dtype).tobytes())
                    out.write(np.array([separator], dtype).tobytes())
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(range(nth, nth + n), pa.int64()), batch.column(0)], ["file", "nth", "doc_id"])
                nth += n

    kept = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return cut(kept.mapInArrow(rows, "file string, nth long, doc_id long"))


def token_counts(spark, folder: str, separator: int = SEPARATOR, dtype: str = DTYPE, block_tokens: int = 1 << 20) -> DataFrame:
    """file, nth (from 0), start (first token), n_tokens, terminated: a row for each document of the folder's files."""
    import numpy as np

    width = np.dtype(dtype).itemsize
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])
    files = spark.read.format("binaryFile").schema(schema).load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.expr(f"length div {width}").alias("tokens"))
    blocks = files.filter("tokens > 0").select("file", "tokens", F.explode(F.sequence(F.lit(0), F.expr(f"(tokens - 1) div {block_tokens}"))).alias("block"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        for batch in batches:
            for file, tokens, block in zip(*(c.to_pylist() for c in batch.columns)):
                at = block * block_tokens
                with fs.open_input_file(f"{base}/{file}") as f:
                    f.seek(at * width)
                    ids = np.frombuffer(f.read(min(block_tokens, tokens - at) * width), dtype)
                ends = np.flatnonzero(ids == separator) + at
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([tokens], pa.int64()), pa.array([block], pa.int64()), pa.array([ends], pa.list_(pa.int64()))], ["file", "tokens", "block", "ends"])

    found = cut(blocks.repartition("file", "block").mapInArrow(rows, "file string, tokens long, block long, ends array<bigint>"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = found.select("file", "block", F.size("ends").cast("long").alias("n"), F.try_element_at("ends", F.lit(-1)).alias("last"))
    scan = sums.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ended"), F.coalesce(F.max("last").over(before) + 1, F.lit(0)).alias("begun"))
    placed = found.join(scan, ["file", "block"]).select("file", "ended", "begun", "ends", F.posexplode("ends").alias("i", "end"))
    start = F.when(F.col("i") == 0, F.col("begun")).otherwise(F.get("ends", F.col("i") - 1) + 1)
    whole = placed.select("file", (F.col("ended") + F.col("i")).alias("nth"), start.alias("start"), (F.col("end") - start).alias("n_tokens"), F.lit(True).alias("terminated"))
    tails = found.groupBy("file").agg(F.max("tokens").alias("tokens"), F.sum(F.size("ends")).cast("long").alias("nth"), F.coalesce(F.max(F.try_element_at("ends", F.lit(-1))) + 1, F.lit(0)).alias("start"))
    open_ = tails.filter("start < tokens").select("file", "nth", "start", (F.col("tokens") - F.col("start")).alias("n_tokens"), F.lit(False).alias("terminated"))
    return whole.unionByName(open_)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    manifest = write_token_files(docs, folder)
    counts = token_counts(spark, folder)  # read once and cut; the files are needed no more
    remove(spark, folder)
    return manifest.join(counts, ["file", "nth"]).select("doc_id", "n_tokens")
