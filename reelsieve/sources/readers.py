"""Readers of the collection's files: logs, lists, state, media folders."""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Signals counted in crawler logs, by name.
LOG_SIGNALS = {
    "kept_partial": r"GIỮ LẠI \d+",
    "cookie_rejected": "đá về đăng nhập|cookie hỏng",
    "rate_limited": "429",
    "browser_error": "Playwright lỗi",
    "budget_spent": "Hết time budget",
    "quota_skip": "đã đủ quota — bỏ qua",
}
LIVE = "url string, image_path string, title string, channel_id string"
HISTORY = "url string, status string, ts string, channel_id string, title string"
FILE = "path string, modificationTime timestamp, length long, content binary"


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated rows; missing trailing columns are empty strings."""
    df = spark.read.csv(path, sep="\t", schema=schema, mode="PERMISSIVE", quote="")
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in df.columns])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """line: what is left of lines without comments, blanks and quotes (camera lists)."""
    bare = F.btrim(F.trim("value"), F.lit("\"'"))
    return spark.read.text(path).filter((F.trim("value") != "") & ~F.trim("value").startswith("#")).select(bare.alias("line"))


def read_classes(spark: SparkSession, path: str) -> DataFrame:
    """idx, name of lines '0 name'; lines without a number have a null idx."""
    df = spark.read.text(path).filter(F.trim("value") != "")
    return df.select(F.nullif(F.regexp_extract("value", r"^\s*(\d+)\s+", 1), F.lit("")).cast("int").alias("idx"), F.trim(F.regexp_replace("value", r"^\s*\d+\s+", "")).alias("name"))


def read_cookies(spark: SparkSession, path: str) -> DataFrame:
    """domain, path, secure, expires, name, value of Netscape lines with seven fields; comments are skipped."""
    f = F.split("value", "\t")
    df = spark.read.text(path).filter(~F.trim("value").startswith("#")).filter(F.size(f) >= 7)
    return df.select(f[0].alias("domain"), f[2].alias("path"), (f[3] == "TRUE").alias("secure"), f[4].try_cast("double").alias("expires"), f[5].alias("name"), f[6].alias("value"))


def files(spark: SparkSession, path: str, suffixes: tuple[str, ...] = (), recursive: bool = True) -> DataFrame:
    """path, modificationTime, length of files with one of the suffixes; contents aren't read."""
    df = spark.read.schema(FILE).format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path).drop("content")
    return df.filter(F.lower("path").rlike(f"({'|'.join(s.replace('.', '[.]') for s in suffixes)})$")) if suffixes else df


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE).format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.sha2("content", 256).alias("file_hash"))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """label (folder), n_files, n_bytes without sidecars and images."""
    df = files(spark, path).filter(~F.lower("path").rlike("[.](json|jpg|png)$"))
    return df.groupBy(F.element_at(F.split("path", "/"), -2).alias("label")).agg(F.count("path").alias("n_files"), F.sum("length").alias("n_bytes"))


def log_signals(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """signal, n over log files changed since then; signals that don't occur are left out."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.log")
    lines = (reader.option("modifiedAfter", since) if since else reader).text(path)
    return signal_counts(lines, "value")


def signal_counts(lines: DataFrame, col: str, signals: dict[str, str] = LOG_SIGNALS) -> DataFrame:
    sums = lines.agg(*[F.sum(F.regexp_count(F.col(col), F.lit(p))).alias(k) for k, p in signals.items()])
    return sums.unpivot([], list(signals), "signal", "n").filter("n > 0")


@F.pandas_udf(StringType())
def literal_to_json(text: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Python literals as JSON; null for anything else."""
    import json

    for part in text:
        out = []
        for t in part:
            try:
                out.append(json.dumps(ast.literal_eval(t)))
            except (ValueError, SyntaxError, TypeError, RecursionError, MemoryError):
                out.append(None)
        yield pd.Series(out, dtype=object)


def decode_values(rows: DataFrame, col: str, out: str = "decoded") -> DataFrame:
    """rows with JSON text of values that are JSON or Python literals; JSON stays on the JVM, and only its nulls go to Python."""
    plain = F.when(F.try_parse_json(F.col(col)).isNotNull(), F.col(col))
    return rows.withColumn(out, F.coalesce(plain, literal_to_json(F.when(plain.isNull(), F.col(col)))))


def first_non_empty(a: DataFrame, b: DataFrame) -> DataFrame:
    return b if a.isEmpty() else a
