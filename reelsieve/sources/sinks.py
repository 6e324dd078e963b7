"""Sinks: routed datasets, annotations, tab-separated logs, cookie files, the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsieve.functions.media import frame_ms
from reelsieve.functions.hashing import segment_id
from reelsieve.functions.text import flat_cell


def write_routed(rows: DataFrame, path: str, outcome: str = "outcome", category: str = "category", mode: str = "append") -> None:
    """A folder for each outcome and category. Rows are dealt to tasks by these with a spread for large ones."""
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(8))
    rows.repartition(outcome, category, spread).write.mode(mode).partitionBy(outcome, category).parquet(path)


def annotation(name: Column, label: Column, start_frame: Column, end_frame: Column, fps: Column, duration: Column) -> Column:
    """The annotation document of a video's segment, as a struct for a JSON sink."""
    return F.struct(
        F.lit("video_classification").alias("type"), F.lit("1.0.0").alias("version"), name.alias("video"),
        F.struct(segment_id(name, start_frame).alias("id"), label.alias("label"), frame_ms(start_frame, fps, duration).alias("start_ms"), frame_ms(end_frame, fps, duration).alias("end_ms")).alias("segment"),
    )


def reject_sidecar(url: Column, outcome: Column, checks: Column) -> Column:
    return F.to_json(F.struct(url.alias("url"), outcome.alias("reason"), checks.alias("checks")))


def write_tsv(rows: DataFrame, path: str, mode: str = "append") -> None:
    rows.select(*[flat_cell(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in rows.columns]).write.mode(mode).csv(path, sep="\t", quote="", escapeQuotes=False)


def label_lines(boxes: DataFrame, image: str) -> DataFrame:
    """image, text: a line 'class x y w h' for each box, in the order of the boxes' numbers."""
    line = F.concat_ws(" ", "cls", *[F.format_string("%.6f", F.col(c)) for c in ("x", "y", "w", "h")])
    return boxes.groupBy(image).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", line.alias("line")))), lambda s: s["line"]), "\n").alias("text"))


def attribute_line(file: Column, scores: Column, least: float) -> Column:
    """'file label score ...' of the labels (array of label, score) over the threshold."""
    over = F.filter(scores, lambda s: s["score"] > least)
    return F.concat_ws(" ", file, F.array_join(F.transform(over, lambda s: F.concat_ws(" ", s["label"], F.format_string("%.2f", s["score"]))), " "))


def netscape_line(domain: Column, path: Column, secure: Column, expires: Column, name: Column, value: Column) -> Column:
    flag = lambda c: F.when(c, "TRUE").otherwise("FALSE")
    return F.concat_ws("\t", domain, flag(domain.startswith(".")), path, flag(secure), F.greatest(expires, F.lit(0)).cast("string"), name, value)


def markdown(df: DataFrame, most: int = 1000) -> str:
    """A report table; for aggregates of at most ``most`` rows, which is an error to exceed."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"over {most} rows in a report table")
    head = f"| {' | '.join(df.columns)} |\n|{'---|' * len(df.columns)}\n"
    return head + "".join("| " + " | ".join("" if v is None else str(v) for v in r) + " |\n" for r in rows)
