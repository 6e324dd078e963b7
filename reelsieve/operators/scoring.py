"""Class scores of embeddings: a matrix product of Arrow batches with prototypes, and softmax over all of them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsieve.functions.media import dot
from reelsieve.operators.spread import cut

_PARTIAL = "no long, peak double, total double, best array<struct<logit:double,cls:string>>"


def prototypes(prompts: DataFrame, cls: str, vector: str) -> DataFrame:
    """cls, vector: for each class the unit mean of its rows' unit vectors. Rows without a vector, or with one of no length,
    are left out."""
    v = F.col(vector).cast("array<double>")
    unit = prompts.select(F.col(cls).cast("string").alias("cls"), v.alias("v"), F.sqrt(dot(v, v)).alias("n")).filter("n > 0")
    parts = unit.select("cls", F.posexplode(F.transform("v", lambda x: x / F.col("n"))).alias("pos", "x"))
    means = parts.groupBy("cls", "pos").agg(F.avg("x").alias("x")).groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("pos", "x")))["x"].alias("m"))
    return means.select("cls", F.transform("m", lambda x: x / F.sqrt(dot(F.col("m"), F.col("m")))).alias("vector"))


def zero_shot(rows: DataFrame, vector: str, protos: DataFrame, scale: float = 100.0, top: int = 1, block_bytes: int = 64 << 20) -> DataFrame:
    """rows with scores: the ``top`` classes of each as (cls, prob), best first, ties by name; prob is the softmax of scale
    times the cosine over all classes. A vector that is null, of another length than the prototypes or of none gives null.

    protos (cls, vector: unit vectors) go to the tasks in blocks of at most ``block_bytes``; every block is one pass over
    the vectors that gives a peak, a sum and the best few for each row, and these are merged by row. With one block, the
    usual case, nothing is shuffled."""
    names = [c for c in rows.columns if c.lower() != "scores"]
    known = cut(protos.select("cls", F.col("vector").cast("array<double>").alias("v")))
    n, width = known.agg(F.count("cls"), F.max(F.size("v"))).first()
    per = max(1, block_bytes // (8 * (width or 1) + 64))
    kind = rows.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).schema[0]
    numbered = rows.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    if n > per:
        numbered = cut(numbered.withColumn("no", F.monotonically_increasing_id()))
    else:
        numbered = numbered.withColumn("no", F.lit(0).cast("long"))

    def merged(parts: Column) -> Column:
        """Scores from a row's partial results."""
        peak = F.array_max(F.transform(parts, lambda p: p["peak"]))
        total = F.aggregate(parts, F.lit(0.0), lambda s, p: s + p["total"] * F.exp(p["peak"] - peak))
        order = F.array_sort(F.flatten(F.transform(parts, lambda p: p["best"])), lambda a, b: F.when(a["logit"] > b["logit"], -1).when(a["logit"] < b["logit"], 1).when(a["cls"] < b["cls"], -1).otherwise(1))
        return F.transform(F.slice(order, 1, top), lambda x: F.struct(x["cls"].alias("cls"), (F.exp(x["logit"] - peak) / total).alias("prob")))

    def scorer(block: list, keep_row: bool):
        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import numpy as np

            cls = np.array([c for c, _ in block], dtype=object)
            p = np.array([v for _, v in block])
            for batch in batches:
                vs = batch.column("v").to_pylist()
                good = [k for k, v in enumerate(vs) if v is not None and len(v) == p.shape[1] and None not in v]
                x = np.array([vs[k] for k in good]).reshape(len(good), p.shape[1])
                length = np.sqrt((x * x).sum(1))
                fine = length > 0
                good, x = [k for k, f in zip(good, fine) if f], x[fine] / length[fine, None]
                logits = scale * np.round(x @ p.T, 12)  # else equal ones could differ by how they are blocked
                out = [None] * batch.num_rows
                for at, row in zip(good, logits):
                    peak = row.max()
                    few = np.flatnonzero(row >= np.partition(row, -min(top, len(row)))[-min(top, len(row))])
                    best = sorted(((-row[j], cls[j]) for j in few))[:top]
                    out[at] = (float(peak), float(np.exp(row - peak).sum()), [{"logit": -a, "cls": c} for a, c in best])
                arrays = [batch.column("no"), pa.array([o and o[0] for o in out], pa.float64()), pa.array([o and o[1] for o in out], pa.float64()), pa.array([o and o[2] for o in out], pa.list_(pa.struct([("logit", pa.float64()), ("cls", pa.string())])))]
                head = [batch.column("row")] if keep_row else []
                yield pa.RecordBatch.from_arrays(head + arrays, ["row"] * keep_row + ["no", "peak", "total", "best"])

        return score

    partial = T._parse_datatype_string(_PARTIAL)
    part = F.struct("peak", "total", "best")
    if n == 0:
        return numbered.select("row.*", F.lit(None).cast("array<struct<cls:string,prob:double>>").alias("scores"))
    if n <= per:
        met = numbered.mapInArrow(scorer([tuple(r) for r in known.orderBy("cls").collect()], True), T.StructType([kind, *partial.fields]))
        return met.select("row.*", F.when(F.col("peak").isNotNull(), merged(F.array(part))).alias("scores"))
    blocks = -(-5 * n // (4 * per))  # dealt by a hash, with room for uneven ones
    places = cut(known.withColumn("at", F.pmod(F.xxhash64("cls"), F.lit(blocks))))
    found = None
    for b in range(blocks):
        block = [tuple(r) for r in places.filter(F.col("at") == b).select("cls", "v").collect()]
        if block:
            some = numbered.select("no", "v").mapInArrow(scorer(block, False), partial)
            found = some if found is None else found.unionByName(some)
    by_row = found.filter("peak IS NOT NULL").groupBy("no").agg(F.collect_list(part).alias("parts"))
    return numbered.join(by_row, "no", "left").select("row.*", F.when(F.col("parts").isNotNull(), merged(F.col("parts"))).alias("scores"))


def probe_prob(vector: Column, weights: list[float], intercept: float) -> Column:
    """Probability of class 1 by a linear probe; null for a vector of another length."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    return F.when(F.size(vector) == len(weights), 1 / (1 + F.exp(-(dot(vector, w) + intercept))))
