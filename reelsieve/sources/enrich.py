"""Asking an outside service about many ids in requests of a fixed size; a request that fails loses nothing."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsieve.operators.spread import cut


def numbered(rows: DataFrame, order: list[str], out: str = "no") -> DataFrame:
    """rows in an order, counted from 0: range-sorted partitions, each beginning where those before it end."""
    kept = cut(rows.withColumn("_tie", F.monotonically_increasing_id()))
    by = [*order, "_tie"]
    parts = max(1, min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), kept.count()))
    placed = cut(kept.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_tie").withColumns({"_part": F.spark_partition_id(), "_i": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    sizes = placed.groupBy("_part").count()  # a row for each partition
    before = F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.join(F.broadcast(sizes.select("_part", before.alias("_b"))), "_part").withColumn(out, F.col("_i") + F.col("_b")).drop("_part", "_i", "_b")


def in_chunks(rows: DataFrame, key: str, fetch: Callable[[list], dict[object, dict]], schema: str, order: list[str], size: int = 100) -> DataFrame:
    """rows with the fields of ``fetch`` (by key; null for keys it doesn't give) and checked: false, with no fields, for all
    rows of a request that raised. Requests have exactly ``size`` keys, in order, but for the last one; a request is one
    task's work, and is sent again if that task is lost. Null keys are rows of a request like others, but aren't asked for."""
    fields = T._parse_datatype_string(schema).fields
    kept = [f for f in rows.schema.fields if f.name not in {x.name for x in fields} | {"checked"}]
    full = T.StructType([*kept, *fields, T.StructField("checked", T.BooleanType())])
    whole = isinstance(rows.schema[key].dataType, T.IntegralType)  # which a null beside it makes a float
    chunks = numbered(rows.select(*[f"`{f.name}`" for f in kept]), order, "_no").withColumn("_chunk", F.floor(F.col("_no") / size))

    def ask(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_no")
        try:
            given = fetch([int(k) if whole else k for k in part[key].tolist() if not pd.isna(k)])
            ok = True
        except Exception:  # the service's fault: the rows stay as they are
            given, ok = {}, False
        out = part[[f.name for f in kept]].copy()
        for f in fields:
            out[f.name] = pd.Series([given.get(k, {}).get(f.name) for k in part[key].tolist()], index=out.index, dtype=object)
        return out.assign(checked=ok)

    return chunks.groupBy("_chunk").applyInPandas(ask, full)


def first_kept(rows: DataFrame, key: str, fetch: Callable[[list], dict[object, dict]], schema: str, keep: str, order: list[str], limit: int, over: int = 3, size: int = 100) -> DataFrame:
    """The first ``limit`` rows that the SQL condition ``keep`` holds for, or that could not be checked: each key once, of the
    first ``over`` times as many keys. A listing is over-fetched because some of it will not do."""
    w = Window.partitionBy(key).orderBy(*order)
    once = rows.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")
    some = once.orderBy(*order).limit(limit * over)
    asked = in_chunks(some, key, fetch, schema, order, size)
    return asked.filter(F.expr(f"NOT checked OR ({keep})")).orderBy(*order).limit(limit)
