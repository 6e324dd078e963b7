"""State machines over ordered rows, run in parallel: what a stretch of rows does to every state is one small map, and maps
of stretches compose. So a key may hold any share of the rows; none of its rows are gathered."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsieve.operators.spread import cut

#: Most partitions of the ordered rows; each gives one row to the broadcast entry states.
MOST_PARTS = 20_000


@dataclass(frozen=True)
class Machine:
    """moves[symbol][state] is the next state; what isn't named stays. The first state is that of a new key."""

    states: tuple[str, ...]
    moves: dict[str, dict[str, str]]

    def tables(self) -> dict[str, list[int]]:
        at = {s: i for i, s in enumerate(self.states)}
        return {x: [at[m.get(s, s)] for s in self.states] for x, m in self.moves.items()}


def run(rows: DataFrame, machine: Machine, key: str, order: list[str], symbol: str, rows_per_part: int = 200_000) -> DataFrame:
    """rows with before and after, the states around each row. A null key is a key; unknown and null symbols change nothing;
    rows equal in order are taken by their symbol.

    Rows are range-sorted. Each partition says what its rows do to its last key; these maps, one a partition, are composed
    per key to the state in which the key enters each partition, and a second pass over the sorted rows starts from there."""
    kept = cut(rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")).alias("k"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(symbol).alias("x"), F.monotonically_increasing_id().alias("tie")))
    n = kept.count()
    parts = max(1, min(MOST_PARTS, max(-(-n // rows_per_part), min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), n))))
    by = ["k", *[f"o{i}" for i in range(len(order))], "x", "tie"]
    placed = cut(kept.repartitionByRange(parts, *by).sortWithinPartitions(*by).select("row", "k", "x", F.spark_partition_id().alias("part")))
    tables, size, names = machine.tables(), len(machine.states), machine.states

    def folds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = first = last = None
        f = list(range(size))
        for batch in batches:
            for p, k, x in zip(*(c.to_pylist() for c in batch.columns)):
                if k != last:
                    first = k if part is None else first
                    part, last, f = p, k, list(range(size))
                if x in tables:
                    t = tables[x]
                    f = [t[s] for s in f]
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([first]), pa.array([last]), pa.array([f], pa.list_(pa.int32()))], ["part", "first", "last", "f"])

    ends = cut(placed.select("part", "k", "x").mapInArrow(folds, "part int, first string, last string, f array<int>"))
    maps = ends.groupBy("last").agg(F.array_sort(F.collect_list(F.struct("part", "f"))).alias("fs"))  # a row of each partition at most
    zero = F.struct(F.lit(0).alias("s"), F.array().cast("array<struct<part:int,s:int>>").alias("out"))

    def step(acc, e):
        s = F.get(e["f"], acc["s"])
        return F.struct(s.alias("s"), F.concat(acc["out"], F.array(F.struct(e["part"].alias("part"), s.alias("s")))).alias("out"))

    left = maps.select(F.col("last").alias("k"), F.explode(F.aggregate("fs", zero, step)["out"]).alias("e")).select("k", "e.part", "e.s", F.lit(1).alias("end"))
    asks = ends.select(F.col("first").alias("k"), "part", F.lit(None).cast("int").alias("s"), F.lit(0).alias("end"))
    earlier = Window.partitionBy("k").orderBy("part", "end").rowsBetween(Window.unboundedPreceding, -1)
    entry = left.unionByName(asks).withColumn("entry", F.last("s", ignorenulls=True).over(earlier)).filter("end = 0").select("part", "entry")

    kind = placed.schema["row"].dataType

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = s = None
        for batch in batches:
            before, after = [], []
            for k, x, e in zip(*(batch.column(c).to_pylist() for c in ("k", "x", "entry"))):
                if k != last:
                    s = e or 0 if last is None else 0
                    last = k
                before.append(names[s])
                s = tables[x][s] if x in tables else s
                after.append(names[s])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(before, pa.string()), pa.array(after, pa.string())], ["row", "before", "after"])

    schema = T.StructType([T.StructField("row", kind), T.StructField("before", T.StringType()), T.StructField("after", T.StringType())])
    walked = placed.join(F.broadcast(entry), "part", "left").select("row", "k", "x", "entry").mapInArrow(walk, schema)
    return walked.select(*[F.col("row").getField(c).alias(c) for c in rows.columns if c not in ("before", "after")], "before", "after")


#: A platform's login. alive: its kept session works; refreshed: it doesn't, but the browser had one that does; dead: neither;
#: peek: it doesn't, and only a look was asked for; error: the check failed.
LOGIN = Machine(("fresh", "alive", "login_needed"), {
    "alive": dict.fromkeys(("fresh", "alive", "login_needed"), "alive"),
    "refreshed": dict.fromkeys(("fresh", "alive", "login_needed"), "alive"),
    "dead": dict.fromkeys(("fresh", "alive", "login_needed"), "login_needed"),
})


def login_states(checks: DataFrame, key: str = "platform", order: list[str] | None = None, symbol: str = "outcome") -> DataFrame:
    """checks with before, after, result (what the check says) and notice: 'back' for a session that works again after a
    login was asked for, 'ask' where one is to be asked for (``cooled_down`` spaces these)."""
    x = F.col(symbol)
    result = F.when(x.isin("alive", "refreshed"), x).when(x.isin("dead", "peek"), "login_needed").otherwise("unknown")
    notice = F.when((x == "alive") & (F.col("before") == "login_needed"), "back").when(x == "dead", "ask")
    return run(checks, LOGIN, key, order or ["at"], symbol).withColumns({"result": result, "notice": notice})
