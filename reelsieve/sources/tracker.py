"""The crawl's own database as a source: read-only, in ranges of its key, with filters answered by the database.

A missing file or table, or one that is locked or lacks a column, is an empty table; a report goes on without it.
"""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual

_SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _name(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class KeyRange(InputPartition):
    def __init__(self, low: int | None, high: int | None):
        self.low, self.high = low, high


class TrackerReader(DataSourceReader):
    def __init__(self, options: dict, names: list[str]):
        self.path, self.table, self.parts = options["path"], options["table"], int(options.get("parts", "4"))
        self.names = names
        self.where: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if type(f) in _SIGNS and column and isinstance(f.value, (int, float, str)):
                self.where.append(f"{_name(column)} {_SIGNS[type(f)]} ?")
                self.values.append(f.value)
            elif isinstance(f, In) and column and all(isinstance(v, (int, float, str)) for v in f.value):
                self.where.append(f"{_name(column)} IN ({', '.join('?' * len(f.value))})")
                self.values += f.value
            elif isinstance(f, (IsNull, IsNotNull)) and column:
                self.where.append(f"{_name(column)} IS {'NOT ' * isinstance(f, IsNotNull)}NULL")
            else:
                yield f

    def _ask(self, sql: str, values: list) -> Iterator[tuple]:
        if not os.path.exists(self.path):
            return
        try:
            db = sqlite3.connect(f"file:{self.path}?mode=ro", uri=True, timeout=10)
            try:
                yield from db.execute(sql, values)
            finally:
                db.close()
        except sqlite3.Error:
            return

    def partitions(self) -> list[KeyRange]:
        low, high = next(self._ask(f"SELECT min(rowid), max(rowid) FROM {_name(self.table)}", []), (None, None))
        if low is None:
            return [KeyRange(None, None)]
        step = max(1, -(-(high - low + 1) // self.parts))
        return [KeyRange(a, a + step) for a in range(low, high + 1, step)]

    def read(self, part: KeyRange) -> Iterator[tuple]:
        if part.low is None:
            return
        where = " AND ".join(["rowid >= ?", "rowid < ?", *self.where])
        yield from self._ask(f"SELECT {', '.join(map(_name, self.names))} FROM {_name(self.table)} WHERE {where}", [part.low, part.high, *self.values])


class Tracker(DataSource):
    """Options path, table, columns (names and types), parts (4)."""

    @classmethod
    def name(cls) -> str:
        return "tracker"

    def schema(self) -> str:
        return self.options["columns"]

    def reader(self, schema) -> DataSourceReader:
        return TrackerReader(dict(self.options), list(schema.names))


def tracker(spark: SparkSession, path: str, table: str, columns: str, parts: int = 4) -> DataFrame:
    """columns: DDL of what to read; times are text, as the database keeps them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Tracker)
    return spark.read.format("tracker").options(path=path, table=table, columns=columns, parts=str(parts)).load()
