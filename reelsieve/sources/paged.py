"""A stored listing as a stream of pages: each page is read once, by the task that needs it, and what was read stays read.

The store is a Parquet folder whose key counts the entries; a page is ``size`` keys. Offsets are page numbers, so the
progress that Spark keeps is a number of whole pages: a scan that is stopped, or times out, keeps what it has, and the next
one goes on behind it. A page with the same entries as the one before it (a site that has no more pages repeats its last
one) gives nothing. A limit ends the listing after so many entries. Read as a table, comparisons of a column with a value
are answered by the files' reader.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, LessThan, LessThanOrEqual

_SIGNS = {EqualTo: "eq", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt", LessThanOrEqual: "le"}


class Page(InputPartition):
    def __init__(self, no: int):
        self.no = no


class _Pages:
    def __init__(self, options: dict, names: list[str]):
        self.path, self.key, self.same = options["path"], options["key"], options["same"]
        self.size, self.tail = int(options.get("size", "100")), options.get("tail", "false").lower() == "true"
        self.limit = int(options["limit"]) if "limit" in options else None
        self.names = names
        self.where: list[tuple] = []

    def count(self) -> int:
        """Pages up to the limit in the store, from the files' statistics alone; one that may still grow counts with tail."""
        import pyarrow.dataset as ds

        highest = -1
        for fragment in ds.dataset(self.path, format="parquet").get_fragments():
            for group in fragment.row_groups:
                if (seen := (group.statistics or {}).get(self.key)) and seen["max"] is not None:
                    highest = max(highest, seen["max"])
        there = (highest + 1) // self.size + (self.tail and (highest + 1) % self.size > 0)
        return there if self.limit is None else min(there, -(-self.limit // self.size))

    def entries(self, no: int, names: list[str], where: list[tuple] = ()) -> pa.Table:
        import operator

        import pyarrow.dataset as ds

        key, end = ds.field(self.key), (no + 1) * self.size
        kept = (key >= no * self.size) & (key < (end if self.limit is None else min(end, self.limit)))
        for column, sign, value in where:
            kept = kept & (ds.field(column).is_valid() if sign == "is_valid" else getattr(operator, sign)(ds.field(column), value))
        return ds.dataset(self.path, format="parquet").to_table(columns=list(dict.fromkeys([self.key, *names])), filter=kept).sort_by(self.key)

    def read(self, page: Page) -> Iterator[pa.RecordBatch]:
        here, before = (self.entries(n, [self.same])[self.same].to_pylist() if n >= 0 else None for n in (page.no, page.no - 1))
        if here == before:
            return
        rows = self.entries(page.no, self.names, self.where)
        table = pa.table([pa.array([page.no] * rows.num_rows, pa.int64()), *(rows[c] for c in self.names)], names=["page", *self.names])
        yield from table.to_batches()


class _BatchReader(_Pages, DataSourceReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if isinstance(f, (IsNotNull, *_SIGNS)) and len(f.attribute) == 1 else "page"
            if column != "page" and isinstance(f, IsNotNull):
                self.where.append((column, "is_valid", None))
            elif column != "page" and isinstance(f.value, (int, float, str)):
                self.where.append((column, _SIGNS[type(f)], f.value))
            else:
                yield f

    def partitions(self) -> list[Page]:
        return [Page(n) for n in range(self.count())]


class _StreamReader(_Pages, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        return {"page": self.count()}

    def partitions(self, start: dict, end: dict) -> list[Page]:
        return [Page(n) for n in range(start["page"], end["page"])]

    def commit(self, end: dict) -> None:
        pass


class PagedListing(DataSource):
    """Options: path, key (a column that counts entries from 0), same (the column that tells a repeated page), columns (name
    and type of what to read), size (100), tail (also the last page if it isn't full), limit (entries; none)."""

    @classmethod
    def name(cls) -> str:
        return "paged_listing"

    def schema(self) -> str:
        return f"page long, {self.options['columns']}"

    def _names(self, schema) -> list[str]:
        return [c for c in schema.names if c != "page"]

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(dict(self.options), self._names(schema))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(dict(self.options), self._names(schema))


def paged_listing(spark: SparkSession, stream: bool = False, **options: str) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedListing)
    return (spark.readStream if stream else spark.read).format("paged_listing").options(**options).load()
