"""Writing in two phases: tasks write to a staging folder, and what all of them wrote is published at once or not at all.

A write has a staging folder of its own. Every attempt of a task writes a file of its own there and names it in its commit
message; the driver moves the named files next to the table's others and then publishes the write by one small
manifest, moved into place whole. Files that no manifest names are not part of the table. Whatever failed or repeated
attempts left behind goes with the staging folder, on success and on failure.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: Folders that Spark's readers pass over.
STAGING, MANIFESTS = "_staging", "_manifests"


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    file: str
    part: int
    rows: int


class StagedWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.job = path.rstrip("/"), uuid.uuid4().hex
        files, folder = _store(self.staging)
        files.create_dir(folder)  # by the driver: a task that is still busy when all is given up can't bring it back

    @property
    def staging(self) -> str:
        return f"{self.path}/{STAGING}/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyarrow import parquet
        from pyspark import TaskContext

        task = TaskContext.get()
        part = task.partitionId() if task else 0
        files, folder = _store(self.staging)
        name, rows, out = f"{part:05d}-{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                out = out or parquet.ParquetWriter(f"{folder}/{name}", batch.schema, filesystem=files)
                out.write_batch(batch)
                rows += batch.num_rows
        finally:
            if out:
                out.close()
        return Written(name if out else "", part, rows)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = _store(self.path)
        staged = _store(self.staging)[1]
        named = sorted((m for m in messages if m and m.file), key=lambda m: m.part)
        listed = [{"file": f"part-{m.part:05d}-{self.job}.parquet", "rows": m.rows} for m in named]
        for m, entry in zip(named, listed):
            files.move(f"{staged}/{m.file}", f"{root}/{entry['file']}")
        with files.open_output_stream(f"{staged}/manifest") as out:
            out.write(json.dumps({"job": self.job, "files": listed}).encode())
        manifests = f"{root}/{MANIFESTS}"
        files.create_dir(manifests)
        files.move(f"{staged}/manifest", f"{manifests}/{self.job}.json")
        self._release(files)

    def abort(self, messages: list[Written | None]) -> None:
        self._release(_store(self.path)[0])

    def _release(self, files) -> None:
        from pyarrow import fs

        staged = _store(self.staging)[1]
        if files.get_file_info(staged).type != fs.FileType.NotFound:
            files.delete_dir(staged)


class StagedTable(DataSource):
    """Appends rows to a folder of Parquet files in two phases; option path."""

    @classmethod
    def name(cls) -> str:
        return "staged_table"

    def writer(self, schema, overwrite: bool) -> StagedWriter:
        if overwrite:
            raise ValueError("a staged table is appended to")
        return StagedWriter(self.options["path"])


def publish(df: DataFrame, path: str) -> None:
    """Append df's rows to the table at path; none of them is there before all are."""
    df.sparkSession.dataSource.register(StagedTable)
    df.write.format("staged_table").mode("append").option("path", path).save()


def published(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all published writes. A folder without any, or that is missing, is an empty table."""
    from pyarrow import fs

    files, root = _store(path.rstrip("/"))
    there = files.get_file_info(fs.FileSelector(f"{root}/{MANIFESTS}", allow_not_found=True))
    listed = []
    for info in sorted(there, key=lambda i: i.path):
        with files.open_input_stream(info.path) as f:
            listed += [f"{path.rstrip('/')}/{e['file']}" for e in json.loads(f.read())["files"]]
    return spark.read.schema(schema).parquet(*listed) if listed else spark.createDataFrame([], schema)
