"""What the engine asks of outside programs (network, codecs, models).

Media measurements are rows that a probe delivers; everything after them is column expressions. Listings are read from
stored pages (``paged``).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def measure(rows: DataFrame, adapter: Callable[[dict], dict], schema: str, error: str = "error") -> DataFrame:
    """adapter(row) for each row, in the executors; its fields by schema, and what it raised as text, never a failure.
    The adapter may load a model on its first call and keep it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                try:
                    out.append({**row, **adapter(row), error: None})
                except Exception as e:  # an adapter's fault is a value here
                    out.append({**row, error: f"{type(e).__name__}: {e}"})
            yield pa.RecordBatch.from_pylist(out, schema=target)

    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    added = T._parse_datatype_string(schema)
    full = T.StructType([*rows.schema.fields, *added.fields, T.StructField(error, T.StringType())])
    target = to_arrow_schema(full)
    return rows.mapInArrow(run, full)


CLASSIFIERS: dict[str, Callable[[dict], dict]] = {}


def classifier(kind: str) -> Callable[[dict], dict]:
    if kind not in CLASSIFIERS:
        raise ValueError(f"no classifier {kind!r}")
    return CLASSIFIERS[kind]


def register_classifier(kind: str, assess: Callable[[dict], dict]) -> None:
    CLASSIFIERS[kind] = assess


def probe_fields(text: str) -> dict:
    """The fields of a media probe's JSON that the rules use, with the sides swapped for a quarter turn."""
    v = json.loads(text)
    w, h = v.get("width"), v.get("height")
    return {"width": h if v.get("rotation") in (90, 270, -90) else w, "height": w if v.get("rotation") in (90, 270, -90) else h, "avg_frame_rate": v.get("avg_frame_rate"), "r_frame_rate": v.get("r_frame_rate")}
