"""Crops of slanted boxes: the size of the upright crop and the map that takes the box to it."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _far(a: Column, b: Column) -> Column:
    return F.sqrt(F.pow(a["x"] - b["x"], 2) + F.pow(a["y"] - b["y"], 2))


def crop_size(points: Column) -> Column:
    """Whole width and height of four corners (structs x, y) from the upper left clockwise: the longer of opposite sides."""
    p = [F.get(points, F.lit(i)) for i in range(4)]
    width = F.floor(F.greatest(_far(p[0], p[1]), _far(p[2], p[3])))
    height = F.floor(F.greatest(_far(p[0], p[3]), _far(p[1], p[2])))
    return F.struct(width.cast("int").alias("width"), height.cast("int").alias("height"))


def is_upright_text(size: Column) -> Column:
    """A crop that is turned by a quarter: half again as high as wide, or more."""
    return size["height"] / size["width"] >= 1.5


def homography(points: Column, size: Column) -> Column:
    """Nine numbers, row by row and the last one 1: the projective map that takes the corners to those of the crop. Null where
    there is none (corners in a line, no width or height).

    The unit square goes to the corners by a map in closed form; its adjugate goes back, and is scaled to the crop."""
    p = [F.get(points, F.lit(i)) for i in range(4)]
    x, y = [q["x"] for q in p], [q["y"] for q in p]
    dx1, dx2, sx = x[1] - x[2], x[3] - x[2], x[0] - x[1] + x[2] - x[3]
    dy1, dy2, sy = y[1] - y[2], y[3] - y[2], y[0] - y[1] + y[2] - y[3]
    den = dx1 * dy2 - dx2 * dy1
    g, h = F.try_divide(sx * dy2 - dx2 * sy, den), F.try_divide(dx1 * sy - sx * dy1, den)
    m = [x[1] - x[0] + g * x[1], x[3] - x[0] + h * x[3], x[0], y[1] - y[0] + g * y[1], y[3] - y[0] + h * y[3], y[0], g, h, F.lit(1.0)]

    def adjugate(v: Column) -> Column:
        a = [F.get(v, F.lit(i)) for i in range(9)]
        back = [
            a[4] * a[8] - a[5] * a[7], a[2] * a[7] - a[1] * a[8], a[1] * a[5] - a[2] * a[4],
            a[5] * a[6] - a[3] * a[8], a[0] * a[8] - a[2] * a[6], a[2] * a[3] - a[0] * a[5],
            a[3] * a[7] - a[4] * a[6], a[1] * a[6] - a[0] * a[7], a[0] * a[4] - a[1] * a[3],
        ]
        return F.array(*back)

    def scaled(v: Column) -> Column:
        b = [F.get(v, F.lit(i)) for i in range(9)]
        sides = [size["width"]] * 3 + [size["height"]] * 3 + [F.lit(1)] * 3
        return F.array(*[F.try_divide(n * s, b[8]) for n, s in zip(b, sides)])

    sound = F.coalesce((size["width"] > 0) & (size["height"] > 0) & (den != 0), F.lit(False))
    solved = F.transform(F.transform(F.array(F.when(sound, F.array(*m))), adjugate), scaled)
    return F.element_at(F.transform(solved, lambda s: F.when(~F.exists(s, lambda v: v.isNull()), s)), 1)


def project(matrix: Column, x: Column, y: Column) -> Column:
    """Where a point goes."""
    a = [F.get(matrix, F.lit(i)) for i in range(9)]
    w = a[6] * x + a[7] * y + a[8]
    return F.struct(F.try_divide(a[0] * x + a[1] * y + a[2], w).alias("x"), F.try_divide(a[3] * x + a[4] * y + a[5], w).alias("y"))


def corners_in_crop(rows: DataFrame, keep: list[str], corners: list[tuple[str, str]]) -> DataFrame:
    """keep, width, height, corners: the crop of four corners (columns x, y) and where its map takes them, to a millionth, x
    and y in turn; nulls where there is no map. The formulas of ``homography`` and ``project``, over batches of rows."""
    points = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in corners])
    flat = [c for corner in corners for c in corner]
    sized = rows.withColumn("_size", crop_size(points)).select(*keep, F.col("_size.width").alias("width"), F.col("_size.height").alias("height"), *[F.col(c).cast("double").alias(c) for c in flat])
    names = [*keep, "width", "height"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sized.schema.fields if f.name in names) + ", corners array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            value = [c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns[len(keep) :]]
            (width, height), x, y = value[:2], value[2::2], value[3::2]
            with np.errstate(all="ignore"):
                dx1, dx2, sx = x[1] - x[2], x[3] - x[2], x[0] - x[1] + x[2] - x[3]
                dy1, dy2, sy = y[1] - y[2], y[3] - y[2], y[0] - y[1] + y[2] - y[3]
                den = dx1 * dy2 - dx2 * dy1
                g, h = (sx * dy2 - dx2 * sy) / den, (dx1 * sy - sx * dy1) / den
                a = [x[1] - x[0] + g * x[1], x[3] - x[0] + h * x[3], x[0], y[1] - y[0] + g * y[1], y[3] - y[0] + h * y[3], y[0], g, h, 1.0]
                back = [
                    a[4] * a[8] - a[5] * a[7], a[2] * a[7] - a[1] * a[8], a[1] * a[5] - a[2] * a[4],
                    a[5] * a[6] - a[3] * a[8], a[0] * a[8] - a[2] * a[6], a[2] * a[3] - a[0] * a[5],
                    a[3] * a[7] - a[4] * a[6], a[1] * a[6] - a[0] * a[7], a[0] * a[4] - a[1] * a[3],
                ]
                m = [b * s / back[8] for b, s in zip(back, [width] * 3 + [height] * 3 + [1.0] * 3)]
                out = np.empty((len(den), 8))
                for i in range(4):
                    w = m[6] * x[i] + m[7] * y[i] + m[8]
                    out[:, 2 * i] = (m[0] * x[i] + m[1] * y[i] + m[2]) / w
                    out[:, 2 * i + 1] = (m[3] * x[i] + m[4] * y[i] + m[5]) / w
                sound = (width > 0) & (height > 0) & (den != 0) & (back[8] != 0)
                out = np.rint(out * 1e6) / 1e6
            known = np.isfinite(out) & sound[:, None]
            whole = pa.array(np.where(known, out, 0.0).astype(np.int64).ravel(), mask=~known.ravel())
            offsets = pa.array(np.arange(0, 8 * len(den) + 1, 8), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.ListArray.from_arrays(offsets, whole)], [*names, "corners"])

    return sized.mapInArrow(run, schema)
