"""Detections: suppression, priorities, class conditions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsieve.functions.media import iou
from reelsieve.plans.catalog import CLASS_PRIORITY


def _overlap(a, b) -> Column:
    return iou(*[a[c] for c in ("x1", "y1", "x2", "y2")], *[b[c] for c in ("x1", "y1", "x2", "y2")])


def suppress(boxes: Column, threshold: float) -> Column:
    """Boxes (array of structs with corners, in the order of preference) without those that overlap a kept one by more
    than the threshold. A fold: each depends on what was kept before."""
    return F.aggregate(boxes, F.slice(boxes, 1, 0), lambda kept, b: F.when(F.exists(kept, lambda k: _overlap(k, b) > threshold), kept).otherwise(F.concat(kept, F.array(b))))


def nms(boxes: DataFrame, image: str, order: str, threshold: float) -> DataFrame:
    """Rows (image, order, x1, y1, x2, y2) that suppression keeps; a group is the boxes of one image."""
    one = F.struct(order, "x1", "y1", "x2", "y2")
    return boxes.groupBy(image).agg(F.array_sort(F.collect_list(one)).alias("b")).select(image, F.explode(suppress(F.col("b"), threshold)).alias("k")).select(image, "k.*")


def overlapping_pairs(boxes: DataFrame, image: str, key: str, threshold: float) -> DataFrame:
    """image, a, b, iou of pairs of boxes of an image (a before b) over the threshold."""
    a = boxes.select(image, F.col(key).alias("a"), F.struct("x1", "y1", "x2", "y2").alias("p"))
    b = boxes.select(image, F.col(key).alias("b"), F.struct("x1", "y1", "x2", "y2").alias("q"))
    return a.join(b, image).filter("a < b").select(image, "a", "b", _overlap(F.col("p"), F.col("q")).alias("iou")).filter(F.col("iou") > threshold)


def _settled(owner, rank, conf, x, y, w, h, threshold: float, large: int = 256):
    """Which boxes stay, of boxes of ascending owners in the order of their scan. Pairs of an owner's boxes are compared
    all at once, unless there are over ``large``: then each box is compared with those kept so far."""
    import numpy as np

    def over(i, j):
        wide = np.minimum(x[i] + w[i] / 2, x[j] + w[j] / 2) - np.maximum(x[i] - w[i] / 2, x[j] - w[j] / 2)
        high = np.minimum(y[i] + h[i] / 2, y[j] + h[j] / 2) - np.maximum(y[i] - h[i] / 2, y[j] - h[j] / 2)
        both = np.maximum(0.0, wide) * np.maximum(0.0, high)
        union = w[i] * h[i] + w[j] * h[j] - both
        return (union > 0) & (both / np.where(union > 0, union, 1.0) > threshold)

    def loses(new: int, old: int) -> bool:
        return rank[new] < rank[old] or (rank[new] == rank[old] and conf[new] <= conf[old])

    n = len(owner)
    stays = np.ones(n, bool)
    begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(begins, n))
    left = np.arange(n)[np.repeat(sizes <= large, sizes)]
    earlier, later, d = [], [], 0
    while len(left):
        d += 1
        left = left[left + d < n]
        left = left[owner[left] == owner[left + d]]
        hit = left[over(left, left + d)]
        earlier.append(hit)
        later.append(hit + d)
    if earlier:
        i, j = np.concatenate(earlier), np.concatenate(later)
        order, done = np.lexsort((i, j)), -1
        for new, old in zip(j[order].tolist(), i[order].tolist()):
            if new != done and stays[old]:  # the first kept one that it overlaps
                done = new
                stays[new if loses(new, old) else old] = False
    for begin, size in zip(begins[sizes > large].tolist(), sizes[sizes > large].tolist()):
        for new in range(begin + 1, begin + size):
            kept = begin + np.flatnonzero(stays[begin:new])
            hit = kept[over(kept, new)]
            if len(hit):
                stays[new if loses(new, hit[0]) else hit[0]] = False
    return stays


def priority_overlap(detections: DataFrame, image: str, threshold: float) -> DataFrame:
    """Detections (image, class_name, x, y, w, h, conf) after overlaps are settled by class priority: scanned by falling
    confidence (ties in the order of class name, place and size), one that overlaps a kept one replaces it if its class ranks
    higher, or equal with more confidence. Order matters, so an image's boxes meet in one row, and the few that overlap are
    settled one after the other."""
    kind = dict(detections.dtypes)[image]
    box = "class_name string, x double, y double, w double, h double, conf double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            groups = batch.column(1)
            boxes = groups.flatten()
            owner = np.repeat(np.arange(len(groups)), groups.value_lengths().to_numpy(zero_copy_only=False))
            names = boxes.field(0).dictionary_encode()
            codes = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            known = names.dictionary.to_pylist()
            place = np.append(np.argsort(np.argsort(np.array(known, object))), -1)[codes]
            rank = np.array([CLASS_PRIORITY.get(c, 0) for c in [*known, None]])[codes]
            x, y, w, h, conf = (boxes.field(i).to_numpy(zero_copy_only=False) for i in range(1, 6))
            order = np.lexsort((h, w, y, x, place, -conf, owner))
            stays = _settled(*(v[order] for v in (owner, rank, conf, x, y, w, h)), threshold)
            at = pa.array(order[stays])
            rows = boxes.take(at)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner).take(at)), *(rows.field(i) for i in range(6))], [image, *(c.split()[0] for c in box.split(", "))])

    groups = detections.groupBy(image).agg(F.collect_list(F.struct(*[c.split()[0] for c in box.split(", ")])).alias("boxes"))
    return groups.mapInArrow(run, f"{image} {kind}, {box}")


def has_all(present: Column, classes: list[int]) -> Column:
    return F.size(F.array_except(F.array(*map(F.lit, classes)), present)) == 0


def class_condition(present: Column, condition) -> Column:
    """None: always; a tuple: all of them; a list of numbers: any; a list of tuples: all of any of them."""
    if condition is None:
        return F.lit(True)
    if isinstance(condition, tuple):
        return has_all(present, list(condition))
    if not isinstance(condition, list) or not condition:
        raise ValueError("a class condition is None, a tuple, or a list that is not empty")
    out = F.lit(False)
    for c in condition:
        out = out | (has_all(present, list(c)) if isinstance(c, tuple) else F.array_contains(present, c))
    return out


def enough(classes: Column, class_id: int, least: int) -> Column:
    return F.coalesce(F.size(F.filter(classes, lambda c: c == class_id)) >= least, F.lit(False))


def confident(conf: Column, cls: Column, threshold: float, own: dict[int, float] | None = None) -> Column:
    """Confidence over the class's own threshold, or the general one."""
    limits = F.create_map(*[F.lit(x) for kv in (own or {}).items() for x in kv]) if own else None
    least = F.coalesce(F.try_element_at(limits, cls), F.lit(threshold)) if own else F.lit(threshold)
    return F.coalesce(conf > least, F.lit(False))


def crop_boxes(detections: DataFrame, sizes: DataFrame, image: str, classes: list[int], threshold: float | None = 0.7, least: tuple[int, int] = (0, 0), more: tuple[int, int, int, int] = (0, 0, 0, 0)) -> DataFrame:
    """image, no, x1, y1, x2, y2: what to cut out of each image (width, height in sizes). detections (image, no, cls, and as
    shares of the image x, y of the centre, w, h): those of the classes, without overlaps over the threshold, widened by
    pixels (top, bottom, left, right), kept inside the image, and of a least width and height."""
    d = detections.filter(F.col("cls").isin(*classes)).join(sizes, image)
    side = lambda c, size, half, total: ((F.col(c) + half * F.col(size)) * F.col(total)).cast("long")
    boxes = d.select(image, "no", side("x", "w", -0.5, "width").alias("x1"), side("y", "h", -0.5, "height").alias("y1"), side("x", "w", 0.5, "width").alias("x2"), side("y", "h", 0.5, "height").alias("y2"))
    kept = boxes if threshold is None else nms(boxes, image, "no", threshold)
    top, bottom, left, right = more
    zero = F.lit(0).cast("long")
    inside = kept.join(sizes, image).select(
        image, "no", F.greatest(zero, F.col("x1") - left).alias("x1"), F.greatest(zero, F.col("y1") - top).alias("y1"),
        F.least(F.col("width").cast("long"), F.col("x2") + right).alias("x2"), F.least(F.col("height").cast("long"), F.col("y2") + bottom).alias("y2"))
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    return inside.filter((w > 0) & (h > 0) & (w >= least[0]) & (h >= least[1]))
