"""Geometry, rates, scores, clocks and expiry times as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelsieve.plans.catalog import BACKOFF_HOURS, BACKOFF_MAX_HOURS, CLOCK_FORM, DATE_FORM, HI, LO, MAX_DURATION, MAX_DURATION_DEFAULT, RECORDER_SUFFIXES, RECORDER_TAGS, STREAK_LIMIT


def is_portrait(w: Column, h: Column, tolerance: float = 0.05) -> Column:
    return F.coalesce((h > 0) & (F.abs(F.try_divide(w.cast("double"), h.cast("double")) - 0.5625) < tolerance), F.lit(False))


def max_duration(platform: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in MAX_DURATION.items() for x in kv])
    return F.coalesce(F.try_element_at(known, platform), F.lit(MAX_DURATION_DEFAULT))


def parse_rate(rate: Column) -> Column:
    """'n/d' as frames a second in (0, 120], else null."""
    r = F.try_divide(F.split_part(rate, F.lit("/"), F.lit(1)).try_cast("double"), F.split_part(rate, F.lit("/"), F.lit(2)).try_cast("double"))
    return F.when((r > 0) & (r <= 120), r)


def frame_rate(avg: Column, real: Column) -> Column:
    return F.coalesce(parse_rate(avg), parse_rate(real), F.lit(25.0))


def iou(ax1, ay1, ax2, ay2, bx1, by1, bx2, by2) -> Column:
    """Intersection over union of two corner boxes; 0 where the union is empty."""
    zero = F.lit(0.0)
    inter = F.greatest(zero, F.least(ax2, bx2) - F.greatest(ax1, bx1)) * F.greatest(zero, F.least(ay2, by2) - F.greatest(ay1, by1))
    union = (ax2 - ax1) * (ay2 - ay1) + (bx2 - bx1) * (by2 - by1) - inter
    return F.coalesce(F.try_divide(inter, union), zero)


def crop_corners(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column, expand=(0.0, 0.0, 0.0, 0.0)) -> list[Column]:
    """Centre box in shares of the image -> x1, y1, x2, y2 in whole pixels, grown by shares (top, bottom, left, right)
    of the box and held inside the image."""
    top, bottom, left, right = expand
    bw, bh = w * width, h * height
    x1, y1, x2, y2 = (x - w / 2) * width, (y - h / 2) * height, (x + w / 2) * width, (y + h / 2) * height
    grown = [x1 - left * bw, y1 - top * bh, x2 + right * bw, y2 + bottom * bh]
    whole = [c.cast("int") for c in grown]
    return [F.greatest(F.lit(0), F.least(c, (width if i % 2 == 0 else height).cast("int"))) for i, c in enumerate(whole)]


def centre_box(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> list[Column]:
    return [(x1 + x2) / 2 / width, (y1 + y2) / 2 / height, (x2 - x1) / width, (y2 - y1) / height]


def scale_up(x: Column) -> Column:
    """Up to the next whole number from a fraction of 0.2 on, else down."""
    return F.when(x - F.floor(x) >= 0.2, F.ceil(x)).otherwise(x.cast("long"))


def softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    es = F.transform(logits, lambda x: F.exp(x - top))
    return F.transform(es, lambda e: e / F.aggregate(es, F.lit(0.0), lambda s, x: s + x))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def segment_evidence(p_visual, ts_score, eff_fps, fps, gray_ratio, probe: bool = False) -> Column:
    ts = F.when(ts_score >= 1, 4.0).when(ts_score >= 0.75, 3.0).when(ts_score >= 0.4, 1.5).otherwise(0.0)
    slow = F.when((eff_fps <= 16) & (fps >= 23), 1.5).otherwise(0.0)
    gray = F.when(gray_ratio >= 0.5, 0.5).otherwise(0.0)
    return F.lit(8.0 if probe else 5.0) * (p_visual - 0.5) + ts + slow + gray


def segment_prob(evidence: Column) -> Column:
    return 1 / (1 + F.exp(1.0 - evidence))


def segment_label(p: Column, hi: float = HI, lo: float = LO) -> Column:
    return F.when(p >= hi, "cctv").when(p <= lo, "not_cctv").otherwise("uncertain")


def clock_seconds(text: Column) -> Column:
    """Array of the times of day that stand in a text, in seconds."""
    found = F.regexp_extract_all(text, F.lit(CLOCK_FORM), F.lit(1))
    return F.transform(found, lambda t: F.aggregate(F.transform(F.split(t, "[:.]"), lambda x: x.cast("int")), F.lit(0), lambda s, x: s * 60 + x))


def has_date(text: Column) -> Column:
    return F.rlike(text, F.lit(DATE_FORM))


def is_recorder(suffix: Column, container: Column, tags: Column) -> Column:
    """Made by a recorder, by file suffix, container or tags."""
    return F.lower(suffix).isin(*RECORDER_SUFFIXES) | F.rlike(F.lower(F.coalesce(container, F.lit(""))), F.lit("dhav")) | F.rlike(F.lower(F.coalesce(tags, F.lit(""))), F.lit(RECORDER_TAGS))


def backoff_hours(streak: Column) -> Column:
    """Hours of back-off after so many visits without a video; null below the limit."""
    over = streak - STREAK_LIMIT
    return F.when(over >= 0, F.least(F.lit(BACKOFF_HOURS) * F.pow(F.lit(2.0), over), F.lit(float(BACKOFF_MAX_HOURS))))


def normalize_expires(raw: Column) -> Column:
    """Microseconds since 1601, milliseconds or seconds since 1970 -> whole seconds since 1970; -1 for none or nonsense."""
    v = raw.cast("double")
    s = F.when(v > 1e14, v / 1_000_000 - 11_644_473_600).when(v > 1e11, v / 1000).otherwise(v)
    return F.when((v > 0) & (s > 0) & (s <= 1e11), F.floor(s)).otherwise(F.lit(-1)).cast("long")


def parse_stamp(text: Column) -> Column:
    """Timestamp of three written forms; an offset is dropped, not applied."""
    t = F.split_part(F.replace(text, F.lit("T"), F.lit(" ")), F.lit("+"), F.lit(1))
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in ("yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm")])


def frame_ms(frame: Column, fps: Column, duration_s: Column) -> Column:
    return F.least(F.bround(frame / fps * 1000), duration_s * 1000).cast("long")


def minutes_up(seconds: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(seconds / 60)).cast("long")


def view_starts(total: int, span: int, clips: int = 0) -> list[int]:
    """First frames of evenly spread clips of span frames; 0 clips for as many as cover the window."""
    n = clips or max(1, -(-total // span))
    last = max(0, total - span)
    return [int(last * i / (n - 1)) if n > 1 else last // 2 for i in range(n)]
