"""Texts that a crawl says or asks for: search targets, one-line summaries, plate and detection lines, valid paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IMAGE_SUFFIXES = (".jpg", ".png", ".jpeg", ".bmp", ".tiff")
#: The counters of a run's summary, in order, and the outcomes that each sums.
RUN_COUNTERS = (
    ("not_cctv", ("not_cctv",)), ("uncertain", ("uncertain_cctv",)), ("no_event", ("no_event",)),
    ("no_frame", ("no_valid_frame",)), ("portrait", ("portrait",)), ("failed", ("failed", "error")),
)


def quoted(text: Column) -> Column:
    """A text as a part of a url's path: spaces are %20 and slashes stay."""
    return F.replace(F.replace(F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/")), F.lit("*"), F.lit("%2A"))


def search_target(platform: Column, keyword: Column, limit: Column) -> Column:
    """What to hand to a listing: a search of its own kind for one platform, a search page's url for another, else null."""
    youtube = F.concat(F.lit("ytsearch"), limit.cast("string"), F.lit(":"), keyword)
    dailymotion = F.concat(F.lit("https://www.dailymotion.com/search/"), quoted(keyword), F.lit("/videos"))
    return F.when(platform == "youtube", youtube).when(platform == "dailymotion", dailymotion)


def stamp(ts: Column) -> Column:
    """A time as a part of file names, in the session's zone."""
    return F.date_format(ts, "yyyy-MM-dd_HH-mm-ss")


def has_suffix(path: Column, *suffixes: str) -> Column:
    """Whether a path ends so, whatever the case; false for null."""
    low = F.lower(F.coalesce(path, F.lit("")))
    out = F.lit(False)
    for s in suffixes:
        out = out | low.endswith(s)
    return out


def plate_detections(lines: Column) -> Column:
    """JSON of a picture's text regions (array of text, points: arrays of numbers): transcription and corners to a tenth."""
    points = lambda ps: F.transform(ps, lambda p: F.transform(p, lambda v: F.bround(v, 1)))
    return F.to_json(F.transform(lines, lambda x: F.struct(x["text"].alias("transcription"), points(x["points"]).alias("points"))))


def plate_line(image: Column, lines: Column) -> Column:
    return F.concat_ws(" ", image, plate_detections(lines))


def read_lines(stem: Column, lines: Column) -> Column:
    """A line 'file text confidence' for each region (text, conf), its file being numbered within the picture."""
    return F.transform(lines, lambda x, i: F.format_string("%s_%02d.jpg %s %.4f", stem, i + 1, x["text"], x["conf"]))


def detection_csv(crop: Column, found: Column) -> Column:
    """A line of a table for each detection (class_name, x, y, w, h, conf)."""
    return F.transform(found, lambda d: F.format_string("%s,%s,%.6f,%.6f,%.6f,%.6f,%.4f", crop, d["class_name"], *[d[c] for c in ("x", "y", "w", "h", "conf")]))


def run_summary(counts: Column) -> Column:
    """One line about a run from its counters (a map); what it lacks is 0."""
    n = lambda k: F.coalesce(F.try_element_at(counts, F.lit(k)), F.lit(0))
    dup = sum((n(f"dup_l{i}") for i in range(1, 5)), n("dup_url"))
    parts = ", ".join(f"L{i}:%d" for i in range(5)).replace(", ", " ")
    ends = [sum((n(k) for k in keys[1:]), n(keys[0])) for _, keys in RUN_COUNTERS]
    form = f"seen=%d new_url=%d downloaded=%d dup=%d({parts}) " + " ".join(f"{name}=%d" for name, _ in RUN_COUNTERS)
    return F.format_string(form, n("seen"), n("new_urls"), n("downloaded"), dup, n("dup_url"), *[n(f"dup_l{i}") for i in range(1, 5)], *ends)


def preferred_first(items: Column, first: Column) -> Column:
    """The items with one of them at the front, in order otherwise."""
    return F.concat(F.filter(items, lambda x: x == first), F.filter(items, lambda x: ~x.eqNullSafe(first)))
