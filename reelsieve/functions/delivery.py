"""Keys and order of media segments, as columns of a segment's url and first bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelsieve.plans.catalog import VIDEO_ID_FORMS


def _parts(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^#]*)", 1)
    return F.split_part(rest, F.lit("?"), F.lit(1)), F.concat(F.lit("&"), F.regexp_extract(rest, r"\?(.*)$", 1))


def _param(query: Column, name: str) -> Column:
    """The first value that isn't empty; null without one."""
    return F.nullif(F.regexp_extract(query, f"[&]{name}=([^&]+)", 1), F.lit(""))


def stream_key(url: Column) -> Column:
    """Host and path: segments of one stream share it."""
    return _parts(url)[0]


def range_key(url: Column) -> Column:
    """Host, path and byte range, whatever the signed tokens in the query are."""
    place, query = _parts(url)
    return F.concat(place, F.lit(":"), F.coalesce(_param(query, "bytestart"), F.lit("0")), F.lit("-"), F.coalesce(_param(query, "byteend"), F.lit("")))


def byte_start(url: Column) -> Column:
    """The range's start; 0 without one, or where it is no number."""
    start = F.trim(_param(_parts(url)[1], "bytestart"))
    return F.coalesce(F.when(F.rlike(start, F.lit(r"^[+-]?\d+$")), start.try_cast("long")), F.lit(0))


def _latin(data: Column) -> Column:
    return F.decode(data, "ISO-8859-1")


def is_init(data: Column) -> Column:
    """Whether a segment holds the stream's header."""
    return F.coalesce((F.length(data) >= 8) & (F.substring(_latin(data), 5, 4) == "ftyp") | F.contains(F.substring(_latin(data), 1, 4096), F.lit("moov")), F.lit(False))


def handler(data: Column) -> Column:
    """'vide' or 'soun' by the first handler box that says so, else null."""
    return F.nullif(F.regexp_extract(_latin(data), "(?s)hdlr.{8}(vide|soun)", 1), F.lit(""))


def segment_order(url: Column, data: Column) -> Column:
    """Headers first, then by byte."""
    return F.struct(F.when(is_init(data), 0).otherwise(1).alias("late"), byte_start(url).alias("start"))


def video_id(url: Column) -> Column:
    """The id of a video's page by the first form that fits, else 'video'."""
    return F.coalesce(*[F.nullif(F.regexp_extract(url, f, 1), F.lit("")) for f in VIDEO_ID_FORMS], F.lit("video"))
