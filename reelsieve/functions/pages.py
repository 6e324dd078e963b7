"""Predicates and forms of listed pages, their links and entries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelsieve.plans.catalog import COLOUR_ELSE, GROUP_LINK, LABEL_COLOURS, NO_RESULT_MARKERS, REMOVED_MARKERS, VIDEO_LINKS


def has_video(is_video: Column, hint: Column, domain: Column) -> Column:
    """Whether a listed post holds a video: it says so, its hint does, or its host is the one for videos."""
    return F.coalesce(is_video, F.lit(False)) | F.coalesce(hint.isin("hosted:video", "rich:video"), F.lit(False)) | F.coalesce(domain == "v.redd.it", F.lit(False))


def valid_image(width: Column, height: Column, mean: Column) -> Column:
    """Large enough for a model and not black; unknown is not."""
    return F.coalesce((width >= 28) & (height >= 28) & (mean >= 8), F.lit(False))


def _says(body: Column, markers: tuple[str, ...]) -> Column:
    low = F.lower(F.coalesce(body, F.lit("")))
    return F.exists(F.array(*map(F.lit, markers)), lambda m: F.contains(low, m))


def found_nothing(body: Column) -> Column:
    """Whether a search page says so; its suggestions are no results then."""
    return _says(body, NO_RESULT_MARKERS)


def is_removed(body: Column) -> Column:
    return _says(body, REMOVED_MARKERS)


def is_group_link(href: Column) -> Column:
    return F.coalesce(F.rlike(href, F.lit(GROUP_LINK)), F.lit(False))


def video_link(href: Column, base: str) -> Column:
    """The link, made absolute, if it leads to a video; else null."""
    whole = F.when(href.startswith("/"), F.concat(F.lit(base), href)).otherwise(href)
    return F.when(F.rlike(whole, F.lit("|".join(f"(?:{v})" for v in VIDEO_LINKS))), whole)


def watch_url(url: Column) -> Column:
    """The watch page of a video's url, with the group it was posted in; another url as it is."""
    path, query = F.split_part(url, F.lit("?"), F.lit(1)), F.concat(F.lit("&"), F.regexp_extract(url, r"[?]([^#]*)", 1))
    param = lambda n: F.nullif(F.regexp_extract(query, f"[&]{n}=([^&]+)", 1), F.lit(""))
    video = F.coalesce(F.nullif(F.regexp_extract(path, r"/videos/(\d+)", 1), F.lit("")), param("v"))
    group = param("idorvanity")
    watch = F.concat(F.lit("https://www.facebook.com/watch/?v="), video)
    return F.when(video.isNull(), url).when(group.isNotNull(), F.concat(watch, F.lit("&idorvanity="), group)).otherwise(watch)


def job_name(platform: Column) -> Column:
    return F.when(platform == "facebook", "social_crawler_fb").otherwise(F.concat(F.lit("social_crawler_"), platform))


def label_colour(label: Column) -> Column:
    colours = F.create_map(*[F.lit(x) for kv in LABEL_COLOURS.items() for x in kv])
    return F.coalesce(F.try_element_at(colours, label), F.lit(COLOUR_ELSE))


def offered_labels(model_labels: Column) -> Column:
    """Labels that an annotation offers: the model's and Normal, in order."""
    return F.array_sort(F.array_union(F.coalesce(model_labels, F.array().cast("array<string>")), F.array(F.lit("Normal"))))


def session_ok(state: Column) -> Column:
    return F.coalesce(state.isin("alive", "refreshed"), F.lit(False))


def session_blocks(platform: Column, state: Column, required: tuple[str, ...] = ("x", "facebook")) -> Column:
    """Whether a platform finds nothing without the session that it has lost."""
    return F.coalesce(platform.isin(*required) & (state == "login_needed"), F.lit(False))
