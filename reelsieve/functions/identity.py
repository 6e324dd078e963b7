"""Url identity as column expressions: platform, canonical id, short links, normal forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsieve.plans.catalog import HOSTS, URL_RULES


def netloc(url: Column) -> Column:
    """Host, lower-cased, without user and port. By regex: url parsers reject hosts that occur (underscores)."""
    raw = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    return F.split_part(F.element_at(F.split(raw, "@"), -1), F.lit(":"), F.lit(1))


_PLATFORM_OF = {h: p for p, hs in HOSTS.items() for h in hs}
_LONGEST = max(h.count(".") for h in _PLATFORM_OF) + 1
# SQL text: hundreds of expression nodes are parsed at once. transform(array(x), v -> ...) names a value that is used many times,
# so that filters pushed through these columns stay as small as they are. Only the rules of a url's platform run.
_RULE = "element_at(transform(array(_platform), p -> CASE p " + " ".join(
    f"WHEN '{p}' THEN CASE " + " ".join(f"WHEN _u RLIKE r'{r}' THEN {i}" for i, (q, r, _, _) in enumerate(URL_RULES) if q == p) + " END" for p in dict.fromkeys(r[0] for r in URL_RULES)) + " END), 1)"
_ID = "regexp_extract(_u, get(array(" + ", ".join(f"r'{r}'" for _, r, _, _ in URL_RULES) + "), _rule), 1)"


def _platform(host: Column) -> Column:
    """Looked up by the host's last labels, most first."""
    names = F.create_map(*[F.lit(x) for hp in _PLATFORM_OF.items() for x in hp])
    return F.coalesce(*[F.try_element_at(names, F.substring_index(host, ".", -n)) for n in range(_LONGEST, 1, -1)])


def _by_rule(values: list) -> Column:
    return F.expr(f"get(array({', '.join(repr(v) if isinstance(v, str) else str(v).lower() for v in values)}), _rule)")


def with_platform(df: DataFrame, url: str, out: str = "platform") -> DataFrame:
    """df with the platform of the url's host, or of a host that it is a subdomain of; never by a substring of the url."""
    return df.withColumn("_host", netloc(F.col(url))).withColumn(out, _platform(F.col("_host"))).drop("_host")


def with_identity(df: DataFrame, url: str) -> DataFrame:
    """df with platform, object_type, object_id and is_short by the first rule of the platform that fits; without one
    null, null, null and false."""
    parts = df.withColumns({"_host": netloc(F.col(url)), "_u": F.coalesce(F.col(url), F.lit(""))})
    ruled = parts.withColumn("_platform", _platform(F.col("_host"))).withColumn("_rule", F.expr(_RULE))
    return ruled.withColumns({
        "platform": _by_rule([r[0] for r in URL_RULES]), "object_type": _by_rule([r[2] for r in URL_RULES]),
        "object_id": F.expr(_ID),
        "is_short": F.coalesce(_by_rule([r[3] for r in URL_RULES]), F.lit(False)),
    }).drop("_host", "_u", "_rule", "_platform")


def is_absolute(url: Column) -> Column:
    return F.coalesce(url.startswith("http://") | url.startswith("https://"), F.lit(False))


def strip_query(url: Column) -> Column:
    return F.split_part(url, F.lit("?"), F.lit(1))


def origin(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)


def encode_query(text: Column) -> Column:
    return F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))


def with_guess(df: DataFrame, url: str, path: str) -> DataFrame:
    """As with_identity; where no rule fits, a file stem of 8 digits or more is a facebook video."""
    stem = F.regexp_extract(F.coalesce(F.col(path), F.lit("")), r"([^/]*?)(?:\.[^./]*)?$", 1)
    named = with_identity(df, url).withColumn("_stem", F.when(F.col("object_id").isNull() & F.rlike(stem, F.lit(r"^\d{8,}$")), stem))
    guess = F.col("_stem").isNotNull()
    return named.withColumns({
        "platform": F.when(guess, "facebook").otherwise(F.col("platform")), "object_type": F.when(guess, "video").otherwise(F.col("object_type")),
        "object_id": F.coalesce("object_id", "_stem"),
    }).drop("_stem")


def entry_url(url: Column, webpage_url: Column, video_id: Column, template: str) -> Column:
    """The first of the two fields that is a url, else the id put into the platform's template (with one %s)."""
    http = lambda c: F.when(c.startswith("http"), c)
    return F.coalesce(http(webpage_url), http(url), F.format_string(template, video_id))
