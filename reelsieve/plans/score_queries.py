"""Queries of scores, domains, samples, slanted crops and enriched listings."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsieve.functions import geometry
from reelsieve.operators import domains, sampling, scoring
from reelsieve.plans.base import BOXES, derive, duck, query, table
from reelsieve.sources import enrich

_UNIT = "SELECT vec_id, label, [x::DOUBLE / sqrt(list_sum([y::DOUBLE * y::DOUBLE FOR y IN embedding])) FOR x IN embedding] AS u FROM embeddings"


@query("zero_shot", f"""WITH u AS ({_UNIT}), f AS (SELECT vec_id, label, unnest(u) AS x, generate_subscripts(u, 1) AS pos FROM u), c AS (SELECT label, pos, avg(x) AS m FROM f GROUP BY label, pos),
z AS (SELECT label, sqrt(sum(m * m)) AS s FROM c GROUP BY label), l AS (SELECT vec_id, c.label AS cls, 20 * sum(x * m / s) AS logit FROM f JOIN c USING (pos) JOIN z ON z.label = c.label GROUP BY vec_id, c.label),
p AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY vec_id)) AS e FROM l), q AS (SELECT vec_id, cls, e / sum(e) OVER (PARTITION BY vec_id) AS prob, row_number() OVER (PARTITION BY vec_id ORDER BY logit DESC, CAST(cls AS VARCHAR)) AS rank FROM p)
SELECT vec_id, CAST(cls AS VARCHAR) AS cls, CAST(rank AS INT) AS rank, CAST(floor(prob * 10000 + 0.5) AS BIGINT) AS prob FROM q WHERE rank <= 2""")
def zero_shot(spark, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    scored = scoring.zero_shot(e, "embedding", scoring.prototypes(e, "label", "embedding"), scale=20.0, top=2)
    rows = scored.select("vec_id", F.posexplode("scores").alias("rank", "s"))
    return rows.select("vec_id", "s.cls", (F.col("rank") + 1).alias("rank"), F.floor(F.col("s.prob") * 10000 + 0.5).cast("long").alias("prob"))


_HOSTS = "SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host FROM {pages}"
# every seventh page's host is a rule, and so is all it stands under
_RULES = f"SELECT DISTINCT CASE page_id % 3 WHEN 0 THEN upper(host) WHEN 1 THEN concat('.', substr(host, instr(host, '.') + 1)) ELSE host END AS domain, CASE WHEN length(host) % 2 = 0 THEN 'allow' ELSE 'block' END AS verdict FROM ({_HOSTS}) WHERE page_id % 7 = 0"


@query("domain_rules", f"""WITH h AS ({duck(_HOSTS)}), r AS (SELECT d, min({{'domain': domain, 'verdict': verdict}}) AS rule FROM (SELECT *, ltrim(lower(domain), '.') AS d FROM ({duck(_RULES)})) WHERE d <> '' GROUP BY d),
m AS (SELECT page_id, arg_max(rule, length(d)) AS rule FROM h JOIN r ON lower(host) = d OR ends_with(lower(host), '.' || d) GROUP BY page_id)
SELECT page_id, host, rule.domain AS domain, rule.verdict AS verdict FROM h LEFT JOIN m USING (page_id)""")
def domain_rules(spark, sf: str) -> DataFrame:
    return domains.match_domains(derive(spark, sf, _HOSTS), "host", derive(spark, sf, _RULES), "domain").select("page_id", "host", "rule.domain", "rule.verdict")


_DRAW = "(('0x' || substr(sha256('7:' || CAST(event_id AS VARCHAR)), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496"


@query("weighted_sample", f"SELECT user_id, event_id, CAST(n AS INT) AS n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY -ln({_DRAW}) / value, event_id) AS n FROM events WHERE value > 0) WHERE n <= 5".replace("SELECT user_id, event_id, CAST(n AS INT) AS n", "SELECT user_id, event_id"))
def weighted_sample(spark, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_id", "user_id", "value")
    return sampling.sample(rows, ["user_id"], "event_id", 5, seed=7, weight="value").select("user_id", "event_id")


# a box's corners, moved by some of its numbers
_CORNERS = f"SELECT image, no, x1 + no % 3 AS ax, y1 + cls AS ay, x2 + cls AS bx, y1 - no AS b_y, x2 - no % 2 AS cx, y2 + (cls + 1) * 9 AS cy, x1 - cls AS dx, y2 + cls * 9 AS dy FROM ({BOXES})"
_SIZE = "CAST(floor(greatest(sqrt((ax - bx) ** 2 + (ay - b_y) ** 2), sqrt((cx - dx) ** 2 + (cy - dy) ** 2))) AS INT) AS width, CAST(floor(greatest(sqrt((ax - dx) ** 2 + (ay - dy) ** 2), sqrt((bx - cx) ** 2 + (b_y - cy) ** 2))) AS INT) AS height"


@query("slanted_crops", f"SELECT image, no, width, height, height / width >= 1.5 AS turned, [0, 0, width, 0, width, height, 0, height]::BIGINT[] AS corners FROM (SELECT *, {_SIZE} FROM ({duck(_CORNERS)}))")
def slanted_crops(spark, sf: str) -> DataFrame:
    """The corners come back through the solved map: the crop's own corners."""
    crops = geometry.corners_in_crop(derive(spark, sf, _CORNERS), ["image", "no"], [("ax", "ay"), ("bx", "b_y"), ("cx", "cy"), ("dx", "dy")])
    return crops.select("image", "no", "width", "height", geometry.is_upright_text(F.struct("width", "height")).alias("turned"), "corners")


def _page_facts(urls: list[str]) -> dict[str, dict]:
    """A stand-in for a service: what the urls say. It has a bad day for requests that begin with a blog's page."""
    if "://blog." in urls[0]:
        raise ConnectionError("try again later")
    found = {u: re.search(r"://[^/]*/(\w+)/(\d+)", u) for u in urls}
    return {u: {"section": m[1], "number": int(m[2])} for u, m in found.items() if m}


@query("enriched_pages", r"""WITH p AS (SELECT page_id, url, (row_number() OVER (ORDER BY page_id) - 1) // 20 AS chunk FROM pages), f AS (SELECT chunk, arg_min(url, page_id) AS first FROM p GROUP BY chunk),
m AS (SELECT p.*, first NOT LIKE '%://blog.%' AS checked, regexp_extract(url, '://[^/]*/(\w+)/(\d+)', 1) AS s, regexp_extract(url, '://[^/]*/(\w+)/(\d+)', 2) AS n FROM p JOIN f USING (chunk))
SELECT page_id, url, CASE WHEN checked AND s <> '' THEN s END AS section, CASE WHEN checked AND s <> '' THEN n::BIGINT END AS number, checked FROM m""")
def enriched_pages(spark, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    return enrich.in_chunks(pages, "url", _page_facts, "section string, number long", ["page_id"], size=20)


@query("first_kept_pages", r"""WITH p AS (SELECT page_id, url, (row_number() OVER (ORDER BY page_id) - 1) // 20 AS chunk, row_number() OVER (ORDER BY page_id) AS no FROM pages), f AS (SELECT chunk, arg_min(url, page_id) AS first FROM p WHERE no <= 180 GROUP BY chunk),
m AS (SELECT p.*, first NOT LIKE '%://blog.%' AS checked, regexp_extract(url, '://[^/]*/(\w+)/(\d+)', 1) AS s, regexp_extract(url, '://[^/]*/(\w+)/(\d+)', 2) AS n FROM p JOIN f USING (chunk) WHERE no <= 180)
SELECT page_id, url, checked FROM m WHERE NOT checked OR (s <> '' AND n::BIGINT % 2 = 0) ORDER BY page_id LIMIT 60""")
def first_kept_pages(spark, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    return enrich.first_kept(pages, "url", _page_facts, "section string, number long", "number % 2 = 0", ["page_id"], limit=60, size=20).select("page_id", "url", "checked")
