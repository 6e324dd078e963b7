"""Registry of queries with their SQL twins, and inputs derived from the tables by SQL that both engines read."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelsieve.plans.catalog import HOSTS, LABELS, REJECT_GROUP, STATUS

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The result of SQL whose tables are written as {name}."""
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in set(re.findall(r"\{(\w+)\}", sql))})


def duck(sql: str) -> str:
    """The same SQL for the other engine."""
    while (at := sql.find("sha2(")) >= 0:
        end = sql.index(", 256)", at)
        sql = f"{sql[:at]}sha256({sql[at + 5 : end]}){sql[end + 6 :]}"
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def query(name: str, oracle: str | None = None):
    def register(f: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"two queries {name}")
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return register


# a url for each page, of every platform and of none
URLS = """SELECT page_id, CASE page_id % 12
 WHEN 0 THEN 'https://www.facebook.com/watch?v=' || (page_id % 61 + 1000)
 WHEN 1 THEN 'https://www.youtube.com/watch?v=' || lpad(CAST(page_id % 97 AS STRING), 11, 'a')
 WHEN 2 THEN 'https://m.tiktok.com/@u/video/' || (page_id % 50)
 WHEN 3 THEN 'https://instagram.com/reel/Ab_' || (page_id % 40)
 WHEN 4 THEN 'https://x.com/u/status/' || (page_id % 50)
 WHEN 5 THEN 'https://old.reddit.com/r/s/comments/a' || page_id || '/title'
 WHEN 6 THEN 'https://de.vimeo.com/' || (page_id + 7)
 WHEN 7 THEN 'https://dai.ly/x' || page_id
 WHEN 8 THEN 'https://evil.com/?ref=facebook.com'
 WHEN 9 THEN 'https://vm.tiktok.com/ZM' || page_id
 WHEN 10 THEN 'https://user@m.facebook.com:443/reel/' || page_id || '?x=1'
 ELSE url END AS u FROM {pages}"""
# videos with a perceptual hash that is near within groups of four, and a duration
VIDEOS = """SELECT vec_id AS id, label, substr(sha2(CAST(vec_id - vec_id % 4 AS STRING), 256), 1, 15) || substr('0123456789abcdef', CAST(vec_id * 7 % 16 AS INT) + 1, 1) AS h,
 CAST(40 + (vec_id - vec_id % 4) % 60 + (vec_id % 4) * 6 AS DOUBLE) AS dur FROM {embeddings}"""
# five frames for each video: three shared within a group of four, two of their own
FRAMES = """SELECT vec_id AS id, CAST(40 + (vec_id - vec_id % 4) % 60 + (vec_id % 4) * 6 AS DOUBLE) AS dur, k AS pos,
 CASE WHEN (k + vec_id) % 5 < 3 THEN substr(sha2(CAST(vec_id - vec_id % 4 AS STRING) || '-' || CAST((k + vec_id) % 5 AS STRING), 256), 1, 15) || substr('0123456789abcdef', CAST(vec_id % 16 AS INT) + 1, 1)
 ELSE substr(sha2('own' || CAST(vec_id AS STRING) || '-' || CAST(k AS STRING), 256), 1, 16) END AS h
 FROM {embeddings} CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) ks"""
# a box for each order line, some of an order overlapping
BOXES = """SELECT l_orderkey AS image, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INT) AS no, CAST(l_partkey % 4 * 20 AS DOUBLE) AS x1, CAST(l_suppkey % 3 * 20 AS DOUBLE) AS y1,
 CAST(l_partkey % 4 * 20 + 50 + l_linenumber AS DOUBLE) AS x2, CAST(l_suppkey % 3 * 20 + 40 + l_linenumber AS DOUBLE) AS y2, CAST(l_partkey % 5 AS INT) AS cls FROM {lineitem}"""
# segments: an order's lines as intervals of seconds with a probability
SEGMENTS = """SELECT l_orderkey AS video, l_linenumber AS no, CAST(l_partkey % 40 AS DOUBLE) AS s, CAST(l_partkey % 40 + 1 + l_suppkey % 4 AS DOUBLE) AS e,
 CAST(l_suppkey % 100 AS DOUBLE) / 100 AS prob FROM {lineitem}"""
# parts named like labels in some ways, or not at all
LABEL_ROWS = "(VALUES " + ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(LABELS)) + ") AS t(ord, label, display)"
NAMES = f"""SELECT p_partkey, p_name, p_type, label AS own, display, CASE p_size % 4 WHEN 0 THEN upper(display) WHEN 1 THEN concat('The ', lower(label)) WHEN 2 THEN label ELSE p_name END AS name
 FROM {{part}} JOIN {LABEL_ROWS} ON ord = p_partkey % {len(LABELS)}"""
# an outcome and a platform for each event
OUTCOMES = "SELECT event_id, event_type, value, outcome, grp FROM {events} JOIN (VALUES " + ", ".join(f"({i}, '{o}', " + (f"'{REJECT_GROUP[o]}'" if o in REJECT_GROUP else "NULL") + ")" for i, o in enumerate(STATUS)) + f") AS t(no, outcome, grp) ON no = event_id % {len(STATUS)}"
PLATFORMS = "SELECT event_id, event_type, value, p FROM {events} JOIN (VALUES " + ", ".join(f"({i}, '{h}')" for i, h in enumerate(HOSTS)) + f") AS t(no, p) ON no = user_id % {len(HOSTS)}"
