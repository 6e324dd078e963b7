"""Queries of series: frames at given times, retries, logins, batches of links, stored pages, staged writes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsieve.operators import asof, machine
from reelsieve.operators.spread import shared_dir
from reelsieve.plans.base import derive, duck, query, table
from reelsieve.sources import paged, staged
from reelsieve.streaming import keyed

_US = "unix_micros(CAST(ts AS TIMESTAMP))"


def twin(sql: str) -> str:
    """The derivation for the other engine, whose clock function has another name."""
    return duck(sql).replace(_US, "epoch_us(ts)")


# a user's events as frames of a video: seconds, a hash that an error lacks, and the energy of its edges
_FRAMES = f"SELECT user_id AS id, event_id AS no, CAST({_US} - 1704067200000000 AS DOUBLE) / 1000000 AS sec, CASE WHEN event_type = 'error' THEN NULL ELSE substr(sha2(CAST(event_id AS STRING), 256), 1, 16) END AS h, value / 4 AS edge FROM {{events}}"
# the last event ends a video; some are cut short, some have hardly a frame
_VIDEOS = f"SELECT id, CASE WHEN id % 7 = 0 THEN 0.4 WHEN id % 7 = 1 THEN min(sec) * 4 ELSE max(sec) END AS duration FROM ({_FRAMES}) GROUP BY id"


@query("sampled_fingerprints", f"""WITH f AS ({twin(_FRAMES)}), v AS ({twin(_VIDEOS)}), t AS (SELECT id, k - 1 AS k, duration * [0.1, 0.3, 0.5, 0.7, 0.9][k]::DOUBLE AS t FROM v, range(1, 6) r(k) WHERE duration >= 0.5),
m AS (SELECT t.id, k, h, coalesce(edge >= 5, false) AS fine FROM t ASOF JOIN f ON t.id = f.id AND t.t >= f.sec WHERE h IS NOT NULL),
g AS (SELECT id, string_agg(h, ':' ORDER BY k) AS hs, string_agg(CAST(fine AS VARCHAR), ',' ORDER BY k) AS fs, count(*) AS n, max(h) FILTER (WHERE k = 2) AS thumbnail FROM m GROUP BY id)
SELECT v.id, thumbnail, CASE WHEN n >= 3 THEN hs END AS fingerprint, CASE WHEN n >= 3 THEN fs ELSE '' END AS informative FROM v LEFT JOIN g USING (id)""")
def sampled_fingerprints(spark, sf: str) -> DataFrame:
    got = asof.sampled_fingerprints(derive(spark, sf, _VIDEOS), derive(spark, sf, _FRAMES).withColumnRenamed("sec", "at"), bucket=86_400.0)
    return got.withColumn("informative", F.array_join(F.transform("informative", lambda b: b.cast("string")), ","))


# a user's events as a camera's tries, in a fortieth of the time
_TRIES = f"SELECT CAST(user_id AS STRING) AS camera, (1704067200000000 + ({_US} - 1704067200000000) DIV 40) DIV 1000 AS t, event_type = 'click' AS ok FROM {{events}}"


@query("capture_retries", f"""WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY camera ORDER BY t, ok) AS i FROM ({twin(_TRIES).replace(' DIV ', ' // ')})),
w(camera, i, t, since, pause, due, tries, said_due, outcome, gave, at_due, tries_due, tried) AS (
 SELECT camera, 0::BIGINT, 0::BIGINT, (-1)::BIGINT, 600000::BIGINT, (-1)::BIGINT, 0, false, '', NULL::BIGINT, NULL::BIGINT, 0, 0 FROM (SELECT DISTINCT camera FROM e)
 UNION ALL SELECT camera, i, t, CASE WHEN early THEN since WHEN ok THEN -1 ELSE s END, CASE WHEN early THEN pause WHEN ok THEN p ELSE least(2 * p, 43200000) END,
  CASE WHEN early THEN due WHEN ok THEN -1 ELSE t + p END, CASE WHEN early THEN tries WHEN ok THEN 0 ELSE n + 1 END, due >= 0 AND NOT early,
  CASE WHEN early THEN 'early' WHEN ok THEN 'captured' ELSE 'failed' END, CASE WHEN early THEN due - t WHEN NOT ok THEN p END, due, tries, CASE WHEN early THEN tries ELSE n + 1 END
 FROM (SELECT *, CASE WHEN anew THEN 600000 ELSE pause END AS p, CASE WHEN anew THEN t ELSE since END AS s, CASE WHEN anew THEN 0 ELSE tries END AS n
  FROM (SELECT w.camera, e.i, e.t, e.ok, w.since, w.pause, w.due, w.tries, w.due > e.t AS early, w.since < 0 OR e.t - w.since >= 43200000 AS anew FROM w JOIN e ON e.camera = w.camera AND e.i = w.i + 1)))
SELECT camera, t AS "at", outcome, gave AS pause, CAST(tried AS INT) AS tries FROM w WHERE i > 0
UNION ALL SELECT camera, at_due, 'due', NULL, CAST(tries_due AS INT) FROM w WHERE said_due""")
def capture_retries(spark, sf: str) -> DataFrame:
    tries = derive(spark, sf, _TRIES)
    return keyed.capture_retries(tries.select("camera", F.timestamp_millis("t").alias("at"), "ok"))


_CHECKS = "SELECT user_id AS platform, ts, event_id, CASE event_type WHEN 'view' THEN 'alive' WHEN 'click' THEN 'dead' WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'refreshed' ELSE 'peek' END AS outcome FROM {events}"


@query("login_states", f"""WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY ts, event_id) AS i FROM ({duck(_CHECKS)})),
w(platform, i, event_id, outcome, before, after) AS (SELECT platform, 0::BIGINT, NULL::BIGINT, '', '', 'fresh' FROM (SELECT DISTINCT platform FROM e)
 UNION ALL SELECT e.platform, e.i, e.event_id, e.outcome, w.after, CASE e.outcome WHEN 'alive' THEN 'alive' WHEN 'refreshed' THEN 'alive' WHEN 'dead' THEN 'login_needed' ELSE w.after END FROM w JOIN e ON e.platform = w.platform AND e.i = w.i + 1)
SELECT event_id, platform, before, after, CASE WHEN outcome IN ('alive', 'refreshed') THEN outcome WHEN outcome IN ('dead', 'peek') THEN 'login_needed' ELSE 'unknown' END AS result,
 CASE WHEN outcome = 'alive' AND before = 'login_needed' THEN 'back' WHEN outcome = 'dead' THEN 'ask' END AS notice FROM w WHERE i > 0""")
def login_states(spark, sf: str) -> DataFrame:
    return machine.login_states(derive(spark, sf, _CHECKS), order=["ts", "event_id"]).select("event_id", "platform", "before", "after", "result", "notice")


_LINKS = f"SELECT CAST(user_id AS STRING) AS source, {_US} DIV 1000 AS t, event_id AS no, concat('u', CAST(floor(value) AS STRING)) AS url, event_type IN ('view', 'click', 'purchase') AS known FROM {{events}}"


@query("fixed_batches", f"""WITH f AS (SELECT source, url, min({{'t': t, 'no': no, 'known': known}}) AS f FROM ({twin(_LINKS).replace(' DIV ', ' // ').replace('floor(value) AS', 'floor(value)::BIGINT AS')}) GROUP BY source, url),
o AS (SELECT source, url, f.known AS known, row_number() OVER (PARTITION BY source ORDER BY f.t, f.no, url) AS i FROM f),
r AS (SELECT *, sum(CASE WHEN known THEN 0 ELSE 1 END) OVER (PARTITION BY source ORDER BY i) AS run FROM o),
s AS (SELECT *, sum(CASE WHEN known THEN 1 ELSE 0 END) OVER (PARTITION BY source, run ORDER BY i) >= 5 AS stops FROM r),
k AS (SELECT s.*, x.stop FROM s LEFT JOIN (SELECT source, min(i) AS stop FROM s WHERE stops GROUP BY source) x USING (source) WHERE x.stop IS NULL OR i <= x.stop),
n AS (SELECT source, url, row_number() OVER (PARTITION BY source ORDER BY i) - 1 AS pos FROM k WHERE NOT known)
SELECT source, pos // 10 AS batch, pos, url, false AS last FROM n
UNION ALL SELECT source, NULL, count(*) FILTER (WHERE NOT known), NULL, true FROM k WHERE stop IS NOT NULL GROUP BY source""")
def fixed_batches(spark, sf: str) -> DataFrame:
    links = derive(spark, sf, _LINKS)
    return keyed.fixed_batches(links.select("source", F.timestamp_millis("t").alias("at"), "no", "url", "known"), size=10)


@query("page_scan", "SELECT page_id // 40 AS page, page_id, url FROM pages")
def page_scan(spark, sf: str) -> DataFrame:
    """The stored pages as a stream of listing pages, into a table."""
    base = f"{shared_dir(spark)}/page-scan-{uuid.uuid4().hex}"
    pages = paged.paged_listing(spark, stream=True, path=f"{sf}/pages.parquet", key="page_id", same="url", columns="page_id long, url string", size="40", tail="true")
    pages.writeStream.format("parquet").option("path", f"{base}/table").option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(pages.schema).parquet(f"{base}/table")


@query("listing_scan", "SELECT event_id // 100 AS page, event_id, event_type, value FROM events WHERE event_id < 850 AND value <= 50")
def listing_scan(spark, sf: str) -> DataFrame:
    """The first entries of a stored listing, a page a task, the short ones only."""
    listed = paged.paged_listing(spark, path=f"{sf}/events.parquet", key="event_id", same="event_id", columns="event_id long, event_type string, value double", limit="850", tail="true")
    return listed.filter("value <= 50")


@query("staged_write", "SELECT page_id, url, length(html) AS chars FROM pages")
def staged_write(spark, sf: str) -> DataFrame:
    """Two writes, even and odd pages, published one after the other."""
    path = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
    rows = table(spark, sf, "pages").select("page_id", "url", F.length("html").cast("long").alias("chars"))
    for rest in (0, 1):
        staged.publish(rows.filter(F.col("page_id") % 2 == rest), path)
    return staged.published(spark, path, "page_id long, url string, chars long")
