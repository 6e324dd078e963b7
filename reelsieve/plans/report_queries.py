"""Queries of scheduling, reporting, state and time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsieve.functions import media as M
from reelsieve.functions import text as X
from reelsieve.operators import scheduling, segments, tables
from reelsieve.plans.base import derive, duck, query, table
from reelsieve.sources import readers
from reelsieve.streaming import streams

_COUNTS = "SELECT p_type AS label, count(*) AS n FROM {part} WHERE p_size > 25 GROUP BY p_type"
_STATE = "SELECT p_type AS label, CAST(max(p_size) % 7 * 100 AS DOUBLE) AS backoff_until, CAST(max(p_partkey) % 11 AS DOUBLE) AS last_visit FROM {part} WHERE p_size % 2 = 0 GROUP BY p_type"


@query("label_deficit_order", f"WITH l AS (SELECT DISTINCT p_type AS label FROM part), j AS (SELECT l.label, coalesce(n, 0) AS n, CASE WHEN coalesce(backoff_until, 0) > 300 OR coalesce(n, 0) >= 200 THEN 1 ELSE 0 END AS deferred, coalesce(last_visit, 0) AS lv FROM l LEFT JOIN ({duck(_COUNTS)}) c USING (label) LEFT JOIN ({duck(_STATE)}) s USING (label)) SELECT label, n, deferred, CAST(row_number() OVER (ORDER BY deferred, n, lv, label) AS INT) AS position FROM j")
def label_deficit_order(spark, sf: str) -> DataFrame:
    labels = table(spark, sf, "part").select(F.col("p_type").alias("label")).distinct()
    return scheduling.label_order(labels, derive(spark, sf, _COUNTS), derive(spark, sf, _STATE), 300.0, 200)


_VISITS = "SELECT user_id % 7 AS platform, event_type AS label, event_id, CAST(event_id AS DOUBLE) AS at_s, value > 95 AS got FROM {events}"


@query("label_backoff", f"""WITH v AS ({duck(_VISITS)}), h AS (SELECT platform, label, max(at_s) FILTER (WHERE got) AS hit FROM v GROUP BY platform, label)
SELECT platform, label, count(*) AS visits, max(at_s) AS last_visit, max(hit) AS last_video_at, CAST(count(*) FILTER (WHERE hit IS NULL OR at_s > hit) AS INT) AS empty_streak,
 CASE WHEN count(*) FILTER (WHERE hit IS NULL OR at_s > hit) >= 3 THEN max(at_s) + least(6 * pow(2, count(*) FILTER (WHERE hit IS NULL OR at_s > hit) - 3), 48) * 3600 ELSE 0 END AS backoff_until FROM v JOIN h USING (platform, label) GROUP BY platform, label""")
def label_backoff(spark, sf: str) -> DataFrame:
    return scheduling.visit_state(derive(spark, sf, _VISITS).withColumnRenamed("at_s", "at"), ["platform", "label"], ["at", "event_id"])


@query("quota_topk", "SELECT p_partkey, p_type FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS n, least(25, 10 + length(p_type) % 5) AS room FROM part) WHERE n <= room")
def quota_topk(spark, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").withColumn("room", F.least(F.lit(25), 10 + F.length("p_type") % 5))
    return scheduling.within_quota(parts, "p_type", "p_partkey", "room").select("p_partkey", "p_type")


@query("round_robin_next", "SELECT n_nationkey, coalesce(lead(n_nationkey) OVER w, first_value(n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey)) AS next FROM nation WINDOW w AS (PARTITION BY n_regionkey ORDER BY n_nationkey)")
def round_robin_next(spark, sf: str) -> DataFrame:
    return scheduling.next_in_turn(table(spark, sf, "nation"), "n_regionkey", "n_nationkey").select("n_nationkey", "next")


@query("status_by_platform", "SELECT coalesce(r_name, 'unknown') AS platform, o_orderstatus AS status, count(*) AS n, count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1996-01-01') AS n_window FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey <> 2 GROUP BY 1, 2")
def status_by_platform(spark, sf: str) -> DataFrame:
    o, c, n, r = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    places = n.join(r.filter("r_regionkey <> 2"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_nationkey", "r_name")
    j = o.select("o_custkey", "o_orderstatus", "o_orderdate").join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    late = F.count(F.when(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"), 1))
    return j.groupBy(F.coalesce("r_name", F.lit("unknown")).alias("platform"), F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), late.alias("n_window"))


@query("label_search_agg", "SELECT p_type AS label, count(*) AS sources, count(DISTINCT p_brand) AS platforms, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS names, max(p_partkey) AS last FROM part GROUP BY p_type")
def label_search_agg(spark, sf: str) -> DataFrame:
    return table(spark, sf, "part").groupBy(F.col("p_type").alias("label")).agg(F.count(F.lit(1)).alias("sources"), F.countDistinct("p_brand").alias("platforms"), F.array_join(F.array_sort(F.collect_set("p_brand")), ",").alias("names"), F.max("p_partkey").alias("last"))


@query("label_dim_left_join", f"WITH l AS (SELECT DISTINCT p_type AS label FROM part) SELECT l.label, coalesce(w.n, 0) AS in_window, coalesce(t.n, 0) AS total FROM l LEFT JOIN (SELECT p_type AS label, count(*) AS n FROM part WHERE p_size > 48 AND p_partkey % 9 = 0 GROUP BY 1) w USING (label) LEFT JOIN ({duck(_COUNTS)}) t USING (label)")
def label_dim_left_join(spark, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    recent = part.filter("p_size > 48 AND p_partkey % 9 = 0").groupBy(F.col("p_type").alias("label")).agg(F.count(F.lit(1)).alias("in_window"))
    total = derive(spark, sf, _COUNTS).withColumnRenamed("n", "total")
    return part.select(F.col("p_type").alias("label")).distinct().join(recent, "label", "left").join(total, "label", "left").na.fill(0, ["in_window", "total"]).select("label", "in_window", "total")


@query("slot_share", "SELECT o_orderpriority AS dag, count(*) AS runs, CAST(floor(10000.0 * count(*) / sum(count(*)) OVER ()) AS BIGINT) AS share FROM orders GROUP BY 1")
def slot_share(spark, sf: str) -> DataFrame:
    runs = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("dag")).agg(F.count(F.lit(1)).alias("runs"))
    # a handful of rows, already aggregated
    return runs.select("dag", "runs", F.floor(10000.0 * F.col("runs") / F.sum("runs").over(Window.partitionBy())).cast("long").alias("share"))


@query("run_durations", "SELECT o_orderpriority AS dag, count(*) AS runs, sum(o_custkey % 600)::BIGINT AS busy, max(o_custkey % 600) AS longest, greatest(0, 1000000 - sum(o_custkey % 600))::BIGINT AS idle, count(*) FILTER (WHERE o_orderstatus = 'F') AS failed FROM orders GROUP BY 1")
def run_durations(spark, sf: str) -> DataFrame:
    d = table(spark, sf, "orders").withColumn("d", F.col("o_custkey") % 600)
    return d.groupBy(F.col("o_orderpriority").alias("dag")).agg(F.count(F.lit(1)).alias("runs"), F.sum("d").alias("busy"), F.max("d").alias("longest"), F.greatest(F.lit(0), 1000000 - F.sum("d")).alias("idle"), F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("failed"))


@query("funnel_sums", "SELECT event_type AS platform, count(*) AS runs, CAST(sum(coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), 0)) AS BIGINT) AS seen, count(*) FILTER (WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) > 50) AS budget_hit FROM events GROUP BY ROLLUP (event_type)")
def funnel_sums(spark, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return e.rollup(F.col("event_type").alias("platform")).agg(F.count(F.lit(1)).alias("runs"), F.sum(F.coalesce("k", F.lit(0))).alias("seen"), F.count(F.when(F.col("k") > 50, 1)).alias("budget_hit"))


@query("json_flag_filter", """SELECT event_id FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'false' ELSE 'true' END AS f FROM events WHERE event_id % 2 = 0) WHERE f = 'false'""")
def json_flag_filter(spark, sf: str) -> DataFrame:
    details = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.struct((F.col("event_id") % 3 != 0).alias("cctv")).alias("filters_enabled")))).alias("detail"))
    return details.filter(F.try_variant_get(F.try_parse_json("detail"), "$.filters_enabled.cctv", "boolean") == F.lit(False)).select("event_id")


@query("expires_normalize", "SELECT event_id, CAST(CASE WHEN v > 0 AND s > 0 AND s <= 1e11 THEN floor(s) ELSE -1 END AS BIGINT) AS expires FROM (SELECT event_id, v, CASE WHEN v > 1e14 THEN v / 1000000 - 11644473600 WHEN v > 1e11 THEN v / 1000 ELSE v END AS s FROM (SELECT event_id, CAST(CASE event_id % 5 WHEN 0 THEN 13300000000000000 + event_id * 1000003 WHEN 1 THEN 1700000000000 + event_id WHEN 2 THEN 1700000000 + event_id WHEN 3 THEN 0 ELSE -5 END AS DOUBLE) AS v FROM events))")
def expires_normalize(spark, sf: str) -> DataFrame:
    raw = derive(spark, sf, "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 13300000000000000 + event_id * 1000003 WHEN 1 THEN 1700000000000 + event_id WHEN 2 THEN 1700000000 + event_id WHEN 3 THEN 0 ELSE -5 END AS v FROM {events}")
    return raw.select("event_id", M.normalize_expires(F.col("v")).alias("expires"))


@query("last_row_per_url", "SELECT user_id % 50 AS k, max(event_id) AS event_id FROM events GROUP BY 1")
def last_row_per_url(spark, sf: str) -> DataFrame:
    return tables.last_per_key(table(spark, sf, "events").select((F.col("user_id") % 50).alias("k"), "event_id"), "k", "event_id")


@query("missing_images_semi", "SELECT count(*) AS n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 3)")
def missing_images_semi(spark, sf: str) -> DataFrame:
    have = table(spark, sf, "lineitem").filter("l_linenumber = 3").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf, "orders").join(have, "o_orderkey", "left_semi").agg(F.count("o_orderkey").alias("n"))


@query("set_union_known", "SELECT count(*) AS known, count(*) FILTER (WHERE k % 2 = 0) AS even FROM (SELECT c_custkey AS k FROM customer UNION SELECT o_custkey FROM orders)")
def set_union_known(spark, sf: str) -> DataFrame:
    both = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")).union(table(spark, sf, "orders").select("o_custkey")).distinct()
    return both.agg(F.count("k").alias("known"), F.count(F.when(F.col("k") % 2 == 0, 1)).alias("even"))


@query("set_intersect_except", "SELECT 'both' AS side, count(*) AS n FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders) UNION ALL SELECT 'without', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)")
def set_intersect_except(spark, sf: str) -> DataFrame:
    c, o = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    count = lambda df, side: df.agg(F.count("k").alias("n")).select(F.lit(side).alias("side"), "n")
    return count(c.intersect(o), "both").union(count(c.join(o, "k", "left_anti").distinct(), "without"))


@query("ordered_distinct", "SELECT l_partkey, min(l_orderkey * 10 + l_linenumber) AS pos FROM lineitem GROUP BY 1")
def ordered_distinct(spark, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.min(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"))


@query("stale_sources", "SELECT c_custkey, last FROM customer LEFT JOIN (SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last FROM orders GROUP BY 1) ON o_custkey = c_custkey WHERE last IS NULL OR last < DATE '1998-01-01'")
def stale_sources(spark, sf: str) -> DataFrame:
    last = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").cast("date").alias("last"))
    j = table(spark, sf, "customer").select("c_custkey").join(last, "c_custkey", "left")
    return j.filter(F.col("last").isNull() | (F.col("last") < F.lit("1998-01-01").cast("date")))


@query("age_buckets", "SELECT CASE WHEN a < 3600 THEN (a // 60) || ' min' WHEN a < 86400 THEN (a // 3600) || ' h' ELSE (a // 86400) || ' d' END AS age, count(*) AS n FROM (SELECT epoch(TIMESTAMP '2024-02-01')::BIGINT - epoch(ts)::BIGINT AS a FROM (SELECT date_trunc('second', ts) AS ts FROM events)) GROUP BY 1")
def age_buckets(spark, sf: str) -> DataFrame:
    a = F.unix_timestamp(F.lit("2024-02-01 00:00:00")) - F.unix_timestamp(F.date_trunc("second", F.col("ts").cast("timestamp")))
    return table(spark, sf, "events").select(X.format_age(a).alias("age")).groupBy("age").agg(F.count(F.lit(1)).alias("n"))


@query("parse_stamps", "SELECT event_id, epoch(CASE event_id % 2 WHEN 0 THEN ts ELSE date_trunc('minute', ts) END)::BIGINT AS s FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)")
def parse_stamps(spark, sf: str) -> DataFrame:
    t = F.col("ts").cast("timestamp")
    text = F.when(F.col("event_id") % 2 == 0, F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00"))).otherwise(F.date_format(t, "yyyy-MM-dd HH:mm"))
    return table(spark, sf, "events").select("event_id", F.unix_timestamp(M.parse_stamp(text)).alias("s"))


@query("parse_rates", "SELECT p_partkey, CASE WHEN r > 0 AND r <= 120 THEN CAST(floor(r * 1000 + 0.5) AS BIGINT) ELSE 25000 END AS milli_fps FROM (SELECT p_partkey, CASE WHEN p_partkey % 7 > 0 THEN (p_size * 1000.0)::DOUBLE / (p_partkey % 7 * 100) END AS r FROM part)")
def parse_rates(spark, sf: str) -> DataFrame:
    rate = F.concat((F.col("p_size") * 1000).cast("string"), F.lit("/"), (F.col("p_partkey") % 7 * 100).cast("string"))
    return table(spark, sf, "part").select("p_partkey", F.floor(M.frame_rate(rate, F.lit("0/0")) * 1000 + 0.5).cast("long").alias("milli_fps"))


@query("log_signals", "SELECT * FROM (SELECT 'rate_limited' AS signal, CAST(sum(len(regexp_extract_all(text, 'the'))) AS BIGINT) AS n FROM conversations UNION ALL SELECT 'budget_spent', CAST(sum(len(regexp_extract_all(text, '[0-9]+'))) AS BIGINT) FROM conversations) WHERE n > 0")
def log_signals(spark, sf: str) -> DataFrame:
    return readers.signal_counts(table(spark, sf, "conversations"), "text", {"rate_limited": "the", "budget_spent": "[0-9]+"}).withColumn("n", F.col("n").cast("long"))


_W = "SELECT {0} AS start, event_type, count(*) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS total FROM {1} GROUP BY 1, 2"


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


def _events(spark, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumns({"ts": F.col("ts").cast("timestamp"), "value": F.floor("value").cast("long")})


@query("tumbling_events", _W.format("strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S')", "events"))
def tumbling_events(spark, sf: str) -> DataFrame:
    return _stamped(streams.tumbling(_events(spark, sf), "ts", "1 day", ["event_type"]))


@query("sliding_events", _W.format("strftime(time_bucket(INTERVAL 6 HOUR, ts) - s * INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S')", "events CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS s)"))
def sliding_events(spark, sf: str) -> DataFrame:
    return _stamped(streams.tumbling(_events(spark, sf), "ts", "1 day", ["event_type"], "6 hours"))


@query("session_events", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM g) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, no")
def session_events(spark, sf: str) -> DataFrame:
    return _stamped(streams.sessions(_events(spark, sf), "ts", "6 hours", "user_id")).select("user_id", "start", "n")


@query("dedup_events", "SELECT user_id, event_type, count(*) AS dropped FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events) WHERE n > 1 GROUP BY 1, 2")
def dedup_events(spark, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    kept = streams.first_seen(e, ["user_id", "event_type"]).select("user_id", "event_type", F.lit(1).alias("one"))
    return e.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n")).join(kept, ["user_id", "event_type"]).select("user_id", "event_type", (F.col("n") - F.col("one")).alias("dropped")).filter("dropped > 0")


@query("warnings_union", "SELECT code, subject, n FROM (SELECT 'failures' AS code, event_type AS subject, count(*) FILTER (WHERE value < 20) AS n FROM events GROUP BY event_type UNION ALL SELECT 'no_downloads', event_type, count(*) FROM events GROUP BY event_type HAVING max(value) < 90 UNION ALL SELECT 'unknown_dag', r_name, 1 FROM region WHERE r_name NOT IN (SELECT n_name FROM nation) UNION ALL SELECT 'stuck_cursor', p_brand, count(*) FROM part WHERE p_size > 40 GROUP BY p_brand HAVING count(*) >= 3 AND count(DISTINCT p_type) <= 1) WHERE n > 0")
def warnings_union(spark, sf: str) -> DataFrame:
    e, r, n, p = (table(spark, sf, t) for t in ("events", "region", "nation", "part"))
    per = e.groupBy(F.col("event_type").alias("subject")).agg(F.count(F.when(F.col("value") < 20, 1)).alias("low"), F.count(F.lit(1)).alias("all"), F.max("value").alias("top"))
    unknown = r.join(n.select(F.col("n_name").alias("r_name")), "r_name", "left_anti").select(F.lit("unknown_dag").alias("code"), F.col("r_name").alias("subject"), F.lit(1).cast("long").alias("n"))
    stuck = p.filter("p_size > 40").groupBy(F.col("p_brand").alias("subject")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("p_type").alias("k")).filter("n >= 3 AND k <= 1").select(F.lit("stuck_cursor").alias("code"), "subject", "n")
    parts = [per.select(F.lit("failures").alias("code"), "subject", F.col("low").alias("n")), per.filter("top < 90").select(F.lit("no_downloads").alias("code"), "subject", F.col("all").alias("n")), unknown, stuck]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.filter("n > 0")


@query("weak_label_diagnosis", "SELECT label, CASE WHEN sources = 0 THEN 'never_searched' WHEN platforms <= 1 THEN 'one_platform' WHEN last < 1900 THEN 'not_recent' WHEN total = 0 THEN 'content' ELSE 'quiet' END AS why FROM (SELECT p_type AS label, count(*) FILTER (WHERE p_size > 48) AS sources, count(DISTINCT p_brand) FILTER (WHERE p_size > 48) AS platforms, max(p_partkey) FILTER (WHERE p_size > 48) AS last, count(*) FILTER (WHERE p_size < 3) AS total FROM part GROUP BY p_type)")
def weak_label_diagnosis(spark, sf: str) -> DataFrame:
    searched = F.col("p_size") > 48
    s = table(spark, sf, "part").groupBy(F.col("p_type").alias("label")).agg(F.count(F.when(searched, 1)).alias("sources"), F.countDistinct(F.when(searched, F.col("p_brand"))).alias("platforms"), F.max(F.when(searched, F.col("p_partkey"))).alias("last"), F.count(F.when(F.col("p_size") < 3, 1)).alias("total"))
    why = F.when(F.col("sources") == 0, "never_searched").when(F.col("platforms") <= 1, "one_platform").when(F.col("last") < 1900, "not_recent").when(F.col("total") == 0, "content").otherwise("quiet")
    return s.select("label", why.alias("why"))


@query("inventory_by_label", "SELECT lang AS label, count(*) AS n_files, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes FROM documents GROUP BY lang")
def inventory_by_label(spark, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy(F.col("lang").alias("label")).agg(F.count(F.lit(1)).alias("n_files"), F.sum(F.octet_length("text")).alias("n_bytes"))


@query("segments_by_stream", "SELECT l_orderkey, max(l_suppkey * 1000 + b) AS best FROM (SELECT l_orderkey, l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS b FROM (SELECT DISTINCT l_orderkey, l_suppkey, l_partkey, l_quantity FROM lineitem) GROUP BY 1, 2) GROUP BY 1")
def segments_by_stream(spark, sf: str) -> DataFrame:
    """Segments distinct by path and range, bytes summed by stream, the leading stream of each handler."""
    s = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_quantity").distinct()
    sums = s.groupBy("l_orderkey", "l_suppkey").agg(F.sum("l_quantity").cast("long").alias("b"))
    return sums.groupBy("l_orderkey").agg(F.max(F.col("l_suppkey") * 1000 + F.col("b")).alias("best"))


@query("unique_names", "SELECT l_orderkey, l_linenumber, CASE WHEN n = 0 THEN base ELSE base || '_' || n END AS name FROM (SELECT l_orderkey, l_linenumber, l_returnflag || (l_orderkey % 100) AS base, row_number() OVER (PARTITION BY l_returnflag || (l_orderkey % 100) ORDER BY l_orderkey * 10 + l_linenumber) - 1 AS n FROM lineitem)")
def unique_names(spark, sf: str) -> DataFrame:
    rows = derive(spark, sf, "SELECT l_orderkey, l_linenumber, l_returnflag || (l_orderkey % 100) AS base, l_orderkey * 10 + l_linenumber AS o FROM {lineitem}")
    return tables.unique_names(rows, "base", "o").select("l_orderkey", "l_linenumber", "name")


@query("first_success", "SELECT l_orderkey, CAST(min(l_linenumber) FILTER (WHERE l_returnflag = 'R' AND l_linenumber <= 5) AS INT) AS frame FROM lineitem GROUP BY 1")
def first_success(spark, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min(F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") <= 5), F.col("l_linenumber"))).alias("frame"))


@query("top_parts_by_type", "SELECT p_type, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_size DESC, p_partkey) AS n FROM part) WHERE n <= 3")
def top_parts_by_type(spark, sf: str) -> DataFrame:
    return segments.top_rows(table(spark, sf, "part"), ["p_type"], [F.col("p_size").desc(), F.col("p_partkey")], 3).select("p_type", "p_partkey")
