"""Queries of view aggregation, label names, media rules, annotations and cookies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsieve.functions import hashing as H
from reelsieve.functions import media as M
from reelsieve.functions import text as X
from reelsieve.plans import catalog as C
from reelsieve.plans.base import LABEL_ROWS, NAMES, derive, duck, query, table

_VIEWS = "SELECT l_orderkey % 500 AS win, l_linenumber AS clip, l_suppkey % 3 AS crop, l_partkey % 4 AS cls, CAST(l_partkey % 50 AS DOUBLE) / 10 AS logit FROM {lineitem}"


@query("view_aggregation", f"""WITH v AS ({duck(_VIEWS)}), c AS (SELECT win, clip, cls, avg(logit) AS z FROM v GROUP BY ALL), e AS (SELECT *, exp(z - max(z) OVER (PARTITION BY win, clip)) AS x FROM c), p AS (SELECT *, x / sum(x) OVER (PARTITION BY win, clip) AS p FROM e),
m AS (SELECT win, cls, avg(logit) AS z FROM v GROUP BY ALL), f AS (SELECT *, exp(z - max(z) OVER (PARTITION BY win)) AS x FROM m), q AS (SELECT win, cls, x / sum(x) OVER (PARTITION BY win) AS p FROM f)
SELECT q.win, q.cls, CAST(floor(q.p * 10000 + 0.5) AS BIGINT) AS p_mean, CAST(floor(max(p.p) * 10000 + 0.5) AS BIGINT) AS p_max FROM q JOIN p ON p.win = q.win AND p.cls = q.cls GROUP BY q.win, q.cls, q.p""")
def view_aggregation(spark, sf: str) -> DataFrame:
    """Class probabilities of a window's views: softmax of mean logits, and the most over clips of each clip's softmax."""
    v = derive(spark, sf, _VIEWS)

    def probs(rows: DataFrame, by: list[str]) -> DataFrame:
        z = rows.groupBy(*by, "cls").agg(F.avg("logit").alias("z"))
        w = Window.partitionBy(*by)
        x = z.withColumn("x", F.exp(F.col("z") - F.max("z").over(w)))
        return x.select(*by, "cls", (F.col("x") / F.sum("x").over(w)).alias("p"))

    whole = lambda c: F.floor(c * 10000 + 0.5).cast("long")
    top = probs(v, ["win", "clip"]).groupBy("win", "cls").agg(whole(F.max("p")).alias("p_max"))
    return probs(v, ["win"]).select("win", "cls", whole(F.col("p")).alias("p_mean")).join(top, ["win", "cls"])


_CAMEL = "regexp_replace({0}, '([a-z])([A-Z])', '\\1 \\2', 'g')"
_TOK = "list_filter(string_split_regex(lower(" + _CAMEL + "), '[^0-9a-z]+'), lambda x: x <> '')"
_ALIKE = "({0} <> '' AND {1} <> '' AND ({0} = {1} OR list_has_all({3}, {2}) OR list_has_all({2}, {3}) OR (least(length({0}), length({1})) >= 4 AND (starts_with({0}, {1}) OR starts_with({1}, {0})))))"


@query("dataset_label", f"""WITH m AS (SELECT DISTINCT name AS model FROM ({duck(NAMES)})), t AS (SELECT model, label, display, ord, {_TOK.format('model')} AS tm, {_TOK.format('label')} AS tl, {_TOK.format('display')} AS td FROM m CROSS JOIN {LABEL_ROWS}),
j AS (SELECT *, array_to_string(tm, '') AS nm, array_to_string(tl, '') AS nl, array_to_string(td, '') AS nd FROM t),
s AS (SELECT model, label, ord, CASE WHEN lower(display) = lower(model) THEN 0 WHEN lower(label) = regexp_replace(lower(model), '[^0-9a-z]', '', 'g') THEN 1 WHEN {_ALIKE.format('nm', 'nl', 'tm', 'tl')} OR {_ALIKE.format('nm', 'nd', 'tm', 'td')} THEN 2 END AS step FROM j)
SELECT model, min_by(label, step * 1000 + ord) AS label FROM s GROUP BY model""")
def dataset_label(spark, sf: str) -> DataFrame:
    """A model's class name as a dataset label: by display name, then letters, then words; the first label of the best."""
    labels = F.inline(F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(a).alias("label"), F.lit(b).alias("display")) for i, (a, b) in enumerate(C.LABELS)]))
    pairs = derive(spark, sf, NAMES).select(F.col("name").alias("model")).distinct().select("model", labels)  # each with the 27 labels
    flat = F.regexp_replace(F.lower("model"), "[^0-9a-z]", "")
    step = F.when(F.lower("display") == F.lower("model"), 0).when(F.lower("label") == flat, 1).when(X.same_label(F.col("model"), F.col("label")) | X.same_label(F.col("model"), F.col("display")), 2)
    return pairs.withColumn("step", step).groupBy("model").agg(F.min_by("label", F.when(F.col("step").isNotNull(), F.struct("step", "ord"))).alias("label"))


@query("recorder_origin", "SELECT p_partkey, s IN ('.dav', '.h264') OR c = 'dhav' OR regexp_matches(t, 'hikvision|\\bnvr\\b') AS recorder FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '.dav' WHEN 1 THEN '.mp4' WHEN 2 THEN '.h264' ELSE '.mkv' END AS s, CASE WHEN p_partkey % 11 = 0 THEN 'dhav' ELSE 'mov' END AS c, CASE p_partkey % 7 WHEN 0 THEN 'made by hikvision' WHEN 1 THEN 'nvr 5' WHEN 2 THEN 'nvrx' ELSE '' END AS t FROM part)")
def recorder_origin(spark, sf: str) -> DataFrame:
    d = derive(spark, sf, "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '.DAV' WHEN 1 THEN '.mp4' WHEN 2 THEN '.h264' ELSE '.mkv' END AS s, CASE WHEN p_partkey % 11 = 0 THEN 'dhav' ELSE 'mov' END AS c, CASE p_partkey % 7 WHEN 0 THEN 'made by Hikvision' WHEN 1 THEN 'NVR 5' WHEN 2 THEN 'nvrx' ELSE '' END AS t FROM {part}")
    return d.select("p_partkey", M.is_recorder(F.col("s"), F.col("c"), F.col("t")).alias("recorder"))


@query("annotation_segments", "SELECT l_orderkey, l_linenumber, 's' || substr(sha1('v' || l_orderkey || ':' || l_partkey), 1, 10) AS id, least(l_partkey * 40, 60000)::BIGINT AS start_ms FROM lineitem")
def annotation_segments(spark, sf: str) -> DataFrame:
    name = F.concat(F.lit("v"), F.col("l_orderkey").cast("string"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", H.segment_id(name, F.col("l_partkey")).alias("id"), M.frame_ms(F.col("l_partkey"), F.lit(25.0), F.lit(60.0)).alias("start_ms"))


@query("match_filter", "SELECT event_id, event_type <> 'error' AND (d IS NULL OR d <= CASE WHEN event_type = 'click' THEN 900 ELSE 1800 END) AS ok FROM (SELECT event_id, event_type, CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_id % 2500 END AS d FROM events)")
def match_filter(spark, sf: str) -> DataFrame:
    """Live rows go; so do those over their platform's longest duration; an unknown duration passes."""
    d = derive(spark, sf, "SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN 'dailymotion' ELSE 'youtube' END AS p, CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_id % 2500 END AS d FROM {events}")
    return d.select("event_id", ((F.col("event_type") != "error") & (F.col("d").isNull() | (F.col("d") <= M.max_duration(F.col("p"))))).alias("ok"))


@query("scaled_boxes", "SELECT l_orderkey, l_linenumber, CASE WHEN x - floor(x) >= 0.2 THEN CAST(ceil(x) AS BIGINT) ELSE CAST(floor(x) AS BIGINT) END AS x FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS DOUBLE) / 8 AS x FROM lineitem)")
def scaled_boxes(spark, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", M.scale_up(F.col("l_partkey").cast("double") / 8).alias("x"))


@query("soonest_expiry", "SELECT user_id % 20 AS jar, min(event_id) FILTER (WHERE event_id > 5000) AS soonest, bool_or(event_type = 'signup') AS signed_in FROM events GROUP BY 1")
def soonest_expiry(spark, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.groupBy((F.col("user_id") % 20).alias("jar")).agg(F.min(F.when(F.col("event_id") > 5000, F.col("event_id"))).alias("soonest"), F.bool_or(F.col("event_type") == "signup").alias("signed_in"))


@query("status_counts", "SELECT o_orderstatus AS status, o_orderpriority AS category, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
def status_counts(spark, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("category"))
    return o.groupingSets([["status"], ["category"], []], "status", "category").agg(F.count(F.lit(1)).alias("n"))


@query("keyword_cap", "SELECT p_type AS label, string_agg(p_name, '|' ORDER BY p_partkey) AS keywords FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS n FROM part) WHERE n <= 4 GROUP BY 1")
def keyword_cap(spark, sf: str) -> DataFrame:
    """The first four keywords of each label; ranked before they are gathered, so no group is held whole."""
    n = F.row_number().over(Window.partitionBy("p_type").orderBy("p_partkey"))
    first = table(spark, sf, "part").withColumn("n", n).filter("n <= 4")
    return first.groupBy(F.col("p_type").alias("label")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name"))), lambda s: s["p_name"]), "|").alias("keywords"))


@query("model_answers", "SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS yes FROM conversations")
def model_answers(spark, sf: str) -> DataFrame:
    said = F.when(F.col("conv_id") % 4 == 0, 'Sure: {"cctv": true, "n": 1} done').when(F.col("conv_id") % 4 == 1, '{"cctv": false}').when(F.col("conv_id") % 4 == 2, 'so\n{"cctv": "Yes"}').otherwise("no json")
    answers = table(spark, sf, "conversations").select("conv_id", "turn", said.alias("t"))
    return answers.select("conv_id", "turn", X.model_json(F.col("t"), "cctv")[0].alias("yes"))
