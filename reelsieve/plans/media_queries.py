"""Queries of frame series, segments, events and detections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsieve.functions import media as M
from reelsieve.functions import text as X
from reelsieve.operators import detection, segments
from reelsieve.plans import catalog as C
from reelsieve.plans.base import BOXES, SEGMENTS, derive, duck, query, table

_SERIES = "SELECT user_id, event_id, CAST(floor(value) AS DOUBLE) AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM {events}"


@query("frame_delta_lag", f"SELECT event_id, coalesce(abs(v - lag(v) OVER (PARTITION BY user_id ORDER BY i)), 0.0) AS delta FROM ({duck(_SERIES)})")
def frame_delta_lag(spark, sf: str) -> DataFrame:
    return segments.frame_deltas(derive(spark, sf, _SERIES), "user_id", ["i"], "v").select("event_id", "delta")


@query("shot_split", f"""WITH RECURSIVE s AS ({duck(_SERIES)}), n AS (SELECT user_id, max(i) AS last FROM s GROUP BY user_id),
w(user_id, i, cut, cuts) AS (SELECT user_id, 0::BIGINT, 0::BIGINT, 1 FROM n UNION ALL
 SELECT w.user_id, w.i + 1, CASE WHEN s.v >= 60 AND w.i + 1 - w.cut >= 3 THEN w.i + 1 ELSE w.cut END, CASE WHEN s.v >= 60 AND w.i + 1 - w.cut >= 3 THEN w.cuts + 1 ELSE w.cuts END
 FROM w JOIN s ON s.user_id = w.user_id AND s.i = w.i + 1)
SELECT user_id, CAST(max(cuts) AS INT) AS shots, max(cut) AS last_cut FROM w GROUP BY user_id""")
def shot_split(spark, sf: str) -> DataFrame:
    return segments.shot_ends(derive(spark, sf, _SERIES), "user_id", "i", "v", 3, 60.0)


@query("merge_intervals", f"""WITH s AS ({duck(SEGMENTS)}), f AS (SELECT *, CASE WHEN s - max(e) OVER (PARTITION BY video ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) < 0.5 THEN 0 ELSE 1 END AS new FROM s),
r AS (SELECT *, sum(new) OVER (PARTITION BY video ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM f) SELECT video, min(s) AS s, max(e) AS e, max(prob) AS prob FROM r GROUP BY video, run""")
def merge_intervals(spark, sf: str) -> DataFrame:
    return segments.merge_intervals(derive(spark, sf, SEGMENTS), "video", "s", "e", "prob")


@query("eff_fps_p75", f"WITH s AS ({duck(_SERIES)}), q AS (SELECT user_id, count(*) AS n, quantile_cont(v, 0.75) AS p75 FROM s GROUP BY user_id) SELECT user_id, n, CASE WHEN n >= 10 AND p75 >= 0.4 THEN k END AS repeated FROM q JOIN (SELECT user_id, count(*) FILTER (WHERE v < 0.15 * p75) AS k FROM s JOIN q USING (user_id) GROUP BY user_id) USING (user_id)")
def eff_fps_p75(spark, sf: str) -> DataFrame:
    r = segments.repeat_rate(derive(spark, sf, _SERIES), "user_id", "v", 10.0)
    return r.select("user_id", "n", F.round(F.col("dup_ratio") * F.col("n")).cast("long").alias("repeated"))


_EVIDENCE = "SELECT l_orderkey AS video, l_linenumber AS no, CAST(l_suppkey % 100 AS DOUBLE) / 100 AS pv, CASE l_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 1.0 WHEN 2 THEN 0.75 WHEN 3 THEN 0.4 ELSE 0.0 END AS ts, CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE CAST(l_partkey % 30 AS DOUBLE) END AS ef, CAST(l_suppkey % 10 AS DOUBLE) / 10 AS gray, CAST(1 + l_quantity AS DOUBLE) AS duration FROM {lineitem}"


@query("segment_score", f"SELECT video, no, CAST(round(s * 100) AS BIGINT) AS evidence, CASE WHEN p >= 0.7 THEN 'cctv' WHEN p <= 0.3 THEN 'not_cctv' ELSE 'uncertain' END AS label FROM (SELECT *, 1 / (1 + exp(1 - s)) AS p FROM (SELECT video, no, 5 * (pv - 0.5) + CASE WHEN ts >= 1 THEN 4 WHEN ts >= 0.75 THEN 3 WHEN ts >= 0.4 THEN 1.5 ELSE 0 END + CASE WHEN ef <= 16 THEN 1.5 ELSE 0 END + CASE WHEN gray >= 0.5 THEN 0.5 ELSE 0 END AS s FROM ({duck(_EVIDENCE)})))")
def segment_score(spark, sf: str) -> DataFrame:
    d = derive(spark, sf, _EVIDENCE).withColumn("s", M.segment_evidence(F.col("pv"), F.col("ts"), F.col("ef"), F.lit(25.0), F.col("gray")))
    return d.select("video", "no", F.round(F.col("s") * 100).cast("long").alias("evidence"), M.segment_label(M.segment_prob(F.col("s"))).alias("label"))


@query("video_verdict", f"SELECT video, CAST(coalesce(sum(duration) FILTER (WHERE pv >= 0.7), 0) AS BIGINT) AS cctv_seconds, CAST(max(pv) * 100 + 0.5 AS BIGINT) AS max_prob, CASE WHEN coalesce(sum(duration) FILTER (WHERE pv >= 0.7), 0) >= 2 THEN 'cctv' WHEN max(pv) > 0.3 THEN 'uncertain' ELSE 'not_cctv' END AS label FROM ({duck(_EVIDENCE)}) GROUP BY video".replace("CAST(max(pv) * 100 + 0.5 AS BIGINT)", "CAST(floor(max(pv) * 100 + 0.5) AS BIGINT)"))
def video_verdict(spark, sf: str) -> DataFrame:
    v = segments.video_verdict(derive(spark, sf, _EVIDENCE).withColumnRenamed("pv", "prob"), "video")
    return v.select("video", F.col("cctv_seconds").cast("long").alias("cctv_seconds"), F.floor(F.col("max_prob") * 100 + 0.5).cast("long").alias("max_prob"), "label")


_LOGITS = "SELECT l_orderkey AS win, l_linenumber AS cls, CAST(l_partkey % 50 AS DOUBLE) / 10 AS logit FROM {lineitem}"


@query("event_windows_argmax", f"WITH l AS ({duck(_LOGITS)}) SELECT win, arg_max(cls, logit * 1000 - cls) AS best, arg_max(cls, logit * 1000 - cls) FILTER (WHERE cls <> 1) AS best_event FROM l GROUP BY win")
def event_windows_argmax(spark, sf: str) -> DataFrame:
    """Class 1 stands for the normal one; ties go to the lower class."""
    ranked = F.struct("logit", -F.col("cls"))
    return derive(spark, sf, _LOGITS).groupBy("win").agg(F.max_by("cls", ranked).alias("best"), F.max_by("cls", F.when(F.col("cls") != 1, ranked)).alias("best_event"))


@query("softmax_probs", f"WITH l AS ({duck(_LOGITS)}), m AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY win)) AS e FROM l) SELECT win, cls, CAST(floor(e / sum(e) OVER (PARTITION BY win) * 10000 + 0.5) AS BIGINT) AS p FROM m")
def softmax_probs(spark, sf: str) -> DataFrame:
    rows = derive(spark, sf, _LOGITS).groupBy("win").agg(F.array_sort(F.collect_list(F.struct("cls", "logit"))).alias("a"))
    probs = rows.select("win", "a", M.softmax(F.transform("a", lambda x: x["logit"])).alias("p"))
    return probs.select("win", F.explode(F.arrays_zip(F.transform("a", lambda x: x["cls"]).alias("cls"), F.col("p").alias("p"))).alias("z")).select("win", F.col("z.cls").alias("cls"), F.floor(F.col("z.p") * 10000 + 0.5).cast("long").alias("p"))


@query("topk_segments", f"WITH s AS ({duck(SEGMENTS)}) SELECT video, no, rank FROM (SELECT *, row_number() OVER (PARTITION BY video ORDER BY prob DESC, no) AS rank FROM s) WHERE rank <= 5".replace("SELECT video, no, rank", "SELECT video, no, CAST(rank AS INT) AS rank"))
def topk_segments(spark, sf: str) -> DataFrame:
    return segments.top_rows(derive(spark, sf, SEGMENTS), ["video"], [F.col("prob").desc(), F.col("no")], 5).select("video", "no", "rank")


@query("tumbling_frame_windows", f"SELECT user_id, i // 16 AS win, count(*) AS frames, max(v) AS top FROM ({duck(_SERIES)}) GROUP BY 1, 2")
def tumbling_frame_windows(spark, sf: str) -> DataFrame:
    return derive(spark, sf, _SERIES).groupBy("user_id", F.floor(F.col("i") / 16).alias("win")).agg(F.count("i").alias("frames"), F.max("v").alias("top"))


@query("centroid_cosine", "WITH u AS (SELECT vec_id, label, embedding, sqrt(list_sum([x::DOUBLE * x::DOUBLE FOR x IN embedding])) AS n FROM embeddings), f AS (SELECT vec_id, label, unnest([x::DOUBLE / n FOR x IN embedding]) AS x, generate_subscripts(embedding, 1) AS pos FROM u), c AS (SELECT label, pos, avg(x) AS m FROM f GROUP BY label, pos), z AS (SELECT label, sqrt(sum(m * m)) AS s FROM c GROUP BY label) SELECT vec_id, CAST(floor(sum(f.x * c.m / z.s) * 10000 + 0.5) AS BIGINT) AS cosine FROM f JOIN c USING (label, pos) JOIN z USING (label) GROUP BY vec_id")
def centroid_cosine(spark, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    c = segments.centroids(e, "label", "embedding").groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]).alias("c"))
    norm = F.sqrt(M.dot(F.col("embedding"), F.col("embedding")))
    return e.join(c, "label").select("vec_id", F.floor(M.dot(F.col("embedding"), F.col("c")) / norm * 10000 + 0.5).cast("long").alias("cosine"))


_IOU = "(greatest(0.0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0.0, least(a.y2, b.y2) - greatest(a.y1, b.y1)))"
_AREA = "(({0}.x2 - {0}.x1) * ({0}.y2 - {0}.y1))"
_RATIO = f"({_IOU} / ({_AREA.format('a')} + {_AREA.format('b')} - {_IOU}))"


@query("iou_pairs", f"WITH x AS ({duck(BOXES)}) SELECT a.image, a.no AS a, b.no AS b, CAST(floor({_RATIO} * 10000 + 0.5) AS BIGINT) AS iou FROM x a JOIN x b ON a.image = b.image AND a.no < b.no WHERE {_RATIO} > 0.3")
def iou_pairs(spark, sf: str) -> DataFrame:
    return detection.overlapping_pairs(derive(spark, sf, BOXES), "image", "no", 0.3).withColumn("iou", F.floor(F.col("iou") * 10000 + 0.5).cast("long"))


@query("nms_greedy", f"""WITH RECURSIVE x AS ({duck(BOXES)}), o AS (SELECT image, max(no) AS last FROM x GROUP BY image),
w(image, no, kept) AS (SELECT image, 0, []::INT[] FROM o UNION ALL SELECT w.image, w.no + 1, CASE WHEN EXISTS (SELECT 1 FROM x b WHERE b.image = w.image AND b.no = w.no + 1) AND NOT EXISTS (SELECT 1 FROM x a JOIN x b ON a.image = b.image WHERE b.image = w.image AND b.no = w.no + 1 AND list_contains(w.kept, a.no) AND {_RATIO} > 0.5) THEN list_append(w.kept, w.no + 1) ELSE w.kept END FROM w JOIN o ON o.image = w.image AND w.no < o.last)
SELECT w.image, unnest(kept) AS no FROM w JOIN o ON o.image = w.image AND w.no = o.last""")
def nms_greedy(spark, sf: str) -> DataFrame:
    return detection.nms(derive(spark, sf, BOXES), "image", "no", 0.5).select("image", "no")


_PRESENT = f"SELECT image, list_sort(list_distinct(list(cls))) AS present FROM ({duck(BOXES)}) GROUP BY image"


@query("class_condition", f"SELECT image, {' OR '.join('list_has_all(present, [' + ', '.join(map(str, g)) + '])' for g in C.HELMET_GROUPS)} AS saved, list_has_all(present, [1, 4]) AS both, list_has_any(present, [3, 9]) AS any_of FROM ({_PRESENT})")
def class_condition(spark, sf: str) -> DataFrame:
    p = derive(spark, sf, BOXES).groupBy("image").agg(F.collect_set("cls").alias("present"))
    c = F.col("present")
    return p.select("image", detection.class_condition(c, list(C.HELMET_GROUPS)).alias("saved"), detection.class_condition(c, (1, 4)).alias("both"), detection.class_condition(c, [3, 9]).alias("any_of"))


@query("class_count", f"SELECT image, count(*) FILTER (WHERE cls = 2) >= 2 AS enough FROM ({duck(BOXES)}) GROUP BY image")
def class_count(spark, sf: str) -> DataFrame:
    return derive(spark, sf, BOXES).groupBy("image").agg(detection.enough(F.collect_list("cls"), 2, 2).alias("enough"))


@query("box_convert", f"SELECT image, no, greatest(0, least(CAST(trunc(x1 - 0.125 * (x2 - x1)) AS INT), 128)) AS l, greatest(0, least(CAST(trunc(y1) AS INT), 64)) AS t, greatest(0, least(CAST(trunc(x2 + 0.25 * (x2 - x1)) AS INT), 128)) AS r, greatest(0, least(CAST(trunc(y2) AS INT), 64)) AS b FROM ({duck(BOXES)})")
def box_convert(spark, sf: str) -> DataFrame:
    """Through shares of a 128 x 64 image, whose factors are exact, and back, widened and held inside the image."""
    w, h = F.lit(128.0), F.lit(64.0)
    cx, cy, bw, bh = M.centre_box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")], w, h)
    corners = M.crop_corners(cx, cy, bw, bh, w, h, (0.0, 0.0, 0.125, 0.25))
    return derive(spark, sf, BOXES).select("image", "no", *[c.cast("int").alias(n) for c, n in zip(corners, "ltrb")])


_PLATES = "SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN '30A' || (c_custkey % 900 + 12345) WHEN 1 THEN '29AB' || (c_custkey % 900 + 100) WHEN 2 THEN '51NG' || (10000 + c_custkey % 80000) WHEN 3 THEN 'AB1234' WHEN 4 THEN 'AB123CD' ELSE '09A123' END AS t FROM {customer}"
_RX = [f.replace("\\{2-3\\}", "[{]2-3[}]") for f in C.PLATE_FORMS]


@query("plate_regex", f"SELECT c_custkey, {' OR '.join(f'''regexp_matches(t, '{r}')''' for r in _RX)} AS plate, {' OR '.join(f'''regexp_matches(t, '{r}')''' for r in [*_RX, C.PLATE_FORM_MEANT])} AS plate_meant FROM ({duck(_PLATES)})")
def plate_regex(spark, sf: str) -> DataFrame:
    t = F.col("t")
    return derive(spark, sf, _PLATES).select("c_custkey", X.is_plate(t).alias("plate"), X.is_plate(t, as_meant=True).alias("plate_meant"))


_OCR = "SELECT l_orderkey AS image, l_linenumber AS no, l_returnflag || ' ' || (l_partkey % 100) AS text, CAST(80 + l_suppkey % 20 AS DOUBLE) / 100 AS conf FROM {lineitem}"


@query("plate_concat", f"SELECT image, coalesce(string_agg(replace(text, ' ', ''), '' ORDER BY no, text, conf) FILTER (WHERE conf >= 0.9), '') AS plate FROM ({duck(_OCR)}) GROUP BY image")
def plate_concat(spark, sf: str) -> DataFrame:
    lines = derive(spark, sf, _OCR).groupBy("image").agg(F.array_sort(F.collect_list(F.struct("no", "text", "conf"))).alias("lines"))
    return lines.select("image", X.plate_text(F.col("lines")).alias("plate"))


_CLOCKS = "SELECT l_orderkey AS video, CAST(l_linenumber AS DOUBLE) AS at_s, 'CAM 2 ' || lpad(CAST(l_partkey % 24 AS STRING), 2, '0') || ':' || lpad(CAST(l_suppkey % 60 AS STRING), 2, '0') || ':' || lpad(CAST(l_partkey % 60 AS STRING), 2, '0') AS t FROM {lineitem}"


@query("clock_consistency", f"WITH c AS (SELECT video, at_s, CAST(substr(t, 7, 2) AS INT) * 3600 + CAST(substr(t, 10, 2) AS INT) * 60 + CAST(substr(t, 13, 2) AS INT) AS s FROM ({duck(_CLOCKS)})) SELECT video, EXISTS (SELECT 1 FROM c a JOIN c b ON a.video = b.video WHERE a.video = v.video AND b.at_s - a.at_s >= 1 AND b.s - a.s > 0 AND b.s - a.s <= 4 * (b.at_s - a.at_s) + 2) AS consistent FROM (SELECT DISTINCT video FROM c) v")
def clock_consistency(spark, sf: str) -> DataFrame:
    reads = derive(spark, sf, _CLOCKS).select("video", F.col("at_s").alias("at"), F.explode(M.clock_seconds(F.col("t"))).alias("clock"))
    return segments.clock_consistent(reads, "video")


_CLASSES = ("Helmet", "Head", "Hat", "goods carried on a motorbike", "person")
_RANK = "CASE b.class_name " + " ".join(f"WHEN '{c}' THEN {C.CLASS_PRIORITY.get(c, 0)}" for c in _CLASSES) + " END"


# boxes in order of confidence; a box that overlaps a kept one replaces the first such one only if its class ranks higher
@query("priority_overlap", f"""WITH RECURSIVE x AS (SELECT *, [{', '.join(repr(c) for c in _CLASSES)}][cls + 1] AS class_name FROM ({duck(BOXES)})), y AS (SELECT b.*, {_RANK} AS rank FROM x b), o AS (SELECT image, max(no) AS last FROM y GROUP BY image),
h AS (SELECT b.image, b.no AS no, a.no AS other FROM y a JOIN y b ON a.image = b.image AND a.no < b.no WHERE {_RATIO} > 0.5),
w(image, no, kept) AS (SELECT image, 0, []::INT[] FROM o UNION ALL SELECT image, no, CASE WHEN class_name IS NULL THEN kept WHEN hit IS NULL THEN list_append(kept, no) WHEN rank > (SELECT rank FROM y k WHERE k.image = z.image AND k.no = hit) THEN list_append(list_filter(kept, lambda k: k <> hit), no) ELSE kept END
 FROM (SELECT w.image, w.no + 1 AS no, w.kept, y.class_name, y.rank, (SELECT arg_min(h.other, list_position(w.kept, h.other)) FROM h WHERE h.image = w.image AND h.no = w.no + 1 AND list_contains(w.kept, h.other)) AS hit
  FROM w JOIN o ON o.image = w.image AND w.no < o.last LEFT JOIN y ON y.image = w.image AND y.no = w.no + 1) z)
SELECT y.image, class_name, (x1 + x2) / 2 AS x, (y1 + y2) / 2 AS y, x2 - x1 AS w, y2 - y1 AS h, 1.0::DOUBLE / (1 + y.no) AS conf FROM (SELECT w.image, unnest(kept) AS no FROM w JOIN o ON o.image = w.image AND w.no = o.last) k JOIN y ON y.image = k.image AND y.no = k.no""")
def priority_overlap(spark, sf: str) -> DataFrame:
    names = F.array(*map(F.lit, _CLASSES))
    d = derive(spark, sf, BOXES).select("image", F.get(names, F.col("cls")).alias("class_name"), ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"), (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"), (F.lit(1.0) / (1 + F.col("no"))).alias("conf"))
    return detection.priority_overlap(d, "image", 0.5)


@query("streak_stop", """WITH s AS (SELECT user_id, event_id, event_type = 'view' OR event_type = 'click' AS known, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
r AS (SELECT *, sum(CASE WHEN known THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY i) AS run FROM s), n AS (SELECT *, sum(CASE WHEN known THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, run ORDER BY i) AS k FROM r),
z AS (SELECT user_id, min(i) AS stop FROM n WHERE k >= 5 GROUP BY user_id) SELECT s.user_id, count(*) AS n FROM s LEFT JOIN z USING (user_id) WHERE z.stop IS NULL OR s.i <= z.stop GROUP BY s.user_id""")
def streak_stop(spark, sf: str) -> DataFrame:
    s = table(spark, sf, "events").select("user_id", "event_id", F.col("event_type").isin("view", "click").alias("known"))
    return segments.streak_cut(s, "user_id", "event_id", "known", 5).groupBy("user_id").agg(F.count("event_id").alias("n"))


@query("even_subsample", f"WITH s AS ({duck(_SERIES)}), n AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS c FROM s) SELECT user_id, event_id FROM n WHERE list_contains([round_even(j * (c - 1) / 6.0, 0) FOR j IN range(7)], i)")
def even_subsample(spark, sf: str) -> DataFrame:
    return segments.even_subsample(derive(spark, sf, _SERIES), "user_id", "i", 7).select("user_id", "event_id")
