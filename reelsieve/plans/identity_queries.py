"""Queries of url identity, text predicates, deduplication layers and the funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsieve.functions import hashing as H
from reelsieve.functions import identity as I
from reelsieve.functions import media as M
from reelsieve.functions import text as X
from reelsieve.operators import graph, joins, scheduling, tables
from reelsieve.plans import catalog as C
from reelsieve.plans.base import FRAMES, LABEL_ROWS, NAMES, OUTCOMES, PLATFORMS, URLS, VIDEOS, derive, duck, query, table

_NETLOC = "split_part(list_last(string_split(lower(regexp_extract(coalesce(u, ''), '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1)), '@')), ':', 1)"
_PLATFORM = "CASE " + " ".join(f"WHEN host = '{h}' OR ends_with(host, '.{h}') THEN '{p}'" for p, hs in C.HOSTS.items() for h in hs) + " END"
_HOSTED = f"h AS (SELECT *, {_NETLOC} AS host FROM ({duck(URLS)}) b), p AS (SELECT *, {_PLATFORM} AS platform FROM h)"
_RULE = "CASE " + " ".join(f"WHEN platform = '{p}' AND regexp_matches(u, '{r}') THEN {i}" for i, (p, r, _, _) in enumerate(C.URL_RULES)) + " END"
_RULED = f"{_HOSTED}, r AS (SELECT *, {_RULE} AS rule FROM p)"
_TYPE = "CASE rule " + " ".join(f"WHEN {i} THEN '{t}'" for i, (_, _, t, _) in enumerate(C.URL_RULES)) + " END"
_ID = "CASE rule " + " ".join(f"WHEN {i} THEN regexp_extract(u, '{r}', 1)" for i, (_, r, _, _) in enumerate(C.URL_RULES)) + " END"
_SHORT = "coalesce(rule IN (" + ", ".join(str(i) for i, r in enumerate(C.URL_RULES) if r[3]) + "), false)"
_CANON = f"{_RULED}, c AS (SELECT page_id, u, platform, {_TYPE} AS object_type, {_ID} AS object_id, {_SHORT} AS is_short, rule FROM r)"


@query("platform_detect", f"WITH {_HOSTED} SELECT page_id, platform FROM p")
def platform_detect(spark, sf: str) -> DataFrame:
    return I.with_platform(derive(spark, sf, URLS), "u").select("page_id", "platform")


@query("canonical_id", f"WITH {_CANON} SELECT page_id, CASE WHEN rule IS NOT NULL THEN platform END AS platform, object_type, object_id FROM c")
def canonical_id(spark, sf: str) -> DataFrame:
    return I.with_identity(derive(spark, sf, URLS), "u").select("page_id", "platform", "object_type", "object_id")


@query("short_link", f"WITH {_CANON} SELECT page_id, is_short FROM c")
def short_link(spark, sf: str) -> DataFrame:
    return I.with_identity(derive(spark, sf, URLS), "u").select("page_id", "is_short")


@query("strip_query", f"SELECT page_id, split_part(u, '?', 1) AS bare, regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1) AS origin FROM ({duck(URLS)}) b")
def strip_query(spark, sf: str) -> DataFrame:
    return derive(spark, sf, URLS).select("page_id", I.strip_query(F.col("u")).alias("bare"), I.origin(F.col("u")).alias("origin"))


@query("absolute_url_gate", "SELECT CAST(page_id % 2 AS INT) AS part, count(*) AS n FROM (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN '/v/' || page_id ELSE url END AS u FROM pages) WHERE starts_with(u, 'http://') OR starts_with(u, 'https://') GROUP BY 1")
def absolute_url_gate(spark, sf: str) -> DataFrame:
    urls = derive(spark, sf, "SELECT page_id, CASE WHEN page_id % 5 = 0 THEN '/v/' || page_id ELSE url END AS u FROM {pages}")
    return urls.filter(I.is_absolute(F.col("u"))).groupBy((F.col("page_id") % 2).cast("int").alias("part")).agg(F.count("u").alias("n"))


@query("og_image", "SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, nullif(regexp_extract(html, '<meta property=\"og:image\" content=\"([^\"]*)\"', 1), '') AS image FROM pages")
def og_image(spark, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"), F.nullif(F.regexp_extract("html", '<meta property="og:image" content="([^"]*)"', 1), F.lit("")).alias("image"))


_FRONTIER = "SELECT page_id AS id, u AS url, CASE page_id % 5 WHEN 0 THEN 'downloaded' WHEN 1 THEN 'failed' WHEN 2 THEN 'skipped_not_cctv' WHEN 3 THEN 'pending' ELSE 'skipped_duplicate' END AS status FROM (" + URLS + ") x WHERE page_id % 3 > 0"


@query("l0_anti", f"SELECT page_id, u FROM ({duck(URLS)}) c WHERE u NOT IN (SELECT url FROM ({duck(_FRONTIER)}) f WHERE status IN {C.TERMINAL})")
def l0_anti(spark, sf: str) -> DataFrame:
    done = derive(spark, sf, _FRONTIER).filter(F.col("status").isin(*C.TERMINAL)).select(F.col("url").alias("u")).distinct()
    return derive(spark, sf, URLS).join(done, "u", "left_anti").select("page_id", "u")


@query("l1_first_match", f"WITH {_CANON}, s AS (SELECT platform, object_type, object_id, min(page_id) AS first, min_by(u, page_id) AS match FROM c WHERE rule IS NOT NULL GROUP BY ALL) SELECT c.page_id, CASE WHEN s.first < c.page_id THEN s.match END AS match FROM c LEFT JOIN s ON c.rule IS NOT NULL AND c.platform = s.platform AND c.object_type = s.object_type AND c.object_id = s.object_id")
def l1_first_match(spark, sf: str) -> DataFrame:
    """Each page's first earlier one of equal identity."""
    ids = I.with_identity(derive(spark, sf, URLS), "u").select("page_id", "u", "platform", "object_type", "object_id")
    store = ids.select(F.col("page_id").alias("id"), F.struct(F.col("page_id").alias("first"), "u").alias("url"), "platform", "object_type", "object_id")
    met = joins.first_match(ids, store, ["platform", "object_type", "object_id"])
    return met.select("page_id", F.when(F.col("match.first") < F.col("page_id"), F.col("match.u")).alias("match"))


@query("l2_first_match", "WITH d AS (SELECT doc_id, sha256(text) AS fh FROM documents), s AS (SELECT fh, min(doc_id) AS match FROM d GROUP BY fh) SELECT doc_id, CASE WHEN match < doc_id THEN match END AS first_copy FROM d JOIN s USING (fh)")
def l2_first_match(spark, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("fh"))
    store = d.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("url"), "fh")
    return joins.first_match(d, store, ["fh"]).select("doc_id", F.when(F.col("match") < F.col("doc_id"), F.col("match")).alias("first_copy"))


_BITS = "('0x' || {0}.h)::UBIGINT"
_DIST = f"bit_count(xor({_BITS.format('a')}, {_BITS.format('b')}))"


@query("l3_range_hamming", f"WITH v AS ({duck(VIDEOS)}) SELECT a.id AS new_id, b.id AS old_id, CAST({_DIST} AS INT) AS distance FROM v a JOIN v b ON b.id < a.id AND b.dur BETWEEN a.dur * 0.8 AND a.dur * 1.2 WHERE {_DIST} < 8")
def l3_range_hamming(spark, sf: str) -> DataFrame:
    v = derive(spark, sf, VIDEOS).withColumn("x", H.pack_hex(F.col("h")))
    new, old = v.select(F.col("id").alias("new_id"), F.col("dur").alias("dx"), "x"), v.select(F.col("id").alias("old_id"), F.col("dur").alias("dy"), F.col("x").alias("y"))
    # the bucket of the duration is a part of the key
    new = new.withColumn("bucket", F.explode(joins.share_buckets(F.col("dx"), C.DURATION_SHARE)))
    old = old.withColumn("bucket", F.explode(joins.share_buckets(F.col("dy"), C.DURATION_SHARE, 2)))
    near = joins.hamming_join(new, old, "x", "y", C.L3_BELOW - 1, ["bucket"])
    return near.filter("old_id < new_id AND dy BETWEEN dx * 0.8 AND dx * 1.2").select("new_id", "old_id", "distance")


# five frames for each video, alike at the same place in a group of four; every other video has one of its own
_ALIGNED = """SELECT vec_id AS id, CAST(40 + (vec_id - vec_id % 4) % 60 + (vec_id % 4) * 6 AS DOUBLE) AS dur, k AS pos,
 CASE WHEN k = vec_id % 5 AND vec_id % 2 = 0 THEN substr(sha2('own' || CAST(vec_id AS STRING), 256), 1, 16)
 ELSE substr(sha2(CAST(vec_id - vec_id % 4 AS STRING) || '-' || CAST(k AS STRING), 256), 1, 15) || substr('0123456789abcdef', CAST(vec_id * 7 % 16 AS INT) + 1, 1) END AS h
 FROM {embeddings} CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) ks"""
_FRAME_DIST = "bit_count(xor(('0x' || x.h)::UBIGINT, ('0x' || y.h)::UBIGINT))"


@query("l4_mean_hamming", f"WITH f AS ({duck(_ALIGNED)}) SELECT x.id AS new_id, y.id AS old_id, CAST(sum({_FRAME_DIST}) AS BIGINT) AS bits FROM f x JOIN f y ON y.id < x.id AND x.pos = y.pos AND y.dur BETWEEN x.dur * 0.8 AND x.dur * 1.2 GROUP BY 1, 2 HAVING sum({_FRAME_DIST}) < {5 * C.L4_MEAN_BELOW}")
def l4_mean_hamming(spark, sf: str) -> DataFrame:
    f = derive(spark, sf, _ALIGNED)
    fp = f.groupBy("id", "dur").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "h"))), lambda s: s["h"]).alias("hs"))
    parsed = fp.select("id", "dur", H.parse_fingerprint(F.array_join("hs", ":")).alias("fp"))
    near = joins.fingerprint_join(parsed, parsed, C.L4_MEAN_BELOW, C.DURATION_SHARE)
    return near.filter("old_id < new_id").select("new_id", "old_id", F.bround(F.col("mean") * 5).cast("long").alias("bits"))


@query("l4x_cross_hamming", f"WITH f AS ({duck(FRAMES)}), m AS (SELECT x.id AS new_id, y.id AS old_id, x.pos AS px, y.pos AS py FROM f x JOIN f y ON y.id < x.id WHERE (x.id + x.pos) % 7 > 0 AND {_FRAME_DIST} <= 6) SELECT new_id, old_id, least(count(DISTINCT px), count(DISTINCT py)) AS matches FROM m GROUP BY 1, 2 HAVING least(count(DISTINCT px), count(DISTINCT py)) >= 2")
def l4x_cross_hamming(spark, sf: str) -> DataFrame:
    """Any frame against any: bands of the frames' hashes, then distinct frames on each side. Frames (id + pos) % 7 = 0
    stand for those with little detail."""
    f = derive(spark, sf, FRAMES).withColumn("x", H.pack_hex(F.col("h")))
    new = f.filter("(id + pos) % 7 > 0").select(F.col("id").alias("new_id"), F.col("pos").alias("px"), "x")
    old = f.select(F.col("id").alias("old_id"), F.col("pos").alias("py"), F.col("x").alias("y"))
    met = joins.hamming_join(new, old, "x", "y", C.CROSS_DISTANCE).filter("old_id < new_id")
    return met.groupBy("new_id", "old_id").agg(F.least(F.countDistinct("px"), F.countDistinct("py")).alias("matches")).filter(F.col("matches") >= C.CROSS_FRAMES)


_PAIRS = f"WITH RECURSIVE v AS ({duck(VIDEOS)}), e AS (SELECT a.id AS x, b.id AS y FROM v a JOIN v b ON a.id <> b.id AND greatest(a.dur, b.dur) <= 1.2 * least(a.dur, b.dur) WHERE {_DIST} < 8)"


def _offline(spark, sf: str) -> DataFrame:
    v = derive(spark, sf, VIDEOS).withColumn("x", H.pack_hex(F.col("h")))
    a, b = v.select(F.col("id").alias("a"), F.col("dur").alias("da"), "x"), v.select(F.col("id").alias("b"), F.col("dur").alias("db"), F.col("x").alias("y"))
    a = a.withColumn("bucket", F.explode(joins.share_buckets(F.col("da"), C.DURATION_SHARE)))
    b = b.withColumn("bucket", F.explode(joins.share_buckets(F.col("db"), C.DURATION_SHARE, 2)))
    met = joins.hamming_join(a, b, "x", "y", C.L3_BELOW - 1, ["bucket"]).filter("a < b")
    return met.filter("greatest(da, db) <= 1.2 * least(da, db)").select("a", "b")


@query("offline_pairs", f"{_PAIRS} SELECT x AS a, y AS b FROM e WHERE x < y")
def offline_pairs(spark, sf: str) -> DataFrame:
    return _offline(spark, sf)


_REACH = f"{_PAIRS}, r(x, y) AS (SELECT x, x FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x), g AS (SELECT x AS node, min(y) AS root FROM r GROUP BY x)"


@query("dup_components", f"{_REACH} SELECT node, root FROM g")
def dup_components(spark, sf: str) -> DataFrame:
    return graph.components(_offline(spark, sf)).select("node", "root")


@query("keep_largest", f"{_REACH}, s AS (SELECT root, node, dur, row_number() OVER (PARTITION BY root ORDER BY dur DESC, node DESC) AS n FROM g JOIN v ON v.id = g.node) SELECT root, max(node) FILTER (WHERE n = 1) AS keeper, count(*) AS size, CAST(sum(dur) FILTER (WHERE n > 1) AS BIGINT) AS waste FROM s GROUP BY root")
def keep_largest(spark, sf: str) -> DataFrame:
    sizes = derive(spark, sf, VIDEOS).select(F.col("id").alias("node"), "dur")
    groups = graph.components(_offline(spark, sf)).join(sizes, "node")
    best = F.max(F.struct("dur", "node"))
    return groups.groupBy("root").agg(best.alias("k"), F.count("node").alias("size"), F.sum("dur").alias("all")).select("root", F.col("k.node").alias("keeper"), "size", (F.col("all") - F.col("k.dur")).cast("long").alias("waste"))


# accepted in order: an eligible one without an accepted earlier neighbour; the groups are small, so the SQL walks them
_ACCEPT = f"""WITH RECURSIVE v AS ({duck(VIDEOS)}), e AS (SELECT b.id AS i, a.id AS j FROM v a JOIN v b ON b.id < a.id AND b.dur BETWEEN a.dur * 0.8 AND a.dur * 1.2 WHERE {_DIST} < 8),
w(seq, acc) AS (SELECT -1::BIGINT, []::BIGINT[] UNION ALL SELECT w.seq + 1, CASE WHEN (w.seq + 1) % 5 > 0 AND NOT EXISTS (SELECT 1 FROM e WHERE e.j = w.seq + 1 AND list_contains(w.acc, e.i)) THEN list_append(w.acc, w.seq + 1) ELSE w.acc END FROM w WHERE w.seq < (SELECT max(id) FROM v)),
f AS (SELECT acc FROM w ORDER BY seq DESC LIMIT 1), a AS (SELECT unnest(acc) AS seq FROM f)"""


def _resolved(spark, sf: str) -> DataFrame:
    v = derive(spark, sf, VIDEOS)
    edges = l3_range_hamming(spark, sf).select(F.col("old_id").alias("earlier"), F.col("new_id").alias("later"))
    return graph.first_accepted(v.select(F.col("id").alias("seq"), (F.col("id") % 5 > 0).alias("eligible")), edges)


@query("first_accepted", f"{_ACCEPT} SELECT v.id AS seq, v.id IN (SELECT seq FROM a) AS accepted, CASE WHEN v.id NOT IN (SELECT seq FROM a) THEN (SELECT min(i) FROM e WHERE e.j = v.id AND e.i IN (SELECT seq FROM a)) END AS blocked_by FROM v")
def first_accepted(spark, sf: str) -> DataFrame:
    return _resolved(spark, sf)


_OUTCOME = "CASE WHEN accepted THEN 'downloaded' WHEN blocked_by IS NOT NULL THEN 'dup_l3' WHEN seq % 10 = 0 THEN 'not_cctv' ELSE 'no_event' END"
_FUNNEL = f"{_ACCEPT}, o AS (SELECT v.id AS seq, v.label, v.id IN (SELECT seq FROM a) AS accepted, CASE WHEN v.id NOT IN (SELECT seq FROM a) THEN (SELECT min(i) FROM e WHERE e.j = v.id AND e.i IN (SELECT seq FROM a)) END AS blocked_by FROM v), q AS (SELECT label, {_OUTCOME} AS outcome FROM o)"


def _funnel(spark, sf: str) -> DataFrame:
    labels = derive(spark, sf, VIDEOS).select(F.col("id").alias("seq"), "label")
    return _resolved(spark, sf).join(labels, "seq").select("label", F.expr(_OUTCOME).alias("outcome"))


@query("funnel_histogram", f"{_FUNNEL} SELECT outcome, count(*) AS n FROM q GROUP BY outcome")
def funnel_histogram(spark, sf: str) -> DataFrame:
    return _funnel(spark, sf).groupBy("outcome").agg(F.count("label").alias("n"))


@query("funnel_rollup", f"{_FUNNEL} SELECT label, outcome, count(*) AS n FROM q GROUP BY ROLLUP (label, outcome)")
def funnel_rollup(spark, sf: str) -> DataFrame:
    return _funnel(spark, sf).rollup("label", "outcome").agg(F.count(F.lit(1)).alias("n"))


@query("outcome_status", f"SELECT outcome, {'CASE outcome ' + ' '.join(f'''WHEN '{k}' THEN '{v}' ''' for k, v in C.STATUS.items()) + 'END'} AS status, n FROM ({_FUNNEL} SELECT outcome, count(*) AS n FROM q GROUP BY outcome)")
def outcome_status(spark, sf: str) -> DataFrame:
    status = F.create_map(*[F.lit(x) for kv in C.STATUS.items() for x in kv])
    return funnel_histogram(spark, sf).select("outcome", F.try_element_at(status, F.col("outcome")).alias("status"), "n")


@query("portrait_flag", "SELECT p_partkey, coalesce(h > 0 AND abs(w / h - 0.5625) < 0.05, false) AS portrait FROM (SELECT p_partkey, CAST(p_size * 20 AS DOUBLE) AS w, CAST(p_partkey % 97 * 20 AS DOUBLE) AS h FROM part)")
def portrait_flag(spark, sf: str) -> DataFrame:
    return derive(spark, sf, "SELECT p_partkey, p_size * 20 AS w, p_partkey % 97 * 20 AS h FROM {part}").select("p_partkey", M.is_portrait(F.col("w"), F.col("h")).alias("portrait"))


@query("title_blocklist", "SELECT conv_id, turn, NOT list_bool_or([contains(lower(coalesce(t, '')), x) FOR x IN [" + ", ".join(f"'{t}'" for t in C.TITLE_BLOCKLIST) + "]]) AS ok FROM (SELECT conv_id, turn, CASE conv_id % 3 WHEN 0 THEN text || ' Trailer' WHEN 1 THEN 'Best Of ' || text ELSE text END AS t FROM conversations)")
def title_blocklist(spark, sf: str) -> DataFrame:
    titles = derive(spark, sf, "SELECT conv_id, turn, CASE conv_id % 3 WHEN 0 THEN text || ' Trailer' WHEN 1 THEN 'Best Of ' || text ELSE text END AS t FROM {conversations}")
    return titles.select("conv_id", "turn", X.likely_camera_title(F.col("t")).alias("ok"))


_PHRASE = "SELECT p_partkey, p_name || CASE WHEN p_partkey % 3 = 0 THEN ' ' || upper(p_name) ELSE '' END AS t FROM {part}"


@query("keyword_valid", f"SELECT p_partkey, length(t) <= 90 AND len(ws) BETWEEN 1 AND 7 AND len(list_distinct(ws)) = len(ws) AS phrase, length(t) <= 80 AND len(cs) BETWEEN 1 AND 6 AND len(list_distinct(cs)) = len(cs) AS keyword FROM (SELECT p_partkey, t, list_filter(string_split_regex(lower(t), '\\s+'), lambda x: x <> '') AS ws, list_filter(string_split_regex(t, '\\s+'), lambda x: x <> '') AS cs FROM ({duck(_PHRASE)}))")
def keyword_valid(spark, sf: str) -> DataFrame:
    t = F.col("t")
    return derive(spark, sf, _PHRASE).select("p_partkey", X.valid_phrase(t).alias("phrase"), X.valid_phrase(t, 6, 80, False).alias("keyword"))


@query("normalize_title", "SELECT conv_id, turn, regexp_replace(lower(trim(text)), '\\s+', ' ', 'g') AS title FROM conversations")
def normalize_title(spark, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", X.normalize_title(F.col("text")).alias("title"))


_CAMEL = "regexp_replace({0}, '([a-z])([A-Z])', '\\1 \\2', 'g')"
_TOK = "list_filter(string_split_regex(lower(" + _CAMEL + "), '[^0-9a-z]+'), lambda x: x <> '')"


@query("label_tokens", f"SELECT p_partkey, array_to_string({_TOK.format('n')}, ' ') AS tokens FROM (SELECT p_partkey, concat(name, 'Of', p_type) AS n FROM ({duck(NAMES)}))")
def label_tokens(spark, sf: str) -> DataFrame:
    return derive(spark, sf, NAMES).select("p_partkey", F.array_join(X.label_tokens(F.concat("name", F.lit("Of"), "p_type")), " ").alias("tokens"))


_SIDE = f"SELECT p_partkey, {_TOK.format('name')} AS ta FROM ({duck(NAMES)})"
_MODEL = f"SELECT label, {_TOK.format('label')} AS tb FROM {LABEL_ROWS}"


@query("same_label_join", f"WITH a AS ({_SIDE}), b AS ({_MODEL}), c AS (SELECT *, array_to_string(ta, '') AS na, array_to_string(tb, '') AS nb FROM a CROSS JOIN b) SELECT p_partkey, label FROM c WHERE na <> '' AND nb <> '' AND (na = nb OR list_has_all(tb, ta) OR list_has_all(ta, tb) OR (least(length(na), length(nb)) >= 4 AND (starts_with(na, nb) OR starts_with(nb, na))))")
def same_label_join(spark, sf: str) -> DataFrame:
    """A name against each of the 27 fixed labels."""
    named = derive(spark, sf, NAMES).select("p_partkey", "name").repartition("p_partkey")  # few bytes are few tasks
    names = named.select("p_partkey", X.label_tokens(F.col("name")).alias("ta")).withColumn("na", F.array_join("ta", ""))
    labels = C.label_table(spark).select("label", X.label_tokens(F.col("label")).alias("tb")).withColumn("nb", F.array_join("tb", ""))
    return names.join(F.broadcast(labels), X.same_tokens(*map(F.col, ("ta", "na", "tb", "nb")))).select("p_partkey", "label")


@query("action_precedence", f"SELECT event_id, outcome, CASE WHEN outcome = 'portrait' THEN 'delete' WHEN grp = 'dedup' THEN 'delete' WHEN outcome = 'dup_l1' THEN 'keep' ELSE 'move' END AS action FROM ({duck(OUTCOMES)})")
def action_precedence(spark, sf: str) -> DataFrame:
    rules = F.create_map(*[F.lit(x) for x in ("*", "move", "portrait", "delete", "dedup", "delete", "dup_l1", "keep")])
    return derive(spark, sf, OUTCOMES).select("event_id", "outcome", scheduling.action_for(F.col("outcome"), F.col("grp"), rules, "move").alias("action"))


@query("filter_overlay", f"SELECT event_id, p, CASE WHEN value > 40 THEN event_type = 'view' WHEN p = 'reddit' THEN true WHEN event_type = 'click' THEN false ELSE true END AS videomae, CASE WHEN value > 40 THEN 'form' WHEN p = 'reddit' THEN 'platform' WHEN event_type = 'click' THEN 'all' ELSE 'default' END AS source FROM ({duck(PLATFORMS)})")
def filter_overlay(spark, sf: str) -> DataFrame:
    everywhere, own, form = F.when(F.col("event_type") == "click", False), F.when(F.col("p") == "reddit", True), F.when(F.col("value") > 40, F.col("event_type") == "view")
    source = scheduling.overlay(F.lit("default"), F.when(everywhere.isNotNull(), "all"), F.when(own.isNotNull(), "platform"), F.when(form.isNotNull(), "form"))
    return derive(spark, sf, PLATFORMS).select("event_id", "p", scheduling.overlay(F.lit(True), everywhere, own, form).alias("videomae"), source.alias("source"))


@query("fingerprint_backfill_anti", f"WITH v AS ({duck(VIDEOS)}) SELECT id FROM v WHERE id NOT IN (SELECT id FROM v WHERE id % 3 = 0)")
def fingerprint_backfill_anti(spark, sf: str) -> DataFrame:
    v = derive(spark, sf, VIDEOS).select("id")
    return v.join(v.filter("id % 3 = 0"), "id", "left_anti")


@query("frontier_merge", f"WITH f AS ({duck(_FRONTIER)}), c AS (SELECT DISTINCT u AS url FROM ({duck(URLS)}) b WHERE page_id % 4 = 0) SELECT id, f.url, CASE WHEN c.url IS NOT NULL THEN 'downloaded' ELSE status END AS status FROM f LEFT JOIN c ON c.url = f.url")
def frontier_merge(spark, sf: str) -> DataFrame:
    changes = derive(spark, sf, URLS).filter("page_id % 4 = 0").select(F.col("u").alias("url"), F.lit("downloaded").alias("status")).distinct()
    return tables.overwrite_matched(derive(spark, sf, _FRONTIER), changes, "url", ["status"])


@query("insert_absent", f"WITH b AS ({duck(URLS)}) SELECT min(page_id) AS page_id, u FROM b WHERE u NOT IN (SELECT u FROM b WHERE page_id % 2 = 0) GROUP BY u")
def insert_absent(spark, sf: str) -> DataFrame:
    b = derive(spark, sf, URLS)
    return tables.insert_absent(b.filter("page_id % 2 = 0"), b, "u", "page_id")


@query("hashtag", "SELECT p_partkey, CASE WHEN length(t) BETWEEN 5 AND 40 AND t NOT IN (" + ", ".join(f"'{t}'" for t in C.GENERIC_TAGS) + ") THEN t END AS tag FROM (SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS t FROM part)")
def hashtag(spark, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", X.to_hashtag(F.col("p_name")).alias("tag"))


@query("dct_hash")
def dct_hash(spark, sf: str) -> DataFrame:
    tiled = F.transform(F.sequence(F.lit(0), F.lit(1023)), lambda i: F.get("embedding", i % 64) * F.get("embedding", F.floor(i / 32).cast("int")))
    return table(spark, sf, "embeddings").select("vec_id", H.dct_hash(tiled.cast("array<double>")).alias("h"))
