"""Quality rules: features of each text, and lines that too many documents of a host hold.

Native. The cross-document rule hashes normalised lines (trimmed, lower-cased, white space squeezed) once and counts,
per host, the distinct documents that hold them; documents with equal texts count once. Lines over the limit are removed
(``clean``), and a document of which too few words are left is rejected. The limit is a share of the host's documents, so it
means the same at any size. Null text has no words and fails; null hosts form one host. Rows are judged by their host
and text alone, so repeated rows and repeated or null ids get equal verdicts; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsieve.llm.common import HOT_PARTS, WS, cut, join_spread, let, pack, small, small_bytes, text_key, unpack, words

SYMBOLS = "#*$%&|<>"


def repeated_window_words(ws: Column, width: int = 3) -> Column:
    """Words inside windows of ``width`` words that the array holds more than once. Sorting the window hashes with
    their places puts equal windows side by side; texts without a repeat stop after a distinct count."""
    starts = F.sequence(F.lit(0), F.size(ws) - width)

    def covered(hs: Column) -> Column:
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(pairs, lambda p: F.filter(p, lambda x, j: (F.get(p, j - 1)["h"].eqNullSafe(x["h"])) | (F.get(p, j + 1)["h"].eqNullSafe(x["h"]))))
        places = F.flatten(F.transform(again, lambda x: F.sequence(x["i"], x["i"] + (width - 1))))
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(F.size(F.array_distinct(places)))

    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
        return F.when(F.size(w) < width, F.lit(0)).otherwise(let(hashes, covered))

    return let(ws, of).cast("long")


def features(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed of a text column."""
    t = F.coalesce(text, F.lit(""))
    ws = words(t)
    n = F.size(ws).cast("long")
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(WS)) != "")
    return {
        "n_words": n,
        "word_chars": F.length(F.translate(t, WS, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_window_words(ws),
    }


def host_lines(packed: DataFrame, host: str) -> DataFrame:
    """host, t1, t2, copies, ls: each distinct text of a host once; ls holds place, hash and words of its lines with a
    word. The host is a 64-bit hash, so what is broadcast has rows of a known size."""
    src = F.xxhash64(F.coalesce(F.col(f"row.{host}").cast("string"), F.lit("\0"))).alias("host")
    lines = F.split(F.regexp_replace(F.lower(F.coalesce("row.text", F.lit(""))), r"[\x20\x09\x0B-\x0D]+", " "), " ?\n ?")
    parts = F.transform(lines, lambda x, i: F.struct(i.alias("pos"), F.xxhash64(F.btrim(x)).alias("h"), F.when(F.btrim(x) == "", 0).otherwise(F.size(F.split(F.btrim(x), " "))).alias("n")))
    rows = packed.select(src, *text_key(), F.filter(parts, lambda x: x["n"] > 0).alias("ls"))
    return rows.groupBy("host", "t1", "t2").agg(F.count(F.lit(1)).alias("copies"), F.first("ls").alias("ls"))


def common_lines(packed: DataFrame, host: str, share: float, min_docs: int, broadcast_rows: int) -> tuple[DataFrame, bool]:
    """host, t1, t2, copies, n_common (words), gone (places) of each text with lines over the limit; and if that is
    broadcast. Lines of very many texts are dealt out where they can't be broadcast."""
    texts = cut(host_lines(packed, host))
    sizes, _ = small(cut(texts.groupBy("host").agg(F.count("t1").alias("of"))), broadcast_rows)
    once = texts.select("host", F.explode(F.array_distinct("ls.h")).alias("h"))
    counts = once.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") >= min_docs)
    held = cut(counts.join(sizes, "host").filter(F.col("n_docs") > F.col("of") * share).select("host", "h", "n_docs"))
    lines = texts.select("host", "t1", "t2", "copies", F.explode("ls").alias("x")).select("host", "t1", "t2", "copies", "x.*")
    over, few = small(held, broadcast_rows)
    if few:
        met = lines.join(over, ["host", "h"])
    else:
        total = held.agg(F.sum("n_docs")).first()[0] or 0
        met = join_spread(lines, held, ["host", "h"], held.filter(F.col("n_docs") > total / HOT_PARTS), [F.col("t1")]).filter("n_docs IS NOT NULL")
    common = met.groupBy("host", "t1", "t2").agg(F.first("copies").alias("copies"), F.sum("n").cast("long").alias("n_common"), F.collect_list("pos").alias("gone"))
    return small_bytes(cut(common), 4 * F.size("gone") + 60, 100 * broadcast_rows)


def judged(docs: DataFrame, host: str, share: float, min_docs: int, least_left: float, broadcast_rows: int) -> DataFrame:
    """row (docs' columns), features as f_*, n_common, gone, failed and kept."""
    packed = pack(docs)
    src = F.xxhash64(F.coalesce(F.col(f"row.{host}").cast("string"), F.lit("\0"))).alias("host")
    common, few = common_lines(packed, host, share, min_docs, broadcast_rows)
    wide = packed.select("row", src, *text_key(), *[v.alias(f"f_{k}") for k, v in features(F.col("row.text")).items()])
    key = ["host", "t1", "t2"]
    if few:
        joined = wide.join(common.drop("copies"), key, "left")
    else:
        rows = packed.count()
        salt = F.col("row").getField(next(c for c in docs.columns if c.lower() == "doc_id")).cast("string") if any(c.lower() == "doc_id" for c in docs.columns) else F.rand(7)
        joined = join_spread(wide, common.drop("copies"), key, common.filter(F.col("copies") > rows / HOT_PARTS).drop("copies"), [salt])
    n_common = F.coalesce("n_common", F.lit(0)).cast("long")
    failed = (F.col("f_n_words") < 50) | (100 * F.col("f_n_repeat_words") > 50 * F.col("f_n_words"))
    depleted = (F.col("f_n_words") - n_common) < least_left * F.col("f_n_words")
    return joined.withColumns({"n_common": n_common, "failed": failed, "kept": ~failed & ~depleted})


def judge(docs: DataFrame, host: str = "source", share: float = 0.01, min_docs: int = 10, least_left: float = 0.3, broadcast_rows: int = 100_000) -> DataFrame:
    """docs with the features, n_common_words (words in lines over the limit), base_failed and kept. The lines over the
    limit, and the texts that hold any, are each broadcast when they count at most ``broadcast_rows`` (texts: 100 bytes for
    each of these, with the places of their lines), else joined by a shuffle that deals out lines of very many texts and texts of very many copies."""
    joined = judged(docs, host, share, min_docs, least_left, broadcast_rows)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return unpack(joined, docs.columns, **{k: F.col(f"f_{k}") for k in names}, n_common_words=F.col("n_common"), base_failed=F.col("failed"), kept=F.col("kept"))


def clean(docs: DataFrame, host: str = "source", share: float = 0.01, min_docs: int = 10, least_left: float = 0.3, broadcast_rows: int = 100_000) -> DataFrame:
    """The documents that are kept, without their lines over the limit; a document without any keeps its text as it is."""
    joined = judged(docs, host, share, min_docs, least_left, broadcast_rows).filter("kept")
    left = let(F.split("row.text", "\n"), lambda ls: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("gone")), lambda i: F.get(ls, i)), "\n"))
    return unpack(joined, docs.columns, text=F.when(F.size("gone") > 0, left).otherwise(F.col("row.text")))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_common_words", "base_failed", "kept")


_BLANK = r"[\x20\x09-\x0D]"
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '{_BLANK}+'), lambda x: x <> '') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
 list_filter(list_transform(string_split_regex(regexp_replace(lower(t), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), ' ?\n ?'), lambda x: trim(x)), lambda x: x <> '') AS ns FROM d),
g AS (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w), h AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS tri FROM g),
r AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, tri) AS c FROM h),
k AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM r WHERE c > 1) GROUP BY rid),
l AS (SELECT rid, host, t, unnest(ns) AS line, generate_subscripts(ns, 1) AS pos FROM w),
o AS (SELECT host, line, count(DISTINCT t) AS held FROM l GROUP BY host, line), z AS (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY host),
f AS (SELECT host, line FROM o JOIN z USING (host) WHERE held >= 10 AND held > 0.01 * n),
m AS (SELECT rid, sum(len(string_split(line, ' ')))::BIGINT AS n_common FROM l JOIN f USING (host, line) GROUP BY rid),
a AS (SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
 len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_common, 0) AS n_common_words FROM w LEFT JOIN k USING (rid) LEFT JOIN m USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a)
SELECT *, NOT base_failed AND NOT (n_words - n_common_words < 0.3 * n_words) AS kept FROM b
"""
