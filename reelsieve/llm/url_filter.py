"""URL filters: host/path rules and pattern rules, the latter fetched through their rarest literal token.

Native: array functions over a literal hash index; no shuffle of the pages, so hot hosts cost nothing.
Null urls and urls without ``://`` have an empty host and path, fit no host rule, and are judged by the pattern
rules alone (a null url fits none). Repeated rows are judged each on its own; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsieve.llm.common import ascii_lower, cut, unpack


@dataclass(frozen=True)
class HostRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """A url that fits ``pattern`` has every token of ``literals`` among its lower-cased alphanumeric tokens."""

    name: str
    pattern: str
    literals: tuple[str, ...]
    verdict: str = "block"


HOST_RULES = (
    HostRule("net", "/", "block"),
    HostRule("example.net", "/en/", "allow"),
    HostRule("example.com", "/de/", "block"),
    HostRule("org", "/fr/", "allow"),
)
PATTERN_RULES = (
    PatternRule("spam-farm", r"://([^/?#]*[.])?spam-farm[.:/?#]", ("spam", "farm")),
    PatternRule("casino", r"(^|[^A-Za-z0-9])[Cc]asino([^A-Za-z0-9]|$)", ("casino",)),
    PatternRule("session-id", r"[?&]sessionid=", ("sessionid",)),
    PatternRule("java-session-id", r"[?&]jsessionid=", ("jsessionid",)),
    PatternRule("wp-login", r"/wp-login[.]php", ("wp", "login", "php")),
    PatternRule("login-page", r"/login([/?#]|$)", ("login",)),
    PatternRule("signin-page", r"/signin([/?#]|$)", ("signin",)),
    PatternRule("calendar-trap", r"/calendar/[0-9]{4}/[0-9]{2}(/|$)", ("calendar",)),
    PatternRule("printer-view", r"[?&]print=1(&|#|$)", ("print", "1")),
    PatternRule("feed-tracking", r"[?&]utm_source=feed&utm_medium=(ads|popup)(&|#|$)", ("utm", "source", "feed", "medium")),
)
#: Rules an index may hold as a literal in the plan; a longer list is joined as a table.
MAX_RULES = 1000


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    u, rx = F.coalesce(url, F.lit("")), "://([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(u, rx, 1)), F.regexp_extract(u, rx, 2)


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.split(ascii_lower(F.coalesce(url, F.lit(""))), "[^a-z0-9]+"))


def rarest_literals(urls: DataFrame, rules: tuple[PatternRule, ...], col: str = "url") -> dict[str, str]:
    """For each rule with literals, the one that the fewest urls have. One aggregate over the url column; the
    driver gets a row per literal of the rules."""
    lits = sorted({t for r in rules for t in r.literals})
    if not lits:
        return {}
    has = F.array_intersect(url_tokens(F.col(col)), F.array(*map(F.lit, lits)))
    n = dict.fromkeys(lits, 0) | {t: c for t, c in urls.select(F.explode(has).alias("t")).groupBy("t").count().collect()}
    return {r.name: min(r.literals, key=lambda t: (n[t], t)) for r in rules if r.literals}


def _struct(no: int, token: str, r: PatternRule) -> Column:
    return F.struct(F.lit(no).alias("no"), F.lit(token).alias("token"), F.lit(r.pattern).alias("pattern"), F.lit(r.verdict).alias("verdict"))


_TYPE = "array<struct<no:int,token:string,pattern:string,verdict:string>>"


def _clean_names(pages: DataFrame) -> list[str]:
    return [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]


def filter_urls(pages: DataFrame, host_rules=HOST_RULES, pattern_rules=PATTERN_RULES, default: str = "allow", url_col: str = "url", max_rules: int = MAX_RULES) -> DataFrame:
    """pages with host, path, rule (the longest fitting host rule, else null) and verdict; columns of these names, in any
    case, are replaced. A host rule decides; without one, the first fitting pattern rule; without that, ``default``. Rules
    without literals run always. Over ``max_rules`` rules are joined as tables, with the same result."""
    kept = _clean_names(pages)
    packed = pages.select(F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{url_col}`").alias("url"))
    host, path = url_parts(F.col("url"))
    df = packed.withColumns({"host": host, "path": path, "tokens": url_tokens(F.col("url"))})
    if len(host_rules) + len(pattern_rules) > max_rules:
        out = _by_tables(df, host_rules, pattern_rules)
    else:
        out = df.withColumns({"fit": _host_fit(host_rules), "found": _first_pattern(df, pattern_rules)})
    # a pattern runs only where no host rule decides
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.col("fit").isNull(), F.col("found")), F.lit(default))
    return unpack(out, kept, host=F.col("host"), path=F.col("path"), rule=F.col("fit.name"), verdict=verdict)


def _host_fit(host_rules) -> Column:
    """The longest fitting host rule of host and path."""
    if not host_rules:
        return F.lit(None).cast("struct<name:string,verdict:string>")
    return F.coalesce(*[
        F.when(((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path), F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict")))
        for r in sorted(host_rules, key=lambda r: (-len(r.name), r.name))
    ])


def _first_pattern(df: DataFrame, pattern_rules) -> Column:
    """The verdict of the first fitting pattern rule of url, fetched through its tokens."""
    pick = rarest_literals(df.select("url"), pattern_rules)
    size = max(1, 2 * len(pick))
    numbered = list(enumerate(pattern_rules))
    indexed = [(i, r) for i, r in numbered if r.name in pick]
    always = [_struct(i, "", r) for i, r in numbered if r.name not in pick]
    # token hash -> rules: an array of buckets, looked up by position
    slots = df.sparkSession.range(1).select(*[F.pmod(F.xxhash64(F.lit(pick[r.name])), F.lit(size)).alias(f"c{i}") for i, r in indexed]).first() if indexed else ()
    buckets = [F.array(*[_struct(i, pick[r.name], r) for (i, r), at in zip(indexed, slots) if at == b]).cast(_TYPE) for b in range(size)]
    fetched = F.flatten(F.transform(F.col("tokens"), lambda t: F.filter(F.element_at(F.array(*buckets), (F.pmod(F.xxhash64(t), F.lit(size)) + 1).cast("int")), lambda r: r["token"] == t)))
    hits = F.filter(F.concat(F.array(*always).cast(_TYPE), fetched), lambda r: F.rlike(F.coalesce("url", F.lit("")), r["pattern"]))
    return F.array_min(hits)["verdict"]  # the lowest rule number


def _by_tables(df: DataFrame, host_rules, pattern_rules) -> DataFrame:
    """df with fit and found, through joins: the hosts' suffixes with the host rules, the tokens with the pattern rules, each
    rule under its rarest literal."""
    spark = df.sparkSession
    rows = cut(df.withColumn("rid", F.monotonically_increasing_id()))
    labels = F.split("host", "[.]")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    rules = spark.createDataFrame([(r.host, r.path, r.name, r.verdict) for r in {r.name: r for r in reversed(host_rules)}.values()], "host string, prefix string, name string, verdict string")
    fits = rows.select("rid", "path", F.explode(suffixes).alias("host")).join(rules, "host").filter(F.col("path").startswith(F.col("prefix")))
    best = F.struct((-F.length("name")).alias("size"), "name", "verdict")
    fits = fits.groupBy("rid").agg(F.min(best).alias("b")).select("rid", F.struct("b.name", "b.verdict").alias("fit"))
    patterns = spark.createDataFrame([(i, list(r.literals), r.pattern, r.verdict) for i, r in enumerate(pattern_rules)], "no int, literals array<string>, pattern string, verdict string")
    lits = patterns.select("no", F.explode("literals").alias("token"))
    counts = rows.select(F.explode("tokens").alias("token")).join(lits.select("token").distinct(), "token").groupBy("token").count()
    rare = lits.join(counts, "token", "left").groupBy("no").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token")).alias("m")).select("no", "m.token")
    hit = F.rlike(F.coalesce("url", F.lit("")), F.col("pattern"))
    got = rows.select("rid", "url", F.explode("tokens").alias("token")).join(rare, "token").join(patterns.drop("literals"), "no").filter(hit)
    bare = [F.when(F.rlike(F.coalesce("url", F.lit("")), F.lit(r.pattern)), F.struct(F.lit(i).alias("no"), F.lit(r.verdict).alias("verdict"))) for i, r in enumerate(pattern_rules) if not r.literals]
    always = rows.select("rid", F.explode(F.array_compact(F.array(*bare))).alias("f")).select("rid", "f.*") if bare else None
    got = got.select("rid", "no", "verdict")
    first = (got.unionByName(always) if bare else got).groupBy("rid").agg(F.min(F.struct("no", "verdict")).alias("f")).select("rid", F.col("f.verdict").alias("found"))
    return rows.join(fits, "rid", "left").join(first, "rid", "left")


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


_CASES = " ".join(f"WHEN regexp_matches(u, '{r.pattern}') THEN '{r.verdict}'" for r in PATTERN_RULES)
_RULES = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}|{r.verdict}'"
    for r in sorted(HOST_RULES, key=lambda r: (-len(r.name), r.name))
)
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
q AS (SELECT page_id, u, translate(regexp_extract(u, '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(u, '://([^/?#]*)([^?#]*)', 2) AS path FROM p),
r AS (SELECT *, CASE {_RULES} END AS fit FROM q)
SELECT page_id, host, path, split_part(fit, '|', 1) AS rule,
       CASE WHEN fit IS NOT NULL THEN split_part(fit, '|', 2) ELSE CASE {_CASES} ELSE 'allow' END END AS verdict
FROM r
"""
