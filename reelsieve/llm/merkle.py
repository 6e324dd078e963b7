"""Merkle manifest of a table: a leaf for each row, a tree for each group of rows, a tree over the groups' roots, and for
each row the proof that leads from its leaf to the root.

Leaves are range-sorted by group and id. Each partition knows where its rows stand in their groups from the counts of the
partitions before it, and folds every complete aligned subtree that lies inside it. What is left at a partition's ends are
some seven ragged nodes a level; these are shuffled by their coordinate (group, level, place), finished level by level, and
their paths to the root go down the same way. A path comes back to its partition and meets the subtree's leaves there, so
neither a group nor a proof's upper part is ever gathered: per task one subtree is held, and the driver holds nothing.

Rows of one group ascend by id, null first, then by leaf; equal leaves are interchangeable. A null group is a group of
its own, first among them. Rows, null texts and empty texts each make a leaf (a null value is ``-``, an empty one ``0:``);
repeated rows make a leaf each. An empty table has no rows, hence no root. Columns that are not asked for are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsieve.llm.common import ascii_lower, cut

DIGEST = 64
#: Most partitions of the sorted leaves; each gives one row to the broadcast offsets.
MOST_PARTS = 20_000
PROOF = T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("others", T.StringType())]))


def leaf_digest(*values: Column) -> Column:
    """Digest of values, each written as its length in bytes, a colon and itself; null is written as a dash."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""

    def up(node: Column, step: Column) -> Column:
        before = step["at"] * DIGEST
        return F.sha2(F.concat(F.substring(step["others"], F.lit(1), before), node, F.substring(step["others"], before + 1, F.length(step["others"]))), 256)

    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """Digest of all digests of a proof, in order."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: s["others"]), ""), 256)


def _join(run: list[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


def _ordered(leaves: DataFrame, rows_per_part: int) -> DataFrame:
    """row, g, o, leaf -> row, g, leaf, part, i: sorted, with the partition and the place in it."""
    kept = cut(leaves.withColumn("tie", F.monotonically_increasing_id()))  # equal rows are parted by it, so none are a hot key
    n = kept.count()
    asked = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(MOST_PARTS, max(1, -(-n // rows_per_part), min(asked, n // 5000)))
    keys = ["g", "o", "leaf", "tie"]
    placed = kept.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return cut(placed.select("row", "g", "leaf", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("i")))


def _subtrees(fan: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """part, i, g, leaf, base -> g, level, idx, digest, part, i of the complete aligned subtrees that lie in none larger."""
        group, pos, stack, out = None, 0, [], []

        def batch_of(out) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["g", "level", "idx", "digest", "part", "i"])

        for batch in batches:
            for part, i, g, leaf, base in zip(*(c.to_pylist() for c in batch.columns)):
                if g != group:
                    out += stack
                    pos = base or 0 if group is None else 0  # only a partition's first group can begin before it
                    group, stack = g, []
                stack.append((g, 0, pos, leaf, part, i))
                while (top := stack[-1])[2] % fan == fan - 1 and len(stack) >= fan and stack[-fan][1:3] == (top[1], top[2] - fan + 1):
                    run = stack[-fan:]
                    stack[-fan:] = [(g, top[1] + 1, top[2] // fan, _join([x[3] for x in run]), part, run[0][5])]
                pos += 1
            if len(out) > 5000:
                yield batch_of(out)
                out = []
        if out or stack:
            yield batch_of(out + stack)

    return rows


def _grow(ordered: DataFrame, fan: int) -> tuple[list[DataFrame], DataFrame]:
    """The runs of each level (g, n, idx of the parent, kids) above the partitions' subtrees, and the groups' top nodes
    (g, level, digest, part, i; part and i where the top is such a subtree)."""
    counts = cut(ordered.groupBy("part", "g").agg(F.count("g").alias("n")))
    before = F.expr("sum(n) OVER (PARTITION BY g ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    offsets = counts.select("part", before.alias("base")).filter("base > 0")  # a row for each partition at most
    sizes = counts.groupBy("g").agg(F.sum("n").alias("n"))
    inner = ordered.join(F.broadcast(offsets), "part", "left").select("part", "i", "g", "leaf", "base")
    nodes = inner.mapInArrow(_subtrees(fan), "g string, level int, idx long, digest string, part int, i long")
    nodes = cut(nodes.join(sizes, "g"))
    most = sizes.agg(F.max("n")).first()[0] or 0
    kids, tops, made, h = [], [], None, 0
    while True:
        here = nodes.filter(F.col("level") == h).drop("level")
        here = here if made is None else here.unionByName(made)
        tops.append(here.filter(F.col("n") <= fan**h).select("g", F.lit(h).alias("level"), "digest", "part", "i"))
        if most <= fan**h:
            break
        kid = F.struct((F.col("idx") % fan).cast("int").alias("at"), "digest", "part", "i")
        kids.append(cut(here.filter(F.col("n") > fan**h).groupBy("g", "n", F.floor(F.col("idx") / fan).alias("idx")).agg(F.sort_array(F.collect_list(kid)).alias("kids"))))
        none = [F.lit(None).cast("int").alias("part"), F.lit(None).cast("long").alias("i")]
        made = kids[-1].select("g", "n", "idx", F.sha2(F.array_join("kids.digest", ""), 256).alias("digest"), *none)
        h += 1
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    return kids, cut(top)


def _paths(kids: list[DataFrame], tops: DataFrame, fan: int) -> DataFrame:
    """tops with subroot, root and proof (the steps above the top) -> part, i, level, subroot, root, proof of the
    partitions' subtrees."""
    out = ["part", "i", "level", "subroot", "root", "proof"]
    found, below = tops.filter(F.col("part").isNotNull()).select(*out), None
    for h in reversed(range(len(kids))):
        parents = tops.filter(F.col("part").isNull() & (F.col("level") == h + 1)).select("g", F.lit(0).cast("long").alias("idx"), "subroot", "root", "proof")
        parents = parents if below is None else parents.unionByName(below)
        met = kids[h].join(parents, ["g", "idx"]).select("g", "idx", "subroot", "root", "proof", F.col("kids.digest").alias("digests"), F.explode("kids").alias("kid"))
        others = F.array_join(F.filter("digests", lambda d, k: k != F.col("kid.at")), "")
        proof = F.concat(F.array(F.struct(F.col("kid.at").alias("at"), others.alias("others"))), F.col("proof"))
        met = cut(met.select("g", (F.col("idx") * fan + F.col("kid.at")).alias("idx"), F.lit(h).alias("level"), "kid.part", "kid.i", "subroot", "root", proof.alias("proof")))
        found = found.unionByName(met.filter(F.col("part").isNotNull()).select(*out))
        below = met.filter(F.col("part").isNull()).select("g", "idx", "subroot", "root", "proof")
    return found


def _attach(ordered: DataFrame, paths: DataFrame, fan: int) -> DataFrame:
    """row, leaf, subroot, root, proof of each leaf: its partition's subtrees are folded again, beside their paths."""
    kind = ordered.schema["row"].dataType
    new = [("level", "int"), ("subroot", "string"), ("root", "string"), ("proof", PROOF)]
    leaves = ordered.select("part", "i", F.lit(1).alias("kind"), "row", "leaf", *[F.lit(None).cast(t).alias(c) for c, t in new])
    heads = paths.select("part", "i", F.lit(0).alias("kind"), F.lit(None).cast(kind).alias("row"), F.lit(None).cast("string").alias("leaf"), *[c for c, _ in new])
    both = leaves.unionByName(heads).repartitionById(max(1, ordered.rdd.getNumPartitions()), "part").sortWithinPartitions("part", "i", "kind")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ready, block, head = [], [], [], None  # rows of leaves, their results, the leaves of the open subtree, its path

        def flush() -> pa.RecordBatch:
            nonlocal held, ready
            whole = pa.concat_arrays(held)
            n, counts = len(ready), [0]
            for r in ready:
                counts.append(counts[-1] + len(r[3]))
            steps = [s for r in ready for s in r[3]]
            items = pa.StructArray.from_arrays([pa.array([s[0] for s in steps], pa.int32()), pa.array([s[1] for s in steps], pa.string())], ["at", "others"])
            arrays = [whole.slice(0, n), *(pa.array([r[k] for r in ready], pa.string()) for k in range(3)), pa.ListArray.from_arrays(pa.array(counts, pa.int32()), items)]
            held, ready = [whole.slice(n)], []
            return pa.RecordBatch.from_arrays(arrays, ["row", "leaf", "subroot", "root", "proof"])

        def close() -> Iterator[pa.RecordBatch]:
            level, subroot, root, proof = head
            above = [(s["at"], s["others"]) for s in proof]
            nodes, others = block, []
            for _ in range(level):
                runs = ["".join(nodes[j : j + fan]) for j in range(0, len(nodes), fan)]
                others.append([s[: DIGEST * k] + s[DIGEST * (k + 1) :] for s in runs for k in range(fan)])
                nodes = [_join([s]) for s in runs]
            for x, leaf in enumerate(block):
                steps = []
                for there in others:
                    steps.append((x % fan, there[x]))
                    x //= fan
                ready.append((leaf, subroot, root, steps + above))
                if len(ready) >= 2000:
                    yield flush()

        for batch in batches:
            held.append(batch.column("row").filter(batch.column("leaf").is_valid()))
            level, leaf = batch.column("level").to_pylist(), batch.column("leaf").to_pylist()
            for k in range(batch.num_rows):
                if leaf[k] is None:
                    head, block = (level[k], *(batch.column(c)[k].as_py() for c in ("subroot", "root", "proof"))), []
                    continue
                block.append(leaf[k])
                if len(block) == fan ** head[0]:
                    yield from close()
        if ready:
            yield flush()

    schema = T.StructType([T.StructField("row", kind), *[T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root")], T.StructField("proof", PROOF)])
    return both.select("row", "leaf", "level", "subroot", "root", "proof").mapInArrow(rows, schema)


def manifest(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), group_col: str = "lang", id_col: str = "doc_id", keep: tuple[str, ...] = ("doc_id", "lang"), fan: int = 8, rows_per_part: int = 100_000) -> DataFrame:
    """The columns in keep (but for those named like new ones), leaf, subroot (its group's), root, proof: for each level up to the
    root the node's place in its run (``at``) and the run's other digests, one after another (``others``)."""
    keep = tuple(c for c in keep if c.lower() not in ("leaf", "subroot", "root", "proof"))
    kept = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`") for c in keep])
    # a null group is '', before all others
    group = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit(""))
    leaves = docs.select(kept.alias("row"), group.alias("g"), F.col(f"`{id_col}`").alias("o"), leaf_digest(*[F.col(f"`{c}`") for c in columns]).alias("leaf"))
    ordered = _ordered(leaves, rows_per_part)
    kids, tops = _grow(ordered, fan)
    # the groups' roots are the leaves of one more tree
    above = _ordered(tops.select(F.struct("g", "level", "part", "i").alias("row"), F.lit("").alias("g"), F.col("g").alias("o"), F.col("digest").alias("leaf")), rows_per_part)
    over, last = _grow(above, fan)
    ends = last.select("g", "level", "part", "i", F.col("digest").alias("subroot"), F.col("digest").alias("root"), F.array().cast(PROOF).alias("proof"))
    roots = _attach(above, _paths(over, ends, fan), fan).select("row.*", F.col("leaf").alias("subroot"), "root", "proof")
    out = _attach(ordered, _paths(kids, cut(roots), fan), fan)
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], "leaf", "subroot", "root", "proof")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0  # a null id is not tampered with
    tampered = F.when(hit, leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], ascii_lower(F.col("text"))))
    proofs = manifest(docs.withColumn("tampered", tampered), keep=("doc_id", "tampered"))
    folded = proofs.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), fold(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


_COLUMNS = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars"))
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [256 + ascii(c)::BIGINT, 1, 1, 1, 1, 1, 1, 1, 1]))), lambda a, b: CASE WHEN b > 1 THEN xor(a, b - 256) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"
ORACLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, sha256({_COLUMNS} || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
  CASE WHEN {_CRC} % 3 = 0 THEN sha256({_COLUMNS} || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d),
a(lang, level, idx, n, digest) AS (SELECT lang, 0, pos, n, leaf FROM p
  UNION ALL SELECT lang, level + 1, idx // 8, any_value(n), sha256(string_agg(digest, '' ORDER BY idx)) FROM a WHERE n > 8 ** level GROUP BY lang, level, idx // 8),
s AS (SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM a WHERE idx = 0 AND n <= 8 ** level),
b(level, idx, n, digest) AS (SELECT 0, pos, n, subroot FROM s
  UNION ALL SELECT level + 1, idx // 8, any_value(n), sha256(string_agg(digest, '' ORDER BY idx)) FROM b WHERE n > 8 ** level GROUP BY level, idx // 8),
r AS (SELECT digest AS root FROM b WHERE idx = 0 AND n <= 8 ** level),
ra AS (SELECT lang, level, idx // 8 AS up, list(digest ORDER BY idx) AS run FROM a WHERE n > 8 ** level GROUP BY ALL),
rb AS (SELECT level, idx // 8 AS up, list(digest ORDER BY idx) AS run FROM b WHERE n > 8 ** level GROUP BY ALL),
steps AS (SELECT p.doc_id, ra.level AS step, (pos // (8 ** level)::BIGINT % 8)::BIGINT AS k, run FROM p JOIN ra ON p.lang IS NOT DISTINCT FROM ra.lang AND pos // (8 ** (level + 1))::BIGINT = up
  UNION ALL SELECT p.doc_id, 1000 + rb.level, (s.pos // (8 ** level)::BIGINT % 8)::BIGINT, run FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang JOIN rb ON s.pos // (8 ** (level + 1))::BIGINT = up),
proofs AS (SELECT doc_id, string_agg(array_to_string(list_slice(run, 1, k), '') || array_to_string(list_slice(run, k + 2, len(run)), ''), '' ORDER BY step) AS others,
  list({{'l': array_to_string(list_slice(run, 1, k), ''), 'r': array_to_string(list_slice(run, k + 2, len(run)), '')}} ORDER BY step) AS path FROM steps GROUP BY doc_id),
f AS (SELECT p.doc_id, leaf, subroot, root, sha256(coalesce(others, '')) AS proof_sha256,
  CASE WHEN path IS NULL THEN coalesce(tampered, leaf) ELSE list_reduce(list_prepend({{'l': coalesce(tampered, leaf), 'r': ''}}, path), lambda x, y: {{'l': sha256(y.l || x.l || y.r), 'r': ''}}).l END AS folded_root
  FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang CROSS JOIN r LEFT JOIN proofs USING (doc_id))
SELECT *, folded_root = root AS verified FROM f
"""
