"""Document fingerprints of improbable features: rare byte windows, kept in a chain of Bloom filters.

Every window of 64 bytes has an entropy, in thousandths of the largest. How often each of these levels occurs in all
windows of all documents is counted once; the rarer the level, the better its rank. A window is chosen where it has the
best rank (the leftmost one) in at least 16 of the runs of 64 neighbouring windows that hold it. Chosen windows, equal
ones once, go through five hashes of 11 bits into Bloom filters of 2,048 bits with 160 windows each. Two fingerprints
are compared filter by filter: common bits beyond what chance gives, over the most that could be common. Each filter
of the one with fewer windows takes its best counterpart, and these are averaged by their windows.

Null text is empty and has an empty fingerprint; a shorter text than a window is one feature, and a text in which no
window is chosen takes its most popular one. Two empty fingerprints are alike by 1, an empty and another one by 0. Texts
of any length are worked on in blocks of bytes; long ones have as many filters as they need.

``compare_edits`` pairs each document with the next one by falling id (null ids last; equal ids by a hash of the text; after
the last comes the first). Rows of equal id and text follow each other. Rows are dealt out to blocks of some megabytes whose bounds come from
the sorted ids alone, so the texts are shuffled once. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsieve.llm.common import NO_ID, cut, small, text_key

WINDOW = 64
LEVELS = 1000
#: Levels that say too little: near-constant windows, and (compressed or random) windows with hardly a byte twice.
LOWEST, HIGHEST = 100, 990
POPULAR = 16
BITS, HASHES, PER_FILTER = 2048, 5, 160
#: Of the span between chance and the most that can be common, what doesn't count yet.
CUTOFF = 0.3
#: Bytes that are worked on at once: they stay in a core's cache.
BLOCK = 1 << 17
NO_RANK = 1 << 20
#: Most blocks of documents; each gives one bound to every task.
MOST_BLOCKS = 20_000


@cache
def _gains():
    """What the entropy of a window gains by one more byte, if it holds c of its kind: whole numbers that add up exactly."""
    import numpy as np

    c = np.arange(1, WINDOW + 1) / WINDOW
    parts = np.concatenate([[0], np.rint(-c * np.log2(c) * 2.0**40)]).astype(np.int64)
    return np.diff(parts)


def levels(b):
    """Entropy level of each window of an array of bytes."""
    import numpy as np

    out = np.empty(max(0, len(b) - WINDOW + 1), np.int16)
    gain, most = _gains(), np.log2(WINDOW) * 2.0**40
    for at in range(0, len(out), BLOCK):
        x = b[at : at + BLOCK + WINDOW - 1]
        before, after = np.zeros(len(x), np.uint8), np.zeros(len(x), np.uint8)  # equal bytes among the 63 on either side
        for k in range(1, WINDOW):
            same = (x[k:] == x[:-k]).view(np.uint8)
            before[k:] += same
            after[:-k] += same
        added = gain[before]
        whole = np.empty(len(x) - WINDOW + 1, np.int64)
        whole[0] = added[:WINDOW].sum()
        np.cumsum(added[WINDOW:] - gain[after[: len(whole) - 1]], out=whole[1:])
        whole[1:] += whole[0]
        out[at : at + BLOCK] = np.minimum(np.maximum(whole, 0) * (LEVELS / most), LEVELS)
    return out


def _starts(raw: list[bytes]):
    import numpy as np

    return np.concatenate([[0], np.cumsum([len(r) for r in raw])])


def level_counts(raw: list[bytes]):
    """How often each level occurs in the windows of the texts."""
    import numpy as np

    at, joined = _starts(raw), np.frombuffer(b"".join(raw), np.uint8)
    found = levels(joined)
    inside = np.zeros(len(found), bool)  # not across two texts
    for a, z in zip(at[:-1], at[1:]):
        if z - a >= WINDOW:
            inside[a : z - WINDOW + 1] = True
    return np.bincount(found[inside], minlength=LEVELS + 1)


def rank_levels(counts) -> list[int]:
    """A rank for each level from how often it occurs, 0 for the rarest; NO_RANK for levels never to be chosen."""
    order = sorted(range(LOWEST, HIGHEST + 1), key=lambda e: (counts[e], e))
    ranks = [NO_RANK] * (LEVELS + 1)
    for r, e in enumerate(order):
        ranks[e] = r
    return ranks


def features(raw: list[bytes], ranks) -> list[list[bytes]]:
    """The chosen windows of each text, equal ones once, in order."""
    import numpy as np

    at, whole = _starts(raw), b"".join(raw)
    found = np.asarray(ranks, np.int64)[levels(np.frombuffer(whole, np.uint8))]
    out: list[list[bytes]] = [[] for _ in raw]
    runs = np.zeros(len(found), bool)
    for a, z in zip(at[:-1], at[1:]):
        if z - a >= 2 * WINDOW - 1:
            runs[a : z - 2 * WINDOW + 2] = True
    best = (found << 32) | np.arange(len(found))
    for k in (1, 2, 4, 8, 16, 32):  # the least of 64 in a row, by doubling
        best = np.minimum(best[:-k], best[k:]) if len(best) > k else best[:0]
    popular = np.bincount(best[runs[: len(best)]] & 0xFFFFFFFF, minlength=len(found))
    chosen = np.flatnonzero((popular >= POPULAR) & (found < NO_RANK))
    ends = np.searchsorted(chosen, at)
    for d, text in enumerate(raw):
        mine = [whole[s : s + WINDOW] for s in chosen[ends[d] : ends[d + 1]].tolist()]
        if not mine and text:
            a, z = int(at[d]), int(at[d + 1]) - WINDOW + 1
            if z > a:  # the most popular window, or of few neighbours the best one
                s = a + int(np.argmax(popular[a:z]) if popular[a:z].any() else np.argmin(found[a:z]))
                mine = [whole[s : s + WINDOW]]
            else:
                mine = [text]
        out[d] = list(dict.fromkeys(mine))
    return out


def filters(windows: list[list[bytes]]) -> list[tuple]:
    """For each text the windows in each of its filters, and the filters as rows of 64-bit numbers."""
    import numpy as np

    sizes = [-(-len(w) // PER_FILTER) for w in windows]
    first = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
    bits = np.zeros((int(first[-1]), BITS), np.uint8)
    if len(bits):
        digests = np.frombuffer(b"".join(hashlib.sha1(x).digest() for w in windows for x in w), "<u4").reshape(-1, HASHES) & (BITS - 1)
        rows = np.concatenate([first[d] + np.arange(len(w)) // PER_FILTER for d, w in enumerate(windows)]).astype(int)
        bits[rows[:, None], digests] = 1
    packed = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    return [([min(PER_FILTER, len(w) - PER_FILTER * k) for k in range(sizes[d])], packed[first[d] : first[d + 1]]) for d, w in enumerate(windows)]


def prints(texts: list[str], ranks) -> list[tuple]:
    """Fingerprints of texts; neighbours are worked on together, some BLOCK bytes at a time."""
    out, part, size = [], [], 0
    for t in texts:
        part.append(t.encode())
        size += len(part[-1])
        if size >= BLOCK:
            out += filters(features(part, ranks))
            part, size = [], 0
    return out + filters(features(part, ranks)) if part else out


def write_print(fp: tuple) -> str:
    """A fingerprint as text: of each filter the number of its windows and its bits in base 64."""
    return ",".join(f"{n}:{base64.b64encode(row.tobytes()).decode()}" for n, row in zip(*fp))


def read_print(text: str) -> tuple:
    import numpy as np

    parts = [p.split(":") for p in text.split(",")] if text else []
    rows = np.frombuffer(b"".join(base64.b64decode(b) for _, b in parts), "<u8").reshape(-1, BITS // 64)
    return [int(n) for n, _ in parts], rows


def likeness(a: tuple, b: tuple) -> float:
    """How alike two fingerprints are, from 0 to 1."""
    import numpy as np

    if not a[0] or not b[0]:
        return float(len(a[0]) == len(b[0]))

    def found(x: tuple, y: tuple) -> float:
        ones = np.bitwise_count(y[1]).sum(1, dtype=np.int64)
        total = 0.0
        for n, row in zip(*x):  # one filter against all others at a time
            mine = int(np.bitwise_count(row).sum())
            common = np.bitwise_count(y[1] & row).sum(1, dtype=np.int64)
            most, chance = np.minimum(ones, mine), ones * mine / BITS
            least = chance + CUTOFF * (most - chance)
            total += n * max(0.0, float(((common - least) / np.maximum(most - least, 1e-9)).max()))
        return total / sum(x[0])

    na, nb = sum(a[0]), sum(b[0])
    if na != nb:
        return found(a, b) if na < nb else found(b, a)
    return (found(a, b) + found(b, a)) / 2


def entropy_ranks(docs: DataFrame, text_col: str = "text") -> list[int]:
    """Ranks of the levels by how rare they are in all of docs; 1,001 counts meet on the driver."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        counts = np.zeros(LEVELS + 1, np.int64)
        for batch in batches:
            part, size = [], 0
            for t in batch.column(0):
                part.append(t.as_buffer().to_pybytes() if t.is_valid else b"")
                size += len(part[-1])
                if size >= BLOCK:
                    counts += level_counts(part)
                    part, size = [], 0
            counts += level_counts(part)
        kept = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int32()), pa.array(counts[kept], pa.int64())], ["level", "n"])

    counts = dict(docs.select(F.col(f"`{text_col}`")).mapInArrow(rows, "level int, n long").groupBy("level").agg(F.sum("n")).collect())
    return rank_levels([counts.get(e, 0) for e in range(LEVELS + 1)])


def fingerprints(docs: DataFrame, ranks: list[int], text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """docs with a fingerprint column, in place of one of that name."""
    print_of = F.pandas_udf(lambda s: s.map(lambda t: write_print(prints([t or ""], ranks)[0])), "string")
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()], print_of(F.col(f"`{text_col}`")).alias(out))


def _bounds(keys: DataFrame, block_bytes: int) -> list[tuple]:
    """First keys (~id, t1, t2) of the blocks that the sorted rows make."""
    n, total = keys.agg(F.count("o"), F.sum("size")).first()
    most = max(block_bytes, (total or 0) // MOST_BLOCKS)
    parts = max(1, min(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_BLOCKS, n))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = most
        for batch in batches:
            first = []
            for k, size in enumerate(batch.column(3).to_pylist()):
                if held >= most:
                    first.append(k)
                    held = 0
                held += size
            yield batch.select(["o", "t1", "t2"]).take(pa.array(first, pa.int64()))

    order = ["o", "t1", "t2"]
    placed = keys.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(*order, "size")
    return sorted(tuple(r) for r in placed.mapInArrow(rows, "o long, t1 long, t2 long").collect())


def _block_of(bounds: list[tuple]):
    """Twice the block of a key, and one more for the first key of a block."""
    lead = [b[0] for b in bounds]

    def place(o, t1, t2):
        import numpy as np
        import pandas as pd

        lead_of = np.array(lead)
        at = np.searchsorted(lead_of, o.to_numpy(), "left")
        past = np.searchsorted(lead_of, o.to_numpy(), "right")
        out = 2 * (at - 1)
        for k in np.flatnonzero(at < past):  # ids that a block begins with
            key = (int(o[k]), int(t1[k]), int(t2[k]))
            i = bisect_right(bounds, key)
            out[k] = 2 * (i - 1) + (bounds[i - 1] == key)
        return pd.Series(out)

    return F.pandas_udf(place, "long")


_EDITS = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, copies long"


def _edits(ranks: list[int], share: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """id, text, m, extra in order; a row's next is the one behind it. The last one is another block's first."""
        before = None

        def of(part: list[tuple]) -> pa.RecordBatch | None:
            nonlocal before
            fps = prints([t for _, t, _ in part], ranks)
            line = [*([before] if before else []), *((*p, fp) for p, fp in zip(part, fps))]
            pairs = [p for a, b in zip(line, line[1:]) for p in ([(a, a, a[2] - 1)] if a[2] > 1 else []) + [(a, b, 1)]]
            before = line[-1]
            edited = [a[1][: len(a[1]) - len(a[1]) // share] + b[1][: len(a[1]) // share] for a, b, _ in pairs]
            made = prints(edited, ranks)
            out = [(a[0], len(a[1]), hashlib.sha256(e.encode()).hexdigest(), write_print(a[3]), write_print(fe), likeness(a[3], fe), likeness(a[3], b[3]), n) for (a, b, n), e, fe in zip(pairs, edited, made)]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
            names = [x.split()[0] for x in _EDITS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names) if out else None

        for batch in batches:
            part, size = [], 0
            for i, t, m in zip(batch.column(0), batch.column(1), batch.column(2)):
                part.append((i.as_py(), t.as_py() or "", m.as_py()))
                size += len(part[-1][1])
                if size >= 1 << 20:
                    if made := of(part):
                        yield made
                    part, size = [], 0
            if part and (made := of(part)):
                yield made

    return rows


def compare_edits(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", ranks: list[int] | None = None, share: int = 3, block_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: each text and its edited
    text, in which the start of the next document replaces the last 1 / share of the characters."""
    text = F.col(f"`{text_col}`")
    ranks = ranks or entropy_ranks(docs, text_col)
    key = F.bitwise_not(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))).alias("o")  # ascends where ids fall
    keys = cut(docs.select(key, *text_key(f"`{text_col}`"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("size")))
    held = keys.groupBy("o", "t1", "t2").agg(F.count("o").alias("m"), F.first("size").alias("size"))
    repeats = cut(held.filter("m > 1").select("o", "t1", "t2", "m"))
    bounds = _bounds(held.select("o", "t1", "t2", "size"), block_bytes)
    rows = docs.select(key, *text_key(f"`{text_col}`"), F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    again = repeats.count() > 0
    if again:  # repeated rows are gathered where they are read, and counted
        few, _ = small(repeats, 100_000)
        met = rows.join(few, ["o", "t1", "t2"], "left")
        one = met.filter("m IS NOT NULL").groupBy("o", "t1", "t2", "m").agg(F.first("id").alias("id"), F.first("text").alias("text"))
        rows = met.filter("m IS NULL").select("o", "t1", "t2", "id", "text", F.lit(1).cast("long").alias("m")).unionByName(one)
    else:
        rows = rows.withColumn("m", F.lit(1).cast("long"))
    n = max(1, len(bounds))
    code = _block_of(bounds)("o", "t1", "t2")
    placed = rows.select("*", code.alias("code")).withColumn("block", F.floor(F.col("code") / 2).cast("int"))
    home = F.struct(F.col("block").alias("to"), F.lit(0).alias("extra"))
    ahead = F.struct(F.pmod(F.col("block") - 1, F.lit(n)).cast("int").alias("to"), F.lit(1).alias("extra"))
    dealt = placed.select("o", "t1", "t2", "id", "text", "m", F.explode(F.when(F.col("code") % 2 == 1, F.array(home, ahead)).otherwise(F.array(home))).alias("place"))
    dealt = dealt.select("*", "place.*").repartitionById(n, F.col("to")).sortWithinPartitions("extra", "o", "t1", "t2")
    made = dealt.select("id", "text", "m").mapInArrow(_edits(ranks, share), _EDITS)
    if again:
        many = F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / 10_000))
        made = made.select("*", F.explode(many).alias("k")).repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        made = made.select("*", F.explode(F.sequence(F.lit(1), F.least(F.lit(10_000), F.col("copies") - 10_000 * F.col("k")))))
    return made.select(F.col("id").alias("doc_id"), *[x.split()[0] for x in _EDITS.split(", ")[1:-1]])


def query(spark, sf_dir: str) -> DataFrame:
    return compare_edits(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
