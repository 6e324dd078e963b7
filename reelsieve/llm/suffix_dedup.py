"""Suffix-array deduplication: remove every byte covered by a string of a given length that starts anywhere else too.

A suffix array of all text is too much for one task, so suffixes are dealt out by content. A string's anchor is the least
hashed 32-byte gram in it (the first of equal ones): copies have it at the same place. The strings of one anchor stand
side by side; the text they cover is their span. Only spans whose gram is some other span's too go on, and spans that are
equal as a whole are one with a count. A gram can still have any number of different spans, so each is cut into parts of
32 strings, which share a core of 369 bytes; parts with a core of their own are done, and equal parts are one with a count.
The different parts of a core meet in one task. Their bytes before and after the core, with the core as one symbol, are
sorted into a suffix array by linear grouping (``suffix_array.py``), and a string is repeated if its suffix has all its
symbols in common with a neighbour. A core with over ``most`` different parts is dealt out by longer cores first (397 bytes,
then whole strings); no group is ever dropped or cut short. Grams, spans, cores and parts are compared by 64-bit
hashes, which the next step adds to; the bytes around a core are compared themselves.

Strings are judged on the input. Null text is empty; texts shorter than the length lose nothing. Rows with equal ids and
texts are copies of each other and both lose what repeats; so do repeated strings inside one text, overlapping ones too.
Other columns pass through. Very long texts are scanned in overlapping pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsieve.llm.common import HOT_PARTS, cut, doc_key, join_spread, pack, text_key, unpack
from reelsieve.llm.suffix_array import common_prefixes, suffix_array

GRAM = 32
#: Strings of a part, at first and when dealt out further.
WIDTHS = (32, 4, 1)
#: Bytes scanned at once; memory is about 100 times this.
PIECE = 1 << 17
_POS = (1 << 31) - 1


@cache
def _tables(n: int):
    """Random values of bytes, and powers of an odd base with their inverses, for rolling hashes modulo 2 ** 64."""
    import numpy as np

    values = np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64)
    base = 0x9E3779B97F4A7C15
    power, inverse = np.full(n + 1, base, np.uint64), np.full(n + 1, pow(base, -1, 2**64), np.uint64)
    power[0] = inverse[0] = 1
    return values, np.cumprod(power), np.cumprod(inverse)


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Hashes:
    """Hashes of any stretch of some bytes, the same wherever it stands."""

    def __init__(self, data: bytes):
        import numpy as np

        n = len(data)
        size = 4 * PIECE
        while size < n:
            size *= 2
        values, power, self.inverse = _tables(size)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[np.frombuffer(data, np.uint8)] * power[:n], out=self.sums[1:])

    def of(self, lo, hi):
        import numpy as np

        return _mix((self.sums[hi] - self.sums[lo]) * self.inverse[lo] + np.asarray(hi - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def spans(data: bytes, ends: list[int], length: int):
    """Arrays over the spans of concatenated texts: text number, first string's start in data, strings, anchor's place
    in the span, hash of the anchor's gram, hash of the span."""
    import numpy as np

    ends_ = np.asarray(ends, np.int64)
    begins = np.concatenate([np.zeros(1, np.int64), ends_[:-1]])
    counts = np.maximum(ends_ - begins - length + 1, 0)
    doc = np.repeat(np.arange(len(ends)), counts)
    if not len(doc):
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2
    h = Hashes(data)
    start = np.arange(len(data) - GRAM + 1)
    low = (h.of(start, start + GRAM) & np.uint64(2**64 - 1 - _POS)) | start.astype(np.uint64)  # the first of equal ones
    size, window = 1, length - GRAM + 1
    while size * 2 <= window:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < window:
        low = np.minimum(low[: len(low) - (window - size)], low[window - size :])
    at = np.arange(len(doc)) + np.repeat(begins - np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)[:-1]]), counts)
    anchor = (low[at] & np.uint64(_POS)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]))
    count = np.diff(np.concatenate([new, [len(at)]]))
    first, a = at[new], anchor[new]
    key = _mix(h.of(a, a + GRAM) ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    whole = _mix(h.of(first, first + count + length - 1) + (a - first).astype(np.uint64))
    return doc[new], first, count, a - first, key, whole


def _scan(keyed: DataFrame, length: int) -> DataFrame:
    """rid (a number of the row), did, t1, t2 and, as arrays, key, span, at, n, off of its spans; at: of a span's first
    string in the text. A very long text gives several rows of one rid."""
    names = ["rid", "did", "t1", "t2", "keys", "spans", "ats", "ns", "offs"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def flush(held: list) -> pa.RecordBatch:
            doc, first, n, off, key, whole = spans(b"".join(x[0] for x in held), np.cumsum([len(x[0]) for x in held]), length)
            begin = np.cumsum([0, *(len(x[0]) for x in held)])[:-1]
            at = first - begin[doc] + np.array([x[1] for x in held], np.int64)[doc]
            offsets = pa.array(np.r_[0, np.cumsum(np.bincount(doc, minlength=len(held)))].astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (key.view(np.int64), whole.view(np.int64), at.astype(np.int32), n.astype(np.int32), off.astype(np.int32))]
            return pa.RecordBatch.from_arrays([*(pa.array([x[i] for x in held], pa.int64()) for i in (2, 3, 4, 5)), *lists], names)

        held, size, rid = [], 0, TaskContext.get().partitionId() << 36
        for batch in batches:
            for did, t1, t2, text in zip(*(c.to_pylist() for c in batch.columns)):
                rid += 1
                for base in range(0, max(0, len(text) - length + 1), PIECE):
                    piece = text[base : base + PIECE + length - 1]
                    held.append((piece, base, rid, did, t1, t2))
                    size += len(piece)
                    if size >= PIECE:
                        yield flush(held)
                        held, size = [], 0
        if held:
            yield flush(held)

    return keyed.select("did", "t1", "t2", "text").mapInArrow(rows, "rid long, did long, t1 long, t2 long, keys array<long>, spans array<long>, ats array<int>, ns array<int>, offs array<int>")


#: A part: the strings at + 0, 1, ... of row rid that have the core; left and right are the bytes around it.
_PART = "core long, part long, rid long, at int, strings int, left binary, right binary, single boolean"
_NAMES = [c.split()[0] for c in _PART.split(", ")]


def _binary(data, lo, hi) -> pa.Array:
    """data[lo:hi] of each row."""
    import numpy as np

    size = hi - lo
    ends = np.r_[0, np.cumsum(size)]
    at = np.arange(ends[-1]) - np.repeat(ends[:-1] - lo, size)
    return pa.Array.from_buffers(pa.binary(), len(lo), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[at])])


def first_parts(key, rid, at, n, off, single, texts: list[bytes], length: int, width: int) -> pa.RecordBatch:
    """The parts of spans. A string whose anchor stands e bytes from its start belongs to part e // width of its span;
    all strings of a part share its core of length - width + 1 bytes."""
    import numpy as np

    data = b"".join(texts)
    h, flat = Hashes(data), np.frombuffer(data, np.uint8)
    begin = np.cumsum([0, *map(len, texts)])[:-1].astype(np.int64)
    low, high = (off - n + 1) // width, off // width
    count = high - low + 1
    row = np.repeat(np.arange(len(n)), count)
    k = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    core = (begin + off)[row] - k * width
    lo, hi = np.maximum(core - width + 1, begin[row]), np.minimum(core, (begin + n - 1)[row])
    end = core + length - width + 1
    keys = _mix(h.of(core, end) ^ key[row].view(np.uint64) ^ k.astype(np.uint64))
    part = _mix(h.of(lo, hi + length) ^ keys ^ (core - lo).astype(np.uint64))
    cols = [keys.view(np.int64), part.view(np.int64), rid[row], (at[row] + lo - begin[row]).astype(np.int32), (hi - lo + 1).astype(np.int32)]
    return pa.RecordBatch.from_arrays([*map(pa.array, cols), _binary(flat, lo, core), _binary(flat, end, hi + length), pa.array(single[row])], _NAMES)


def finer_parts(core: int, rid: int, at: int, strings: int, left: bytes, right: bytes, single: bool, width: int, finer: int) -> Iterator[tuple]:
    """The parts of a part, with cores of width - finer more bytes."""
    a = len(left)
    for q in range((a - strings + 1) // finer, a // finer + 1):
        near, far = max(q * finer, a - strings + 1), min(q * finer + finer - 1, a)  # bytes before the core of the last and the first string
        more = (left[a - q * finer :], right[: width - (q + 1) * finer])
        outer = (left[a - far : a - q * finer], right[width - (q + 1) * finer : width - 1 - near])
        inner = xxhash.xxh64_intdigest(b"%d:" % len(more[0]) + more[0] + more[1], core & (2**64 - 1))
        part = xxhash.xxh64_intdigest(b"%d:" % len(outer[0]) + outer[0] + outer[1], inner)
        yield _signed(inner), _signed(part), rid, at + a - far, far - near + 1, *outer, single


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _parts(members: DataFrame, length: int, width: int) -> DataFrame:
    """members: rid, key, at, n, off, single, bytes (of the span)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                b = batch.slice(lo, 512)
                rid, key, at, n, off = (b.column(i).to_numpy().astype(np.int64) for i in range(5))
                yield first_parts(key, rid, at, n, off, b.column(5).to_numpy(zero_copy_only=False), b.column(6).to_pylist(), length, width)

    return members.select("rid", "key", "at", "n", "off", "single", "bytes").mapInArrow(rows, _PART)


def _finer(parts: DataFrame, width: int, finer: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [x for r in zip(*(c.to_pylist() for c in batch.columns)) for x in finer_parts(*r, width, finer)]
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], _NAMES)

    return parts.select("core", "rid", "at", "strings", "left", "right", "single").mapInArrow(rows, _PART)


def matches(members: list[tuple], width: int) -> list[tuple[int, int, int]]:
    """members: (core, strings, left, right). (member, first string, strings) of each run of strings that another member
    has too: suffixes that have ``width`` symbols, the core among them, in common with a neighbour in the suffix array."""
    text: list[int] = []
    begins = []
    cores: dict[int, int] = {}
    for core, _, left, right in members:
        begins.append(len(text))
        text += [b + 1 for b in left]
        text.append(257 + cores.setdefault(core, len(cores)))  # the core is one symbol
        text += [b + 1 for b in right]
        text.append(0)
    order = suffix_array(text)
    common = common_prefixes(text, order)
    again = bytearray(len(text))
    for k in range(1, len(order)):
        if common[k] >= width:
            again[order[k - 1]] = again[order[k]] = 1
    out = []
    for m, (_, strings, _, _) in enumerate(members):
        i, hits = 0, again[begins[m] : begins[m] + strings]
        while (i := hits.find(1, i)) >= 0:
            j = hits.find(0, i)
            j = strings if j < 0 else j
            out.append((m, i, j - i))
            i = j
    return out


def _sorted_groups(kinds: DataFrame, length: int, width: int, batch_rows: int = 2048) -> DataFrame:
    """rid, lo, hi: repeated stretches of parts that stand once, by suffix arrays over whole cores."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list) -> pa.RecordBatch:
            found = [(held[m][4], held[m][5] + i, held[m][5] + i + run + length - 1) for m, i, run in matches([r[:4] for r in held], width) if held[m][6]]
            cols = zip(*found) if found else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32()))], ["rid", "lo", "hi"])

        held: list[tuple] = []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= batch_rows and held[-1][0] != r[0]:
                    yield flush(held)
                    held = []
                held.append(r)
        if held:
            yield flush(held)

    cols = kinds.select("core", "strings", "left", "right", "rid", "at", "single")
    return cols.repartition("core").sortWithinPartitions("core").mapInArrow(rows, "rid long, lo int, hi int")


def _counted(rows: DataFrame, counts: DataFrame, keys: list[str], salt: str) -> DataFrame:
    """rows with n from counts (keys, n) where they have one; rows of keys with very many are dealt out."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    return join_spread(rows, counts, keys, counts.filter(F.col("n") > total / HOT_PARTS), [F.col(salt)]).filter("n IS NOT NULL")


def repeated(keyed: DataFrame, length: int = 400, most: int = 2048) -> DataFrame:
    """keyed: did, t1, t2, text (binary). did, t1, t2, cuts (array of lo, hi): bytes covered by repeated strings. most:
    kinds of parts in a suffix array; cores with more are dealt out by longer cores."""
    scanned = cut(_scan(keyed, length))
    one = scanned.select("rid", F.explode(F.arrays_zip("keys", "spans", "ats", "ns", "offs")).alias("s"))
    rows = one.select("rid", F.col("s.keys").alias("key"), F.col("s.spans").alias("span"), F.col("s.ats").alias("at"), F.col("s.ns").alias("n_strings"), F.col("s.offs").alias("off"))
    often = cut(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    hits = cut(_counted(rows, often, ["key"], "rid").drop("n"))
    kinds = cut(hits.groupBy("key", "span").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("rid", "at", "n_strings", "off")).alias("one")))
    copied = kinds.filter("copies > 1").select("key", "span", F.col("copies").alias("n"))
    whole = _counted(hits, copied, ["key", "span"], "rid").select("rid", F.col("at").alias("lo"), (F.col("at") + F.col("n_strings") + (length - 1)).alias("hi"))
    found = [cut(whole)]
    mixed = cut(kinds.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    open_ = _counted(kinds, mixed, ["key"], "span").select("key", (F.col("copies") == 1).alias("single"), "one.*")
    ids = scanned.select("rid", "did", "t1", "t2").distinct()
    lists = open_.join(ids, "rid").groupBy("did", "t1", "t2").agg(F.collect_list(F.struct("rid", "key", "at", F.col("n_strings").alias("n"), "off", "single")).alias("spans"))
    members = keyed.join(lists, ["did", "t1", "t2"]).select("text", F.explode("spans").alias("s"))
    members = members.select("s.*", F.expr(f"substring(text, s.at + 1, s.n + {length - 1})").alias("bytes"))
    widths = [w for w in WIDTHS if w < length]
    parts = _parts(members, length, widths[0])
    for width, finer in zip(widths, [*widths[1:], None]):
        parts = cut(parts)
        by_core = parts.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        parts = cut(_counted(parts, cut(by_core), ["core"], "rid").drop("n"))
        first = F.min(F.struct("rid", "at", "strings", "left", "right", "single")).alias("one")
        kinds = cut(parts.groupBy("core", "part").agg(F.count(F.lit(1)).alias("n"), first))
        copied = kinds.filter("n > 1").select("core", "part", "n")
        found.append(cut(_counted(parts.filter("single").select("core", "part", "rid", "at", "strings"), copied, ["core", "part"], "rid").select("rid", F.col("at").alias("lo"), (F.col("at") + F.col("strings") + (length - 1)).alias("hi"))))
        mixed = cut(kinds.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
        open_ = _counted(kinds.select("core", (F.col("n") == 1).alias("once"), "one.*"), mixed, ["core"], "rid")
        open_ = cut(open_.withColumn("single", F.col("single") & F.col("once")).drop("once"))
        found.append(_sorted_groups(open_.filter(F.col("n") <= most), length, width))
        parts = open_.filter(F.col("n") > most).drop("n")
        if finer is None or parts.isEmpty():
            break
        parts = _finer(parts, width, finer)
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    cuts = every.groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("cuts"))
    return cuts.join(ids, "rid").drop("rid").dropDuplicates(["did", "t1", "t2"])


def dedup_substrings(docs: DataFrame, length: int = 400, most: int = 2048, digests: bool = False) -> DataFrame:
    """docs with kept_text in place of text (binary: what is left may break a character; with digests, kept_sha256),
    n_bytes, n_removed, n_spans. Columns of these names, in any case, are replaced."""
    # the text crosses the shuffle once, beside the other columns
    taken = {"text", "kept_sha256" if digests else "kept_text", "n_bytes", "n_removed", "n_spans"}
    others = [c for c in docs.columns if c.lower() not in taken]
    packed = pack(docs)
    row = F.struct(F.lit(0).alias("none"), *[F.col("row").getField(c).alias(c) for c in others]).alias("row")
    keyed = packed.select(row, doc_key(), *text_key(), F.encode(F.coalesce("row.text", F.lit("")), "UTF-8").alias("text"))
    joined = keyed.join(repeated(keyed.select("did", "t1", "t2", "text"), length, most), ["did", "t1", "t2"], "left").select("row", F.col("text").alias("raw"), "cuts")
    new = [("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string") if digests else ("kept_text", "binary")]
    schema = T.StructType([joined.schema["row"], *[T.StructField(c, T._parse_datatype_string(t)) for c, t in new]])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string() if digests else pa.binary()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            out = []
            for raw, cuts in zip(batch.column(1).to_pylist(), batch.column(2)):
                n = len(raw)
                if cuts.is_valid:
                    lo, hi = (cuts.values.field(k).to_numpy() for k in (0, 1))
                    change = np.zeros(n + 1, np.int32)
                    np.add.at(change, lo, 1)
                    np.add.at(change, hi, -1)
                    gone = np.cumsum(change[:-1]) > 0
                    removed = int(gone.sum())
                    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    raw = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                else:
                    removed = runs = 0
                out.append((n, removed, runs, hashlib.sha256(raw).hexdigest() if digests else raw))
            cols = [pa.array([x[k] for x in out], kinds[k]) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["row", *[c for c, _ in new]])

    return unpack(joined.mapInArrow(rows, schema), others, **{c: F.col(c) for c, _ in new})


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_substrings(docs, digests=True).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
