"""License scans: exact base phrases, and short notices found with a bounded number of edits.

A notice with k edits is split into k + 1 pieces, one of which must stand in the text unchanged. One automaton looks for
all pieces; around each hit the regex library matches the whole notice with at most k edits and gives the span.
Null text is empty: no words, no labels, null places, score 0. Repeated rows are scanned each; other columns pass
through. Labels are joined by commas, an empty string for none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsieve.llm.common import unpack

BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Notices in words as this scan sees them, with the label of each.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person", "mit"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("mozilla public license version 2 0", "mpl-2.0"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("dedicated to the public domain", "public-domain"),
    ("copyright all rights reserved", "reserved"),
    ("licensed under the mit license", "mit"),
    ("distributed under the terms of the mit license", "mit"),
    ("licensed under the bsd license", "bsd"),
    ("neither the name of the copyright holder nor the names of its contributors", "bsd"),
    ("this program is free software you can redistribute it and or modify", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl-3.0"),
    ("eclipse public license version 2 0", "epl-2.0"),
    ("boost software license version 1 0", "bsl-1.0"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("free and unencumbered software", "unlicense"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution noderivatives", "cc-by-nd"),
    ("creative commons zero public domain dedication", "cc0"),
    ("european union public licence version 1 2", "eupl-1.2"),
    ("open database license", "odbl"),
    ("may not be reproduced without written permission", "reserved"),
    ("unauthorized copying of this file is strictly prohibited", "reserved"),
)
#: Word bytes stay, A-Z become a-z, every other ASCII byte a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def scan_words(text: str) -> list[str]:
    return text.encode().translate(_TABLE).decode().split(" ")


def normal(text: str) -> tuple[str, int]:
    """The words with a space before and after each, and their number."""
    ws = text.encode("utf-8", "surrogatepass").translate(_TABLE).split()
    return (b" " + b" ".join(ws) + b" ").decode("utf-8", "surrogatepass"), len(ws)


def edits(notice: str, rate: float) -> int:
    return int(len(notice) * rate)


@cache
def _search(notices: tuple, rate: float):
    import ahocorasick
    import regex

    pieces: dict[str, list] = {}
    patterns = []
    for no, (notice, _) in enumerate(notices):
        k = edits(notice, rate)
        cuts = [len(notice) * i // (k + 1) for i in range(k + 2)]
        for a, b in zip(cuts, cuts[1:]):
            pieces.setdefault(notice[a:b], []).append((no, a))
        patterns.append((regex.compile(f"(?b)(?:{regex.escape(notice, literal_spaces=True)}){{e<={k}}}"), k))
    seeds = ahocorasick.Automaton()
    for piece, where in pieces.items():
        seeds.add_word(piece, (len(piece), where))
    seeds.make_automaton()
    return seeds, patterns


def find_notices(body: str, notices: tuple = NOTICES, rate: float = 0.1) -> list[tuple[int, int, int, int]]:
    """(start, end, notice number, edits) of each match in a normalised text, the best around each seed."""
    seeds, patterns = _search(notices, rate)
    done: dict[int, int] = {}  # up to where a notice's windows were searched
    out = set()
    for end, (size, where) in seeds.iter(body):
        for no, offset in where:
            pattern, k = patterns[no]
            lo = max(0, end + 1 - size - offset - k)
            hi = min(len(body), lo + len(notices[no][0]) + 2 * k)
            if done.get(no, -1) >= hi:
                continue
            if m := pattern.search(body, lo, hi):
                out.add((m.start(), m.end(), no, sum(m.fuzzy_counts)))
                done[no] = m.end()
    return sorted(out)


def _word_counter(body: str):
    """The spaces before a place."""
    import numpy as np

    spaces = np.flatnonzero(np.frombuffer(body.encode("utf-32-le", "surrogatepass"), "<u4") == 32)
    return lambda at: int(np.searchsorted(spaces, at))


def scan(text: str, notices: tuple = NOTICES, rate: float = 0.1) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, spans (label, first and last word, edits)."""
    body, n = normal(text)
    starts, base = [], set()
    for phrase, label in BASE:
        at = body.find(f" {phrase} ")
        while at >= 0:
            starts.append(at)
            base.add(label)
            at = body.find(f" {phrase} ", at + 1)
    found = find_notices(body, notices, rate)
    word = _word_counter(body) if starts or found else None
    spans = [(notices[no][1], max(0, word(a + 1) - 1), max(0, word(b - 1) - 1), e) for a, b, no, e in found]
    score = max([1.0 if base else 0.0, *(1 - e / len(notices[no][0]) for _, _, no, e in found)])
    places = [word(a) for a in (min(starts), max(starts))] if starts else [None, None]
    return n, len(starts), *places, ",".join(sorted(base)), ",".join(sorted(base | {s[0] for s in spans})), score, spans


_SPAN = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int64())]))
_NEW = [("n_words", "long", pa.int64()), ("n_base", "long", pa.int64()), ("first_word", "long", pa.int64()), ("last_word", "long", pa.int64()), ("base_labels", "string", pa.string()), ("labels", "string", pa.string()), ("score", "double", pa.float64()), ("spans", "array<struct<label:string,first_word:bigint,last_word:bigint,edits:bigint>>", _SPAN)]


def scan_licenses(docs: DataFrame, text_col: str = "text", notices: tuple = NOTICES, rate: float = 0.1) -> DataFrame:
    """docs with the columns of ``scan``; columns of those names, in any case, are replaced."""
    names = [c for c, _, _ in _NEW]
    kept = [c for c in docs.columns if c.lower() not in names]
    rowed = docs.select(F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([rowed.schema["row"]] + [T.StructField(c, T._parse_datatype_string(t)) for c, t, _ in _NEW])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [scan(t or "", notices, rate) for t in batch.column(1).to_pylist()]
            cols = [pa.array([g[i] if t is not _SPAN else [dict(zip(("label", "first_word", "last_word", "edits"), s)) for s in g[i]] for g in got], t) for i, (_, _, t) in enumerate(_NEW)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], schema.names)

    return unpack(rowed.mapInArrow(rows, schema), kept, **{c: F.col(c) for c in names})


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_licenses(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
