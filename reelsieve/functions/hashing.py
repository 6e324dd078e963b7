"""Perceptual hashes as 64-bit values: packing, distances, fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_HEX = "^[0-9a-fA-F]{16}$"


def pack_hex(h: Column) -> Column:
    """16 hex digits as the bits of a long (two halves: the whole can exceed a signed long); anything else null."""
    half = lambda at: F.conv(F.substring(h, at, 8), 16, 10).cast("long")
    return F.when(F.rlike(h, F.lit(_HEX)), F.shiftleft(half(1), 32).bitwiseOR(half(9)))


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two packed hashes."""
    return F.bit_count(a.bitwiseXOR(b))


def hash_distance(a: Column, b: Column) -> Column:
    """Differing bits of two hex hashes; 64 where either is not one."""
    return F.coalesce(hamming(pack_hex(a), pack_hex(b)), F.lit(64))


def parse_fingerprint(fp: Column, strict: bool = False) -> Column:
    """'h1:h2:...' as an array of longs; bad parts are left out, or with strict make it null."""
    parts = F.split(F.coalesce(fp, F.lit("")), ":")
    good = F.filter(parts, lambda h: F.rlike(h, F.lit(_HEX)))
    out = F.transform(good, pack_hex)
    return F.when(F.size(good) == F.size(parts), out) if strict else out


def mean_distance(a: Column, b: Column) -> Column:
    """Mean distance over the frames that both arrays have; 64 if there is none."""
    n = F.least(F.size(a), F.size(b))
    pairs = F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("double"))
    total = F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)
    return F.when(F.coalesce(n, F.lit(0)) > 0, total / n).otherwise(F.lit(64.0))


def cross_matches(new: Column, informative: Column, other: Column, distance: int) -> Column:
    """Frames that match at any position: the smaller of the two sides' numbers of frames with a match. Frames of the
    new side count only where they are informative."""
    near = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= distance
    usable = F.filter(new, lambda x, i: F.get(informative, i))
    mine = F.size(F.filter(usable, lambda x: F.exists(other, lambda y: near(x, y))))
    theirs = F.size(F.filter(other, lambda y: F.exists(usable, lambda x: near(x, y))))
    return F.least(mine, theirs)


def segment_id(name: Column, frame: Column) -> Column:
    return F.concat(F.lit("s"), F.substring(F.sha1(F.concat_ws(":", name, frame.cast("string"))), 1, 10))


def edge_energy(pixels: Column, width: int = 64) -> Column:
    """Mean absolute difference of neighbours in a row, of a flat array of gray values."""
    at = F.filter(F.sequence(F.lit(1), F.size(pixels) - 1), lambda i: i % width != 0)
    return F.aggregate(F.transform(at, lambda i: F.abs(F.get(pixels, i) - F.get(pixels, i - 1)).cast("double")), F.lit(0.0), lambda s, x: s + x) / F.size(at)


@F.pandas_udf(StringType())
def dct_hash(pixels: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Perceptual hash of 32x32 gray values (flat array): signs of the 8x8 low DCT terms about their median."""
    import numpy as np

    k, n = np.arange(8)[:, None], np.arange(32)[None]
    basis = np.cos(np.pi * (2 * n + 1) * k / 64)
    for part in pixels:
        good = np.flatnonzero([p is not None and len(p) == 1024 for p in part])
        out = np.full(len(part), None, object)
        if len(good):
            tiles = np.stack([np.asarray(part.iloc[i], float) for i in good]).reshape(-1, 32, 32)
            low = (basis @ tiles @ basis.T).reshape(-1, 64)
            bits = np.packbits(low > np.median(low, axis=1, keepdims=True), axis=1)
            out[good] = [b.tobytes().hex() for b in bits]
        yield pd.Series(out, dtype=object)
