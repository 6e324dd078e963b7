"""Fingerprints against plain Python: levels, choices, filters, likeness, edited and next texts."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from reelsieve.llm import fingerprints as fp

ALPHABET = "abcdefgh éß"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    out = ["".join(rng.choice(ALPHABET) for _ in range(n)) for n in [0, 1, 63, 64, 65, 90, 126, 127, 128, 200, 1000, 5000] * 3]
    return out + ["x" * 400, out[10], out[11], None, out[11][:3000] + out[23][:2000], "".join(rng.choice(ALPHABET) for _ in range(60_000))]


def level(w):
    return int(sum(-c / 64 * math.log2(c / 64) for c in Counter(w).values()) * 1000 / 6 + 1e-9)


def chosen(raw, ranks):
    if len(raw) < 64:
        return [raw] if raw else []
    rank = [ranks[level(raw[i : i + 64])] for i in range(len(raw) - 63)]
    popular = [0] * len(rank)
    for g in range(len(rank) - 63):
        popular[min(range(g, g + 64), key=lambda i: (rank[i], i))] += 1
    mine = [i for i, p in enumerate(popular) if p >= 16 and rank[i] < fp.NO_RANK]
    mine = mine or [max(range(len(rank)), key=lambda i: (popular[i], -i)) if any(popular) else min(range(len(rank)), key=lambda i: (rank[i], i))]
    return list(dict.fromkeys(raw[i : i + 64] for i in mine))


def sets(windows):
    out = []
    for at in range(0, len(windows), 160):
        bits = set()
        for w in windows[at : at + 160]:
            digest = hashlib.sha1(w).digest()
            bits |= {int.from_bytes(digest[4 * k : 4 * k + 4], "little") % 2048 for k in range(5)}
        out.append((len(windows[at : at + 160]), bits))
    return out


def alike(a, b):
    def found(x, y):
        best = []
        for n, p in x:
            scores = []
            for _, q in y:
                chance, most = len(p) * len(q) / 2048, min(len(p), len(q))
                least = chance + 0.3 * (most - chance)
                scores.append((len(p & q) - least) / (most - least))
            best.append(n * max(0.0, max(scores)))
        return sum(best) / sum(n for n, _ in x)

    if not a or not b:
        return float(len(a) == len(b))
    na, nb = sum(n for n, _ in a), sum(n for n, _ in b)
    return found(a, b) if na < nb else found(b, a) if nb < na else (found(a, b) + found(b, a)) / 2


def plain_ranks(raw):
    counts = Counter(level(r[i : i + 64]) for r in raw for i in range(len(r) - 63))
    order = sorted(range(100, 991), key=lambda e: (counts[e], e))
    return {**dict.fromkeys(range(1001), fp.NO_RANK), **{e: k for k, e in enumerate(order)}}


def test_small_blocks(texts, monkeypatch):
    raw = [(t or "").encode() for t in texts]
    joined = np.frombuffer(b"".join(raw), np.uint8)
    whole = fp.levels(joined).tolist()
    assert whole == [level(joined[i : i + 64].tobytes()) for i in range(len(joined) - 63)]
    monkeypatch.setattr(fp, "BLOCK", 200)
    assert fp.levels(joined).tolist() == whole


def test_compare_edits(spark, texts):
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(5, texts[5])] * 3 + [(None, texts[10])] * 30
    raw = [(t or "").encode() for _, t in rows]
    ranks = plain_ranks(raw)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, FINGERPRINT string").repartition(3)
    assert fp.entropy_ranks(df) == [ranks[e] for e in range(1001)]
    known = {}

    def of(t):
        if t not in known:
            known[t] = sets(chosen(t.encode(), ranks))
        return known[t]

    seen = None
    for block in (16 << 20, 700):
        got = fp.compare_edits(df, block_bytes=block)
        assert got.columns == "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()
        got = got.collect()
        # the order of equal ids is free but the same for equal texts: it is read off the edited texts' digests
        ids = sorted({i for i, _ in rows if i is not None}, reverse=True) + [None]
        first = {}
        for i in ids:
            mine = Counter(t or "" for j, t in rows if j == i)
            first[i] = set(mine)
        want = Counter((i, len(t or "")) for i, t in rows)
        assert Counter((r.doc_id, r.n_chars) for r in got) == want
        for k, i in enumerate(ids):
            after = first[ids[(k + 1) % len(ids)]] | first[i]
            options = {}
            for t in first[i]:
                cut = len(t) // 3
                for nxt in after:
                    e = t[: len(t) - cut] + nxt[:cut]
                    options.setdefault((len(t), hashlib.sha256(e.encode()).hexdigest()), []).append((t, e, nxt))
            for r in (r for r in got if r.doc_id == i):
                fits = options[r.n_chars, r.edited_sha256]
                assert any(sets_of(r.fingerprint) == of(t) and sets_of(r.edited_fingerprint) == of(e) and abs(r.near_edited - alike(of(t), of(e))) < 1e-9 and abs(r.near_next - alike(of(t), of(n))) < 1e-9 for t, e, n in fits)
        assert sorted(map(repr, got)) == (seen := seen or sorted(map(repr, got)))


def sets_of(text):
    counts, rows = fp.read_print(text)
    return [(n, set(np.flatnonzero(np.unpackbits(row.view(np.uint8), bitorder="little")).tolist())) for n, row in zip(counts, rows)]


def test_next_of_distinct_ids(spark):
    rng = random.Random(9)
    rows = [(i * 3 - 50, "".join(rng.choice(ALPHABET) for _ in range(rng.choice([0, 5, 400, 2000])))) for i in range(60)]
    rng.shuffle(rows)
    order = sorted(rows, reverse=True)
    want = {}
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        want[i] = hashlib.sha256((t[: len(t) - len(t) // 3] + n[: len(t) // 3]).encode()).hexdigest()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for block in (16 << 20, 900, 1):
        assert {r.doc_id: r.edited_sha256 for r in fp.compare_edits(df, block_bytes=block).collect()} == want


def test_likeness_and_edges(spark):
    rng = random.Random(4)
    body = "".join(rng.choice(ALPHABET) for _ in range(30_000))
    other = "".join(rng.choice(ALPHABET) for _ in range(30_000))
    ranks = plain_ranks([body.encode(), other.encode()])
    ranks = [ranks[e] for e in range(1001)]
    a, b, c, none = (fp.prints([t], ranks)[0] for t in (body, body[:20_000] + other[:10_000], other, ""))
    assert fp.likeness(a, a) == 1 and fp.likeness(a, c) < 0.05 and 0.4 < fp.likeness(a, b) < 0.9
    assert fp.likeness(none, none) == 1 and fp.likeness(none, a) == 0
    assert all(np.array_equal(x, y) for x, y in zip(fp.read_print(fp.write_print(a)), a))
    assert fp.compare_edits(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    (r,) = fp.compare_edits(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()
    assert (r.n_chars, r.fingerprint, r.near_edited, r.near_next) == (0, "", 1, 1)
    df = spark.createDataFrame([(1, body, "y")], "doc_id long, text string, Fingerprint string")
    (r,) = fp.fingerprints(df, ranks).collect()
    assert r.asDict() == {"doc_id": 1, "text": body, "fingerprint": fp.write_print(a)}
