"""Training-data operators against brute force and round trips, and on nulls, empty tables, repeats and clashing names."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from reelsieve.llm import bpe, chaining, decontaminate, license_scan, line_dedup, quality, simhash, suffix_dedup, token_counts, url_filter
from reelsieve.llm.common import join_spread
from reelsieve.llm.suffix_array import common_prefixes, suffix_array

DOCS = "doc_id long, text string, source string"
WORDS = [f"w{i}" for i in range(400)]


def words(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    texts = ["\n".join(words(rng, rng.randrange(5, 40)) for _ in range(rng.randrange(1, 8))) for _ in range(60)]
    passage, line = words(rng, 90), words(rng, 12)
    for i in range(0, 60, 6):
        texts[i] = texts[i][: len(texts[i]) // 2] + " " + passage + " " + texts[i][len(texts[i]) // 2 :]
    for i in range(0, 60, 4):
        texts[i] += "\n" + line
    texts += [texts[3], texts[3], texts[7].replace("w1 ", "w2 "), "", None, " \n ", "a", "x" * 5000, "Été À\n#*$\n#*$", texts[8] + "\n" + texts[8]]
    rows = [(i, t, f"s{i % 3}" if i % 11 else None) for i, t in enumerate(texts)]
    return [*rows, rows[5], (None, texts[9], "s1"), (None, None, None)]


@pytest.fixture
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS)


def by_row(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_suffix_array_brute_force():
    rng = random.Random(1)
    for _ in range(3000):
        t = [rng.randrange(rng.choice([1, 2, 5])) for _ in range(rng.randrange(25))]
        order = suffix_array(t)
        assert order == sorted(range(len(t)), key=lambda i: t[i:])
        lcp = common_prefixes(t, order)
        for k in range(1, len(t)):
            a, b = t[order[k - 1] :], t[order[k] :]
            assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("most", [4096, 1])
def test_suffix_dedup(docs, corpus, most):
    length = 100
    raw = [(t or "").encode() for _, t, _ in corpus]
    starts = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    want = []
    for (d, _, _), b in zip(corpus, raw):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if starts[b[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        want.append((d is None, d or 0, len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    got = suffix_dedup.dedup_substrings(docs, length, most, digests=True).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)


def test_suffix_dedup_many_contexts(spark):
    """A line that stands in very many texts, between words of their own and in near copies, and null ids."""
    rng = random.Random(17)
    line = words(rng, 12)
    body = words(rng, 120).split(" ")
    texts = [f"{words(rng, 30)} {line} {words(rng, 30)}" for _ in range(120)] + [" ".join(body[:k] + ["edit" + str(k)] + body[k:]) for k in range(0, 120, 2)]
    rows = [(None if i % 3 == 0 else i, t) for i, t in enumerate(texts)]
    length = 150
    raw = [t.encode() for _, t in rows]
    starts = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    want = []
    for (d, _), b in zip(rows, raw):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if starts[b[i : i + length]] > 1:
                gone[i : i + length] = True
        want.append((repr(d), len(b), int(gone.sum()), hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, N_BYTES string")
    for most in (4096, 2):
        got = suffix_dedup.dedup_substrings(df, length, most, digests=True)
        assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        assert sorted((repr(r.doc_id), r.n_bytes, r.n_removed, r.kept_sha256) for r in got.collect()) == sorted(want)


def test_suffix_dedup_long_pieces(spark, monkeypatch):
    rng = random.Random(4)
    body = words(rng, 3000)
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    df = spark.createDataFrame([(1, body), (2, "y" * 50 + body), (3, words(rng, 50))], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffix_dedup.dedup_substrings(df).collect()}
    assert got[1] == (len(body), len(body)) and got[2] == (len(body) + 50, len(body)) and got[3][1] == 0


def test_url_filter(spark):
    urls = ["http://A.example.net/en/x?q", "https://x.example.com/de/1", "https://b.org/fr/2", "https://z.net", "https://z.net/", "nothing", None, "", "https://spam-farm.example.org/en/1", "http://a.org/wp-login.php", "https://q.org/calendar/2020/01/", "ftp://x.example.com/DE/"]
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id int, url string, host int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(df).collect()}
    for i, u in enumerate(urls):
        m = re.search("://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [r for r in url_filter.HOST_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        method = next((r.verdict for r in url_filter.PATTERN_RULES if re.search(r.pattern, u or "")), "allow")
        assert got[i] == (host, path, best and best.name, best.verdict if best else method)


def test_url_rules_by_tables(spark):
    """Very many rules are joined as tables and give the same; columns of any name and case stay or are replaced."""
    rng = random.Random(14)
    hosts = [f"{a}.{b}" for a in "abcdef" for b in ("com", "net", "x.org")]
    rules = tuple(url_filter.HostRule(rng.choice([h, h.split(".", 1)[1]]), rng.choice(["/", "/a", "/a/b/"]), rng.choice(["allow", "block"])) for h in hosts * 2)
    patterns = (*url_filter.PATTERN_RULES, url_filter.PatternRule("digits", "/[0-9]{5}", ()), url_filter.PatternRule("ab", "a/b/c", ("a", "b", "c"), "allow"))
    urls = [f"http://{rng.choice(['', 'w.'])}{rng.choice(hosts)}{rng.choice(['', '/', '/a', '/a/b/c', '/login', '/q?jsessionid=1', '/12345'])}" for _ in range(150)] + [None, "", "nothing"]
    df = spark.createDataFrame([(i, u, 7, 8, 9) for i, u in enumerate(urls)] * 2, "page_id int, url string, _host int, Tokens int, RULE int")
    got = [sorted(map(repr, url_filter.filter_urls(df, rules, patterns, max_rules=n).collect())) for n in (1000, 0)]
    assert got[0] == got[1] and "_host=7, Tokens=8, host=" in got[0][0] and len(got[0]) == 2 * len(urls)
    none = url_filter.filter_urls(df, (), (), max_rules=-1).collect()
    assert {r.verdict for r in none} == {"allow"} and {r.rule for r in none} == {None}


def test_chaining_finds_passages(docs, corpus):
    rows = chaining.shared_passages(docs).collect()
    linked = {r.doc_id for r in rows} | {r.other_id for r in rows}
    assert set(range(0, 60, 6)) <= linked
    assert not linked & {1, 2, 4, 10, 11, 61 + 4}
    assert all(r.n_words >= 50 and r.similarity >= 0.8 and r.doc_id != r.other_id for r in rows)


@pytest.mark.parametrize("few", [32, 1])
def test_chaining_links_later_holders(spark, few):
    """Texts 1 and 2 hold parts of a passage that only 3 and 4 hold whole."""
    rng = random.Random(21)
    rows = []
    for g in range(20):
        p = [rng.choice(WORDS) for _ in range(60)]
        for i, part in enumerate((p[:40], p[20:], p, p)):
            rows.append((4 * g + i, f"{words(rng, 40)} {' '.join(part)} {words(rng, 40)}"))
    got = {(r.doc_id, r.other_id): r for r in chaining.shared_passages(spark.createDataFrame(rows, "doc_id long, text string"), few=few).collect()}
    assert all(got[4 * g + 3, 4 * g + 2].n_equal >= 60 for g in range(20))


@pytest.mark.parametrize("n, share", [(60, 0.05), (60, 0.1), (60, 0.15), (100, 0.15), (60, 0.2), (100, 0.2)])
def test_chaining_recall(spark, n, share):
    """Passages of which a share of the words is replaced, left out or added, evenly or anywhere."""
    rng = random.Random(22)
    rows, want = [], set()
    for g in range(40):
        p = [rng.choice(WORDS) for _ in range(n)]
        q, edits = list(p), int(share * n)
        places = [int((e + 0.5) / share) for e in range(edits)] if g % 2 else rng.sample(range(n), edits)
        for x in sorted(places, reverse=True):
            kind = rng.choice("rio") if g % 4 > 1 else "r"
            q[x : x + 1] = {"r": [f"z{x}"], "i": [q[x], f"z{x}"], "o": []}[kind]
        for i, part in enumerate((p, q)):
            rows.append((2 * g + i, " ".join(f"a{g}x{i}x{k}" for k in range(60)) + f" {' '.join(part)} " + " ".join(f"b{g}x{i}x{k}" for k in range(60))))
        want.add((2 * g + 1, 2 * g))
    got = {(r.doc_id, r.other_id) for r in chaining.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


@pytest.mark.parametrize("early", [17, 60])
def test_chaining_pieces_shadow_nothing(spark, early):
    """Early documents hold pieces of a passage that two late ones hold whole."""
    rng = random.Random(23)
    p = [rng.choice(WORDS) for _ in range(120)]
    rows = [(i, f"{words(rng, 30)} {' '.join(p[x : x + 26])} {words(rng, 30)}") for i, x in enumerate(rng.randrange(95) for _ in range(early))]
    rows += [(500, f"{words(rng, 40)} {' '.join(p)} {words(rng, 40)}"), (501, f"{words(rng, 20)} {' '.join(p)}")]
    got = chaining.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.other_id, r.n_equal) for r in got] == [(501, 500, 120)]


def test_chaining_second_partner(spark):
    """A text shares most of itself with one other, and most of that and a passage more with a second one."""
    rng = random.Random(26)
    rows, want = [], set()
    for g in range(12):
        body, more = [rng.choice(WORDS) for _ in range(1000)], [rng.choice(WORDS) for _ in range(90)]
        parts = (body + [f"x{g}"] + more, body, [f"b{g}"] + body[:900] + [f"c{g}"] * 3 + more)
        order = rng.sample(range(3), 3)
        ids = {k: 3 * g + order[k] for k in range(3)}
        rows += [(ids[k], " ".join(p)) for k, p in enumerate(parts)]
        want.add((max(ids[0], ids[2]), min(ids[0], ids[2])))
    got = defaultdict(list)
    for r in chaining.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.doc_id, r.other_id].append(r)
    for pair in want:  # the passage of 90 words is in a row of this pair
        spans = [(r.first_byte, r.last_byte) for r in got[pair]]
        text = dict(rows)[pair[0]].encode()
        assert any(len(set(text[a:b].decode().split()) & {"nothing"}) == 0 and len(text[a:b].split()) >= 85 and (f"x{pair[0] // 3}" in text[:a].decode() or f"c{pair[0] // 3}" in text[:a].decode() or f"x{pair[0] // 3}".encode() in text[a:b] or f"c{pair[0] // 3}".encode() in text[a:b]) for a, b in spans)


def test_chaining_common_pieces_and_edits(spark):
    """Forty texts hold the first 40 words of a passage, forty the last 40, and two hold all 60 but for three words each."""
    rng = random.Random(27)
    rows, want = [], set()
    for g in range(15):
        p = [rng.choice(WORDS) for _ in range(60)]
        parts = [p[:40]] * 40 + [p[20:]] * 40
        for k in range(2):
            q = list(p)
            for x in rng.sample(range(60), 3):
                q[x] = f"z{g}x{k}x{x}"
            parts.append(q)
        order = rng.sample(range(82), 82)
        rows += [(82 * g + i, f"{words(rng, 30)} {' '.join(q)} {words(rng, 30)}") for i, q in zip(order, parts)]
        want.add((82 * g + max(order[80:]), 82 * g + min(order[80:])))
    got = {(r.doc_id, r.other_id) for r in chaining.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(want & got) >= 14 and not {(a, b) for a, b in got if a // 82 != b // 82}


def test_chaining_common_seeds_lose_nothing(spark):
    """Six texts hold the first 40 words of a passage, six the last 40, and two hold all 60 but for four words each; all its seeds are
    common, and stand first in other texts."""
    rng = random.Random(32)
    rows, want = [], set()
    for g in range(30):
        p = [rng.choice(WORDS) for _ in range(60)]
        parts = [p[:40]] * 6 + [p[20:]] * 6
        for k in range(2):
            q = list(p)
            for x in rng.sample(range(60), 4):
                q[x] = f"z{g}x{k}x{x}"
            parts.append(q)
        rows += [(14 * g + i, f"{words(rng, 30)} {' '.join(q)} {words(rng, 30)}") for i, q in enumerate(parts)]
        want.add((14 * g + 13, 14 * g + 12))
    got = {(r.doc_id, r.other_id) for r in chaining.shared_passages(spark.createDataFrame(rows, "doc_id long, text string"), few=2).collect()}
    assert want <= got and not {(a, b) for a, b in got if a // 14 != b // 14}


@pytest.mark.parametrize("columns", [256, 2])
def test_chaining_alike_brute_force(monkeypatch, columns):
    monkeypatch.setattr(chaining, "COLUMNS", columns)
    rng = np.random.default_rng(33)
    for n in range(60):
        wins = rng.integers(0, (3, 6, 30)[n % 3], (12, 40), dtype=np.uint8)
        pairs = [Counter((a, b) for a, b in zip(w, w[1:]) if a and b) for w in wins.tolist()]
        for firsts, least in ((0, 4), (0, 9), (5, 4), (5, 9)):
            want = {(i, j) for i in range(12) for j in range(i + 1, 12) if (not firsts or i < firsts <= j) and sum((pairs[i] & pairs[j]).values()) >= least}
            i, j = chaining.alike(wins, firsts, least)
            assert sorted(zip(i.tolist(), j.tolist())) == sorted(want)


def edited(rng, x, edits, width):
    """The words around the middle of x with so many edits outside of the seed, cut to the same width."""
    sides = []
    for y in (x[:width][::-1], x[width + chaining.K :]):
        y = list(y)
        for _ in range(edits):
            at, kind = rng.randrange(len(y)), rng.choice("rio")
            y[at : at + 1] = {"r": [rng.randrange(1, 256)], "i": [y[at], rng.randrange(1, 256)], "o": []}[kind]
        sides.append((y + [rng.randrange(1, 256) for _ in range(width)])[:width])
    return [*sides[0][::-1], *x[width : width + chaining.K], *sides[1]]


def test_chaining_windows_never_lose_a_passage():
    """What align finds from the seed in the middle is let through by both tests of the windows."""
    rng = random.Random(34)
    n, width = 20, 40
    ones, twos, want = [], [], []
    for g in range(1500):
        x = [rng.randrange(1, 256) for _ in range(2 * width + chaining.K)]
        lo, hi = rng.randrange(width - 16, width), rng.randrange(width + chaining.K, width + 20)
        y = edited(rng, x, rng.randrange(5), width)
        y = [w if lo <= k < hi else rng.randrange(1, 256) for k, w in enumerate(y)]
        texts = [" ".join(f"w{w}" for w in z).encode() for z in (x, y)]
        at = [len(" ".join(f"w{w}" for w in z[:width])) + 1 for z in (x, y)]
        rows, _ = chaining.align(*texts, [tuple(at)], n, 0.8, [False] * 2, [False] * 2)
        want.append(bool(rows))
        ones.append(x)
        twos.append(y)
    a, b, want = np.array(ones, np.uint8), np.array(twos, np.uint8), np.array(want)
    fit, alone = chaining.may_align(a, b, n, 0.8), chaining.may_stand_alone(a, b, n)
    assert 200 < want.sum() < 1300 and fit[want].all() and alone[want].all()
    assert (fit & alone).sum() < 1.5 * want.sum()


def test_chaining_windows_pass_over_short_runs():
    """Runs of one word, of 33 and 47 of them, are no passage of 50 words; before, both were aligned."""
    rng = random.Random(35)
    ones, twos = [], []
    for run in (33, 47, 52):
        for out in (ones, twos):
            more = run if out is ones else 90
            row = [rng.randrange(2, 256) for _ in range(204)]
            row[100 : 100 + more] = [1] * more
            out.append(row)
    a, b = np.array(ones, np.uint8), np.array(twos, np.uint8)
    assert (chaining.may_align(a, b, 50, 0.8) & chaining.may_stand_alone(a, b, 50)).tolist() == [False, False, True]
    assert not chaining.may_align(a, b, 50, 0.8)[0]


def test_chaining_plainly_alike_windows():
    """What differs in few words, one for one, passes both tests of the windows, so that these need not be made."""
    rng = np.random.default_rng(37)
    a = rng.integers(1, 256, (3000, 204), dtype=np.uint8)
    b, other = a.copy(), rng.random(a.shape) < rng.choice([0, 0.03, 0.08, 0.15, 0.4], (3000, 1))
    other[:, 100:104] = False
    b[other] = rng.integers(0, 256, int(other.sum()))
    sure = chaining.plainly(a, b, 50, 0.8)
    assert 500 < sure.sum() < 2500 and (chaining.may_align(a, b, 50, 0.8) & chaining.may_stand_alone(a, b, 50))[sure].all()


def test_chaining_aligns_many_at_once():
    """Chains that are aligned together give what each gives alone."""
    rng = random.Random(38)
    ids, flat, jobs, want = {}, [], [], []
    for g in range(300):
        x = [rng.randrange((2, 5, 30, 400)[g % 4]) for _ in range(rng.randrange(20, 200))]
        y = [w for w in x for w in {0: [w, 900], 1: [], 2: [901]}.get(rng.randrange((8, 20, 60)[g % 3]), [w])]
        texts = [" ".join(f"w{w}" for w in z).encode() for z in (x, y)]
        words = [[m.group() for m in re.finditer(rb"[^ ]+", t)] for t in texts]
        places = [[m.start() for m in re.finditer(rb"[^ ]+", t)] for t in texts]
        pairs = [(places[0][i], places[1][j]) for i in range(len(x) - 3) for j in range(max(0, i - 9), min(i + 9, len(y) - 3)) if words[0][i : i + 4] == words[1][j : j + 4]]
        for c in chaining.chain(rng.sample(pairs, min(len(pairs), 1 + g % 7)))[:2]:
            more = [[rng.random() < 0.5 for _ in range(2)] for _ in range(2)]
            want.append(chaining.align(*texts, c, 20, 0.8, *more))
            sides = []
            for k, t in enumerate(texts):
                numbers = [ids.setdefault(w, len(ids)) for w in words[k]]
                sides.append(chaining.Side(numbers, places[k], [p + len(w) for p, w in zip(places[k], words[k])], 0, len(t), more[0][k], more[1][k], len(flat)))
                flat += numbers
            jobs.append((*sides, c))
    assert chaining.align_all(np.array(flat, np.int32), jobs, 20, 0.8) == want and sum(bool(rows) for rows, _ in want) > 100


def test_chaining_rows_for_each_later_document(spark):
    """Forty documents share a passage, in any order of ids: each but the earliest has a row of its own that names an earlier one."""
    rng = random.Random(30)
    rows = []
    for g in range(6):
        p = " ".join(rng.choice(WORDS) for _ in range(60))
        rows += [(1000 * g + 7 * i, f"{' '.join(f'a{g}x{i}x{k}' for k in range(30))} {p} {' '.join(f'b{g}x{i}x{k}' for k in range(30))}") for i in rng.sample(range(40), 40)]
    rows += [(5, "".join(f"q{i} " for i in range(60))), (5, "".join(f"r{i} " for i in range(60)))]  # an id of two texts
    got = {(r.doc_id, r.other_id) for r in chaining.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {a for a, b in got if b < a and a // 1000 == b // 1000} == {1000 * g + 7 * i for g in range(6) for i in range(1, 40)}
    assert len({a for a, _ in got}) == 6 * 39 and all(b < a for a, b in got)


@pytest.mark.parametrize("few", [32, 2])
def test_chaining_links_each_two(spark, few):
    """A passage with ten edits in one text and fifteen others in another, which are too far from each other; and families of near copies:
    every two that are alike are linked, whatever else holds the stretch."""
    rng = random.Random(36)
    rows, want = [], set()

    def text(p: list[str]) -> str:
        i = len(rows)
        return f"{' '.join(f'a{i}x{k}' for k in range(30))} {' '.join(p)} {' '.join(f'b{i}x{k}' for k in range(30))}"

    for g in range(10):
        p = [rng.choice(WORDS) for _ in range(100)]
        far = [f"z{g}x{k}" if k % 20 in (2, 9, 15) else w for k, w in enumerate(p)]
        near = [f"y{g}x{k}" if k % 10 == 6 else w for k, w in enumerate(p)]
        rows += [(len(rows), text(q)) for q in (near,)]
        rows += [(len(rows), text(q)) for q in (far,)]
        rows += [(len(rows), text(q)) for q in (p,)]
        want |= {(3 * g + 2, 3 * g), (3 * g + 2, 3 * g + 1)}
    first = len(rows)
    for n in (12, 45):
        p = [rng.choice(WORDS) for _ in range(80)]
        begin = len(rows)
        for _ in range(n):
            q = list(p)
            for x in rng.sample(range(80), 3):
                q[x] = f"z{len(rows)}x{x}"
            rows.append((len(rows), text(q)))
        want |= {(i, j) for i in range(begin, len(rows)) for j in range(begin, i)}
    got = {(r.doc_id, r.other_id) for r in chaining.shared_passages(spark.createDataFrame(rows, "doc_id long, text string"), few=few).collect()}
    assert want <= got and not {(a, b) for a, b in got - want if a >= first}


def test_chaining_query_names_each_holder(spark, tmp_path):
    rng = random.Random(31)
    p = " ".join(rng.choice(WORDS) for _ in range(60))
    rows = [(i, f"{' '.join(f'a{i}x{k}' for k in range(30 + i))} {p} {' '.join(f'b{i}x{k}' for k in range(30))}") for i in range(2)] + [(2, " ".join(f"c{k}" for k in range(90)))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in chaining.query(spark, str(tmp_path)).collect()}
    assert {(a, r.other_id) for a, r in got.items()} == {(0, 1), (1, 0)}
    assert all(rows[a][1][r.first_byte : r.last_byte] == rows[r.other_id][1][r.other_first : r.other_last] == p for a, r in got.items())


def test_chaining_periodic(spark):
    """Stretches that repeat a few words again and again."""
    rng = random.Random(28)
    rows, want = [], set()
    for g in range(20):
        unit = [f"p{g}x{k}" for k in range(rng.choice([1, 3, 4, 5, 7]))]
        stretch = (unit * 80)[: rng.choice([60, 75, 200])]
        for i in range(2):
            rows.append((2 * g + i, f"{' '.join(f'a{g}x{i}x{k}' for k in range(rng.randrange(20, 60)))} {' '.join(stretch)} {' '.join(f'b{g}x{i}x{k}' for k in range(30))}"))
        want.add((2 * g + 1, 2 * g))
    assert {(r.doc_id, r.other_id) for r in chaining.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == want


def test_chaining_on_any_partitioning(spark):
    rng = random.Random(29)
    shared = [[rng.choice(WORDS) for _ in range(rng.randrange(50, 300))] for _ in range(8)]
    texts = [" ".join(w if rng.random() > 0.05 else f"z{i}" for x in rng.sample(shared, 3) for w in x) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before, sets = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (4, 7, 11):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            sets.append(sorted(map(repr, chaining.shared_passages(df.repartition(n)).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sets[0] == sets[1] == sets[2] and len(sets[0]) > 60


def test_chaining_brute_force(spark):
    """Texts that share min_words equal words are linked, and what is reported is as alike as it says."""
    rng = random.Random(24)
    shared = [[rng.choice(WORDS) for _ in range(rng.randrange(40, 75))] for _ in range(12)]
    rows = []
    for i in range(70):
        parts = [words(rng, rng.randrange(5, 60))]
        for x in rng.sample(shared, rng.randrange(3)):
            rate = rng.choice([0, 0, 0.05, 0.15])
            y = ["zz" if rng.random() < rate else w for w in x]
            parts += [" ".join(y), words(rng, rng.randrange(5, 60))]
        rows.append((None if i % 9 == 0 else i // 2, ("\n" if i % 2 else " ").join(parts)))
    rows += [rows[4], (300, rows[5][1]), (None, rows[6][1]), (301, None), (302, ""), (303, "x" * 70000)]
    ws = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()) for _, t in rows]
    want = set()
    for i in range(len(rows)):
        for j in range(i):
            grams = {tuple(ws[j][k : k + 50]) for k in range(len(ws[j]) - 49)}
            if rows[i] != rows[j] and any(tuple(ws[i][k : k + 50]) in grams for k in range(len(ws[i]) - 49)):
                want.add(frozenset([rows[i], rows[j]]))
    text = defaultdict(list)
    for r in rows:
        text[r[0]].append(r[1])
    got = chaining.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    pairs = set()
    for r in got:
        if r.first_byte is None:
            pairs |= {frozenset([(r.doc_id, a), (r.other_id, b)]) for a in text[r.doc_id] for b in text[r.other_id] if a == b}
            continue
        sides = []
        for d, lo, hi in ((r.doc_id, r.first_byte, r.last_byte), (r.other_id, r.other_first, r.other_last)):
            sides.append([(t, re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.encode()[lo:hi].decode(errors="replace").lower())) for t in text[d] if t])
        best = None
        for a, x in sides[0]:
            for b, y in sides[1]:
                row = [0] * (len(y) + 1)
                for u in x:
                    last = 0
                    for k, v in enumerate(y, 1):
                        last, row[k] = row[k], last + 1 if u == v else max(row[k], row[k - 1])
                if row[-1] >= r.n_equal and max(len(x), len(y)) == r.n_words and a != b:
                    best = frozenset([(r.doc_id, a), (r.other_id, b)])
                    pairs.add(best)
        assert best and r.n_words >= 50 and r.similarity == r.n_equal / r.n_words >= 0.8
    by_class = defaultdict(set)  # copies are reported with their class, others between representatives
    for d, t in rows:
        by_class[t].add((d, t))
    low = {t: min(ds, key=lambda r: (r[0] is not None, r[0] or 0)) for t, ds in by_class.items()}
    # who shares a passage is linked, if not by a row of its own then by those of others that share it
    root = {r: r for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p in pairs:
        x, y = (tuple(p) * 2)[:2]
        root[find(x)] = find(y)
    same = [{find(low[t]) for _, t in p} for p in want]
    assert len(want) > 20 and all(len(s) == 1 for s in same)


def test_chaining_goes_on(spark):
    """A passage whose seeds stand first in other texts goes on beyond the bytes fetched at first."""
    rng = random.Random(25)
    p = [rng.choice(WORDS) for _ in range(900)]
    rows = [(i, " ".join(p[450:]) + " " + words(rng, 30)) for i in range(3)] + [(10, " ".join(p)), (11, words(rng, 9) + " " + " ".join(p))]
    got = {(r.doc_id, r.other_id): r.n_equal for r in chaining.shared_passages(spark.createDataFrame(rows, "doc_id long, text string"), few=1, margin=40).collect()}
    assert got[11, 10] == 900


def test_chain_fenwick_brute_force():
    rng = random.Random(9)
    for _ in range(200):
        ms = sorted({(rng.randrange(300), rng.randrange(300)) for _ in range(rng.randrange(1, 14))})
        best = {}
        for m in ms:
            best[m] = 40 + max([0.0, *(best[p] - 0.05 * (m[0] - p[0] + m[1] - p[1]) for p in ms if p[0] < m[0] and p[1] < m[1])])
        top = chaining.chain(ms)[0]
        score = 40 * len(top) - 0.05 * sum(y[0] - x[0] + y[1] - x[1] for x, y in zip(top, top[1:]))
        assert abs(score - max(best.values())) < 1e-6


def test_simhash(docs, corpus):
    def low(t):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")

    prints = []
    for _, t, _ in corpus:
        ws = [w for w in re.split(r"[\x20\x09-\x0D]+", low(t)) if w]
        sh = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] if len(ws) > 2 else [" ".join(ws)] if ws else []
        hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)))
    root = list(range(len(prints)))
    for _ in range(len(prints)):
        for i in range(len(prints)):
            for j in range(i):
                if bin(prints[i] ^ prints[j]).count("1") <= 3:
                    root[i] = root[j] = min(root[i], root[j])
    low_id = defaultdict(lambda: 10**9)
    for i, (d, _, _) in enumerate(corpus):
        if d is not None:
            low_id[root[i]] = min(low_id[root[i]], d)
    want = sorted((d is None, d or 0, prints[i], low_id[root[i]]) for i, (d, _, _) in enumerate(corpus))
    got = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fp & (2**64 - 1), r.component_id) for r in got) == want


def test_tiles_give_all_links(spark):
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = list({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (2**64 - 1) for b in base for _ in range(12)})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin(a ^ b).count("1") <= 3:
                root[find(a)] = find(b)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 3, tile=4).collect()
    other = {f: f for f in fps}

    def find2(x):
        while other[x] != x:
            x = other[x]
        return x

    for e in edges:
        a, b = e.u & (2**64 - 1), e.v & (2**64 - 1)
        assert find(a) == find(b)
        other[find2(a)] = find2(b)
    assert len({find2(f) for f in fps}) == len({find(f) for f in fps})


def test_license_scan(spark):
    texts = ["Licensed, CC BY 4.0; cc-by x ccby", "All rights reserved. all  rights RESERVED", "Relesed under the MIT licence now", "general public licenses", "", None, "Permission is hereby grantd, free of charge, to any persn"]
    got = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).orderBy("doc_id").collect()
    for r, t in zip(got, texts):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = {p: [i for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()] for p, _ in license_scan.BASE}
        places = sorted(i for v in at.values() for i in v)
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(ws), len(places), *((places[0], places[-1]) if places else (None, None)))
        assert r.base_labels == ",".join(sorted({label for p, label in license_scan.BASE if at[p]}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert got[2].labels == "mit" and got[6].labels == "mit" and got[3].labels == ""
    assert [tuple(s) for s in got[2].spans] == [("mit", 0, 4, 2)] and [s.label for s in got[6].spans] == ["mit"] and 1 <= got[6].spans[0].edits <= 5


def test_license_scan_long_text(spark):
    """Many notices in one long text, each with its place."""
    text = " ".join(f"{' '.join(['word'] * 30)} All rights reserved, released under the MIT license" for _ in range(2000))
    (r,) = license_scan.scan_licenses(spark.createDataFrame([(1, text)], "doc_id int, text string")).collect()
    assert (r.n_base, r.first_word, r.last_word, r.n_words) == (2000, 30, 1999 * 38 + 30, 2000 * 38)
    assert [s.first_word for s in r.spans if s.label == "mit" and not s.edits] == [38 * i + 33 for i in range(2000)]


def test_bpe_is_the_library(docs, corpus):
    from tokenizers import Tokenizer

    ref = Tokenizer.from_file(bpe.default_path())
    ref.no_padding()
    ref.no_truncation()
    odd = ["ΣΑΣ", "İx", "<|endoftext|>a<|startoftext|>", "日本語 don't", "a\x1cb\x85c", "llll rrrr nllll"]
    tok = bpe.tokenizer(bpe.default_path())
    for t in [*odd, *(t or "" for _, t, _ in corpus)]:
        e = ref.encode(t, add_special_tokens=False)
        ids = np.frombuffer(tok.encode(t), "<u4").tolist()
        assert ids == e.ids and tok.decode(ids) == ref.decode(e.ids, skip_special_tokens=False)
    got = bpe.decode(bpe.encode(docs).drop("decoded")).collect()
    assert len(got) == len(corpus) and all(r.n_tokens == len(r.token_ids) for r in got)
    assert all(r.decoded == tok.decode(r.token_ids) for r in got)


def test_automaton_random_merges():
    rng = random.Random(6)
    for _ in range(60):
        vocab, merges = {c: i for i, c in enumerate("abc")}, []
        for _ in range(12):
            u, v = rng.choice(list(vocab)), rng.choice(list(vocab))
            if u + v not in vocab:
                vocab[u + v] = len(vocab)
                merges.append((u, v))
        auto = bpe.Automaton(vocab, merges, "")
        for _ in range(60):
            word = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 14)))
            parts = list(word)
            for u, v in merges:
                i = 0
                while i + 1 < len(parts):
                    if parts[i] == u and parts[i + 1] == v:
                        parts[i : i + 2] = [u + v]
                    i += 1
            assert [auto.labels[x] for x in auto.encode(word)] == parts


def test_token_counts(spark, docs, corpus, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    manifest = token_counts.write_token_files(docs.repartition(3), folder)
    tok = bpe.tokenizer(bpe.default_path())
    want = sorted((d is None, d or 0, len(tok.encode(t or "", special=False)) // 4) for d, t, _ in corpus)
    for block in (7, 1 << 20):
        got = manifest.join(token_counts.token_counts(spark, folder, block_tokens=block), ["file", "nth"]).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in got) == want
    (tmp_path / "raw").mkdir()
    np.array([5, 6, 49407, 49407, 1], "<u2").tofile(tmp_path / "raw" / "a.bin")
    np.array([], "<u2").tofile(tmp_path / "raw" / "b.bin")
    rows = token_counts.token_counts(spark, f"file://{tmp_path}/raw", block_tokens=2).orderBy("nth").collect()
    assert [(r.nth, r.start, r.n_tokens, r.terminated) for r in rows] == [(0, 0, 2, True), (1, 3, 0, True), (2, 4, 1, False)]


def test_quality(docs, corpus):
    got = quality.judge(docs).collect()
    assert len(got) == len(corpus)
    by = {(r.doc_id, r.text): r for r in got}
    for d, t, _ in corpus:
        ws = [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]
        win = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
        n = Counter(win)
        inside = {i + k for i, w in enumerate(win) if n[w] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = by[d, t]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(inside))
        assert r.base_failed == (len(ws) < 50 or 100 * len(inside) > 50 * len(ws)) and not (r.base_failed and r.kept)


def test_quality_boilerplate(spark):
    rng = random.Random(3)
    notice = words(rng, 60)
    rows = [(i, words(rng, 15) + "\n" + notice + "\n" + words(rng, 5), "h") for i in range(30)] + [(100 + i, words(rng, 80), "h") for i in range(30)] + [(200 + i, rows_text, "h") for rows_text in [words(rng, 30) + "\n" + words(rng, 30)] for i in range(30)]
    kept = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, DOCS)).collect()}
    assert not any(kept[i] for i in range(30)) and all(kept[i] for i in kept if i >= 100)


@pytest.mark.parametrize("n_lines", [3, 4, 5, 6])
@pytest.mark.parametrize("place", ["header", "footer"])
def test_quality_blocks(spark, n_lines, place):
    """Each line of a block counts the distinct documents that hold it; copies of one text count once."""
    rng = random.Random(5)
    block = [words(rng, 40) for _ in range(n_lines)]
    few = [words(rng, 30) for _ in range(4)]
    rows = [(i, "\n".join([*block, words(rng, 24)] if place == "header" else [words(rng, 24), *block]), "h") for i in range(40)]
    rows += [(100 + i, "\n".join([words(rng, 25), *few, words(rng, 25)]), "h") for i in range(8)]
    rows += [(200, "\n".join(few), "h")] * 30 + [(300 + i, words(rng, 80), "h") for i in range(30)]
    rows += [(400 + i, "\n".join([*block, words(rng, 200)]), "h") for i in range(3)] + [(500, "\n".join(block) + "\nit goes on " + words(rng, 60), "g")]
    df = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in quality.judge(df).collect()}
    assert all(got[i].n_common_words == 40 * n_lines and not got[i].kept for i in range(40))
    assert all(r.n_common_words == 0 and r.kept for i, r in got.items() if 100 <= i < 400 or i == 500)
    assert all(got[i].n_common_words == 40 * n_lines and got[i].kept for i in range(400, 403))
    left = {r.doc_id: r.text for r in quality.clean(df).collect()}
    assert set(left) == {i for i in got if got[i].kept}
    assert all(left[i] == (t.split("\n")[-1] if 400 <= i < 500 else t) for i, t, _ in rows if i in left)


def test_quality_by_shuffle(spark, docs):
    lines = "\n".join(["subscribe to our newsletter today", "all the news that we print"])
    more = spark.createDataFrame([(100 + i, f"{lines}\n{i} " + " ".join(f"v{i}x{k}" for k in range(8 * (i % 9))) + f"\n{lines}", "s1") for i in range(40)] * 2, DOCS)
    some = docs.unionByName(more)
    cols = ("doc_id", "n_words", "n_common_words", "kept")
    got = [sorted(map(repr, by_row_unsorted(quality.judge(some, broadcast_rows=n), *cols))) for n in (100_000, 0)]
    assert got[0] == got[1] and any("False" in r for r in got[0])


def by_row_unsorted(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


@pytest.mark.parametrize("hot", [[], [1], [1, 2, 9], list(range(12))])
def test_join_spread(spark, hot):
    """The result is that of a left join, whichever keys count as hot; hot keys without a match give nulls."""
    left = spark.createDataFrame([(i % 9, str(i % 2), i) for i in range(60)], "k long, s string, `odd.name` long")
    right = spark.createDataFrame([(k, s, 10 * k) for k in range(7) for s in "01"], "k long, s string, v long")
    some = spark.createDataFrame([(k, s) for k in hot for s in "01"], "k long, s string").join(right, ["k", "s"], "left")
    got = join_spread(left, right, ["k", "s"], some, [F.col("`odd.name`")])
    want = [(i % 9, str(i % 2), i, 10 * (i % 9) if i % 9 < 7 else None) for i in range(60)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_line_dedup(docs, corpus):
    keep = {}
    held = defaultdict(set)
    low = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\f\r"))
    ids = [(-1 if d is None else d, t or "") for d, t, _ in corpus]
    for d, t in ids:
        for x in t.split("\n"):
            held[low(x)].add(d)
    for k, ds in held.items():
        if len(k) >= 20 and len(ds) >= 3:
            keep[k] = max(ds)
    want = []
    for d, t in ids:
        lines = t.split("\n")
        left = [x for x in lines if keep.get(low(x), d) == d]
        want.append((d, "\n".join(left), len(lines), len(lines) - len(left)))
    got = [(-1 if r.doc_id is None else r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(docs).collect()]
    assert sorted(got) == sorted(want)


def test_decontaminate(spark, docs, corpus):
    items = [(1, corpus[0][1][-300:].upper()), (2, "too short"), (6, "A!"), (7, " ,"), (3, None), (4, " ".join(WORDS[:30])), (5, corpus[12][1]), (1, corpus[0][1][-300:])]

    def shingles(t):
        ws = re.findall(r"[^\W_]+", (t or "").lower())
        return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()

    want = set()
    for d, t, _ in corpus:
        for i, x in items:
            s = shingles(x)
            if s and len(s & shingles(t)) >= 0.8 * len(s):
                want.add((d, i, len(s & shingles(t)), len(s)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.leaks(docs, bench).collect()
    assert {(None if r.did == -(2**63) else r.did, r.iid, r.n_shared, r.n_shingles) for r in got} == want and want
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(d) for d, _, _ in corpus if d not in {w[0] for w in want})


def test_decontaminate_null_and_equal_item_ids(spark):
    rng = random.Random(3)
    a, b, c = (words(rng, 30) for _ in range(3))
    items = spark.createDataFrame([(None, a), (None, b), (7, b), (7, c), (7, c)], "item_id long, text string")
    df = spark.createDataFrame([(1, f"x {a} y"), (2, b), (3, f"{c} z"), (4, words(rng, 40)), (None, a)], "doc_id long, text string")
    got = sorted((r.did, repr(r.iid), r.n_shared) for r in decontaminate.leaks(df, items).collect())
    assert got == sorted([(1, "None", 26), (2, "None", 26), (2, "7", 26), (3, "7", 26), (-(2**63), "None", 26)])
    assert sorted(repr(r) for r in decontaminate.leaks(df, items, broadcast_rows=0).select("did", "iid").collect()) == sorted(repr(r) for r in decontaminate.leaks(df, items).select("did", "iid").collect())
    assert [r.doc_id for r in decontaminate.clean(df, items).collect()] == [4]


def test_bpe_finds_its_column_in_any_case(spark):
    df = spark.createDataFrame([(1, "hello there", "tail"), (2, None, "x")], "doc_id long, Text string, tail string")
    tok = bpe.tokenizer(bpe.default_path())
    got = bpe.encode(df)
    assert {r.doc_id: r.decoded for r in got.collect()} == {1: tok.decode(np.frombuffer(tok.encode("hello there"), "<u4").tolist()), 2: ""}
    again = bpe.decode(got.drop("decoded").withColumnRenamed("token_ids", "Token_Ids").withColumn("last", F.array(F.lit(5))))
    assert {r.doc_id: r.decoded for r in again.collect()} == {r.doc_id: r.decoded for r in got.collect()}


def test_empty_tables_and_clashing_names(spark):
    clash = "doc_id long, text string, source string, did string, t1 int, t int, h int, row string, n_lines string, fp string, cuts int, n_words string, kept string"
    empty = spark.createDataFrame([], clash)
    one = spark.createDataFrame([(1, "a b c d e f\n" * 30, "s", "x", 1, 2, 3, "r", "n", "f", 4, "w", "k"), (2, None, None, *[None] * 10)], clash)
    for df, n in ((empty, 0), (one, 2)):
        assert line_dedup.dedup_lines(df).count() == n
        assert quality.judge(df).count() == n
        assert simhash.near_duplicates(df).count() == n
        assert suffix_dedup.dedup_substrings(df).count() == n
        assert license_scan.scan_licenses(df).count() == n
        assert bpe.encode(df).count() == n
        assert decontaminate.clean(df, spark.createDataFrame([], "item_id long, text string")).count() == n
        assert chaining.shared_passages(df).count() == 0
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string, path int")).count() == 0
    assert quality.clean(empty).count() == 0


def test_token_files_of_nothing_and_clashing_names(spark, tmp_path):
    odd = "doc_id long, text string, file int, nth string, start int, block int"
    for i, (rows, want) in enumerate((([], []), ([(1, "a b", 1, "x", 2, 3), (1, None, *[None] * 4), (None, "", 1, "x", 2, 3)], [(1, 2), (1, 0), (None, 0)]))):
        folder = f"file://{tmp_path}/{i}"
        (tmp_path / str(i)).mkdir()
        manifest = token_counts.write_token_files(spark.createDataFrame(rows, odd), folder)
        got = manifest.join(token_counts.token_counts(spark, folder), ["file", "nth"]).collect()
        assert sorted((repr(r.doc_id), r.n_tokens) for r in got) == sorted((repr(d), n) for d, n in want)
    with pytest.raises(Exception, match="separator"):
        token_counts.write_token_files(spark.createDataFrame([(1, "a b", 1, "x", 2, 3)], odd), folder, dtype="u1", separator=7)


def test_names_without_case(spark):
    """Columns named as an operator's own, in other case too, clash with nothing."""
    df = spark.createDataFrame([(1, "a b c", 1, 2, 3, 4, 5), (2, "a b c", 1, 2, 3, 4, 5)], "doc_id long, text string, _hot int, FP int, Component_ID int, _text int, t1 int")
    got = simhash.near_duplicates(df).collect()
    assert [(r.doc_id, r._hot, r._text, r.t1, r.component_id) for r in sorted(got)] == [(1, 1, 4, 5, 1), (2, 1, 4, 5, 1)]
    odd = spark.createDataFrame([(1, "cc by", 4, 5, 6)], "doc_id long, text string, _scanned int, row int, N_Words int")
    assert [(r._scanned, r.row, r.n_words, r.base_labels) for r in license_scan.scan_licenses(odd).collect()] == [(4, 5, 2, "cc-by")]
    assert [(r._scanned, r.n_tokens) for r in bpe.encode(odd.withColumn("N_Tokens", F.lit("x"))).collect()] == [(4, 2)]
    host = spark.createDataFrame([(1, "a b c", "h", 7, 8, 9)], "doc_id long, text string, source string, HOST int, f_n_words int, Gone int")
    assert [(r.HOST, r.f_n_words, r.Gone, r.n_words) for r in quality.judge(host).collect()] == [(7, 8, 9, 3)]


def test_pipeline_near_copies(spark, sf):
    """Of copies with edited words one stays if five-word shingles are alike by 0.8, both if not; against brute force."""
    import corpus_pipeline

    rng = random.Random(31)
    rows = []
    for n, edits in [(100, 1), (100, 2), (100, 4), (300, 2), (300, 4), (300, 6), (300, 12), (1000, 5), (1000, 20), (1000, 40)] * 4:
        t = words(rng, n).split(" ")
        copy = list(t)
        for x in rng.sample(range(n), edits):
            copy[x] = f"z{x}"
        rows += [(len(rows), " ".join(t)), (len(rows) + 1, " ".join(copy))]
    sets = [{tuple(t.split(" ")[i : i + 5]) for i in range(len(t.split(" ")) - 4)} for _, t in rows]
    alike = {i + 1 for i in range(0, len(rows), 2) if len(sets[i] & sets[i + 1]) >= 0.8 * len(sets[i] | sets[i + 1])}
    left = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf)
    assert {r.doc_id for r in left.collect()} == set(range(len(rows))) - alike and 20 <= len(alike) < 40
    many = [(i, " ".join(f"z{i}" if k == 7 + i % 300 else f"m{k}" for k in range(300))) for i in range(100)]
    assert [r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(many, "doc_id long, text string"), sf).collect()] == [0]


def test_near_copies_in_large_families(spark):
    """Recall of links alike by 0.8 in families whose bands hold far more texts than are compared with each other."""
    rng = random.Random(33)
    texts = []
    for g, (size, edits) in enumerate([(120, 1), (160, 2), (200, 3)]):
        body = [f"f{g}w{k}" for k in range(220)]
        made = [body]
        for _ in range(size - 1):  # copies of copies
            t = list(rng.choice(made))
            for x in rng.sample(range(220), edits):
                t[x] = f"e{rng.randrange(10**9)}"
            made.append(t)
        texts += made
    sets = [{hash(tuple(t[i : i + 5])) for i in range(len(t) - 4)} for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if (n := len(sets[i] & sets[j])) >= 0.8 * (len(sets[i]) + len(sets[j]) - n)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    group = {r.doc_id: r.component for r in simhash.near_duplicates(df, width=5, similarity=0.8).collect()}
    held = sum(group[i] == group[j] for i, j in links)
    print(f"{held} of {len(links)} links")
    assert len(links) > 300 and held >= 0.99 * len(links)
    root = list(range(len(texts)))
    for _ in range(60):
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
    assert all(root[i] == root[j] for i in range(len(texts)) for j in range(i) if group[i] == group[j])


def test_pipeline_stages(spark, docs, sf):
    import corpus_pipeline

    full = docs.withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long")}).select("doc_id", "text", "lang", "source", "n_chars")
    judged = corpus_pipeline.quality_stage(spark, full, sf)
    assert judged.columns == full.columns and judged.count() == quality.judge(docs).filter("kept").count()
    assert all(r.n_chars == len(r.text) for r in judged.collect())
    lines = corpus_pipeline.line_stage(spark, full, sf)
    assert lines.columns == full.columns and lines.count() == full.count()
    near = corpus_pipeline.near_duplicate_stage(spark, full, sf)
    groups = {r.component_id for r in simhash.near_duplicates(docs).collect() if r.component_id is not None}
    assert near.columns == full.columns and {r.doc_id for r in near.collect()} >= groups and near.count() <= len(groups) + 2
    assert corpus_pipeline.benchmark_stage(spark, full, sf).columns == full.columns
    assert corpus_pipeline.token_stage(spark, full, sf).columns == [*full.columns, "n_tokens", "token_ids", "decoded"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "BPE encoding and decoding"]


def test_pipeline_brute_force(spark, tmp_path):
    """run() over a small table against each stage in plain Python."""
    from tokenizers import Tokenizer

    import corpus_pipeline

    rng = random.Random(41)
    footer, item = [words(rng, 30), words(rng, 25)], words(rng, 40)
    texts = ["\n".join(words(rng, rng.randrange(20, 60)) for _ in range(rng.randrange(2, 7))) for _ in range(90)]
    for i in range(0, 36, 3):
        texts[i] += "\n" + "\n".join(footer)
    texts += [f"{words(rng, 12)}\n" + "\n".join(footer) for _ in range(15)]  # little but the footer
    common = words(rng, 9)
    for i in (40, 50, 60, 70):
        texts[i] = common + "\n" + texts[i]
    for i in (5, 7, 9):
        t = texts[i].split(" ")
        texts += [texts[i], " ".join(w if k != 11 else "changed" for k, w in enumerate(t))]
    texts[20] += f"\n{words(rng, 30)} {item.upper()} {words(rng, 30)}"
    texts += ["too short", "", None, " ".join(["spam spam spam"] * 40)]
    rows = [(i, t, "en", "h") for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, words(rng, 40))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted((r.doc_id, r.text, r.n_chars, r.n_tokens, list(r.token_ids), r.decoded) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())

    docs = {i: t or "" for i, t, _, _ in rows}
    # quality: lines of over a hundredth of the distinct texts, ten at least, go; then what is short, repetitive or depleted
    norm = lambda x: " ".join(x.lower().split())
    held = Counter(h for t in set(docs.values()) for h in {norm(x) for x in t.split("\n")} - {""})
    often = {h for h, n in held.items() if n >= 10 and n > 0.01 * len(set(docs.values()))}
    assert often == {norm(x) for x in footer}
    kept = {}
    for i, t in docs.items():
        ws = t.split()
        win = Counter(tuple(ws[k : k + 3]) for k in range(len(ws) - 2))
        inside = {k + d for k in range(len(ws) - 2) if win[tuple(ws[k : k + 3])] > 1 for d in range(3)}
        gone = sum(len(x.split()) for x in t.split("\n") if norm(x) in often)
        if len(ws) >= 50 and 100 * len(inside) <= 50 * len(ws) and len(ws) - gone >= 0.3 * len(ws):
            kept[i] = "\n".join(x for x in t.split("\n") if norm(x) not in often)
    assert not set(range(90, 105)) & set(kept)
    # line dedup: a line of three documents stays in the last
    keep = defaultdict(set)
    for i, t in kept.items():
        for x in t.split("\n"):
            if len(x.strip()) >= 20:
                keep[x.strip().lower()].add(i)
    lined = {i: "\n".join(x for x in t.split("\n") if len(keep[x.strip().lower()]) < 3 or i == max(keep[x.strip().lower()])) for i, t in kept.items()}
    assert lined != kept
    # near duplicates: the first of each group of texts whose five-word shingles are alike by 0.8
    sets = {i: {tuple(t.lower().split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in lined.items()}
    root = {i: i for i in lined}
    for i in sorted(lined):
        for j in sorted(lined):
            if j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = {k: min(a, b) if r in (a, b) else r for k, r in root.items()}
    near = {i: t for i, t in lined.items() if root[i] == i}
    assert len(near) < len(lined)
    # decontamination
    grams = lambda t: {tuple(w[k : k + 5]) for w in [re.findall(r"[^\W_]+", t.lower())] for k in range(len(w) - 4)}
    clean = {i: t for i, t in near.items() if len(grams(item) & grams(t)) < 0.8 * len(grams(item))}
    assert set(near) - set(clean) == {20}
    ref = Tokenizer.from_file(bpe.default_path())
    ref.no_padding()
    ref.no_truncation()
    want = []
    for i, t in sorted(clean.items()):
        ids = ref.encode(t, add_special_tokens=False).ids
        want.append((i, t, len(t), len(ids), ids, ref.decode(ids, skip_special_tokens=False)))
    assert got == want
