"""Lexical search, MaxScore and the conversation trie against brute force, with edge cases."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakestrata.llm import burst_trie, lexical_search, maxscore_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = {a: a + 32 for a in range(65, 91)}


# --- lexical search ---------------------------------------------------------------------

def brute_rank(docs, items, k=10):
    held = [(d, Counter(TERM.findall((t or "").translate(FOLD)))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, length = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in held:
            m = 10 + (90 * c.total() * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(TERM.findall((text or "").translate(FOLD))) if t in c)
            if s > 0:
                found.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(found)[:k])]
    return out


def ranked(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, "x", "y") for r in docs], "doc_id long, text string, rank string, `ids` string")
    i = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, terms string")
    return sorted((tuple(r) for r in lexical_search.rank_documents(d, i, **options).collect()), key=str)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "日本語", "don't"]
    weights = 1 / np.arange(1, len(words) + 1)
    draw = lambda n: " ".join(rng.choice(words, n, p=weights / weights.sum()))
    docs = [(i, draw(int(rng.integers(1, 60)))) for i in range(700)]
    docs += [(1000 + i, docs[3][1]) for i in range(300)]  # copies tie
    docs += [(3, docs[3][1]), (None, docs[5][1]), (None, None), (2000, None), (2001, ""), (2002, " .,;\x00 "), (2003, "W1 w1 W2! " * 40_000), (2004, "語" * 700_000 + " w7")]
    return docs, [(i, draw(12)) for i in range(15)] + [(7, "w1 w2"), (None, "w3 W3 w3"), (90, None), (91, ""), (92, "nowhere"), (93, "日本語 Ünï ÜNÏ")]


@pytest.mark.parametrize("options", [{}, {"shard_docs": 40}, {"max_vocabulary": 3}, {"block_terms": 20, "shard_docs": 300}, {"k": 1}])
def test_ranked_search(spark, texts, options):
    docs, items = texts
    assert ranked(spark, docs, items, **options) == sorted(brute_rank(docs, items, options.get("k", 10)), key=str)


def test_ranked_search_of_nothing(spark, texts):
    docs, items = texts
    assert ranked(spark, [], items) == [] and ranked(spark, docs, []) == [] and ranked(spark, [(1, None), (2, "..")], items) == []


def test_terms_are_cut_between_pieces(monkeypatch):
    text = ("Ab, cd-ü 日本語 " * 50 + "x" * 300 + " end").encode()
    whole = [t for p in lexical_search.terms(text) for t in p]
    monkeypatch.setattr(lexical_search, "PIECE", 7)
    assert [t for p in lexical_search.terms(text) for t in p] == whole == [t.encode() for t in TERM.findall(text.decode().translate(FOLD))]


# --- MaxScore ---------------------------------------------------------------------------

def brute_products(rows, k, every, scale=256):
    fine = [(i, n, [math.floor(scale * x) for x in v]) for n, (i, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, n, q in fine:
        if i is not None and i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), j is None, j or 0) for j, m, v in fine if m != n)
            out += [(i, r + 1, None if null else j, -s) for r, (s, null, j) in enumerate(found[:k])]
    return sorted(out, key=str)


def products(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, rank string, `row` int")
    return sorted((tuple(r) for r in maxscore_search.top_inner_products(df, **options).collect()), key=str)


@pytest.mark.parametrize("options", [{"shard_rows": 64}, {"shard_rows": 4096, "k": 3}, {"block_values": 40, "shard_rows": 200}])
def test_inner_products(spark, options):
    rng = np.random.default_rng(9)
    near = rng.normal(size=8)
    rows = [(i, [*map(float, rng.normal(size=8) * (rng.random(8) < 0.6))]) for i in range(3000)]
    rows += [(4000 + i, [*map(float, near)]) for i in range(900)]  # copies tie
    rows += [(10, rows[3][1]), (None, [9.0] * 8), (20, [1.0, -2.0]), (30, []), (40, [0.0] * 8), (50, None), (60, [float("nan")] * 8), (70, [float("inf")] + [0.0] * 7), (80, [None, 1.0])]
    k = options.get("k", 5)
    assert products(spark, rows, query_every=250, **options) == brute_products(rows, k, 250)


def test_few_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, [-1.0, -1.0]), (2, [-3.0, 0.5])]
    assert products(spark, rows) == brute_products(rows, 5, 50) and products(spark, rows[:1]) == [] and products(spark, []) == []
    assert products(spark, rows[1:], query_every=1) == brute_products(rows[1:], 5, 1)  # all scores negative or not, all candidates


# --- trie -------------------------------------------------------------------------------

def turn_key(role, text):
    return hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()


def brute_trie(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, turn_key(role, text), len((text or "").encode())))
    turns = {c: [(k, n) for _, _, k, n in sorted(x)] for c, x in turns.items()}
    seqs = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        seqs[c] = turns.get(c - math.trunc(math.fmod(c, 5)), [])[:h] + own[h:]
    node, kids, leaves, saved = defaultdict(list), defaultdict(list), {}, {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            node[tuple(s[:d])].append(c)
    for p in node:
        if p:
            kids[p[:-1]].append(p)
    for p in sorted(node, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(node[p]) - 1) * p[-1][1] if p else 0)
    ends = lambda p: ",".join(str(c) for c in sorted(node[p]) if len(seqs[c]) == len(p))
    return sorted(((min(m), len(p), min(node[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends(p).encode()).hexdigest())
                   for p, m in node.items()), key=str)


def trie(spark, rows, cap):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, conv string, pos int")
    return sorted((tuple(r) for r in burst_trie.prefix_trie(burst_trie.rebuilt_turns(burst_trie.turn_rows(df)), cap).collect()), key=str)


@pytest.fixture(scope="module")
def talks():
    rng = np.random.default_rng(3)
    rows = []
    for c in range(-7, 160):
        shared = c % 3 == 0  # a third starts alike
        for t in range(int(rng.integers(1, 10))):
            rows.append((c, t, "user" if t % 2 else "assistant", f"same {t}" if shared and t < 5 else f"says {rng.integers(0, 3)}"))
    rows += [(1000 + c, t, "user", f"copy {t}") for c in range(120) for t in range(4)]
    rows += [(c, t, "user", f"long {t}") for c in (2005, 2010) for t in range(600)]  # long and alike
    rows += [(3000, None, "user", "first"), (3000, 0, None, None), (3000, 0, None, None), (3000, 0, "user", ""), (3000, -1, "", "user"),
             (None, 1, "user", "of nobody"), (None, None, None, None), (3003, 1, "a", "ü語" * 50_000), (3004, 1, "a", None), (3011, 7, "u", "alone")]
    return rows


@pytest.mark.parametrize("cap", [16_384, 200, 7, 1])
def test_trie(spark, talks, cap):
    rows = talks if cap > 100 else [r for r in talks if r[0] is None or r[0] < 12]
    assert trie(spark, rows, cap) == brute_trie(rows)


def test_trie_of_few(spark):
    assert trie(spark, [], 10) == [] and trie(spark, [(None, 1, "a", "b")], 10) == []
    one = [(4, 1, "a", "b")]
    assert trie(spark, one, 1) == brute_trie(one)  # its first turns are borrowed from a conversation that is not there


def test_hash_members_joins_pieces(spark):
    ends = spark.createDataFrame([(1, 2, c) for c in range(-5, 400)] + [(1, 3, 9)], "hc long, e long, conv long")
    got = {(r.hc, r.e): r.sha for r in burst_trie.hash_members(ends, piece=20).collect()}
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got == {(1, 2): sha(range(-5, 400)), (1, 3): sha([9])}
