"""Decision lists, histogram sort, Jaccard join, mixing and byte-level BPE against brute force and edge cases."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import byte_bpe, decision_list, histogram_sort, jaccard_join, mixing
from lakestrata.llm.queries import tokenizer_files

SF = "/root/testdata/sf0.001"
EDGE = "doc_id long, text string, lang string, source string, n_chars long, n_words long, size long, shard int, ids string, epoch int"


def words(t):
    return re.findall(r"[^\x20\x09-\x0d]+", t or "")


def edge_rows():
    rng = random.Random(4)
    base = " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) + str(rng.randint(0, 40)) for _ in range(120))
    near = base.replace(base.split()[60], "changed", 1)
    texts = [None, "", "  \n\t ", "one", "Two words", "two  WORDS", base, base, near, base.upper(), "x " * 40, "same line\nsame line\n\nother",
             "héllo   wörld\u00a0 \n\n  emoji 😀😀 \r\n tab\tend ", base + "\n" + base, "z" * 50_000, "a b c d e " * 4000]
    rows = [(k, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", None, 7, 7, 7, "clash", 7) for k, t in enumerate(texts)]
    return rows + [rows[6], (None, base, "en", "s1", 1, 1, 1, 1, "x", 1), (None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), EDGE)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], EDGE)


def stats(t):
    w = words(t)
    seen, dup, cov = set(), 0, set()
    for line in (t or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    c = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    for i in range(len(w) - 2):
        if c[tuple(w[i : i + 3])] > 1:
            cov |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(cov)


def test_statistics_match_brute_force(edge, spark):
    for df in (edge, spark.read.parquet(f"{SF}/documents.parquet")):
        rows = decision_list.text_statistics(df, drop_text=False).collect()
        assert len(rows) == df.count()
        for r in rows:
            s = stats(r.text)
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == s
            assert r.base_failed == (s[0] < 50 or 100 * s[4] > 50 * s[0])


def test_decision_list_learns_and_keeps(spark, edge, empty):
    rows = [(bool(k % 4 == 0), k % 3, float(k % 4 == 0) * 2 + (k % 7) / 10, float(k % 11)) for k in range(600)]
    sample = spark.createDataFrame(rows, "target boolean, part int, a double, b double")
    rules = decision_list.learn_decision_list(sample, ["a", "b"]).rules
    assert [c.feature for c in rules[0].conditions] == ["a"] and 0.6 < rules[0].conditions[0].threshold <= 2
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (None, 0, 0), (6, None, 1)], "doc_id long, quality int, toxic int")
    out, learned = decision_list.quality_rules(edge, labels)
    assert out.count() == edge.count() and not learned.rules
    assert out.where("kept = base_failed").count() == 0
    assert decision_list.quality_rules(empty, labels.limit(0))[0].count() == 0


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out, learned = decision_list.quality_rules(docs, labels.where("doc_id % 2 = 0"))
    assert learned.rules
    held = out.join(labels.where("doc_id % 2 = 1"), "doc_id").where("NOT base_failed")
    assert held.where("kept AND quality = 0").count() == 0 and held.where("NOT kept AND quality = 1").count() == 0


def test_histogram_sort(spark, edge, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    hot = docs.where("doc_id < 10").select("doc_id", F.lit("copy of one text " * 20).alias("text"))
    hot = hot.select("doc_id", "text", F.explode(F.sequence(F.lit(1), F.lit(100))).alias("k")).selectExpr("doc_id * 1000 + k AS doc_id", "text")
    rows = histogram_sort.shard_by_bytes(docs.union(hot), 8, range_bytes=50_000).collect()
    by = collections.defaultdict(list)
    for r in rows:
        assert r.size == len((r.text or "").encode()) + 16
        by[r.shard].append(r)
    sizes = {s: sum(r.size for r in x) for s, x in by.items()}
    mean = sum(sizes.values()) / 8
    assert set(by) == set(range(8)) and max(abs(v - mean) for v in sizes.values()) <= 2 * max(r.size for r in rows)
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
    out = histogram_sort.shard_by_bytes(edge, 3)
    assert out.count() == edge.count() and out.columns.count("size") == 1
    assert histogram_sort.shard_by_bytes(empty, 3).count() == 0


def test_shards_hold_when_one_row_is_a_third_of_all(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('text ', id, repeat(' w', cast(id % 40 AS int))) AS text")
    again = spark.range(1000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'one text that stands a thousand times' AS text")
    rows = histogram_sort.shard_by_bytes(docs.union(again), 40, range_bytes=20_000).collect()
    sizes = collections.Counter()
    slots = collections.defaultdict(list)
    for r in rows:
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    mean = sum(sizes.values()) / 40
    assert len(rows) == 3000 and len(sizes) == 40 and max(abs(v - mean) for v in sizes.values()) <= 2 * max(r["size"] for r in rows) + 0.02 * mean
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def brute_groups(docs):
    sets = []
    for _, t in docs:
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(docs)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    inverted = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for j, n in collections.Counter(j for x in s for j in inverted[x]).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                up[find(i)] = find(j)
        for x in s:
            inverted[x].append(i)
    members = collections.defaultdict(list)
    for i in range(len(docs)):
        members[find(i)].append(i)
    least = {r: min((docs[i][0] for i in m if docs[i][0] is not None), default=None) for r, m in members.items()}
    return sorted(((docs[i][0], len(sets[i]), least[find(i)]) for i in range(len(docs))), key=str)


def test_jaccard_groups_match_brute_force(spark, edge):
    rng = random.Random(8)
    passage = " ".join(f"p{k}" for k in range(80))
    made = []
    for k in range(60):  # a large group of near copies, and texts that mostly share one passage
        w = [f"w{i}" for i in range(100)]
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(100)] = f"n{rng.randint(0, 9)}"
        made.append((100 + k, " ".join(w)))
        made.append((300 + k, passage + " " + " ".join(f"u{k}x{i}" for i in range(rng.randint(0, 40)))))
    for df in (spark.createDataFrame(made, "doc_id long, text string"), edge):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        got = sorted((tuple(r) for r in jaccard_join.linked_groups(df).collect()), key=str)
        assert got == brute_groups(rows)


def test_jaccard_links_that_share_few_rare_shingles(spark):
    body = " ".join(f"b{k}" for k in range(79))  # 75 shingles, hot by its copies
    made = [(k, body) for k in range(1000)]
    for k, rare in enumerate((1, 2, 3, 4, 3)):  # y: the body and a few own shingles; x: y and about a third of own text
        y = body + "".join(f" y{k}x{i}" for i in range(rare))
        n = 75 + rare
        made += [(5000 + k, y), (6000 + k, y + "".join(f" x{k}x{i}" for i in range(n * 100 // 75 - n - (k == 4) * 2)))]
    got = sorted((tuple(r) for r in jaccard_join.linked_groups(spark.createDataFrame(made, "doc_id long, text string")).collect()), key=str)
    assert got == brute_groups(made)


def test_jaccard_of_nothing(spark, empty):
    assert jaccard_join.linked_groups(empty).count() == 0
    one = spark.createDataFrame([(1, None), (2, ""), (3, "all alone here")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard_join.linked_groups(one).collect())) == [(1, 0, 1), (2, 0, 2), (3, 1, 3)]
    copies = spark.createDataFrame([(5, "a b c d e f g"), (4, "A b  c d e f G"), (9, "else")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard_join.linked_groups(copies).collect())) == [(4, 3, 4), (5, 3, 4), (9, 1, 9)]


def test_prefixes_never_lose_a_partner():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        drop = int(rng.integers(0, len(x) // 4 + 1))
        y = np.unique(np.concatenate([x[drop:], rng.integers(0, 1 << 63, int(rng.integers(0, 3))).astype(np.uint64)]))
        inter = len(np.intersect1d(x, y))
        if 100 * inter < 75 * (len(x) + len(y) - inter):
            continue
        excess = np.zeros(jaccard_join.SLOTS << jaccard_join.SLOT_BITS, np.float32)
        every = (np.concatenate([x, y]) >> np.uint64(64 - jaccard_join.SLOT_BITS - 7)).astype(np.int64)
        excess[rng.choice(every, len(every) // 2)] = rng.integers(1, 5000)
        (px, lx, nx), (py, ly, ny) = (jaccard_join.prefix_of(s, excess, 75) for s in (x, y))
        need = min(nx, ny)
        assert len(set(px[lx <= need].tolist()) & set(py[ly <= need].tolist())) >= need


def test_mixing(spark, edge, empty):
    tokens = [1000, 100, 10]
    for limit in (1.0, 2.0, 50.0):
        w = mixing.tempered(tokens, mixing.solve_exponent(tokens, max_repetition=limit))
        assert mixing.repetition(tokens, w) <= limit + 1e-6
    x = mixing.solve_exponent(tokens, target_entropy=0.9)
    assert abs(mixing.entropy(mixing.tempered(tokens, x)) - 0.9) < 1e-6
    docs = spark.range(6000).selectExpr("id doc_id", "CASE WHEN id % 10 < 7 THEN 'big' WHEN id % 10 < 9 THEN 'mid' ELSE 'small' END source", "repeat('w ', 20) text")
    out, _, plans = mixing.mix_sources(docs, max_repetition=3.0)
    by = {r.source: r for r in out.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count_distinct("doc_id").alias("d")).collect()}
    assert sum(r.d for r in by.values()) == 6000  # everything at least once
    for p in plans:
        assert p.budget - 20 < by[p.source].t <= p.budget
    assert out.groupBy("doc_id", "epoch").count().where("count > 1").count() == 0
    half, _, plans = mixing.mix_sources(docs, target_entropy=1.0, budget=60_000)
    assert sum(p.budget for p in plans) - 61 < half.agg(F.sum("n_tokens")).first()[0] <= 60_001
    out, _, _ = mixing.mix_sources(edge, max_repetition=1.5)
    assert out.select("text", "doc_id").distinct().count() == edge.select("text", "doc_id").distinct().count()
    assert mixing.mix_sources(empty)[0].count() == 0


def test_bpe_round_trip(spark, edge, empty):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = tokenizer_files()
    ranks = byte_bpe.read_ranks(path)
    plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    extra = spark.createDataFrame([(50, "a   b \n  c\n\n d <|endoftext|> \u2003 x  "), (51, " lead"), (52, "trail "), (53, "it's  1234'll"), (54, " "), (55, "   ")], "doc_id long, text string")
    for df in (edge, extra, spark.read.parquet(f"{SF}/documents.parquet")):
        coded = byte_bpe.encode(df, ranks, pattern, keep_text=True)
        for r in byte_bpe.decode(coded, ranks).collect():
            want = plain.encode_ordinary(r.text or "")
            assert byte_bpe.unpack(bytes(r.ids)) == want and r.n_tokens == len(want)
            assert bytes(r.decoded) == (r.text or "").encode()
    assert byte_bpe.decode(byte_bpe.encode(empty, ranks, pattern), ranks).count() == 0
    back = byte_bpe.decode(byte_bpe.encode(extra, ranks, pattern, keep_text=True, offsets=True), ranks, as_text=True)
    for r in back.collect():
        assert r.decoded == r.text and len(r.offsets) == r.n_tokens and all(0 <= o.start <= o.end <= len(r.text) for o in r.offsets)


def test_split_characters():
    path, _ = tokenizer_files()
    ranks = byte_bpe.read_ranks(path)
    table = [b""] * len(ranks)
    for t, k in ranks.items():
        table[k] = t
    ids = [ranks[bytes([b])] for b in "é😀x".encode()]
    assert list(byte_bpe.decode_pieces(ids, table)) == ["", "é", "", "", "", "😀", "x", ""]
    assert "".join(byte_bpe.decode_pieces(ids[:3], table)) == "é\ufffd"


def test_crc_and_digest_columns(spark):
    from lakestrata.llm.queries import op4_histogram_sort

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op4_histogram_sort(spark, SF).collect():
        assert r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.law == "bytes" and 0 <= r.shard < 40
    assert hashlib.sha256(b"").hexdigest()[:4] == "e3b0"


def test_encoder_holds_a_bounded_number_of_bytes(monkeypatch):
    path, pattern = tokenizer_files()
    ranks = byte_bpe.read_ranks(path)
    encoder = byte_bpe.Encoder(ranks, pattern)
    monkeypatch.setattr(byte_bpe, "CACHE", 200_000)
    rng = np.random.default_rng(1)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9000, 4000))) + " tail" for _ in range(30)]  # no spaces: long pieces
    texts += [" ".join(f"w{rng.integers(1 << 40)}" for _ in range(300)) for _ in range(30)]  # pieces that don't come back
    plain = [byte_bpe.pack(e.ids) for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for text, ids in zip(texts, plain, strict=True):
        assert encoder.encode([text, None, "the common words of every text"])[0] == ids
        assert encoder.held <= 200_000 and all(len(p) <= byte_bpe.LONG for p in encoder.known)
        assert encoder.held == sum(map(encoder._size, encoder.known))
    encoder.forget()
    assert not encoder.known and not encoder.held


def test_mixing_spreads_null_and_repeated_ids(spark):
    for ids in ([None] * 1000, [7] * 1000, list(range(1000))):
        docs = spark.createDataFrame([(i, "ten words " * 5, "s") for i in ids], "doc_id long, text string, source string")
        out, _, plans = mixing.mix_sources(docs, budget=5000)
        assert 4990 <= out.agg(F.sum("n_tokens")).first()[0] <= 5000 and plans[0].budget == 5000
        out, _, _ = mixing.mix_sources(docs, budget=25_000)
        assert 24_990 <= out.agg(F.sum("n_tokens")).first()[0] <= 25_000 and {r.epoch for r in out.select("epoch").distinct().collect()} == {0, 1, 2}
    whole = mixing.mix_sources(docs, max_repetition=2.0, keep_text=False)[0]
    assert "text" not in whole.columns and whole.count() == 1000


def test_mix_of_plain_shares(spark):
    """Against the plan's own arithmetic, worked out plainly: weights, budgets and rows of each source."""
    sizes = {"a": 300, "b": 100, None: 40}
    docs = spark.createDataFrame([(k, "w " * 5, s) for s, n in sizes.items() for k in range(n)], "doc_id long, text string, source string")
    out, exponent, plans = mixing.mix_sources(docs, target_entropy=1.0, budget=3000)
    total = sum(5 * n for n in sizes.values())
    raised = {s: (5 * n / total) ** exponent for s, n in sizes.items()}
    weights = {s: r / sum(raised.values()) for s, r in raised.items()}
    assert abs(-sum(w * np.log(w) for w in weights.values()) - 1.0) < 1e-6
    rows = {r.source: r.n for r in out.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    for s, w in weights.items():
        assert abs(next(p.weight for p in plans if p.source == s) - w) < 1e-9 and 0 <= round(3000 * w) - rows[s] < 5
    once = out.groupBy("source", "doc_id", "epoch").count().where("count > 1")
    assert once.isEmpty()
