"""HTML extraction, vectors, transcripts, URLs and archives: brute force, held-out accuracy and edge cases."""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import ann_partitions, html_template, transcripts, url_gbt, warc

SF = "/root/testdata/sf0.01"
PAGE = "page_id long, url string, html string, host string, text string, verdict string"


@pytest.fixture(scope="module")
def edge(spark):
    page = ("<html><head><title>t</title></head><body><header>top</header><nav><a href=x>menu</a></nav><main><h1>Ti&amp;tle</h1><p>one <b>two</b><br>three"
            "<p>last&nbsp;one<script>var x='</p>'</script></main><aside>side</aside><div class='comments'><p>said</p></div><footer>foot</footer>")
    rows = [(k, u, h, "clash", "clash", "clash") for k, (u, h) in enumerate([
        ("http://a.org/1", page), ("http://a.org/2", page), (None, None), ("", ""), ("no scheme", "just text"), ("HTTP://U@Ex.COM:80?q#f", "<p>unclosed <"),
        ("https://sub.example.org/es/x", "<div><p>" + "long " * 200_000), ("x://example.org/en/1", "<!-- open"), ("x://www.com/de/?a=1&b=2", "\x00 <b>ü</b>"),
        ("x://notexample.org/es/", page)])]
    return spark.createDataFrame([*rows, rows[0], (None, "http://z.net/", page, None, None, None), (None, None, None, None, None, None)], PAGE)


def test_main_text(spark, edge):
    rows = html_template.extract_main_text(edge).collect()
    assert len(rows) == edge.count() and all(r.n_chars == len(r.text) for r in rows)
    texts = {r.page_id: r.text for r in rows}
    assert texts[0] == texts[9] == "Ti&tle\none two three\nlast one" and texts[2] == texts[3] == "" and texts[4] == "just text"
    assert len(texts[6]) == 999_999
    assert html_template.extract_main_text(edge.limit(0)).count() == 0


def test_main_text_of_all_pages(spark):
    def plain(page):
        inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        blocks = re.sub(r"<[^>]*>", " ", re.sub(r"</?(?:h1|p)>", "\x00", inner)).split("\x00")
        return "\n".join(x for x in (" ".join(entities.unescape(b).split()) for b in blocks) if x)

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in html_template.extract_main_text(spark.read.parquet(f"{SF}/pages.parquet")).collect():
        assert r.text == plain(pages[r.page_id])


def test_template_drops_text_that_all_pages_share(spark):
    page = "<body><div><p>Welcome to our site</p></div><div><h2>News</h2><p>{}</p><p>{}</p></div><div><p>Call us now</p></div></body>"
    rows = [(k, "http://h.net/", page.format(f"story {k} about things", f"more of {k}")) for k in range(9)]
    out = html_template.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in out} == {k: f"story {k} about things\nmore of {k}" for k in range(9)}


def test_copies_without_main_element_keep_their_text(spark):
    page = "<body><div><p>Welcome to our site</p></div><div class='ad'>buy {}</div><div><h2>{}</h2><p>{}</p><p>{}</p></div><div><p>Call us now</p></div></body>"
    story = lambda k: (f"title {k}", f"story {k} about things", f"more of {k}")
    rows = [(k, "http://h.net/", page.format(k, *story(max(k, 5)))) for k in range(12)]  # 0 to 5 are copies
    out = html_template.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in out} == {k: "\n".join(story(max(k, 5))) for k in range(12)}


@pytest.mark.parametrize("page", [
    "<body class='has-sidebar'>{}<div class='ad'>buy</div></body>", "<body><div class='content no-comments'>{}</div><div class='site-footer-inner'>end</div></body>",
    "<body><article class='post with-banner'>{}</article><div id='comments'>said</div></body>", "<body><form>{}<div class='comments'>said</div></form></body>",
    "<body><div class='widget'>{}</div><div class='widget'>other</div></body>", "<body><form><article>{}</article></form><p>aside from it</p></body>"])
def test_names_do_not_cut_clean_pages(page):
    inner = "<h1 class='post-header'>Title</h1><p>a text of some length</p><p>and one more paragraph of it</p>"
    assert html_template.main_text(page.format(inner), set()) == "Title\na text of some length\nand one more paragraph of it"


def test_noise_inside_a_line_and_odd_markup():
    page = "<body><article><p>one {} two</p><p>three</p></article></body>"
    for noise in ("<span class='ad'>buy now</span>", "<ins class='adsbygoogle'>buy now</ins>", "<button>press</button>", "<span hidden>unseen</span>",
                  "<b style='color:red; display: none'>unseen</b>", "<a class='sponsored-content' href=x>buy</a>", "<!-- note -->"):
        assert html_template.main_text(page.format(noise), set()) == "one two\nthree", noise
    assert html_template.main_text(page.format("<b class='ad-free'>kept</b>"), set()) == "one kept two\nthree"
    for tag in ("<p title=it's>", '<p title="abc>', "<p title='a > b' data-id=comments>", "<p a = \"x>y\" b='>' hidden-not>", "<p title=a\"b>"):
        assert html_template.main_text(f"<body><article>{tag}Hello</p><p>you</p></article></body>", set()) == "Hello\nyou", tag
    assert html_template.main_text("<article><p>one</p><iframe src=x><p>two</p></article>", set()) == "one\ntwo"
    assert html_template.main_text("<article><p>one</p><script>var x = 1;<p>two</p></article>", set()) == "one"
    assert html_template.main_text("<p" + " a=" * 3000, set()).startswith("<p")  # no tag at all, and read in linear time


def test_teasers_and_replies_are_no_main_text():
    page = "<body><main><article><h1>T</h1><p>body of the article</p></article>{}</main></body>"
    for noise in ("<section class='related-posts'><article><h2>Other</h2><p>teaser</p></article></section>", "<div class='reader-feedback'><article>a reply</article></div>",
                  "<ol class='commentlist'><li>said</li></ol>", "<div id='respond'>Leave a reply</div>", "<div class='adbox'>buy</div>", "<div class='sponsored-content'><p>buy</p></div>"):
        assert html_template.main_text(page.format(noise), set()) == "T\nbody of the article", noise


def test_nearest_recall_and_order(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    x = np.concatenate([centres[rng.integers(0, 12, 3000)] + 0.3 * rng.normal(size=(3000, 16)), np.repeat(centres[:1], 300, 0)])
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = ann_partitions.nearest(df, part_rows=300, block_rows=200, block_queries=20, target_recall=0.95).collect()
    by: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(by) == set(range(0, 3300, 20)) and all(len(v) == 20 for v in by.values())
    hits = 0
    for q, got in by.items():
        s = np.cumsum(x * x[q], 1)[:, -1]
        want = [int(i) for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:20]
        hits += len({i for i, _ in got} & set(want))
        assert all(abs(s[i] - v) < 1e-12 for i, v in got) and got == sorted(got, key=lambda g: (-g[1], g[0]))
    assert hits / (20 * len(by)) >= 0.9


def test_nearest_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1.0]), (20, [0.5, 0.5]),
            (None, [1.0, 1.0]), (7, [None, 1.0]), (20, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann_partitions.nearest(df).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 1, 0.5)]
    assert ann_partitions.nearest(df.limit(0)).count() == 0


def test_nearest_counts_every_row_of_an_id(spark):
    rows = [(7, [5.0, 0.0]), (7, [0.1, 0.2]), (20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann_partitions.nearest(df).collect())
    assert got == sorted([(20, 1, 7, 5.0), (20, 2, 7, 0.1), (20, 3, 20, 0.0), (20, 1, 7, 0.2), (20, 2, 7, 0.0), (20, 3, 20, 0.0)])


def test_nearest_routes_on_the_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = vectors.collect()
    x, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    sample = x[np.argsort(ids)]
    graph = ann_partitions.neighbour_graph(sample, 10)
    part = ann_partitions.balanced_parts(sample, graph, 8)
    assert np.bincount(part).max() <= 1.06 * len(x) / 8 and len(set(part)) == 8
    by: dict[int, set] = {}
    for r in ann_partitions.nearest(vectors).collect():
        by.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        want = [i for i in ids[np.lexsort((ids, -s))] if i != q][:20]
        hits += len(by[q] & set(want))
    assert len(by) == (ids % 20 == 0).sum() and hits / (20 * len(by)) >= 0.9


def test_transcripts(spark):
    c = spark.read.parquet(f"{SF}/conversations.parquet")
    lines = transcripts.transcript_lines(c)
    model = transcripts.fit(lines.where("conv_id % 2 = 0"))  # held out: the odd ones
    held = transcripts.recover_turns(lines.where("conv_id % 2 = 1"), model).withColumn("turn", F.shiftright("pos", 32))
    want = c.where("conv_id % 2 = 1")
    right = want.join(held.withColumnRenamed("text", "found"), ["conv_id", "turn", "role"]).where("trim(text) = found").count()
    assert right >= 0.95 * want.count()
    a = transcripts.recover_turns(lines, model).drop("x")
    b = transcripts.recover_turns(lines, model, block=F.shiftright("pos", 32))  # blocks of one turn: the same result
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_transcript_edges(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", "again"), (None, 0, "user", "no id"), (2, None, "system", "rules"),
            (3, 0, "user", ""), (4, 0, "tool", "a tool's result"), (4, 1, None, "of nobody"), (4, 2, "critic", "another role"), (5, 0, "user", "line\n" * 3000), (1, 0, "user", "hi")]
    c = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("state", F.lit("clash"))
    lines = transcripts.transcript_lines(c)
    out = transcripts.recover_turns(lines, transcripts.fit(lines)).collect()
    assert sorted(r.text for r in out if r.conv_id == 4) == ["a tool's result", "another role", "of nobody"] and {r.role for r in out if r.conv_id == 4} == {"tool"}
    assert {r.conv_id for r in out} == {1, None, 2, 4, 5} and all(r.rendered == f"<|{r.role}|>\n{r.text}\n<|end|>\n" for r in out)
    assert transcripts.recover_turns(lines.limit(0), transcripts.fit(lines.limit(0))).count() == 0


def test_repeated_rows_of_a_turn_keep_their_lines(spark):
    texts = [f"first of {k}\nsecond of {k}\nthird of {k}" for k in range(3)]
    rows = [(1, 0, "user", texts[0]), (1, 0, "user", texts[1]), (1, 0, "assistant", texts[2]), (1, 0, "user", texts[0]), (1, 1, "assistant", "end")]
    lines = transcripts.transcript_lines(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), drop_marker=0.0).orderBy("pos").collect()
    assert len({r.pos for r in lines}) == len(lines)
    told = "\n".join(r.line for r in lines if r.line.strip())
    assert [told.count(t) for t in texts] == [2, 1, 1]
    assert [r.before // 3 for r in lines if r.pos == 1 << 32] == [transcripts.ROLES.index("user")]


def test_url_rules_and_hosts(spark, edge):
    rules = [url_gbt.UrlRule.parse(r) for r in ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")]
    got = {r.page_id: r for r in url_gbt.judge_urls(edge, rules).collect()}
    assert url_gbt.judge_urls(edge, rules).count() == edge.count()
    assert (got[2].host, got[2].path, got[2].rule) == ("", "", None) and (got[4].host, got[4].path) == ("", "")
    assert (got[5].host, got[5].path, got[5].rule) == ("u@ex.com:80", "", None)
    assert (got[6].rule, got[6].verdict) == ("example.org/es/", "block") and got[7].rule == "example.org/en/1"
    assert got[8].rule == "com/de/" and got[9].rule == "org/"
    assert all(r.verdict in ("allow", "block") for r in got.values())
    assert url_gbt.judge_urls(edge.limit(0), rules).count() == 0
    assert {r.verdict for r in url_gbt.judge_urls(edge, []).collect()} == {"allow"}


def test_url_trees_held_out(spark):
    urls = spark.range(1500).selectExpr("id page_id", "CASE WHEN id % 3 = 0 THEN concat('http://x', id, '-win-', id * 7919, '.biz/?a=', id, '&b=', id, '&c=1') "
                                        "ELSE concat('http://www.site', id % 40, '.net/news/story') END url", "int(id % 3 = 0) block")
    out = url_gbt.judge_urls(urls, [], labelled=urls.where("page_id % 2 = 0").select("url", "block"))
    held = out.join(urls.where("page_id % 2 = 1").select("page_id", "block"), "page_id")
    assert held.where("(verdict = 'block') = (block = 1)").count() >= 0.98 * held.count()


def test_archives(spark, edge, tmp_path):
    pages = edge.unionByName(spark.createDataFrame([(k, "http://copy.net/\r\nX: y", "same page", None, None, None) for k in (50, 51, 52, 52)], PAGE))
    files = warc.write_monolithic(pages, f"{tmp_path}/mono", file_bytes=4000)
    index = warc.normalise(files, f"{tmp_path}/norm")
    rows = warc.read_records(index).collect()
    assert len(rows) == pages.count() == index.count()
    want: dict = {}
    for r in pages.collect():
        want.setdefault((r.html or ""), []).append(r.page_id)
    for r in rows:
        if r.record_type == "response":
            assert r.payload_digest == base64.b32encode(hashlib.sha1(bytes(r.payload)).digest()).decode() and r.payload_bytes == len(r.payload)
    same = {(r.page_id, r.record_type, r.refers_to) for r in rows if r.page_id in (50, 51, 52)}
    assert same == {(50, "revisit", 52), (51, "revisit", 52), (52, "response", None)}
    for payload, ids in want.items():
        top = max((i for i in ids if i is not None), default=None)
        got = [r for r in rows if r.payload_digest == warc.base32_sha1(payload.encode())]
        assert {r.refers_to for r in got if r.record_type == "revisit"} <= {top}
        assert sum(r.record_type == "response" for r in got) == sum(i == top for i in ids)
    r = index.first()  # each member stands alone, and the sidecar says where
    data = open(r.file, "rb").read()[r.offset : r.offset + r.length]
    assert zlib.decompress(data, 31).startswith(b"WARC/1.1") and open(r.file + ".idx").readline().split("\t")[:2] == ["0", str(index.where(F.col("file") == r.file).orderBy("offset").first().length)]
    assert warc.normalise(warc.write_monolithic(edge.limit(0), f"{tmp_path}/none"), f"{tmp_path}/none2").count() == 0


def test_broken_archive(tmp_path):
    good = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = good.compress(warc.record(1, "u", b"x" * 100, None, "d")) + good.flush()
    path = tmp_path / "a.gz"
    path.write_bytes(data[:-12])
    with open(path, "rb") as f, pytest.raises((EOFError, zlib.error)):
        list(warc._members(f, open(tmp_path / "b.gz", "wb"), 1))
