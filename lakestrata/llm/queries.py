"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SHARDS = 40


def tokenizer_files() -> tuple[str, str]:
    """Path of the rank file and the split pattern of the public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from .html_template import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found of every 20th vector."""
    from .ann_partitions import nearest

    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=20, query_every=20)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rule and learned verdict of every document."""
    from .decision_list import quality_rules

    out, _ = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards of nearly equal bytes."""
    from .histogram_sort import shard_by_bytes

    out = shard_by_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS)
    return out.select("doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_transcript_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns recovered from raw transcripts of every conversation; ``turn`` is where each starts in the source."""
    from .transcripts import fit, recover_turns, transcript_lines

    lines = transcript_lines(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    out = recover_turns(lines, fit(lines))
    return out.select("conv_id", F.shiftright("pos", 32).cast("long").alias("turn"), "role", "n_lines", "text", "rendered")


#: The rules of the URL query.
URL_RULES = ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")


def op6_url_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or learned verdict on every page's URL."""
    from .url_gbt import UrlRule, judge_urls

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, [UrlRule.parse(r) for r in URL_RULES]).select("page_id", "host", "path", "rule", "verdict", "score")


def op7_adaptive_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that links of 75 % of the five-word shingles reach."""
    from .jaccard_join import linked_groups

    return linked_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to monolithic archives, these normalised, and every record read back by its offset."""
    from .warc import archive_folder, normalise, read_records, write_monolithic

    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    files = write_monolithic(pages, archive_folder(pages, "monolithic"), least_bytes=0)
    index = normalise(files, archive_folder(pages, "normalised"))
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    from .byte_bpe import decode, encode, read_ranks

    path, pattern = tokenizer_files()
    ranks = read_ranks(path)
    back = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, pattern), ranks)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as often as its source's tempered weight asks (no source over twice), with its place in the mix."""
    from .mixing import mix_sources

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out, exponent, _ = mix_sources(docs, max_repetition=2.0, keep_text=False)
    return out.select("doc_id", "source", "n_tokens", "epoch", "block", "mix_key", "mix_tie", "weight", F.lit(exponent).alias("exponent"))


def op11_hybrid_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    from .lexical_search import rank_documents

    return rank_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"), k=10)


def op12_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    from .burst_trie import prefix_trie, rebuilt_turns, turn_rows

    turns = turn_rows(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return prefix_trie(rebuilt_turns(turns))


def op13_maxscore_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest integer inner products of every 50th vector."""
    from .maxscore_search import top_inner_products

    return top_inner_products(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=5, query_every=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_template_extraction, op2_learned_partitions, op3_quality_rules, op4_histogram_sort, op5_transcript_parsing, op6_url_gbt, op7_adaptive_prefix_join, op8_warc_normaliser, op9_byte_bpe, op10_temperature_mixing,
                                op11_hybrid_lexical_search, op12_burst_trie, op13_maxscore_search)
}

_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op11_hybrid_lexical_search": f"""
WITH held AS (SELECT doc_id, unnest(regexp_extract_all({_FOLD.format('text')}, '{_TERMS}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM held GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
stats AS (SELECT count(*) AS nd, sum(n)::BIGINT AS nt FROM lengths),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weights AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, stats),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_FOLD.format('text')}, '{_TERMS}')) AS term FROM benchmark),
scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nd) // nt))))::BIGINT AS score
           FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (doc_id), stats GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10""",
    "op13_maxscore_search": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5""",
    # CRC-32 bit by bit, for want of a function; a node's key is its turn ids (32 characters each) joined by commas
    "op12_burst_trie": """
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tid) AS pos, tid, size
  FROM (SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS tid, strlen(coalesce(text, '')) AS size
        FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
    list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda s, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda u, i: xor(u >> 1, 3988292384 * (u & 1)), xor(s, b)), 4294967295::BIGINT), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.tid, t.size FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.tid, t.size FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
seqs AS (
  SELECT c.conv_id, coalesce(list(r.tid ORDER BY part, pos) FILTER (r.tid IS NOT NULL), []) AS tids, list(r.size ORDER BY part, pos) FILTER (r.tid IS NOT NULL) AS sizes
  FROM convs c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id),
prefixes AS (SELECT conv_id, tids, sizes, unnest(range(0, len(tids) + 1)) AS depth FROM seqs),
keyed AS (
  SELECT conv_id, depth, depth = len(tids) AS ended, array_to_string(tids[1:depth], ',') AS k, CASE WHEN depth > 0 THEN coalesce(sizes[depth], 0) ELSE 0 END AS size
  FROM prefixes),
nodes AS (
  SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS own,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
  FROM keyed GROUP BY k, depth),
kids AS (SELECT left(k, greatest(33 * (depth - 1) - 1, 0)) AS k, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
above AS (SELECT left(n.k, greatest(33 * d - 1, 0)) AS k, d AS depth, n.own, coalesce(c.n_children, 0) = 0 AS leaf
          FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM nodes) n LEFT JOIN kids c ON c.k = n.k AND c.depth = n.depth),
totals AS (SELECT k, depth, count(*) FILTER (leaf) AS n_leaves, sum(own)::BIGINT AS saved_tokens FROM above GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, t.n_leaves, t.saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t USING (k, depth) LEFT JOIN kids c USING (k, depth)
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.k = left(n.k, greatest(33 * (n.depth - 1) - 1, 0))""",
}
