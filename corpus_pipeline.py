"""Training-corpus pipeline: quality rules, near duplicates, source mixing, tokens.

Each stage takes all its predecessor kept. All but the last return the columns of ``documents``;
columns beyond these are left out by the first stage, whatever their names. An empty table goes
through all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.byte_bpe import decode, encode, read_ranks
from lakestrata.llm.common import stage, table
from lakestrata.llm.decision_list import quality_rules
from lakestrata.llm.jaccard_join import linked_groups
from lakestrata.llm.mixing import mix_sources
from lakestrata.llm.queries import tokenizer_files

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and that no learned rule rejects.

    Null and empty texts have no words and fail the base rule. Rows with null or repeated ids, and
    repeated rows, are judged by their text and stay as often as they come; a null source or language stays null.
    """
    out, _ = quality_rules(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), drop_text=False)
    return out.where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one row with the smallest id (nulls last), then the least hash of id and text.

    Rows that repeat the kept id and text count as one, the one with the least other columns. Empty texts are linked to nothing.
    """
    groups = stage(linked_groups(docs.select("doc_id", "text"), keyed=True).where("label IS NOT NULL").select("doc_id", "row", "label"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    kept = stage(groups.groupBy("label").agg(first.alias("first")).select("first.row"), "kept")
    gone = stage(groups.select("row").distinct().join(kept, "row", "left_anti"), "gone")
    repeated = stage(groups.join(kept, "row", "left_semi").groupBy("row").count().where("count > 1").select("row"), "repeated")
    left = docs.select(*COLUMNS, F.xxhash64(F.col("doc_id").cast("long"), "text").alias("row")).join(gone, "row", "left_anti")
    if not repeated.limit(1).count():
        return left.select(*COLUMNS)
    again = left.join(repeated, "row", "left_semi").groupBy("row").agg(F.min(F.struct(*COLUMNS)).alias("one")).select("one.*")
    return left.join(repeated, "row", "left_anti").select(*COLUMNS).unionByName(again)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's tempered weight asks: each once at least, none over twice.

    Null is a source of its own. Rows count each, also with null or repeated ids; a text without words
    is taken once.
    """
    out, _, _ = mix_sources(docs.select(*COLUMNS), max_repetition=2.0)
    return out.select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with hashes of the ids and of the bytes they decode to.

    Null and empty texts have no ids (the hashes are those of nothing); long texts are encoded whole; a row comes
    out for every row. The ids are written before they are decoded: steps chained in one task each hold a Python
    process of their own, and Spark keeps these processes for the steps that follow.
    """
    path, pattern = tokenizer_files()
    ranks = read_ranks(path)
    coded = decode(stage(encode(docs.select("doc_id", "source", "text"), ranks, pattern), "ids"), ranks)
    return coded.select("doc_id", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("mixing", mixing), ("tokens", tokens)]

#: SQL cannot express the learned rules, the joins' hashes or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
