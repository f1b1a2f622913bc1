"""Shared pieces of the ``llm`` operators: words, scratch tables, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.session import shared_dir

#: Fixed value: the six ASCII white-space characters that separate words.
WHITE_SPACE = r"[\x20\x09-\x0D]"


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text (null text: null)."""
    return F.array_remove(F.split(text, WHITE_SPACE + "+"), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read again.

    The written table cuts the lineage: a lost executor costs a re-read, not a recomputation,
    and a value computed twice by two consumers is computed once.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Components of an undirected graph: ``(node, label)`` with the smallest node as label.

    ``edges`` has the columns ``a`` and ``b``. Each round lowers every label to the smallest one
    among the neighbours and then follows labels of labels, so chains halve; every round is
    written as a table. Nodes without an edge do not appear. Labels never reach the driver, only
    the number of changes does.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                 .where("a != b").distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                   .select("node", F.least("node", "low").alias("label")), "labels")
    for _ in range(max_rounds):
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low")))
        lowered = (labels.join(near, "node")
                   .select("node", "label", F.least("label", "low").alias("low")))
        lowered = stage(lowered, "lowered")
        jump = lowered.select(F.col("node").alias("low"), F.col("low").alias("jump"))
        after = stage(lowered.join(jump, "low").select("node", "label", F.least("low", "jump").alias("low")), "jumped")
        changed = after.where("low != label").limit(1).count()
        labels = after.select("node", F.col("low").alias("label"))
        if not changed:
            return labels
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")
