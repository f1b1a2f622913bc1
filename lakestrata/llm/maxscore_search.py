"""Exact top-k inner products by MaxScore over signed posting lists.

A vector's components are its terms: dimension ``d`` with value ``v``. A shard holds one posting
list for each dimension. For a query a dimension's bound is the largest product its list can give
(0 at least); dimensions of small bounds are non-essential and only probed. Shards are searched in
parallel, each task keeps one threshold per query over all its shards, and their tops are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .postings import Postings, Top, blocks, filled, max_score, window_edges

RESULT = "query_id long, rank int, vec_id long, score long"
#: Largest value of a component after scaling; beyond it a product could leave 64 bits.
LARGEST = 1 << 31


def quantise(vectors: DataFrame, id_col: str, vector: str, scale: int) -> DataFrame:
    """``row vec_id v``: a number for every row and its components as ``floor(scale * x)``, written once.

    Vectors that are null, or hold a null or non-finite component or one beyond ``LARGEST`` after
    scaling, are left out.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    fine = lambda x: F.coalesce(F.abs(x * scale) < LARGEST, F.lit(False))  # noqa: E731  not NaN either: it is greater than all
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & F.forall("v", fine))
    return stage(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.transform("v", lambda x: F.floor(x * scale)).alias("v")), "quantised")


def build_index(rows: DataFrame, shard_rows: int = 8192) -> DataFrame:
    """One row for each shard of about ``shard_rows`` vectors, written once: ``rows``, ``ids`` and the
    posting lists of all its dimensions behind one another (``dims``, ``sizes``, ``docs``, ``vals``)."""
    shards = max(1, -(-rows.count() // shard_rows))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, shard_rows):
                part = batch.slice(start, shard_rows)
                lists = part.column(2)
                length = np.asarray(lists.value_lengths())
                doc = np.repeat(np.arange(len(length), dtype=np.int32), length)
                dim = np.arange(len(doc)) - np.repeat(np.cumsum(length) - length, length)
                val = lists.flatten().to_numpy()
                order = np.lexsort((doc, dim))
                order = order[val[order] != 0]
                dims, sizes = np.unique(dim[order], return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "rows": pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), "ids": pa.array([part.column(1).to_pylist()], pa.list_(pa.int64())),
                    "dims": pa.array([dims.astype("<i4").tobytes()]), "sizes": pa.array([sizes.astype("<i4").tobytes()]),
                    "docs": pa.array([doc[order].astype("<i4").tobytes()]), "vals": pa.array([val[order].astype("<i4").tobytes()])})

    dealt = rows.repartition(shards, "row")  # copies of one vector spread over all shards
    return stage(dealt.mapInArrow(pack, "rows array<long>, ids array<long>, dims binary, sizes binary, docs binary, vals binary"), "shards")


def top_inner_products(vectors: DataFrame, *, id_col: str = "vec_id", vector: str = "embedding", k: int = 5, query_every: int = 50,
                       scale: int = 256, shard_rows: int = 8192, block_values: int = 4 << 20) -> DataFrame:
    """``query_id rank vec_id score``: for each row whose id is divisible by ``query_every`` the ``k`` other
    rows of the largest inner product of ``floor(scale * x)``, ties to the smaller id. Exact.

    Every row but the query's own is a candidate, repeated ids and copies included; of equal rows
    each has a rank. Rows with a null id are no queries; as candidates their ``vec_id`` is null and
    they lose ties. A vector shorter than another has zeros for the rest; an empty one scores 0.
    Vectors that are null, or hold a null or non-finite component or one beyond 2**31 after scaling,
    take no part. Other columns are not read. No vectors: no rows. Queries go to the tasks in
    blocks of at most about ``block_values`` components (32 MB); for each block one job reads all shards.
    """
    spark = vectors.sparkSession
    rows = quantise(vectors, id_col, vector, scale)
    queries = rows.where(F.col("vec_id") % query_every == 0).withColumn("weight", F.size("v") + 8)
    index = build_index(rows, shard_rows)
    found = spark.createDataFrame([], "row long, query_id long, vec_id long, score long")
    for block in blocks(queries, "row", "weight", block_values):
        asked = [(r.row, r.vec_id, np.array(r.v, np.int64)) for r in block.select("row", "vec_id", "v").collect()]  # bounded by block_values
        found = found.unionByName(stage(_search(index, asked, k), "tops"))
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(index: DataFrame, asked: list[tuple[int, int, np.ndarray]], k: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [Top(k) for _ in shared.value]
        for batch in batches:
            for shard in batch.to_pylist():
                ids = np.array([i or 0 for i in shard["ids"]], np.int64)
                nulls = np.array([i is None for i in shard["ids"]], bool)
                places = {row: at for at, row in enumerate(shard["rows"])}
                dims, sizes, docs, vals = (np.frombuffer(shard[c], "<i4") for c in ("dims", "sizes", "docs", "vals"))
                ends = np.cumsum(sizes)
                lists = {}
                for d, a, b in zip(dims.tolist(), ends - sizes, ends, strict=True):
                    at, v = filled(docs[a:b], vals[a:b].astype(np.int64), len(ids))
                    lists[d] = (at, v, int(v.min()), int(v.max()), window_edges(at, len(ids)))
                for (row, _, q), top in zip(shared.value, tops, strict=True):
                    terms = []
                    for d in np.flatnonzero(q).tolist():
                        if d in lists:
                            at, v, low, high, edges = lists[d]
                            weight = int(q[d])
                            terms.append(Postings(at, v, weight, max(0, weight * high, weight * low), edges))
                    max_score(terms, ids, nulls, top, places.get(row, -1))
        rows, queries, hits, scores = [], [], [], []
        for (row, query, _), top in zip(shared.value, tops, strict=True):
            n = len(top.ids)
            rows += [row] * n
            queries += [query] * n
            hits += [None if null else i for i, null in zip(top.ids.tolist(), top.nulls.tolist(), strict=True)]
            scores += top.scores.tolist()
        yield pa.RecordBatch.from_pydict({"row": pa.array(rows, pa.int64()), "query_id": pa.array(queries, pa.int64()),
                                          "vec_id": pa.array(hits, pa.int64()), "score": pa.array(scores, pa.int64())})

    return index.mapInArrow(run, "row long, query_id long, vec_id long, score long")
