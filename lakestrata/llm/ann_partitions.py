"""Approximate nearest neighbours over learned partitions.

The neighbour graph of a bounded sample is cut into balanced parts; a small classifier learns to
name a vector's part from its components. It then places every vector of the table and sends each
query to the several parts that it finds most probable, where candidates are ranked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest other rows of each row, by inner product, in blocks."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), max(k, 0)), np.int64)
    for a in range(0, len(x), 512):
        s = x[a : a + 512] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        if k:
            near = np.argpartition(-s, k - 1, axis=1)[:, :k]
            out[a : a + 512] = np.take_along_axis(near, np.argsort(-np.take_along_axis(s, near, 1), axis=1, kind="stable"), 1)
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 0.05, passes: int = 12) -> np.ndarray:
    """Part of each node (``parts`` a power of two): halved along main axes, then nodes move to the
    part that most of their neighbours are in, largest gain first, while no part outgrows its share."""
    part = np.zeros(len(x), np.int64)
    for _ in range(int(np.log2(parts))):
        new = part * 2
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            y = x[own] - x[own].mean(0)
            axis = np.linalg.eigh(y.T @ y)[1][:, -1]
            order = np.argsort(y @ axis, kind="stable")
            new[own[order[len(own) // 2 :]]] += 1
        part = new
    if parts == 1 or not graph.size:
        return part
    cap = int(np.ceil((1 + slack) * len(x) / parts))
    for _ in range(passes):
        votes = np.zeros((len(x), parts), np.int32)
        rows = np.repeat(np.arange(len(x)), graph.shape[1])
        np.add.at(votes, (rows, part[graph.ravel()]), 1)
        np.add.at(votes, (graph.ravel(), part[rows]), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), part]
        sizes = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < cap:
                sizes[part[i]] -= 1
                part[i] = best[i]
                sizes[best[i]] += 1
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """One hidden layer and a softmax over the parts, in numpy."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    scale: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x * self.scale) @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def order(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` most probable parts of each row, best first (ties: the smaller part)."""
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :n]


def train_router(x: np.ndarray, part: np.ndarray, graph: np.ndarray, parts: int, hidden: int = 128, steps: int = 300, seed: int = 5) -> Router:
    """Fits the parts of each row and of its neighbours (soft labels) by Adam on the whole sample."""
    rng = np.random.default_rng(seed)
    want = np.zeros((len(x), parts))
    want[np.arange(len(x)), part] += 1 + graph.shape[1] / 2
    for j in range(graph.shape[1]):
        want[np.arange(len(x)), part[graph[:, j]]] += 0.5
    want /= want.sum(1, keepdims=True)
    scale = 1 / max(float(np.sqrt((x * x).sum(1).mean())), 1e-30) * np.sqrt(x.shape[1])
    p = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    xs = x * scale
    for t in range(1, steps + 1):
        pick = rng.integers(0, len(x), min(len(x), 1024))
        a, y = xs[pick], want[pick]
        h = np.maximum(a @ p[0] + p[1], 0)
        z = h @ p[2] + p[3]
        e = np.exp(z - z.max(1, keepdims=True))
        d = (e / e.sum(1, keepdims=True) - y) / len(a)
        dh = (d @ p[2].T) * (h > 0)
        for i, g in enumerate((a.T @ dh, dh.sum(0), h.T @ d, d.sum(0))):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            p[i] = p[i] - 0.01 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return Router(*p, scale)


def probes_for(router: Router, x: np.ndarray, graph: np.ndarray, parts: int, target: float) -> int:
    """Fewest parts per query that hold a share ``target`` of the sample's nearest neighbours."""
    if parts == 1 or not graph.size:
        return 1
    own = router.order(x, 1)[:, 0]
    rank = np.argsort(router.order(x, parts), axis=1)
    found = np.sort(np.take_along_axis(rank, own[graph], 1).ravel())
    return int(found[min(len(found) - 1, int(np.ceil(target * len(found))))]) + 1


def _unpack(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)


def exact_top(q: np.ndarray, q_rows: np.ndarray, x: np.ndarray, x_rows: np.ndarray, x_ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its ``k`` best candidates but its own row: place of the query, ids, scores.

    A matrix product finds the candidates within rounding of the k-th best; these are scored
    again, one sum in component order, so that equal vectors get equal scores and ties go to the
    smaller id.
    """
    for a in range(0, len(q), 256):
        s = q[a : a + 256] @ x.T
        s[q_rows[a : a + 256, None] == x_rows[None, :]] = -np.inf
        for i, row in enumerate(s):
            real = int(np.isfinite(row).sum())
            if not real:
                continue
            n = min(k, real)
            least = -np.partition(-row, n - 1)[n - 1]
            near = np.flatnonzero((row >= least - 1e-9 * max(1.0, abs(least))) & np.isfinite(row))
            exact = np.cumsum(q[a + i] * x[near], axis=1)[:, -1]
            order = np.lexsort((x_ids[near], -exact))[:n]
            yield a + i, x_ids[near][order], exact[order]


def nearest(vectors: DataFrame, *, id_col: str = "vec_id", vector: str = "embedding", k: int = 20, query_every: int = 20,
            max_sample: int = 8192, part_rows: int = 4096, least_parts: int = 8, max_parts: int = 256, target_recall: float = 0.93,
            block_rows: int = 8192, block_queries: int = 2048) -> DataFrame:
    """``query_id rank vec_id score``: for each row whose id is divisible by ``query_every`` its ``k``
    nearest other rows found, by inner product in double precision, ties to the smaller id.

    The graph, the parts and the router are fitted on at most ``max_sample`` vectors (least
    ``xxhash64`` of the id first; a documented bound), every vector is indexed and every query
    searched. The number of probed parts is the least that reaches ``target_recall`` on the
    sample. Parts are searched in blocks of about ``block_rows`` vectors and ``block_queries``
    queries, so copies of one vector spread over many tasks. Vectors that are null, zero, of
    another length than most, or hold null or non-finite components take no part, nor do null
    ids. Rows that agree in id and vector count as one; rows that share an id only are rows of their own, each
    a candidate of the other. Other columns are not read. No vectors: no rows.

    There are at least ``least_parts`` parts where the sample has 64 vectors for each, and one more doubling while
    parts would hold over ``part_rows`` vectors, up to ``max_parts`` and 64 sampled vectors a part.
    """
    spark = vectors.sparkSession
    base = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    base = base.where("vec_id IS NOT NULL AND v IS NOT NULL").where(F.forall("v", fine) & F.exists("v", lambda x: x != 0))
    lengths = base.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], schema)
    dim = lengths[0].dim
    base = base.where(F.size("v") == dim).distinct()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["vec_id", "v"])

    packed = stage(base.mapInArrow(pack, "vec_id long, v binary").withColumn("row", F.monotonically_increasing_id()).select("vec_id", "v", "row"), "vectors")
    total = packed.count()
    sample = packed.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(max_sample).select("v").collect()
    x = np.frombuffer(b"".join(bytes(r.v) for r in sample), "<f8").reshape(-1, dim)
    parts = 1
    while parts * 2 <= max_parts and (parts < least_parts or parts * part_rows < total) and parts * 2 * 64 <= len(x):
        parts *= 2
    graph = neighbour_graph(x, 10)
    part = balanced_parts(x, graph, parts)
    router = train_router(x, part, graph, parts) if parts > 1 else None
    probes = probes_for(router, x, neighbour_graph(x, k), parts, target_recall) if router else 1
    shared = spark.sparkContext.broadcast(tuple(vars(router).values()) if router else None)  # (dim + parts) x 128 weights

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = Router(*shared.value) if shared.value else None
        for batch in batches:
            y = _unpack(batch.column(1), dim)
            order = r.order(y, probes) if r is not None else np.zeros((len(y), 1), np.int64)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * order.shape[1]), pa.array(order.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], names=["vec_id", "v", "row", "parts"])

    placed = stage(packed.mapInArrow(place, "vec_id long, v binary, row long, parts array<int>"), "placed")
    queries = placed.where(F.col("vec_id") % query_every == 0)
    # a row for each part, max_parts at most
    rows = {r.p: r.n for r in placed.groupBy(F.col("parts")[0].alias("p")).agg(F.count("*").alias("n")).collect()}
    asked = {r.p: r.n for r in queries.select(F.explode("parts").alias("p")).groupBy("p").agg(F.count("*").alias("n")).collect()}
    grid = spark.createDataFrame([(p, -(-rows[p] // block_rows), -(-asked[p] // block_queries)) for p in rows if p in asked] or [(-1, 1, 1)],
                                 "part int, rb int, qb int")
    spread = lambda df, own, other, salt: (
        df.join(F.broadcast(grid), "part")
        .withColumn("own", F.pmod(F.xxhash64("row", F.lit(salt)), F.col(own)).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1))))
    left = spread(placed.select("vec_id", "v", "row", F.col("parts")[0].alias("part")), "rb", "qb", 3).select("vec_id", "v", "row", "part", F.col("own").alias("r"), F.col("other").alias("q"))
    right = spread(queries.select("vec_id", "v", "row", F.explode("parts").alias("part")), "qb", "rb", 4).select("vec_id", "v", "row", "part", F.col("other").alias("r"), F.col("own").alias("q"))

    def search(candidates: pa.Table, wanted: pa.Table) -> pa.Table:
        asked, ids, rows, found = [], [], [], []
        if len(candidates) and len(wanted):
            y, y_ids, y_rows = _unpack(candidates.column(1), dim), candidates.column(0).to_numpy(), candidates.column(2).to_numpy()
            z, z_ids, z_rows = _unpack(wanted.column(1), dim), wanted.column(0).to_numpy(), wanted.column(2).to_numpy()
            for i, near, scores in exact_top(z, z_rows, y, y_rows, y_ids, k):
                asked.append(np.full(len(near), z_ids[i], np.int64))
                rows.append(np.full(len(near), z_rows[i], np.int64))
                ids.append(near)
                found.append(scores)
        cat = lambda xs, t: np.concatenate(xs) if xs else np.zeros(0, t)
        return pa.table({"query_id": cat(asked, np.int64), "row": cat(rows, np.int64), "vec_id": cat(ids, np.int64), "score": cat(found, np.float64)})

    keys = ["part", "r", "q"]
    left, right = left.toDF("vec_id", "v", "row", *keys), right.toDF("query_id", "w", "own", *keys)
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query_id long, row long, vec_id long, score double")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
