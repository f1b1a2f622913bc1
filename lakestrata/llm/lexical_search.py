"""Ranked lexical search with integer scores, term lists first and documents next (hybrid TAAT-DAAT).

Every shard of documents holds a posting list for each term. For a query the short lists are summed
term at a time into accumulators of bounded number; these become one more list, with the largest sum
as its bound. Then the long lists and the accumulators are gone through document at a time, skipping
documents that cannot reach the current top. Shards are searched in parallel and their tops merged.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .postings import Postings, Top, blocks, max_score, window_edges

#: Fixed value: ASCII characters other than letters and digits separate terms; A-Z count as a-z.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
PIECE = 1 << 20  # bytes of a long text that are split at once
RESULT = "item_id long, rank int, doc_id long, score long"


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, a piece of about ``PIECE`` bytes at a time."""
    start = 0
    while start < len(text):
        piece = text[start : start + PIECE].translate(FOLD)
        if start + PIECE < len(text):
            cut = piece.rfind(b" ")
            while cut < 0 and start + len(piece) < len(text):  # a term as long as a piece
                piece += text[start + len(piece) : start + len(piece) + PIECE].translate(FOLD)
                cut = piece.rfind(b" ")
            piece = piece[: cut + 1] if cut >= 0 else piece
        start += len(piece)
        yield piece.split()


def build_index(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", only: set[bytes] | None = None,
                shard_docs: int = 16_384, shard_bytes: int = 32 << 20) -> DataFrame:
    """One row for each shard of documents, written once.

    A shard ends at ``shard_docs`` documents or ``shard_bytes`` of text. ``ids`` and ``lengths`` (terms
    with repeats) belong to its documents, ``n_docs`` counts those with a term, ``n_terms`` sums the
    lengths; ``terms``, ``sizes``, ``docs`` and ``tfs`` are the posting lists. ``only`` keeps the lists
    of these terms (the counts are of all terms).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(only)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        ids, lengths, lists, held = [], [], {}, 0

        def shard() -> pa.RecordBatch:
            names = sorted(lists)
            pairs = [np.frombuffer(lists[t], np.int32).reshape(-1, 2) for t in names]
            both = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int32)
            return pa.RecordBatch.from_pydict({
                "ids": pa.array([ids], pa.list_(pa.int64())), "lengths": pa.array([np.array(lengths, "<i8").tobytes()]),
                "n_docs": pa.array([sum(n > 0 for n in lengths)], pa.int64()), "n_terms": pa.array([sum(lengths)], pa.int64()),
                "terms": pa.array([names], pa.list_(pa.binary())), "sizes": pa.array([[len(p) for p in pairs]], pa.list_(pa.int32())),
                "docs": pa.array([both[:, 0].astype("<i4").tobytes()]), "tfs": pa.array([both[:, 1].astype("<i4").tobytes()])})

        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1), strict=True):
                raw = value.as_py() or b""
                counts: Counter[bytes] = Counter()
                for piece in terms(raw):
                    counts.update(piece)
                for t in counts if wanted is None else counts.keys() & wanted:
                    lists.setdefault(t, array("i")).extend((len(ids), counts[t]))
                ids.append(doc_id.as_py())
                lengths.append(counts.total())
                held += len(raw)
                if len(ids) >= shard_docs or held >= shard_bytes:
                    yield shard()
                    ids, lengths, lists, held = [], [], {}, 0
        if ids:
            yield shard()

    source = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text}`").cast("binary"))
    return stage(source.mapInArrow(run, "ids array<long>, lengths binary, n_docs long, n_terms long, terms array<binary>, sizes array<int>, docs binary, tfs binary"), "shards")


def item_terms(items: DataFrame, id_col: str, text: str) -> DataFrame:
    """``row item_id terms``: a number and the distinct terms of every item, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({t for piece in terms(x.as_py() or b"") for t in piece}) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.binary()))], names=["row", "item_id", "terms"])

    source = items.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("item_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    return stage(source.mapInArrow(run, "row long, item_id long, terms array<binary>"), "items")


def rank_documents(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", item_col: str = "item_id", text: str = "text", k: int = 10,
                   max_vocabulary: int = 1 << 20, block_terms: int = 1 << 20, shard_docs: int = 16_384) -> DataFrame:
    """``item_id rank doc_id score``: the ``k`` documents of the highest score above 0 for each item, exact.

    ``N`` documents have a term, all texts have ``L``; a term in ``df`` documents weighs
    ``floor(1000 ln((2N+2)/(2df+1)))``; a document of ``n`` terms has ``m = 10 + 90nN div L``; the score sums
    ``w * (10**9 tf div (1000 tf + 8m))`` over an item's distinct terms. Equal scores go by ascending
    ``doc_id``, null ids last. Every row is a document and an item of its own, repeated ids and
    texts included. Null and empty texts have no terms: such items get no rows, such documents are not found.
    Other columns are not read. Lists are kept for the items' terms if these are at most
    ``max_vocabulary`` (the set sent to the tasks), else for all terms. Items go to the tasks in blocks of at
    most about ``block_terms`` terms; for each block one job reads all shards.
    """
    spark = docs.sparkSession
    asked = item_terms(items, item_col, text)
    vocabulary = asked.select(F.explode("terms").alias("term")).distinct()
    few = vocabulary.limit(max_vocabulary + 1).count() <= max_vocabulary
    only = {bytes(r.term) for r in vocabulary.collect()} if few else None
    index = build_index(docs, id_col=id_col, text=text, only=only, shard_docs=shard_docs)
    total = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n, length = total.n or 0, total.l or 0
    if not length:
        return spark.createDataFrame([], RESULT)
    counts = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.sizes").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weighted = (asked.select("row", "item_id", F.explode("terms").alias("term")).join(counts, "term")
                .select("row", "item_id", F.struct("term", weight.alias("w")).alias("t")).where("t.w > 0")
                .groupBy("row", "item_id").agg(F.collect_list("t").alias("terms")))  # no more than the item's own terms
    weighted = stage(weighted.withColumn("weight", F.size("terms")), "weighted")
    found = spark.createDataFrame([], "row long, item_id long, doc_id long, score long")
    for block in blocks(weighted, "row", "weight", block_terms):
        queries = [(r.row, r.item_id, [(bytes(t.term), t.w) for t in r.terms]) for r in block.collect()]  # bounded by block_terms
        found = found.unionByName(stage(_search(index, queries, n, length, k), "tops"))
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def accumulate(lists: list[Postings], n_docs: int) -> Postings:
    """The short lists summed term at a time: one list of weight 1 whose bound is its largest sum."""
    docs = np.concatenate([x.docs for x in lists])
    sums = np.concatenate([x.weight * x.values for x in lists])
    order = np.argsort(docs, kind="stable")
    docs = docs[order]
    first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    sums = np.add.reduceat(sums[order], first)
    return Postings(docs[first], sums, 1, int(sums.max()), window_edges(docs[first], n_docs))


def _search(index: DataFrame, queries: list[tuple[int, int, list[tuple[bytes, int]]]], n: int, length: int, k: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [Top(k, least=1) for _ in shared.value]
        for batch in batches:
            for place in range(batch.num_rows):
                shard = {c: batch.column(c)[place].as_py() for c in ("ids", "lengths", "terms", "sizes", "docs", "tfs")}
                if not shard["terms"]:
                    continue
                ids = np.array([i or 0 for i in shard["ids"]], np.int64)
                nulls = np.array([i is None for i in shard["ids"]], bool)
                m = 10 + (90 * np.frombuffer(shard["lengths"], "<i8") * n) // length
                docs, tf = np.frombuffer(shard["docs"], "<i4"), np.frombuffer(shard["tfs"], "<i4").astype(np.int64)
                impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[docs])
                ends = np.cumsum(shard["sizes"])
                starts = ends - shard["sizes"]
                highest = np.maximum.reduceat(impact, starts)
                at = {t: i for i, t in enumerate(shard["terms"])}
                edges: dict[int, np.ndarray] = {}
                room = max(256, len(ids) // 8)  # accumulators
                for (_, _, query), top in zip(shared.value, tops, strict=True):
                    short, long, used = [], [], 0
                    for i, w in sorted(((at[t], w) for t, w in query if t in at), key=lambda x: shard["sizes"][x[0]]):
                        a, b = starts[i], ends[i]
                        used += b - a
                        if used <= room:
                            short.append(Postings(docs[a:b], impact[a:b], w, int(w * highest[i]), ends))
                        else:
                            if i not in edges:
                                edges[i] = window_edges(docs[a:b], len(ids))
                            long.append(Postings(docs[a:b], impact[a:b], w, int(w * highest[i]), edges[i]))
                    max_score(long + ([accumulate(short, len(ids))] if short else []), ids, nulls, top)
        rows, items, hits, scores = [], [], [], []
        for (row, item, _), top in zip(shared.value, tops, strict=True):
            count = len(top.ids)
            rows += [row] * count
            items += [item] * count
            hits += [None if null else i for i, null in zip(top.ids.tolist(), top.nulls.tolist(), strict=True)]
            scores += top.scores.tolist()
        yield pa.RecordBatch.from_pydict({"row": pa.array(rows, pa.int64()), "item_id": pa.array(items, pa.int64()),
                                          "doc_id": pa.array(hits, pa.int64()), "score": pa.array(scores, pa.int64())})

    return index.mapInArrow(run, "row long, item_id long, doc_id long, score long")
