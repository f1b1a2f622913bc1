"""Prefix trie of conversations, built as a burst trie.

A container holds the suffixes of all conversations that share a trie head. It starts at the root.
In rounds, every container of more than a bounded number of rows bursts: the turns that all its
members share become nodes, then each next turn id heads a container of its own. Containers that
are small enough are sorted and swept into nodes inside one task each; a container of one member is
a chain and needs no sweep. A node is named by its smallest member and its depth. Totals over
subtrees go back up round by round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Fixed value: each run of this many conversations borrows first turns from its first.
FAMILY = 5
#: Fixed value: a conversation borrows fewer first turns than this.
BORROWED = 9

#: Most heads that are sent to all tasks; more are joined by a shuffle.
FEW_HEADS = 100_000

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``conv pos tid bytes cum``: the turns of each conversation numbered from 1 by ``turn``, nulls first.

    Null role or text is empty; ``tid`` stands for both (MD5 over role length, role and text),
    ``bytes`` is the UTF-8 length of the text and ``cum`` its sum so far. Turns of one number go by
    ``tid``. Rows without a ``conv_id`` belong to no conversation and are left out. The rows are
    dealt by ranges of all order columns, so one conversation may spread over many tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    keyed = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("tid"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("nr"))
    order = ["turn", "tid", "nr"]
    dealt = stage(stage(keyed, "turns").repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "dealt")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task that holds the conversation
    parts = (dealt.groupBy("conv", "part").agg(F.count("*").alias("n"), F.sum("bytes").alias("b"))
             .select("conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"), F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b")))
    here = Window.partitionBy("conv", "part").orderBy(*order)
    numbered = (dealt.withColumn("at", F.row_number().over(here)).withColumn("sum", F.sum("bytes").over(here.rowsBetween(Window.unboundedPreceding, 0)))
                .join(parts, ["conv", "part"]))
    return stage(numbered.select("conv", (F.col("n") + F.col("at")).alias("pos"), "tid", "bytes", (F.col("b") + F.col("sum")).alias("cum")), "numbered")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """Turns (as of ``turn_rows``) of the rebuilt conversations, with a row at ``pos`` 0 and ``len`` turns for each.

    Conversation c starts with the first ``crc32(decimal c) % 9`` turns of conversation ``c - c % 5``
    (all if fewer, none if absent); its own turns after as many follow.
    """
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % BORROWED).cast("long")
    convs = turns.groupBy("conv").agg(F.count("*").alias("n"), F.sum(F.when(F.col("pos") <= h, F.col("bytes"))).alias("skipped")).withColumn("h", h).withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
    convs = stage(convs, "convs")
    lead = turns.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < BORROWED)).withColumnRenamed("conv", "base")
    borrowed = stage(lead.join(convs.select("conv", "base", "h"), "base").where("pos <= h").select("conv", "pos", "tid", "bytes", "cum"), "borrowed")
    given = borrowed.groupBy("conv").agg(F.max("pos").alias("given"), F.max("cum").alias("given_cum"))
    convs = (convs.join(given, "conv", "left").na.fill(0, ["given", "given_cum", "skipped"])
             .select("conv", "h", "given", "given_cum", "skipped", (F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")))
    convs = stage(convs, "lengths")
    own = turns.join(convs, "conv").where("pos > h").select(
        "conv", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "tid", "bytes", (F.col("cum") - F.col("skipped") + F.col("given_cum")).alias("cum"), "len")
    start = convs.select("conv", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("tid"), F.lit(0).cast("long").alias("bytes"), F.lit(0).cast("long").alias("cum"), "len")
    return own.unionByName(borrowed.join(convs.select("conv", "len"), "conv")).unionByName(start)


def _by_head(df: DataFrame, heads: DataFrame, on: list[str]) -> DataFrame:
    """Join with a table of heads, sent to all tasks if it is proven small."""
    small = heads.limit(FEW_HEADS + 1).count() <= FEW_HEADS
    return df.join(F.broadcast(heads) if small else heads, on)


def prefix_trie(rows: DataFrame, container_rows: int = 16_384) -> DataFrame:
    """One row for each distinct prefix of a conversation, the empty one at depth 0 included.

    ``rows`` are as of ``rebuilt_turns`` (``conv pos tid bytes cum len`` from ``pos`` 0 on). Returns
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (root: null), ``n_convs``, ``n_children``,
    ``n_leaves`` and ``saved_tokens`` over the subtree, and ``ends_sha256`` of the members that end here.
    No conversations: no rows. Copies, very long conversations and a first turn that most share
    only change which containers burst. ``container_rows`` bounds what one task holds.
    """
    spark = rows.sparkSession
    rows = stage(rows, "rebuilt")
    root = rows.agg(F.min("conv").alias("conv"), F.count("*").alias("size"), F.count_if(F.col("pos") == 0).alias("n")).first()
    if not root.size:
        return spark.createDataFrame([], NODE)
    live = rows.select(F.lit(root.conv).cast("long").alias("hc"), F.lit(0).cast("long").alias("hd"), F.lit(None).cast("long").alias("hp"),
                       F.lit(root.n).cast("long").alias("n"), F.lit(root.size).cast("long").alias("size"), "conv", "pos", "tid", "bytes", "cum", "len")
    large = (F.col("size") > container_rows) & (F.col("n") > 1)
    settled, runs, ends = [live.where(~large)], [], []
    live = live.where(large)
    while live.limit(1).count():
        live, run, end, rest = _burst(live, large)
        settled.append(rest)
        runs.append(run)
        ends.append(end)
    rest = settled[0]
    for part in settled[1:]:
        rest = rest.unionByName(part)
    swept = stage(sweep(rest.where("n > 1")).unionByName(_chains(rest.where("n = 1"))), "swept")
    if not runs:
        return swept.drop("head")
    below = swept.where("head").select(F.col("parent_conv_id").alias("hc"), (F.col("depth") - 1).alias("e"), "n_leaves", "saved_tokens")
    hashes = None
    for end in ends:
        hashes = end if hashes is None else hashes.unionByName(end)
    hashes = stage(hash_members(hashes), "hashes")
    out, empty = swept.drop("head"), hashlib.sha256(b"").hexdigest()
    for run in reversed(runs):
        total = below.groupBy("hc", "e").agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        heads = run.where("pos = e").select("hc", "hd", "e", F.col("cum").alias("cum_e"))
        heads = stage(heads.join(total, ["hc", "e"], "left").join(hashes.select("hc", "e", "sha"), ["hc", "e"], "left"), "heads").drop("e")
        last = F.col("pos") == F.col("e")
        nodes = _by_head(run, heads, ["hc", "hd"]).select(
            F.col("hc").alias("conv_id"), F.col("pos").alias("depth"), F.when(F.col("pos") == F.col("hd"), F.col("hp")).otherwise(F.col("hc")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"), F.when(last, F.coalesce("children", F.lit(0))).otherwise(1).cast("long").alias("n_children"),
            F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
            ((F.col("n") - 1) * (F.col("cum_e") - F.col("cum") + F.col("bytes")) + F.coalesce("saved", F.lit(0))).cast("long").alias("saved_tokens"),
            F.when(last & F.col("sha").isNotNull(), F.col("sha")).otherwise(F.lit(empty)).alias("ends_sha256"), (F.col("pos") == F.col("hd")).alias("head"))
        nodes = stage(nodes, "nodes")
        above = nodes.where("head").select(F.col("parent_conv_id").alias("hc"), (F.col("depth") - 1).alias("e"), "n_leaves", "saved_tokens")
        below = below.unionByName(above)
        out = out.unionByName(nodes.drop("head"))
    return out


def _burst(live: DataFrame, large: Any) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """One round over all large containers: containers that are large still, nodes of the shared turns,
    members that end behind these, and containers that are settled."""
    head = ["hc", "hd"]
    same = (F.col("c") == F.col("n")) & F.coalesce(F.col("a") == F.col("b"), F.lit(True))
    places = live.groupBy(*head, "n", "pos").agg(F.count("*").alias("c"), F.min("tid").alias("a"), F.max("tid").alias("b"))
    shared = stage(places.groupBy(*head).agg(F.coalesce(F.min(F.when(~same, F.col("pos"))) - 1, F.max("pos")).alias("e")), "shared")
    live = _by_head(live, shared, head)
    run = stage(live.where("conv = hc AND pos <= e").select("hc", "hd", "hp", "n", "e", "pos", "bytes", "cum"), "run")
    end = stage(live.where("len = e AND pos = e").select("hc", "e", "conv"), "ends")
    turn = [*head, "tid"]
    first = live.where(F.col("pos") == F.col("e") + 1)
    children = first.groupBy(*turn).agg(F.min("conv").alias("cc"), F.count("*").alias("cn"), F.sum(F.col("len") - F.col("e")).alias("size"))
    members = stage(first.select(*turn, "conv").join(stage(children, "children"), turn).select("conv", "cc", "cn", F.col("size").alias("cs")), "members")
    after = live.where("pos > e").join(members, "conv").select(
        F.col("cc").alias("hc"), (F.col("e") + 1).alias("hd"), F.col("hc").alias("hp"), F.col("cn").alias("n"), F.col("cs").alias("size"), "conv", "pos", "tid", "bytes", "cum", "len")
    after = stage(after, "burst")
    return after.where(large), run, end, after.where(~large)


def _chains(rows: DataFrame) -> DataFrame:
    """Nodes of containers with one member: each of its rows is a node."""
    last = F.col("pos") == F.col("len")
    return rows.select(
        F.col("conv").alias("conv_id"), F.col("pos").alias("depth"), F.when(F.col("pos") == F.col("hd"), F.col("hp")).otherwise(F.col("conv")).alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"), F.sha2(F.when(last, F.col("conv").cast("string")).otherwise(F.lit("")).cast("binary"), 256).alias("ends_sha256"),
        (F.col("pos") == F.col("hd")).alias("head"))


def sweep_container(members: list[tuple[tuple[bytes, ...], tuple[int, ...], int]], head_bytes: int) -> list[list[Any]]:
    """Nodes of one container from its members' suffixes: ``[level, smallest, parent's place, n, children, leaves, saved, ends]``.

    ``members`` are (turn ids behind the head, their bytes, conversation). Sorted suffixes are swept
    with a stack of the open nodes; level 0 is the head. A parent's place in the list is before its children's.
    """
    nodes: list[list[Any]] = [[0, None, None, 0, 0, 0, 0, []]]
    sizes, stack, previous = [head_bytes], [0], ()
    for tids, lengths, conv in sorted(members):
        common = 0
        while common < len(previous) and common < len(tids) and previous[common] == tids[common]:
            common += 1
        del stack[common + 1 :]
        for level in range(common + 1, len(tids) + 1):
            nodes.append([level, None, stack[-1], 0, 0, 0, 0, []])
            sizes.append(lengths[level - 1])
            nodes[stack[-1]][4] += 1
            stack.append(len(nodes) - 1)
        for place in stack:
            node = nodes[place]
            node[1] = conv if node[1] is None else min(node[1], conv)
            node[3] += 1
        nodes[stack[-1]][7].append(conv)
        previous = tids
    for place in range(len(nodes) - 1, -1, -1):
        node = nodes[place]
        node[5] = node[5] or 1
        node[6] += (node[3] - 1) * sizes[place]
        if node[2] is not None:
            nodes[node[2]][5] += node[5]
            nodes[node[2]][6] += node[6]
    return nodes


def sweep(rows: DataFrame) -> DataFrame:
    """Nodes of settled containers; ``head`` marks each container's own node."""
    order = ["hc", "hd", "conv", "pos"]
    dealt = rows.select("hc", "hd", "hp", "conv", "pos", "tid", "bytes").repartition("hc", "hd").sortWithinPartitions(*order)
    names = [x.split()[0] for x in NODE.split(", ")] + ["head"]

    def nodes_of(key: tuple, members: list) -> Iterator[tuple]:
        _, depth, parent = key
        found = sweep_container([(tuple(t for t, _ in turns[1:]), tuple(b for _, b in turns[1:]), conv) for conv, turns in members], members[0][1][0][1])
        for level, conv, up, n, children, leaves, saved, ends in found:
            text = ",".join(map(str, sorted(ends))).encode()
            yield conv, depth + level, parent if up is None else found[up][1], n, children, leaves, saved, hashlib.sha256(text).hexdigest(), up is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, out = None, [], []

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64()] * 7 + [pa.string(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for hc, hd, hp, conv, _, tid, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (hc, hd, hp) != key:
                    if members:
                        out.extend(nodes_of(key, members))
                    key, members = (hc, hd, hp), []
                    if len(out) > 50_000:
                        yield batch_of(out)
                        out = []
                if not members or members[-1][0] != conv:
                    members.append((conv, []))
                members[-1][1].append((tid, size))
        if members:
            out.extend(nodes_of(key, members))
        if out:
            yield batch_of(out)

    return dealt.mapInArrow(run, NODE + ", head boolean")


def hash_members(ends: DataFrame, piece: int = 1 << 20) -> DataFrame:
    """``hc e sha``: SHA-256 of the ascending, comma-joined conversations of each node.

    Sorted ranges first join their ids into texts of at most about ``piece`` bytes; these are then
    hashed in order, one after another, so no node's list is ever held whole.
    """
    node = ["hc", "e"]

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, size = None, [], 0

        def text() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"hc": pa.array([key[0]], pa.int64()), "e": pa.array([key[1]], pa.int64()), "first": pa.array([int(ids[0])], pa.int64()),
                                               "ids": pa.array([",".join(ids)], pa.string())})

        for batch in batches:
            for hc, e, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (hc, e) != key or size >= piece:
                    if ids:
                        yield text()
                    key, ids, size = (hc, e), [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield text()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, hashlib.sha256()

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"hc": pa.array([key[0]], pa.int64()), "e": pa.array([key[1]], pa.int64()), "sha": pa.array([sha.hexdigest()], pa.string())})

        for batch in batches:
            for hc, e, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (hc, e) != key:
                    if key is not None:
                        yield row()
                    key, sha = (hc, e), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
        if key is not None:
            yield row()

    joined = ends.select(*node, "conv").repartitionByRange(*node, "conv").sortWithinPartitions(*node, "conv").mapInArrow(join_ids, "hc long, e long, first long, ids string")
    return joined.repartition(*node).sortWithinPartitions(*node, "first").mapInArrow(digest, "hc long, e long, sha string")
