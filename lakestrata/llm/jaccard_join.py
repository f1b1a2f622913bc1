"""N-gram Jaccard self-join with adaptive multi-match prefixes, and the groups it links.

Shingles get one global order, the common ones last. Two sets that reach the threshold t share at
least l of the first |x| - ceil(t|x|) + l shingles of either (for every l). A document whose prefix
would meet many candidates gets a larger l: a longer prefix, of which a partner must share
correspondingly more before the pair is verified on the whole sets.

Documents with equal sets are one set. Sets that share prefix shingles are linked round by round:
a round verifies for each group its best candidate among the leaders of its lists. The last step takes
every pair still in two groups that upper bounds on the shared shingles leave, verifies the likeliest
first and then those that are still apart. A pair left out lies in one group or cannot link, so the
groups are exact. Copies cost about n verifications; near copies around the threshold that don't link
cost one per pair that the bounds leave, and their lists are compared pair by pair inside the join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, stage

SLOT_BITS, SLOTS = 14, 128  # the count sketch: 128 slots of 2^14 counters
MOST_MATCHES = 8000  # largest l
STEP = 16  # one more match for so many shingles of a set, whatever its cost
SALTS = 32
LEADERS = 4  # sets of a list that lead it in one round
WORDS = 8  # 64-bit words of the bit map of a set's listed shingles, a power of two
LIST_ROWS = 4096  # rows of a list that one task compares; larger lists are cut into blocks
PAIRS = 1 << 17  # pairs that a task looks at together


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text: A-Z lower-cased, words split at ASCII
    white space; fewer words than ``width``: the whole sequence as one; no words or null: empty."""
    import xxhash

    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    ends, flat = words.offsets.to_numpy(), words.flatten()
    base = int(ends[0]) if len(ends) else 0
    ends = ends - base
    coded = flat.dictionary_encode()
    known = coded.dictionary.to_pylist()
    value = np.fromiter((xxhash.xxh64_intdigest(w) for w in known), np.uint64, len(known))
    code = coded.indices.to_numpy(zero_copy_only=False)
    real = np.fromiter((bool(w) for w in known), bool, len(known))[code] if len(known) else np.zeros(0, bool)
    at = np.concatenate([[0], np.cumsum(real)])[ends]  # empty strings at either end are no words
    h = value[code[real]] if len(known) else np.zeros(0, np.uint64)
    joint = _mix(h[: len(h) - width + 1] + np.uint64(width)) if len(h) >= width else np.zeros(0, np.uint64)
    for k in range(1, width):
        if len(joint):
            joint = _mix(joint * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k])
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= width:
            yield np.unique(joint[a : b - width + 1])
        elif b > a:
            one = np.uint64(b - a)
            for x in h[a:b]:
                one = _mix(np.array([one], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + x)[0]
            yield np.array([one], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def _pieces(batches: Iterator[pa.RecordBatch], at: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each hold about ``most`` bytes."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, done + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def set_key(hashes: np.ndarray) -> int:
    """64-bit key of a set; with the set's size it stands for the set."""
    with np.errstate(over="ignore"):
        return int(_mix(_mix(hashes + np.uint64(1)).sum(dtype=np.uint64).reshape(1) + np.uint64(len(hashes)))[0].astype(np.int64))


def least_overlap(n: int, percent: int) -> int:
    """Shingles that any partner must share with a set of ``n``."""
    return -(-percent * n // 100)


def _first_pass(docs: DataFrame, width: int) -> DataFrame:
    """Set key and size of every row, and the counters of the shingle sketch, a row per slot and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS << SLOT_BITS, np.int64)
        names = ["doc_id", "row", "set", "n", "slot", "counts"]
        for part in _pieces(batches, 2):
            sets = list(shingle_sets(part.column(2), width))
            keys = pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())
            sizes = pa.array([len(s) for s in sets], pa.int64())
            every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            counts += np.bincount((every >> np.uint64(64 - SLOT_BITS - 7)).astype(np.int64), minlength=len(counts))
            none = pa.nulls(part.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), keys, sizes, none, pa.nulls(part.num_rows, pa.binary())], names=names)
        rows = [(k, s.astype("<u4").tobytes()) for k, s in enumerate(counts.reshape(SLOTS, -1)) if s.any()]
        if rows:
            yield pa.RecordBatch.from_arrays([*[pa.nulls(len(rows), pa.int64())] * 4,
                                              pa.array([k for k, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], names=names)

    return docs.mapInArrow(run, "doc_id long, row long, set long, n long, slot int, counts binary")


def _excess(sketch: DataFrame) -> np.ndarray:
    """Estimated number of other sets that hold a shingle, by counter (0: no more than chance).

    The counters of all tasks are added slot by slot, streaming; 2^21 sums reach the driver
    whatever the input.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(b, "<u4").astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.astype("<i8").tobytes() for s in sums.values()], pa.binary())],
                                             names=["slot", "counts"])

    out = np.zeros((SLOTS, 1 << SLOT_BITS), np.int64)
    for r in sketch.repartition(8, "slot").mapInArrow(add, "slot int, counts binary").collect():
        out[r.slot] += np.frombuffer(r["counts"], "<i8")
    mean = out.mean()
    out = out.reshape(-1) - mean
    return np.where(out > 8 + 6 * math.sqrt(mean), out, 0).astype(np.float32)


def matches_needed(cost: float, prefix: int, overlap: int) -> int:
    """l of a set: in proportion to its size, and 2 more for each doubling of the mean number of candidates per prefix shingle."""
    n = prefix + overlap - 1
    return max(1, min(1 + n // STEP + int(2 * math.log2(1 + cost / max(prefix, 1))), MOST_MATCHES, overlap))


def prefix_of(hashes: np.ndarray, excess: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The prefix of a set in the global order (rare first, then by hash), each shingle's level, and l.

    The shingle at place i has level max(1, i - base + 1), base = |x| - ceil(t|x|) + 1: it belongs
    to the prefixes of that l and above.
    """
    n = len(hashes)
    overlap = least_overlap(n, percent)
    base = n - overlap + 1
    common = excess[(hashes >> np.uint64(64 - SLOT_BITS - 7)).astype(np.int64)]
    if common.any():
        order = np.argsort(np.ceil(np.log2(1 + common)), kind="stable")
        hashes, common = hashes[order], common[order]
    need = matches_needed(float(common[:base].sum()), base, overlap)
    # a prefix that can do without common shingles is not lengthened into them
    rare = int((common == 0).sum())
    if base <= rare:
        need = min(need, rare - base + 1)
    last = base + need - 1
    return hashes[:last], np.maximum(1, np.arange(1, last + 1) - base + 1), need


def _postings(docs: DataFrame, width: int, percent: int, excess: np.ndarray) -> DataFrame:
    """A row per prefix shingle: ``token set n need level hot``."""
    shared = docs.sparkSession.sparkContext.broadcast(excess)  # 8 MB, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over = shared.value
        for part in _pieces(batches, 0, 1 << 20):
            tokens, keys, meta = [], [], []
            for s in shingle_sets(part.column(0), width):
                if len(s):
                    t, level, need = prefix_of(s, over, percent)
                    tokens.append(t)
                    keys.append(np.full(len(t), set_key(s), np.int64))
                    meta.append((len(s) << 28) | (need << 15) | (level << 1) | (over[(t >> np.uint64(64 - SLOT_BITS - 7)).astype(np.int64)] > 0))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(keys)),
                                                  pa.array(np.concatenate(meta).astype(np.int64))], names=["token", "set", "meta"])

    return docs.mapInArrow(run, "token long, set long, meta long")


def _size(meta: str) -> Column:
    return F.shiftright(meta, 28)


def _enough(a: str, b: str, percent: int) -> Column:
    """Sizes that can reach the threshold at all."""
    return (100 * F.least(_size(a), _size(b))) >= percent * F.greatest(_size(a), _size(b))


def _matched(a: str, b: str) -> tuple[Column, Column]:
    """l of a pair (the smaller of the two) and whether a shared shingle counts at it."""
    part = lambda m, shift, mask: F.shiftright(m, shift).bitwiseAND(F.lit(mask))
    need = F.least(part(a, 15, 8191), part(b, 15, 8191))
    level = F.greatest(part(a, 1, 16383), part(b, 1, 16383))
    return need, level <= need


def _fewest(a: str, b: str, need: Column, percent: int) -> Column:
    """Shared shingles that a pair must have in its prefixes: l, and what its overlap needs beyond
    the longer suffix (all they share behind the prefix that ends first lies in that set's suffix)."""
    both, largest = _size(a) + _size(b), F.greatest(_size(a), _size(b))
    overlap = F.ceil(percent * both / (100 + percent) - F.lit(1e-9))
    return F.greatest(need, overlap - F.ceil(percent * largest / 100 - F.lit(1e-9)) + need)


def _candidates(rows: dict[str, np.ndarray], percent: int, best_only: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places ``(a, b)`` of the plausible pairs in whole lists, and the classes their maps share.

    ``rows`` are sorted by list (``token lo hi``), side, and the list's largest group last. A row outside that
    group meets the rows behind it, or those of the other side; a row of it the other side's rows outside.
    """
    n = len(rows["token"])
    new = np.flatnonzero(np.concatenate([[True], np.any([rows[c][1:] != rows[c][:-1] for c in ("token", "lo", "hi")], axis=0)]))
    size = np.diff(np.append(new, n))
    end = np.repeat(new + size, size)
    outside, right = ~rows["of"], rows["side"] == 1
    split = np.repeat(rows["lo"][new] != rows["hi"][new], size)
    from_right = np.repeat(new + np.add.reduceat(~right, new), size)  # where the other side starts
    right_outside = np.repeat(np.add.reduceat(right & outside, new), size)
    first = np.where(split, from_right, np.arange(n) + 1)
    last = np.where(split, np.where(outside, end, from_right + right_outside), np.where(outside, end, 0))
    count = np.where(split & right, 0, np.maximum(last - first, 0))
    meta = rows["meta"]
    sizes, need, level = meta >> 28, (meta >> 15) & 8191, (meta >> 1) & 16383
    words = np.stack([rows[f"w{i}"] for i in range(WORDS)], axis=1).view(np.uint64)
    dup = rows["k"] - np.bitwise_count(words).sum(axis=1)
    word, below = (rows["token"] >> 6) & (WORDS - 1), (np.uint64(1) << (rows["token"] & 63).astype(np.uint64)) - np.uint64(1)
    ends = np.cumsum(count)
    start = 0
    while start < n:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, "right")))
        own = np.arange(start, stop)
        x = np.repeat(own, count[start:stop])
        y = np.arange(len(x)) - np.repeat(np.cumsum(count[start:stop]) - count[start:stop], count[start:stop]) + first[x]
        start = stop
        fit = (rows["label"][x] != rows["label"][y]) & (100 * np.minimum(sizes[x], sizes[y]) >= percent * np.maximum(sizes[x], sizes[y]))
        fit &= np.maximum(level[x], level[y]) <= np.minimum(need[x], need[y])
        x, y = x[fit], y[fit]
        asked = np.minimum(need[x], need[y])
        overlap = -(-percent * (sizes[x] + sizes[y]) // (100 + percent))
        asked = np.maximum(asked, overlap + (-percent * np.maximum(sizes[x], sizes[y])) // 100 + asked)
        asked = np.maximum(asked - np.minimum(dup[x], dup[y]), 1)  # classes that their shared shingles lie in, at least
        both = words[x] & words[y]
        bits = np.bitwise_count(both).astype(np.int64)
        classes = bits.sum(axis=1)
        at = word[x]
        before = np.cumsum(bits, axis=1)[np.arange(len(x)), at] - bits[np.arange(len(x)), at] + np.bitwise_count(both[np.arange(len(x)), at] & below[x])
        fit = before + asked <= classes
        x, y, classes = x[fit], y[fit], classes[fit]
        if best_only and len(x):
            groups = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
            best = np.maximum.reduceat((classes << 32) - np.arange(len(x)), groups)
            pick = -(best - ((best + ((1 << 32) - 1)) >> 32 << 32))
            x, y, classes = x[pick], y[pick], classes[pick]
        if len(x):
            yield x, y, classes


def _plausible(listed: DataFrame, percent: int, best_only: bool = False) -> DataFrame:
    """``x y labela labelb met``: every pair of sets of two groups that may share as many listed
    shingles as it must, and how many it seems to share; ``best_only``: of each set in a list the likeliest.

    A bit map of a set's listed shingles bounds that: a bit set in one map alone is a shingle that the
    other set lacks. A pair comes out of few of its shared shingles, of one at least: those it must
    share lie in a known number of the classes (bits) that both maps have, so one of them lies among the
    first classes, as many as can be without a shared shingle and one more. A list's rows of its
    largest group meet the rows of the others only. Lists of over ``LIST_ROWS`` rows are cut into blocks, and
    each pair of blocks is a list of its own.
    """
    word, bit = F.col("token").bitwiseAND(F.lit(64 * WORDS - 1)), F.expr("shiftleft(1L, cast(token & 63 AS int))")
    maps = listed.groupBy("set").agg(F.count("*").alias("k"), *[F.bit_or(F.when(F.shiftright(word, 6) == i, bit).otherwise(F.lit(0))).alias(f"w{i}") for i in range(WORDS)])
    sizes = listed.groupBy("token", "label").agg(F.count("*").alias("n")).groupBy("token").agg(F.sum("n").alias("n"), F.max_by("label", F.struct("n", "label")).alias("main"))
    rows = listed.select("token", "set", "meta", "label").join(sizes, "token").withColumn("of", F.col("label") == F.col("main"))
    blocks = F.ceil(F.col("n") / LIST_ROWS).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("set"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).withColumn("side", (F.col("own") > F.col("lo")).cast("int"))
    rows = rows.select("token", "lo", "hi", "side", "of", "set", "meta", "label").join(maps, "set")  # the maps move once, to the lists
    names = ["token", "lo", "hi", "side", "of", "set", "meta", "label", "k", *[f"w{i}" for i in range(WORDS)]]
    rows = rows.select(*names).repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi", "side", "of")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
            cols = {c: table.column(c).to_numpy() for c in names}
            for x, y, met in _candidates(cols, percent, best_only):
                ends = [f(cols[c][x], cols[c][y]) for c in ("set", "label") for f in (np.minimum, np.maximum)]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (*ends, met)], names=["x", "y", "labela", "labelb", "met"])

        for batch in batches:
            keys = [batch.column(i).to_numpy() for i in range(3)]
            same = np.all([k == k[-1] for k in keys], axis=0)
            tail = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0  # the last list may go on
            if tail:
                yield from pairs(pa.Table.from_batches([*held, batch.slice(0, tail)]))
                held = []
            elif held and any(h.column(i)[-1] != batch.column(i)[0] for h in held[-1:] for i in range(3)):
                yield from pairs(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(tail))
        if held:
            yield from pairs(pa.Table.from_batches(held))

    found = rows.mapInArrow(run, "x long, y long, labela long, labelb long, met long")
    return found.groupBy("x", "y", "labela", "labelb").agg(F.max("met").alias("met"))


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) with ``linked``: the exact test on the whole sets."""
    left = sets.select(F.col("set").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("set").alias("b"), F.col("hashes").alias("hb"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    inter = F.size(F.array_intersect("ha", "hb"))
    return both.select("a", "b", (100 * inter >= percent * (F.size("ha") + F.size("hb") - inter)).alias("linked"))


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``set hashes`` of the wanted rows (``row``), as a written table. A bit map of fixed size
    spares the other rows the shingling; a row that it lets through by chance does no harm."""
    bits = 23
    place = F.pmod("row", F.lit(1 << bits)) + 1  # bucket k of the two bitmap functions holds 32768 places from 1 on
    rows = (wanted.select(F.bitmap_bucket_number(place).alias("k"), F.bitmap_bit_position(place).alias("p"))
            .groupBy("k").agg(F.bitmap_construct_agg("p").alias("m")).collect())
    bitmap = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows:  # at most 256 maps of 4 KB
        bitmap[(r.k - 1) * 4096 : r.k * 4096] |= np.frombuffer(r.m, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            at = batch.column(1).to_numpy(zero_copy_only=False) - 1
            hit = pa.array((known[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)
            for part in _pieces(iter([batch.filter(hit)]), 0):
                sets = [s for s in shingle_sets(part.column(0), width) if len(s)]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                                                 names=["set", "hashes"])

    return stage(docs.select("text", place.cast("long").alias("at")).mapInArrow(run, "set long, hashes array<long>"), "hashes")


def _labelled(postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return postings.withColumn("label", F.col("set"))
    named = labels.select(F.col("node").alias("set"), "label")
    return postings.join(named, "set", "left").withColumn("label", F.coalesce("label", "set"))


def linked_groups(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", width: int = 5, percent: int = 75,
                  rounds: int = 2, keyed: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``.

    Two rows are linked if ``100 * |x and y| >= percent * |x or y|`` on the sets of their distinct
    ``width``-word shingles (A-Z lower-cased, whole text; fewer words: the sequence as one).
    ``component_id`` is the smallest id that links reach, the row's own included. Null texts and
    texts without words have an empty set and no link: their component is their own id. Null ids
    never name a component unless no row of it has another (then null). Repeated rows all come
    back. Other columns are ignored. Shingles and sets are told apart by 64-bit hashes. ``keyed``
    adds ``row``, the ``xxhash64`` of id and text, and ``label``, one value for each group (null: empty set).
    """
    if not 0 < percent <= 100:
        raise ValueError("percent is over 0 and at most 100")
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # a row is found again by the hash of its id and text: ids may be null or repeated
    base = base.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    first = stage(_first_pass(base, width), "sets")
    excess = _excess(first.where("slot IS NOT NULL").select("slot", "counts"))
    rows = first.where("slot IS NULL").select("doc_id", "row", "set", "n")

    # shingles that only one set has in its prefix can link nothing: most rows end here
    hot = F.col("meta").bitwiseAND(F.lit(1)) == 1
    salt = F.when(hot, F.pmod("set", F.lit(SALTS))).otherwise(F.lit(0))
    w = Window.partitionBy("token", "salt")
    postings = _postings(base.select("text"), width, percent, excess).withColumn("salt", salt.cast("int"))
    postings = postings.withColumns({"low": F.min("set").over(w), "high": F.max("set").over(w)})
    postings = stage(postings.where(hot | F.expr("low != high")).select("token", "set", "meta").distinct(), "shared")

    # A set shares with any partner its own l shingles of the prefixes, or what the smallest partner
    # asks for by its size: if the partner's l was lowered, its prefix is all its rare shingles, and
    # then the set's own l are among them or the set has that many common shingles in its prefix.
    listed = postings.groupBy("set").agg(F.count("*").alias("k"), F.max("meta").alias("m"))
    own = F.shiftright("m", 15).bitwiseAND(F.lit(8191))
    smallest = F.ceil(percent * _size("m") / 100 - F.lit(1e-9))
    asked = F.least(1 + F.floor(smallest / STEP), F.ceil(percent * smallest / 100 - F.lit(1e-9)))
    listed = listed.where(F.col("k") >= F.least(own, asked)).select("set")
    postings = stage(postings.join(listed, "set", "left_semi"), "postings")

    tried: DataFrame | None = None
    labels: DataFrame | None = None

    def untried(pairs: DataFrame) -> DataFrame:
        return pairs if tried is None else pairs.join(tried.select(F.col("a").alias("x"), F.col("b").alias("y")), ["x", "y"], "left_anti")

    def check(pairs: DataFrame) -> bool:
        """Verifies pairs ``x y`` and merges the groups that they link; whether there were any."""
        nonlocal tried, labels
        pairs = stage(pairs.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "pairs")
        ends = pairs.select(F.col("a").alias("set")).union(pairs.select(F.col("b").alias("set"))).distinct()
        chosen = rows.where("set IS NOT NULL").join(ends, "set").groupBy("set").agg(F.min("row").alias("row"))
        checked = stage(_verify(pairs, _sets_of(base, chosen, width), percent).distinct(), "checked")
        tried = checked if tried is None else tried.unionByName(checked)
        if not checked.where("linked").limit(1).count():
            return False
        labels = connected_components(tried.where("linked").select("a", "b"))
        return True

    need, counts = _matched("ma", "mb")
    for k in range(rounds):
        listed = _labelled(postings, labels)
        # other sets lead a list in each round
        leads = [F.min(F.struct(F.xxhash64("set", F.lit(k * LEADERS + i)).alias("h"), "label", "set", "meta")) for i in range(LEADERS)]
        spans = (listed.groupBy("token").agg(F.array_distinct(F.transform(F.array(*leads), lambda x: x.dropFields("h"))).alias("leaders"),
                                             F.min("label").alias("first"), F.max("label").alias("last"))
                 .where("first != last").drop("first", "last"))
        listed = listed.join(spans, "token")
        # every group against the leaders of its lists, the best such pair only
        pairs = listed.select("set", "meta", F.col("label").alias("own"), F.explode("leaders").alias("low")).where("own != low.label").select(
            F.col("low.set").alias("a"), F.col("set").alias("b"), F.col("low.meta").alias("ma"), F.col("meta").alias("mb"), "own")
        pairs = (pairs.where(_enough("ma", "mb", percent) & counts).withColumn("need", need)
                 .groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), "own")
                 .agg(F.count("*").alias("shared"), F.max("need").alias("need")).where("shared >= need"))
        best = untried(pairs).groupBy("own").agg(F.max_by(F.struct("x", "y"), F.struct("shared", "x", "y")).alias("p"))
        if not check(best.select("p.x", "p.y")):
            break

    def apart() -> DataFrame:
        """The lists of several groups."""
        rows = _labelled(postings, labels)
        spans = rows.groupBy("token").agg(F.min("label").alias("first"), F.max("label").alias("last")).where("first != last").select("token")
        return stage(rows.join(spans, "token", "left_semi").select("token", "set", "meta", "label"), "listed")

    def likeliest(left: DataFrame) -> DataFrame:
        """The likeliest pairs of each group."""
        order = [F.desc("met"), "x", "y"]
        ranks = [F.row_number().over(Window.partitionBy(c).orderBy(*order)) for c in ("labela", "labelb")]
        best = [left.withColumn("r", r).where(F.col("r") <= LEADERS).select("x", "y") for r in ranks]
        return best[0].unionByName(best[1])

    # the likeliest partner of each set in each list
    check(likeliest(stage(untried(_plausible(apart(), percent, best_only=True)), "best")))
    # whatever two groups still share: each group's likeliest pairs, then all that are still in two groups
    left = stage(untried(_plausible(apart(), percent)), "left")
    check(likeliest(left))
    left = untried(left.select("x", "y"))
    if labels is not None:
        for end in ("x", "y"):
            left = left.join(labels.select(F.col("node").alias(end), F.col("label").alias(f"l{end}")), end, "left")
        left = left.where(F.coalesce("lx", "x") != F.coalesce("ly", "y")).select("x", "y")
    check(left)
    # rows of one set are one group, linked to others or not
    own = _labelled(rows.where("set IS NOT NULL"), labels).select("doc_id", F.col("n").alias("n_shingles"), "label", "row")
    least = own.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    keys = ["row", "label"] if keyed else []
    out = own.join(least, "label").select("doc_id", "n_shingles", "component_id", *keys)
    empty = rows.where("set IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                                 *(["row", F.lit(None).cast("long").alias("label")] if keyed else []))
    return out.unionByName(empty)
