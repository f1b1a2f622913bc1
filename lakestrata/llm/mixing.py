"""Mixing sources to target weights: temperature mixing with budgeted block permutations.

Weights are the sources' token shares raised to an exponent and normalised. The exponent is found
by bisection: for a target entropy, or as the largest flattening whose repetition stays within a
limit. Weights are then realised against a token budget: whole epochs of a source first, then a
cut of one more permutation of its blocks. Per-row work is a map; only sums per (source, block)
are shuffled, with map-side partial sums, so a hot source costs no more than its rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, words

BLOCKS = 256  # blocks of a source
SLICE_BITS = 54  # a block's rows in 1024 slices of the hash range


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def tempered(tokens: list[int], exponent: float) -> list[float]:
    """Shares to the power ``exponent``, normalised; sources without tokens get weight 0."""
    total = sum(tokens)
    raised = [(t / total) ** exponent if t else 0.0 for t in tokens]
    norm = sum(raised)
    return [r / norm for r in raised]


def repetition(tokens: list[int], weights: list[float]) -> float:
    """Passes over the most repeated source when every source is passed over at least once."""
    per_token = [w / t for t, w in zip(tokens, weights, strict=True) if t]
    return max(per_token) / min(per_token)


def solve_exponent(tokens: list[int], *, target_entropy: float | None = None, max_repetition: float | None = None,
                   steps: int = 60) -> float:
    """Exponent in [0, 1] by bisection (1 keeps the shares, 0 makes the sources equal).

    ``target_entropy``: the entropy falls as the exponent grows; a target outside the reachable
    span gives the nearer end. ``max_repetition``: the least exponent whose most repeated source
    is passed over at most so many times while no source is passed over less than once.
    """
    if (target_entropy is None) == (max_repetition is None):
        raise ValueError("give a target entropy or a repetition limit")
    if max_repetition is not None and max_repetition < 1:
        raise ValueError("a repetition limit is 1 or more")
    if not any(tokens):
        return 1.0

    def flat_enough(x: float) -> bool:  # true: the exponent can grow
        w = tempered(tokens, x)
        return entropy(w) > target_entropy if target_entropy is not None else repetition(tokens, w) > max_repetition

    if not flat_enough(0.0):
        return 0.0
    lo, hi = 0.0, 1.0
    for _ in range(steps):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if flat_enough(mid) else (lo, mid)
    return hi


@dataclass(frozen=True)
class SourcePlan:
    source: str | None
    tokens: int
    weight: float
    budget: int  # tokens to take
    epochs: int  # whole passes
    rest: int  # tokens of one more, cut pass


def plan_sources(totals: list[tuple[str | None, int]], exponent: float, budget: int | None) -> list[SourcePlan]:
    """Budget of each source. No ``budget``: the least one that passes over every source once."""
    tokens = [t for _, t in totals]
    if not any(tokens):
        return [SourcePlan(s, t, 0.0, 0, 1, 0) for s, t in totals]
    weights = tempered(tokens, exponent)
    whole = budget if budget is not None else max(t / w for t, w in zip(tokens, weights, strict=True) if t)
    out = []
    for (s, t), w in zip(totals, weights, strict=True):
        take = round(whole * w)
        if budget is None:
            take = max(take, t)
        out.append(SourcePlan(s, t, w, take, take // t if t else 1, take % t if t else 0))
    return out


def mix_sources(docs: DataFrame, *, text: str = "text", source: str = "source", id_col: str = "doc_id",
                target_entropy: float | None = None, max_repetition: float | None = 2.0, budget: int | None = None,
                seed: int = 17, max_sources: int = 100_000, keep_text: bool = True) -> tuple[DataFrame, float, list[SourcePlan]]:
    """Rows of ``docs``, each as often as its source's weight asks, with their place in the mix.

    Adds ``n_tokens`` (words of the text; null: 0), ``epoch`` (from 0), ``block``, ``mix_key``
    (share of the source's budget that precedes the block: sorting by ``mix_key, mix_tie``
    interleaves the sources at their weights) and ``mix_tie``. Rows are written once with their number, and a
    hash of id and number deals them to blocks, so null or repeated ids spread like others. Each
    epoch orders the source's blocks anew, and the rows in a block by that hash. The cut pass takes whole blocks in its order
    and of the next block the rows that come first, up to the budget: it falls short of it by
    less than one text. A row without tokens is taken in whole passes only, or once.
    With no ``budget`` every row is taken at least once. Null is a source of its own; repeated
    rows count each. ``keep_text=False`` leaves the texts out of the result. An empty table gives an empty result. Input columns named as those added are
    replaced. Totals come to the driver: a row for each source, ValueError beyond
    ``max_sources``.
    """
    spark = docs.sparkSession
    added = ("n_tokens", "epoch", "block", "mix_key", "mix_tie")
    keep = [c for c in docs.columns if c not in added and (keep_text or c != text)]
    words_of = F.greatest(F.coalesce(F.size(words(F.col(f"`{text}`"))), F.lit(0)), F.lit(0)).cast("long")
    base = docs.select(*[F.col(f"`{c}`") for c in keep], words_of.alias("n_tokens"), F.coalesce(F.xxhash64(F.col(f"`{source}`")), F.lit(0)).alias("_src"),
                       F.xxhash64(F.col(f"`{id_col}`"), F.monotonically_increasing_id(), F.lit(seed)).alias("_h"))
    base = stage(base, "mixed").withColumn("block", F.pmod(F.xxhash64("_h"), F.lit(BLOCKS)).cast("int"))  # words are counted once
    blocks = base.groupBy(F.col(f"`{source}`").alias("source"), F.col("_src"), "block").agg(F.sum("n_tokens").alias("tokens"))
    sums = blocks.groupBy("source", "_src").agg(F.sum("tokens").alias("tokens")).limit(max_sources + 1).collect()
    if len(sums) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    sums = sorted(sums, key=lambda r: (r.source is not None, r.source or ""))
    if target_entropy is not None:
        max_repetition = None
    exponent = solve_exponent([r.tokens for r in sums], target_entropy=target_entropy, max_repetition=max_repetition)
    plans = plan_sources([(r.source, r.tokens) for r in sums], exponent, budget)
    plan_rows = [(r._src, p.epochs, p.rest, p.tokens, p.budget, p.weight) for r, p in zip(sums, plans, strict=True)]
    plan = spark.createDataFrame(plan_rows, "_src long, _epochs long, _rest long, _tokens long, _budget long, weight double")

    # every (source, epoch, block): its place in that epoch's permutation and the tokens before it
    epochs = (blocks.join(F.broadcast(plan), "_src")  # a row for each source: bounded by max_sources
              .withColumn("epoch", F.explode(F.expr("sequence(0L, greatest(0L, _epochs - 1L + CAST(_rest > 0 AS BIGINT)))"))))
    epochs = epochs.where("epoch < _epochs OR _rest > 0")
    order = Window.partitionBy("_src", "epoch").orderBy(F.xxhash64("_src", "epoch", "block", F.lit(seed)), "block")
    placed = epochs.withColumn("_before", F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    cut = placed.where("epoch = _epochs AND _before <= _rest AND _before + tokens > _rest")
    # of the block that the budget cuts, the rows in hash order up to it: the last hash that fits. Whole
    # slices of the hash range are told by their sums; only the slice that the budget cuts is gone through
    room = cut.select("_src", "block", (F.col("_rest") - F.col("_before")).alias("_room"))
    narrow = base.select("_src", "block", "_h", "n_tokens", F.shiftright("_h", SLICE_BITS).alias("_slice")).join(F.broadcast(room), ["_src", "block"])
    by_slice = Window.partitionBy("_src", "block").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (narrow.groupBy("_src", "block", "_slice", "_room").agg(F.sum("n_tokens").alias("_t"))
              .withColumn("_sum", F.coalesce(F.sum("_t").over(by_slice), F.lit(0))).where("_sum <= _room"))
    whole = slices.where("_sum + _t <= _room").select("_src", "block", (F.shiftleft("_slice", SLICE_BITS) + ((1 << SLICE_BITS) - 1)).alias("_last"))
    last = slices.where("_sum + _t > _room").select("_src", "block", "_slice", "_sum")  # one for each source
    row_order = Window.partitionBy("_src").orderBy("_h").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inner = (narrow.join(F.broadcast(last), ["_src", "block", "_slice"]).withColumn("_run", F.col("_sum") + F.sum("n_tokens").over(row_order))
             .where("_run <= _room").select("_src", "block", F.col("_h").alias("_last")).unionByName(whole)
             .groupBy("_src", "block").agg(F.max("_last").alias("_last")))
    taken = (placed.where("epoch < _epochs OR _before + tokens <= _rest").withColumn("_last", F.lit((1 << 63) - 1))
             .unionByName(cut.drop("_last").join(inner, ["_src", "block"])))
    taken = taken.select("_src", "block", "epoch", "_last", "weight",
                         ((F.col("epoch") * F.col("_tokens") + F.col("_before")) / F.greatest(F.col("_budget"), F.lit(1))).alias("mix_key"))
    # at most sources x BLOCKS rows, each with its epochs: a proven bound for the broadcast
    per_block = taken.groupBy("_src", "block").agg(F.collect_list(F.struct("epoch", "mix_key", "_last", "weight")).alias("_e"))
    out = base.join(F.broadcast(per_block), ["_src", "block"])
    out = out.select("*", F.explode("_e").alias("_x")).where("_h <= _x._last AND (n_tokens > 0 OR _x.epoch = 0 OR _x._last = 9223372036854775807)")
    out = out.select(*[f"`{c}`" for c in keep], "n_tokens", F.col("_x.epoch").cast("int").alias("epoch"), "block",
                     F.col("_x.mix_key").alias("mix_key"), F.xxhash64("_h", "_x.epoch").alias("mix_tie"),
                     F.col("_x.weight").alias("weight"))
    return out, exponent, plans
