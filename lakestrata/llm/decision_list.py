"""Quality rules: a learned decision list over text statistics (sequential covering).

Statistics, training counts and the rules themselves are DataFrame expressions; the driver sees
only counts per (feature, bin), never rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE_SPACE, stage, words

#: Fixed value: the characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"

BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_statistics(df: DataFrame, text: str = "text", drop_text: bool = True) -> DataFrame:
    """Adds ``n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed`` for each row.

    Null and empty texts have zero in every count and fail the base rule. The statistics of a
    row need that row alone, so there is no shuffle whatever its length. Columns of these names
    that the input already has are replaced.
    """
    keep = [c for c in df.columns if c not in (*BASE_COLUMNS, "base_failed") and not (drop_text and c == text)]
    t = F.coalesce(F.col("_t"), F.lit(""))
    out = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_t"))
    out = out.withColumn("_w", words(t))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.select(
        *[f"`{c}`" for c in keep], "_w",
        F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace(t, WHITE_SPACE + "+", "")).cast("long").alias("word_chars"),
        (F.char_length(t) - F.char_length(F.regexp_replace(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("_l"),
    )
    # a window's hash and its place share one long (as many low bits as places need), so the sort
    # is one of plain longs; candidates that agree in the high bits are then compared in full
    out = out.select(
        "*",
        F.expr("CASE WHEN size(_w) >= 3 THEN transform(sequence(0, size(_w) - 3), i -> xxhash64(_w[i], _w[i+1], _w[i+2])) END").alias("_h"),
        F.expr("64 - length(trim(LEADING '0' FROM bin(CAST(size(_w) AS BIGINT))))").alias("_k"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
    ).drop("_w", "_l")
    out = out.withColumn("_p", F.expr(
        "sort_array(transform(_h, (h, i) -> shiftleft(shiftright(h, 64 - _k), 64 - _k) | CAST(i AS BIGINT)))"))
    same = "shiftright(get(_p, {0}), 64 - _k) = shiftright(x, 64 - _k)"
    out = out.withColumn("_c", F.expr(
        f"filter(_p, (x, k) -> coalesce({same.format('k - 1')}, false) OR coalesce({same.format('k + 1')}, false))"))
    out = out.withColumn("_s", F.expr(
        "sort_array(transform(_c, x -> named_struct('h', _h[CAST(x & (shiftleft(1L, 64 - _k) - 1) AS INT)],"
        " 'i', CAST(x & (shiftleft(1L, 64 - _k) - 1) AS INT))))")).drop("_p", "_c", "_h", "_k")
    out = out.withColumn("_i", F.expr(
        "sort_array(transform(filter(_s, (s, k) -> coalesce(get(_s, k - 1).h = s.h, false)"
        " OR coalesce(get(_s, k + 1).h = s.h, false)), s -> s.i))")).drop("_s")
    covered = F.expr(
        "CASE WHEN coalesce(size(_i), 0) < 1 THEN 0L ELSE aggregate(_i, named_struct('n', 3L, 'last', _i[0]),"
        " (a, i) -> named_struct('n', a.n + least(3, i - a.last), 'last', i), a -> a.n) END")
    out = out.withColumn("n_repeat_words", covered).drop("_i")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # a one-row generator: a filter on a statistic stays above it, where the optimizer would
    # otherwise copy the whole chain of array expressions into the filter
    stats = F.struct(*BASE_COLUMNS, failed.alias("base_failed"))
    return out.select(*[f"`{c}`" for c in keep], F.inline(F.array(stats)))


def default_features() -> dict[str, Column]:
    """Ratios that the rules may test; every one is defined (0 for an empty text)."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word_chars": F.col("word_chars") / n,
        "symbols_per_word": F.col("n_symbols") / n,
        "dup_lines_per_word": F.col("n_dup_lines") / n,
        "repeated_share": F.col("n_repeat_words") / n,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        x = F.col(self.feature)
        return x >= self.threshold if self.at_least else x < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " AND ".join(map(str, self.conditions))


@dataclass
class DecisionList:
    """Ordered rules; the first that holds decides (reject), none: keep."""

    rules: list[Rule] = field(default_factory=list)

    def verdict(self) -> Column:
        """Number of the first rule that holds, as an ordered conditional expression (null: none)."""
        out = None
        for k, r in enumerate(self.rules):
            out = F.when(r.column(), F.lit(k)) if out is None else out.when(r.column(), F.lit(k))
        return F.lit(None).cast("int") if out is None else out


def _counts(df: DataFrame, features: list[str], thresholds: dict[str, list[float]]) -> dict[tuple[str, int], tuple[int, int]]:
    """(feature, bin) -> (target rows, other rows); one aggregate, at most features x bins rows come back."""
    bins = F.array(*[
        F.struct(F.lit(f).alias("f"), sum(((F.col(f) >= t).cast("int") for t in thresholds[f]), F.lit(0)).alias("b"))
        for f in features if thresholds[f]])
    rows = (df.select("target", F.explode(bins).alias("x")).groupBy("x.f", "x.b")
            .agg(F.count_if("target").alias("p"), F.count_if(~F.col("target")).alias("n")).collect())
    return {(r.f, r.b): (r.p, r.n) for r in rows}


def _totals(df: DataFrame, tests: list[Column]) -> list[tuple[int, int]]:
    """(target, other) rows under each test, in one aggregate."""
    aggs = [a for k, t in enumerate(tests) for a in (
        F.count_if(t & F.col("target")).alias(f"p{k}"), F.count_if(t & ~F.col("target")).alias(f"n{k}"))]
    r = df.agg(*aggs).first()
    return [(r[f"p{k}"], r[f"n{k}"]) for k in range(len(tests))]


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def learn_decision_list(sample: DataFrame, features: list[str], *, max_rules: int = 8, max_conditions: int = 4,
                        bins: int = 32, min_precision: float = 0.9, min_cover: int = 3) -> DecisionList:
    """Sequential covering over ``sample`` (boolean ``target`` and double feature columns).

    Grow: on two thirds of the rows, add the threshold test with the largest information gain
    until no other row is covered or nothing gains. Prune: on the other third, drop final tests
    while that raises (p - n) / (p + n). A rule is accepted if it covers ``min_cover`` target rows
    of the growing part and its precision over both parts is ``min_precision`` or more; covered
    rows leave before the next rule. Candidate thresholds are quantiles of the target rows and of
    the others, half way to the next one. Ties go to the feature named first and the lower threshold. No target rows or no
    rows at all: an empty list, which keeps everything.
    """
    grow, prune = sample.where("part < 2"), sample.where("part = 2")
    share = [k / bins for k in range(bins + 1)]
    q = sample.groupBy("target").agg(*[F.percentile_approx(f, share, 10000).alias(f) for f in features]).collect()
    values = {f: sorted({float(v) for r in q for v in (r[f] or []) if v is not None and math.isfinite(v)}) for f in features}
    thresholds = {f: [(a + b) / 2 for a, b in zip(vs, vs[1:], strict=False)] for f, vs in values.items()}
    out = DecisionList()
    left: Column = F.lit(True)
    while len(out.rules) < max_rules:
        [(p0, n0)] = _totals(grow, [left])
        if p0 < min_cover or not n0 and out.rules:
            break
        chosen: list[Condition] = []
        while len(chosen) < max_conditions and p0 and n0:
            counts = _counts(grow.where(left & Rule(tuple(chosen)).column()), features, thresholds)
            best: tuple[float, Condition | None, int, int] = (1e-9, None, 0, 0)
            for f in features:
                ts = thresholds[f]
                below = [0, 0]
                for k, t in enumerate(ts):
                    p, n = counts.get((f, k), (0, 0))
                    below = [below[0] + p, below[1] + n]
                    for at_least, (cp, cn) in ((False, below), (True, (p0 - below[0], n0 - below[1]))):
                        if cp >= min_cover and (cp, cn) != (p0, n0) and (g := _gain(cp, cn, p0, n0)) > best[0]:
                            best = (g, Condition(f, at_least, t), cp, cn)
            if best[1] is None:
                break
            chosen.append(best[1])
            p0, n0 = best[2], best[3]
        if not chosen:
            break
        prefixes = [Rule(tuple(chosen[:k])) for k in range(1, len(chosen) + 1)]
        on_prune = _totals(prune, [left & r.column() for r in prefixes])
        on_grow = _totals(grow, [left & r.column() for r in prefixes])
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in on_prune]
        k = max(range(len(prefixes)), key=lambda i: (worth[i], -i)) if max(worth) > -1 else len(prefixes) - 1
        p, n = on_prune[k][0] + on_grow[k][0], on_prune[k][1] + on_grow[k][1]
        if p < min_cover or p / (p + n) < min_precision:
            break
        out.rules.append(prefixes[k])
        left = left & ~prefixes[k].column()
    return out


def quality_rules(docs: DataFrame, labels: DataFrame, *, max_labelled: int = 20_000, drop_text: bool = True,
                  features: dict[str, Column] | None = None, **options) -> tuple[DataFrame, DecisionList]:
    """Text statistics of every row of ``docs`` with ``base_failed``, ``rule`` and ``kept``.

    The list is learned from at most ``max_labelled`` labelled documents (those of least
    ``xxhash64(doc_id)``; a documented bound on the training rows alone) that pass the base rule
    and have a quality of 0 (target) or 1. ``rule`` is the number of the rule that rejects a row,
    else null; ``kept`` is false for rows that fail the base rule or that a rule rejects. Null
    and repeated labels: null ones are left out, of repeated ones the lowest counts. Empty
    tables give an empty result or an empty list. Null texts count as empty.
    """
    feats = features or default_features()
    chosen = (labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    # at most max_labelled rows of two numbers: a proven bound for the broadcast
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = text_statistics(labelled).where("NOT base_failed").select(
        (F.col("quality") == 0).alias("target"), (F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3))).alias("part"),
        *[c.alias(f) for f, c in feats.items()])
    rules = learn_decision_list(stage(sample, "labelled"), list(feats), **options)
    out = text_statistics(docs, drop_text=drop_text)
    out = out.select("*", F.struct(*[c.alias(f) for f, c in feats.items()]).alias("_x"))
    first = DecisionList([Rule(tuple(Condition(f"_x.{c.feature}", c.at_least, c.threshold) for c in r.conditions)) for r in rules.rules]).verdict()
    out = out.withColumn("rule", first).drop("_x")
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), rules
