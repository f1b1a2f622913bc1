"""Sharding by histogram sort: exact byte counts below candidate key boundaries, one exchange.

The sort key of a row is (hash of the text, hash of the id), so equal texts lie side by side and a
group of copies can still be cut where the balance needs it. Each probe round counts the exact
bytes and rows between evenly spaced candidate boundaries of the cells that are still too coarse;
cells shrink until every shard boundary meets the tolerance and no range is too large for a task.
Only then the rows move, once. DataFrame functions throughout.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

FIRST_BITS = 14  # probes of the first round: 2^14 cells
CELLS = 1 << 16  # probes of a later round at most
MAX_ROUNDS = 16


@dataclass
class Cell:
    """A half-open piece of the key order: rows and bytes in it, and the span of keys it holds."""

    rows: int
    size: int
    k1: tuple[int, int]
    k2: tuple[int, int]
    children: int = 0  # number of probes when it was refined
    level: int = 0
    code: int = 0
    dim: int = 1
    lo: int = 0
    step: int = 1


def _histogram(df: DataFrame) -> list:
    """Exact counts per (cell, probe); at most CELLS rows come to the driver."""
    return df.groupBy("cell").agg(
        F.count("*").alias("n"), F.sum("size").alias("s"), F.min("k1").alias("a1"), F.max("k1").alias("b1"),
        F.min("k2").alias("a2"), F.max("k2").alias("b2")).collect()


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus 16 for the row."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(16)


def shard_by_bytes(df: DataFrame, n_shards: int, *, text: str = "text", id_col: str = "doc_id", tolerance: float = 0.01,
                   range_bytes: int = 64 << 20, max_ranges: int = 8192) -> DataFrame:
    """All rows and columns of ``df`` with ``size``, ``shard`` (0 to n-1) and ``slot``.

    Shards hold nearly equal bytes: a boundary misses its target by at most ``tolerance`` of a
    shard, or by one row that is larger than that. ``slot`` numbers the rows of a shard from 0
    without gaps, in key order. Rows are sorted in ranges of about ``range_bytes`` (larger only
    once ``max_ranges`` ranges exist), each with an exact offset from the histogram, so no task
    holds a shard. Null texts count as size 16. Rows that agree in text and id have one key; if so
    many do that a boundary or a range must fall among them, the table is written once with row
    numbers and these go into the key. An empty table gives an empty result. Input columns named
    ``size``, ``shard`` or ``slot`` are replaced.
    """
    keep = [c for c in df.columns if c not in ("size", "shard", "slot")]
    out = _sharded(df, keep, F.xxhash64(F.col(f"`{id_col}`"), F.lit(1)), n_shards, text, id_col, tolerance, range_bytes, max_ranges)
    if out is not None:
        return out
    numbered = stage(df.select(*[F.col(f"`{c}`") for c in keep], F.monotonically_increasing_id().alias("_number")), "numbered")
    return _sharded(numbered, keep, F.xxhash64(F.col(f"`{id_col}`"), "_number"), n_shards, text, id_col, tolerance, range_bytes, max_ranges, numbered=True)


def _sharded(df: DataFrame, keep: list[str], second: Column, n_shards: int, text: str, id_col: str, tolerance: float,
             range_bytes: int, max_ranges: int, numbered: bool = False) -> DataFrame | None:
    """The rows in shards with ``second`` as second key; ``None`` if rows of one key must be cut and aren't numbered."""
    spark = df.sparkSession
    mask = F.lit((1 << 62) - 1)
    keyed = df.select(
        *[F.col(f"`{c}`") for c in keep], text_size(F.col(f"`{text}`")).alias("size"),
        F.xxhash64(F.col(f"`{text}`")).bitwiseAND(mask).alias("_k1"), second.bitwiseAND(mask).alias("_k2"))
    narrow = keyed.select("size", F.col("_k1").alias("k1"), F.col("_k2").alias("k2"))

    first = F.shiftright("k1", 62 - FIRST_BITS).cast("int")
    root: dict[int, Cell] = {r.cell: Cell(r.n, r.s, (r.a1, r.b1), (r.a2, r.b2), level=1, code=r.cell)
                             for r in _histogram(narrow.withColumn("cell", first))}
    total = sum(c.size for c in root.values())
    limit = max(range_bytes, -(-total // max_ranges))
    allowed = max(1.0, tolerance * total / n_shards)
    below = {1: root}  # level -> code -> cell
    order: list[Cell] = [root[k] for k in sorted(root)]
    tables: list[tuple[int, DataFrame]] = []  # the refined cells of each level, for locating rows
    located = narrow.withColumn("cell", first)
    for level in range(2, MAX_ROUNDS + 2):
        coarse, at = [], 0
        for c in order:
            end = at + c.size
            k = int(at * n_shards // total) + 1 if total else n_shards
            target = k * total / n_shards
            cut = k < n_shards and target < end and min(target - at, end - target) > allowed
            if not numbered and c.rows > 1 and c.k1[0] == c.k1[1] and c.k2[0] == c.k2[1] and (cut or c.size > limit):
                return None
            if c.level == level - 1 and c.rows > 1 and (c.k1[0] < c.k1[1] or c.k2[0] < c.k2[1]) and (cut or c.size > limit):
                coarse.append(c)
            at = end
        if not coarse:
            break
        probes = max(2, min(256, CELLS // len(coarse)))
        for i, c in enumerate(coarse):
            c.dim, (c.lo, hi) = (1, c.k1) if c.k1[0] < c.k1[1] else (2, c.k2)
            c.children, c.step = probes, (hi - c.lo) // probes + 1
        table = spark.createDataFrame([(c.code, i, c.dim, c.lo, c.step) for i, c in enumerate(coarse)],
                                      "cell int, refined int, dim int, lo long, step long")
        tables.append((probes, table))
        # at most CELLS / 2 rows of five numbers: a proven bound for the broadcast
        located = _finer(located, table, probes, "inner").select("size", "k1", "k2", "cell")
        found: dict[int, Cell] = {r.cell: Cell(r.n, r.s, (r.a1, r.b1), (r.a2, r.b2), level=level, code=r.cell) for r in _histogram(located)}
        below[level] = found
        inside = {id(c): [found[i * probes + j] for j in range(probes) if i * probes + j in found] for i, c in enumerate(coarse)}
        order = [leaf for c in order for leaf in inside.get(id(c), [c])]

    # leaves in key order -> shard, range and the rows of the shard before the range
    leaves, at, shard, before, ranges, filled = [], 0, 0, 0, 0, 0
    for c in order:
        middle = at + c.size / 2
        now = min(n_shards - 1, int(middle * n_shards / total)) if total else 0
        if now != shard:
            shard, before, ranges, filled = now, 0, ranges + 1, 0
        elif filled and filled + c.size > limit:
            ranges, filled = ranges + 1, 0
        leaves.append((c.level, c.code, shard, ranges, before))
        before, filled, at = before + c.rows, filled + c.size, at + c.size
    starts: dict[int, int] = {}
    for *_, number, offset in leaves:
        starts.setdefault(number, offset)
    rows = keyed.withColumn("_at1", F.shiftright("_k1", 62 - FIRST_BITS).cast("int"))
    for i, (probes, t) in enumerate(tables, start=1):
        rows = _finer(rows, t, probes, "left", cell=f"_at{i}", out=f"_at{i + 1}", k1="_k1", k2="_k2")
    for level in below:
        part = spark.createDataFrame([(code, s, r, starts[r]) for lv, code, s, r, _ in leaves if lv == level],
                                     f"_at{level} int, _s{level} int, _r{level} int, _b{level} long")
        # at most CELLS rows a level: a proven bound for the broadcast
        rows = rows.join(F.broadcast(part), f"_at{level}", "left")
    pick = lambda p: F.coalesce(*[F.col(f"_{p}{lv}") for lv in below])
    placed = rows.select(*[F.col(f"`{c}`") for c in keep], "size", "_k1", "_k2", pick("s").alias("shard"), pick("r").alias("_range"),
                         pick("b").alias("_before"))
    w = Window.partitionBy("_range").orderBy("_k1", "_k2", F.col(f"`{id_col}`"))
    return placed.withColumn("slot", F.col("_before") + F.row_number().over(w) - 1).drop("_k1", "_k2", "_range", "_before")


def _finer(df: DataFrame, table: DataFrame, probes: int, how: str, cell: str = "cell", out: str = "cell",
           k1: str = "k1", k2: str = "k2") -> DataFrame:
    """The probe interval of each row inside its refined cell (left join: null in other cells)."""
    t = table.select(F.col("cell").alias("_cell"), F.col("refined").alias("_i"), F.col("dim").alias("_dim"), F.col("lo").alias("_lo"),
                     F.col("step").alias("_step"))
    j = df.join(F.broadcast(t), F.col(cell) == F.col("_cell"), how)
    code = (F.col("_i") * probes + F.least(F.lit(probes - 1), F.expr(f"(CASE WHEN _dim = 1 THEN `{k1}` ELSE `{k2}` END - _lo) DIV _step"))).cast("int")
    return j.withColumn(out, code).drop("_cell", "_i", "_dim", "_lo", "_step")
