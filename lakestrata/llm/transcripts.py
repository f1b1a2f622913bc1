"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

States are role x place in the turn (first line, later line, blank line). Each line shows a symbol:
speaker marker, length class and question mark. The model is counted from labelled lines; the most
probable path is found by Viterbi in blocks: the best score from every state before a block to
every state at its end is a small matrix, matrices of a conversation chain in order, and each block
is then decoded on its own between its known ends. So a long conversation spreads over tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Canonical roles and the speaker words that may stand for them.
ROLES = ("system", "user", "assistant", "tool")
SPEAKERS = {"system": 1, "instructions": 1, "user": 2, "human": 2, "customer": 2, "question": 2, "q": 2, "assistant": 3, "ai": 3, "bot": 3,
            "agent": 3, "answer": 3, "a": 3, "tool": 4, "function": 4, "result": 4}
MARKER = re.compile(r"^\s*(?:#+\s*|\*\*|\[|<\|?)?(" + "|".join(sorted(SPEAKERS, key=len, reverse=True)) + r")(?:\*\*|\]|\|?>)?\s*(?::\*{0,2}|(?<=[\]>])|$)\s*", re.I)
STATES = 3 * len(ROLES)  # role * 3 + (0 first, 1 later, 2 blank)
START = STATES
KINDS = 1 + len(ROLES)  # of markers, none among them
SYMBOLS = KINDS * 4 * 2


def symbol(line: str) -> tuple[int, str]:
    """The symbol of a line (marker class, length class, question mark) and the line without its marker."""
    m = MARKER.match(line)
    kind, body = (SPEAKERS[m.group(1).lower()], line[m.end() :]) if m else (0, line)
    text = body.strip()
    size = 0 if not text else 1 if len(text) < 40 else 2 if len(text) < 200 else 3
    return (kind * 4 + size) * 2 + text.endswith("?"), body


@dataclass
class Model:
    """Log probabilities: ``a[i, j]`` from state i (or START) to j, ``e[j, s]`` of symbol s in j."""

    a: np.ndarray
    e: np.ndarray

    @classmethod
    def counted(cls, moves: np.ndarray, shown: np.ndarray) -> Model:
        """From counts, smoothed; marker class and the rest of a symbol count separately."""
        a = np.log((moves + 0.05) / (moves + 0.05).sum(1, keepdims=True))
        s = shown.reshape(STATES, KINDS, 8) + 0.05
        kinds, rest = s.sum(2), s.sum(1)
        e = np.log(kinds / kinds.sum(1, keepdims=True))[:, :, None] + np.log(rest / rest.sum(1, keepdims=True))[:, None, :]
        return cls(a, e.reshape(STATES, SYMBOLS))

    def transfer(self, symbols: list[int]) -> np.ndarray:
        """Best score from each state before the lines (START last) to each state at their end."""
        m = self.a + self.e[:, symbols[0]]
        for s in symbols[1:]:
            m = (m[:, :, None] + self.a[None, :STATES, :]).max(1) + self.e[:, s]
        return m

    def decode(self, symbols: list[int], before: np.ndarray, end: int) -> list[int]:
        """Best states of the lines, given scores of the states before them and the last state."""
        v, back = before, []
        for s in symbols:
            step = v[:, None] + self.a[: len(v)]
            back.append(step.argmax(0))
            v = step.max(0) + self.e[:, s]
        path = [end]
        for b in reversed(back[1:]):
            path.append(int(b[path[-1]]))
        return path[::-1]


def _blocks(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Runs of rows that agree in the first ``keys`` columns."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and row[:keys] != held[0][:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def fit(lines: DataFrame) -> Model:
    """Model from labelled lines (``conv_id pos line role``, ``first``: first line of its turn, ``before``:
    state number before it, null at the start of a conversation). Counts of all rows; states x
    (states + symbols) sums reach the driver."""
    shown = lines.select("state", "before", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves, seen = np.zeros((STATES + 1, STATES)), np.zeros((STATES, SYMBOLS))
        for batch in batches:
            for s, b, x in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                moves[START if b is None else b, s] += 1
                seen[s, symbol(x)[0]] += 1
        every = np.concatenate([moves.ravel(), seen.ravel()])
        at = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(every[at])], names=["cell", "n"])

    total = np.zeros((STATES + 1) * STATES + STATES * SYMBOLS)
    for r in shown.mapInArrow(run, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        total[r.cell] = r.n
    return Model.counted(total[: (STATES + 1) * STATES].reshape(STATES + 1, STATES), total[(STATES + 1) * STATES :].reshape(STATES, SYMBOLS))


def recover_turns(lines: DataFrame, model: Model, *, block: Column | None = None) -> DataFrame:
    """``conv_id pos role n_lines text rendered``: a row per recovered turn, ``pos`` of its first line.

    ``lines`` has ``conv_id``, ``pos`` (long, order in the conversation) and ``line``. Lines with a
    null ``pos`` come first, ties go by the line's text; null lines are blank. A null ``conv_id`` is
    a conversation of its own. Markers are taken off, blank lines between turns are dropped and
    those inside kept. Blocks are runs of ``pos``; the result doesn't depend on where they are cut.
    A turn without text is not returned.
    """
    cut = block if block is not None else F.shiftright("pos", 38)
    base = lines.select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("pos"), F.lit(-1)).cast("long").alias("pos"),
                        F.coalesce("line", F.lit("")).alias("line"))
    base = base.withColumn("block", cut.cast("long"))
    ordered = base.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "pos", "line")
    ordered = ordered.select("conv_id", "block", "pos", "line")
    shared = lines.sparkSession.sparkContext.broadcast((model.a, model.e))

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        rows = []
        for run in _blocks(batches, 2):
            rows.append((run[0][0], run[0][1], m.transfer([symbol(x[3])[0] for x in run]).ravel().tolist()))
            if len(rows) >= 1000:
                yield _arrays(rows, [pa.int64(), pa.int64(), pa.list_(pa.float64())], ["conv_id", "block", "m"])
                rows = []
        if rows:
            yield _arrays(rows, [pa.int64(), pa.int64(), pa.list_(pa.float64())], ["conv_id", "block", "m"])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _blocks(batches, 1):
            start = np.full(STATES + 1, -np.inf)
            start[START] = 0.0
            v, before = start, []
            each = [np.array(x[2]).reshape(STATES + 1, STATES) for x in run]
            for m in each:
                before.append(v)
                v = np.append((v[:, None] + m).max(0), -np.inf)
            ends = [int(v[:STATES].argmax())]
            for v, m in zip(reversed(before[1:]), reversed(each[1:]), strict=True):
                ends.append(int((v + m[:, ends[-1]]).argmax()))
            yield _arrays([(x[0], x[1], b.tolist(), e) for x, b, e in zip(run, before, reversed(ends), strict=True)],
                          [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.int32()], ["conv_id", "block", "v", "e"])

    m = ordered.mapInArrow(matrices, "conv_id long, block long, m array<double>")
    ends = stage(m.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(chain, "conv_id long, block long, v array<double>, e int"), "chained")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for run in _blocks(batches, 2):
            seen = [symbol(x[3]) for x in run]
            states = m.decode([s for s, _ in seen], np.array(run[0][4]), run[0][5])
            yield _arrays([(x[0], x[1], x[2], k, s, b) for k, (x, s, (_, b)) in enumerate(zip(run, states, seen, strict=True))],
                          [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()], ["conv_id", "block", "pos", "k", "state", "body"])

    known = ends.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), "v", "e")
    joined = base.join(known, base.conv_id.eqNullSafe(known._c) & (base.block == known._b)).select("conv_id", "block", "pos", "line", "v", "e")
    joined = joined.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "pos", "line")
    told = stage(joined.mapInArrow(decode, "conv_id long, block long, pos long, k long, state int, body string"), "decoded")
    # the turn that a block begins in: the last one that starts in an earlier block
    place = F.struct("block", "pos", "k")
    starts = told.groupBy("conv_id", "block").agg(F.max(F.when(F.col("state") % 3 == 0, place)).alias("last"), F.min(place).alias("first"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), F.coalesce(F.last("last", True).over(earlier), "first").alias("open"))
    inside = Window.partitionBy("conv_id", "block").orderBy("pos", "k").rowsBetween(Window.unboundedPreceding, 0)
    turns = (told.join(starts, told.conv_id.eqNullSafe(starts._c) & (told.block == starts._b))
             .withColumn("turn", F.coalesce(F.last(F.when(F.col("state") % 3 == 0, place), True).over(inside), "open")))
    role = F.element_at(F.array(*map(F.lit, ROLES)), F.floor(F.col("state") / 3).cast("int") + 1)
    out = turns.groupBy("conv_id", "turn").agg(
        F.min_by(role, place).alias("role"), F.count("*").alias("n_lines"),
        F.sort_array(F.collect_list(F.struct("block", "pos", "k", "body"))).alias("lines"))
    text = F.regexp_replace(F.array_join("lines.body", "\n"), r"^\s+|\s+$", "")
    out = out.select("conv_id", F.col("turn.pos").alias("pos"), "role", "n_lines", text.alias("text")).where("text != ''")
    return out.withColumn("rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>\n")))


def _arrays(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def transcript_lines(conversations: DataFrame, *, drop_marker: float = 0.15) -> DataFrame:
    """Raw transcript lines of ``conversations`` (``conv_id turn role text``) with their true ``state`` and the one ``before``.

    Each conversation has one of four marker styles (by the hash of its id); a share
    ``drop_marker`` of the later turns has no marker, as in transcripts found in the wild. Turns
    are parted by a blank line. ``pos`` is the turn number times 2^32 plus the line's number in
    it; repeated rows of one turn follow each other by role and text. Roles other than the first three,
    null too, are turns of the role ``tool``; null texts are empty, null turns -1.
    """
    role = F.when(F.col("role").isin(*ROLES), F.col("role")).otherwise(F.lit(ROLES[-1])).alias("role")
    c = conversations.select("conv_id", F.coalesce("turn", F.lit(-1)).alias("turn"), role, F.coalesce("text", F.lit("")).alias("text"))
    name = lambda user, assistant, system, tool: (
        F.when(F.col("role") == "user", user).when(F.col("role") == "assistant", assistant).when(F.col("role") == "system", system).otherwise(tool))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    marker = (F.when(style == 0, name("User: ", "Assistant: ", "System: ", "Tool: ")).when(style == 1, name("### Human:\n", "### Assistant:\n", "### System:\n", "### Function:\n"))
              .when(style == 2, name("[user] ", "[assistant] ", "[system] ", "[tool] ")).otherwise(name("Q: ", "A: ", "Instructions: ", "Result: ")))
    bare = (F.pmod(F.xxhash64("conv_id", "turn", F.lit("bare")), F.lit(1000)) < int(1000 * drop_marker)) & (F.col("turn") > 0)
    shown = F.concat(F.when(bare, "").otherwise(marker), "text", F.lit("\n"))
    number = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")).cast("int") - 1
    rows = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    numbered = c.withColumn("_lines", F.split(shown, "\n")).withColumn("_from", F.coalesce(F.sum(F.size("_lines")).over(rows.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    lines = numbered.select("conv_id", "turn", "role", number.alias("_r"), "_from", F.posexplode("_lines").alias("k", "line"))
    blank = F.trim("line") == ""
    lines = lines.withColumn("state", (F.col("_r") * 3 + F.when(F.col("k") == 0, 0).when(blank, 2).otherwise(1)).cast("int"))
    lines = lines.withColumn("pos", F.shiftleft(F.col("turn").cast("long"), 32) + F.col("_from") + F.col("k"))
    w = Window.partitionBy("conv_id", "turn").orderBy("pos")
    lines = lines.withColumn("_in", F.lag("state").over(w))
    # the state at the end of the turn before: a blank line of its role
    prior = c.groupBy("conv_id", (F.col("turn") + 1).alias("turn")).agg(F.max_by(number, F.struct("role", "text")).alias("_p"))
    lines = lines.join(prior, ["conv_id", "turn"], "left")
    return lines.select("conv_id", "pos", "line", "role", "state", F.coalesce("_in", (F.col("_p") * 3 + 2).cast("int")).alias("before"))
