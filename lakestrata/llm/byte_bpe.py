"""Byte-level BPE with the tokenizers library over Arrow batches, and its inverse.

Bytes map to printable characters one to one; the vocabulary and the merges are rewritten in those
characters. A text is cut before every space that a non-space follows, where no match of the split
pattern can reach across; a task remembers the ids of short pieces, up to a bound in bytes.
"""

from __future__ import annotations

import base64
import codecs
import struct
import sys
import types
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CACHE = 16 << 20  # bytes of pieces and ids that a task remembers; beyond, it keeps the latest
LONG = 64  # characters; longer pieces are not remembered


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable Latin-1, else one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken vocabulary file (base64 token and rank on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f.read().splitlines()) if a}


def build_tokenizer(ranks: dict[bytes, int], pattern: str):
    """A tokenizer that merges as the ranks say: any pair whose joint bytes are a token, lowest rank first."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    chars = byte_characters()
    shown = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = [(shown[t[:i]], shown[t[i:]]) for t in sorted(ranks, key=ranks.get) for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    out = Tokenizer(models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    out.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return out


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def unpack(ids: bytes) -> list[int]:
    return [int(i) for i in memoryview(ids).cast("I")] if ids else []


def worker_encoder(key: int, ranks: dict[bytes, int], pattern: str) -> Encoder:
    """The encoder of this worker process. Its tokenizer stays from task to task, what it remembers does not."""
    kept = sys.modules.setdefault("_byte_bpe_worker", types.ModuleType("_byte_bpe_worker"))
    if getattr(kept, "key", None) != key:
        kept.encoder, kept.key = Encoder(ranks, pattern), key
    return kept.encoder


class Encoder:
    """Encodes texts and remembers the ids of their short pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.tokenizer = build_tokenizer(ranks, pattern)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes | None] = {}
        self.held = 0

    def _learn(self, new: list[str]) -> None:
        # a piece that is empty or starts with white space could belong to a longer run of it
        whole = [p for p in new if p and not p[0].isspace()]
        for k in range(0, len(whole), 10_000):
            part = whole[k : k + 10_000]
            for p, e in zip(part, self.tokenizer.encode_batch_fast([" " + p for p in part], add_special_tokens=False), strict=True):
                self.known[p] = pack(e.ids)
        self.known.update((p, None) for p in new if not p or p[0].isspace())

    def _size(self, piece: str) -> int:
        return sys.getsizeof(piece) + sys.getsizeof(self.known[piece]) + 100  # and a place in the table

    def _settle(self, new: list[str], seen: set[str]) -> None:
        """Drop long pieces, and once ``CACHE`` is passed all that the last slice didn't hold (or those too)."""
        for p in new:
            if len(p) > LONG:
                del self.known[p]
            else:
                self.held += self._size(p)
        if self.held > CACHE:
            self.known = {p: self.known[p] for p in seen if len(p) <= LONG}
            self.held = sum(map(self._size, self.known))
            if self.held > CACHE // 2:
                self.forget()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers (null: none)."""
        cut = [(text or "").split(" ") for text in texts]
        seen: set[str] = set()
        for first, *rest in cut:
            seen.update(rest)
        new = [p for p in seen if p not in self.known]
        self._learn(new)
        heads = self.tokenizer.encode_batch_fast([first for first, *_ in cut], add_special_tokens=False)
        out = []
        for text, head, (_, *rest) in zip(texts, heads, cut, strict=True):
            ids = list(map(self.known.__getitem__, rest))
            whole = None in ids
            out.append(pack(self.tokenizer.encode(text, add_special_tokens=False).ids) if whole else pack(head.ids) + b"".join(ids))
        self._settle(new, seen)
        return out

    def offsets(self, text: str | None) -> list[tuple[int, int]]:
        """Start and end of each token in characters of the text; parts of one character share its place."""
        return self.tokenizer.encode(text, add_special_tokens=False).offsets if text else []


def _slices(sizes: list[int], most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    start = total = 0
    for k, n in enumerate(sizes):
        if total and total + n > most:
            yield start, k
            start = k
            total = 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, text: str = "text", keep_text: bool = False,
           offsets: bool = False) -> DataFrame:
    """Adds ``ids`` (binary: little-endian unsigned 32-bit integers) and ``n_tokens``; the text goes unless kept.

    ``offsets=True`` also adds ``offsets`` (array of start and end, in characters of the text).
    The whole text is encoded, without special tokens. Null and empty texts have no ids. Input
    columns of these names are replaced. The ranks (under 1 MB) are broadcast.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((ranks, pattern))
    key = hash((spark.sparkContext.applicationId, pattern, frozenset(ranks.items())))
    added = {"ids", "n_tokens", "offsets"}
    cols = [c for c in docs.columns if c not in added and c != text]
    source = docs.select(*[f"`{c}`" for c in cols], f"`{text}`")
    fields = [source.schema[c] for c in cols] + ([T.StructField(text, T.StringType())] if keep_text else [])
    fields += [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    if offsets:
        fields.append(T.StructField("offsets", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = worker_encoder(key, *shared.value)
        encoder.forget()  # also what a task that was stopped midway left
        for batch in batches:
            texts = batch.column(len(cols))
            for a, b in _slices([len(x.as_py() or "") for x in texts] if batch.nbytes > 4 << 20 else [0] * len(texts)):
                part = batch.slice(a, b - a)
                values = part.column(len(cols)).to_pylist()
                ids = encoder.encode(values)
                arrays = [part.column(k) for k in range(len(cols) + keep_text)]
                arrays += [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
                names = [*cols, *([text] if keep_text else []), "ids", "n_tokens"]
                if offsets:
                    arrays.append(pa.array([[{"start": s, "end": e} for s, e in encoder.offsets(x)] for x in values],
                                           pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))))
                    names.append("offsets")
                yield pa.RecordBatch.from_arrays(arrays, names=names)
        encoder.forget()

    return source.mapInArrow(run, T.StructType(fields))


def decode_bytes(ids: bytes, table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, memoryview(ids).cast("I"))) if ids else b""


def decode_pieces(ids: list[int], table: list[bytes]) -> Iterator[str]:
    """Text of each id in turn; the bytes of a character split over ids come with the id that ends it."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for i in ids:
        yield decoder.decode(table[i])
    yield decoder.decode(b"", True)


def decode(encoded: DataFrame, ranks: dict[bytes, int], *, ids: str = "ids", as_text: bool = False) -> DataFrame:
    """Adds ``decoded``: the bytes that the ids stand for, or with ``as_text`` the text, where a
    sequence that ends inside a character gives U+FFFD. Null ids decode to nothing. The table goes
    back from the printable characters of the vocabulary to bytes."""
    spark = encoded.sparkSession
    chars = byte_characters()
    back = {c: b for b, c in enumerate(chars)}
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = bytes(back[chars[b]] for b in token)
    shared = spark.sparkContext.broadcast(table)
    cols = [c for c in encoded.columns if c != "decoded"]
    source = encoded.select(*[f"`{c}`" for c in cols])
    at = cols.index(ids)
    schema = T.StructType([*source.schema.fields, T.StructField("decoded", T.StringType() if as_text else T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes = [len(x.as_py() or b"") for x in batch.column(at)]
            for a, b in _slices(sizes):
                part = batch.slice(a, b - a)
                values = part.column(at).to_pylist()
                if as_text:
                    out = pa.array(["".join(decode_pieces(unpack(x or b""), known)) for x in values], pa.string())
                else:
                    out = pa.array([decode_bytes(x, known) for x in values], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, out], names=[*cols, "decoded"])

    return source.mapInArrow(run, schema)
