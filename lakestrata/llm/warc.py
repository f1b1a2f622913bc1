"""WARC archives: monolithic gzip files rewritten with a member per record and an offset index.

A monolithic file is one gzip stream, so nothing in it can be read without all before it. The
normaliser inflates the stream once, in chunks, rewrites every record as a gzip member of its own
and writes a sidecar index of offsets; afterwards any record is one ranged read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.session import shared_dir

from .common import stage

CHUNK = 1 << 20
#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "file string, offset long, length long, record_id string, record_type string"


def _open(path: str):
    """File system and path of a URI; a plain path is local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if ":" in path.split("/", 1)[0] else "file://" + path)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(value: str) -> str:
    """A header value without line ends (percent-encoded)."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record: a response, or a revisit (its HTTP header alone) if it refers to another."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_one_line(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    """Named fields of a record or HTTP head, names in lower case; later lines win."""
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}


def find_revisits(pages: DataFrame, *, page_id: str = "page_id", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """``page_id sha1 refers_to`` of the pages whose payload (null: empty) a page of larger id has too.

    Only hashes are shuffled. Payloads under ``least_bytes`` are never revisits. A null id counts
    as the smallest; rows that share the largest id are no revisits.
    """
    payload = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    keys = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.sha1(payload.cast("binary")).alias("sha1"), F.octet_length(payload).alias("n"))
    keys = keys.where(F.col("n") >= least_bytes)
    last = keys.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.min(F.coalesce("page_id", F.lit(-(1 << 63)))).alias("low")).where("low < refers_to")
    return keys.join(last.drop("low"), "sha1").where("page_id IS NULL OR page_id < refers_to").select("page_id", "sha1", "refers_to").distinct()


def write_monolithic(pages: DataFrame, folder: str, *, page_id: str = "page_id", url: str = "url", html: str = "html",
                     least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", file_bytes: int = 256 << 20, level: int = 1) -> DataFrame:
    """Archives of one gzip stream each under ``folder``; returns ``file records bytes``, a row per file.

    A record per row; payload the page in UTF-8 (null: empty). A file ends once it holds
    ``file_bytes`` before compression. Files are named by task attempt, and only those of attempts
    that ended well are returned: a lost task leaves an orphan at most.
    """
    revisits = stage(find_revisits(pages, page_id=page_id, html=html, least_bytes=least_bytes), "revisits")
    p = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"))
    r = revisits.select(F.col("page_id").alias("_id"), F.col("sha1").alias("_sha1"), "refers_to")
    rows = p.join(r, p.page_id.eqNullSafe(r._id) & (F.sha1(p.html.cast("binary")) == r._sha1), "left").select("page_id", "url", "html", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}"
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        done, out, deflate, size, count = [], None, None, 0, 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if out is None:
                    file = f"{name}-{len(done):04d}.warc.gz"
                    out, deflate, size, count = store.open_output_stream(f"{root}/{file}", compression=None), zlib.compressobj(level, zlib.DEFLATED, 31), 0, 0
                data = record(row[0], row[1], row[2].encode(), row[3], date)
                out.write(deflate.compress(data))
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    out.write(deflate.flush())
                    out.close()
                    done.append((f"{folder}/{file}", count, size))
                    out = None
        if out is not None:
            out.write(deflate.flush())
            out.close()
            done.append((f"{folder}/{file}", count, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=["file", "records", "bytes"])

    return stage(rows.mapInArrow(run, "file string, records long, bytes long"), "monolithic")


class _Inflated:
    """Chunked reader over a gzip file of one or more members."""

    def __init__(self, stream) -> None:
        self.stream, self.inflate, self.left = stream, zlib.decompressobj(31), b""

    def more(self) -> bool:
        """Takes in the next piece; false at the end. A stream that breaks off raises."""
        while True:
            raw = self.inflate.unconsumed_tail or self.inflate.unused_data or self.stream.read(CHUNK)
            if self.inflate.eof:
                if not raw:
                    return False
                self.inflate = zlib.decompressobj(31)
            if piece := self.inflate.decompress(raw, CHUNK):
                self.left += piece
                return True
            if not raw and not self.inflate.eof:
                raise EOFError("the gzip stream breaks off")

    def until(self, mark: bytes) -> bytes | None:
        """All up to and with ``mark``; None at the end of the file."""
        start = 0
        while (at := self.left.find(mark, start)) < 0:
            start = max(0, len(self.left) - len(mark) + 1)
            if not self.more():
                if self.left.strip():
                    raise EOFError("a record breaks off")
                return None
        head, self.left = self.left[: at + len(mark)], self.left[at + len(mark) :]
        return head

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, in pieces."""
        while n:
            if not self.left and not self.more():
                raise EOFError("a record breaks off")
            piece, self.left = self.left[:n], self.left[n:]
            n -= len(piece)
            yield piece


def _members(stream, out, level: int) -> Iterator[tuple[int, int, str, str]]:
    """Copies each record of ``stream`` to ``out`` as a member; yields offset, length, id and type."""
    source, offset = _Inflated(stream), 0
    while (head := source.until(b"\r\n\r\n")) is not None:
        head = head.lstrip(b"\r\n")
        fields = headers(head)
        deflate, length = zlib.compressobj(level, zlib.DEFLATED, 31), 0
        for piece in (head,):
            length += out.write(x) if (x := deflate.compress(piece)) else 0
        for piece in source.pieces(int(fields["content-length"])):
            length += out.write(x) if (x := deflate.compress(piece)) else 0
        for piece in source.pieces(4):
            length += out.write(x) if (x := deflate.compress(piece)) else 0
        length += out.write(deflate.flush())
        yield offset, length, fields.get("warc-record-id", ""), fields.get("warc-type", "")
        offset += length


def normalise(files: DataFrame, folder: str, *, level: int = 1) -> DataFrame:
    """Rewrites each archive named in ``file`` under ``folder`` with a member per record; returns the index.

    Beside every archive lies ``<archive>.idx``: a line per record with offset, length, id and
    type, in file order. One task inflates a file once, holding a chunk of it at a time. An
    archive without records gives an empty file and index. A broken stream raises.
    """
    n = max(1, files.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = _open(folder)
        target.create_dir(root, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for path in batch.column(0).to_pylist():
                name = f"{path.rsplit('/', 1)[-1].removesuffix('.warc.gz')}-{attempt}.warc.gz"
                store, at = _open(path)
                with store.open_input_stream(at, compression=None) as stream, target.open_output_stream(f"{root}/{name}", compression=None) as out:
                    with target.open_output_stream(f"{root}/{name}.idx", compression=None) as side:
                        rows = []
                        for row in _members(stream, out, level):
                            side.write("{}\t{}\t{}\t{}\n".format(*row).encode())
                            rows.append((f"{folder}/{name}", *row))
                            if len(rows) >= 10_000:
                                yield _index(rows)
                                rows = []
                        if rows:
                            yield _index(rows)

    return stage(files.select("file").repartition(n).mapInArrow(run, INDEX), "index")


def _index(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["file", "offset", "length", "record_id", "record_type"])


def read_records(index: DataFrame) -> DataFrame:
    """Every record that ``index`` names, by ranged reads: ``page_id url record_type payload payload_bytes
    payload_digest refers_to``.

    ``payload`` is null for revisits, whose length and digest are those of the full payload they
    refer to. A response whose payload doesn't have the digest of its header raises.
    """
    schema = ("page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long")
    number = lambda urn: int(urn[len("<urn:x-page:") : -1]) if urn and urn != "<urn:x-page:>" else None

    def parse(data: bytes) -> tuple:
        head, _, block = data.partition(b"\r\n\r\n")
        fields = headers(head)
        block = block[: int(fields["content-length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
        size = int(headers(http)["content-length"])
        if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
            raise ValueError(f"record {fields['warc-record-id']} is damaged")
        return (number(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, payload if kind == "response" else None, size, digest,
                number(fields.get("warc-refers-to")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        types = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)],
                                              names=["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"])

        for batch in batches:
            rows, held = [], 0
            for file, offset, length in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                if file != name:
                    if source is not None:
                        source.close()
                    store, at = _open(file)
                    name, source = file, store.open_input_file(at)
                rows.append(parse(zlib.decompress(source.read_at(length, offset), 31)))
                held += rows[-1][4]
                if held >= 8 << 20:
                    yield packed(rows)
                    rows, held = [], 0
            if rows:
                yield packed(rows)
        if source is not None:
            source.close()

    return index.select("file", "offset", "length").mapInArrow(run, schema)


def archive_folder(pages: DataFrame, name: str) -> str:
    """A fresh folder for archives under the shared folder of the session."""
    return shared_dir(pages.sparkSession, "llm", name)
