"""WARC archives as a table of chunks.

A page becomes one or more records: payloads longer than a chunk are segmented
as WARC 1.1 provides (a ``response`` and its ``continuation`` records). Chunk
rows are (page, chunk number); writer and reader carry the digest from chunk to
chunk. The writer takes chunks out of the payload where it lies, in one pass; the
reader holds a chunk at a time, never an oversized record.

Archives are written by Spark's text writer with the record separator as line
separator, one gzip file per input partition, and read by its text reader, so
they lie wherever Spark can write. Lines that the reader splits inside a payload
are joined again by the lengths the record headers state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.llm.memory import giving_back
from corpuscle.llm.skew import attach
from corpuscle.sources.shared import SMALL_ROWS, materialise, small_side

# Characters of a chunk, and bytes from which equal payloads are stored once.
CHUNK_CHARS = 262_144
REVISIT_BYTES = 1000
# Bytes of chunks, and chunks, that the writer gives on together.
WRITTEN_BYTES = 1 << 22
WRITTEN_ROWS = 4096

SEPARATOR = "\r\n\r\n"
REST = b"\r\n"
HTTP_HEADER = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNKS = (
    "page_id bigint, chunk_no int, chunk string, bytes_so_far bigint, digest_so_far string, last boolean, "
    "record_type string, refers_to bigint"
)
_CHUNKS_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("chunk_no", pa.int32()), ("chunk", pa.string()), ("bytes_so_far", pa.int64()),
        ("digest_so_far", pa.string()), ("last", pa.bool_()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ]
)

_CUT = (
    "page_id bigint, url string, n_bytes bigint, digest string, refers_to bigint, chunk_no int, chunk binary, "
    "bytes_so_far bigint, digest_so_far string, last boolean"
)
_CUT_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("n_bytes", pa.int64()), ("digest", pa.string()),
        ("refers_to", pa.int64()), ("chunk_no", pa.int32()), ("chunk", pa.binary()), ("bytes_so_far", pa.int64()),
        ("digest_so_far", pa.string()), ("last", pa.bool_()),
    ]
)


def _payloads(pages: DataFrame, key: str, payload: str, url: str) -> DataFrame:
    body = F.coalesce(F.col(payload), F.lit(""))
    return pages.select(
        F.col(key).cast("bigint").alias("page_id"),
        F.col(url).alias("url"),
        body.alias("body"),
        F.octet_length(body).cast("bigint").alias("n_bytes"),
        F.sha1(body.cast("binary")).alias("digest"),
    )


def revisits(payloads: DataFrame, at_least: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, digest, refers_to`` of pages whose payload a page with a larger id has too."""
    ids = payloads.select("page_id", "digest", "n_bytes").filter((F.col("n_bytes") >= at_least) & F.col("page_id").isNotNull())
    shared = materialise(
        ids.groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least"), F.count("*").alias("n"))
        .filter(F.col("least") < F.col("refers_to"))
        .drop("least"),
        "warc-shared",
    )
    if shared.count() <= SMALL_ROWS:
        found = ids.join(F.broadcast(shared), "digest")
    else:
        found = attach(materialise(ids, "warc-ids"), shared, ["digest"], "n")
    return found.filter(F.col("page_id") < F.col("refers_to")).select("page_id", "digest", "refers_to").distinct()


def _end_of_chunk(data: memoryview, at: int, chars: int) -> int:
    """Where the chunk of ``chars`` characters that begins at ``at`` ends."""
    window = np.frombuffer(data[at : at + 4 * chars + 1], np.uint8)
    begins = np.flatnonzero((window & 0xC0) != 0x80)
    return at + int(begins[chars]) if len(begins) > chars else len(data)


def chunk_rows(payloads: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Chunk rows of a table of ``page_id, url, n_bytes, digest, refers_to, body``, in order.

    ``bytes_so_far`` and ``digest_so_far`` are those of the payload up to the
    chunk's end. A revisit is one empty chunk and has the digest it refers to. A
    payload that doesn't end in its stated length and digest raises.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0

        def given() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(_CUT_ARROW)
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _CUT_ARROW, strict=True)], schema=_CUT_ARROW)

        for batch in batches:
            *known, bodies = batch.columns
            for page, body in zip(zip(*(c.to_pylist() for c in known), strict=True), bodies, strict=True):
                _, _, n_bytes, digest, refers_to = page
                if refers_to is not None:
                    rows.append((*page, 0, b"", n_bytes, digest, True))
                    continue
                data = memoryview(body.as_buffer())
                so_far = hashlib.sha1()
                at, number, last = 0, 0, False
                while not last:
                    end = _end_of_chunk(data, at, chunk_chars) if len(data) - at > chunk_chars else len(data)
                    part, at, last = bytes(data[at:end]), end, end == len(data)
                    so_far.update(part)
                    rows.append((*page, number, part, at, so_far.hexdigest(), last))
                    number, held = number + 1, held + len(part)
                    if held >= WRITTEN_BYTES or len(rows) >= WRITTEN_ROWS:
                        yield given()
                        rows, held = [], 0
                if (at, so_far.hexdigest()) != (n_bytes, digest):
                    raise ValueError(f"the payload of page {page[0]} differs from its digest")
        yield given()

    known = payloads.select("page_id", "url", "n_bytes", "digest", "refers_to", "body")
    return known.mapInArrow(giving_back(cut), _CUT)


def records(
    pages: DataFrame, *, key: str = "page_id", payload: str = "html", url: str = "url",
    chunk_chars: int = CHUNK_CHARS, date: str = "1970-01-01T00:00:00Z", at_least: int = REVISIT_BYTES,
) -> DataFrame:
    """One column ``record``: header and block of every record, in order within a partition."""
    rows = _payloads(pages, key, payload, url)
    rows = rows.join(small_side(revisits(rows, at_least), "warc-revisits"), ["page_id", "digest"], "left")
    again = F.col("refers_to").isNotNull()
    # A revisit's body stays where it is.
    rows = chunk_rows(rows.withColumn("body", F.when(again, "").otherwise(F.col("body"))), chunk_chars)
    chunk = F.col("chunk").cast("string")
    first = F.col("chunk_no") == 0
    block = F.concat(F.when(first, HTTP_HEADER).otherwise(""), chunk)
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(":"))
    line = lambda field, value, when=None: F.when(
        F.lit(True) if when is None else when, F.concat(F.lit(f"{field}: "), value)
    )
    segmented = ~first | ~F.col("last")
    header = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(again, "revisit").when(first, "response").otherwise("continuation")),
        line("WARC-Record-ID", F.concat(name, F.col("chunk_no") + 1, F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")), first),
        line("WARC-Payload-Length", F.col("n_bytes").cast("string"), first),
        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(":1>")), again),
        line("WARC-Profile", F.lit(REVISIT_PROFILE), again),
        line("WARC-Segment-Number", (F.col("chunk_no") + 1).cast("string"), segmented),
        line("WARC-Segment-Origin-ID", F.concat(name, F.lit("1>")), segmented & ~first),
        line("WARC-Segment-Total-Length", F.col("bytes_so_far").cast("string"), segmented & F.col("last")),
        line("Content-Type", F.when(first, "application/http; msgtype=response").otherwise("text/html")),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    return rows.select(F.concat(header, F.lit(SEPARATOR), block).alias("record"))


def write_archives(pages: DataFrame, path: str, **options) -> None:
    """Write the pages as gzip WARC files into the folder ``path``."""
    records(pages, **options).write.option("compression", "gzip").option("lineSep", SEPARATOR).text(path)


class _Reader:
    """Feed it the bytes of archives; it gives back chunk rows."""

    def __init__(self, with_chunks: bool):
        self.with_chunks = with_chunks
        self.header: dict[str, str] | None = None
        self.pending = bytearray()
        self.left = 0
        self.digest = hashlib.sha1()
        self.total = 0
        self.chunk_no = 0
        self.origin: dict[str, str] = {}
        self.http = False

    def feed(self, data: memoryview) -> Iterator[tuple]:
        while True:
            if self.header is None:
                self.pending += data
                end = self.pending.find(b"\r\n\r\n")
                if end < 0:
                    return
                data = memoryview(bytes(self.pending[end + 4 :]))
                self._begin(bytes(self.pending[:end]).decode())
            elif self.left:
                if not data:
                    return
                part, data = data[: self.left], data[self.left :]
                self.left -= len(part)
                self._body(part)
            else:
                need = 4 - self.trail
                part, data = bytes(data[:need]), data[need:]
                if part != b"\r\n\r\n"[self.trail : self.trail + len(part)]:
                    raise ValueError("a record is longer than its Content-Length")
                self.trail += len(part)
                if self.trail < 4:
                    return
                yield self._end()

    def _begin(self, text: str) -> None:
        lines = text.split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record begins with {lines[0][:40]!r}")
        self.header = dict(line.split(": ", 1) for line in lines[1:])
        self.left, self.trail = int(self.header["Content-Length"]), 0
        self.pending = bytearray()
        self.kept: list[bytes] = []
        self.http = self.header["WARC-Type"] != "continuation"
        if self.http:
            self.digest, self.total, self.chunk_no, self.origin = hashlib.sha1(), 0, 0, self.header
        elif int(self.header["WARC-Segment-Number"]) != self.chunk_no + 1 or self.header["WARC-Segment-Origin-ID"] != self.origin["WARC-Record-ID"]:
            raise ValueError("a segment is missing")

    def _body(self, part: memoryview) -> None:
        if self.http:
            self.pending += part
            end = self.pending.find(b"\r\n\r\n")
            if end < 0:
                return
            part = memoryview(bytes(self.pending[end + 4 :]))
            self.pending = bytearray()
            self.http = False
        self.digest.update(part)
        self.total += len(part)
        if self.with_chunks:
            self.kept.append(bytes(part))

    def _end(self) -> tuple:
        header, origin = self.header, self.origin
        self.header, self.pending = None, bytearray()
        last = "WARC-Segment-Number" not in origin or "WARC-Segment-Total-Length" in header
        again = origin["WARC-Type"] == "revisit"
        stated, length = origin["WARC-Payload-Digest"].removeprefix("sha1:"), int(origin["WARC-Payload-Length"])
        so_far = stated if again else self.digest.copy().hexdigest()
        total = length if again else self.total
        if last and (so_far, total) != (stated, length):
            raise ValueError(f"the payload of {origin['WARC-Record-ID']} differs from its digest")
        page = origin["WARC-Record-ID"].split(":")[2]
        refers_to = int(origin["WARC-Refers-To"].split(":")[2]) if again else None
        self.chunk_no += 1
        chunk = b"".join(self.kept).decode() if self.with_chunks else None
        self.kept = []
        return (None if page == "null" else int(page), self.chunk_no - 1, chunk, total, so_far, last, origin["WARC-Type"], refers_to)


def read_archives(spark: SparkSession, path: str, with_chunks: bool = True) -> DataFrame:
    """Chunk rows of all archives in ``path``, digests carried from chunk to chunk.

    The row with ``last`` has length and digest of the whole payload, checked
    against what the record states; a record that doesn't fit them raises. A
    revisit is one row with the length and digest of the payload it refers to.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(with_chunks)
        separator = memoryview(SEPARATOR.encode())
        for batch in batches:
            rows = []
            for value in batch.column(0):
                line = memoryview(value.as_buffer())
                rows += reader.feed(line)
                # A file that ends in an odd run of line ends leaves this rest, and no separator after it.
                # Elsewhere there is no such line: with what follows, its bytes would be a separator.
                if line != REST:
                    rows += reader.feed(separator)
            columns = list(zip(*rows, strict=True)) or [()] * len(_CHUNKS_ARROW)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _CHUNKS_ARROW, strict=True)], schema=_CHUNKS_ARROW)
        if reader.header is not None or reader.pending:
            raise ValueError("an archive ends inside a record")

    return spark.read.option("lineSep", SEPARATOR).text(path).mapInArrow(parse, CHUNKS)


def round_trip(pages: DataFrame, path: str, **options) -> DataFrame:
    """Write archives and read them back: a row per page.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``. A null
    payload is empty; a null url leaves its header line out. Of equal payloads
    of at least ``at_least`` bytes the largest page id is the response, and so is
    each of its repeated rows; a null page id takes no part and is a response.
    Other columns are ignored; an empty table gives an empty folder and no rows.
    """
    write_archives(pages, path, **options)
    chunks = read_archives(pages.sparkSession, path, with_chunks=False)
    return chunks.filter("last").select(
        "page_id",
        F.col("bytes_so_far").alias("payload_bytes"),
        F.col("digest_so_far").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
