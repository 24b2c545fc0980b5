"""WARC archives as chunked record tables: written from, and read into, rows of bounded size."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.llm.common import scratch, stored
from tasador.llm.tokenfile import place
from tasador.operators.keyed import BROADCAST_ROWS, fits_broadcast, lookup

CHUNK = 1 << 18
"""Bytes of payload in a row of the chunk table."""
SHARED_FROM = 100
"""A payload of so many bytes is stored once."""
DATE = "2024-01-01T00:00:00Z"
LEVEL = 1

READ = (
    "archive string, record_no bigint, page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, chunk_no bigint, data binary, bytes_so_far bigint, digest_so_far string, last boolean"
)


CHUNKS = "record bigint, page_id bigint, url string, payload_bytes bigint, payload_digest string, chunk_no bigint, data binary, bytes_so_far bigint, digest_so_far string"


def chunk_table(pages: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """`pages` (page_id, url, html) as rows of at most `chunk` payload bytes: record and chunk number, data, what the chunks so far add up to.

    The payload is the html in UTF-8, of no bytes if null; null urls are empty; other
    columns are not read.  Every chunk is a view of the page as it arrived and
    updates one running digest, so no payload is copied or digested whole, and
    no row after this one is larger than a chunk.  The rows of a record follow each
    other.  `with_data=False` gives the last row of every record, without data.
    """
    kinds = {
        "record": pa.int64(), "page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "chunk_no": pa.int64(),
        "data": pa.binary(), "bytes_so_far": pa.int64(), "digest_so_far": pa.string(),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                view = memoryview(batch.column(3)[i].as_buffer())
                ends = [min(len(view), a + chunk) for a in range(0, max(1, len(view)), chunk)]
                digest, so_far = hashlib.sha256(), []
                for a, b in zip([0, *ends], ends):
                    digest.update(view[a:b])
                    so_far.append(digest.hexdigest())
                row = {"record": batch.column(0)[i].as_py(), "page_id": batch.column(1)[i].as_py(), "url": batch.column(2)[i].as_py(), "payload_bytes": len(view), "payload_digest": so_far[-1]}
                for number, (a, b) in enumerate(zip([0, *ends], ends)):
                    if with_data or b == len(view):
                        rows.append(row | {"chunk_no": number, "data": view[a:b].tobytes() if with_data else None, "bytes_so_far": b, "digest_so_far": so_far[number]})
                        held += b - a if with_data else 0
                    if len(rows) == 1000 or held >= 16 * chunk:
                        yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    read = pages.select(
        F.monotonically_increasing_id().alias("record"), F.col("page_id").cast("bigint"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    )
    return read.mapInArrow(run, CHUNKS)


_RECORD = ["_id", "_none", "payload_digest"]


def _named(rows: DataFrame) -> DataFrame:
    """Null page ids as keys that can be joined."""
    return rows.withColumns({"_id": F.coalesce("page_id", F.lit(0)), "_none": F.col("page_id").isNull()})


def revisits(digests: DataFrame) -> DataFrame:
    """(_id, _none, payload_digest, refers_to) of the records of (page_id, payload_bytes, payload_digest) whose payload another one stores.

    Of pages with equal payloads of at least 100 bytes the one with the smallest
    page_id is the response and the others revisit it; rows that share that id
    are all responses, as are pages without an id if no other has the payload.  A page
    without an id revisits one that has an id.  Copies fold to one row per input
    partition before ids and digests are shuffled.
    """
    ids = stored(digests.filter(F.col("payload_bytes") >= SHARED_FROM).select("page_id", "payload_digest").distinct(), "payload-digests")
    first = ids.groupBy(F.col("payload_digest").alias("_of")).agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = ids.join(first, F.col("payload_digest") == F.col("_of")).filter(F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return stored(_named(later).select(*_RECORD, "refers_to"), "revisits")


def records(pages: DataFrame, chunk: int = CHUNK, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The chunk table of `pages` with `record_type` and `refers_to`; a revisit is one row without data.

    Who revisits whom is settled on the records' last rows.  While the revisits are
    few enough to be broadcast (their size is measured) chunks stay where they are
    and none is shuffled; beyond that chunks meet them in a salted join and
    those of responses are put in order by record and number.
    """
    later = revisits(chunk_table(pages, chunk, with_data=False))
    chunks = _named(chunk_table(pages, chunk))
    in_place = fits_broadcast(later, max_rows)
    met = chunks.join(F.broadcast(later), _RECORD, "left") if in_place else lookup(chunks, later, _RECORD, max_rows=0)
    again = F.col("refers_to").isNotNull()
    met = met.filter(~again | (F.col("chunk_no") == 0)).drop("_id", "_none")
    met = met.withColumns({"record_type": F.when(again, "revisit").otherwise("response"), "data": F.when(again, F.lit(b"")).otherwise(F.col("data"))})
    return met if in_place else met.repartition("record").sortWithinPartitions("record", "chunk_no")


def _identity(page_id: int | None, digest: str) -> str:
    """Depends on the content, so that a revisit can name its response; rows equal in both are one record written again."""
    return f"<urn:page:{digest}>" if page_id is None else f"<urn:page-id:{page_id}:{digest}>"


def _header(chunk: dict) -> tuple[bytes, int]:
    """The bytes before the payload, and how many payload bytes follow."""
    revisit = chunk["record_type"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {chunk['payload_bytes']}\r\n\r\n".encode()
    follows = 0 if revisit else chunk["payload_bytes"]
    url = chunk["url"].replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {chunk['record_type']}",
        f"WARC-Record-ID: {_identity(chunk['page_id'], chunk['payload_digest'])}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha256:{chunk['payload_digest']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + follows}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_identity(chunk['refers_to'], chunk['payload_digest'])}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http, follows


class ArchiveWriter:
    """Writes records chunk by chunk, each as a gzip member of its own; nothing larger than a chunk is held."""

    def __init__(self, folder: str) -> None:
        system, root = place(folder)
        self.path = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz"  # a task that runs again writes another file
        self.file = system.open_output_stream(f"{root}/{self.path.rpartition('/')[2]}", compression=None)
        self.member, self.left, self.n_records = None, 0, 0

    def add(self, chunk: dict) -> None:
        if chunk["chunk_no"] == 0:
            self._end()
            self.member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            header, self.left = _header(chunk)
            self._put(header)
            self.n_records += 1
        self._put(chunk["data"])
        self.left -= len(chunk["data"])
        if chunk["record_type"] == "response" and not self.left and chunk.get("digest_so_far", chunk["payload_digest"]) != chunk["payload_digest"]:
            raise ValueError("the chunks do not add up to the payload")

    def _put(self, data: bytes) -> None:
        if out := self.member.compress(data):
            self.file.write(out)

    def _end(self) -> None:
        if self.member:
            if self.left:
                raise ValueError("chunks are missing or out of order")
            self._put(b"\r\n\r\n")
            self.file.write(self.member.flush())
            self.member = None

    def close(self) -> None:
        self._end()
        self.file.close()


def write(chunks: DataFrame, folder: str) -> DataFrame:
    """Write a chunk table as archives under `folder`; (archive, n_records) of each.

    The rows of a record follow each other in a partition, as `records` gives
    them; each partition becomes an archive, without another shuffle.
    """
    system, root = place(folder)
    system.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            for i in range(batch.num_rows):  # one row at a time: a batch of rows as dicts would be a second copy
                writer = writer or ArchiveWriter(folder)
                writer.add({n: batch.column(n)[i].as_py() for n in names})
        if writer:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([writer.path]), pa.array([writer.n_records], pa.int64())], names=["part", "archive", "n_records"])

    names = chunks.columns
    # Names and counts of the archives reach the driver, one row each.
    done = sorted(map(tuple, chunks.mapInArrow(run, "part int, archive string, n_records bigint").collect()))
    return chunks.sparkSession.createDataFrame(done, "part int, archive string, n_records bigint")


class Unzipped:
    """The uncompressed bytes of an archive of gzip members, a block at a time."""

    def __init__(self, file, block: int = 1 << 16) -> None:
        self.file, self.block = file, block
        self.inflate, self.held, self.packed = None, b"", b""

    def _more(self) -> bool:
        """Inflate one more block; False at the end of the file."""
        while True:
            if not self.packed:
                self.packed = self.file.read(self.block)
                if not self.packed:
                    return False
            self.inflate = self.inflate or zlib.decompressobj(31)
            out = self.inflate.decompress(self.packed, self.block)
            self.packed = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if self.inflate.eof:
                self.inflate = None
            if out:
                self.held += out
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with `mark`; None at the end."""
        while (at := self.held.find(mark)) < 0:
            if not self._more():
                if self.held.strip():
                    raise ValueError("the archive ends within a record")
                return None
        out, self.held = self.held[: at + len(mark)], self.held[at + len(mark) :]
        return out

    def upto(self, count: int) -> bytes:
        """`count` bytes."""
        pieces, got = [self.held[:count]], min(count, len(self.held))
        self.held = self.held[count:]
        while got < count:
            if not self._more():
                raise ValueError("the archive ends within a record")
            pieces.append(self.held[: count - got])
            got += len(pieces[-1])
            self.held = self.held[len(pieces[-1]) :]
        return b"".join(pieces)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").strip("\r\n").split("\r\n")
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}


def _page(identity: str | None) -> int | None:
    parts = (identity or "").strip("<>").split(":")
    return int(parts[2]) if parts[:2] == ["urn", "page-id"] else None


def read_records(stream: Unzipped, chunk: int = CHUNK) -> Iterator[dict]:
    """The rows of an archive's chunk table, without its name."""
    record_no = 0
    while (head := stream.until(b"\r\n\r\n")) is not None:
        fields = _fields(head)
        http = stream.until(b"\r\n\r\n")
        left = int(fields["content-length"]) - len(http)
        row = {
            "record_no": record_no,
            "page_id": _page(fields["warc-record-id"]),
            "url": fields.get("warc-target-uri", ""),
            "record_type": fields["warc-type"],
            "refers_to": _page(fields.get("warc-refers-to")),
            "payload_bytes": int(_fields(http)["content-length"]),
            "payload_digest": fields["warc-payload-digest"].removeprefix("sha256:"),
        }
        digest, number, done = hashlib.sha256(), 0, 0
        while True:
            data = stream.upto(min(chunk, left))
            left, done = left - len(data), done + len(data)
            digest.update(data)
            yield row | {"chunk_no": number, "data": data, "bytes_so_far": done, "digest_so_far": digest.hexdigest(), "last": not left}
            number += 1
            if not left:
                break
        if stream.upto(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where it should")
        record_no += 1


def read(archives: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunk table of archives (archive): one row per `chunk` payload bytes of a record.

    `payload_bytes` and `payload_digest` are what the record's header says,
    `bytes_so_far` and `digest_so_far` what the chunks up to this one really
    have; in the row marked `last` they are those of the stored payload.  Nothing
    larger than a chunk is held.  `with_data=False` leaves `data` null.
    """
    kinds = {
        "archive": pa.string(), "record_no": pa.int64(), "page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_bytes": pa.int64(),
        "payload_digest": pa.string(), "chunk_no": pa.int64(), "data": pa.binary(), "bytes_so_far": pa.int64(), "digest_so_far": pa.string(), "last": pa.bool_(),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                system, root = place(archive)
                rows, held = [], 0
                with system.open_input_stream(root, compression=None) as file:
                    for row in read_records(Unzipped(file), chunk):
                        row["archive"] = archive
                        held += len(row["data"])
                        row["data"] = row["data"] if with_data else None
                        rows.append(row)
                        if len(rows) == 1000 or with_data and held >= 16 * chunk:
                            yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    return archives.select("archive").repartition(max(1, archives.count())).mapInArrow(run, READ)


def pages_of(chunks: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) of every record of a chunk table.

    Comes from each record's last row: for a response the bytes and digest that its
    chunks really add up to, for a revisit those in its header.
    """
    own = F.col("record_type") == "response"
    return chunks.filter("last").select(
        "page_id",
        F.when(own, F.col("bytes_so_far")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(own, F.col("digest_so_far")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
        "url",
    )


def archive(pages: DataFrame, folder: str, chunk: int = CHUNK) -> DataFrame:
    """Write `pages` (page_id, url, html; other columns are not read) and name the archives."""
    return write(records(pages, chunk), folder)


def written_and_read(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Write `pages` into archives in the shared folder and give the pages read back from them."""
    return pages_of(read(archive(pages, scratch(pages.sparkSession, "warc"), chunk), chunk, with_data=False))
