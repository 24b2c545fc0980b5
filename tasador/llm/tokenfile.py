"""Token ids in Arrow files of equal-length sequences and masks."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.llm.common import scratch
from tasador.llm.tokenizer import WORD_CHARS, encoder

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
LENGTH = 2048
SEQUENCES = 64
"""Sequences in a record batch: 256 KB of ids."""

PARTS = "part int, ids string, documents string, n_docs bigint, n_tokens bigint"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def place(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file every executor can reach."""
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


def schema(kind: np.dtype, length: int) -> pa.Schema:
    """`input_ids`; `mask`: 1 for ids, 0 for the filling of the last sequence; `ends`: 1 for the last id of a document."""
    bits = pa.list_(pa.field("item", pa.bool_(), False), length)
    ids = pa.list_(pa.field("item", pa.from_numpy_dtype(kind), False), length)
    return pa.schema([("input_ids", ids), ("mask", bits), ("ends", bits)])


class Writer:
    """One file of sequences and one of documents; ids that do not fill a batch wait in memory."""

    def __init__(self, folder: str, kind: np.dtype, length: int, end_id: int) -> None:
        system, root = place(folder)
        name = uuid.uuid4().hex  # a task that runs again writes other files; only those of the row it returns are read
        self.ids, self.documents = f"{folder}/ids-{name}.arrow", f"{folder}/documents-{name}.arrow"
        self.kind, self.length, self.schema = kind, length, schema(kind, length)
        self.files = [system.open_output_stream(f"{root}/ids-{name}.arrow"), system.open_output_stream(f"{root}/documents-{name}.arrow")]
        self.sequences = pa.ipc.new_file(self.files[0], self.schema)
        self.index = pa.ipc.new_file(self.files[1], INDEX)
        self.end = np.array([end_id], kind).tobytes()
        self.held = bytearray()
        self.ends: list[int] = []  # places of document ends, counted from the first id held
        self.n_tokens = self.n_docs = 0

    def add(self, doc_ids: list[int | None], encoded: list[bytes]) -> None:
        size, starts, counts = self.kind.itemsize, [], []
        for ids in encoded:
            self.held += ids
            self.held += self.end
            starts.append(self.n_tokens)
            counts.append(len(ids) // size + 1)
            self.n_tokens += counts[-1]
            self.ends.append(len(self.held) // size - 1)
            if len(self.held) >= size * self.length * SEQUENCES:
                self._flush(len(self.held) // (size * self.length * SEQUENCES) * SEQUENCES)
        self.n_docs += len(doc_ids)
        self.index.write_batch(pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64())], schema=INDEX))

    def _flush(self, rows: int) -> None:
        """Write the first `rows` sequences; all batches of a file but the last are of one size."""
        size = self.kind.itemsize
        for first in range(0, rows, SEQUENCES):
            n = min(SEQUENCES, rows - first) * self.length
            ids = np.frombuffer(bytes(self.held[first * self.length * size : (first * self.length + n) * size]), self.kind)
            mask, ends = np.ones(n, bool), np.zeros(n, bool)
            mask[len(ids) :] = False
            own = np.array(self.ends, np.int64) - first * self.length
            ends[own[(own >= 0) & (own < n)]] = True
            if len(ids) < n:
                ids = np.concatenate([ids, np.zeros(n - len(ids), self.kind)])
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(v), type=f.type) for v, f in zip((ids, mask, ends), self.schema)]
            self.sequences.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        del self.held[: rows * self.length * size]
        self.ends = [e - rows * self.length for e in self.ends if e >= rows * self.length]

    def close(self) -> None:
        if self.held:
            self._flush(-(-len(self.held) // (self.kind.itemsize * self.length)))
        self.sequences.close()
        self.index.close()
        for file in self.files:
            file.close()


def write(docs: DataFrame, vocabulary: str, folder: str, length: int = LENGTH, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text of `docs` into files under `folder`; returns one row per part, in order.

    The ids of all documents, each followed by `end_id`, form one stream in
    ascending doc_id order (null ids first, equal ids by text), cut at the parts
    and there into sequences of `length` ids.  Only a part's last sequence is
    filled up.  Null and empty texts are the end id alone; repeated rows are
    written as often as they come.  Other columns are not read.  A part is a
    range of doc_id; equal ids and texts may fall into several parts.
    """
    _make(folder)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keys = rows.withColumn("_hash", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    line = keys.repartitionByRange("doc_id", "_hash", "_row").sortWithinPartitions("doc_id", "_hash", "_row").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, writer = encoder(vocabulary), None
        ids: list[int | None] = []
        texts: list[str] = []
        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            writer = writer or Writer(folder, tokens.kind, length, end_id)
            ids += batch.column(0).to_pylist()
            texts += batch.column(1).to_pylist()
            held += batch.nbytes
            if held >= WORD_CHARS:  # many texts at once share more words
                writer.add(ids, tokens.encode(texts))
                ids, texts, held = [], [], 0
        if ids:
            writer.add(ids, tokens.encode(texts))
        if writer:
            writer.close()
            row = [TaskContext.get().partitionId(), writer.ids, writer.documents, writer.n_docs, writer.n_tokens]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()])], names=["part", "ids", "documents", "n_docs", "n_tokens"])

    # One row per part reaches the driver: names and two counts.
    parts = sorted(map(tuple, line.mapInArrow(run, PARTS).collect()))
    done, out = 0, []
    for part in parts:
        out.append((*part, done))
        done += part[-1]
    return docs.sparkSession.createDataFrame(out, PARTS + ", first bigint")


def _make(folder: str) -> None:
    system, root = place(folder)
    system.create_dir(root, recursive=True)


class Sequences:
    """Random access to a file of sequences.  A local file is mapped, and the arrays are views of it."""

    def __init__(self, path: str) -> None:
        system, root = place(path)
        source = pa.memory_map(root) if isinstance(system, pafs.LocalFileSystem) else system.open_input_file(root)
        self.file = pa.ipc.open_file(source)
        self.length = self.file.schema.field("input_ids").type.list_size
        self.batches = self.file.num_record_batches
        self.per_batch = self.file.get_batch(0).num_rows if self.batches else 0

    def __len__(self) -> int:
        return (self.batches - 1) * self.per_batch + self.file.get_batch(self.batches - 1).num_rows if self.batches else 0

    def sequence(self, i: int) -> dict[str, np.ndarray]:
        """Sequence `i`: `input_ids` without a copy, `mask` and `ends` unpacked from their bits."""
        batch, row = self.file.get_batch(i // self.per_batch), i % self.per_batch
        return {name: batch.column(name)[row].values.to_numpy(zero_copy_only=name == "input_ids") for name in ("input_ids", "mask", "ends")}

    def ids(self, start: int, count: int) -> Iterator[np.ndarray]:
        """Ids `start` to `start + count` of the file's stream, as views batch by batch."""
        size = self.per_batch * self.length
        while count:
            flat = self.file.get_batch(start // size).column("input_ids").flatten().to_numpy(zero_copy_only=True)
            piece = flat[start % size : start % size + count]
            yield piece
            start, count = start + len(piece), count - len(piece)


def read(parts: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of `write`.

    `start` counts the ids of all documents before it; `ids_crc32` is the crc32 of
    its ids, the end id included, as little-endian 32-bit numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                sequences = Sequences(part["ids"])
                system, root = place(part["documents"])
                with system.open_input_file(root) as file:
                    index = pa.ipc.open_file(file)
                    for i in range(index.num_record_batches):
                        rows = index.get_batch(i)
                        digests = []
                        for start, count in zip(rows.column("start").to_pylist(), rows.column("n_tokens").to_pylist()):
                            crc = 0
                            for ids in sequences.ids(start, count):
                                crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                            digests.append(crc)
                        starts = pa.array(np.array(rows.column("start")) + part["first"], pa.int64())
                        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), starts, rows.column("n_tokens"), pa.array(digests, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # A part for each task: the rows are names, the work is in the files.
    return parts.repartition(max(1, parts.count())).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def written_and_read(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """Write `docs` into the shared folder and give what is read back."""
    return read(write(docs, vocabulary, scratch(docs.sparkSession, "tokens"), length))
