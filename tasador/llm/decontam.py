"""Benchmark decontamination: test items found inside documents by size-partitioned MinHash."""

from __future__ import annotations

import math
import pickle
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.llm.common import scratch
from tasador.llm.tokenfile import place

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 64
ITEMS_PER_BLOCK = 20_000
BYTES_PER_BLOCK = 32 << 20
HELD = 2
"""Blocks of items that a Python worker keeps in memory."""
SLICE = 1 << 16
"""Shingles of so many documents are searched together; 0.5 MB for each hash function."""
ROUND = 1 << 20
"""Words of documents that wait together for a block to be read, where there are more blocks than a worker holds."""

_MIX = np.random.Generator(np.random.PCG64(20_240_601)).integers(1, 1 << 63, (2, HASHES), dtype=np.uint64)
MULTIPLY, ADD = _MIX[0] | np.uint64(1), _MIX[1]


def split(text: bytes | None) -> list[bytes]:
    """Words: runs without ASCII white space, A-Z lower-cased."""
    return (text or b"").lower().split()


def shingles(words: list[bytes], size: int) -> set[bytes]:
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """One 64-bit hash for every `size` words in a row; none if there are fewer words."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = (out ^ own[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def minima(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash values of the runs of shingles that begin at `starts`: a row per hash function, a column per run."""
    return np.stack([np.minimum.reduceat(hashes * m + a, starts) for m, a in zip(MULTIPLY, ADD)])


class Index:
    """MinHash signatures of a bounded number of items, by size class.

    Class c holds the items of over 2**(c-1), up to 2**c different shingles.  Documents
    are searched for it in windows of two neighbouring runs of 2**c shingles, so
    that a passage of that size lies whole in one window, and the similarity of
    item and window is at least about a quarter of the containment however long
    the document is.  A passage that is spread out meets more windows, each in
    part, with the same number of expected hits.
    """

    def __init__(self, items: list[tuple[int | None, list[bytes]]], size: int) -> None:
        self.size = size
        self.items = [(item_id, b" ".join(words)) for item_id, words in items]
        rows: dict[int, list[tuple[int, np.ndarray]]] = {}
        for i, (_, words) in enumerate(items):
            values = minima(shingle_hashes(words, size), np.zeros(1, np.int64))[:, 0]
            rows.setdefault((len(shingles(words, size)) - 1).bit_length(), []).append((i, values))
        # Per class and hash function: the items' values in order, and whose they are.
        self.classes = []
        for c, found in sorted(rows.items()):
            values = np.stack([v for _, v in found], axis=1)
            order = np.argsort(values, axis=1, kind="stable")
            self.classes.append((c, np.take_along_axis(values, order, 1), np.array([i for i, _ in found])[order]))

    def candidates(self, hashes: list[np.ndarray]) -> set[tuple[int, int]]:
        """(document, item) pairs that share a MinHash value; `hashes` has the shingles of each document."""
        sizes = np.array([len(h) for h in hashes], np.int64)
        out: set[tuple[int, int]] = set()
        if not sizes.sum():
            return out
        width = 1 << self.classes[0][0]
        runs = -(-sizes // width)
        doc = np.repeat(np.arange(len(sizes)), runs)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs)
        values = minima(np.concatenate(hashes), place * width + np.repeat(np.cumsum(sizes) - sizes, runs))
        for c, own, owners in self.classes:
            while width < 1 << c:  # a run of the next class is a pair of runs
                first = np.flatnonzero(place % 2 == 0)
                values = np.minimum.reduceat(values, first, axis=1)
                doc, place, width = doc[first], place[first] // 2, width * 2
            windows = values.copy()
            whole = np.flatnonzero(doc[1:] == doc[:-1])
            windows[:, whole] = np.minimum(values[:, whole], values[:, whole + 1])
            for k in range(HASHES):
                at = np.minimum(np.searchsorted(own[k], windows[k]), own.shape[1] - 1)
                for w in np.flatnonzero(own[k][at] == windows[k]).tolist():
                    until = np.searchsorted(own[k], windows[k, w], "right")
                    out.update((int(doc[w]), i) for i in owners[k][at[w] : until].tolist())
        return out

    def verified(self, group: list[tuple[int, list[bytes]]], hashes: list[np.ndarray], threshold: float) -> Iterator[tuple[int, int | None, int, int]]:
        """(row, item_id, shingles shared, shingles of the item) where enough of the item's shingles are in the row."""
        last, own = -1, set()
        wanted_of: dict[int, set[bytes]] = {}
        for doc, i in sorted(self.candidates(hashes)):
            row, words = group[doc]
            if doc != last:
                last, own = doc, shingles(words, self.size)
            item_id, text = self.items[i]
            if i not in wanted_of:
                wanted_of[i] = shingles(text.split(), self.size)
            shared = len(wanted_of[i] & own)
            if shared >= threshold * len(wanted_of[i]):
                yield row, item_id, shared, len(wanted_of[i])


def miss_probability(containment: float = THRESHOLD) -> float:
    """Upper estimate of the chance that none of the item's MinHash values meets those of its window."""
    return (1 - containment / (5 - containment)) ** HASHES


def indexes(items: list[tuple[int | None, bytes | None]]) -> list[Index]:
    """The items of one block, by the length of their shingles; items without a word are left out."""
    by_size: dict[int, list] = {}
    for item_id, text in items:
        if words := split(text):
            by_size.setdefault(min(SHINGLE, len(words)), []).append((item_id, words))
    return [Index(own, size) for size, own in sorted(by_size.items())]


@lru_cache(maxsize=HELD)
def _block(path: str) -> list[Index]:
    system, file = place(path)
    with system.open_input_stream(file) as source:
        return pickle.loads(source.read())


def search(paths: list[str], threshold: float, texts: pa.Array) -> Iterator[tuple[int, int | None, int, int]]:
    """(row, item_id, shingles shared, shingles of the item), verified, for the texts of a batch and the items of all blocks."""
    at_once = SLICE if len(paths) <= HELD else ROUND
    group: list[tuple[int, list[bytes]]] = []
    held = 0
    for row, text in enumerate(texts):
        group.append((row, split(text.as_py())))
        held += len(group[-1][1])
        if held >= at_once:
            yield from _searched(paths, threshold, group)
            group, held = [], 0
    if group:
        yield from _searched(paths, threshold, group)


def _searched(paths: list[str], threshold: float, group: list[tuple[int, list[bytes]]]) -> Iterator[tuple[int, int | None, int, int]]:
    parts: list[list[tuple[int, list[bytes]]]] = [[]]
    held = 0
    for row in group:
        parts[-1].append(row)
        held += len(row[1])
        if held >= SLICE:
            parts.append([])
            held = 0
    known: dict[tuple[int, int], list[np.ndarray]] = {}
    for path in paths:
        for index in _block(path):
            for k, part in enumerate(parts):
                if (k, index.size) not in known:
                    known[k, index.size] = [shingle_hashes(words, index.size) for _, words in part]
                yield from index.verified(part, known[k, index.size], threshold)


def signed(benchmark: DataFrame, folder: str, item_id: str = "item_id", text: str = "text") -> list[str]:
    """Sign the different items in Spark and write them as files under `folder`, a block each; returns the paths.

    A block is bounded in number and bytes and depends on its items alone.  The
    driver sees counts and paths, never a text.  A task that runs again writes
    another file; only those that finished tasks report are returned.
    """
    items = benchmark.select(F.col(item_id).cast("bigint").alias("id"), F.col(text).cast("binary").alias("text"))
    count, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    parts = max(math.ceil(2 * count / ITEMS_PER_BLOCK), math.ceil(2 * size / BYTES_PER_BLOCK))
    if not parts:
        return []
    system, root = place(folder)
    system.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [pair for batch in batches for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        if built := indexes(held):
            name = f"block-{uuid.uuid4().hex}"
            with system.open_output_stream(f"{root}/{name}") as file:
                file.write(pickle.dumps(built))
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"])], names=["path"])

    dealt = items.distinct().withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(parts)).cast("int"))
    blocks = dealt.repartitionById(parts, F.col("block")).sortWithinPartitions("id", "text").select("id", "text")
    return sorted(r["path"] for r in blocks.mapInArrow(run, "path string").collect())


def leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) of every document and item with enough in common.

    `containment` is the share of the item's different five-word shingles that
    the whole document has anywhere; pairs of at least `threshold` are returned.
    MinHash finds the candidates, the shingles themselves decide; a contained
    item is missed with a chance below `miss_probability()`.  An item of fewer
    than five words is one shingle of its own length, looked for among shingles
    of that length.  Items without a word are found nowhere.  Every document row
    is judged by itself, equal items count once, null ids stay null.

    The signed items lie in files in the shared folder, in blocks bounded in
    number and bytes; the documents are read once, in one narrow pass without a
    shuffle, and a task takes one block after the other for the texts it holds.
    """
    schema = "doc_id bigint, item_id bigint, n_shared bigint, n_item bigint, containment double"
    read = docs.select(F.col(doc_id).cast("bigint"), F.col(text).cast("binary"))
    paths = signed(benchmark, scratch(docs.sparkSession, "benchmark"), item_id, item_text)
    if not paths:
        return docs.sparkSession.createDataFrame([], schema)
    return read.mapInArrow(_reporter(paths, threshold), schema)


def _reporter(paths: list[str], threshold: float):
    names = ["doc_id", "item_id", "n_shared", "n_item", "containment"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(batch.column(0)[row].as_py(), i, n, m, n / m) for row, i, n, m in search(paths, threshold, batch.column(1))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return report


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` whose text holds no item, with all their columns."""
    at = docs.columns.index("text")
    paths = signed(benchmark, scratch(docs.sparkSession, "benchmark"))
    return docs.mapInArrow(_filter(paths, threshold, at), docs.schema) if paths else docs


def _filter(paths: list[str], threshold: float, at: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            clean[[row for row, *_ in search(paths, threshold, batch.column(at).cast(pa.binary()))]] = False
            yield batch.filter(pa.array(clean))

    return keep
