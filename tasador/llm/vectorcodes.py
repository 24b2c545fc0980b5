"""Product codes of integer vectors, searched through dictionaries of each dimension's values."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.llm.common import stored
from tasador.operators.keyed import lookup

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
CHUNK = 8192
"""Vectors whose values share dictionaries."""
BLOCK = 256
"""Vectors whose distances are added up at once; they stay in the processor's cache."""


def limit(width: int) -> int:
    """Largest magnitude of a component, so that the squared distance of a part of `width` fits 62 bits."""
    return 1 << ((62 - (max(1, width) - 1).bit_length()) // 2 - 1)


def nearest(values: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (the lower one on a tie) and squared distance, for every row of one part.

    Every dimension has a dictionary of its distinct integers and a table of the
    squared differences of each of them to all entries.  A row's distances are the
    sum of the table rows its dictionary codes name: gathers and adds, no
    multiplication per vector.
    """
    n, width = values.shape
    spread = max(int(values.max(initial=0)), int(entries.max())) - min(int(values.min(initial=0)), int(entries.min()))
    kind = np.int32 if spread * spread * width < 1 << 31 else np.int64
    tables, codes = [], []
    for j in range(width):
        known, code = np.unique(values[:, j], return_inverse=True)
        tables.append(np.square((known[:, None] - entries[None, :, j]).astype(kind)))
        codes.append(code)
    index, distance = np.empty(n, np.int64), np.empty(n, np.int64)
    for first in range(0, n, BLOCK):
        rows = slice(first, min(n, first + BLOCK))
        total = tables[0].take(codes[0][rows], axis=0)
        gathered = np.empty_like(total)
        for table, code in zip(tables[1:], codes[1:]):
            total += table.take(code[rows], axis=0, out=gathered, mode="clip")
        index[rows] = best = total.argmin(axis=1)
        distance[rows] = total[np.arange(len(best)), best]
    return index, distance


def _chunks(batches: Iterator[pa.RecordBatch], column: int, dims: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches put together to about CHUNK rows, with their vectors as one array."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= CHUNK:
            yield _together(held, column, dims)
            held, count = [], 0
    if count:
        yield _together(held, column, dims)


def _together(held: list[pa.RecordBatch], column: int, dims: int) -> tuple[pa.Table, np.ndarray]:
    parts = [b.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) for b in held]
    return pa.Table.from_batches(held), np.concatenate(parts).astype(np.int64)


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str | None = "label", parts: int = PARTS) -> DataFrame:
    """(vec_id, label, known, v) of the vectors that can be encoded, `v` as floor(1024 * x).

    Null vectors and those with a null, infinite or not-a-number component go, and
    those whose length is no multiple of `parts`, or differs from that of the
    vector with the smallest id (null ids last, shorter vectors first).
    Components beyond `limit` count as the limit.  `label` is its text, `known`
    whether it has one.  Other columns are not read.
    """
    named = F.col(label).cast("string") if label else F.lit(None).cast("string")
    read = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.coalesce(named, F.lit("")).alias("label"), named.isNotNull().alias("known"), F.col(vector).cast("array<double>").alias("v"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = read.filter(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0)).filter(whole)
    first = kept.agg(F.min(F.struct(F.col("vec_id").isNull().alias("null"), "vec_id", F.size("v").alias("dims"))).alias("m")).first()["m"]
    dims = first["dims"] if first else parts
    far = float(limit(dims // parts))
    integer = F.transform("v", lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(far)), F.lit(-far))).cast("int"))
    return kept.filter(F.size("v") == dims).withColumn("v", integer)


def start(kept: DataFrame, entries: int = ENTRIES, parts: int = PARTS) -> np.ndarray:
    """Codebooks (part, entry, place) from the vectors of the `entries` smallest ids, ascending.

    A null id comes last.  Of several vectors with one id the smallest, place by
    place, is taken.  Only those vectors reach the driver.
    """
    ids = [r[0] for r in kept.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(entries).collect()]
    if not ids:
        return np.zeros((parts, 0, 0), np.int64)
    chosen = F.col("vec_id").isin([i for i in ids if i is not None]) | (F.col("vec_id").isNull() & F.lit(None in ids))
    found = {r["vec_id"]: r["v"] for r in kept.filter(chosen).groupBy("vec_id").agg(F.min("v").alias("v")).collect()}
    whole = np.array([found[i] for i in ids], np.int64)
    return np.stack(np.split(whole, parts, axis=1))


def refine(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every part goes to its nearest entry, every used entry becomes its parts' mean, rounded down.

    Each task adds up its own parts; what is shuffled is a row per task, part and
    entry, and what reaches the driver is the codebooks.
    """
    parts, entries, width = books.shape
    sums_of = [f"s{j}" for j in range(width)]
    names = ["part", "entry", "n", *sums_of]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for _, values in _chunks(batches, 0, parts * width):
            for p in range(parts):
                own = values[:, p * width : (p + 1) * width]
                index, _ = nearest(own, books[p])
                order = np.argsort(index, kind="stable")
                used, first, n = np.unique(index[order], return_index=True, return_counts=True)
                counts[p, used] += n
                sums[p, used] += np.add.reduceat(own[order], first, axis=0)
        part, entry = np.nonzero(counts)
        columns = [part, entry, counts[part, entry], *sums[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    seen = kept.select("v").mapInArrow(run, ", ".join(f"{n} bigint" for n in names))
    # Exact whatever the number of rows: the sums of tasks are added as decimals.
    totals = [F.sum(F.col(n).cast("decimal(38,0)")).alias(n) for n in ["n", *sums_of]]
    books = books.copy()
    for row in seen.groupBy("part", "entry").agg(*totals).collect():
        books[row["part"], row["entry"]] = [int(row[s]) // int(row["n"]) for s in sums_of]
    return books


def fit(kept: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, parts: int = PARTS) -> np.ndarray:
    """Codebooks after `rounds` rounds over all vectors."""
    books = start(kept, entries, parts)
    for _ in range(rounds if books.size else 0):
        books = refine(kept, books)
    return books


def encode(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, known, code, error): indexes of the nearest entries, two hex digits a part, and the squared distance.

    An error beyond 64 bits counts as the largest number.
    """
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, values in _chunks(batches, 3, parts * width):
            found = [nearest(values[:, p * width : (p + 1) * width], books[p]) for p in range(parts)]
            hexed = np.stack([index for index, _ in found], axis=1).astype(np.uint8).tobytes().hex()
            codes = [hexed[i : i + 2 * parts] for i in range(0, len(hexed), 2 * parts)]
            error, over = np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
            for _, distance in found:
                error += distance
                over |= error < 0
                error[over] = np.iinfo(np.int64).max >> 1
            error[over] = np.iinfo(np.int64).max
            columns = [rows.column(n).combine_chunks() for n in ("vec_id", "label", "known")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(codes, pa.string()), pa.array(error, pa.int64())], names=["vec_id", "label", "known", "code", "error"])

    if books.shape[1] > 256:
        raise ValueError("an index has two hex digits: 256 entries at most")
    return kept.select("vec_id", "label", "known", "v").mapInArrow(run, "vec_id bigint, label string, known boolean, code string, error bigint")


def decode(codes: DataFrame, books: np.ndarray, code: str = "code") -> DataFrame:
    """`codes` plus `v`, the integer vector its code stands for."""
    tables = [F.array(*[F.array(*[F.lit(int(x)) for x in entry]) for entry in book]) for book in books]
    place = [F.conv(F.substring(code, 2 * p + 1, 2), 16, 10).cast("int") for p in range(len(books))]
    return codes.withColumn("v", F.concat(*[F.get(t, i) for t, i in zip(tables, place)]))


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compressed(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str | None = "label") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, code, error, label_error), codebooks) of all vectors that `integer_vectors` keeps.

    `label_error`: the errors of all rows of one label together, those without a
    label being one group; null beyond 64 bits.  One row per kept row: null ids
    and repeated rows stay, and repeated rows count as often as they come.  An
    empty table, or one without a usable vector, gives no rows and empty codebooks.
    Vectors are stored once as integers and read in every round; a label of a
    third of all rows is a number, added up in every task first.
    """
    kept = stored(integer_vectors(vectors, vec_id, vector, label), "integer-vectors")
    books = fit(kept)
    coded = stored(encode(kept, books), "vector-codes") if books.size else encode(kept.limit(0), books)
    errors = coded.groupBy("label", "known").agg(F.try_sum("error").alias("label_error"))
    return lookup(coded, errors, ["label", "known"]).select("vec_id", "code", "error", "label_error"), books
