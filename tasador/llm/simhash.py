"""SimHash near-duplicates: fingerprints, links by pigeonhole blocks, groups."""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.llm.common import map_arrow, stored
from tasador.llm.components import components

SEED = 42
BITS = 64
SLICE = 4096
"""Hashes whose bits are counted at once."""


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Signed 64-bit fingerprint: a bit is set if it is set in over half of the shingles' hashes."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    joined = b" ".join(words)
    at = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(at, at[width:])), "<u8", len(words) - width + 1)
    ones = np.zeros(BITS, np.int64)
    for first in range(0, len(hashes), SLICE):
        bits = np.unpackbits(hashes[first : first + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) for every row of `docs`.

    Words are runs without ASCII white space, with A-Z lower-cased; shingles are
    `shingle` words in a row, the whole text if it has fewer, repeats included.
    A null or wordless text has fingerprint 0.  Null ids and repeated rows stay.
    """

    def rows(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "fp": [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]}

    return map_arrow(docs.select(F.col(doc_id).cast("bigint"), F.col(text).cast("binary")), rows, "doc_id bigint, fp bigint")


def _pieces(count: int) -> list[int]:
    """Masks that cut the bits into `count` pieces, as signed longs."""
    edges = [round(i * BITS / count) for i in range(count + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def block_keys(fp: Column, max_distance: int, spare: int) -> Column:
    """The keys by which close fingerprints meet.

    The bits are cut into `max_distance + spare` pieces.  Two fingerprints that
    differ in at most `max_distance` bits agree on `spare` whole pieces; every
    choice of `spare` pieces is one key: its number and the bits in it.
    """
    masks = [_signed(sum(c)) for c in combinations(_pieces(max_distance + spare), spare)]
    return F.array(*[F.struct(F.lit(i).alias("no"), fp.bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)])


def links(distinct: DataFrame, max_distance: int = 2, spare: int = 3, crowd: int = 32) -> DataFrame:
    """Pairs (a, b) that connect the fingerprints of `distinct` (fp) differing in at most `max_distance` bits.

    Fingerprints meet in blocks (`block_keys`) and are compared there.  A block of
    over `crowd` fingerprints would give pairs by the square of its size; its
    members are dealt out once more, by themselves with each single bit flipped.
    Two fingerprints share such a value exactly if they differ in at most two
    bits, so one value has at most 65 of them, all linked to each other, and
    each is linked to the smallest.  No link between groups is lost either way;
    inside a crowded block the pairs are a spanning part of all links.
    """
    if max_distance not in (1, 2):
        raise ValueError("links are found for one or two differing bits")
    keys = distinct.select("fp", F.explode(block_keys(F.col("fp"), max_distance, spare)).alias("key")).select("fp", "key.*")
    sizes = keys.groupBy("no", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = stored(keys.join(sizes, ["no", "bits"]), "blocks")
    calm = met.filter(F.col("n") <= crowd)
    other = calm.select("no", "bits", F.col("fp").alias("other"))
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_distance
    pairs = calm.join(other, ["no", "bits"]).filter(F.col("fp") < F.col("other")).filter(close).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    crowded = met.filter(F.col("n") > crowd).select("fp").distinct()
    flips = F.array(*[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(BITS)], F.col("fp"))
    dealt = crowded.select("fp", F.explode(flips).alias("value"))
    if max_distance == 2:
        near = dealt.groupBy("value").agg(F.collect_list("fp").alias("near")).filter(F.size("near") > 1)
        stars = near.select(F.array_min("near").alias("a"), F.explode("near").alias("b")).filter("a != b")
    else:
        stars = dealt.join(crowded.select(F.col("fp").alias("b")), F.col("value") == F.col("b")).filter("fp < b").select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(stars).distinct()


def grouped(own: DataFrame, max_distance: int = 2) -> DataFrame:
    """`own` (doc_id, fp) with `root`, one fingerprint that stands for the group, and `component_id`, its smallest doc_id.

    Equal fingerprints are folded to one before any search, so a group of exact
    copies costs a row.
    """
    folded = stored(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(folded.select("fp"), max_distance)).withColumnRenamed("node", "fp")
    placed = folded.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return own.join(placed.join(groups, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for every row of `docs`.

    `fingerprint`: 16 lower-case hex digits.  `component_id`: the smallest doc_id
    reached over links of at most `max_distance` differing bits, the row's own
    included; null only if no row of the group has an id.  Of `docs` only the id and
    text are read; other columns may have any name.
    """
    own = stored(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return grouped(own, max_distance).select("doc_id", hexed, "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """One row of every near-duplicate group, with all columns of `docs`: that of the smallest doc_id.

    Of rows that share this id the one with the smallest fingerprint stays, then the
    one with the smallest hash of its text, then of all columns.  Of a group without
    ids a row is chosen in the same way.  Texts are fingerprinted once: groups are
    settled on ids, fingerprints and text hashes, by which whole rows are met again
    and shuffled once.
    """
    read = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("h"), F.col("text").cast("binary"))

    def rows(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "h": batch.column(1), "fp": [fingerprint(t, shingle) for t in batch.column(2).to_pylist()]}

    own = stored(map_arrow(read, rows, "doc_id bigint, h bigint, fp bigint"), "fingerprints")
    found = grouped(own, max_distance).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keys = found.groupBy("root").agg(F.min(F.struct("fp", "h")).alias("best"), F.min("doc_id").alias("id"))
    keys = keys.select(F.coalesce("id", F.lit(0)).alias("k_id"), F.col("id").isNull().alias("k_null"), F.col("best.h").alias("k_h"))
    whole = F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("whole")
    id_ = F.col("doc_id").cast("bigint")
    packed = docs.select(whole, F.coalesce(id_, F.lit(0)).alias("k_id"), id_.isNull().alias("k_null"), F.xxhash64("text").alias("k_h"))
    key = ["k_id", "k_null", "k_h"]
    return packed.join(keys, key, "left_semi").groupBy(*key).agg(F.min_by("whole", F.xxhash64("whole")).alias("whole")).select("whole.*")
