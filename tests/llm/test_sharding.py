"""Shards: whole tables, equal counts, gapless slots, an order without pattern, edges."""

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tasador.llm import sharding as M
from tasador.llm.common import scratch
from tasador.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def checked(rows, docs, shards):
    """The law, the slots, the digests; `docs` are (id, text)."""
    crc = lambda t: zlib.crc32((t or "").encode())
    size = lambda t: len((t or "").encode()) + 8
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=key) == sorted(((i, size(t), crc(t)) for i, t in docs), key=key)
    slots = defaultdict(list)
    for r in rows:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[s]) for s in range(shards)]
    assert set(slots) <= set(range(shards)) and max(counts) - min(counts) <= 1
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def test_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op11_sharding"](spark, SF).collect()
    checked(rows, docs, 24)
    again = QUERIES["op11_sharding"](spark, SF).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_many_buckets(spark):
    """Shards that cut buckets and buckets that cut shards; the files hold the texts themselves."""
    docs = [(i, f"text {i} " * (i % 40)) for i in range(3000)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    for shards, bytes_ in ((24, 4000), (3, 20_000), (7, 10**9), (5000, 10_000)):
        files = M.write(table, scratch(spark, "shards"), bucket_bytes=bytes_)
        ranges = M.slices(files, shards)
        rows = M.read(ranges).collect()
        assert sorted((r["doc_id"], r["text"]) for r in rows) == docs
        checked([{**r.asDict(), "law": "rows", "grown_shard": None} for r in rows], docs, shards)
        sizes = [r["n"] for r in files.collect()]
        assert len(sizes) == 1 if bytes_ == 10**9 else len(sizes) > 20
        if bytes_ == 4000:
            # One shard by itself reads its own ranges only.
            own = ranges.filter("shard = 5")
            assert {r["doc_id"] for r in M.read(own).collect()} == {r["doc_id"] for r in rows if r["shard"] == 5}


def test_order_has_no_pattern(spark):
    docs = [(i, "same length") for i in range(4000)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4, "doc_id")
    rows = M.sharded(table, shards=4, bucket_bytes=20_000).collect()
    place = {r["doc_id"]: r["shard"] * 1000 + r["slot"] for r in rows}
    assert sum(abs(place[i + 1] - place[i]) == 1 for i in range(3999)) < 20
    quarters = Counter((i // 1000, place[i] // 1000) for i in range(4000))
    assert all(190 < quarters[a, b] < 310 for a in range(4) for b in range(4))
    other = {r["doc_id"]: r["shard"] * 1000 + r["slot"] for r in M.sharded(table, shards=4, seed=43, bucket_bytes=20_000).collect()}
    assert sum(place[i] == other[i] for i in place) < 20


def test_copies_of_one_row_spread(spark):
    docs = [(5, "copy " * 20)] * 2000 + [(None, None)] * 1000 + [(i, "") for i in range(100, 1100)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6, F.lit(1))
    files = M.write(table, scratch(spark, "shards"), bucket_bytes=10_000)
    sizes = {r["path"]: r["n"] for r in files.collect()}
    assert len(sizes) > 15 and max(sizes.values()) < 3 * min(sizes.values())
    checked(M.sharded(table, bucket_bytes=10_000).collect(), docs, 24)


def test_edges(spark):
    docs = [(1, "a"), (1, "a"), (1, None), (None, "é😀"), (None, None), (2, ""), (3, "long " * 2_000)]
    table = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id bigint, text string, bucket int, row int")
    checked(M.sharded(table).collect(), docs, 24)  # fewer rows than shards
    checked(M.sharded(table, shards=1, bucket_bytes=1000).collect(), docs, 1)
    assert M.sharded(table.limit(0)).collect() == []
