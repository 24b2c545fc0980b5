"""WARC archives: round trips and revisits."""

import gzip
import hashlib
import re

import pyarrow as pa
import pytest

from tasador.llm import warc as W
from tasador.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LONG = "<p>é longer than a hundred bytes</p>" * 10
HUGE = "".join(f"<p>{i} ü</p>" for i in range(30_000))
PAGES = [
    (4, "http://a/4", LONG, 1), (2, "http://a/2", LONG, 1), (9, None, LONG, 1), (2, "http://a/2", LONG, 1), (5, "u\r\nX: y", "short", 2), (6, "u", "short", 2), (7, "u", None, 3),
    (8, "u", "", 3), (None, "u", LONG, 4), (None, "u", HUGE + "x", 4), (10, "u", HUGE, 5), (11, "u", HUGE, 5), (12, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20, 6), (13, "u", "z" * 99, 7), (14, "u", "z" * 99, 7),
]
SCHEMA = "page_id bigint, url string, html string, record_type int"


def expected(pages):
    first = {}
    for page_id, _, html, _ in pages:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    out = []
    for page_id, url, html, _ in pages:
        payload = (html or "").encode()
        at = first.get(html or "", page_id) if len(payload) >= 100 else page_id
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), *(("response", None) if at == page_id else ("revisit", at))))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [7_000, W.CHUNK])
def test_round_trip(spark, chunk):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    got = W.written_and_read(pages, chunk).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected(PAGES)
    assert {r["page_id"]: r["url"] for r in got}[5] == "u%0D%0AX: y"


def test_round_trip_with_more_revisits_than_are_broadcast(spark, tmp_path):
    pages = spark.createDataFrame(PAGES * 3, SCHEMA).repartition(3)
    rows = W.records(pages, 7_000, max_rows=0)
    got = W.pages_of(W.read(W.write(rows, str(tmp_path / "w")), with_data=False)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected(PAGES * 3)


def test_rows_before_writing_are_bounded_and_carry_running_digests(spark):
    """A long page is in rows of a chunk from the first step on, and copies of it take no data along."""
    pages = spark.createDataFrame([(i, "u", HUGE * 3, 0) for i in range(6)], SCHEMA)
    rows = W.records(pages, 5_000).collect()
    payload = (HUGE * 3).encode()
    assert max(len(r["data"]) for r in rows) == 5_000 and sum(len(r["data"]) for r in rows) == len(payload)
    done = hashlib.sha256()
    for i, r in enumerate(sorted((r for r in rows if r["record_type"] == "response"), key=lambda r: r["chunk_no"])):
        done.update(r["data"])
        assert (r["chunk_no"], r["digest_so_far"], r["payload_bytes"]) == (i, done.hexdigest(), len(payload))
    assert done.hexdigest() == rows[0]["payload_digest"]
    plan = W.records(pages, 5_000)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_given_pages(spark):
    rows = [(*r, 0) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    got = sorted((tuple(r)[:5] for r in QUERIES["op9_warc_archive"](spark, SF).collect()), key=str)
    assert got == expected(rows)


def test_empty_table(spark):
    assert W.written_and_read(spark.createDataFrame([], SCHEMA)).collect() == []


def test_chunk_rows_carry_running_digests(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", HUGE, 0)], SCHEMA)
    archives = W.archive(pages, str(tmp_path / "w"), chunk=10_000)
    rows = W.read(archives, chunk=4_096).orderBy("chunk_no").collect()
    payload, done = HUGE.encode(), hashlib.sha256()
    assert len(rows) == -(-len(payload) // 4096) and [r["last"] for r in rows] == [False] * (len(rows) - 1) + [True]
    for i, r in enumerate(rows):
        assert len(r["data"]) <= 4096 and r["chunk_no"] == i
        done.update(r["data"])
        assert r["digest_so_far"] == done.hexdigest()
    assert b"".join(bytes(r["data"]) for r in rows) == payload and rows[-1]["digest_so_far"] == rows[-1]["payload_digest"]


def test_archives_are_plain_warc(spark, tmp_path):
    archives = W.archive(spark.createDataFrame(PAGES, SCHEMA), str(tmp_path / "w")).collect()
    assert sum(a["n_records"] for a in archives) == len(PAGES)
    text = b"".join(gzip.open(a["archive"]).read() for a in archives)
    ids = set(re.findall(rb"WARC-Record-ID: (\S+)", text))
    assert len(ids) == len({p[::2] for p in PAGES}) and set(re.findall(rb"WARC-Refers-To: (\S+)", text)) <= ids
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(PAGES) and text.count(b"WARC-Type: revisit") == 4


def test_damage_is_noticed(tmp_path):
    writer = W.ArchiveWriter(str(tmp_path))
    chunk = dict(page_id=1, url="u", record_type="response", refers_to=None, payload_bytes=10, payload_digest="0", chunk_no=0, data=b"12345")
    writer.add(chunk)
    with pytest.raises(ValueError):
        writer.close()
    cut = gzip.compress(W._header(chunk)[0] + b"1234")
    with pytest.raises(ValueError):
        list(W.read_records(W.Unzipped(pa.BufferReader(cut))))
