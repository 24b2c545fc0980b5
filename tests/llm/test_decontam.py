"""Decontamination against exact containment."""

import random

import pytest

from tasador.llm import decontam as D
from tasador.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(docs, items, threshold=0.8):
    out = []
    for item_id, text in set(items):
        wanted_words = D.split((text or "").encode())
        size = min(5, len(wanted_words))
        if not size:
            continue
        wanted = D.shingles(wanted_words, size)
        for doc_id, body in docs:
            shared = len(wanted & D.shingles(D.split((body or "").encode()), size))
            if shared >= threshold * len(wanted):
                out.append((doc_id, item_id, shared, len(wanted), shared / len(wanted)))
    return sorted(out, key=str)


def found(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted(map(tuple, D.leaks(d, b, **kw).collect()), key=str)


def test_given_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op5_benchmark_decontamination"](spark, SF).collect()), key=str)
    assert got == plain(docs, items) and got


def _words(draw, n, of=4000):
    return [f"w{draw.randrange(of)}" for _ in range(n)]


def test_items_hidden_in_long_documents(spark):
    """Whole, edited, spread out and very short items; all that brute force finds is found."""
    draw = random.Random(3)
    items = [(i, " ".join(_words(draw, n))) for i, n in enumerate([1, 2, 4, 5, 6, 9, 15, 30, 59, 200, 900] * 3)]
    docs = []
    for i, (item, text) in enumerate(items):
        body, words = _words(draw, draw.choice([3, 400, 20_000]), 10**6), text.split()
        at = draw.randrange(len(body))
        if i % 3 == 1 and len(words) > 40:
            words[len(words) // 2] = "edited"
        if i % 3 == 2 and len(words) > 40:
            half = len(words) // 2
            body = body[:at] + words[:half] + _words(draw, 700, 10**6) + words[half:] + body[at:]
        else:
            body = body[:at] + words + body[at:]
        docs.append((100 + i, " ".join(body).upper() if i % 2 else "\n".join(body)))
    want = plain(docs, items)
    assert {(r[0] - 100, r[1]) for r in want} >= {(i, i) for i in range(len(items)) if i % 3 == 0}
    assert found(spark, docs, items) == want


def test_nulls_ties_and_empty(spark):
    passage = "one two three four five six seven eight nine ten"
    docs = [(1, None), (2, ""), (None, f"x {passage} y"), (3, passage), (3, passage), (4, "one two three"), (5, passage + " " + passage)]
    items = [(7, passage), (7, passage), (None, passage), (8, None), (9, " \n"), (10, "two three")]
    assert found(spark, docs, items) == plain(docs, items)
    assert found(spark, docs, []) == [] and found(spark, [], items) == []


def test_many_blocks_give_the_same(spark, monkeypatch):
    draw = random.Random(5)
    items = [(i, " ".join(_words(draw, 20))) for i in range(40)]
    docs = [(i, " ".join(_words(draw, 50) + items[i % 40][1].split())) for i in range(80)]
    want = found(spark, docs, items)
    monkeypatch.setattr(D, "ITEMS_PER_BLOCK", 10)
    assert found(spark, docs, items) == want == plain(docs, items)
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert D.clean(d, b).count() == 0
    assert D.leaks(d, b)._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_blocks_are_files_and_depend_on_the_items_alone(spark, tmp_path, monkeypatch):
    """More blocks than a worker holds, together all different items with a word, each once."""
    monkeypatch.setattr(D, "ITEMS_PER_BLOCK", 10)
    rows = [(i % 30, f"item {i % 30} has some words of its own") for i in range(60)] + [(None, None), (7, " "), (None, "no id")]
    items = spark.createDataFrame(rows, "item_id bigint, text string")

    def listed(df, folder):
        paths = D.signed(df, str(tmp_path / folder))
        assert len(paths) > D.HELD and all(p.startswith(str(tmp_path / folder)) for p in paths)
        blocks = [sorted((item for index in D._block(p) for item in index.items), key=str) for p in paths]
        return sorted(blocks, key=str)

    blocks = listed(items, "a")
    assert blocks == listed(items.repartition(7, "text"), "b")
    assert sorted((i for b in blocks for i in b), key=str) == sorted({(i, t.encode()) for i, t in rows if t and t.strip()}, key=str)


def test_clean_keeps_all_columns(spark):
    passage = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, passage, 2, [1.5]), (None, "a " + passage, 3, None), (None, "other words", 4, None), (5, None, None, [])], "doc_id bigint, text string, item_id int, containment array<double>")
    items = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    assert sorted(map(tuple, D.clean(docs, items).collect()), key=str) == [(5, None, None, []), (None, "other words", 4, None)]
    assert D.clean(docs, items).columns == docs.columns


def test_chance_of_a_miss():
    assert D.miss_probability() < 2e-6 and D.miss_probability(1.0) == pytest.approx(0.75**64)
