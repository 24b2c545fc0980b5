"""Toxicity on held-out documents and on planted ones."""

import random
import zlib

import numpy as np
import pytest

from tasador.llm import toxicity as T
from tasador.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def planted(n, seed=1, share=0.12):
    """Documents of which some have a bad word, and labels for a third of them."""
    draw = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "te") for b in ("na", "so", "vi", "zu", "pel", "dor")]
    bad = ["blorg", "snirkle", "snirkler", "snirkling"]
    docs, labels = [], []
    for i in range(n):
        words = [draw.choice(vocabulary) for _ in range(draw.choice([8, 60, 400]))]
        toxic = draw.random() < share
        if toxic:
            words[draw.randrange(len(words))] = draw.choice(bad).upper() + ","
        docs.append((i, " ".join(words)))
        if draw.random() < 0.35:
            labels.append((i, int(toxic)))
        docs[-1] += (toxic,)
    return docs, labels


def test_planted_words_are_learned(spark):
    docs, labels = planted(1500)
    table = spark.createDataFrame([d[:2] for d in docs], "doc_id bigint, text string")
    model = T.fit(table, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    got = {r["doc_id"]: r for r in T.scores(table, model).collect()}
    truth = {d[0]: d[2] for d in docs}
    hits = [(truth[i], r["predicted"]) for i, r in got.items() if r["held_out"]]
    assert sum(t and p for t, p in hits) >= 0.95 * sum(t for t, _ in hits)
    assert sum(p and not t for t, p in hits) <= 0.05 * sum(not t for t, _ in hits)
    assert abs(model.prior - 0.12) < 0.05
    # Held-out labels and text play no part: without them the model is the same.
    kept = {r["doc_id"] for r in got.values() if not r["held_out"]}
    again = T.fit(spark.createDataFrame([d[:2] for d in docs if d[0] in kept], "doc_id bigint, text string"), spark.createDataFrame([x for x in labels if x[0] in kept], "doc_id bigint, toxic int"))
    assert again.wanted == model.wanted and np.array_equal(again.weights, model.weights)


def test_given_documents(spark):
    got = {r["doc_id"]: r for r in QUERIES["op7_toxicity"](spark, SF).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    held = [(labels[i], r["score"]) for i, r in got.items() if r["held_out"] and i in labels]
    good = [s for t, s in held if t]
    bad = [s for t, s in held if not t]
    assert np.mean([[(a > b) + 0.5 * (a == b) for b in bad] for a in good]) > 0.9  # area under the curve


def test_risk_is_never_driven_below_zero():
    """A feature that only positives have among few texts does not make every text toxic."""
    w, b = T.fit_one([[0]] * 5, [[0]] * 3 + [[1]] * 27, 2, 0.1)
    score = lambda z: 1 / (1 + np.exp(-z))
    assert score(w[0] + b) > 0.5 > 0.3 > score(w[1] + b)


def test_edges(spark):
    docs, labels = planted(400, seed=2)
    rows = [(i, t, 0.5) for i, t, _ in docs] + [(None, None, 0.5), (None, "blorg", 0.5), (9000, "", 0.5), (9001, " ".join(["kana"] * 50_000) + " snirkle", 0.5), (9002, None, 0.1), (9002, None, 0.1)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, score double")
    noted = spark.createDataFrame(labels + [(None, 1), (labels[0][0], labels[0][1]), (5, None), (77777, 1)], "doc_id bigint, toxic int")
    out = T.scores(table, T.fit(table, noted)).collect()
    assert len(out) == len(rows) and all(r["score"] is not None and r["held_out"] is not None for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (9000, 9002)}) == 1
    assert T.scores(table.limit(0), T.fit(table.limit(0), noted)).collect() == []
    nothing = T.fit(table, noted.filter("toxic = 0"))
    assert {(r["score"], r["predicted"]) for r in T.scores(table, nothing).collect()} == {(0.0, 0)}


def test_sample_is_bounded(spark):
    docs, labels = planted(600, seed=3)
    table = spark.createDataFrame([d[:2] for d in docs], "doc_id bigint, text string")
    model = T.fit(table, spark.createDataFrame(labels, "doc_id bigint, toxic int"), positives=10, unlabelled=50)
    assert len(model.bias) == T.CLASSIFIERS and len(model.wanted) < 60


@pytest.mark.parametrize("repeated", [False, True])
def test_one_row_repeated(spark, repeated):
    """One document that makes up most of the table changes neither the sample nor the verdicts on clean ones."""
    docs, labels = planted(2000, seed=4, share=0.2)
    labels = [(i, int(toxic)) for i, _, toxic in docs]
    again = next(d for d in docs if d[2] == repeated and zlib.crc32(str(d[0]).encode()) % 4 != 2)
    table = spark.createDataFrame([d[:2] for d in docs] + [again[:2]] * 9000, "doc_id bigint, text string")
    out = {r["doc_id"]: r["predicted"] for r in T.scores(table, T.fit(table, spark.createDataFrame(labels, "doc_id bigint, toxic int"))).collect()}
    clean = [out[i] for i, _, toxic in docs if not toxic]
    bad = [out[i] for i, _, toxic in docs if toxic]
    assert sum(clean) <= 0.02 * len(clean) and sum(bad) >= 0.9 * len(bad)


def test_smallest_is_the_same_as_ordering_all(spark):
    ids = spark.range(50_000).withColumnRenamed("id", "doc_id")
    got = [r[0] for r in T.smallest(ids, 300).collect()]
    want = ids.selectExpr("doc_id", "pmod(xxhash64(doc_id), 4611686018427387904) AS h").orderBy("h", "doc_id").limit(300)
    assert got == [r[0] for r in want.collect()]


def test_frequencies_cover_all_rows(spark):
    docs, _ = planted(700, seed=6)
    wanted = {f: i for i, f in enumerate(sorted({f for w in (b"blorg", b"kana", b"nothere") for f in T.word_features(w)}))}
    table = spark.createDataFrame([d[1:2] for d in docs] + [(None,)], "text string").selectExpr("cast(text as binary) text").repartition(5)
    among, rows = T.document_frequencies(table, wanted)
    reader, want = T.Reader(wanted), np.zeros(len(wanted), int)
    for _, text, _ in docs:
        want[reader.features(text.encode())] += 1
    assert among.tolist() == want.tolist() and rows == 701
