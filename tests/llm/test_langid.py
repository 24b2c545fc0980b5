"""Languages of held-out documents, spans of mixed texts, the path search against brute force."""

import itertools
import random

import numpy as np
import pytest

from tasador.llm import langid as L
from tasador.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return L.fit(docs)


def test_held_out_documents(spark, docs):
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = QUERIES["op1_language_id"](spark, SF).collect()
    assert len(rows) == len(truth) and {r["lang_pred"] for r in rows} <= {*truth.values(), L.UNKNOWN}
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held) > 100
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_spans_of_mixed_texts(spark, docs, model):
    draw = random.Random(1)
    by_lang = {}
    for r in docs.filter("lang is not null and length(text) between 600 and 4000").orderBy("doc_id").collect():
        by_lang.setdefault(r["lang"], []).append(r["text"])
    mixed, truth = [], []
    for i in range(40):
        langs = draw.sample(sorted(by_lang), 3)
        parts = [" ".join(draw.choice(by_lang[x]).split()[:60]) + " " for x in langs]
        mixed.append((i, "".join(parts)))
        truth.append([x for x, p in zip(langs, parts) for _ in p])
    right = total = 0
    rows = L.spans(spark.createDataFrame(mixed, "doc_id bigint, text string"), model).collect()
    for i, text in mixed:
        own = sorted((r["start"], r["end"], r["lang"]) for r in rows if r["doc_id"] == i)
        assert own[0][0] == 0 and own[-1][1] == len(text) and all(a[1] == b[0] and a[2] != b[2] for a, b in zip(own, own[1:]))
        right += sum(sum(t == lang for t in truth[i][a:b]) for a, b, lang in own)
        total += len(text)
    assert right > 0.95 * total


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    for _ in range(60):
        sizes = rng.integers(0, 6, 4)
        scores = rng.normal(0, 2, (sizes.sum(), 3))
        switch = float(rng.choice([0, 1, 3]))
        path, at = L.viterbi(scores, sizes, switch), 0

        def value(p, own):
            return sum(own[i, x] for i, x in enumerate(p)) - switch * sum(a != b for a, b in zip(p, p[1:]))

        for size in sizes:
            own = scores[at : at + size]
            best = max(value(p, own) for p in itertools.product(range(3), repeat=int(size)))
            assert value(path[at : at + size].tolist(), own) == pytest.approx(best)
            at += size


def test_scripts_narrow_the_candidates(spark):
    rows = [(i, "the cat sat on the mat", "en") for i in range(8)] + [(10 + i, "кот сидит на коврике дома", "ru") for i in range(8)] + [(20 + i, "kot siedzi na macie w domu", "pl") for i in range(8)]
    model = L.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), least=1)
    labeller = L.Labeller(model)
    assert labeller.languages(["жук", "the жук the the", "日本", "½ ² 12 _", None, "", "Ⅷ"]) == [
        ("ru", 1.0), ("en", 9 / 12), labeller.languages(["日本"])[0], (L.UNKNOWN, 0.0), (L.UNKNOWN, 0.0), (L.UNKNOWN, 0.0), (L.UNKNOWN, 0.0),
    ]
    assert model.allowed[L.NAMES.index("Cyrillic")].tolist() == [x == "ru" for x in model.languages]
    assert [x[2] for x in labeller.spans("the cat sat, кот сидит на коврике")] == ["en", "ru"]


def test_edges(spark, model):
    rows = [(None, None, "xx", 1), (None, "the of and", "xx", 1), (1, "", None, 1), (2, " 12 \n", "xx", 1), (3, "the of " * 40_000, "xx", 1), (4, "la de las", "xx", 1), (4, "la de las", "xx", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int")
    got = L.predict(docs, model).collect()
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in got) == [(0, "en"), (0, "und"), (1, "und"), (2, "und"), (3, "en"), (4, "es"), (4, "es")]
    assert L.predict(docs.limit(0), model).collect() == [] and L.spans(docs.limit(0), model).collect() == []
    nothing = L.fit(docs.withColumn("lang", docs["lang"].substr(9, 0)).filter("lang is null"))
    assert {r["lang_pred"] for r in L.predict(docs, nothing).collect()} == {"und"} and nothing.languages == []


def test_only_training_rows_count(docs, model):
    again = L.fit(docs.filter("crc32(cast(doc_id as string)) % 4 != 2"))
    assert again.languages == model.languages and np.array_equal(again.grams, model.grams)


def test_many_values_of_lang(spark):
    """Values that next to no document has are no languages; a value that most have is sampled as ever."""
    rows = [(i, "the cat sat on the mat", "en") for i in range(5000)] + [(9000 + i, "el gato come pescado", "es") for i in range(30)]
    rows += [(20_000 + i, "x y z", f"junk{i % 2000}") for i in range(4000)] + [(1, "the cat sat on the mat", "en")] * 3000
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(16)
    model = L.fit(docs, sample=20)
    assert model.languages == ["en", "es"]
    ids = L._sample_ids(docs.filter("crc32(cast(doc_id as string)) % 4 != 2"), 20, 5).collect()
    by_language = {lang: {r["_id"] for r in ids if r["_lang"] == lang} for lang in ("en", "es")}
    assert [len(v) for v in by_language.values()] == [20, 20]
    plain = spark.sql("select doc_id, pmod(xxhash64(doc_id), 4503599627370496) h from {d} where lang = 'en' and crc32(cast(doc_id as string)) % 4 != 2", d=docs).distinct()
    assert by_language["en"] == {r["doc_id"] for r in plain.orderBy("h", "doc_id").limit(20).collect()}
    assert len(L.fit(docs, sample=20, least=1).languages) > 1000
