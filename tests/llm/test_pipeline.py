"""The pipeline, stage by stage, against the brute-force versions of its operators."""

from collections import Counter

import pytest
from test_decontam import plain as plain_leaks
from test_mixing import draw
from test_quality import expected as plain_quality
from test_simhash import plain_fingerprint, plain_groups
from test_tokens import expected as plain_tokens

import corpus_pipeline as P
from tasador.llm import mixing

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_pipeline(docs, trusted, items):
    """The documents after every stage."""
    kept = {r[0] for r in plain_quality([d[:2] for d in docs], trusted) if r[7]}
    out = [[d for d in docs if d[0] in kept]]
    prints = [(d[0], plain_fingerprint(d[1])) for d in out[-1]]
    out.append([d for d, g in zip(out[-1], plain_groups(prints)) if d[0] == g])
    bad = {r[0] for r in plain_leaks([d[:2] for d in out[-1]], items)}
    out.append([d for d in out[-1] if d[0] not in bad])
    sizes = Counter(d[3] for d in out[-1])
    total = sum(n**mixing.ALPHA for n in sizes.values())
    rates = {s: n**mixing.ALPHA / total * len(out[-1]) / n for s, n in sizes.items()}
    out.append([d for d in out[-1] for _ in range(draw(rates[d[3]], d[0], d[1]))])
    out.append(plain_tokens(sorted(d[:2] for d in out[-1])))
    return out


@pytest.fixture(scope="module")
def given(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS).collect()]
    trusted = {r[0] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    return docs, plain_pipeline(docs, trusted, items)


def test_every_stage(spark, given):
    docs, want = given
    at = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for (name, stage), rows in zip(P.STAGES, want):
        at = P.stored(stage(spark, at, SF), "test")
        assert sorted(map(tuple, at.collect())) == sorted(rows), name
        if name != "token_files":
            assert at.columns == COLUMNS
    assert len(docs) > len(want[0]) > len(want[1]) >= len(want[2])


def test_run(spark, given):
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(given[1][-1])


def test_stages_keep_rows_without_id_and_other_columns(spark):
    """Null values, repeated rows and columns named like the stages' own do not stop any stage."""
    text, other = " ".join(f"w{i}" for i in range(70)), " ".join(f"u{i}" for i in range(90))
    rows = [(1, text, None, "a", None, True, "x"), (1, text, None, "a", None, True, "x"), (None, other, None, None, 5, None, None), (None, other, None, None, 5, None, None),
            (2, None, "en", "b", 0, False, ""), (3, "", "en", "b", 0, False, ""), (4, " ".join(f"v{i}" for i in range(3000)), "en", "b", 1, True, "y"), (None, "", None, None, None, None, None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, copy string"
    docs = spark.createDataFrame(rows, schema)
    for name, stage in P.STAGES:
        for df in (docs, docs.limit(0)):
            out = stage(spark, df, SF)
            got = out.collect()
            if name != "token_files":
                assert out.columns == docs.columns and set(map(tuple, got)) <= set(rows)
    one = P.simhash_near_duplicates(spark, docs, SF).collect()
    # The texts without a word are one group; copies are another; the row without id has no link to it.
    assert sorted(map(tuple, one), key=str) == sorted([rows[0], rows[2], rows[4], rows[6]], key=str)


def test_the_smallest_id_stays_even_if_it_is_in_two_groups(spark):
    a, b = " ".join(f"w{i}" for i in range(70)), " ".join(f"v{i}" for i in range(70))
    docs = spark.createDataFrame([(3, a), (5, a), (5, b), (9, b)], "doc_id bigint, text string")
    assert sorted(map(tuple, P.simhash_near_duplicates(spark, docs, SF).collect())) == [(3, a), (5, b)]
