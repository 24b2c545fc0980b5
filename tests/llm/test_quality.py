"""Quality rules against brute force."""

import math
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tasador.llm import quality as Q
from tasador.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def chained(hashes):
    """Spark's xxhash64 of several longs: each is hashed with the hash so far as seed."""
    seed = 42
    for h in hashes:
        seed = xxhash.xxh64_intdigest((h & ((1 << 64) - 1)).to_bytes(8, "little"), seed)
    return signed(seed)


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    hashes = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words]
    grams = [h % Q.BUCKETS for h in hashes] + [chained(hashes[i : i + 2]) % Q.BUCKETS for i in range(len(words) - 1)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(Q.SYMBOLS, text or "")), len(lines) - len(set(lines)), len(covered), failed), grams


def expected(rows, trusted):
    """doc_id, measures, score and verdict of every row."""
    found = [(d, *plain(t)) for d, t in rows]
    raw, target = Counter(), Counter()
    for d, _, grams in found:
        raw.update(grams)
        if d is not None and d in trusted:
            target.update(grams)
    share = target.total() / max(1, raw.total())
    out = []
    for d, m, grams in found:
        score = sum(math.log((target[b] + Q.PRIOR) / (raw[b] * share + Q.PRIOR)) for b in grams) / len(grams) if grams and share else 0.0
        out.append((d, *m[:5], m[5], not m[5] and score >= Q.THRESHOLD, score))
    return out


def same(got, want):
    key = lambda r: str(r[:6])
    got = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"], r["kept"], r["score"]) for r in got), key=key)
    want = sorted(want, key=key)
    assert [r[:8] for r in got] == [r[:8] for r in want]
    assert [r[8] for r in got] == pytest.approx([r[8] for r in want], abs=1e-9)


def test_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    trusted = {r[0] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").select("doc_id").collect()}
    want = expected(docs, trusted)
    same(QUERIES["op3_quality_rules"](spark, SF).collect(), want)
    assert {r[7] for r in want} == {True, False}


LONG = " ".join(f"w{i % 5003}" for i in range(12_000))
ROWS = [
    (1, None), (2, ""), (3, " \t\r\n\x0b\x0c "), (4, "a b a b a b a"), (5, "x\n\nx\n x\nx"), (None, "one two three"), (6, LONG), (6, LONG),
    (7, "## a|b <c> 100% &$*\r\na b   z\n## a|b <c> 100% &$*\r"), (8, " ".join(["spam"] * 60)), (9, " ".join(f"t{i}" for i in range(60))),
]


def test_nulls_repeats_and_long_texts(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    trusted = spark.createDataFrame([(6,), (6,), (None,), (77,)], "doc_id bigint")
    same(Q.verdicts(docs, Q.fit_weights(docs, trusted)).collect(), expected(ROWS, {6}))


def test_without_trusted_texts_only_the_base_rules_count(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    same(Q.verdicts(docs, Q.fit_weights(docs, docs.select("doc_id").limit(0))).collect(), expected(ROWS, set()))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert Q.verdicts(docs, Q.fit_weights(docs, docs.select("doc_id"))).collect() == []


def test_filter_keeps_every_column(spark):
    text = " ".join(f"t{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text, "x", 3.5, None), (2, "short", "y", 1.0, "r"), (1, text, "x", 3.5, None)], "doc_id bigint, text string, kept string, score double, row string")
    got = Q.keep_good(docs, docs.select("doc_id").limit(0))
    assert got.columns == docs.columns
    assert [tuple(r) for r in got.collect()] == [(1, text, "x", 3.5, None)] * 2


def test_documents_without_an_id_are_never_trusted(spark):
    docs = spark.createDataFrame([(1, "good words here")] + [(None, "bad words there")] * 50, "doc_id bigint, text string")
    own = spark.createDataFrame([(1,), (None,)], "doc_id bigint")
    got = {r["bucket"]: r["weight"] for r in Q.fit_weights(docs, own).collect()}
    want = {r["bucket"]: r["weight"] for r in Q.fit_weights(docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(2))), own).collect()}
    assert got == want and min(got.values()) < 0 < max(got.values())


def test_every_trusted_text_counts(spark):
    """More trusted texts than any fixed number that was kept before: if all are trusted, no n-gram tells anything."""
    docs = spark.range(200_500).selectExpr("id AS doc_id", "concat('w', id % 97) AS text")
    weights = Q.fit_weights(docs, docs.select("doc_id")).collect()
    assert len(weights) == 97 and {w["weight"] for w in weights} == {0.0}


def test_the_filter_changes_no_count(spark):
    """A filter of one word lets nearly every id pass, the usual one few but the trusted."""
    docs = spark.range(3_000).selectExpr("if(id % 7 = 0, null, id) AS doc_id", "concat('w', id % 97, ' v', id % 13) AS text")
    own = docs.select("doc_id").filter("doc_id % 3 = 0").union(spark.createDataFrame([(-5,), (None,)], "doc_id bigint"))
    found = [sorted(map(tuple, Q.fit_weights(docs, own, filter_words=size).collect())) for size in (1, 16, Q.FILTER_WORDS)]
    assert found[0] == found[1] == found[2] and len({w for _, w in found[0]}) > 10


def test_untrusted_documents_are_not_shuffled(spark):
    """The filter passes every trusted id, and of 80,000 others at most one in fifty."""
    ids = spark.range(0, 100_000, 5).toDF("trusted_id")
    passed = spark.range(100_000).filter(Q._possible(ids)(F.col("id"))).agg(F.count_if(F.expr("id % 5 = 0")).alias("own"), F.count_if(F.expr("id % 5 <> 0")).alias("others")).first()
    assert passed["own"] == 20_000 and passed["others"] < 1_600
