"""SimHash against brute force."""

import re

import pytest
import xxhash

from tasador.llm import simhash
from tasador.llm.components import components
from tasador.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance=2):
    """Smallest id per group of (id, fingerprint) rows, by comparing all pairs."""
    group = list(range(len(prints)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= distance:
                group[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [least.get(root(i)) for i in range(len(prints))]


def check(spark, rows, extra=""):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string" + extra)
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    want = sorted([(d, f"{p:016x}", g) for (d, p), g in zip(prints, plain_groups(prints))], key=str)
    assert got == want


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r[0], plain_fingerprint(r[1])) for r in docs]
    want = {d: (f"{p:016x}", g) for (d, p), g in zip(prints, plain_groups(prints))}
    got = {r[0]: (r[1], r[2]) for r in QUERIES["op10_simhash_near_dedup"](spark, SF).collect()}
    assert got == want and len(set(g for _, g in want.values())) < len(want)


def test_nulls_repeats_long_and_clashing_columns(spark):
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(5, None, 1), (3, "", 1), (9, " \t\n", 1), (None, "a b c d", 1), (4, "A b C d", 1), (4, "A b C d", 2), (7, long, 1), (2, long + " w1", 1),
            (None, "lonely words here", 1), (8, "one two", 1), (6, " nbsp is no\u0085white space", 1)]
    check(spark, rows, ", fp int")


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


@pytest.mark.parametrize("crowd", [1, 4, 10_000])
def test_links_of_a_crowded_block(spark, crowd):
    """Chains and clouds of close fingerprints give the same groups whatever a crowded block is."""
    import random

    draw = random.Random(7)
    prints = {0}
    for centre in (0, draw.getrandbits(64), (1 << 64) - 1):
        p = centre
        for _ in range(40):
            p ^= 1 << draw.randrange(64)
            prints.add(p ^ (1 << draw.randrange(64) if draw.random() < 0.5 else 0))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint"), 2, crowd=crowd).collect()
    for a, b in found:
        assert ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2
    roots = {r[0]: r[1] for r in components(spark.createDataFrame(found, "a bigint, b bigint")).collect()}
    got = [roots.get(p, p) for p in signed]
    want = plain_groups(list(zip(signed, prints)))
    assert got == want


def test_one_bit(spark):
    prints = [0, 1, 2, 3, 7 << 60, 3 << 60]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    for crowd in (1, 100):
        got = {tuple(sorted(r)) for r in simhash.links(df, 1, crowd=crowd).collect()}
        assert got == {(0, 1), (0, 2), (1, 3), (2, 3), tuple(sorted((signed[4], signed[5])))}


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100), (200, None), (301, 300), (300, 301)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 200, 300: 300, 301: 300}
