"""Vector codes against plain loops over Python integers."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from tasador.llm import vectorcodes as M
from tasador.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plainly(rows, entries=256, rounds=4, parts=4):
    """(rows of (id, code, error, label error), books) of (id, vector, label), one distance at a time."""
    kept = [(i, [math.floor(1024 * x) for x in v], l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: r[0])[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for _, v, _ in kept:
                own[best(cut(v, p), books[p])[1]].append(cut(v, p))
            for k, found in own.items():
                books[p][k] = [sum(x) // len(found) for x in zip(*found)]
    out, by_label = [], defaultdict(int)
    for i, v, l in kept:
        found = [best(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), l))
        by_label[l] += out[-1][2]
    return [(i, c, e, by_label[l]) for i, c, e, l in out], books


def draw(n, dims, seed, spread=0.2):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(dims)], rng.choice([None, 0, 1, 1, 1])) for i in rng.sample(range(10 * n), n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(5)


@pytest.mark.parametrize("spread", [0.004, 0.2, 3000.0])
def test_nearest_same_as_direct(spread):
    rng = np.random.default_rng(1)
    values = np.floor(rng.normal(0, spread, (700, 6)) * 1024).astype(np.int64)
    entries = np.floor(rng.normal(0, spread, (40, 6)) * 1024).astype(np.int64)
    entries[7] = entries[3]  # a tie
    direct = np.square(values[:, None] - entries[None]).sum(axis=2)
    index, distance = M.nearest(values, entries)
    assert (index == direct.argmin(axis=1)).all() and (distance == direct.min(axis=1)).all()


def test_largest_components_do_not_overflow():
    far = M.limit(16)
    index, distance = M.nearest(np.full((2, 16), far), np.full((1, 16), -far))
    assert index.tolist() == [0, 0] and distance.tolist() == [16 * (2 * far) ** 2] * 2


def test_same_as_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(M, "ENTRIES", 9)
    rows = draw(120, 8, 3)
    kept = M.integer_vectors(frame(spark, rows))
    books = M.fit(kept, entries=9)
    want, want_books = plainly(rows, entries=9)
    assert books.tolist() == want_books
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in M.encode(kept, books).collect()) == sorted(w[:3] for w in want)
    decoded = {r["vec_id"]: r["v"] for r in M.decode(M.encode(kept, books), books).collect()}
    assert all(decoded[i] == sum((want_books[p][int(c[2 * p : 2 * p + 2], 16)] for p in range(4)), []) for i, c, _, _ in want)


def test_given_vectors(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, books = plainly(rows)
    text = ",".join(str(x) for part in books for entry in part for x in entry)
    got = QUERIES["op12_vector_codes"](spark, SF).collect()
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got) == sorted(want)
    assert {r["codebooks_sha256"] for r in got} == {hashlib.sha256(text.encode()).hexdigest()}


def test_edges(spark):
    good = draw(40, 8, 5)
    bad = [(9001, None, 1), (9002, [None] * 8, 1), (9003, [0.1] * 7 + [float("nan")], 1), (9004, [0.1] * 7 + [float("-inf")], 1), (9005, [], 1), (9006, [0.1] * 7, 1), (9007, [0.1] * 12, 1)]
    clashing = frame(spark, good + bad).selectExpr("vec_id", "embedding", "label", "1 as v", "2 as part", "3 as code", "4 as known")
    coded, books = M.compressed(clashing)
    want, want_books = plainly(good)
    assert books.tolist() == want_books
    assert sorted(map(tuple, coded.collect())) == sorted(want)
    # Rows without an id come last in the codebooks; repeated rows stay and count.
    repeated = [*good, good[0], good[0], (None, [0.5] * 8, None), (None, [0.5] * 8, None)]
    coded, books = M.compressed(frame(spark, repeated))
    out = coded.collect()
    assert len(out) == len(repeated) and books.shape == (4, 41, 2)
    assert len({(r["code"], r["error"]) for r in out if r["vec_id"] is None}) == 1
    far, _ = M.compressed(frame(spark, [(1, [1e300] * 8, 1), (2, [-1e300] * 8, 1)]))
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in far.collect()) == [(1, "00000000", 0), (2, "01010101", 0)]
    for nothing in (frame(spark, bad[:5]), frame(spark, good).limit(0)):
        coded, books = M.compressed(nothing)
        assert coded.collect() == [] and books.size == 0 and M.books_digest(books) == hashlib.sha256(b"").hexdigest()
