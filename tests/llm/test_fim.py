"""Fill-in-middle against a plain rendering, round trips, edges."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tasador.llm import fim as M
from tasador.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
texts = st.text(st.sampled_from(list(" \t\n\x0b\x0c\r\x1c\xa0ab<P>SMé😀")), max_size=60)


def plainly(text, doc_id, seed=42):
    """Unit by unit."""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if text == "" or any(t in text for t in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", text, None, None
    if h[3] % 100 < 80:
        return len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


@settings(max_examples=400, deadline=None)
@given(texts, st.integers(-5, 10**12))
def test_same_as_unit_by_unit(text, doc_id):
    assert M.cut(text, doc_id) == plainly(text, doc_id)


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(1, 9))
def test_long_texts_in_pieces(text, piece):
    assert M.unit_ends(text, piece).tolist() == [m.end() for m in UNIT.finditer(text)]


def test_every_row_is_restored(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(["", " ", "one", " a  b\n", "x <P> y", "half <P", "< S> <", "S> <M", "é😀 " * 50, "w" * 100_000, "a b " * 100_000] * 12)]
    rows += [(None, "no id here", "x", 1), (None, None, "x", 1), (7, None, "x", 1), (8, "same row", "x", 1), (8, "same row", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, form string, n int")
    done = M.transform(docs, plain=70).withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    assert len(done) == len(rows) and {r["form"] for r in done} == {"plain", "psm", "spm"}
    texts_of = sorted((r[0] is None, r[0] or 0, r[1] or "") for r in rows)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["back"]) for r in done) == texts_of
    assert all((r["prefix_chars"] is None) == (r["form"] == "plain") == (r["middle_chars"] is None) for r in done)
    assert all(r["n"] == len(UNIT.findall(r["back"])) for r in done)
    assert len({tuple(r) for r in done if r["doc_id"] == 8 and r["back"] == "same row"}) == 1
    assert M.transform(docs.limit(0)).collect() == []
    assert {r["form"] for r in M.transform(docs, plain=0).collect()} == {"plain"}


def test_given_documents(spark):
    assert "op13_fill_in_middle" in ORACLE
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in QUERIES["op13_fill_in_middle"](spark, SF).collect():
        n, form, output, prefix, middle = plainly(docs[r["doc_id"]] or "", r["doc_id"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, prefix, middle)
        assert r["output_sha256"] == digest(output) and r["restored_sha256"] == digest(docs[r["doc_id"]] or "")
