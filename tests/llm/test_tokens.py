"""Token counts and token files against the libraries on whole texts."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tasador.llm import tokencount, tokenfile
from tasador.llm.queries import QUERIES
from tasador.llm.tokenizer import Encoder, load, splits_at_spaces, vocabulary_path

SF = "/root/testdata/sf0.001"
BYTES, WORDS, PIECES = map(vocabulary_path, ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ODD = [
    "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "don't stop we'll 1234567 go!!", "x y z", "é à ü ß ñ", "́ ́a", "日本語 テキスト 漢字", "👩‍👩‍👧 family 🎉",
    "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b <|startoftext|>", "tab\tand\x1cseparator \x1d x", "\r\n\r\n x", "   wide  x", "▁ sign ▁a b▁", "Ġ sign Ġa", "ſ K Å", "\x00 \x00a",
]


def plain(path, text):
    model = load(path)
    return model.encode(text) if path.endswith(".model") else model.encode(text, add_special_tokens=False).ids


def noise(draw, n):
    parts = ["the", "and", "Straße", "naïve", "don't", " ", "  ", "\n", "\n\n", "\t", "1234", "!!!", "日本", "🎉", "<|endoftext|>", "x" * 40, "́", "é", " ", "."]
    return "".join(draw.choice(parts) + draw.choice(["", " ", " "]) for _ in range(n))


def test_encoder_of_words_gives_the_library_ids():
    draw = random.Random(1)
    texts = ODD + [noise(draw, draw.randrange(300)) for _ in range(150)]
    for path in (BYTES, WORDS, PIECES):
        encoder = Encoder(path)
        for _ in range(2):  # new and known words
            for text, raw in zip(texts, encoder.encode(texts)):
                assert np.frombuffer(raw, encoder.kind).tolist() == plain(path, text), repr(text)
    assert Encoder(BYTES).by_word and not Encoder(PIECES).by_word


@pytest.mark.parametrize("path", [BYTES, WORDS, PIECES])
def test_spliced_counts(path):
    assert splits_at_spaces(path)
    draw = random.Random(2)
    texts = [noise(draw, draw.randrange(1, 900)) for _ in range(60)] + ["x" * 3000, "x " * 1500, " " * 2000 + "a b", "ab  " * 700, "word " * 300 + "y" * 2000 + " word" * 300]
    for text in ODD + texts:
        want = len(plain(path, text))
        for chunk, overlap in ((200, 16), (97, 3), (1000, 400)):
            assert tokencount.count_long(path, text, chunk, overlap) == want, (repr(text[:60]), chunk)


def test_chunks_are_really_spliced(monkeypatch):
    seen = []
    spans = tokencount.spans
    monkeypatch.setattr(tokencount, "spans", lambda path, text: seen.append(len(text)) or spans(path, text))
    tokencount.count_long(BYTES, "some plain words here " * 1000, 1000, 64)
    assert len(seen) > 20 and max(seen) <= 1000


def unspaced(kind, n, seed=5):
    draw = random.Random(seed)
    if kind == "base64":
        return "".join(draw.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=n))
    if kind == "code":
        return "".join(draw.choices(["function", "(", "a1", ")", "{", "x.y", "='", "s'", ";", "}", "<|endoftext|>", "don't", "''ll"], k=n // 3))[:n]
    if kind == "cjk":
        return "".join("".join(draw.choices("日本語漢字中文的是不了人", k=draw.randrange(3, 30))) + draw.choice("，。！") for _ in range(n // 16))[:n]
    return "".join(draw.choices("abcdefgh", k=n))


@pytest.mark.parametrize("kind", ["base64", "code", "cjk", "letters"])
def test_texts_without_spaces(kind):
    for path in (BYTES, WORDS, PIECES):
        for n in (60, 777, 5000):
            text = unspaced(kind, n, n)
            want = len(plain(path, text))
            for chunk, overlap in ((200, 16), (97, 3), (1000, 400)):
                assert tokencount.count_long(path, text, chunk, overlap) == want, (path, n, chunk)


@pytest.mark.parametrize("kind", ["base64", "code", "cjk", "letters"])
def test_work_in_proportion_without_spaces(monkeypatch, kind):
    text, seen = unspaced(kind, 1_000_000), []
    want = tokencount.counts(BYTES, [text])[0]
    spans = tokencount.spans
    monkeypatch.setattr(tokencount, "spans", lambda path, part: seen.append(len(part)) or spans(path, part))
    assert tokencount.count_long(BYTES, text) == want
    assert sum(seen) < (4 if kind == "letters" else 1.2) * len(text)
    if kind != "letters":
        assert max(seen) <= tokencount.CHUNK


def test_token_counts(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, None, "y"), (3, "again", "y"), (3, "again", "y"), (90, noise(random.Random(3), 30_000), "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    got = sorted(map(tuple, tokencount.token_counts(docs, BYTES).collect()), key=str)
    want = [(d, len((t or "").encode()), n := len(plain(BYTES, t or "")), n > 512) for d, t, _ in rows]
    assert got == sorted(want, key=str)
    assert tokencount.token_counts(docs.limit(0), BYTES).collect() == []


def test_given_documents_are_counted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op8_token_counts"](spark, SF).collect()}
    assert got == {r["doc_id"]: len(plain(BYTES, r["text"] or "")) for r in docs}


def expected(rows, path=BYTES):
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*plain(path, text or ""), 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_given_documents_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted(map(tuple, QUERIES["op6_token_files"](spark, SF).collect()))
    assert got == expected(map(tuple, docs))


def test_nulls_repeats_and_extra_columns(spark):
    rows = [(i, t, 1) for i, t in enumerate(ODD)] + [(90, None, 1), (91, "same", 2), (91, "same", 2), (92, noise(random.Random(4), 20_000), 1), (None, "no id", 3), (None, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start int").repartition(5)
    got = sorted(map(tuple, tokenfile.written_and_read(docs, BYTES, length=64).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, *sorted(r[0] for r in rows if r[0] is not None)]
    nulls = {r[2:] for r in expected([(None, "no id"), (None, None)])}
    assert {r[2:] for r in got[:2]} == nulls
    shift = sum(r[2] for r in got[:2])
    assert [(d, s - shift, n, c) for d, s, n, c in got[2:]] == expected(sorted((r[:2] for r in rows if r[0] is not None), key=lambda r: r[0]))
    assert tokenfile.written_and_read(docs.limit(0), BYTES).collect() == []


@pytest.mark.parametrize("path, kind", [(BYTES, pa.uint16()), (PIECES, pa.uint16())])
def test_sequences_and_masks(spark, tmp_path, path, kind):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    parts = tokenfile.write(docs, path, str(tmp_path / "out"), length=100).orderBy("part").collect()
    stream, ends = [], []
    for part in parts:
        file = tokenfile.Sequences(part["ids"])
        assert file.file.schema.field("input_ids").type == pa.list_(pa.field("item", kind, False), 100)
        assert len(file) == -(-part["n_tokens"] // 100) and part["first"] == len(stream)
        order = list(range(len(file)))
        random.Random(1).shuffle(order)
        rows = {i: file.sequence(i) for i in order}
        mask = np.concatenate([rows[i]["mask"] for i in range(len(file))])
        assert mask[: part["n_tokens"]].all() and not mask[part["n_tokens"] :].any()
        assert not rows[0]["input_ids"].flags.owndata
        stream += np.concatenate([rows[i]["input_ids"] for i in range(len(file))])[mask].tolist()
        ends += np.concatenate([rows[i]["ends"] for i in range(len(file))])[mask].tolist()
    want = [[*plain(path, r["text"] or ""), 2] for r in docs.orderBy("doc_id").collect()]
    assert stream == [i for ids in want for i in ids]
    assert ends == [k == len(ids) - 1 for ids in want for k in range(len(ids))]
