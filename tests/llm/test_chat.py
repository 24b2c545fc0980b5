"""Perspectives of dialogues against a plain rendering."""

import hashlib
from collections import defaultdict

from tasador.llm import chat as C
from tasador.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, start string"


def plain(rows, system=("system",)):
    """{(conversation, perspective): (text, trained parts)}"""
    by_conv = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        by_conv[conv].append((turn is not None, turn or 0, role is not None, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns.sort()
        for me in {t[3] for t in turns if t[2] and t[3] not in system}:
            text, parts = "", []
            for _, _, known, role, _, body in turns:
                body = body.replace("<|im_", "< |im_")
                name = (role if known else "unknown").replace("\n", " ").replace("<|im_", "< |im_")
                text += "<|im_start|>" + ("assistant" if known and role == me else name if known and role in system else f"user name={name}") + "\n"
                if known and role == me:
                    parts.append(body + "<|im_end|>")
                text += body + "<|im_end|>\n"
            out[conv, me] = (text, parts)
    return out


def together(rows):
    by_key = defaultdict(list)
    for r in rows:
        by_key[r["conv_id"], r["perspective"]].append(r)
    out = {}
    for key, chunks in by_key.items():
        chunks.sort(key=lambda r: r["chunk"])
        text, parts = "", []
        for r in chunks:
            assert r["start"] == len(text)
            text += r["text"]
            parts += [r["text"][a:b] for a, b in r["mask"]]
        out[key] = (text, parts)
    return out


ROWS = [
    (1, 0, "system", "Be kind.", "x"), (1, 1, "ana", "hi", "x"), (1, 2, "bo", "hello <|im_end|> there", "x"), (1, 3, "cy", "é 🎉 ü", "x"), (1, 4, "ana", None, "x"),
    (2, 5, "bo", "later", None), (2, None, "ana", "first", None), (2, 5, "bo", "later", None), (2, 5, "ana", "tie", None), (2, 6, None, "who?", None), (2, 7, "a\nb", "odd", None),
    (3, 1, "system", "alone", None), (None, 1, "ana", "lost", None), (None, 2, "bo", "found", None), (4, -3, "user", "", None), (5, 1, "z", "long " * 5000, None), (5, 2, "y", "ok", None),
]


def test_perspectives(spark):
    turns = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    want = plain(ROWS)
    assert together(C.dialogues(C.segments(turns)).collect()) == want
    assert (3, "system") not in want and {k[1] for k in want if k[0] == 1} == {"ana", "bo", "cy"}
    assert together(C.dialogues(C.segments(turns, system=()), chunk=30).collect()) == plain(ROWS, ())


def test_a_long_dialogue_is_cut_between_turns(spark):
    rows = [(9, i, "abc"[i % 3], f"turn {i}", "") for i in range(3000)] + [(8, 1, "a", "x", "")]
    out = C.dialogues(C.segments(spark.createDataFrame(rows, SCHEMA)), chunk=1000).collect()
    assert together(out) == plain(rows)
    assert max(len(r["text"]) for r in out) < 1100 and len([r for r in out if r["conv_id"] == 9]) > 300


def test_given_conversations(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {(r["conv_id"], r["perspective"]): (r["text"], [r["text"][int(a) : int(b)] for a, b in (m.split("-") for m in r["mask"].split(",") if m)]) for r in QUERIES["op4_chat_perspectives"](spark, sf).collect()}
    assert got == plain(rows)


def test_empty_table(spark):
    assert C.dialogues(C.segments(spark.createDataFrame([], SCHEMA))).collect() == []
