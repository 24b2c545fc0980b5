"""Fill-in-middle: texts cut into prefix, middle and suffix at unit edges and put in another order."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.llm.common import map_arrow

SEED = 42
PLAIN_PERCENT = 50
SPM_PERCENT = 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_SPACE = r"\x20\x09-\x0D"
# Possessive: what a unit has taken is never given back, so there is one way to match and nothing to remember for another.
_UNITS = regex.compile(rf"([{_SPACE}]*+[^{_SPACE}]++|[{_SPACE}]++)*")
_EDGE = regex.compile(rf"[^{_SPACE}](?=[{_SPACE}])")
PIECE = 1 << 22
"""Characters matched at once: the captures take up to 250 bytes a unit."""


def unit_ends(text: str, piece: int = PIECE) -> np.ndarray:
    """Where the units of a text end: white space with the word after it, or white space alone.

    One full match of repeated units keeps the end of every repetition.  Texts of
    over `piece` characters are cut where a word meets white space, which is where
    a unit ends in any case, so that memory stays bounded.
    """
    found, first = [], 0
    while len(text) - first > piece:
        edge = _EDGE.search(text, first + piece - 1)
        if edge is None:
            break
        found.append(np.array(_UNITS.fullmatch(text, first, edge.end()).ends(1), np.int64))
        first = edge.end()
    found.append(np.array(_UNITS.fullmatch(text, first).ends(1), np.int64))
    return np.concatenate(found)


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers that depend on the seed and the id only."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def cut(text: str, doc_id: int | None, seed: int = SEED, plain: int = PLAIN_PERCENT, spm: int = SPM_PERCENT) -> tuple:
    """(n, form, output, prefix length, middle length) of one text; no lengths for a plain one."""
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= plain:
        return n, "plain", text, None, None
    first, last = (0 if k == 0 else int(ends[k - 1]) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    if h4 % 100 < spm:
        return n, "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", first, last - first
    return n, "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", first, last - first


def transform(docs: DataFrame, seed: int = SEED, plain: int = PLAIN_PERCENT, spm: int = SPM_PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, form, output, prefix_chars, middle_chars), one row per row of `docs`.

    `n`: units of the whole text.  `form`: `plain` (the text as it is), `psm` or
    `spm` (prefix, suffix, middle after their marks; the suffix first in the
    second).  Empty texts and texts that hold a mark themselves stay plain, of the
    others those whose third draw modulo 100 is `plain` or more.  A null text
    counts as empty; a null id draws like the empty id; equal ids draw alike;
    repeated rows stay.  Lengths are in code points, null where the form is plain.
    Other columns are not read.
    """

    def rows(batch: pa.RecordBatch) -> dict:
        done = [cut(t, i, seed, plain, spm) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        names = ("n", "form", "output", "prefix_chars", "middle_chars")
        return {"doc_id": batch.column(0), **{name: [d[k] for d in done] for k, name in enumerate(names)}}

    read = docs.select(F.col(doc_id).cast("bigint"), F.coalesce(F.col(text).cast("string"), F.lit("")))
    return map_arrow(read, rows, "doc_id bigint, n bigint, form string, output string, prefix_chars bigint, middle_chars bigint")


def restored(output: Column, form: Column) -> Column:
    """The text again, from output and form alone.

    A cut text holds no mark of its own, and no piece can make one up with the
    mark beside it, so the three marks part it.
    """
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first)).otherwise(output)
