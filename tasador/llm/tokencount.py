"""Token counts of whole texts; huge ones by overlapping chunks that are spliced where both agree."""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.llm.common import map_arrow
from tasador.llm.tokenizer import counts, edges, encoder, load

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
CHUNK = 16_384
OVERLAP = 256


def spans(path: str, text: str) -> list[tuple[int, int]]:
    """First and last place of each token of a text, in characters."""
    model = load(path)
    if path.endswith(".model"):
        # This library counts in bytes.
        opens = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
        at = np.concatenate([[0], np.cumsum(opens)])
        pieces = model.encode(text, return_type="proto").pieces
        return list(zip(at[[p.begin for p in pieces]].tolist(), at[[p.end for p in pieces]].tolist()))
    return model.encode(text, add_special_tokens=False).offsets


class Chunk:
    """The tokens of text[first:last], by their places in the whole text."""

    def __init__(self, path: str, text: str, first: int, last: int) -> None:
        found = spans(path, text[first:last])
        self.first, self.last = first, last
        self.starts = [first + a for a, _ in found]
        self.ends = [first + b for _, b in found]

    def cut(self, at: int) -> int | None:
        """How many tokens lie before `at`; None if one lies across it."""
        before = bisect.bisect_left(self.starts, at)
        return before if before == 0 or max(self.ends[max(0, before - 8) : before]) <= at else None

    def near(self, at: int, width: int = 4) -> list[tuple[int, int]]:
        """The tokens around a cut."""
        k = bisect.bisect_left(self.starts, at)
        return list(zip(self.starts[max(0, k - width) : k + width], self.ends[max(0, k - width) : k + width]))


def places(path: str, text: str, first: int, last: int) -> list[int]:
    """The boundaries that hold in the whole text (`edges`) and lie well inside text[first:last], those nearest to the middle first."""
    known, reach = edges(path)
    lo, hi = first + reach, last - reach
    found = [m.start() for m in known.finditer(text, max(0, lo - 1), min(len(text), hi + 2)) if lo <= m.start() <= hi]
    return sorted(found, key=lambda at: abs(2 * at - first - last))


def splice(path: str, text: str, left: Chunk, right: Chunk) -> tuple[int, int] | None:
    """Tokens of `left` before, and of `right` before, a boundary inside the overlap where both agree.

    No token of this tokenizer crosses such a boundary, and what stands on one side
    does not change the other.  Both chunks must cut there, with the same tokens
    around.
    """
    for at in places(path, text, right.first, left.last):
        a, b = left.cut(at), right.cut(at)
        if a is not None and b is not None and left.near(at, 2) == right.near(at, 2):
            return a, b
    return None


def count_long(path: str, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one text, holding the tokens of two chunks at a time.

    Each chunk begins `overlap` characters before the end of the last.  If no
    boundary is in there, or the two chunks agree at none, the overlap is doubled, and
    stays so; once it would reach back to the place where the left chunk begins,
    that one is made twice as long instead, at worst up to the whole rest of the text.
    Chunks are encoded only where there is a boundary to try, so that what is encoded
    in all is a small multiple of the text, also of one without any.
    """
    if len(text) <= chunk or edges(path)[0] is None:
        return counts(path, [text])[0]
    total, skipped = 0, 0  # skipped: tokens of the left chunk that the chunk before has counted
    left, first, last = None, 0, min(len(text), chunk)
    while last < len(text):
        width = overlap
        while last < len(text):
            if width >= last - first:
                last = min(len(text), first + 2 * (last - first))
            elif places(path, text, last - width, last):
                if left is None or (left.first, left.last) != (first, last):
                    left = Chunk(path, text, first, last)
                right = Chunk(path, text, last - width, min(len(text), last - width + max(chunk, 2 * width)))
                if cut := splice(path, text, left, right):
                    total += cut[0] - skipped
                    left, skipped, first, last = right, cut[1], right.first, right.last
                    break
                width *= 2
            else:
                width *= 2
    if left is None or (left.first, left.last) != (first, last):
        left = Chunk(path, text, first, last)
    return total + len(left.starts) - skipped


def count_short(path: str, texts: list[str]) -> list[int]:
    """Tokens of each whole text, put together from its words where the tokenizer allows that: a worker encodes a word once."""
    words = encoder(path)
    if not words.by_word:
        return counts(path, texts)
    return [len(ids) // words.kind.itemsize for ids in words.encode(texts)]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of `docs`.

    `n_tokens`: what the library gives for the whole text, without added special
    tokens; special strings inside a text are read as the library does by
    default.  Texts of over `chunk` characters are counted in overlapping chunks,
    with work in proportion to their length whether or not they have spaces.
    A null text counts as empty: no bytes, no tokens.  Null ids and repeated rows
    stay; other columns are not read.
    """

    def rows(batch: pa.RecordBatch) -> dict:
        texts = batch.column(2).to_pylist()
        short = iter(count_short(path, [t for t in texts if len(t) <= chunk]))
        return {
            "doc_id": batch.column(0),
            "n_bytes": batch.column(1),
            "n_tokens": [next(short) if len(t) <= chunk else count_long(path, t, chunk, overlap) for t in texts],
        }

    whole = F.coalesce(F.col(text), F.lit(""))
    read = docs.select(F.col(doc_id).cast("bigint"), F.octet_length(whole).cast("bigint"), whole)
    return map_arrow(read, rows, "doc_id bigint, n_bytes bigint, n_tokens bigint").withColumn("over_limit", F.col("n_tokens") > limit)
