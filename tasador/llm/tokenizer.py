"""Public tokenizers in a worker: loading, whole texts, and cached words."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

GROUP_CHARS = 1 << 18
"""Characters encoded in one call; the library keeps some hundred bytes per token until it returns."""
WORDS_KEPT = 500_000
WORD_CHARS = 1 << 23
"""Characters put together from words in one go."""
WORDS_AT_ONCE = 20_000

# White space other than single spaces and line ends within a text.
_WIDE = ("  ", "\n\n", " \n", "\n ")
ODD = b"?"
"""Stands for a word with other white space; half an id, so that it cannot be taken for one."""
_ODD = re.compile(r"[^\S\n]|.\n")


def vocabulary_path(name: str) -> str:
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(path: str):
    """The library's tokenizer: `tokenizers` for .json, `sentencepiece` for .model."""
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def splits_at_spaces(path: str) -> bool:
    """Whether encodings never cross, nor look across, the left side of a single inner space.

    Known for byte-level BPE with the usual pattern: its pieces have a space only
    in front, the rest of a piece is of one class of other characters, and only
    runs of white space look ahead.  The same holds for a pattern that drops white
    space.  For sentencepiece it holds if no piece has the space sign after
    another character.
    """
    if path.endswith(".model"):
        model = load(path)
        return not any("▁" in model.id_to_piece(i).lstrip("▁") for i in range(model.vocab_size()))
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = spec.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    flags = [t for t in spec.get("added_tokens", []) if t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]]
    if spec["model"]["type"] != "BPE" or spec["model"].get("dropout") or flags or spec.get("post_processor"):
        return False
    if [s["type"] for s in steps if "type" in s] == ["ByteLevel"]:
        return steps[0]["use_regex"] and not steps[0]["add_prefix_space"] and not spec["normalizer"]
    kinds = [s.get("type") for s in steps]
    if kinds == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed" and steps[0]["invert"]:
        pattern = re.sub(r"\[\^\\s[^\]]*\]", "", steps[0]["pattern"].get("Regex", " "))  # classes that leave white space out
        return " " not in pattern and "\\s" not in pattern and not steps[1]["use_regex"]
    return False


# Characters that every Unicode version puts in the same class: letters, digits, and signs but the apostrophe.
_LETTER = r"A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u0410-\u044F\u3042-\u3093\u30A2-\u30F3\u4E00-\u9FA5\uAC00-\uD7A3"
_DIGIT = "0-9"
_SIGN = r"!-&(-/:-@\[-`{-~\u3001\u3002\uFF01\uFF0C\uFF1A\uFF1F"
_SPACE_EDGE = r"(?<=\S)(?= \S)(?<![\x1c-\x1f\x85\xa0])(?! [\x1c-\x1f\x85\xa0])"
_CLASS_EDGE = rf"(?<=[{_LETTER}])(?=[{_DIGIT}{_SIGN}'])|(?<=[{_DIGIT}])(?=[{_LETTER}{_SIGN}'])|(?<=[{_SIGN}])(?=[{_LETTER}{_DIGIT}])"


@lru_cache(maxsize=4)
def edges(path: str) -> tuple[regex.Pattern | None, int]:
    """Where encodings fall apart whatever stands around, and how far from there a chunk has to reach.

    The left side of a single inner space (`splits_at_spaces`).  The usual pattern of
    byte-level BPE also ends a piece where letters, digits and signs meet; only an
    apostrophe may go with the letters after it, and only a special token, which
    is taken out before, may lie across.  A chunk that reaches as far as the longest
    of those to both sides sees it whole.  None: nothing is known.
    """
    if not splits_at_spaces(path):
        return None, 0
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = spec.get("pre_tokenizer") or {}
        if [s["type"] for s in steps.get("pretokenizers", [steps])] == ["ByteLevel"]:
            return regex.compile(f"{_SPACE_EDGE}|{_CLASS_EDGE}"), max([1, *(len(t["content"]) for t in spec.get("added_tokens", []))])
    return regex.compile(_SPACE_EDGE), 1


def grouped(texts: list[str], chars: int = GROUP_CHARS):
    """Runs of texts of about `chars` characters together."""
    group, held = [], 0
    for text in texts:
        if group and held + len(text) > chars:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        yield group


def counts(path: str, texts: list[str]) -> list[int]:
    """Tokens of each whole text."""
    model, out = load(path), []
    for group in grouped(texts):
        if path.endswith(".model"):
            out += [len(ids) for ids in model.encode(group, num_threads=1)]
        else:
            out += [len(e.ids) for e in model.encode_batch_fast(group, add_special_tokens=False)]
    return out


class Encoder:
    """Token ids of whole texts.

    Where `splits_at_spaces` holds and tokens carry the space in front, the
    library encodes every word once, many in one call, and texts are put together
    from the words; elsewhere it encodes the texts themselves.  The ids are the
    same.  Frequent words are remembered from batch to batch.
    """

    def __init__(self, path: str) -> None:
        self.path, self.model = path, load(path)
        size = self.model.vocab_size() if path.endswith(".model") else self.model.get_vocab_size(True)
        self.kind = np.dtype("<u4" if size > 1 << 16 else "<u2")
        self.words: dict[str, bytes] = {"": b""}  # the empty one is before the line end in front
        self.by_word = False
        if path.endswith(".json") and splits_at_spaces(path):
            vocabulary = self.model.get_vocab(True)
            self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
            self.opens[[i for token, i in vocabulary.items() if token[0] == "Ġ"]] = True  # the sign of a byte-level space
            space, line = self._ids(" a"), self._ids("a\nb")
            self.by_word = bool(self.opens[np.frombuffer(space, self.kind)[0]]) and len(line) == 3 * self.kind.itemsize
            self.line = line[self.kind.itemsize : -self.kind.itemsize]
            self.marks = {m: self._ids("a" + m)[self.kind.itemsize :] for m in (".", ",")}

    def _ids(self, text: str) -> bytes:
        if self.path.endswith(".model"):
            return np.array(self.model.encode(text), self.kind).tobytes()
        return np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind).tobytes()

    def _together(self, words: list[str], mark: str) -> dict[str, bytes]:
        """The ids of words that have no white space: `mark` is a space, which opens each word's ids, or a line end, which parts them."""
        out, size = {}, self.kind.itemsize
        for first in range(0, len(words), WORDS_AT_ONCE):
            part = words[first : first + WORDS_AT_ONCE]
            raw = self._ids(mark + mark.join(part))
            ids = np.frombuffer(raw, self.kind)
            starts = np.flatnonzero(self.opens[ids] if mark == " " else ids == np.frombuffer(self.line, self.kind)) * size
            if len(starts) == len(part):
                out.update(zip(part, (raw[a:b] for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(raw)]))))
            else:
                out.update((w, self._ids(mark + w)) for w in part)
        return out

    def _learn(self, new: list[str]) -> None:
        """Remember the ids of words; those that begin with a line end stand for themselves, the others for a space and the word."""
        known = self.words
        # A full stop or comma after a letter is a piece of its own: such words need only the word before it.
        marked = [w for w in new if w[-1:] in (".", ",") and w[-2:-1].isalpha()]
        bases = {w[:-1] for w in marked if w[:-1] not in known}
        todo = bases.union(new).difference(marked).union(bases)
        odd = {w for w in todo if _ODD.search(w)}
        todo -= odd
        known.update(dict.fromkeys(odd, ODD))
        known.update(self._together([w for w in todo if w[:1] != "\n"], " "))
        known.update(("\n" + w, ids) for w, ids in self._together([w[1:] for w in todo if w[:1] == "\n"], "\n").items())
        for w in marked:
            base = known[w[:-1]]
            known[w] = ODD if base is ODD else base + self.marks[w[-1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian numbers of `kind`."""
        if not self.by_word:
            return [self._ids(t) for t in texts]
        return [ids for group in grouped(texts, WORD_CHARS) for ids in self._by_word(group)]

    def _by_word(self, texts: list[str]) -> list[bytes]:
        # Texts with wider white space are encoded by the library as they are.  In the others a line end
        # is put in front, so that the first word is one that follows a line end, and its id is taken off.
        plain = [t[-1:] != " " and not any(x in t for x in _WIDE) for t in texts]
        lines = pc.replace_substring(pa.array([f"\n{t}" if p else "" for t, p in zip(texts, plain)], pa.string()), "\n", " \n")
        pieces = pc.split_pattern(lines, " ")
        coded = pieces.flatten().dictionary_encode()
        if len(self.words) > WORDS_KEPT:
            self.words = {"": b""}
        words = coded.dictionary.to_pylist()
        raw = list(map(self.words.get, words))
        new = [i for i, r in enumerate(raw) if r is None]
        self._learn([words[i] for i in new])
        for i in new:
            raw[i] = self.words[words[i]]
        size = self.kind.itemsize
        length = np.fromiter(map(len, raw), np.int32, len(raw))
        odd = np.flatnonzero(length % size)
        for i in odd.tolist():
            raw[i] = b""
        length //= size
        ids, first = np.frombuffer(b"".join(raw), self.kind), np.cumsum(length, dtype=np.int32) - length
        place = coded.indices.to_numpy()
        count = length[place]
        ends = np.zeros(len(place) + 1, np.int32)
        np.cumsum(count, out=ends[1:])
        at = np.arange(ends[-1], dtype=np.int32)
        at += np.repeat(first[place] - ends[:-1], count)
        out = ids[at].tobytes()
        edges = pieces.offsets.to_numpy()
        if len(odd):
            strange = np.zeros(len(raw), bool)
            strange[odd] = True
            bad = np.concatenate([[0], np.cumsum(strange[place])])[edges]
            plain = [p and not b for p, b in zip(plain, np.diff(bad).tolist())]
        at = (ends[edges].astype(np.int64) * size).tolist()
        return [out[a + size : b] if p else self._ids(t) for t, p, a, b in zip(texts, plain, at, at[1:])]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(path)
