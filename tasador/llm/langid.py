"""Language identification: scripts narrow the candidates, Viterbi over word scores labels the spans of a text."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tasador.llm.common import held_out, map_arrow, stored
from tasador.operators.keyed import lookup

UNKNOWN = "und"
SAMPLE = 1_000
"""Training documents of a language at most: those whose ids have the smallest hashes."""
LEAST_DOCUMENTS = 5
"""Values of `lang` that fewer documents have are no languages to learn."""
BROADCAST_IDS = 1_000_000
BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
PRIOR = 0.5
SWITCH = 4.0
"""What a change of language costs, in the unit of the word scores (nats)."""
LEAST_SHARE = 0.01
BARRED = -1e4
WORDS_KEPT = 300_000
CELLS = 4 << 20
"""Word scores held at once, words times languages."""

# First and last code points of scripts, fixed values of the Unicode blocks.
SCRIPTS = [
    ("Latin", 0x0041, 0x024F),
    ("Greek", 0x0370, 0x03FF),
    ("Cyrillic", 0x0400, 0x052F),
    ("Armenian", 0x0530, 0x058F),
    ("Hebrew", 0x0590, 0x05FF),
    ("Arabic", 0x0600, 0x077F),
    ("Devanagari", 0x0900, 0x097F),
    ("Bengali", 0x0980, 0x09FF),
    ("Tamil", 0x0B80, 0x0BFF),
    ("Thai", 0x0E00, 0x0E7F),
    ("Georgian", 0x10A0, 0x10FF),
    ("Hangul", 0x1100, 0x11FF),
    ("Latin", 0x1E00, 0x1EFF),
    ("Greek", 0x1F00, 0x1FFF),
    ("Kana", 0x3040, 0x30FF),
    ("Han", 0x3400, 0x4DBF),
    ("Han", 0x4E00, 0x9FFF),
    ("Hangul", 0xAC00, 0xD7AF),
]
NAMES = sorted({name for name, _, _ in SCRIPTS}) + ["other"]
_FIRST = np.array([a for _, a, _ in SCRIPTS])
_LAST = np.array([b for _, _, b in SCRIPTS])
_SCRIPT = np.array([NAMES.index(name) for name, _, _ in SCRIPTS])
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters (and of number signs that are no digits, which `Words` drops)."""
    return _WORD.findall(text or "")


class Words:
    """What the scores of many words need, one entry per word: n-gram buckets, letters, main script."""

    def __init__(self, words: list[str]) -> None:
        line = np.frombuffer((" " + " ".join(w.lower() for w in words) + " ").encode("utf-32-le"), "<u4")
        gap = line == 32
        word = np.cumsum(gap) - 1  # a gap belongs to the word after it
        self.n = len(words)
        self.letters = np.array([sum(map(str.isalpha, w)) for w in words], np.int64)
        buckets, owners = [], []
        for order in ORDERS:
            size = len(line) - order + 1
            if size <= 0:
                continue
            digest = np.full(size, order, np.uint64)
            inner = np.zeros(size, bool)
            for k in range(order):
                digest = (digest ^ line[k : k + size]) * np.uint64(0x9E3779B97F4A7C15)
                digest ^= digest >> np.uint64(31)
                if 0 < k < order - 1:
                    inner |= gap[k : k + size]
            whole = ~inner & ~(gap[:size] & gap[order - 1 : order - 1 + size])
            buckets.append((digest[whole] % np.uint64(BUCKETS)).astype(np.int64))
            owners.append(word[:size][whole])
        self.buckets, self.owners = np.concatenate(buckets), np.concatenate(owners)
        at = np.searchsorted(_FIRST, line, "right") - 1
        script = np.where((at >= 0) & (line <= _LAST[at]), _SCRIPT[at], len(NAMES) - 1)[~gap]
        seen = np.bincount(word[~gap] * len(NAMES) + script, minlength=self.n * len(NAMES))[: self.n * len(NAMES)]
        self.by_script = seen.reshape(self.n, len(NAMES))
        self.script = self.by_script.argmax(axis=1)


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # log shares, a row per language
    allowed: np.ndarray  # script by language

    def scores(self, words: Words) -> np.ndarray:
        """Word by language: a scaled log-likelihood, 0 for the best language; barred languages are far below."""
        total = np.stack([np.bincount(words.owners, own[words.buckets], words.n) for own in self.grams], axis=1) / len(ORDERS)
        open_to = self.allowed[words.script]
        open_to = open_to | ~open_to.any(axis=1, keepdims=True)
        total = np.where(open_to, total, BARRED)
        total -= np.where(open_to, total, -np.inf).max(axis=1, keepdims=True)
        total[words.letters == 0] = 0.0
        return total


def viterbi(scores: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of every word, where a change from word to word costs `switch`.

    `scores`: the words of all texts in one line, `sizes`: words per text.  All texts
    advance together, word by word, the longest in front.
    """
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    longest = int(sizes.max(initial=0))
    active = np.searchsorted(-sizes[order], -np.arange(longest), "left")  # texts that have a word at each step
    n, k = len(sizes), scores.shape[1]
    own = np.arange(k, dtype=np.int16)
    came = np.empty(scores.shape, np.int16)
    state = np.zeros((n, k))
    for step in range(longest):
        m = active[step]
        at = starts[:m] + step
        if step:
            now = state[:m]
            best = now.argmax(axis=1)
            jump = now[np.arange(m), best] - switch
            moved = jump[:, None] > now
            came[at] = np.where(moved, best[:, None], own)
            state[:m] = np.where(moved, jump[:, None], now) + scores[at]
        else:
            state[:m] = scores[at]
    path = np.empty(len(scores), np.int16)
    current = state.argmax(axis=1)
    for step in range(longest - 1, -1, -1):
        m = active[step]
        at = starts[:m] + step
        path[at] = current[:m]
        if step:
            current[:m] = came[at, current[:m]]
    return path


class Labeller:
    """Labels the words of texts; scores of a word are found once."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.table = np.zeros((0, len(self.model.languages)), np.float32)
        self.letters = np.zeros(0, np.int64)

    def _learn(self, words: set[str]) -> None:
        if len(self.places) > WORDS_KEPT:
            self._forget()
        new = [w for w in words if w not in self.places]
        step = max(1, CELLS // (8 * len(self.model.languages)))
        tables, letters = [self.table], [self.letters]
        for first in range(0, len(new), step):
            part = Words(new[first : first + step])
            tables.append(self.model.scores(part).astype(np.float32))
            letters.append(part.letters)
        self.places.update(zip(new, range(len(self.table), len(self.table) + len(new))))
        self.table, self.letters = np.concatenate(tables), np.concatenate(letters)

    def label(self, texts: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Language and letters of each word, text by text."""
        out: list[tuple[np.ndarray, np.ndarray]] = []
        room, group = max(1, CELLS // max(1, len(self.model.languages))), []
        for i, words in enumerate(texts):
            group.append(words)
            room -= len(words)
            if room <= 0 or i + 1 == len(texts):
                out += self._group(group)
                room, group = max(1, CELLS // max(1, len(self.model.languages))), []
        return out

    def _group(self, texts: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        self._learn({w for words in texts for w in words})
        sizes = np.array([len(t) for t in texts], np.int64)
        get = self.places.__getitem__
        place = np.fromiter((get(w) for words in texts for w in words), np.int64, int(sizes.sum()))
        path, letters = viterbi(self.table[place], sizes), self.letters[place]
        ends = np.cumsum(sizes)
        return [(path[a:b], letters[a:b]) for a, b in zip((ends - sizes).tolist(), ends.tolist())]

    def languages(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The language with most letters of each text, and its share of the letters."""
        if not self.model.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        out = []
        for path, letters in self.label([words_of(t) for t in texts]):
            weight = np.bincount(path, letters, len(self.model.languages))
            best = int(weight.argmax())
            out.append((self.model.languages[best], float(weight[best] / weight.sum())) if weight.sum() else (UNKNOWN, 0.0))
        return out

    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        """(start, end, language) of the runs of a text, in characters; a run goes up to the next one."""
        found = [m for m in _WORD.finditer(text or "") if any(map(str.isalpha, m[0]))]
        if not found or not self.model.languages:
            return []
        path = self.label([[m[0] for m in found]])[0][0]
        first = [0, *(np.flatnonzero(path[1:] != path[:-1]) + 1).tolist()]
        starts = [0, *(found[i].start() for i in first[1:])]
        return [(a, b, self.model.languages[path[i]]) for a, b, i in zip(starts, [*starts[1:], len(text)], first)]


def _sample_ids(known: DataFrame, sample: int, least: int) -> DataFrame:
    """(_id, _lang): the `sample` ids of every language with the smallest hashes, of languages that have `least` at all.

    A threshold per language, got from the number of its ids, leaves about twice as
    many before any are put in order, so no task sees a whole language.
    """
    ids = stored(known.select("doc_id", "lang").distinct(), "language-all-ids")
    sizes = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least)
    low = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 52))
    near = lookup(ids, stored(sizes, "language-sizes"), ["lang"], "inner").filter(low <= F.least(F.lit(1.0), (2 * sample + 1000) / F.col("_n")) * (1 << 52))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(low, "doc_id"))
    chosen = near.withColumn("rank", rank).filter(F.col("rank") <= sample)
    return stored(chosen.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")), "language-ids")


def fit(docs: DataFrame, sample: int = SAMPLE, least: int = LEAST_DOCUMENTS) -> Model:
    """Learn from at most `sample` documents of every language, held-out ones aside.

    Rows without language or text are left out, and so are rows without an id and
    values of `lang` that fewer than `least` different ids have: from those no
    language can be learned, and there may be any number of them.  What reaches the
    driver is a count per n-gram bucket and language.
    """
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "text").filter("doc_id is not null and lang is not null and text is not null")
    known = known.filter(~held_out(F.col("doc_id")))
    ids = _sample_ids(known, sample, least)
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    chosen = known.join(ids, (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")))
    # One text per id and language, so that a repeated row is read once.
    chosen = chosen.groupBy("lang", "doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first"))
    chosen = stored(chosen.select("lang", "first.text"), "language-sample")

    def rows(batch: pa.RecordBatch) -> dict:
        by_language: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_language.setdefault(lang, []).extend(w for w in words_of(text) if any(map(str.isalpha, w)))
        out = {"lang": [], "place": [], "n": []}
        for lang, words in by_language.items():
            if not words:
                out["lang"].append(lang)
                out["place"].append(0)
                out["n"].append(0)
                continue
            own = Words(words)
            counts = np.concatenate([np.bincount(own.buckets, minlength=BUCKETS), own.by_script.sum(axis=0)])
            seen = np.flatnonzero(counts)
            out["lang"] += [lang] * len(seen)
            out["place"] += seen.tolist()
            out["n"] += counts[seen].tolist()
        return out

    counted = map_arrow(chosen, rows, "lang string, place bigint, n bigint").groupBy("lang", "place").agg(F.sum("n").alias("n")).toArrow()
    names = counted.column("lang").combine_chunks().dictionary_encode()
    languages = sorted(names.dictionary.to_pylist())
    at = {lang: i for i, lang in enumerate(languages)}
    line = np.array([at[lang] for lang in names.dictionary.to_pylist()], np.int64)
    counts = np.zeros((len(languages), BUCKETS + len(NAMES)))
    counts[line[names.indices.to_numpy()], counted.column("place").to_numpy()] = counted.column("n").to_numpy()
    grams, scripts = counts[:, :BUCKETS], counts[:, BUCKETS:]
    shares = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True))
    return Model(languages, np.log((grams + PRIOR) / (grams.sum(axis=1, keepdims=True) + PRIOR * BUCKETS)), (shares >= LEAST_SHARE).T)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per row of `docs`.

    `lang_pred` is the language whose spans have most letters, the first by name
    among equals; `score` is its share of the letters.  A null text and a text
    without a letter are `und` with score 0, as is every text if no language
    was learned.  Null ids and repeated rows stay; no other column is read.
    """
    labeller = Labeller(model)

    def rows(batch: pa.RecordBatch) -> dict:
        found = labeller.languages(batch.column(1).to_pylist())
        return {"doc_id": batch.column(0), "lang_pred": [x for x, _ in found], "score": [x for _, x in found]}

    out = map_arrow(docs.select(F.col(doc_id).cast("bigint"), F.col(text)), rows, "doc_id bigint, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def spans(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end, lang) of every span of every text, in characters; texts without a letter have none."""
    labeller = Labeller(model)

    def rows(batch: pa.RecordBatch) -> dict:
        found = [(d, *s) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for s in labeller.spans(t)]
        return {"doc_id": [f[0] for f in found], "start": [f[1] for f in found], "end": [f[2] for f in found], "lang": [f[3] for f in found]}

    return map_arrow(docs.select(F.col(doc_id).cast("bigint"), F.col(text)), rows, "doc_id bigint, start bigint, end bigint, lang string")
