"""Toxicity by non-negative learning from positive and unlabelled texts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.llm.common import held_out, map_arrow, stored

POSITIVES, UNLABELLED = 4_000, 8_000
"""Texts a model is fitted on at most: those whose ids have the smallest hashes."""
FEATURES = 1_000
LEAST_TEXTS, LEAST_RATIO, LEAST_DEVIATION = 3, 2.0, 1.5
CUT = 0.3
CLASSIFIERS = 5
PREFIXES = (3, 4, 5, 6)
STEPS, RATE, PENALTY = 200, 0.1, 1e-4
SPACE = 1 << 22
WORDS_KEPT = 400_000
OFTEN = 1_000
_EDGES = b".,;:!?\"'()[]{}|*#$%&<>-_"


def word_features(word: bytes) -> set[int]:
    """Hashes of a word without punctuation at its ends, and of its first letters."""
    core = word.strip(_EDGES)
    if not core:
        return set()
    letters = core.decode("utf-8", "replace")
    parts = [b"w" + core, *(b"p" + letters[:n].encode() for n in PREFIXES if len(letters) > n)]
    return {zlib.crc32(p) % SPACE for p in parts}


class Reader:
    """Features of texts; those of a word are found once.  `wanted`: feature to place, all features if None."""

    def __init__(self, wanted: dict[int, int] | None = None) -> None:
        self.wanted, self.words = wanted, {}

    def _word(self, word: bytes) -> tuple[int, ...]:
        own = word_features(word)
        return tuple(sorted(own)) if self.wanted is None else tuple(self.wanted[f] for f in sorted(own) if f in self.wanted)

    def features(self, text: bytes | None) -> list[int]:
        """The different features of a whole text."""
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        words, out = self.words, set()
        for word in set((text or b"").lower().split()):
            own = words.get(word)
            if own is None:
                own = words[word] = self._word(word)
            if own:
                out.update(own)
        return sorted(out)


@dataclass
class Model:
    """Classifiers over the chosen features, and the share of toxic texts they were trained for."""

    wanted: dict[int, int]
    weights: np.ndarray  # a row per classifier
    bias: np.ndarray
    prior: float

    def score(self, places: list[int]) -> float:
        if not len(self.bias):
            return 0.0
        total = self.bias + (self.weights[:, places].sum(axis=1) / np.sqrt(len(places)) if places else 0.0)
        return float(np.mean(_sigmoid(total)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class _Texts:
    """Feature places of some texts; each text's features share a length of 1."""

    def __init__(self, rows: list[list[int]]) -> None:
        self.n = len(rows)
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.place = np.array([p for r in rows for p in r], np.int64)
        self.value = np.repeat([1 / np.sqrt(len(r)) if r else 0.0 for r in rows], [len(r) for r in rows])

    def total(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.place], self.n)

    def back(self, by_text: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.place, self.value * by_text[self.row], size)


def fit_one(positive: list[list[int]], unlabelled: list[list[int]], size: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias of one classifier.

    Minimises prior * loss of positives as toxic + max(0, loss of unlabelled as clean
    - prior * loss of positives as clean): the unlabelled texts stand for the
    clean ones once the share of toxic ones in them is taken off.  Where the
    difference falls below 0, which only over-fitting can cause, the step goes the
    other way.  Logistic loss, Adam steps over all texts.
    """
    p, u = _Texts(positive), _Texts(unlabelled)
    w = np.zeros(size + 1)  # the last is the bias
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        zp, zu = p.total(w[:-1]) + w[-1], u.total(w[:-1]) + w[-1]
        clean_part = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        of_p, of_u = -prior * _sigmoid(zp) / p.n, _sigmoid(zu) / u.n
        if clean_part < 0:
            of_p, of_u = -of_p, -of_u
        else:
            of_p = of_p - prior * (1 - _sigmoid(zp)) / p.n
        slope = np.append(p.back(of_p, size) + u.back(of_u, size) + PENALTY * w[:-1], of_p.sum() + of_u.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope * slope
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def smallest(ids: DataFrame, count: int) -> DataFrame:
    """The `count` ids of (doc_id), distinct ones, that have the smallest hashes.

    A threshold got from the number of ids leaves about twice as many before any
    are put in order, so no task sees more than those.
    """
    total = ids.count()
    share = min(1.0, (2 * count + 1000) / max(1, total))
    placed = ids.withColumn("_h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 62))).filter(F.col("_h") <= int(share * (1 << 62)))
    return placed.orderBy("_h", "doc_id").limit(count).drop("_h")


def document_frequencies(texts: DataFrame, wanted: dict[int, int]) -> tuple[np.ndarray, int]:
    """In how many of all rows of `texts` (text) each wanted feature is, and how many rows there are.

    Every task adds up its own rows; only one number per feature and task is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, found, rows = Reader(wanted), np.zeros(len(wanted) + 1, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for text in batch.column(0).to_pylist():
                found[reader.features(text)] += 1
        found[-1] = rows
        place = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(found[place], pa.int64())], names=["place", "n"])

    out = np.zeros(len(wanted) + 1, np.int64)
    for row in texts.mapInArrow(run, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).collect():
        out[row["place"]] = row["n"]
    return out[:-1], int(out[-1])


def telling(positive: np.ndarray, positives: int, among: np.ndarray, rows: int) -> np.ndarray:
    """Places of the features that toxic texts have clearly more often than all texts, the clearest first."""
    rate = (among + 0.5) / (rows + 1)
    excess = (positive - positives * rate) / np.sqrt(positives * rate + 0.25)
    chosen = (positive >= LEAST_TEXTS) & (positive / positives >= LEAST_RATIO * rate) & (excess >= LEAST_DEVIATION)
    order = np.lexsort((np.arange(len(excess)), -excess))
    return order[chosen[order]]


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, classifiers: int = CLASSIFIERS) -> Model:
    """Learn from the documents that are not held out.

    Positive: at most `positives` documents labelled toxic.  Unlabelled: at most
    `unlabelled` documents of all, whatever their label.  Both are those whose ids
    have the smallest hashes, one text per id (the one with the smallest hash, where
    an id comes with several), so at most that many texts are learned from.  How
    often a feature comes otherwise is counted over all documents that are not held
    out, an id that makes up one row in `OFTEN` or more once, other repeated rows as
    often as they come; the at most `FEATURES` features that tell most are fitted.  The prior is the share of toxic among all labelled
    documents that are not held out.  Each classifier leaves out another part of
    both samples.  An id that is labelled both ways counts as toxic; rows without an
    id are not learned from.  Without a toxic text, or without a word that tells,
    the model scores 0 everywhere.
    """
    known = labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    texts = texts.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    toxic = smallest(known.filter("toxic = 1").select(F.col("doc_id").cast("bigint")), positives)
    copies = stored(texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")), "toxic-ids")
    others = smallest(copies.select("doc_id"), unlabelled)
    chosen = toxic.withColumn("p", F.lit(1)).join(others.withColumn("u", F.lit(1)), "doc_id", "full").na.fill(0, ["p", "u"])
    sample = stored(_one_each(texts.join(F.broadcast(chosen), "doc_id"), ["doc_id", "p", "u"]), "toxic-sample")
    sizes = sample.agg(F.coalesce(F.sum("p"), F.lit(0)).alias("p"), F.coalesce(F.sum("u"), F.lit(0)).alias("u")).first()
    empty = Model({}, np.zeros((0, 0)), np.zeros(0), prior)
    if not sizes["p"] or not sizes["u"]:
        return empty

    seen = map_arrow(sample.filter("p = 1"), _sample_rows(None), "doc_id bigint, p int, u int, places array<bigint>")
    counts = seen.select(F.explode("places").alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("p")).filter(F.col("p") >= LEAST_TEXTS)
    found = sorted(map(tuple, counts.collect()))
    often = copies.filter("n > 1").filter(F.col("n") * OFTEN >= (copies.agg(F.sum("n")).first()[0] or 0))
    often = [r["doc_id"] for r in often.select("doc_id").collect()]  # at most OFTEN of them
    each = texts if not often else texts.filter(~F.col("doc_id").isin(often)).unionByName(_one_each(texts.filter(F.col("doc_id").isin(often)), ["doc_id"]))
    among, rows_seen = document_frequencies(each.select("text"), {feature: i for i, (feature, _) in enumerate(found)})
    tell = telling(np.array([p for _, p in found], np.int64), sizes["p"], among, rows_seen)[:FEATURES]
    wanted = {found[i][0]: place for place, i in enumerate(tell.tolist())}
    if not wanted:
        return empty
    rows = map_arrow(sample, _sample_rows(wanted), "doc_id bigint, p int, u int, places array<bigint>").collect()
    # A text of the same content has the same place whatever order the rows arrive in.
    rows = sorted((zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"], r["places"], r["p"], r["u"]) for r in rows)
    prior = min(max(prior, 0.001), 0.9)
    models = []
    for k in range(classifiers):
        parts = [[r[2] for i, r in enumerate(rows) if r[side] and (i % classifiers != k or len(rows) < 10 * classifiers)] for side in (3, 4)]
        if all(parts):
            models.append(fit_one(*parts, len(wanted), prior))
    return Model(wanted, np.array([w for w, _ in models]), np.array([b for _, b in models]), prior) if models else empty


def _one_each(texts: DataFrame, keys: list[str]) -> DataFrame:
    """One text per key, that with the smallest hash."""
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first")
    return texts.groupBy(*keys).agg(first).select(*keys, "first.text")


def _sample_rows(wanted: dict[int, int] | None):
    def rows(batch: pa.RecordBatch) -> dict:
        reader = Reader(wanted)
        return {"doc_id": batch.column(0), "p": batch.column(1), "u": batch.column(2), "places": [reader.features(t) for t in batch.column(3).to_pylist()]}

    return rows


def scores(docs: DataFrame, model: Model, cut: float = CUT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of `docs`.

    `score` (0 to 1) is the mean probability of the classifiers from the whole
    text alone; a null text counts as empty.  Null ids and repeated rows stay;
    other columns are not read.
    """
    reader = Reader(model.wanted)

    def rows(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "score": [model.score(reader.features(t)) for t in batch.column(1).to_pylist()]}

    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("binary"))
    found = map_arrow(read, rows, "doc_id bigint, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
