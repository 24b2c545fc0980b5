"""Quality rules: plain text measures, then a log-likelihood ratio over hashed n-grams.

Column expressions only.  Lambdas of Spark's array functions are interpreted and
evaluate an outer expression once per element, so everything used twice is bound
to a name first (`let`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.llm.common import barrier, stored

WHITE = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
BUCKETS = 1 << 16
PRIOR = 10.0
THRESHOLD = -0.1
FILTER_WORDS = 1 << 18
"""64-bit words of the filter that tells which documents cannot be trusted: 2 MB, whatever the input."""


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Runs of characters other than the space and 09 to 0D; none of a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{WHITE}]+"), "")


def word_hashes(split: Column) -> Column:
    return F.transform(split, lambda w: F.xxhash64(w))


def _runs(hashes: Column, size: int) -> Column:
    """One hash for every `size` elements in a row, in order."""
    last = F.size(hashes) - size
    # The guard repeats the condition because a sequence must not run backwards.
    places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size)]))


def _covered(windows: Column, size: int) -> Column:
    """How many words lie in a window that occurs twice or more."""

    def places(line: Column) -> Column:
        same = lambda k, j: F.get(line, k)["h"] == F.get(line, j)["h"]
        found = F.filter(
            F.sequence(F.lit(0), F.size(line) - 1),
            lambda k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)),
        )
        return F.array_sort(F.transform(found, lambda k: F.get(line, k)["i"]))

    def total(at: Column) -> Column:
        # A window adds the words that the window before it has not covered.
        return F.aggregate(
            at,
            F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-size).alias("last")),
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(size), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"],
        )

    def counted(hashes: Column) -> Column:
        line = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(repeated, let(line, lambda s: let(places(s), total))).otherwise(F.lit(0).cast("bigint"))

    return let(windows, counted)


def measures(text: Column, split: Column, hashes: Column) -> dict[str, Column]:
    """The plain measures of a text, given its words and their hashes."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    return {
        "n_words": F.size(split).cast("bigint"),
        "word_chars": F.length(F.array_join(split, "")).cast("bigint"),
        "n_symbols": (F.length(whole) - F.length(F.regexp_replace(whole, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": let(lines, lambda own: F.size(own) - F.size(F.array_distinct(own))).cast("bigint"),
        "n_repeat_words": _covered(_runs(hashes, 3), 3),
    }


def ngrams(hashes: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all single words and all pairs of neighbours."""
    return F.transform(F.concat(hashes, _runs(hashes, 2)), lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def _dense(cells: DataFrame, size: int, rest: Column) -> Column:
    """`value` of the cells (at, value) in one array by `at`, `rest` elsewhere: a scalar subquery of `size` numbers."""
    every = cells.sparkSession.range(size).select(F.col("id").cast("int").alias("at"))
    full = every.join(cells, "at", "left").select("at", F.coalesce("value", rest).alias("value"))
    row = full.agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("line"))
    return row.select(F.transform("line", lambda x: x["value"])).scalar()


def _possible(ids: DataFrame, size: int = FILTER_WORDS) -> Callable[[Column], Column]:
    """A test of an id that holds for every id of `ids` and few others: one bit per id in an array of `size` words.

    The array has the same size for any number of ids; the more ids, the more others pass.
    """
    mixed = lambda id_: F.xxhash64(id_, F.lit("trusted"))
    word = lambda id_: F.pmod(F.shiftright(mixed(id_), 6), F.lit(size)).cast("int")
    bit = lambda id_: mixed(id_).bitwiseAND(F.lit(63)).cast("int")
    own = F.col(ids.columns[0])
    cells = ids.groupBy(word(own).alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit(own))).alias("value"))
    line = _dense(cells, size, F.lit(0).cast("bigint"))
    return lambda id_: id_.isNotNull() & (F.getbit(F.get(line, word(id_)), bit(id_)) == 1)


def fit_weights(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR, filter_words: int = FILTER_WORDS) -> DataFrame:
    """(bucket, weight): log ratio of a bucket's share in the trusted texts to its share in all.

    The raw multinomial counts every n-gram of every document, the trusted one
    those of every document whose id is in `trusted` (doc_id).  Documents that a
    filter of fixed size proves untrusted are counted where they are read; the
    others are shuffled to meet the ids, so no list of ids is held whole.  The filter
    (`filter_words`) changes what is shuffled, never a count.
    Documents without an id are not trusted.  `prior` expected occurrences are added
    to each bucket on both sides, so a bucket seen rarely says little.  Without
    trusted texts all weights are 0.  A bucket that no text has is left out.
    """
    ids = trusted.select(F.col("doc_id").cast("bigint").alias("trusted_id")).dropna().distinct()
    possible = _possible(ids, filter_words)(F.col("_id"))
    dealt = docs.select(F.col("doc_id").cast("bigint").alias("_id"), "text")
    # Texts are joined, not their hashes, which take half as much again in a shuffle.
    met = dealt.filter(possible).join(ids.hint("merge"), F.col("_id") == F.col("trusted_id"), "left")
    texts = met.select(F.col("trusted_id").isNotNull().alias("target"), "text")
    texts = texts.unionByName(dealt.filter(~possible).select(F.lit(False).alias("target"), "text"))
    read = barrier(texts.select("target", word_hashes(words(F.col("text"))).alias("hashes")))
    grams = read.select("target", F.explode(ngrams(F.col("hashes"), buckets)).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count_if("target").alias("target"))
    counts = stored(counts, "ngrams")
    totals = counts.agg(F.sum("raw").alias("raws"), F.sum("target").alias("targets")).first()
    share = (totals["targets"] or 0) / (totals["raws"] or 1)
    weight = F.log((F.col("target") + prior) / (F.col("raw") * share + prior)) if share else F.lit(0.0)
    return counts.select("bucket", weight.alias("weight"))


def verdicts(docs: DataFrame, weights: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """One row per row of `docs`: `keep` (doc_id by default), the measures, `score`, `base_failed`, `kept`.

    `score` is the sum of the weights of all single words and neighbour pairs of
    the whole text, divided by their number; 0 without words.  `base_failed`:
    under 50 words, or over half of them in repeated three-word windows.  `kept`
    holds if the base rules do and the score is at least `threshold`.  A null
    text counts as empty.  A kept column that is named like a result is replaced.
    """
    own = ["doc_id"] if keep is None else keep
    split = barrier(docs.select(F.struct(*[F.col(f"`{n}`") for n in own]).alias("row"), F.col("text").alias("text"), words(F.col("text")).alias("words")))
    hashed = barrier(split.withColumn("hashes", word_hashes(F.col("words"))))
    found = measures(F.col("text"), F.col("words"), F.col("hashes"))
    # The table is a column first: a subquery may not be written inside a lambda.
    hashed = hashed.withColumn("table", _dense(weights.toDF("at", "value"), buckets, F.lit(0.0)))
    score = let(
        F.col("table"),
        lambda table: let(
            ngrams(F.col("hashes"), buckets),
            lambda own: F.when(
                F.size(own) > 0, F.aggregate(own, F.lit(0.0), lambda acc, b: acc + F.get(table, b)) / F.size(own)
            ).otherwise(F.lit(0.0)),
        ),
    )
    measured = barrier(hashed.select("row", *[c.alias(n) for n, c in found.items()], score.alias("score")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    results = [*found, "score", "base_failed", "kept"]
    judged = measured.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold))
    return judged.select(*[F.col("row")[n].alias(n) for n in own if n not in results], *results)


def keep_good(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """The documents whose verdict is `kept`, with all their columns."""
    names = docs.columns
    packed = docs.select("doc_id", "text", F.struct(*[F.col(f"`{n}`") for n in names]).alias("_whole"))
    return verdicts(packed, fit_weights(docs, trusted), keep=["_whole"]).filter("kept").select("_whole.*")


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.filter("quality = 1").select("doc_id")
