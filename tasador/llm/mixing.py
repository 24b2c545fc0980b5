"""Mixing sources to target weights by Poisson replication.  Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.llm.common import stored
from tasador.llm.quality import let

SEED = 17
ALPHA = 0.5
PART_RATE = 64
"""A higher rate is split into equal parts, whose independent draws add up to a draw of the whole."""
BROADCAST_SOURCES = 10_000
"""Sources that are broadcast at most; each brings some 200 steps of its distribution, 20 MB in all."""
SALTS = 64


def source_rates(docs: DataFrame, weights: DataFrame | None = None, total: float | None = None, alpha: float = ALPHA) -> DataFrame:
    """(source, n, rate): how often a document of each source is repeated on average.

    `weights` (source, weight) are the target shares before they are made to sum to
    1; by default the count of the source to the power `alpha`, which raises
    small sources.  `rate` is share * total / n; `total` is the wanted number of
    documents, by default as many as there are.  A source without a positive
    weight has rate 0.  Documents without a source form one.  Sources are any
    number: all steps are aggregates or joins of this table.
    """
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighed = counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(alpha)))
    else:
        wanted = weights.groupBy(F.col("source").alias("_source")).agg(F.sum("weight").cast("double").alias("weight"))
        weighed = counts.join(wanted, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
        weighed = weighed.withColumn("weight", F.greatest(F.lit(0.0), F.coalesce("weight", F.lit(0.0))))
    weighed = stored(weighed, "sources")
    sums = weighed.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
    if not sums["weight"]:
        return weighed.select("source", "n", (F.col("n") * 0.0).alias("rate"))
    size = float(sums["n"] if total is None else total)
    return weighed.select("source", "n", (F.col("weight") / sums["weight"] * size / F.col("n")).alias("rate"))


def poisson_steps(rate: Column) -> Column:
    """The distribution function of a Poisson number at 0, 1, 2 ... until nothing measurable is left."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 50)
    start = F.struct(F.lit(0.0).alias("log"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("steps"))

    def step(acc: Column, k: Column) -> Column:
        log = F.when(k == 0, -rate).otherwise(acc["log"] + F.log(rate) - F.log(k.cast("double")))
        return let(log, lambda own: let(acc["sum"] + F.exp(own), lambda upto: F.struct(own.alias("log"), upto.alias("sum"), F.concat(acc["steps"], F.array(upto)).alias("steps"))))

    return F.aggregate(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint")), start, step, lambda acc: acc["steps"])


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 random bits that depends on the parts alone."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def replicate(docs: DataFrame, rates: DataFrame, seed: int = SEED) -> DataFrame:
    """Every row of `docs` as often as its draw says, in a random order over the whole table.

    The draw inverts the Poisson distribution of the source's rate at a hash of
    seed, id and text: it is the same in any run and on any cluster, and repeated
    rows have the same draw.  Columns: those of `docs`, then `part`, `copy`
    (which repetition; part is 1 for rates up to 64) and `order_key`, a hash of
    both and the row's content; columns of `docs` with these names are replaced.  A
    source whose rate is 0, or is not in `rates`, is left out.

    The order is that of a hash of `order_key` and the row's place in `docs`, so
    that rows that are equal, also a third of all, go to places of their own.  The
    places have to repeat where a task runs again, as those of tables read from files do.

    The rates are joined by broadcast while there are few sources; beyond that
    the documents of a source are dealt to `SALTS` keys, as one source may have
    a third of them.  The one shuffle of whole rows is the final one, by hash.
    """
    results = ["part", "copy", "order_key"]
    names = [n for n in docs.columns if n not in results]
    ready = rates.filter("rate > 0").select(F.col("source").alias("_source"), F.ceil(F.col("rate") / PART_RATE).alias("_parts"), "rate")
    ready = stored(ready.select("_source", "_parts", poisson_steps(F.col("rate") / F.col("_parts")).alias("_steps")), "rates")
    identity = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce(F.col("text"), F.lit(""))))
    rows = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"), F.col("source").alias("_of"), identity.alias("_key"), F.monotonically_increasing_id().alias("_no"))
    same = F.col("_of").eqNullSafe(F.col("_source"))
    if ready.count() <= BROADCAST_SOURCES:
        met = rows.join(F.broadcast(ready), same)
    else:
        salted = ready.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = rows.withColumn("_deal", F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int")).join(salted, same & (F.col("_deal") == F.col("_salt")))
    parts = met.select("_row", "_key", "_no", "_steps", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_parts"))).alias("part"))
    drawn = parts.withColumn("_u", _uniform(F.col("_key"), F.col("part").cast("string")))
    times = F.size(F.filter("_steps", lambda upto: upto <= F.col("_u"))).cast("bigint")
    counted = drawn.select("_row", "_key", "_no", "part", times.alias("_times")).filter("_times > 0")
    copies = counted.select("_row", "_key", "_no", "part", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times"))).alias("copy"))
    order = F.substring(F.md5(F.concat_ws("|", F.lit("order"), "_key", F.col("part").cast("string"), F.col("copy").cast("string"))), 1, 15)
    keyed = copies.select(*[F.col("_row")[n].alias(n) for n in names], "part", "copy", F.conv(order, 16, 10).cast("bigint").alias("order_key"), "_no")
    placed = keyed.withColumn("_place", F.xxhash64("order_key", "_no")).drop("_no")
    return placed.repartition("_place").sortWithinPartitions("_place").drop("_place")


def mix(docs: DataFrame, weights: DataFrame | None = None, total: float | None = None, seed: int = SEED, alpha: float = ALPHA) -> DataFrame:
    return replicate(docs, source_rates(docs, weights, total, alpha), seed)


SQL = f"""WITH s AS (SELECT source, count(*) AS n, pow(CAST(count(*) AS DOUBLE), {ALPHA}) AS w FROM documents GROUP BY 1),
r AS (SELECT source, w / (SELECT sum(w) FROM s) * (SELECT CAST(sum(n) AS DOUBLE) FROM s) / n AS rate FROM s),
q AS (SELECT source, CAST(ceil(rate / {PART_RATE}) AS BIGINT) AS parts, rate / ceil(rate / {PART_RATE}) AS rate FROM r),
e AS (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 50) AS BIGINT) + 1)) AS k FROM q),
p AS (SELECT source, k, exp(sum(CASE WHEN k = 0 THEN -rate ELSE ln(rate) - ln(k) END) OVER (PARTITION BY source ORDER BY k)) AS p FROM e),
f AS (SELECT source, list(upto ORDER BY k) AS steps FROM (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS upto FROM p) GROUP BY 1),
d AS (SELECT *, unnest(range(1, parts + 1)) AS part FROM (SELECT documents.*, parts, steps,
    concat_ws('|', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), 'null'), md5(coalesce(text, ''))) AS id
    FROM documents JOIN q ON documents.source IS NOT DISTINCT FROM q.source JOIN f ON q.source IS NOT DISTINCT FROM f.source)),
t AS (SELECT *, len(list_filter(steps, lambda x: x <= CAST('0x' || substr(md5(id || '|' || part), 1, 13) AS BIGINT) / 4503599627370496.0)) AS times FROM d),
c AS (SELECT *, unnest(range(1, times + 1)) AS copy FROM t)
SELECT doc_id, text, lang, source, n_chars, part, copy, CAST('0x' || substr(md5('order|' || id || '|' || part || '|' || copy), 1, 15) AS BIGINT) AS order_key FROM c"""
