"""The registered queries of this subpackage and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasador.llm import chat, decontam, fim, langid, mixing, quality, sharding, simhash, tokencount, tokenfile, toxicity, vectorcodes, warc
from tasador.llm.common import prepared, table
from tasador.llm.tokenizer import vocabulary_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(prepared(spark), sf_dir)
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


@register("op1_language_id")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


@register("op2_source_mixing", mixing.SQL)
def op2(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@register("op3_quality_rules")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    weights = quality.fit_weights(docs, quality.trusted_ids(table(spark, sf_dir, "labels")))
    return quality.verdicts(docs, weights)


@register("op4_chat_perspectives", chat.SQL)
def op4(spark, sf_dir):
    out = chat.dialogues(chat.segments(table(spark, sf_dir, "conversations")))
    pairs = F.transform("mask", lambda m: F.concat_ws("-", m.cast("array<string>")))
    return out.withColumn("mask", F.array_join(pairs, ","))


_SHINGLES = """SELECT DISTINCT id, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS s
    FROM (SELECT id, w, unnest(range(1, len(w) - 3)) AS i FROM (
        SELECT {id} AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM {table}))"""


# Items of fewer than five words, which the benchmark table does not have, are left to the tests.
@register(
    "op5_benchmark_decontamination",
    f"""WITH b AS ({_SHINGLES.format(id="item_id", table="benchmark")}), d AS ({_SHINGLES.format(id="doc_id", table="documents")}),
    n AS (SELECT id, count(*) AS n_item FROM b GROUP BY 1), c AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared FROM d JOIN b USING (s) GROUP BY 1, 2)
    SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment FROM c JOIN n ON n.id = item_id WHERE n_shared >= 0.8 * n_item""",
)
def op5(spark, sf_dir):
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op6_token_files")
def op6(spark, sf_dir):
    return tokenfile.written_and_read(table(spark, sf_dir, "documents"), vocabulary_path(tokenfile.VOCABULARY))


@register("op7_toxicity")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@register("op8_token_counts")
def op8(spark, sf_dir):
    return tokencount.token_counts(table(spark, sf_dir, "documents"), vocabulary_path(tokencount.VOCABULARY))


@register(
    "op9_warc_archive",
    """WITH p AS (SELECT page_id, coalesce(url, '') AS url, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to, url FROM f""",
)
def op9(spark, sf_dir):
    return warc.written_and_read(table(spark, sf_dir, "pages"))


@register("op10_simhash_near_dedup")
def op10(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)


@register("op11_sharding")
def op11(spark, sf_dir):
    return sharding.sharded(table(spark, sf_dir, "documents"))


_CODES = [
    """k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
    "p AS MATERIALIZED (SELECT vec_id, part, v[part * len(v) // 4 + 1:(part + 1) * len(v) // 4] AS w FROM k, range(4) AS r(part))",
    "b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, w FROM p WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 256))",
]
_NEAREST = """a{r} AS MATERIALIZED (SELECT vec_id, part, min(CAST(list_sum(list_transform(list_zip(p.w, b.w), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * 256 + entry) AS m
    FROM p JOIN b{r} b USING (part) GROUP BY 1, 2)"""
_MEANS = """b{next} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(u.w, b.w) AS w FROM b{r} b LEFT JOIN (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY j) AS w FROM (
    SELECT part, m % 256 AS entry, j, CAST(sum(w[j]) AS BIGINT) AS s, count(*) AS n FROM a{r} JOIN p USING (vec_id, part), range(1, 4096) AS r(j) WHERE j <= len(w) GROUP BY 1, 2, 3) GROUP BY 1, 2) u ON u.part = b.part AND u.entry = b.entry)"""
for _r in range(4):
    _CODES += [_NEAREST.format(r=_r), _MEANS.format(r=_r, next=_r + 1)]
_CODES += [_NEAREST.format(r=4), "c AS (SELECT vec_id, string_agg(printf('%02x', m % 256), '' ORDER BY part) AS code, CAST(sum(m // 256) AS BIGINT) AS error FROM a4 GROUP BY 1)"]


@register(
    "op12_vector_codes",
    f"""WITH {", ".join(_CODES)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY part, entry)) FROM b4) AS codebooks_sha256 FROM c JOIN k USING (vec_id)""",
)
def op12(spark, sf_dir):
    coded, books = vectorcodes.compressed(table(spark, sf_dir, "embeddings"))
    return coded.withColumn("codebooks_sha256", F.lit(vectorcodes.books_digest(books)))


_SPACE = "\\x20\\x09-\\x0D"


@register(
    "op13_fill_in_middle",
    f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h FROM documents),
    u AS (SELECT *, regexp_extract_all(text, '[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+') AS u FROM t),
    d AS (SELECT *, len(u) AS n, {", ".join(f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))} FROM u),
    c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM d),
    f AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s, CASE
        WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(p || m || s) AS restored_sha256 FROM f""",
)
def op13(spark, sf_dir):
    done = fim.transform(table(spark, sf_dir, "documents"))
    text = fim.restored(F.col("output"), F.col("form"))
    digests = [F.sha2(F.col("output"), 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256")]
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)
