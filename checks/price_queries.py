"""Price list, dictionaries and matching, each with its SQL."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from checks.registry import register
from checks.silver_queries import ROW, c, num, tok
from checks.views import AS_OF, cte, view
from tasador.functions.text import bag, nfkd
from tasador.operators import dictionaries as D
from tasador.operators import match as M
from tasador.plans import pricelist as P
from tasador.session import shared_dir

YEAR = AS_OF[:4]


def _alnum(x):
    return f"regexp_replace({x}, '[^A-Za-z0-9]', '', 'g')"


def _plain(x):
    return _alnum(f"strip_accents(upper(trim({x})))")


_BOOK = f"""book AS (SELECT {_plain('"Marca"')} AS "Marca", replace({_plain('"Modelo_Cube"')}, 'CLASE', '') AS "Modelo_Cube", "Segmento", max(seq) AS seq
  FROM segment_book GROUP BY "Marca", "Modelo_Cube", "Segmento")"""
_MERGED = """merged AS (SELECT "Marca", "Modelo_Cube", "Segmento" FROM (SELECT *, row_number() OVER (PARTITION BY "Marca", "Modelo_Cube" ORDER BY rk DESC, seq DESC) AS rn
  FROM (SELECT "Marca", "Modelo_Cube", "Segmento", seq, 0 AS rk FROM book UNION ALL SELECT "Marca", "Modelo_Cube", "Segmento", seq, 1 FROM segment_history) x) y WHERE rn = 1)"""


def _book(spark, sf_dir):
    return P.segment_book(view(spark, sf_dir, "segment_book"), ["seq"])


def _merged(spark, sf_dir):
    return P.segment_merge(_book(spark, sf_dir), view(spark, sf_dir, "segment_history"), ["seq"])


@register("prc_segment_dim", f"{cte('segment_book')}, {_BOOK} SELECT * FROM book")
def prc_segment_dim(spark, sf_dir):
    return _book(spark, sf_dir)


@register("prc_segment_merge", f"{cte('segment_book', 'segment_history')}, {_BOOK}, {_MERGED} SELECT * FROM merged")
def prc_segment_merge(spark, sf_dir):
    return _merged(spark, sf_dir)


_STAR = f"coalesce({num(tok('\"Matriculacion\"', 1).replace(chr(39) + ' ' + chr(39), chr(39) + '-' + chr(39)))}, {YEAR})"
_END2 = tok('"Matriculacion"', 2).replace("' '", "'-'")
_END = f"coalesce({num(f'(CASE WHEN length({_END2}) >= 3 THEN {_END2} END)')}, {YEAR})"


@register(
    "prc_period",
    f'{cte("price_raw")} SELECT p_partkey, CAST({_STAR} AS DOUBLE) AS "StarDate", CAST({_END} AS DOUBLE) AS "EndDate" FROM price_raw WHERE {_END} >= 2005',
)
def prc_period(spark, sf_dir):
    return P.period(view(spark, sf_dir, "price_raw"), AS_OF).select("p_partkey", "StarDate", "EndDate")


_CODES = "CASE \"Combustible\" " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.FUEL_CODES.items()) + " END"


@register("prc_fuel_map", f"{cte('price_raw')} SELECT p_partkey, {_CODES} AS fuel FROM price_raw WHERE ({_CODES}) IS NOT NULL")
def prc_fuel_map(spark, sf_dir):
    return P.map_fuel(view(spark, sf_dir, "price_raw")).select("p_partkey", c("Combustible").alias("fuel"))


def _rest(x, n):
    return f"array_to_string(string_split({x}, ' ')[{n}:], ' ')"


def _shift(src, dst, when, joined=True, extra=""):
    head = ("m || " if joined else "") + tok("x", 1)
    return (
        f"{dst} AS (SELECT * EXCLUDE (m, x), CASE WHEN {when} THEN {head} ELSE m END AS m, "
        f"CASE WHEN {when} THEN {_rest('x', 2)} ELSE x END AS x{extra} FROM {src})"
    )


_SPLIT = f"""
s0 AS (SELECT *, {tok('"Modelo"', 1)} AS m, {_rest('"Modelo"', 2)} AS x FROM price_raw),
{_shift('s0', 's1', "m IN ('XC', 'MAZDA')")},
{_shift('s1', 's2', f'''"Marca" = 'BMW' AND length({tok('x', 1)}) = 1''')},
s3 AS (SELECT *, coalesce(length(x) >= 2, false) AS ok FROM s2),
{_shift('s3', 's4', '''ok AND "Marca" = 'VOLVO' AND length(m) = 1 AND regexp_matches(substr(x, 2, 1), '[0-9]')''')},
{_shift('s4', 's5', "ok AND m = 'ALFA'", joined=False)},
s6 AS (SELECT *, ok AND trim(m) = 'Range' AS rng FROM s5),
{_shift('s6', 's7', 'rng')},
{_shift('s7', 's8', f"rng AND {tok('x', 1)} IN ('Velar', 'Evoque')")},
sp AS (SELECT * EXCLUDE (x), CASE WHEN ok THEN x ELSE '-' END AS x FROM s8)
"""


@register("prc_clean_model", f"{cte('price_raw')}, {_SPLIT} SELECT p_partkey, m AS model, x AS features FROM sp")
def prc_clean_model(spark, sf_dir):
    df = P.split_model(view(spark, sf_dir, "price_raw"))
    return df.select("p_partkey", c("Modelo").alias("model"), c("Caracteristicas").alias("features"))


@register(
    "prc_normalise",
    f"""{cte('price_raw')} SELECT p_partkey, {_plain('"Marca"')} AS brand, {_plain('"Modelo"')} AS model,
    CAST("Precios" AS DOUBLE) AS price, CAST("Cilindrada_CV" AS DOUBLE) AS cv FROM price_raw""",
)
def prc_normalise(spark, sf_dir):
    df = P.normalise(view(spark, sf_dir, "price_raw"))
    return df.select("p_partkey", c("Marca").alias("brand"), c("Modelo").alias("model"), c("Precios").alias("price"), c("Cilindrada_CV").alias("cv"))


_NORM = f"""nm AS (SELECT p_partkey, {_plain('"Marca"')} AS "Marca", {_plain('"Modelo"')} AS "Modelo_Cube" FROM price_raw)"""


@register(
    "prc_join_segment",
    f"""{cte('price_raw', 'segment_book', 'segment_history')}, {_BOOK}, {_MERGED}, {_NORM}
    SELECT p_partkey, "Marca", "Modelo_Cube" AS "Modelo", "Segmento" FROM nm LEFT JOIN merged USING ("Marca", "Modelo_Cube")""",
)
def prc_join_segment(spark, sf_dir):
    df = P.normalise(view(spark, sf_dir, "price_raw")).select("p_partkey", "Marca", "Modelo")
    return P.join_segment(df, _merged(spark, sf_dir)).select("p_partkey", "Marca", "Modelo", "Segmento")


_PUBLISHED = f"""{cte('price_raw', 'segment_book', 'segment_history')}, {_BOOK}, {_MERGED}, {_SPLIT},
    fin AS (SELECT p_partkey, {_plain('"Marca"')} AS "Marca", {_plain('m')} AS "Modelo_Cube", x, {_CODES} AS fuel,
      CAST(coalesce(CAST("Cilindrada_CV" AS DOUBLE), 0) AS INT) AS cv, CAST("Precios" AS DOUBLE) AS price,
      CAST({_STAR} AS INT) AS s, CAST({_END} AS INT) AS e FROM sp WHERE ({_CODES}) IS NOT NULL AND {_END} >= 2005),
    pub AS (SELECT p_partkey, "Marca" AS "Brand", "Modelo_Cube" AS "Model", cv AS "CV", fuel AS "Fuel", price AS "Price", x AS "Features",
      "Segmento" AS "Segment", s AS "StarDate", e AS "EndDate" FROM fin LEFT JOIN merged USING ("Marca", "Modelo_Cube"))
"""


@register("prc_publish", f"{_PUBLISHED} SELECT * FROM pub")
def prc_publish(spark, sf_dir):
    return P.build_price_list(view(spark, sf_dir, "price_raw"), _merged(spark, sf_dir), AS_OF, ("p_partkey",))[0]


@register("prc_publish_known", f'{_PUBLISHED} SELECT * FROM pub WHERE "Segment" IS NOT NULL')
def prc_publish_known(spark, sf_dir):
    return P.build_price_list(view(spark, sf_dir, "price_raw"), _merged(spark, sf_dir), AS_OF, ("p_partkey",))[1]


# Compatibility forms, which plain decomposition would leave as they are, in front of every name.
_COMPATIBLE = {"ﬁ": "fi", "Ⅳ": "IV", "²": "2", "Ｇ": "G", "½": "1⁄2", "…": "..."}


@register(
    "prc_unicode_norm",
    f"""{cte("price_raw")} SELECT p_partkey, nfc_normalize("Modelo") AS model, list_extract({list(_COMPATIBLE.values())}, CAST(p_partkey % {len(_COMPATIBLE)} AS INT) + 1) || strip_accents("Modelo") AS letters
    FROM price_raw""",
)
def prc_unicode_norm(spark, sf_dir):
    # The SQL side composes again, so the decomposed text is checked through its letters and its composed form.
    sign = F.element_at(F.array(*map(F.lit, _COMPATIBLE)), (c("p_partkey") % len(_COMPATIBLE)).cast("int") + 1)
    df = view(spark, sf_dir, "price_raw").select("p_partkey", c("Modelo").alias("model"), nfkd(F.concat(sign, c("Modelo"))).alias("d"))
    return df.select("p_partkey", "model", F.regexp_replace("d", r"\p{Mn}", "").alias("letters"))


# -- bags and dictionaries ------------------------------------------------


def _bag_sql(x, shortest=1, upper=True):
    keep = (
        f"t <> '' AND (trim(replace(t, '(', '')) = '' OR (length(trim(replace(t, '(', ''))) > {shortest} "
        "AND NOT regexp_matches(trim(replace(t, '(', '')), '^[0-9]')))"
    )
    return f"list_transform(list_filter(string_split({x}, ' '), lambda t: {keep}), lambda t: upper(t))"


@register("txt_bag", f"{cte('listing')} SELECT l_orderkey, l_linenumber, array_to_string({_bag_sql('\"Features\"')}, ' ') AS bag FROM listing")
def txt_bag(spark, sf_dir):
    return view(spark, sf_dir, "listing").select(*ROW, bag(c("Features")).alias("bag"))


_WORD = "regexp_replace(coalesce(string_split(t, '/')[2], t), '[^A-Za-z0-9]', '', 'g')"


_KEYWORD_CTES = f"""w AS (SELECT "Brand", "Model", unnest({_bag_sql("coalesce(\"Features\", '-')", 3)}) AS t FROM price_list),
    k AS (SELECT DISTINCT "Brand", "Model", {_WORD} AS word FROM w), ok AS (SELECT * FROM k WHERE length(word) >= 3 AND NOT regexp_matches(word, '[0-9]')),
    b AS (SELECT DISTINCT "Brand", "Model" FROM price_list)"""
_KEYWORDS = """SELECT b."Brand", b."Model", coalesce(string_agg(word, ' ' ORDER BY word), '') AS words
    FROM b LEFT JOIN ok ON b."Brand" = ok."Brand" AND b."Model" = ok."Model" GROUP BY 1, 2"""


@register("dic_keywords", f"{cte('price_list')}, {_KEYWORD_CTES} {_KEYWORDS}")
def dic_keywords(spark, sf_dir):
    df = D.keywords(view(spark, sf_dir, "price_list"))
    return df.select("Brand", "Model", F.array_join("Words", " ").alias("words"))


_OFFERED = f"""SELECT DISTINCT {_alnum('"Brand"')} AS "Brand", {_alnum('"Model"')} AS "Model", "CV" FROM listing
      WHERE "Province" = 'LAS PALMAS' AND "CV" IS NOT NULL"""
_POWERS = f"""SELECT "Brand", "Model", string_agg(CAST(CAST("CV" AS INT) AS VARCHAR), ' ' ORDER BY "CV") AS powers FROM o
    WHERE "Model" IN (SELECT {_alnum('"Model"')} FROM price_list) GROUP BY 1, 2"""


@register("dic_power", f"{cte('listing', 'price_list')}, o AS ({_OFFERED}) {_POWERS}")
def dic_power(spark, sf_dir):
    df = D.powers(view(spark, sf_dir, "listing"), view(spark, sf_dir, "price_list"))
    return df.select("Brand", "Model", F.array_join(F.transform("Powers", lambda v: v.cast("int").cast("string")), " ").alias("powers"))


@register(
    "dic_save",
    f"""{cte('price_list', 'listing')}, {_KEYWORD_CTES}, o AS ({_OFFERED})
    SELECT 'bags' AS saved, CAST(p_partkey AS VARCHAR) AS item, array_to_string({_bag_sql("coalesce(\"Features\", '-')")}, ' ') AS words FROM price_list
    UNION ALL SELECT 'keywords', "Brand" || '/' || "Model", words FROM ({_KEYWORDS}) k
    UNION ALL SELECT 'powers', "Brand" || '/' || "Model", powers FROM ({_POWERS}) p""",
)
def dic_save(spark, sf_dir):
    folder = f"{shared_dir(spark).rstrip('/')}/check-{uuid.uuid4().hex}"
    paths = D.save(view(spark, sf_dir, "price_list"), view(spark, sf_dir, "listing"), folder)
    saved = {name: spark.read.parquet(path) for name, path in paths.items()}
    item = F.concat("Brand", F.lit("/"), "Model").alias("item")
    parts = [
        saved["bags"].select(F.lit("bags").alias("saved"), c("p_partkey").cast("string").alias("item"), c("Bags").alias("words")),
        saved["keywords"].select(F.lit("keywords"), item, F.array_join("Words", " ")),
        saved["powers"].select(F.lit("powers"), item, F.array_join(F.transform("Powers", lambda v: v.cast("int").cast("string")), " ")),
    ]
    return reduce(lambda x, y: x.union(y), parts)


@register(
    "map_model_segment",
    f"""{cte('listing')} SELECT "Brand", "Model", arg_min("Segment", CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) || "Segment") AS "Segment"
    FROM listing WHERE "Brand" IS NOT NULL AND "Model" IS NOT NULL AND "Segment" IS NOT NULL GROUP BY 1, 2""",
)
def map_model_segment(spark, sf_dir):
    df = view(spark, sf_dir, "listing")
    seq = F.concat(c("l_orderkey").cast("string"), F.lit("/"), c("l_linenumber").cast("string"), c("Segment")).alias("seq")
    return D.model_segments(df.select("Brand", "Model", "Segment", seq), ["seq"])


# -- matching -------------------------------------------------------------

_SIGS = f"""sg AS (SELECT DISTINCT "Brand", "Model", "CV", "Fuel", "Registration", array_to_string({_bag_sql("coalesce(\"Features\", '')")}, ' ') AS "Bag" FROM listing),
si AS (SELECT *, row_number() OVER (ORDER BY "Brand", "Model", "CV", "Fuel", "Registration", "Bag") AS sid, string_split("Bag", ' ') AS ws FROM sg),
pl AS (SELECT *, array_to_string({_bag_sql("coalesce(\"Features\", '-')")}, ' ') AS pbag FROM price_list)"""
# One flag per greedy step, read as one binary number: the survivors are the rows of the largest number.
_FLAGS = (
    "CAST(coalesce(p.\"Brand\" = s.\"Brand\", false) AS BIGINT) * 16384 + CAST(coalesce(p.\"Model\" = s.\"Model\", false) AS BIGINT) * 8192 + "
    "CAST(coalesce(p.\"CV\" = s.\"CV\", false) AS BIGINT) * 4096 + CAST(coalesce(p.\"Fuel\" = s.\"Fuel\", false) AS BIGINT) * 2048 + "
    "CAST(coalesce(s.\"Registration\" BETWEEN p.\"StarDate\" AND p.\"EndDate\", false) AS BIGINT) * 1024 + "
    + " + ".join(f"CAST(coalesce(contains(p.pbag, s.ws[{i + 1}]), false) AS BIGINT) * {2 ** (9 - i)}" for i in range(10))
)
_SURVIVE = f"""{cte('listing', 'price_list')}, {_SIGS},
fl AS (SELECT s.sid, p.p_partkey, p."CV" AS pcv, p."Price" AS price, {_FLAGS} AS f FROM si s, pl p),
mx AS (SELECT sid, max(f) AS f FROM fl GROUP BY 1),
sv AS (SELECT fl.sid, p_partkey, pcv, price FROM fl JOIN mx ON fl.sid = mx.sid AND fl.f = mx.f),
nr AS (SELECT sv.sid, arg_min(pcv, abs(pcv - "CV") * 1000000000 + p_partkey) AS near FROM sv JOIN si ON sv.sid = si.sid WHERE "CV" IS NOT NULL GROUP BY 1),
md AS (SELECT sv.sid, median(price) AS "PriceMed" FROM sv LEFT JOIN nr ON sv.sid = nr.sid WHERE near IS NULL OR pcv = near GROUP BY 1)
"""


def _matched(spark, sf_dir):
    signed = M.with_signature(view(spark, sf_dir, "listing"))
    final, survivors = M.match(signed, view(spark, sf_dir, "price_list"), "p_partkey")
    return signed.select("sig", *M.SIGNATURE).distinct(), final, survivors


@register(
    "lvl_match",
    f"""{_SURVIVE} SELECT "Brand", "Model", "CV", "Fuel", "Registration", "Bag", count(*) AS n, CAST(sum(p_partkey) AS BIGINT) AS id_sum
    FROM sv JOIN si ON sv.sid = si.sid GROUP BY 1, 2, 3, 4, 5, 6""",
)
def lvl_match(spark, sf_dir):
    signatures, final, survivors = _matched(spark, sf_dir)
    sizes = survivors.rows.groupBy("cls").agg(F.sum("n").alias("n"), F.sum("id_sum").alias("id_sum"))
    sets = survivors.sets.join(sizes, "cls").groupBy("state").agg(F.sum("n").alias("n"), F.sum("id_sum").alias("id_sum"))
    return signatures.join(final.select("sig", "state"), "sig").join(sets, "state").select(*M.SIGNATURE, "n", "id_sum")


@register(
    "lvl_nearest",
    f"""{_SURVIVE} SELECT "Brand", "Model", "CV", "Fuel", "Registration", "Bag", CAST(near AS DOUBLE) AS near FROM si JOIN nr ON si.sid = nr.sid""",
)
def lvl_nearest(spark, sf_dir):
    signatures, final, survivors = _matched(spark, sf_dir)
    near = M.nearest_power(final, survivors)
    return final.join(near, ["state", "CV"]).select("sig", "near").join(signatures, "sig").select(*M.SIGNATURE, "near")


@register(
    "lvl_median",
    f"""{_SURVIVE} SELECT l.l_orderkey, l.l_linenumber, round("PriceMed", 6) AS "PriceMed" FROM listing l JOIN si s ON l."Brand" IS NOT DISTINCT FROM s."Brand"
    AND l."Model" IS NOT DISTINCT FROM s."Model" AND l."CV" IS NOT DISTINCT FROM s."CV" AND l."Fuel" IS NOT DISTINCT FROM s."Fuel"
    AND l."Registration" = s."Registration" AND array_to_string({_bag_sql("coalesce(l.\"Features\", '')")}, ' ') = s."Bag" JOIN md ON md.sid = s.sid""",
)
def lvl_median(spark, sf_dir):
    df = M.price_level(view(spark, sf_dir, "listing"), view(spark, sf_dir, "price_list"), "p_partkey")
    return df.select(*ROW, F.round("PriceMed", 6).alias("PriceMed"))
