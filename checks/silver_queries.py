"""Cleaning rules, filters, joins, keys and the whole silver job, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import ORACLE, register
from checks.views import AS_OF, cte, view
from tasador import schemas
from tasador.functions import rules
from tasador.functions.text import capitalise, fold_accents, number, strip
from tasador.operators import keyed
from tasador.operators import numbers as N
from tasador.plans import silver as S
from tasador.session import shared_dir

ROW = ["l_orderkey", "l_linenumber"]
TS = f"TIMESTAMP '{AS_OF}'"


def c(name):
    return F.col(name)


# -- SQL spelling helpers -------------------------------------------------


def cap(x):
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


def tok(x, n):
    return f"string_split({x}, ' ')[{n}]"


NUM = r"'^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"


def num(x):
    return f"(CASE WHEN regexp_matches({x}, {NUM}) THEN TRY_CAST({x} AS DOUBLE) END)"


def ts_text(col):
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def sql_ts(x):
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


SQL_BRAND0 = f"replace(replace({cap('Marca')}, '-', ' '), 'Mercedes benz', 'Mercedes')"
SQL_FUEL0 = "upper(strip_accents(Combustible))"
SQL_FUEL = (
    "CASE WHEN contains({f}, 'HIBRIDO') OR contains({f}, 'ELECTRICO') THEN 'ELECTRICO/HIBRIDO' "
    "WHEN {f} IN ('GASOLINA', 'DIESEL', 'ELECTRICO/HIBRIDO', 'GLP') THEN {f} END"
)
SQL_GEAR = (
    "CASE WHEN {g} = 'Manual' THEN 'Manual' WHEN {g} IN ('Automatico', 'Semiautomatico', 'Doble embrague', "
    "'Semi-automatico') THEN 'Automático' END"
)
SQL_CV_NUM = (
    "CASE WHEN length({v}) BETWEEN 2 AND 3 AND regexp_matches({v}, '^[0-9]') AND NOT contains(lower({v}), 'w') "
    "THEN " + num("{v}").replace("{", "{{").replace("}", "}}").replace("{{v}}", "{v}") + " END"
)
SQL_SHIFT = "coalesce(contains(AnyoMatriculacion, 'enchufable') AND Kms IS NOT NULL, false)"
SQL_YEAR0 = f"CASE WHEN {SQL_SHIFT} THEN {tok('Kms', 1)} ELSE AnyoMatriculacion END"
SQL_KMS0 = f"CASE WHEN {SQL_SHIFT} THEN coalesce({tok('Kms', 2)}, Kms) ELSE Kms END"
SQL_PUB = (
    "CASE WHEN Publicacion IS NULL THEN strftime(" + TS + ", '%Y/%d/%m %H:%M') ELSE "
    "CAST(coalesce(TRY_CAST(PublicacionAnyo AS BIGINT), year(" + TS + ")) AS VARCHAR) || '/' || Publicacion END"
)
SQL_PRICE = "CASE WHEN instr({p}, '.') = 0 OR length({p}) - instr({p}, '.') = 3 THEN {p} END"
SQL_FAMILY = "CASE WHEN regexp_matches(lower({m}), 'clase|santa|mini|grand|serie|land') THEN {m} ELSE string_split({m}, ' ')[1] END"


def bronze_rule(name: str, sql: str, columns):
    """A rule applied to every raw listing."""

    @register(name, f"{cte('bronze')} SELECT l_orderkey, l_linenumber, {sql} FROM bronze ")
    def query(spark, sf_dir):
        return view(spark, sf_dir, "bronze").select(*ROW, *columns())

    return query


bronze_rule(
    "cln_brand_prep",
    f"{SQL_BRAND0} AS brand, replace(Cilindrada, ' CV', '') AS cv",
    lambda: [rules.brand_prep(c("Marca")).alias("brand"),
    rules.cv_prep(c("Cilindrada")).alias("cv")],
)
bronze_rule(
    "cln_brand_digit",
    "CASE WHEN length(Marca) > 0 AND NOT regexp_matches(Marca, '^[0-9]') THEN Marca END AS brand",
    lambda: [rules.brand_digit(c("Marca")).alias("brand")],
)
bronze_rule(
    "cln_fuel",
    SQL_FUEL.format(f=SQL_FUEL0) + " AS fuel",
    lambda: [rules.fuel(rules.fuel_plain(c("Combustible"))).alias("fuel")],
)
bronze_rule(
    "cln_gearbox",
    SQL_GEAR.format(g="trim(strip_accents(Caja))") + " AS gearbox",
    lambda: [rules.gearbox(rules.gear_plain(c("Caja"))).alias("gearbox")],
)
_CV = SQL_CV_NUM.format(v="replace(Cilindrada, ' CV', '')")
bronze_rule(
    "cln_cv",
    f"CASE WHEN {_CV} < 50 THEN {_CV} + 100 ELSE {_CV} END AS cv",
    lambda: [rules.cv(rules.cv_prep(c("Cilindrada"))).alias("cv")],
)
bronze_rule(
    "cln_price_text",
    SQL_PRICE.format(p="trim(Precio)") + " AS price",
    lambda: [rules.price_text(strip(c("Precio"))).alias("price")],
)
bronze_rule("cln_plugin_shift", f"{SQL_YEAR0} AS year_text, {SQL_KMS0} AS kms_text", lambda: [*[col.alias(n) for col, n in zip(rules.plugin_shift(c("AnyoMatriculacion"), c("Kms")), ["year_text", "kms_text"])]])
_SQL_YEAR_PART = "CASE WHEN contains(AnyoMatriculacion, '/') THEN string_split(AnyoMatriculacion, '/')[2] ELSE AnyoMatriculacion END"
bronze_rule(
    "cln_year_slash",
    f"CASE WHEN length({_SQL_YEAR_PART}) = 4 THEN {_SQL_YEAR_PART} END AS year_text",
    lambda: [rules.year_length(rules.year_part(c("AnyoMatriculacion"))).alias("year_text")],
)
bronze_rule(
    "cln_publication",
    SQL_PUB + " AS publication",
    lambda: [rules.publication_text(c("Publicacion"), c("PublicacionAnyo"), S.stamp(AS_OF)).alias("publication")],
)
bronze_rule(
    "cln_model_default",
    f"coalesce(Modelo, {tok('Caracteristicas', 1)}) AS model",
    lambda: [rules.model_default(c("Modelo"), c("Caracteristicas")).alias("model")],
)
bronze_rule(
    "cln_model_ascii",
    "strip_accents(Modelo) AS model, strip_accents(Combustible) AS fuel",
    lambda: [fold_accents(c("Modelo")).alias("model"),
    fold_accents(c("Combustible")).alias("fuel")],
)
bronze_rule(
    "cln_alfa_model",
    f"CASE WHEN lower(Marca) = 'alfa' THEN coalesce({tok('Modelo', 2)}, Modelo) ELSE Modelo END AS model",
    lambda: [rules.alfa_model(c("Marca"), c("Modelo")).alias("model")],
)
bronze_rule("cln_family", SQL_FAMILY.format(m="Modelo") + " AS family", lambda: [rules.family(c("Modelo")).alias("family")])


def _named(fam, brand, features):
    return (
        f"CASE WHEN lower({fam}) = 'range' THEN 'Range Rover' WHEN lower({fam}) = 'serie' THEN {fam} || ' ' || "
        f"coalesce({tok(features, 1)}, 'None') WHEN {brand} = 'Mercedes' AND length({fam}) = 1 THEN 'Clase ' || {fam} "
        f"ELSE {fam} END"
    )


_LAND = (
    "CASE WHEN contains(lower({x}), 'hiace') THEN 'Hiace' WHEN {x} IS NOT NULL AND lower({f}) = 'land' "
    "THEN 'Land Cruiser' ELSE {k} END"
)


@register(
    "cln_family_rules",
    f"""{cte('bronze')},
    a AS (SELECT l_orderkey, l_linenumber, {SQL_BRAND0} AS brand, Modelo AS model, Caracteristicas AS x,
            {SQL_FAMILY.format(m='Modelo')} AS fam FROM bronze),
    b AS (SELECT *, {_LAND.format(x='x', f='fam', k='model')} AS m1, {_LAND.format(x='x', f='fam', k='fam')} AS f1 FROM a),
    d AS (SELECT *, CASE WHEN lower(f1) = 'space' THEN 'Space Star' ELSE m1 END AS m2,
            CASE WHEN lower(f1) = 'space' THEN 'Space Star' ELSE f1 END AS f2 FROM b),
    e AS (SELECT *, {_named('f2', 'brand', 'x')} AS f3 FROM d),
    g AS (SELECT *, CASE WHEN contains(lower(f3), 'nuevo') THEN coalesce({tok('x', 1)}, f3) ELSE f3 END AS f4 FROM e)
    SELECT l_orderkey, l_linenumber, m2 AS model,
      CASE WHEN f4 = 'Audi' THEN coalesce({tok('x', 1)}, f4) ELSE f4 END AS family FROM g""",
)
def cln_family_rules(spark, sf_dir):
    df = view(spark, sf_dir, "bronze").select(
        *ROW, rules.brand_prep(c("Marca")).alias("brand"), c("Modelo").alias("model"), c("Caracteristicas").alias("x")
    )
    df = df.withColumn("family", rules.family(c("model")))
    m, f = rules.land_family(c("model"), c("family"), c("x"))
    df = df.withColumns({"model": m, "family": f})
    m, f = rules.space_family(c("model"), c("family"))
    df = df.withColumns({"model": m, "family": f})
    df = df.withColumn("family", rules.named_family(c("brand"), c("family"), c("x")))
    df = df.withColumn("family", rules.new_family(c("family"), c("x")))
    return df.select(*ROW, "model", rules.audi_family(c("family"), c("x")).alias("family"))


bronze_rule(
    "cln_link_check",
    "CASE WHEN Links IS NOT NULL AND Marca IS NOT NULL AND Modelo IS NOT NULL AND Caracteristicas IS NOT NULL AND Web IS NOT NULL AND "
    "(contains(lower(Links), lower(Marca)) OR contains(lower(Links), lower(Modelo)) OR contains(lower(Links), lower(Caracteristicas)) "
    "OR contains(lower(Links), lower(Web))) THEN Links END AS link",
    lambda: [rules.link_check(c("Links"), c("Marca"), c("Modelo"), c("Caracteristicas"), c("Web")).alias("link")],
)
_FINISH = (
    "CASE WHEN {m} IS NULL THEN NULL WHEN {x} IS NULL THEN {m} ELSE array_to_string(list_concat([{m}], "
    "list_filter(string_split({x}, ' '), lambda t: length(t) > 4)), ' ') END"
)
bronze_rule(
    "cln_finish_append",
    _FINISH.format(m="Modelo", x="Caracteristicas") + " AS finish",
    lambda: [rules.finish_append(c("Modelo"), c("Caracteristicas")).alias("finish")],
)
_TRIM = ["Precio", "Marca", "Kms", "Combustible", "Caja", "AnyoMatriculacion", "Provincia", "Financiado"]
bronze_rule(
    "cln_trim_all",
    f"trim({cap('Modelo')}) AS \"Modelo\", trim({cap('Caracteristicas')}) AS \"Caracteristicas\", "
    + ", ".join(f'trim({n}) AS "{n}"' for n in _TRIM),
    lambda: [*[strip(capitalise(c(n))).alias(n) for n in ("Modelo", "Caracteristicas")],
    *[strip(c(n)).alias(n) for n in _TRIM]],
)
_PARSE = "try_strptime({x}, '%Y/%d/%m %H:%M')"
bronze_rule(
    "cln_parse_dates",
    f"{sql_ts(_PARSE.format(x='(' + SQL_PUB + ')'))} AS publication, {sql_ts('CAST(ExtractedDate AS TIMESTAMP)')} AS extracted",
    lambda: [ts_text(rules.parse_publication(rules.publication_text(c("Publicacion"), c("PublicacionAnyo"), S.stamp(AS_OF)))).alias("publication"),
    ts_text(c("ExtractedDate").cast("timestamp")).alias("extracted")],
)
bronze_rule(
    "cln_digits",
    "replace(Kms, '.', '') AS kms, replace(Precio, '.', '') AS price",
    lambda: [rules.drop_dots(c("Kms")).alias("kms"),
    rules.drop_dots(c("Precio")).alias("price")],
)
_BRAND_MAP = (
    "CASE WHEN contains(lower({b}), 'opel') THEN 'Opel' WHEN contains(lower({b}), 'hyundai') THEN 'Hyundai' "
    "WHEN {b} = 'Land' THEN 'Land rover' WHEN {b} = 'Citroën' THEN 'Citroen' WHEN {b} = 'Alfa' THEN 'Alfa romeo' ELSE {b} END"
)
bronze_rule("cln_brand_map", _BRAND_MAP.format(b=cap("Marca")) + " AS brand", lambda: [rules.brand_map(capitalise(c("Marca"))).alias("brand")])


@register(
    "cln_kms_digit",
    f"{cte('bronze')} SELECT l_orderkey, l_linenumber, replace(trim(Kms), '.', '') AS kms FROM bronze "
    "WHERE regexp_matches(replace(trim(Kms), '.', ''), '^[0-9]+$')",
)
def cln_kms_digit(spark, sf_dir):
    df = view(spark, sf_dir, "bronze").select(*ROW, rules.drop_dots(strip(c("Kms"))).alias("kms"))
    return df.filter(rules.kms_digit(c("kms")))


bronze_rule(
    "cln_null_tokens",
    "CASE WHEN coalesce(Marca, 'None') NOT IN ('nan', 'None') THEN Marca END AS brand, "
    "CASE WHEN coalesce(Modelo, 'nan') NOT IN ('nan', 'None') THEN Modelo END AS model",
    lambda: [rules.null_token(F.coalesce(c("Marca"), F.lit("None"))).alias("brand"),
    rules.null_token(F.coalesce(c("Modelo"), F.lit("nan"))).alias("model")],
)
_NUMERIC = {"kms": "Kms", "price": "Precio", "registration": "AnyoMatriculacion", "cv": "Cilindrada"}
bronze_rule(
    "cln_numeric",
    ", ".join(f"{num(v)} AS {k}" for k, v in _NUMERIC.items()),
    lambda: [*[number(c(v)).alias(k) for k, v in _NUMERIC.items()]],
)
_UP = ["Marca", "Modelo", "Caracteristicas", "Combustible", "Caja", "Provincia", "Web"]
bronze_rule("cln_upper", ", ".join(f'upper({n}) AS "{n}"' for n in _UP), lambda: [*[F.upper(c(n)).alias(n) for n in _UP]])
bronze_rule("cln_link_anchor", "replace(Links, '#fotos', '') AS link", lambda: [rules.link_anchor(c("Links")).alias("link")])
bronze_rule(
    "cln_model_override",
    "CASE WHEN contains(coalesce(upper(Caracteristicas), ''), 'MITO') THEN 'MITO' WHEN contains(lower(Modelo), 'santa') THEN 'SANTA FE' "
    "WHEN contains(lower(Modelo), 'rover') THEN 'RANGE ROVER' ELSE upper(Modelo) END AS model",
    lambda: [rules.model_override(F.upper(c("Modelo")), F.upper(c("Caracteristicas"))).alias("model")],
)
bronze_rule(
    "cln_klasse",
    "trim(replace(replace(upper(Modelo), 'KLASSE', ''), 'CLASE', '')) AS model",
    lambda: [rules.klasse(F.upper(c("Modelo"))).alias("model")],
)
_BEM = (
    "CASE WHEN {b} = {m} THEN CASE WHEN {b} = coalesce(upper(string_split({x}, ' ')[1]), {x}) "
    "THEN coalesce(upper(string_split({x}, ' ')[2]), {x}) ELSE coalesce(upper(string_split({x}, ' ')[1]), {x}) END ELSE {m} END"
)
bronze_rule(
    "cln_brand_eq_model",
    _BEM.format(b="upper(Marca)", m="upper(Modelo)", x="upper(Caracteristicas)") + " AS model",
    lambda: [rules.brand_eq_model(F.upper(c("Marca")), F.upper(c("Modelo")), F.upper(c("Caracteristicas"))).alias("model")],
)
_BRAND_FINAL = (
    "CASE WHEN contains({b}, 'RENAULT') THEN 'RENAULT' WHEN {b} = 'VW' THEN 'VOLKSWAGEN' WHEN {b} = 'ASTON' THEN 'ASTONMARTIN' "
    "WHEN {b} = 'DSAUTOMOBILES' THEN 'DS' WHEN regexp_matches({b}, '^[\\p{{L}}\\p{{N}}_\\s]*$') AND {b} NOT IN ('NO SE SABE', 'NOSESABE') THEN {b} END"
)
_MODEL_FINAL = (
    "replace(replace(CASE WHEN {m} = 'CEE''D' THEN 'CEED' WHEN {m} = 'UP!' THEN 'UP' WHEN regexp_matches({m}, '^ID\\.[1-9]+$') "
    "THEN replace({m}, '.', '') WHEN trim({m}) <> '' AND {m} NOT IN ('NUEVO', '|') THEN {m} END, '-', ''), ' ', '')"
)
_SPACELESS = "replace(trim(upper(Marca)), ' ', '')"


@register(
    "cln_brand_final",
    f"{cte('bronze')}, f AS (SELECT l_orderkey, l_linenumber, {_BRAND_FINAL.format(b=_SPACELESS)} AS brand FROM bronze) "
    "SELECT * FROM f WHERE brand IS NOT NULL",
)
def cln_brand_final(spark, sf_dir):
    df = view(spark, sf_dir, "bronze").select(*ROW, rules.brand_final(rules.spaceless(F.upper(c("Marca")))).alias("brand"))
    return df.dropna(subset=["brand"])


@register(
    "cln_model_final",
    f"{cte('bronze')}, f AS (SELECT l_orderkey, l_linenumber, {_MODEL_FINAL.format(m='upper(Modelo)')} AS model FROM bronze) "
    "SELECT * FROM f WHERE model IS NOT NULL",
)
def cln_model_final(spark, sf_dir):
    df = view(spark, sf_dir, "bronze").select(*ROW, rules.model_final(F.upper(c("Modelo"))).alias("model"))
    return df.dropna(subset=["model"])


bronze_rule(
    "cln_gear_final",
    "CASE WHEN lower(Caja) = 'automático' THEN 'AUTOMATICO' ELSE Caja END AS gearbox",
    lambda: [rules.gear_final(c("Caja")).alias("gearbox")],
)
bronze_rule(
    "cln_sale_case",
    f"CASE WHEN Venta IN ('PROFESIONAL', 'PARTICULAR') THEN {cap('Venta')} ELSE Venta END AS sale",
    lambda: [rules.sale_case(c("Venta")).alias("sale")],
)
bronze_rule(
    "cln_pub_clamp",
    f"{sql_ts('least(coalesce(p, CAST(ExtractedDate AS TIMESTAMP)), CAST(ExtractedDate AS TIMESTAMP))')} AS publication",
    lambda: [ts_text(
        rules.publication_clamp(
            rules.parse_publication(rules.publication_text(c("Publicacion"), c("PublicacionAnyo"), S.stamp(AS_OF))),
            c("ExtractedDate").cast("timestamp"),
        )
    ).alias("publication")],
)
ORACLE["cln_pub_clamp"] = ORACLE["cln_pub_clamp"].replace(
    " FROM bronze ", f" FROM (SELECT *, {_PARSE.format(x='(' + SQL_PUB + ')')} AS p FROM bronze) b "
)


@register(
    "cln_rename",
    f"{cte('bronze')} SELECT l_orderkey, l_linenumber, "
    + ", ".join(f'"{a}" AS "{b}"' for a, b in schemas.BRONZE_TO_SILVER_NAMES.items())
    + " FROM bronze",
)
def cln_rename(spark, sf_dir):
    return S.rename_bronze(view(spark, sf_dir, "bronze")).select(*ROW, *schemas.BRONZE_TO_SILVER_NAMES.values())


# -- rules and filters on typed listings ----------------------------------


@register(
    "cln_age",
    f'{cte("listing")} SELECT l_orderkey, l_linenumber, CAST(year("ExtractedDate") - "Registration" AS BIGINT) AS age FROM listing',
)
def cln_age(spark, sf_dir):
    return view(spark, sf_dir, "listing").select(*ROW, rules.age(c("ExtractedDate"), c("Registration")).alias("age"))


@register(
    "cln_cicar_kms",
    f"""{cte('listing')}, ratio AS (SELECT "Segment", CAST(count(*) AS DOUBLE) AS r FROM listing WHERE "Segment" IS NOT NULL GROUP BY 1)
    SELECT l_orderkey, l_linenumber, "Web" AS web,
      CAST(CASE WHEN "Web" = 'CICAR' THEN coalesce(trunc("Age" * r), "Kms") ELSE "Kms" END AS BIGINT) AS kms
    FROM listing LEFT JOIN ratio USING ("Segment")""",
)
def cln_cicar_kms(spark, sf_dir):
    df = view(spark, sf_dir, "listing")
    ratios = df.dropna(subset=["Segment"]).groupBy("Segment").agg(F.count(F.lit(1)).cast("double").alias("Ratio_Kms_Age"))
    return S.estimate_kms(df, ratios).select(*ROW, c("Web").alias("web"), c("Kms").alias("kms"))


@register(
    "cln_types",
    f"""{cte('bronze')} SELECT l_orderkey, l_linenumber, TRY_CAST(replace(trim("Kms"), '.', '') AS BIGINT) AS "Kms",
      {num('"Precio"')} AS "Price", CAST("ExtractedDate" AS VARCHAR) || ' 00:00:00' AS "ExtractedDate",
      CAST(NULL AS VARCHAR) AS "Segment" FROM bronze WHERE regexp_matches(replace(trim("Kms"), '.', ''), '^[0-9]+$')""",
)
def cln_types(spark, sf_dir):
    df = view(spark, sf_dir, "bronze").withColumn("Kms", rules.drop_dots(strip(c("Kms"))))
    df = df.filter(rules.kms_digit(c("Kms"))).withColumnRenamed("Precio", "Price")
    wide = df.withColumn("Price", F.when(c("Price").rlike(r"^\s*[0-9.]+\s*$"), c("Price")))
    keep = ["Kms", "Price", "ExtractedDate", "Segment"]
    schema = [f for f in schemas.SILVER if f.name in keep]
    ids = [T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType())]
    out = S.typed(wide, T.StructType(ids + schema))
    return out.withColumn("ExtractedDate", ts_text(c("ExtractedDate")))


def listing_filter(name, where, predicate, view_name="listing", columns=ROW):
    @register(name, f"{cte(view_name)} SELECT {', '.join(columns)} FROM {view_name} WHERE {where}")
    def query(spark, sf_dir):
        return view(spark, sf_dir, view_name).filter(predicate()).select(*columns)


@register("flt_recent", f"{cte('bronze')} SELECT l_orderkey, l_linenumber FROM bronze WHERE \"ExtractedDate\" >= DATE '2024-01-01'")
def flt_recent(spark, sf_dir):
    return S.recent(view(spark, sf_dir, "bronze"), "2024-01-01").select(*ROW)


listing_filter(
    "flt_range",
    '"Price" BETWEEN 1000 AND 150000 AND "Kms" <= 1000000 AND "Registration" >= 1990',
    lambda: rules.in_range(c("Price"), c("Kms"), c("Registration")),
)
listing_filter("flt_province", "upper(Provincia) IN ('S/C TENERIFE', 'LAS PALMAS')", lambda: rules.province_kept(F.upper(c("Provincia"))), "bronze")
listing_filter("flt_p_dot", "instr(upper(Modelo), 'P.') <> 2", lambda: rules.p_dot_kept(F.upper(c("Modelo"))), "bronze")
listing_filter(
    "flt_model_unknown",
    f"({_BRAND_FINAL.format(b=_SPACELESS)}) IS NOT NULL AND ({_MODEL_FINAL.format(m='upper(Modelo)')}) IS NOT NULL",
    lambda: rules.brand_final(rules.spaceless(F.upper(c("Marca")))).isNotNull() & rules.model_final(F.upper(c("Modelo"))).isNotNull(),
    "bronze",
)


@register(
    "flt_required",
    f"{cte('bronze')} SELECT l_orderkey, l_linenumber FROM bronze WHERE Marca IS NOT NULL AND Precio IS NOT NULL AND "
    "AnyoMatriculacion IS NOT NULL AND Provincia IS NOT NULL AND Combustible IS NOT NULL AND Caja IS NOT NULL AND Kms IS NOT NULL",
)
def flt_required(spark, sf_dir):
    return S.with_fields(S.rename_bronze(view(spark, sf_dir, "bronze"))).select(*ROW)


# -- segments, keys, survivors --------------------------------------------

_SEG_DIM = """
seg AS (SELECT b AS "Brand", m AS "Model", s AS "Segment" FROM (
  SELECT *, row_number() OVER (PARTITION BY b, m ORDER BY seq DESC) AS rn FROM (
    SELECT CASE upper(trim("Brand")) WHEN 'ALFAROMEO' THEN 'ALFA ROMEO' WHEN 'LANDROVER' THEN 'LAND ROVER'
             WHEN 'CITROËN' THEN 'CITROEN' ELSE upper(trim("Brand")) END AS b,
           CASE upper(trim("Model_Cube")) WHEN 'HI LUX' THEN 'HILUX' WHEN 'C-ELYSEE' THEN 'CELYSEE' WHEN 'C-HR' THEN 'CHR'
             WHEN '500L LIVING MPV' THEN '500L' WHEN '500X 5P' THEN '500X' ELSE upper(trim("Model_Cube")) END AS m,
           "Segment" AS s, seq FROM segment_silver) k) r WHERE rn = 1)
"""
_UPPER_BRONZE = 'up AS (SELECT l_orderkey, l_linenumber, upper(Marca) AS "Brand", upper(Modelo) AS "Model" FROM bronze)'


def _upper_bronze(spark, sf_dir):
    return view(spark, sf_dir, "bronze").select(*ROW, F.upper(c("Marca")).alias("Brand"), F.upper(c("Modelo")).alias("Model"))


def _segments(spark, sf_dir):
    # As the workbook has it, under its own headers.
    own = {name: header for header, name in schemas.SEGMENT_BOOK_NAMES.items()}
    book = view(spark, sf_dir, "segment_silver").withColumnsRenamed({n: own[n] for n in ("Brand", "Model_Cube", "Segment")})
    return S.segment_dimension(S.segment_book(book, ["seq"]), ["seq"])


@register("jn_segment", f'{cte("bronze", "segment_silver")}, {_SEG_DIM}, {_UPPER_BRONZE} SELECT up.*, "Segment" FROM up LEFT JOIN seg USING ("Brand", "Model")')
def jn_segment(spark, sf_dir):
    return keyed.lookup(_upper_bronze(spark, sf_dir), _segments(spark, sf_dir), ["Brand", "Model"]).select(*ROW, "Brand", "Model", "Segment")


_SEG_FIX = (
    "CASE WHEN contains(lower({m}), 'cooper') THEN 'A0' WHEN {m} = 'TUCSON' THEN 'SUVA' WHEN {m} = 'SANTA FE' THEN 'SUVB' ELSE {s} END"
)
bronze_rule(
    "jn_segment_fix",
    _SEG_FIX.format(m="replace(replace(upper(Modelo), ' KLASSE', ''), 'SANTA', 'SANTA FE')", s="Web") + " AS segment",
    lambda: [rules.segment_fix(c("Web"), F.replace(F.replace(F.upper(c("Modelo")), F.lit(" KLASSE"), F.lit("")), F.lit("SANTA"), F.lit("SANTA FE"))).alias("segment")],
)
_FALL_DIM = """
fall AS (SELECT b AS "Brand", m AS "Model", s AS "ListSegment" FROM (
  SELECT *, row_number() OVER (PARTITION BY b, m ORDER BY p_partkey DESC) AS rn FROM (
    SELECT replace("Brand", ' ', '') AS b, replace(replace(trim(replace(replace("Model", 'KLASSE', ''), 'CLASE', '')), '-', ''), ' ', '') AS m,
           "Segment" AS s, p_partkey FROM price_list) k) r WHERE rn = 1)
"""


@register(
    "jn_segment_fallback",
    f"""{cte('listing', 'price_list')}, {_FALL_DIM},
    l AS (SELECT l_orderkey, l_linenumber, replace("Brand", ' ', '') AS "Brand", replace(replace("Model", '-', ''), ' ', '') AS "Model", "Segment" FROM listing)
    SELECT l_orderkey, l_linenumber, "Brand", "Model", coalesce("Segment", "ListSegment") AS "Segment" FROM l LEFT JOIN fall USING ("Brand", "Model")""",
)
def jn_segment_fallback(spark, sf_dir):
    df = view(spark, sf_dir, "listing").select(
        *ROW, F.replace("Brand", F.lit(" "), F.lit("")).alias("Brand"), F.regexp_replace("Model", "[- ]", "").alias("Model"), "Segment"
    )
    dim = S.fallback_dimension(view(spark, sf_dir, "price_list"), ["p_partkey"])
    return S.fill_segment(df, dim).select(*ROW, "Brand", "Model", "Segment")


def _sql_key(parts):
    return " || ".join(f"coalesce(CAST(\"{p}\" AS VARCHAR), 'None')" for p in parts)


_SQL_ID = f"sha256({_sql_key(schemas.ID_PARTS)})"
_SQL_VEHICLE = f"sha256({_sql_key(schemas.VEHICLE_PARTS)})"


def _sql_surrogate(h):
    return f"(CAST('0x' || substr({h}, 1, 12) AS BIGINT) % 9999999)"


def _listing(spark, sf_dir):
    return view(spark, sf_dir, "listing")


# The 256-bit digest stands in for the 224-bit one of the tables: the checking engine has no SHA-224.
@register("key_id", f"{cte('listing')} SELECT l_orderkey, l_linenumber, {_SQL_ID} AS id FROM listing")
def key_id(spark, sf_dir):
    return _listing(spark, sf_dir).select(*ROW, rules.digest([c(n) for n in schemas.ID_PARTS], 256).alias("id"))


@register("key_vehicle", f"{cte('listing')} SELECT l_orderkey, l_linenumber, {_SQL_VEHICLE} AS id FROM listing")
def key_vehicle(spark, sf_dir):
    return _listing(spark, sf_dir).select(*ROW, rules.digest([c(n) for n in schemas.VEHICLE_PARTS], 256).alias("id"))


# Some vehicles are registered first, the others in a second run; each run goes on with the next numbers.
@register(
    "key_surrogate",
    f"""{cte('listing')}, k AS (SELECT l_orderkey, l_linenumber, {_SQL_VEHICLE} AS h FROM listing), e AS (SELECT h, min(CASE WHEN l_linenumber <= 3 THEN 0 ELSE 1 END) AS run FROM k GROUP BY 1),
    r AS (SELECT h, row_number() OVER (ORDER BY run, h) - 1 AS vehicle_id FROM e) SELECT l_orderkey, l_linenumber, vehicle_id FROM k JOIN r USING (h)""",
)
def key_surrogate(spark, sf_dir):
    folder = f"{shared_dir(spark).rstrip('/')}/check-{uuid.uuid4().hex}"
    key = F.unhex(rules.digest([c(n) for n in schemas.VEHICLE_PARTS], 256))
    df = _listing(spark, sf_dir)
    N.register(df.filter("l_linenumber <= 3").select(key.alias("key")), folder)
    return N.with_number(df.select(*ROW, key.alias("key")), c("key"), folder, "vehicle_id").select(*ROW, "vehicle_id")


_KEY = ", ".join(f'"{n}"' for n in schemas.SILVER_KEY)
_SHOW = ["Brand", "Model", "Features", "Fuel", "Kms", "Price", "Web"]


def _survivor_sql(keys, order, direction, source="listing"):
    nulls = "NULLS LAST" if direction == "DESC" else "NULLS FIRST"
    ranks = ", ".join(f"{o} {direction} {nulls}" for o in order)
    return (
        f"SELECT {', '.join(chr(34) + s + chr(34) for s in _SHOW)}, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {keys} ORDER BY {ranks}) AS rn FROM {source}) r WHERE rn = 1"
    )


@register("dd_id_last", f"{cte('listing')} {_survivor_sql(_SQL_ID, ['l_orderkey', 'l_linenumber'], 'DESC')}")
def dd_id_last(spark, sf_dir):
    df = _listing(spark, sf_dir).withColumn("Id", rules.digest([c(n) for n in schemas.ID_PARTS], 256))
    return keyed.keep_last(df.select("Id", *_SHOW, *ROW), ["Id"], ROW).drop("Id")


@register("dd_key_first", f"{cte('listing')} {_survivor_sql(_KEY, ['l_orderkey', 'l_linenumber'], 'ASC')}")
def dd_key_first(spark, sf_dir):
    df = _listing(spark, sf_dir).select(*schemas.SILVER_KEY, *ROW)
    return keyed.keep_first(df, schemas.SILVER_KEY, ROW).select(*_SHOW, *ROW)


# History is every listing seen up to the cut, new rows the later ones with the same keys shifted by price.
_OLD_NEW = (
    'hn AS (SELECT *, 0 AS batch FROM listing WHERE l_linenumber <= 3 UNION ALL '
    'SELECT *, 1 AS batch FROM listing WHERE l_linenumber >= 3)'
)


@register("dd_key_last", f"{cte('listing')}, {_OLD_NEW} {_survivor_sql('\"Brand\", \"Model\", \"Features\", \"Fuel\", \"Web\"', ['batch', 'l_orderkey', 'l_linenumber', '\"Kms\"', '\"Price\"'], 'DESC', 'hn')}")
def dd_key_last(spark, sf_dir):
    df = _listing(spark, sf_dir)
    both = df.filter("l_linenumber <= 3").withColumn("batch", F.lit(0)).unionByName(df.filter("l_linenumber >= 3").withColumn("batch", F.lit(1)))
    keys = ["Brand", "Model", "Features", "Fuel", "Web"]
    return keyed.keep_last(both.select("batch", *_SHOW, *ROW), keys, ["batch", *ROW]).select(*_SHOW, *ROW)


@register("un_history", f"{cte('listing')}, {_OLD_NEW} SELECT batch, l_orderkey, l_linenumber, CASE WHEN batch = 1 THEN \"Sale\" END AS sale FROM hn")
def un_history(spark, sf_dir):
    df = _listing(spark, sf_dir)
    old = df.filter("l_linenumber <= 3").select(*ROW)
    new = df.filter("l_linenumber >= 3").select(*ROW, c("Sale").alias("sale"))
    return S.with_history(new, old).withColumnRenamed("_batch", "batch")


@register(
    "agg_null_rate",
    f"""{cte('listing', 'price_list')}, {_FALL_DIM},
    l AS (SELECT replace("Brand", ' ', '') AS "Brand", replace(replace("Model", '-', ''), ' ', '') AS "Model", "Segment" FROM listing),
    f AS (SELECT coalesce("Segment", "ListSegment") AS s, "Segment" AS s0 FROM l LEFT JOIN fall USING ("Brand", "Model"))
    SELECT 'before' AS step, count(*) AS rows, count(*) FILTER (s0 IS NULL) AS gaps, round(100.0E0 * count(*) FILTER (s0 IS NULL) / count(*), 6) AS gap_pct FROM f
    UNION ALL
    SELECT 'after', count(*), count(*) FILTER (s IS NULL), round(100.0E0 * count(*) FILTER (s IS NULL) / count(*), 6) FROM f""",
)
def agg_null_rate(spark, sf_dir):
    df = _listing(spark, sf_dir).select(
        F.replace("Brand", F.lit(" "), F.lit("")).alias("Brand"), F.regexp_replace("Model", "[- ]", "").alias("Model"), "Segment"
    )
    after = S.fill_segment(df, S.fallback_dimension(view(spark, sf_dir, "price_list"), ["p_partkey"]))
    return S.segment_gaps(df, after).withColumn("gap_pct", F.round("gap_pct", 6))


@register(
    "agg_rowcount",
    f"""{cte('listing')} SELECT 'listings' AS step, count(*) AS rows FROM listing UNION ALL
    SELECT 'in range', count(*) FROM listing WHERE "Price" BETWEEN 1000 AND 150000 AND "Kms" <= 1000000 AND "Registration" >= 1990""",
)
def agg_rowcount(spark, sf_dir):
    df = _listing(spark, sf_dir)
    return S.row_counts({"listings": df, "in range": df.filter(rules.in_range(c("Price"), c("Kms"), c("Registration")))})


# -- the whole job --------------------------------------------------------

_F2 = SQL_FUEL.format(f="fuel0")
_SILVER_SQL = f"""{cte('bronze', 'segment_silver', 'price_list')}, {_SEG_DIM}, {_FALL_DIM},
r0 AS (SELECT {SQL_BRAND0} AS brand0, {SQL_FUEL0} AS fuel0, trim(strip_accents(Caja)) AS gear0, replace(Cilindrada, ' CV', '') AS cv0,
    trim(Precio) AS price0, {SQL_YEAR0} AS year0, {SQL_KMS0} AS kms0, Caracteristicas AS x,
    strip_accents(coalesce(Modelo, {tok('Caracteristicas', 1)})) AS model0, {SQL_PUB} AS pub0, ExtractedDate, Provincia, Financiado, Web, Venta, Links
  FROM bronze WHERE ExtractedDate >= DATE '2024-01-01'),
r1 AS (SELECT *, CASE WHEN length(brand0) > 0 AND NOT regexp_matches(brand0, '^[0-9]') THEN brand0 END AS brand1, {_F2} AS fuel1,
    {SQL_GEAR.format(g='gear0')} AS gear1, {SQL_CV_NUM.format(v='cv0')} AS cv1, {SQL_PRICE.format(p='price0')} AS price1,
    CASE WHEN contains(year0, '/') THEN string_split(year0, '/')[2] ELSE year0 END AS year1,
    CASE WHEN lower(brand0) = 'alfa' THEN coalesce({tok('model0', 2)}, model0) ELSE model0 END AS model1 FROM r0),
r2 AS (SELECT *, CASE WHEN length(year1) = 4 THEN year1 END AS year2, {SQL_FAMILY.format(m='model1')} AS fam1,
    CASE WHEN cv1 < 50 THEN cv1 + 100 ELSE cv1 END AS cv2 FROM r1),
r3 AS (SELECT *, {_LAND.format(x='x', f='fam1', k='model1')} AS m1, {_LAND.format(x='x', f='fam1', k='fam1')} AS f1 FROM r2),
r4 AS (SELECT *, CASE WHEN lower(f1) = 'space' THEN 'Space Star' ELSE m1 END AS m2,
    CASE WHEN lower(f1) = 'space' THEN 'Space Star' ELSE f1 END AS f2 FROM r3),
r5 AS (SELECT *, {_named('f2', 'brand1', 'x')} AS f3 FROM r4),
r6 AS (SELECT *, CASE WHEN contains(lower(f3), 'nuevo') THEN coalesce({tok('x', 1)}, f3) ELSE f3 END AS f4 FROM r5),
r7 AS (SELECT *, CASE WHEN brand1 IS NOT NULL AND m2 IS NOT NULL AND f4 IS NOT NULL AND Web IS NOT NULL AND Links IS NOT NULL AND
      (contains(lower(Links), lower(brand1)) OR contains(lower(Links), lower(m2)) OR contains(lower(Links), lower(f4)) OR contains(lower(Links), lower(Web)))
      THEN Links END AS link1, {_FINISH.format(m='m2', x='x')} AS fin1,
    CASE WHEN f4 = 'Audi' THEN coalesce({tok('x', 1)}, f4) ELSE f4 END AS f5 FROM r6),
t0 AS (SELECT upper({_BRAND_MAP.format(b='trim(brand1)')}) AS "Brand", upper(trim({cap('fin1')})) AS "Finish", upper(trim({cap('x')})) AS "Features",
    upper(f5) AS fam, replace(trim(kms0), '.', '') AS kms1, replace(trim(price1), '.', '') AS price2, upper(trim(fuel1)) AS "Fuel",
    upper(trim(gear1)) AS "Gearbox", cv2 AS "CV", CAST({num('trim(year2)')} AS BIGINT) AS "Registration", upper(trim(Provincia)) AS "Province",
    {_PARSE.format(x='pub0')} AS pub, CAST(ExtractedDate AS TIMESTAMP) AS "ExtractedDate", trim(Financiado) AS "Funded", upper(Web) AS "Web",
    Venta AS "Sale", replace(link1, '#fotos', '') AS "Links" FROM r7),
t1 AS (SELECT *, CASE WHEN regexp_matches(kms1, '^[0-9]+$') THEN TRY_CAST(kms1 AS BIGINT) END AS "Kms", {num('price2')} AS "Price",
    CAST(year("ExtractedDate") - "Registration" AS BIGINT) AS "Age",
    CASE WHEN contains(coalesce("Features", ''), 'MITO') THEN 'MITO' WHEN contains(lower(fam), 'santa') THEN 'SANTA FE'
      WHEN contains(lower(fam), 'rover') THEN 'RANGE ROVER' ELSE fam END AS "Model" FROM t0),
t2 AS (SELECT * FROM t1 WHERE "Brand" IS NOT NULL AND "Province" IS NOT NULL AND "Fuel" IS NOT NULL AND "Gearbox" IS NOT NULL
    AND "Price" BETWEEN 1000 AND 150000 AND "Kms" <= 1000000 AND "Registration" >= 1990),
t3 AS (SELECT t2.*, seg."Segment" AS s0 FROM t2 LEFT JOIN seg USING ("Brand", "Model")),
t4 AS (SELECT *, {_SEG_FIX.format(m='"Model"', s='s0')} AS "Segment", {_SQL_ID} AS "Id", {_sql_surrogate(_SQL_VEHICLE)} AS "VehicleId",
    least(coalesce(pub, {TS}), "ExtractedDate") AS "Publication" FROM t3 WHERE instr("Model", 'P.') <> 2 AND "Province" IN ('S/C TENERIFE', 'LAS PALMAS')),
u0 AS (SELECT * REPLACE (trim(replace(replace("Model", 'KLASSE', ''), 'CLASE', '')) AS "Model", trim("Brand") AS "Brand",
    CASE WHEN lower("Gearbox") = 'automático' THEN 'AUTOMATICO' ELSE "Gearbox" END AS "Gearbox",
    CASE WHEN "Sale" IN ('PROFESIONAL', 'PARTICULAR') THEN {cap('"Sale"')} ELSE "Sale" END AS "Sale") FROM t4),
u1 AS (SELECT * REPLACE ({_BEM.format(b='"Brand"', m='"Model"', x='"Features"')} AS "Model", replace("Brand", ' ', '') AS "Brand") FROM u0),
u2 AS (SELECT * REPLACE ({_BRAND_FINAL.format(b='"Brand"')} AS "Brand", {_MODEL_FINAL.format(m='"Model"')} AS "Model") FROM u1),
u3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY "ExtractedDate" DESC, "VehicleId" DESC, "Id" DESC,
      "CV" DESC NULLS LAST, "Age" DESC, "Segment" DESC NULLS LAST, "Publication" DESC, "Funded" DESC, "Sale" DESC, "Links" DESC NULLS LAST) AS rn
    FROM u2 WHERE "Brand" IS NOT NULL AND "Model" IS NOT NULL) r WHERE rn = 1)
SELECT "VehicleId", "Id", "Brand", "Model", "Finish", "Features", "Kms", "Price", "Fuel", "Gearbox", "CV", "Registration", "Age",
  coalesce("Segment", "ListSegment") AS "Segment", "Province", {sql_ts('"Publication"')} AS "Publication", {sql_ts('"ExtractedDate"')} AS "ExtractedDate",
  "Funded", "Web", "Sale", "Links"
FROM u3 LEFT JOIN fall USING ("Brand", "Model")
"""


def build(spark, sf_dir, **options):
    fallback = S.fallback_dimension(view(spark, sf_dir, "price_list"), ["p_partkey"])
    return S.build_silver(view(spark, sf_dir, "bronze"), _segments(spark, sf_dir), fallback, AS_OF, **options)


@register("silver", _SILVER_SQL)
def silver(spark, sf_dir):
    df = build(spark, sf_dir, bits=256)
    return df.withColumns({n: ts_text(c(n)) for n in ("Publication", "ExtractedDate")})
