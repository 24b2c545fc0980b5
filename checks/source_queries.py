"""Extraction, bronze tables, sources and sinks, each with its SQL."""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import functions as F

from checks.registry import register
from checks.silver_queries import ROW, c, cap, tok
from checks.views import AS_OF, SITE_TEXT, cte, table, view
from tasador import schemas
from tasador.functions import fields
from tasador.operators import bronze as B
from tasador.plans import silver as S
from tasador.session import shared_dir, store
from tasador.sources import bucketed, pages, sinks, sites, tables

DAY = AS_OF[:10]


def ficha_rule(name, sql, columns, where=""):
    """A field rule applied to every listing page text."""

    @register(name, f"{cte('ficha')} SELECT l_orderkey, l_linenumber, {sql} FROM ficha {where}")
    def query(spark, sf_dir):
        return view(spark, sf_dir, "ficha").select(*ROW, *columns())

    return query


def _strip_sql(x, *pieces):
    for p in pieces:
        x = f"replace({x}, '{p}', '')"
    return f"trim({x}, ' ' || chr(10))"


_CUT = "string_split(price, '{}')[1]"
ficha_rule(
    "ext_price_text",
    f"{_strip_sql(_CUT.format(','), '.', '€')} AS cut_decimals, {_strip_sql(_CUT.format('€'), '.', '€')} AS cut_euro, {_strip_sql('price', '.', '€')} AS plain",
    lambda: [
        fields.price(c("price"), ",").alias("cut_decimals"),
        fields.price(c("price"), "€").alias("cut_euro"),
        fields.price(c("price")).alias("plain"),
    ],
)
ficha_rule("ext_kms_text", "trim(replace(string_split(kms, 'km')[1], '.', '')) AS kms", lambda: [fields.kms(c("kms")).alias("kms")])
_BRACKET = "trim(string_split(string_split(upper({p}), '(')[2], 'CV')[1])"
_LAST_CV = "trim(replace(list_filter(string_split(details, chr(10)), lambda t: contains(t, ' CV'))[-1], 'CV', ''))"
ficha_rule(
    "ext_power_text",
    f"{_BRACKET.format(p='power')} AS in_brackets, replace(trim(string_split(power, 'CV')[1]), '.', '') AS before_unit, {_LAST_CV} AS last_line",
    lambda: [
        fields.power_in_brackets(c("power")).alias("in_brackets"),
        fields.power_before_unit(c("power")).alias("before_unit"),
        fields.power_last_line(c("details")).alias("last_line"),
    ],
)
ficha_rule(
    "ext_year_text",
    "trim(string_split(year_text, '/')[2]) AS after_slash, trim(string_split(year_text, '/')[-1]) AS last_slash, "
    "trim(string_split(market_features, '|')[2]) AS after_bar",
    lambda: [
        fields.year_after_slash(c("year_text")).alias("after_slash"),
        fields.year_last_slash(c("year_text")).alias("last_slash"),
        fields.year_after_bar(c("market_features")).alias("after_bar"),
    ],
)
ficha_rule(
    "ext_seller_type",
    "CASE WHEN contains(coalesce(upper(spans[5]), ''), 'PARTICULAR') THEN 'Particular' ELSE 'Profesional' END AS seller",
    lambda: [fields.seller(F.get("spans", F.lit(4))).alias("seller")],
)
_SECOND = "string_split(trim(replace(replace(price, '.', ''), '€', '')), ' ')[2]"
ficha_rule(
    "ext_financing",
    "CASE WHEN upper(trim(label)) = 'FINANCIADO' THEN 'FINANCIADO' ELSE 'SIN FINANCIACIÓN' END AS by_label, "
    f"CASE WHEN length({_SECOND}) > 1 THEN 'FINANCIADO' ELSE 'SIN FINANCIACIÓN' END AS by_second_price",
    lambda: [fields.financed_by_label(c("label")).alias("by_label"), fields.financed_by_second_price(c("price")).alias("by_second_price")],
)
ficha_rule(
    "ext_province",
    "CASE WHEN contains(upper(province), 'PALMAS') THEN 'LAS PALMAS' ELSE 'S/C TENERIFE' END AS province",
    lambda: [fields.province(c("province")).alias("province")],
)


@register(
    "ext_skip_nonvehicle",
    f"{cte('ficha')} SELECT l_orderkey, l_linenumber, title FROM ficha WHERE NOT regexp_matches(upper(title), 'SILENCE|MOTO|DUCATI')",
)
def ext_skip_nonvehicle(spark, sf_dir):
    return view(spark, sf_dir, "ficha").filter(fields.is_vehicle(c("title"))).select(*ROW, "title")


_T = "replace(title, chr(10), ' ')"
_TITLE_MODEL = (
    f"CASE WHEN {tok(_T, 2)} IN ('CLASE', 'SERIE') THEN coalesce({tok(_T, 2)} || ' ' || string_split(string_split({_T}, ' - ')[2], ' ')[2], {tok(_T, 2)}) ELSE {tok(_T, 2)} END"
)
ficha_rule(
    "ext_title_split",
    f"trim({tok(_T, 1)}) AS brand, {_TITLE_MODEL} AS model, CASE WHEN contains({tok(_T, 2)}, 'CLASE') OR contains(upper({tok(_T, 2)}), 'SERIE') "
    f"THEN upper({tok(_T, 2)} || ' ' || {tok(_T, 3)}) ELSE upper({tok(_T, 2)}) END AS two_words, "
    f"CASE WHEN contains(upper({tok(_T, 2)}), 'NUEVO') THEN {tok(_T, 3)} ELSE {tok(_T, 2)} END AS not_new",
    lambda: [
        fields.title_brand(c("title")).alias("brand"),
        fields.title_model(c("title")).alias("model"),
        fields.title_model_two_words(F.replace("title", F.lit("\n"), F.lit(" "))).alias("two_words"),
        fields.title_model_not_new(F.replace("title", F.lit("\n"), F.lit(" "))).alias("not_new"),
    ],
)
_L = "string_split(block, chr(10))"
_LAYOUTS = f"""lay AS (SELECT *, CASE
    WHEN len(spans) >= 5 AND {_BRACKET.format(p='spans[5]')} IS NOT NULL THEN 1
    WHEN {_L}[7] IS NOT NULL AND {_BRACKET.format(p=_L + '[3]')} IS NOT NULL THEN 2
    WHEN {_L}[5] IS NOT NULL AND {_BRACKET.format(p=_L + '[5]')} IS NOT NULL THEN 3 END AS kind FROM ficha),
lf AS (SELECT *, CASE kind WHEN 1 THEN spans[1] WHEN 2 THEN {_L}[1] WHEN 3 THEN {_L}[1] END AS f_kms,
    CASE kind WHEN 1 THEN spans[2] WHEN 2 THEN {_L}[6] WHEN 3 THEN {_L}[2] END AS f_gear,
    CASE kind WHEN 1 THEN spans[3] WHEN 2 THEN {_L}[2] WHEN 3 THEN {_L}[3] END AS f_year,
    CASE kind WHEN 1 THEN spans[4] WHEN 2 THEN {_L}[7] WHEN 3 THEN {_L}[4] END AS f_fuel,
    CASE kind WHEN 1 THEN {_BRACKET.format(p='spans[5]')} WHEN 2 THEN {_BRACKET.format(p=_L + '[3]')} WHEN 3 THEN {_BRACKET.format(p=_L + '[5]')} END AS f_power FROM lay)"""


@register(
    "ext_layout_fallback",
    f"{cte('ficha')}, {_LAYOUTS} SELECT l_orderkey, l_linenumber, f_kms, f_gear, f_year, f_fuel, f_power FROM lf WHERE kind IS NOT NULL",
)
def ext_layout_fallback(spark, sf_dir):
    df = view(spark, sf_dir, "ficha").withColumn("found", sites.layout(c("spans"), c("block"))).filter("found is not null")
    return df.select(*ROW, *[c(f"found.{n}").alias(f"f_{n}") for n in ("kms", "gear", "year", "fuel", "power")])


def _label_sql(label):
    at = f"list_position(string_split(label_text, chr(10)), '{label}:')"
    return f"CASE WHEN {at} > 0 THEN trim(string_split(label_text, chr(10))[{at} + 1]) END"


_LABELLED = ", ".join(
    f'coalesce({", ".join(_label_sql(x) for x in labels)}) AS "{name}"' if len(labels) > 1 else f'{_label_sql(labels[0])} AS "{name}"'
    for name, labels in sites.LABELS.items()
)
_NOT_NULL = " AND ".join(f'"{n}" IS NOT NULL' for n in sites.LABELS)
_NAMES = ", ".join(f'"{n}"' for n in sites.LABELS)


@register(
    "ext_label_value",
    f"{cte('ficha')}, x AS (SELECT l_orderkey, l_linenumber, link, {_LABELLED} FROM ficha) SELECT l_orderkey, l_linenumber, {_NAMES} FROM x WHERE {_NOT_NULL}",
)
def ext_label_value(spark, sf_dir):
    return sites.labelled_fields(view(spark, sf_dir, "ficha"), "label_text").select(*ROW, *sites.LABELS)


def _keyed_sql(keys):
    names = ", ".join(f"'{k}'" for k in keys)
    hits = f"list_filter(string_split(colon_text, chr(10)), lambda t: trim(string_split(t, ':')[1]) IN ({names}) AND string_split(t, ':')[2] IS NOT NULL)"
    return f"trim(string_split({hits}[-1], ':')[2])"


_KEYED = ", ".join(f'{_keyed_sql(k)} AS "{n}"' for n, k in {**sites.LABELS, "Precio": ["Precio", "Precio contado"]}.items())


@register(
    "ext_key_colon_value",
    f"{cte('ficha')}, x AS (SELECT l_orderkey, l_linenumber, {_KEYED}, CASE WHEN contains(colon_text, 'PrecioFinanciado:') THEN 'FINANCIADO' "
    f"ELSE 'SIN FINANCIACIÓN' END AS \"Financiado\" FROM ficha) SELECT * FROM x WHERE {_NOT_NULL}",
)
def ext_key_colon_value(spark, sf_dir):
    df = sites.keyed_fields(view(spark, sf_dir, "ficha"), "colon_text", "PrecioFinanciado")
    return df.select(*ROW, *sites.LABELS, "Financiado")


_BRZ = ", ".join(f'"{n}"' for n in schemas.BRONZE.names if n != "PublicacionAnyo")


def _stamped(site, sale=None, day_only=False):
    pub = f"'{DAY}'" if day_only else "'30/06 12:34'"
    year = "" if day_only else ", '2027' AS \"PublicacionAnyo\""
    return f"DATE '{DAY}' AS \"ExtractedDate\", '{site}' AS \"Web\", {pub} AS \"Publicacion\"{year}" + (f", '{sale}' AS \"Venta\"" if sale else "")


def _fichas(spark, sf_dir):
    return view(spark, sf_dir, "ficha")


@register(
    "ext_autoscout_row",
    f"""{cte('ficha')}, {_LAYOUTS} SELECT trim({tok(_T, 1)}) AS "Marca", {_TITLE_MODEL} AS "Modelo", {_T} AS "Caracteristicas",
    {tok("trim(replace(replace(f_kms, '.', ''), 'km', ''))", 1)} AS "Kms", {_strip_sql(_CUT.format(','), '.', '€')} AS "Precio",
    CASE WHEN f_fuel = 'Eléctrico' THEN 'Eléctrico/Híbrido' ELSE f_fuel END AS "Combustible", trim(f_gear) AS "Caja", {tok('f_power', 1)} AS "Cilindrada",
    trim(string_split(f_year, '/')[2]) AS "AnyoMatriculacion", province AS "Provincia", 'SIN FINANCIACIÓN' AS "Financiado",
    CASE WHEN contains(coalesce(spans[5], ''), 'PARTICULAR') THEN 'Particular' ELSE 'Profesional' END AS "Venta", link AS "Links", {_stamped('Autoscout24.es')}
    FROM lf WHERE string_split(f_year, '/')[2] IS NOT NULL""",
)
def ext_autoscout_row(spark, sf_dir):
    return sites.autoscout(_fichas(spark, sf_dir), AS_OF)


_MF = "array_to_string(string_split(market_features, ' ')[2:], ' ')"
_MB = "string_split(market_brand, ' ')"


@register(
    "ext_carmarket_row",
    f"""{cte('ficha')}, m AS (SELECT *, {_MF} AS fx, array_to_string({_MB}[2:len({_MB}) - 1], ' ') AS mid, {tok('gear', 1)} AS g0 FROM ficha),
    n AS (SELECT {tok("trim(replace(market_brand, 'Nuevo', ''))", 1)} AS "Marca", CASE WHEN mid = '' THEN {tok('fx', 1)} ELSE mid END AS "Modelo", fx AS "Caracteristicas",
      CAST(TRY_CAST(trim(replace(replace(kms, '.', ''), 'km', '')) AS BIGINT) AS VARCHAR) AS "Kms",
      CAST(TRY_CAST(trim(replace(replace(price, '€', ''), '.', '')) AS BIGINT) AS VARCHAR) AS "Precio",
      fuel, CASE {cap('g0')} WHEN 'S' THEN 'Automático' WHEN 'Manual' THEN 'Manual' WHEN 'Automática' THEN 'Automático' END AS "Caja",
      CAST(TRY_CAST(trim(replace(details, ' CV', '')) AS BIGINT) AS VARCHAR) AS "Cilindrada", trim(string_split(fx, '|')[2]) AS "AnyoMatriculacion",
      'Las Palmas' AS "Provincia", 'FINANCIADO' AS "Financiado", link AS "Links" FROM m)
    SELECT "Marca", "Modelo", "Caracteristicas", "Kms", CASE WHEN regexp_matches("Precio", '^[0-9]+$') THEN "Precio" END AS "Precio", CASE fuel WHEN '5 puertas' THEN '5 Puertas' WHEN 'híbrido' THEN 'Híbrido' WHEN 'GLP' THEN 'Glp' ELSE fuel END AS "Combustible", "Caja", "Cilindrada",
      "AnyoMatriculacion", "Provincia", "Financiado", "Links", {_stamped('CarMarket', 'Profesional', True)}
    FROM n WHERE "Marca" NOT IN ('DUCATI', 'HONDA') AND "AnyoMatriculacion" IS NOT NULL AND "Modelo" IS NOT NULL""",
)
def ext_carmarket_row(spark, sf_dir):
    df = _fichas(spark, sf_dir).select(
        c("market_brand").alias("brand"), c("market_features").alias("features"), "price", F.replace("kms", F.lit("."), F.lit("")).alias("kms"), "fuel", "gear",
        c("details").alias("power"), "link",
    )
    return sites.carmarket(df, AS_OF)


_GEAR = "CASE WHEN contains(gear, 'Manual') THEN 'Manual' WHEN contains(upper(gear), 'DSG') OR contains(upper(gear), 'TRONIC') THEN 'Automática' WHEN gear = 'manual 6 vel' THEN 'Manual 6 Vel' ELSE gear END"


@register(
    "ext_carplus_row",
    f"""{cte('ficha')} SELECT DISTINCT trim({tok(_T, 1)}) AS "Marca", CASE WHEN contains(upper({tok(_T, 2)}), 'NUEVO') THEN {tok(_T, 3)} ELSE {tok(_T, 2)} END AS "Modelo",
    upper(label) AS "Caracteristicas", trim(replace(kms, 'km', '')) AS "Kms", {_strip_sql('price', '.', '€')} AS "Precio", trim(fuel) AS "Combustible", {_GEAR} AS "Caja",
    {_LAST_CV} AS "Cilindrada", year_text AS "AnyoMatriculacion", 'LAS PALMAS' AS "Provincia",
    CASE WHEN upper(trim(label)) = 'FINANCIADO' THEN 'FINANCIADO' ELSE 'SIN FINANCIACIÓN' END AS "Financiado", link AS "Links", {_stamped('Carplus', 'Profesional')}
    FROM ficha WHERE NOT regexp_matches(upper(title), 'SILENCE|MOTO|DUCATI')""",
)
def ext_carplus_row(spark, sf_dir):
    df = _fichas(spark, sf_dir).withColumns({"features": c("label"), "year": c("year_text"), "title": F.replace("title", F.lit("\n"), F.lit(" "))})
    return sites.carplus(df, AS_OF)


@register(
    "ext_km0_row",
    f"""{cte('ficha')}, x AS (SELECT l_orderkey, l_linenumber, link, {_LABELLED} FROM ficha) SELECT "Marca",
    CASE WHEN contains("Modelo", 'Serie') THEN {tok('"Caracteristicas"', 1)} ELSE "Modelo" END AS "Modelo", "Caracteristicas", trim(replace("Kms", '.', '')) AS "Kms",
    {_strip_sql("string_split(\"Precio\", '€')[1]", '.')} AS "Precio",
    CASE WHEN contains("Combustible", '(') OR contains("Combustible", 'Eléctrico') THEN 'Electrico/hibrido' ELSE "Combustible" END AS "Combustible",
    "Caja", "Cilindrada", "AnyoMatriculacion", 'Las Palmas' AS "Provincia", 'SIN FINANCIACIÓN' AS "Financiado", link AS "Links", {_stamped('TuKm0', 'Profesional', True)}
    FROM x WHERE {_NOT_NULL}""",
)
def ext_km0_row(spark, sf_dir):
    return sites.km0(_fichas(spark, sf_dir).select(c("label_text").alias("text"), "link"), AS_OF)


@register(
    "ext_mleon_row",
    f"""{cte('ficha')}, x AS (SELECT link, {_KEYED} FROM ficha) SELECT DISTINCT "Marca", "Modelo", upper("Caracteristicas") AS "Caracteristicas", "Kms",
    {_strip_sql('"Precio"', '€', '.')} AS "Precio", "Combustible", "Caja", "Cilindrada", "AnyoMatriculacion", 'LAS PALMAS' AS "Provincia",
    'SIN FINANCIACIÓN' AS "Financiado", link AS "Links", {_stamped('Mleon', 'Profesional')} FROM x WHERE {_NOT_NULL}""",
)
def ext_mleon_row(spark, sf_dir):
    return sites.mleon(_fichas(spark, sf_dir).select(c("colon_text").alias("text"), "link"), AS_OF)


# -- pages ----------------------------------------------------------------

_UNESCAPE = "replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


@register(
    "ext_html_text",
    f"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>')) AS t FROM pages),
    h AS (SELECT page_id, unnest(regexp_extract_all(html, '<h1>[^<]*</h1>')) AS t FROM pages)
    SELECT page_id, 'a' AS tag, trim({_UNESCAPE.format(x="regexp_extract(t, '>([^<]*)<', 1)")}) AS text, {_UNESCAPE.format(x="regexp_extract(t, 'href=\"([^\"]*)\"', 1)")} AS href FROM a
    UNION ALL SELECT page_id, 'h1', trim({_UNESCAPE.format(x="regexp_extract(t, '>([^<]*)<', 1)")}), NULL FROM h""",
)
def ext_html_text(spark, sf_dir):
    nodes = pages.page_nodes(table(spark, sf_dir, "pages"), ["a", "h1"])
    return nodes.select("page_id", F.explode("nodes").alias("n")).select("page_id", "n.tag", "n.text", "n.href")


@register(
    "ext_dt_dd",
    f"""{cte('part_pages')} SELECT page_id, trim({_UNESCAPE.format(x="regexp_extract(html, '<dt>Versión<dd>([^<]*)<', 1)")}) AS version,
    trim(regexp_extract(html, '<dt>Matriculación</dt><dd>([^<]*)<', 1)) AS registered, regexp_extract(html, '<dt>Potencia máxima</dt><dd>([^<]*)<', 1) AS power,
    CASE WHEN contains(html, '<dt>Cambio</dt>') THEN regexp_extract(html, '<dt>Cambio</dt><dd>([^<]*)<', 1) END AS gear FROM part_pages""",
)
def ext_dt_dd(spark, sf_dir):
    parsed = pages.page_nodes(view(spark, sf_dir, "part_pages"), ["dt", "dd"])
    t = c("terms")
    return parsed.withColumn("terms", pages.term_values(c("nodes"))).select(
        "page_id", t["Versión"].alias("version"), t["Matriculación"].alias("registered"), t["Potencia máxima"].alias("power"), t["Cambio"].alias("gear")
    )


_H1 = "regexp_extract(html, '<h1[^>]*>([^<]*)<', 1)"
_STRONG = "trim(replace(replace(regexp_extract(html, '<strong>([^<]*)<', 1), '.', ''), '€', ''))"
_FUEL_PP = "regexp_extract(html, '<dt>Combustible</dt><dd>([^<]*)<', 1)"
_MODEL_PP = f"CASE WHEN regexp_matches(upper({tok(_H1, 2)}), 'CLASE|SERIE') THEN upper({tok(_H1, 2)} || ' ' || {tok(_H1, 3)}) ELSE upper({tok(_H1, 2)}) END"
_MOTOR_SQL = f"""{cte('part_pages')}, x AS (SELECT page_id, url, html, upper({tok(_H1, 1)}) AS b, {_MODEL_PP} AS m FROM part_pages)
SELECT DISTINCT CASE b WHEN 'LAND' THEN 'LAND ROVER' WHEN 'MERCEDES' THEN 'MERCEDES BENZ' ELSE b END AS "Marca",
  CASE WHEN b = 'TOYOTA' AND m = 'LAND' THEN 'LAND CRUISER' ELSE m END AS "Modelo",
  b || ' ' || m || ' ' || trim(replace(regexp_extract(html, '<dt>Versión<dd>([^<]*)<', 1), '&amp;', '&')) AS "Caracteristicas",
  replace(trim(string_split(regexp_extract(html, '<dt>Kilómetros</dt><dd>([^<]*)<', 1), 'Km')[1]), '.', '') AS "Kms", {tok(_STRONG, 1)} AS "Precio",
  CASE {_FUEL_PP} WHEN 'gasolina' THEN 'Gasolina' WHEN 'Diesel' THEN 'Diesel' WHEN 'híbrido' THEN 'Híbrido' END AS "Combustible",
  CASE WHEN contains(html, '<dd>Manual') THEN 'Manual' ELSE 'Automático' END AS "Caja",
  trim(string_split(regexp_extract(html, '<dt>Potencia máxima</dt><dd>([^<]*)<', 1), 'CV')[1]) AS "Cilindrada",
  trim(string_split(regexp_extract(html, '<dt>Matriculación</dt><dd>([^<]*)<', 1), '/')[-1]) AS "AnyoMatriculacion",
  CASE WHEN contains(html, 'Las Palmas de') THEN 'LAS PALMAS' ELSE 'S/C TENERIFE' END AS "Provincia",
  CASE WHEN length({tok(_STRONG, 2)}) > 1 THEN 'FINANCIADO' ELSE 'SIN FINANCIACIÓN' END AS "Financiado",
  CASE WHEN contains(html, '>Particular<') THEN 'Particular' ELSE 'Profesional' END AS "Venta", url AS "Links", {_stamped('MotorES')}
FROM x WHERE NOT contains({_FUEL_PP}, 'puertas')"""


@register("ext_motores_row", _MOTOR_SQL)
def ext_motores_row(spark, sf_dir):
    parsed = pages.page_nodes(view(spark, sf_dir, "part_pages"), ["h1", "strong", "dt", "dd", "dl", "span", "section"])
    tags = {"title": "h1", "price": "strong", "place": "span", "sheet": "dl", "vendor": "section"}
    texts = [pages.first_text(c("nodes"), tag).alias(name) for name, tag in tags.items()]
    df = parsed.select(*texts, pages.term_values(c("nodes")).alias("terms"), c("url").alias("link"))
    return sites.motores(df, AS_OF)


ficha_rule(
    "ext_value_maps",
    "CASE fuel WHEN 'Gasolina' THEN 'Gasolina' WHEN 'Diesel' THEN 'Diesel' WHEN 'Eléctrico' THEN 'Eléctrico' WHEN 'híbrido' THEN 'Híbrido' END AS fuel_motor, "
    f"CASE {cap(tok('gear', 1))} WHEN 'S' THEN 'Automático' WHEN 'Manual' THEN 'Manual' WHEN 'Automática' THEN 'Automático' END AS gear_market, "
    "CASE gear WHEN 'Manual' THEN 'Manual' WHEN 'Automático' THEN 'Automático' END AS gear_motor, "
    "CASE WHEN contains(gear, 'Manual') THEN 'Manual' WHEN contains(upper(gear), 'DSG') OR contains(upper(gear), 'TRONIC') THEN 'Automática' ELSE gear END AS gear_name, "
    "CASE WHEN contains(fuel, '(') OR contains(fuel, 'Eléctrico') THEN 'Electrico/hibrido' ELSE fuel END AS fuel_label",
    lambda: [
        fields.mapped(c("fuel"), fields.FUEL_MOTOR).alias("fuel_motor"),
        fields.gear_market(c("gear")).alias("gear_market"),
        fields.mapped(c("gear"), fields.GEAR_MOTOR).alias("gear_motor"),
        fields.gear_by_name(c("gear")).alias("gear_name"),
        fields.fuel_hybrid_label(c("fuel")).alias("fuel_label"),
    ],
)
_UB, _UM = f"upper({tok(_T, 1)})", f"upper({tok(_T, 2)})"
ficha_rule(
    "ext_site_fixups",
    f"CASE {_UB} WHEN 'LAND' THEN 'LAND ROVER' WHEN 'MERCEDES' THEN 'MERCEDES BENZ' ELSE {_UB} END AS brand, "
    f"CASE WHEN {_UB} = 'TOYOTA' AND {_UM} = 'LAND' THEN 'LAND CRUISER' ELSE {_UM} END AS model",
    lambda: [
        fields.brand_fixup(F.upper(fields.title_brand(c("title")))).alias("brand"),
        fields.model_fixup(F.upper(fields.title_brand(c("title"))), F.upper(F.get(F.split(c("title"), "[ \n]"), 1))).alias("model"),
    ],
)


@register(
    "ext_required_fields",
    f"{cte('ficha')} SELECT l_orderkey, l_linenumber FROM ficha WHERE string_split(market_features, '|')[2] IS NOT NULL AND spans IS NOT NULL",
)
def ext_required_fields(spark, sf_dir):
    df = _fichas(spark, sf_dir).withColumn("year", fields.year_after_bar(c("market_features")))
    return sites.with_required(df, "year", "spans").select(*ROW)


@register("ext_drop_float_tail", "SELECT l_orderkey, l_linenumber, string_split(CAST(l_quantity AS VARCHAR), '.')[1] AS quantity FROM lineitem")
def ext_drop_float_tail(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*ROW, fields.no_float_tail(c("l_quantity")).alias("quantity"))


@register(
    "ext_initcap",
    "SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(split_part(p_name, ' ', 1), 2) || ' ' || upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) AS name FROM part",
)
def ext_initcap(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", fields.title_case(c("p_name")).alias("name"))


@register("ext_stamp", f"SELECT l_orderkey, l_linenumber, {_stamped('TuKm0', 'Profesional')} FROM lineitem")
def ext_stamp(spark, sf_dir):
    return sites.stamp(table(spark, sf_dir, "lineitem").select(*ROW), "TuKm0", AS_OF, sale="Profesional")


# -- bronze ---------------------------------------------------------------

_B = ", ".join(f'"{n}"' for n in schemas.BRONZE.names)
_OLD = "old AS (SELECT * EXCLUDE (\"PublicacionAnyo\") FROM bronze WHERE \"ExtractedDate\" < DATE '2025-06-01')"
_NEW = "new AS (SELECT * FROM bronze WHERE \"ExtractedDate\" >= DATE '2025-01-01')"
_BOTH = f"{_OLD}, {_NEW}, both_ AS (SELECT *, CAST(NULL AS VARCHAR) AS \"PublicacionAnyo\" FROM old UNION ALL SELECT * FROM new)"


def _batches(spark, sf_dir):
    df = view(spark, sf_dir, "bronze").select(*schemas.BRONZE.names)
    cut = lambda d: F.lit(d).cast("date")
    return df.filter(c("ExtractedDate") < cut("2025-06-01")).drop("PublicacionAnyo"), df.filter(c("ExtractedDate") >= cut("2025-01-01"))


@register("brz_union", f"{cte('bronze')}, {_BOTH} SELECT {_B} FROM both_")
def brz_union(spark, sf_dir):
    return B.union_batches(*_batches(spark, sf_dir))


@register("brz_exact_distinct", f"{cte('bronze')}, {_BOTH} SELECT DISTINCT {_B} FROM both_")
def brz_exact_distinct(spark, sf_dir):
    return B.exact_distinct(B.union_batches(*_batches(spark, sf_dir)))


_LK = ", ".join(f'"{n}"' for n in schemas.LISTING_KEY)
_LREST = ", ".join(f'"{n}" ASC NULLS FIRST' for n in ["ExtractedDate", *[n for n in schemas.BRONZE.names if n not in schemas.LISTING_KEY]])
_KEY_DISTINCT = f"SELECT {_B} FROM (SELECT *, row_number() OVER (PARTITION BY {_LK} ORDER BY {_LREST}) AS rn FROM both_) r WHERE rn = 1"


@register("brz_key_distinct", f"{cte('bronze')}, {_BOTH} {_KEY_DISTINCT}")
def brz_key_distinct(spark, sf_dir):
    return B.append_batch(*_batches(spark, sf_dir))


@register("brz_key_late", f"{cte('bronze')}, {_BOTH} {_KEY_DISTINCT}")
def brz_key_late(spark, sf_dir):
    """The same, chosen on narrow rows of stored batches: a view is computed once, and one after the other."""
    return B.append_batch(*[store(batch) for batch in _batches(spark, sf_dir)], late=True)


@register("brz_bucketed", f"{cte('bronze')}, {_BOTH} {_KEY_DISTINCT}")
def brz_bucketed(spark, sf_dir):
    """The same by a table in buckets, that grows by one batch and then by the other."""
    table = f"{shared_dir(spark).rstrip('/')}/check-{uuid.uuid4().hex}"
    for batch in _batches(spark, sf_dir):
        bucketed.append(batch, table, buckets=16)
    return B.project(bucketed.read(spark, table))


@register("brz_project", f"{cte('bronze')} SELECT {_B} FROM bronze")
def brz_project(spark, sf_dir):
    return B.project(view(spark, sf_dir, "bronze"))


@register("brz_fallback_old", f"{cte('bronze')}, {_BOTH} SELECT {_BRZ} FROM old")
def brz_fallback_old(spark, sf_dir):
    old, new = _batches(spark, sf_dir)
    return B.with_fallback(old, new.filter(c("Web") == "no such site"))


@register(
    "brz_freshness",
    f"""{cte('bronze')}, {_BOTH} SELECT (SELECT count(*) FROM old) AS rows_before, count(*) AS rows_after, count(*) - (SELECT count(*) FROM old) AS new_rows,
    max("ExtractedDate") AS last_extracted, date_diff('day', max("ExtractedDate"), DATE '{DAY}') > 7 AS stale FROM both_""",
)
def brz_freshness(spark, sf_dir):
    old, new = _batches(spark, sf_dir)
    return B.freshness(old, B.union_batches(old, new), AS_OF)


@register("brz_nonempty", f"{cte('bronze')}, {_BOTH} SELECT count(*) AS n FROM new")
def brz_nonempty(spark, sf_dir):
    return B.require_rows(_batches(spark, sf_dir)[1]).agg(F.count(F.lit(1)).alias("n"))


# -- sources and sinks ----------------------------------------------------


def _scratch(spark):
    return f"{shared_dir(spark).rstrip('/')}/check-{uuid.uuid4().hex}"


_TABLES = {site: f"tb_check_{re.sub('[^a-z0-9]', '', site.lower())}task" for site in SITE_TEXT}
_TABLE_SQL = "CASE \"Web\" " + " ".join(f"WHEN '{site}' THEN '{name}'" for site, name in _TABLES.items()) + " END"


def _site_tables(spark, sf_dir):
    """One table per site; one site's table lacks a column it never fills."""
    df = view(spark, sf_dir, "bronze").select(*schemas.BRONZE.names)
    for site, name in _TABLES.items():
        own = df.filter(c("Web") == site)
        (own.drop("PublicacionAnyo") if site == "TuKm0" else own).createOrReplaceTempView(name)
    df.filter(c("Web") == "MotorES").createOrReplaceTempView("tb_check_other")


@register("src_table", f"{cte('bronze')} SELECT {_B} FROM bronze")
def src_table(spark, sf_dir):
    _site_tables(spark, sf_dir)
    return reduce(B.union_batches, [tables.read_table(spark, name) for name in _TABLES.values()])


@register("src_bootstrap", f"{cte('bronze')} SELECT {_B} FROM bronze")
def src_bootstrap(spark, sf_dir):
    _site_tables(spark, sf_dir)
    names = ["tb_check_missingtask", *_TABLES.values()]
    return reduce(B.union_batches, [tables.read_or_empty(spark, name, schemas.BRONZE) for name in names])


@register("src_discover", f"{cte('bronze')} SELECT {_TABLE_SQL} AS name, count(*) AS n FROM bronze GROUP BY 1")
def src_discover(spark, sf_dir):
    _site_tables(spark, sf_dir)
    names = tables.discover(spark, r"^tb_check_.*task$")
    return S.row_counts({n: spark.read.table(n) for n in names}).select(c("step").alias("name"), c("rows").alias("n"))


@register("src_multi_union", f"{cte('bronze')} SELECT {_B} FROM bronze WHERE \"ExtractedDate\" >= DATE '2024-01-01'")
def src_multi_union(spark, sf_dir):
    _site_tables(spark, sf_dir)
    return tables.read_recent(spark, tables.discover(spark, r"^tb_check_.*task$"), "2024-01-01").select(*schemas.BRONZE.names)


@register("src_csv_dim", f'{cte("segment_history")} SELECT "Marca", "Modelo_Cube", "Segmento" FROM segment_history')
def src_csv_dim(spark, sf_dir):
    folder = _scratch(spark)
    view(spark, sf_dir, "segment_history").select(*schemas.SEGMENT_CSV.names).write.csv(folder, header=True)
    return tables.read_dictionary(spark, folder)


@register("src_excel_dim", 'SELECT p_partkey, p_name AS "MODELO", p_brand AS "Periodo" FROM part')
def src_excel_dim(spark, sf_dir):
    from tasador.plans.pricelist import clean_headers

    raw = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("\xa0"), "p_name").alias(" MODELO"), c("p_brand").alias("Período"))
    return clean_headers(raw)


@register("src_rows_schema", f"{cte('price_list')} SELECT \"Brand\", \"Model\", \"CV\", \"Fuel\", \"Price\", \"Features\", \"Segment\", \"StarDate\", \"EndDate\" FROM price_list")
def src_rows_schema(spark, sf_dir):
    return tables.typed_rows(spark, view(spark, sf_dir, "price_list"), schemas.PRICE_LIST)


@register(
    "snk_merge_schema",
    f"{cte('bronze')}, {_BOTH} SELECT {_B} FROM both_",
)
def snk_merge_schema(spark, sf_dir):
    folder = _scratch(spark)
    old, new = _batches(spark, sf_dir)
    sinks.overwrite(old, folder)
    sinks.overwrite_growing(B.union_batches(sinks.read_current(spark, folder), new), folder)
    return sinks.read_current(spark, folder)


@register("snk_overwrite_schema", f"{cte('bronze')} SELECT \"Web\" AS site, count(*) AS n FROM bronze GROUP BY 1")
def snk_overwrite_schema(spark, sf_dir):
    folder = _scratch(spark)
    df = view(spark, sf_dir, "bronze").select(*schemas.BRONZE.names)
    sinks.overwrite(df, folder)
    sinks.overwrite(df.groupBy(c("Web").alias("site")).agg(F.count(F.lit(1)).alias("n")), folder)
    return sinks.read_current(spark, folder)


@register("snk_plain", f"{cte('bronze')} SELECT {_B} FROM bronze")
def snk_plain(spark, sf_dir):
    folder = _scratch(spark)
    sinks.overwrite(view(spark, sf_dir, "bronze").select(*schemas.BRONZE.names), folder)
    return sinks.read_current(spark, folder)
