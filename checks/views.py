"""Vehicle-shaped views over the given tables.

The given tables hold no vehicles, so the columns are renamed and combined into
listings, price lists and scored rows.  Every text below is plain SQL that both
Spark and the checking engine read, so a query and its check start from the
same rows.  All rows of the underlying tables are used.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tasador.operators.keyed import BROADCAST_ROWS

AS_OF = "2027-06-30 12:34:00"

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def _pick(selector: str, values: list[str | None]) -> str:
    """The value at position `selector` (0-based); Spark gets its own spelling of the list functions."""
    texts = ["NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values]
    return f"list_extract(list_value({', '.join(texts)}), CAST({selector} AS INT) + 1)"


def spark_text(sql: str) -> str:
    sql = sql.replace("list_extract(", "element_at(").replace("list_value(", "array(")
    return re.sub(r"(?<=\w)''(?=\w)", r"\\'", sql).replace('"', "`")


BRAND_TEXT = [
    "audi", "Mercedes-benz", "alfa", "VW", "land", "CITROËN", "Hyundai motor", "opel", "SEAT", "renault trucks",
    "9bad", "toyota", "BMW", "volvo", "kia", "ford", "ds-automobiles", "Aston", "no se sabe", "Mini", "fiat",
    "peugeot", "Abarth!", None, "škoda", "audi",
]
MODEL_TEXT = [
    "A3", "CLASE A", "SERIE 3", "Land", "ID.3", "UP!", "Golf Plus", "Space Wagon", "Range Evoque", "Santa", "A",
    "CEE'D", "Nuevo Ibiza", "C-HR", "León", "P.x", None, "serie", "Tucson Klasse", "X1", "Cooper D", "AP.E", "Romeo Giulia",
    "Audi Q2", "|", "Mini", "NUEVO",
]
FUEL_TEXT = [
    "Gasolina", "Diésel", "Híbrido enchufable", "GLP", "Gas", "eléctrico", None, "DIESEL", "gasolina", "Hidrógeno",
]
GEAR_TEXT = ["Manual", "Automático", "Automática", " Doble embrague ", "Semi-automatico", "manual", None]
POWER_TEXT = ["115 CV", "40", "85kW", "1600", None, "n/a", "9", "150 CV", "1a", "99"]
PROVINCE_TEXT = ["Las Palmas", "S/C Tenerife", "Madrid", "las palmas ", None]
SITE_TEXT = ["Autoscout24.es", "CarMarket", "Carplus", "TuKm0", "Mleon", "MotorES", "CICAR"]
EXTRA_TEXT = [
    "", " 2.0 TDI (GTI", " 5P Mito", " Hiace combi", " (", " Sportline DSG", " MINI cooper", " Xcellence",
]

BN = "CAST(substr(p_brand, 7) AS INT)"

# Raw listings with every irregularity the cleaning rules deal with.
BRONZE = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  {_pick(f"(({BN} + CASE WHEN l_linenumber = 6 THEN 3 ELSE 0 END) % 26)", BRAND_TEXT)} AS "Marca",
  {_pick("((l_partkey + l_suppkey) % 27)", MODEL_TEXT)} AS "Modelo",
  CASE WHEN l_orderkey % 37 = 5 THEN NULL
       ELSE upper(substr(p_name, 1, 1)) || substr(p_name, 2) || ' ' || lower(p_type)
            || {_pick("(l_partkey % 8)", EXTRA_TEXT)} END AS "Caracteristicas",
  CASE WHEN l_orderkey % 23 = 1 THEN 'N/D'
       WHEN l_orderkey % 23 = 2 THEN 'abc'
       WHEN l_orderkey % 23 = 3 THEN '2021 ' || CAST(CAST(l_quantity AS INT) * 1000 AS STRING)
       WHEN l_orderkey % 23 = 4 THEN NULL
       WHEN l_orderkey % 2 = 0 THEN CAST(CAST(l_quantity AS INT) AS STRING) || '.' || lpad(CAST(l_partkey % 1000 AS STRING), 3, '0')
       ELSE ' ' || CAST(CAST(l_quantity AS INT) * 25000 AS STRING) || ' ' END AS "Kms",
  CASE WHEN l_orderkey % 29 = 1 THEN NULL
       WHEN l_orderkey % 29 = 2 THEN '12.5'
       WHEN l_orderkey % 29 = 3 THEN 'consultar'
       WHEN l_orderkey % 29 = 4 THEN CAST(CAST(floor(l_extendedprice) AS BIGINT) * 2 AS STRING)
       WHEN l_orderkey % 29 = 5 THEN '1.234.567'
       WHEN l_orderkey % 2 = 0 AND l_extendedprice >= 1000
         THEN ' ' || CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS STRING) || '.'
              || lpad(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS STRING), 3, '0')
       ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) END AS "Precio",
  {_pick("((l_orderkey + l_linenumber) % 10)", FUEL_TEXT)} AS "Combustible",
  {_pick("((l_orderkey + l_suppkey) % 7)", GEAR_TEXT)} AS "Caja",
  {_pick("((l_partkey + l_linenumber) % 10)", POWER_TEXT)} AS "Cilindrada",
  CASE WHEN l_orderkey % 23 = 3 THEN 'híbrido enchufable'
       WHEN l_orderkey % 19 = 1 THEN '19'
       WHEN l_orderkey % 19 = 2 THEN NULL
       WHEN l_orderkey % 19 = 3 THEN '1989'
       WHEN l_orderkey % 3 = 0 THEN '0' || CAST(l_linenumber AS STRING) || '/' || CAST(year(o_orderdate) + 18 AS STRING)
       ELSE CAST(year(o_orderdate) + 18 AS STRING) END AS "AnyoMatriculacion",
  {_pick("((l_suppkey + l_linenumber) % 5)", PROVINCE_TEXT)} AS "Provincia",
  CASE WHEN l_orderkey % 17 = 0 THEN NULL
       WHEN l_orderkey % 17 = 1 THEN CAST(year(l_shipdate) + 26 AS STRING) || '-05-01'
       ELSE lpad(CAST(day(l_shipdate) AS STRING), 2, '0') || '/' || lpad(CAST(month(l_shipdate) AS STRING), 2, '0')
            || ' ' || CAST(l_orderkey % 24 AS STRING) || ':' || CAST(l_partkey % 60 AS STRING) END AS "Publicacion",
  make_date(year(l_shipdate) + 26, month(l_shipdate), least(day(l_shipdate), 28)) AS "ExtractedDate",
  CASE WHEN l_returnflag = 'R' THEN 'FINANCIADO' ELSE ' SIN FINANCIACIÓN' END AS "Financiado",
  {_pick("(l_suppkey % 7)", SITE_TEXT)} AS "Web",
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'PARTICULAR' WHEN o_orderpriority = '2-HIGH' THEN 'PROFESIONAL'
       ELSE 'Profesional' END AS "Venta",
  CASE WHEN l_orderkey % 13 = 0 THEN NULL
       WHEN l_orderkey % 13 = 1 THEN 'https://example.org/nothing'
       ELSE 'https://example.org/' || CAST(l_orderkey AS STRING) || '/' || lower(p_brand) || '-a3-autoscout24.es#fotos' END AS "Links",
  CASE WHEN l_suppkey % 7 IN (1, 3) THEN NULL WHEN l_orderkey % 31 = 0 THEN 'x'
       ELSE CAST(year(l_shipdate) + 26 AS STRING) END AS "PublicacionAnyo"
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
"""

LISTING_BRANDS = [
    "ALFA ROMEO", "MERCEDES-BENZ", "SEAT", "AUDI", "BMW", "KIA", "OPEL", "FORD", "MINI", "LAND ROVER",
]
# Typed listings in the silver shape.
LISTING = f"""
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 41 = 7 THEN NULL WHEN l_linenumber = 6 THEN 'DACIA'
       ELSE {_pick(f"({BN} % 10)", LISTING_BRANDS)} END AS "Brand",
  CASE WHEN l_orderkey % 9 = 4 THEN 'OTHER' ELSE upper(split_part(p_name, ' ', 2))
       || CASE WHEN p_partkey % 3 = 0 THEN ' ' || CAST(p_size % 4 AS STRING) WHEN p_partkey % 3 = 1 THEN '-X' ELSE '' END END AS "Model",
  upper(p_name) AS "Finish",
  CASE WHEN l_orderkey % 97 = 3 THEN '' ELSE upper(p_name) || ' ' || p_type ||
       CASE l_partkey % 5 WHEN 0 THEN ' 2.0 TDI (GTI' WHEN 1 THEN ' 5P NAVI' WHEN 2 THEN ' (' WHEN 3 THEN ' RO' ELSE '  (DSG) X' END END AS "Features",
  CAST(CAST(l_quantity AS INT) * 7000 AS BIGINT) AS "Kms",
  CAST(floor(l_extendedprice) AS DOUBLE) AS "Price",
  CASE WHEN l_orderkey % 15 = 2 THEN 'GLP' WHEN l_partkey % 2 = 0 THEN 'GASOLINA' ELSE 'DIESEL' END AS "Fuel",
  CASE WHEN l_linestatus = 'O' THEN 'MANUAL' ELSE 'AUTOMATICO' END AS "Gearbox",
  CASE WHEN l_orderkey % 33 = 1 THEN NULL
       ELSE CAST(p_size * 10 + CASE WHEN l_linenumber = 5 THEN 4 WHEN l_linenumber = 7 THEN 5 ELSE 0 END
            + CASE WHEN l_orderkey % 501 = 0 THEN 400 ELSE 0 END AS DOUBLE) END AS "CV",
  CAST(year(o_orderdate) + 9 AS BIGINT) AS "Registration",
  CAST(year(l_shipdate) + 26 - (year(o_orderdate) + 26 - (l_suppkey % 22)) AS BIGINT) AS "Age",
  CASE WHEN l_orderkey % 27 = 1 THEN NULL WHEN l_orderkey % 1501 = 2 THEN 'RARE' ELSE p_type END AS "Segment",
  CASE WHEN l_suppkey % 2 = 0 THEN 'LAS PALMAS' ELSE 'S/C TENERIFE' END AS "Province",
  CAST(make_date(year(l_shipdate) + 26, month(l_shipdate), least(day(l_shipdate), 28)) AS TIMESTAMP) AS "Publication",
  CAST(make_date(year(l_shipdate) + 26, month(l_shipdate), least(day(l_shipdate), 28)) AS TIMESTAMP) AS "ExtractedDate",
  CASE WHEN l_suppkey % 9 = 0 THEN 'CICAR' WHEN l_suppkey % 11 = 0 THEN 'COMPRAMOSTUCOCHE.ES' ELSE 'CARPLUS' END AS "Web",
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Particular' WHEN o_orderpriority = '5-LOW' AND l_linenumber = 4 THEN NULL
       ELSE 'Profesional' END AS "Sale"
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
"""

# Clean new-price list in its published shape, one row per part.
PRICE_LIST = f"""
SELECT p_partkey,
  {_pick(f"({BN} % 10)", LISTING_BRANDS)} AS "Brand",
  upper(split_part(p_name, ' ', 2))
       || CASE WHEN p_partkey % 3 = 0 THEN ' ' || CAST(p_size % 4 AS STRING) WHEN p_partkey % 3 = 1 THEN '-X' ELSE '' END AS "Model",
  CAST(p_size * 10 AS INT) AS "CV",
  CASE WHEN p_partkey % 2 = 0 THEN 'GASOLINA' ELSE 'DIESEL' END AS "Fuel",
  p_retailprice AS "Price",
  CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_name || ' ' || p_type ||
       CASE p_partkey % 4 WHEN 0 THEN ' gti/sport' WHEN 1 THEN ' 1.6 NAVI' WHEN 2 THEN ' (DSG) (' ELSE ' tdi' END END AS "Features",
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS "Segment",
  CAST(2003 + p_partkey % 6 AS INT) AS "StarDate",
  CAST(2003 + p_partkey % 6 + p_partkey % 4 AS INT) AS "EndDate"
FROM part
"""

RAW_BRANDS = ["BMW", "VOLVO", "ALFA-ROMEO", "LAND ROVER", "MAZDA", "Citroën", "FORD", "SEAT ", "KIA", "Škoda"]
RAW_MODELS = [
    "XC 60 ", "MAZDA 3 ", "Serie 3 ", "X M ", "V 40 ", "ALFA 147 ", "Range Rover Velar ", "Range Evoque Sport ", "Clase A ",
    "C-HR ", "León ", "Golf", "V x ", "X 5P ",
]
# Raw price list as published by the authority.
PRICE_RAW = f"""
SELECT p_partkey,
  {_pick(f"({BN} % 10)", RAW_BRANDS)} AS "Marca",
  {_pick("(p_partkey % 14)", RAW_MODELS)} || CASE WHEN p_partkey % 14 = 11 THEN '' ELSE p_name || ' ' || p_type END AS "Modelo",
  CASE p_partkey % 6 WHEN 0 THEN '2015-2019' WHEN 1 THEN '2018-' WHEN 2 THEN '2018-nan' WHEN 3 THEN 'nan-nan'
       WHEN 4 THEN '2001-2004' ELSE '2012' END AS "Matriculacion",
  {_pick("(p_partkey % 9)", ["G", "D", "ELC", "GLP", "CNG", "GyD", "S", "GyE", "??"])} AS "Combustible",
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(p_size * 10 AS STRING) END AS "Cilindrada_CV",
  CAST(p_retailprice AS STRING) AS "Precios"
FROM part
"""

# Segment dictionaries: the current workbook and the historical list.
SEGMENT_BOOK = f"""
SELECT p_partkey AS seq, {_pick(f"({BN} % 10)", RAW_BRANDS)} AS "Marca",
  ' ' || {_pick("(p_partkey % 14)", [m.strip() for m in RAW_MODELS])} AS "Modelo_Cube", p_type AS "Segmento"
FROM part
"""
SEGMENT_HISTORY = f"""
SELECT p_partkey AS seq, {_pick(f"({BN} % 10)", ["BMW", "VOLVO", "ALFAROMEO", "LANDROVER", "MAZDA", "CITROEN", "FORD", "SEAT", "KIA", "SKODA"])} AS "Marca",
  {_pick("(p_partkey % 5)", ["XC60", "3", "CHR", "LEON", "147"])} AS "Modelo_Cube", lower(p_type) AS "Segmento"
FROM part
"""
# Dictionary in the shape the silver job joins to.
SEGMENT_SILVER = f"""
SELECT p_partkey AS seq, {_pick(f"({BN} % 10)", ["Audi ", "ALFAROMEO", "LANDROVER", "CITROËN", "MERCEDES", "SEAT", "BMW", "TOYOTA", "FORD", "KIA"])} AS "Brand",
  {_pick("(p_partkey % 10)", ["A3", "C-HR", "Clase A", "ID.3", "Golf", "HI LUX", "Land Cruiser", "serie", "MITO ", "Space Star"])} AS "Model_Cube",
  p_type AS "Segment"
FROM part
"""

# Scored rows: actual and predicted price.
SCORED = f"""
SELECT {_pick(f"({BN} % 10)", LISTING_BRANDS)} AS "Brand", l_extendedprice AS y_real,
  l_extendedprice * (0.9 + 0.2 * ((l_orderkey * 7919 + l_partkey * 31) % 1009) / 1009.0E0)
    + CASE WHEN l_orderkey % 40 = 0 THEN l_quantity * 700.25E0 ELSE 0.0E0 END AS y_pred
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

# Golden patterns for enrichment and modelling.
GOLDEN = f"""
SELECT {_pick(f"({BN} % 10)", LISTING_BRANDS)} AS "Brand", upper(split_part(p_name, ' ', 2)) AS "Model",
  CAST(10 + (length(p_name) * 37 + {BN}) % 50 AS DOUBLE) AS "Shortage",
  CASE WHEN l_partkey % 2 = 0 THEN 'GASOLINA' ELSE 'DIESEL' END AS "Fuel",
  CASE WHEN l_linestatus = 'O' THEN 'MANUAL' ELSE 'AUTOMATICO' END AS "Gearbox",
  CAST(p_size * 10 AS DOUBLE) AS "CV", p_type AS "Segment", CAST(CAST(l_quantity AS INT) * 5000 AS BIGINT) AS "Kms",
  CAST(floor(l_extendedprice) AS DOUBLE) AS "Price", CAST(l_suppkey % 20 AS BIGINT) AS "Age",
  CASE WHEN l_returnflag = 'R' THEN 'Particular' ELSE 'Profesional' END AS "Sale",
  p_retailprice * 20.5E0 AS "PriceMed"
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

# Client requests, one per customer.
CLIENTS = f"""
SELECT c_custkey,
  CASE WHEN c_custkey % 11 = 0 THEN 'NOBODY' ELSE {_pick("(c_custkey % 10)", LISTING_BRANDS)} END AS "Brand",
  {_pick("(c_nationkey % 9)", ["BOLT", "GEAR", "ROD", "RING", "PLATE", "ANVIL", "GIZMO", "WIDGET", "NONE"])} AS "Model",
  CAST((c_custkey * 7) % 520 AS INT) AS "CV", CASE WHEN c_custkey % 3 = 0 THEN 'GASOLINA' ELSE 'DIESEL' END AS "Fuel",
  'MANUAL' AS "Gearbox", c_mktsegment AS "Segment", CAST(c_custkey * 100 AS BIGINT) AS "Kms",
  CAST(c_custkey % 23 AS INT) AS "Age", 'Particular' AS "Sale"
FROM customer
"""

# Listing pages as the sites show them: every text field of a listing, in each site's layout.
_DOTTED = (
    "CASE WHEN l_extendedprice >= 1000 THEN CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS STRING) || '.' || "
    "lpad(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS STRING), 3, '0') ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) END"
)
_FB = _pick("(l_partkey % 8)", ["Audi", "TOYOTA", "Land", "Mercedes", "Ducati", "BMW", "Citroën", "Silence"])
_FM = _pick("((l_partkey + l_suppkey) % 7)", ["CLASE", "SERIE", "A3", "Nuevo", "LAND", "León", "Serie"])
_FF = _pick("(l_orderkey % 7)", ["Gasolina", "Diesel", "Eléctrico", "Híbrido (enchufable)", "5 puertas", "híbrido", "GLP"])
_FG = _pick("(l_suppkey % 8)", ["Manual", "Automática", "S tronic", "DSG 7", "manual 6 vel", "Automático", "Manual S tronic", "Manual DSG"])
_FK = "CAST(CAST(l_quantity AS INT) AS STRING) || '.' || lpad(CAST(l_partkey % 1000 AS STRING), 3, '0') || ' km'"
_FP = "CASE WHEN l_orderkey % 13 = 0 THEN '85 kW' ELSE '85 kW (' || CAST(p_size * 5 AS STRING) || ' CV)' END"
_FY = "CASE WHEN l_orderkey % 11 = 0 THEN '2014' ELSE '0' || CAST(l_linenumber AS STRING) || '/' || CAST(year(l_shipdate) + 15 AS STRING) END"
FICHA = f"""
SELECT l_orderkey, l_linenumber, title, price, kms, power, year_text, gear, fuel, province, label, link,
  CASE WHEN l_orderkey % 3 = 0 THEN list_value(kms, gear, year_text, fuel, power || CASE WHEN l_partkey % 5 = 0 THEN ' PARTICULAR' ELSE '' END) END AS spans,
  CASE WHEN l_orderkey % 2 = 0 THEN kms || chr(10) || year_text || chr(10) || power || chr(10) || 'a' || chr(10) || 'b' || chr(10) || gear || chr(10) || fuel
       ELSE kms || chr(10) || gear || chr(10) || year_text || chr(10) || fuel || chr(10) || power END AS block,
  'Euro 6' || chr(10) || '99 CV' || chr(10) || power || chr(10) || CAST(p_size AS STRING) || ' CV' || chr(10) || 'x' AS details,
  CASE WHEN l_orderkey % 4 = 0 THEN 'Nuevo ' ELSE '' END || brand || ' ' || model || CASE WHEN l_linenumber = 2 THEN ' Plus' ELSE '' END || ' x' AS market_brand,
  'Coche 1.5 ' || p_type || CASE WHEN l_linenumber = 3 THEN '' ELSE ' | ' || year_text || ' | x' END AS market_features,
  'Marca:' || chr(10) || ' ' || brand || chr(10) || 'Modelo:' || chr(10) || model || chr(10) || 'Versión:' || chr(10) || p_name || chr(10)
    || 'Kilómetros:' || chr(10) || kms || chr(10) || 'Precio:' || chr(10) || price || chr(10) || 'Combustible:' || chr(10) || fuel || chr(10)
    || 'Cambio:' || chr(10) || gear || chr(10) || 'Potencia(CV):' || chr(10) || CAST(p_size AS STRING) || chr(10)
    || CASE WHEN l_linenumber = 1 THEN 'Año:' || chr(10) || '2019' WHEN l_linenumber = 2 THEN 'Año Desde:' || chr(10) || '2018' ELSE 'Año:' || chr(10) || year_text END
    || CASE WHEN l_orderkey % 17 = 0 THEN '' ELSE chr(10) || 'Fin' END AS label_text,
  'Marca: ' || brand || chr(10) || 'Modelo :' || model || chr(10) || 'Versión: ' || p_name || chr(10) || 'Kilómetros: ' || kms || chr(10)
    || 'Precio contado: ' || price || CASE WHEN l_linenumber = 2 THEN chr(10) || 'Precio: 9.999 €' ELSE '' END || chr(10) || 'Combustible: ' || fuel || chr(10)
    || CASE WHEN l_orderkey % 17 = 0 THEN '' ELSE 'Cambio: ' || gear || chr(10) END || 'Potencia(CV): ' || CAST(p_size AS STRING) || chr(10) || 'Año Desde: 2018'
    || CASE WHEN l_linenumber = 3 THEN chr(10) || 'Año: 2020' ELSE '' END || CASE WHEN l_linenumber = 4 THEN chr(10) || 'PrecioFinanciado: 1' ELSE '' END AS colon_text
FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, p_name, p_type, p_size, {_FB} AS brand, {_FM} AS model,
    {_FB} || ' ' || {_FM} || chr(10) || p_name || ' - x ' || p_type AS title,
    {_DOTTED} || CASE WHEN l_linenumber = 5 THEN ' € 1.500 €' WHEN l_linenumber = 6 THEN ',50 €' ELSE ' €' END AS price,
    {_FK} AS kms, {_FP} AS power, {_FY} AS year_text, {_FG} AS gear, {_FF} AS fuel,
    CASE WHEN l_suppkey % 2 = 0 THEN 'Las Palmas' ELSE 'S/C Tenerife' END AS province,
    CASE WHEN l_returnflag = 'R' THEN ' Financiado ' ELSE 'Contado' END AS label, 'https://example.org/' || CAST(l_orderkey AS STRING) AS link
  FROM lineitem JOIN part ON l_partkey = p_partkey
) f
"""
# One page per part, with a definition list.
PART_PAGES = f"""
SELECT p_partkey AS page_id, 'https://example.org/' || CAST(p_partkey AS STRING) AS url,
  '<html><body><h1 class="titulo-pagina">' || {_pick("(p_partkey % 6)", ["Toyota LAND", "Land Rover", "Mercedes CLASE A", "BMW SERIE 3", "Seat León", "Audi A3"])}
  || ' ' || p_name || '</h1><dl><dt>Precio</dt><dd class="ddprecio"><strong>' || CAST(p_size AS STRING) || '.500'
  || CASE WHEN p_partkey % 8 = 0 THEN ' 9.900 €' WHEN p_partkey % 4 = 0 THEN ' € 9.900 €' ELSE ' €' END || '</strong></dd><dt>Versión<dd>' || p_type || ' &amp; ' || p_name
  || '<dt>Matriculación</dt><dd> 0' || CAST(p_partkey % 9 + 1 AS STRING) || '/20' || CAST(p_partkey % 14 + 10 AS STRING)
  || '</dd><dt>Combustible</dt><dd>' || {_pick("(p_partkey % 5)", ["gasolina", "Diesel", "híbrido", "5 puertas", "Gas"])}
  || '</dd><dt>Kilómetros</dt><dd>' || CAST(p_size AS STRING) || '.000 Km</dd><dt>Potencia máxima</dt><dd>' || CAST(p_size * 3 AS STRING)
  || ' CV (85 kW)</dd>' || CASE WHEN p_partkey % 3 = 0 THEN '<dt>Cambio</dt><dd>Manual</dd>' ELSE '' END || '</dl><span class="lugar">'
  || CASE WHEN p_partkey % 2 = 0 THEN 'Las Palmas de G.C.' ELSE 'Adeje' END || '</span><section class="datos-vendedor">'
  || CASE WHEN p_partkey % 7 = 0 THEN 'Particular' ELSE 'Concesionario' END || '</section></body></html>' AS html
FROM part
"""

VIEWS = {
    "ficha": FICHA,
    "part_pages": PART_PAGES,
    "bronze": BRONZE,
    "listing": LISTING,
    "price_list": PRICE_LIST,
    "price_raw": PRICE_RAW,
    "segment_book": SEGMENT_BOOK,
    "segment_history": SEGMENT_HISTORY,
    "segment_silver": SEGMENT_SILVER,
    "scored": SCORED,
    "golden": GOLDEN,
    "clients": CLIENTS,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Views that long rule chains start from.  Sums of floating numbers depend on the order of rows, so the others stay as they are read.
DEALT = {"ficha", "part_pages", "bronze", "listing", "price_raw"}


def dealt(df: DataFrame) -> DataFrame:
    """The rows of a table of fewer splits than cores on all cores: a given table is one file with one row group."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named view as a DataFrame; only the tables it mentions are read.

    The size of a file says little about its columns in memory: millions of keys pass for a few
    megabytes and would be broadcast, so tables joined to are counted.  Large ones are shuffled, and each
    task holds its part of them only; the rows they are joined to are neither held nor sorted.
    """
    text = spark_text(VIEWS[name])
    used = [t for t in TABLES if f" {t} " in text.replace("\n", " ") + " "]
    frames = {}
    for t in used:
        text = text.replace(f"FROM {t} ", f"FROM {{{t}}} ").replace(f"FROM {t}\n", f"FROM {{{t}}}\n")
        text = text.replace(f"JOIN {t} ", f"JOIN {{{t}}} ")
        frames[t] = dealt(table(spark, sf_dir, t)) if name in DEALT and t in ("lineitem", "part") else table(spark, sf_dir, t)
        if f"JOIN {{{t}}} " in text and table(spark, sf_dir, t).count() > BROADCAST_ROWS:
            frames[t] = frames[t].hint("shuffle_hash")
    return spark.sql(text, **frames)


def cte(*names: str) -> str:
    """The named views as the head of a checking query."""
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)
