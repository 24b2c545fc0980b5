"""The listing sites: page fields to bronze rows.

Each function takes one row per listing with the texts of its page and returns
bronze columns.  A listing that lacks a field its site always shows is dropped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador import schemas
from tasador.functions import fields
from tasador.functions.text import drop_text, number, strip, token, tokens
from tasador.operators.steps import counted
from tasador.plans.silver import stamp as _stamp


def stamp(df: DataFrame, site: str, as_of, day_only: bool = False, sale: str | None = None) -> DataFrame:
    """Site name, sighting date, publication stamp without its year, and the year."""
    now = _stamp(as_of)
    published = F.date_format(now, "yyyy-MM-dd" if day_only else "dd/MM H:m")
    columns = {"Web": F.lit(site), "ExtractedDate": now.cast("date"), "Publicacion": published}
    if not day_only:
        columns["PublicacionAnyo"] = F.year(now).cast("string")
    if sale:
        columns["Venta"] = F.lit(sale)
    return df.withColumns(columns)


def project(df: DataFrame) -> DataFrame:
    """Bronze columns in their order; a column the site never fills is left out."""
    return df.select(*[n for n in schemas.BRONZE.names if n in df.columns])


def with_required(df: DataFrame, *names: str) -> DataFrame:
    """Only listings that have every one of the fields."""
    return df.dropna(subset=list(names))


def _all(*columns: Column) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])


def layout(spans: Column, block: Column) -> Column:
    """Technical fields from the first of three layouts that has them all; null when none has."""
    lines = tokens(block, "\n")

    def candidate(kms: Column, gear: Column, year: Column, fuel: Column, power: Column) -> Column:
        power = fields.power_in_brackets(power)
        full = F.struct(
            kms.alias("kms"), gear.alias("gear"), year.alias("year"), fuel.alias("fuel"), power.alias("power")
        )
        return F.when(_all(kms, gear, year, fuel, power), full)

    return F.coalesce(
        candidate(*[F.get(spans, i) for i in range(5)]),
        candidate(F.get(lines, 0), F.get(lines, 5), F.get(lines, 1), F.get(lines, 6), F.get(lines, 2)),
        candidate(F.get(lines, 0), F.get(lines, 1), F.get(lines, 2), F.get(lines, 3), F.get(lines, 4)),
    )


def autoscout(df: DataFrame, as_of, site: str = "Autoscout24.es") -> DataFrame:
    """Input: title, link, price, spans (array), block (text), province."""
    df = df.withColumn("_layout", layout(F.col("spans"), F.col("block")))
    year = fields.year_after_slash(F.col("_layout.year"))
    df = df.withColumn("AnyoMatriculacion", year).filter(F.col("AnyoMatriculacion").isNotNull())
    title = F.replace("title", F.lit("\n"), F.lit(" "))
    out = df.select(
        fields.title_brand(title).alias("Marca"),
        fields.title_model(title).alias("Modelo"),
        title.alias("Caracteristicas"),
        token(strip(drop_text(F.col("_layout.kms"), ".", "kms", "km")), 0).alias("Kms"),
        fields.price(F.col("price"), ",").alias("Precio"),
        F.when(F.col("_layout.fuel") == "Eléctrico", F.lit("Eléctrico/Híbrido")).otherwise(F.col("_layout.fuel")).alias("Combustible"),
        strip(F.col("_layout.gear")).alias("Caja"),
        token(F.col("_layout.power"), 0).alias("Cilindrada"),
        "AnyoMatriculacion",
        F.col("province").alias("Provincia"),
        F.lit(fields.NOT_FINANCED).alias("Financiado"),
        F.when(F.get("spans", F.lit(4)).contains("PARTICULAR"), F.lit(fields.PRIVATE)).otherwise(F.lit(fields.TRADE)).alias("Venta"),
        F.col("link").alias("Links"),
    )
    return project(stamp(out, site, as_of))


def carmarket(df: DataFrame, as_of, site: str = "CarMarket") -> DataFrame:
    """Input: brand, features, price, kms, fuel, gear, power, link."""
    features = fields.drop_first_word(F.col("features"))
    middle = fields.middle_words(F.col("brand"))
    out = df.select(
        token(strip(drop_text(F.col("brand"), "Nuevo")), 0).alias("Marca"),
        F.when(middle == "", token(features, 0)).otherwise(middle).alias("Modelo"),
        features.alias("Caracteristicas"),
        fields.no_float_tail(number(drop_text(F.col("kms"), "km")).cast("bigint")).alias("Kms"),
        fields.no_float_tail(number(drop_text(F.col("price"), "€", ".")).cast("bigint")).alias("Precio"),
        fields.title_case(F.col("fuel")).alias("Combustible"),
        F.col("gear").alias("Caja"),
        fields.no_float_tail(number(drop_text(F.col("power"), " CV")).cast("bigint")).alias("Cilindrada"),
        fields.year_after_bar(features).alias("AnyoMatriculacion"),
        F.lit("Las Palmas").alias("Provincia"),
        F.lit(fields.FINANCED).alias("Financiado"),
        F.lit(fields.TRADE).alias("Venta"),
        F.col("link").alias("Links"),
    )
    out = out.filter(~F.col("Marca").isin(fields.SKIPPED_BRANDS)).transform(with_required, "AnyoMatriculacion", "Modelo", "Caja")
    out = out.withColumn("Caja", fields.gear_market(F.col("Caja")))
    return project(stamp(out, site, as_of, day_only=True))


def carplus(df: DataFrame, as_of, site: str = "Carplus") -> DataFrame:
    """Input: title, features, year, kms, fuel, gear, price, label, details, link."""
    power = fields.power_last_line(F.col("details"))
    out = df.filter(fields.is_vehicle(F.col("title"))).select(
        fields.title_brand(F.col("title")).alias("Marca"),
        fields.title_model_not_new(F.col("title")).alias("Modelo"),
        F.upper("features").alias("Caracteristicas"),
        strip(drop_text(F.col("kms"), "km")).alias("Kms"),
        fields.price(F.col("price")).alias("Precio"),
        strip(F.col("fuel")).alias("Combustible"),
        fields.title_case(fields.gear_by_name(strip(F.col("gear")))).alias("Caja"),
        power.alias("Cilindrada"),
        F.col("year").alias("AnyoMatriculacion"),
        F.lit(fields.PLACE_PALMAS).alias("Provincia"),
        fields.financed_by_label(F.col("label")).alias("Financiado"),
        F.col("link").alias("Links"),
    )
    return project(stamp(with_required(out, "Modelo", "Cilindrada").distinct(), site, as_of, sale=fields.TRADE))


# Labels of a listing's fields; fixed values.
LABELS = {
    "Marca": ["Marca"],
    "Modelo": ["Modelo"],
    "Caracteristicas": ["Versión"],
    "Kms": ["Kilómetros"],
    "Precio": ["Precio"],
    "Combustible": ["Combustible"],
    "Caja": ["Cambio"],
    "Cilindrada": ["Potencia(CV)"],
    "AnyoMatriculacion": ["Año", "Año Desde"],
}


def labelled_fields(df: DataFrame, text: str) -> DataFrame:
    """Bronze fields from "Label:" lines followed by their value; of two labels the first present counts."""
    # The lines are split once, as a column of their own; the fields then only look values up.
    df = df.withColumn("_lines", tokens(F.col(text), "\n"))
    found = {
        name: F.coalesce(*[fields.labelled(F.col("_lines"), f"{label}:") for label in labels])
        for name, labels in LABELS.items()
    }
    return with_required(counted(df.withColumns(found).drop("_lines"), "labelled"), *LABELS)


def keyed_fields(df: DataFrame, text: str, financed_key: str | None = None) -> DataFrame:
    """Bronze fields from "Key: value" lines; of two keys the last one present counts."""
    synonyms = {**LABELS, "Precio": ["Precio", "Precio contado"]}
    df = df.withColumn("_lines", fields.key_lines(F.col(text)))
    found = {name: fields.last_of(F.col("_lines"), keys) for name, keys in synonyms.items()}
    flag = fields.has_key(F.col("_lines"), financed_key) if financed_key else F.lit(False)
    df = df.withColumns({**found, "Financiado": fields.financed(flag)}).drop("_lines")
    return with_required(counted(df, "keyed"), *LABELS)


def km0(df: DataFrame, as_of, site: str = "TuKm0") -> DataFrame:
    """Input: text (label lines), link."""
    df = labelled_fields(df, "text")
    out = df.withColumns(
        {
            "Precio": fields.price(F.col("Precio"), "€"),
            "Kms": strip(drop_text(F.col("Kms"), ".")),
            "Combustible": fields.fuel_hybrid_label(F.col("Combustible")),
            "Modelo": fields.model_serie(F.col("Modelo"), F.col("Caracteristicas")),
            "Financiado": F.lit(fields.NOT_FINANCED),
            "Provincia": F.lit("Las Palmas"),
            "Venta": F.lit(fields.TRADE),
            "Links": F.col("link"),
        }
    )
    return project(stamp(out, site, as_of, day_only=True))


def mleon(df: DataFrame, as_of, site: str = "Mleon", financed_key: str | None = None) -> DataFrame:
    """Input: text ("Key: value" lines), link."""
    out = keyed_fields(df, "text", financed_key).withColumns(
        {
            "Caracteristicas": F.upper("Caracteristicas"),
            "Precio": fields.price(F.col("Precio")),
            "Provincia": F.lit(fields.PLACE_PALMAS),
            "Venta": F.lit(fields.TRADE),
            "Links": F.col("link"),
        }
    )
    return stamp(project(out).distinct(), site, as_of).transform(project)


def motores(df: DataFrame, as_of, site: str = "MotorES") -> DataFrame:
    """Input: title, price, terms (map of term to definition), place, sheet, vendor, link."""

    def term(word: str) -> Column:
        hits = F.filter(F.map_keys("terms"), lambda k: k.contains(word))
        return F.col("terms")[F.try_element_at(hits, F.lit(1))]

    brand = F.upper(fields.title_brand(F.col("title")))
    model = fields.title_model_two_words(F.col("title"))
    gear = F.when(fields.has(F.col("sheet"), "Manual"), F.lit("Manual")).otherwise(F.lit("Automático"))
    out = df.select(
        brand.alias("Marca"),
        model.alias("Modelo"),
        strip(F.concat(brand, F.lit(" "), model, F.lit(" "), F.col("terms")["Versión"])).alias("Caracteristicas"),
        fields.kms(term("Kilómetros"), "Km").alias("Kms"),
        token(strip(drop_text(F.col("price"), ".", "€", "\n")), 0).alias("Precio"),
        term("Combustible").alias("fuel"),
        gear.alias("gear"),
        fields.power_before_unit(term("Potencia")).alias("Cilindrada"),
        fields.year_last_slash(term("Matriculación")).alias("AnyoMatriculacion"),
        fields.province(F.col("place")).alias("Provincia"),
        fields.financed_by_second_price(F.col("price")).alias("Financiado"),
        fields.seller(F.col("vendor")).alias("Venta"),
        F.col("link").alias("Links"),
    )
    out = with_required(out, "Modelo", "Caracteristicas", "Kms", "Precio", "fuel", "Cilindrada", "AnyoMatriculacion")
    out = out.filter(~F.col("fuel").contains("puertas")).distinct()
    out = out.withColumns(
        {
            "Caja": fields.mapped(F.col("gear"), fields.GEAR_MOTOR),
            "Combustible": fields.mapped(F.col("fuel"), fields.FUEL_MOTOR),
            "Modelo": fields.model_fixup(F.col("Marca"), F.col("Modelo")),
            "Marca": fields.brand_fixup(F.col("Marca")),
        }
    )
    return project(stamp(out, site, as_of))
