"""The official new-price list: raw rows to the published table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador import schemas
from tasador.functions.text import alphanumeric, drop_text, fold_accents, nfkd, number, strip, token, tokens_after
from tasador.operators.keyed import keep_last, lookup
from tasador.operators.steps import counted
from tasador.plans.silver import stamp

# Fuel codes of the list; fixed values.
FUEL_CODES = {
    "G": "GASOLINA",
    "D": "DIESEL",
    "ELC": "ELECTRICO/HIBRIDO",
    "GLP": "GLP",
    "CNG": "GLP",
    "GyD": "ELECTRICO/HIBRIDO",
    "S": "GLP",
    "GyE": "ELECTRICO/HIBRIDO",
}
MIN_END = 2005


def clean_headers(df: DataFrame) -> DataFrame:
    """Workbook headers without accents or edge blanks, texts without non-breaking spaces."""
    texts = {f.name for f in df.schema if f.dataType.simpleString() == "string"}

    def plain(name: str) -> str:
        import unicodedata

        return "".join(ch for ch in unicodedata.normalize("NFD", name) if not unicodedata.combining(ch)).strip()

    return df.select(
        *[(drop_text(F.col(f"`{n}`"), "\xa0") if n in texts else F.col(f"`{n}`")).alias(plain(n)) for n in df.columns]
    )


def normal_model(df: DataFrame) -> DataFrame:
    return df.withColumn("Modelo", nfkd(F.col("Modelo")))


def segment_book(book: DataFrame, order: list[str]) -> DataFrame:
    """Distinct (Marca, Modelo_Cube, Segmento) of the workbook under plain keys; `order` columns kept."""
    triple = ["Marca", "Modelo_Cube", "Segmento"]
    last = keep_last(book.select(*triple, *order), triple, order)
    brand = alphanumeric(fold_accents(F.upper(strip(F.col("Marca")))))
    model = alphanumeric(fold_accents(F.upper(strip(F.col("Modelo_Cube")))))
    return last.withColumns({"Marca": brand, "Modelo_Cube": drop_text(model, "CLASE")})


def segment_merge(book: DataFrame, history: DataFrame, order: list[str]) -> DataFrame:
    """One row per (Marca, Modelo_Cube), the historical list overriding the workbook."""
    both = book.withColumn("_rank", F.lit(0)).unionByName(history.withColumn("_rank", F.lit(1)))
    return keep_last(both, ["Marca", "Modelo_Cube"], ["_rank", *order]).drop("_rank", *order)


def map_fuel(df: DataFrame) -> DataFrame:
    pairs = [F.lit(x) for pair in FUEL_CODES.items() for x in pair]
    return df.withColumn("Combustible", F.create_map(*pairs)[F.col("Combustible")]).dropna(subset=["Combustible"])


def split_model(df: DataFrame) -> DataFrame:
    """Full model text to `Modelo` and `Caracteristicas`, with the per-brand exceptions.

    Where fewer than two characters of features are left at the Volvo test, the
    features become "-" and the rules after it do not apply.
    """
    model, rest = F.col("Modelo"), F.col("Caracteristicas")

    def shift(frame: DataFrame, when: Column, joined: bool = True) -> DataFrame:
        head = F.concat(model, token(rest, 0)) if joined else token(rest, 0)
        return frame.withColumns(
            {
                "Modelo": F.when(when, head).otherwise(model),
                "Caracteristicas": F.when(when, tokens_after(rest, 1)).otherwise(rest),
            }
        )

    df = df.withColumns({"Caracteristicas": tokens_after(model, 1), "Modelo": token(model, 0)})
    df = shift(df, model.isin("XC", "MAZDA"))
    df = shift(df, (F.col("Marca") == "BMW") & (F.length(token(rest, 0)) == 1))
    df = df.withColumn("_ok", F.coalesce(F.length(rest) >= 2, F.lit(False)))
    ok = F.col("_ok")
    df = shift(df, ok & (F.col("Marca") == "VOLVO") & (F.length(model) == 1) & F.substring(rest, 2, 1).rlike("[0-9]"))
    df = shift(df, ok & (model == "ALFA"), joined=False)
    df = df.withColumn("_range", ok & (strip(model) == "Range"))
    df = shift(df, F.col("_range"))
    df = shift(df, F.col("_range") & token(rest, 0).isin("Velar", "Evoque"))
    return df.withColumn("Caracteristicas", F.when(ok, rest).otherwise(F.lit("-"))).drop("_ok", "_range")


def period(df: DataFrame, as_of) -> DataFrame:
    """ "start-end" to the two years; what is missing or does not parse is the current year."""
    now = F.year(stamp(as_of)).cast("double")
    end = token(F.col("Matriculacion"), 1, "-")
    df = df.withColumns(
        {
            "StarDate": F.coalesce(number(token(F.col("Matriculacion"), 0, "-")), now),
            "EndDate": F.coalesce(number(F.when(F.length(end) >= 3, end)), now),
        }
    )
    return df.filter(F.col("EndDate") >= MIN_END).drop("Matriculacion")


def normalise(df: DataFrame) -> DataFrame:
    """Plain upper-case keys and numeric price and power."""
    return df.withColumns(
        {
            "Marca": alphanumeric(F.upper(fold_accents(strip(F.col("Marca"))))),
            "Modelo": alphanumeric(F.upper(fold_accents(strip(F.col("Modelo"))))),
            "Precios": number(F.col("Precios")),
            "Cilindrada_CV": number(F.col("Cilindrada_CV")),
        }
    )


def join_segment(df: DataFrame, segments: DataFrame) -> DataFrame:
    return lookup(df, segments.withColumnRenamed("Modelo_Cube", "Modelo"), ["Marca", "Modelo"])


def publish(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """English names and declared types; whole numbers default to 0."""
    df = df.withColumnsRenamed(schemas.PRICE_NAMES)
    whole = {"CV", "StarDate", "EndDate"}
    return df.select(
        *extra,
        *[
            (F.coalesce(F.col(f.name), F.lit(0)).cast("int") if f.name in whole else F.col(f.name).cast(f.dataType)).alias(f.name)
            for f in schemas.PRICE_LIST
        ],
    )


def build_price_list(
    raw: DataFrame, segments: DataFrame, as_of, extra: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """The full list and its part with a known segment; `segments` is a `segment_merge`."""
    split = counted(split_model(counted(period(map_fuel(normal_model(raw)), as_of), "in period")), "split")
    full = publish(join_segment(normalise(split), segments), extra)
    return full, full.filter(F.col("Segment").isNotNull())
