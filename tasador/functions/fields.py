"""Field rules of the listing sites: page text to bronze text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tasador.functions.text import capitalise, drop_text, has, respell, strip, token, tokens, tokens_after

# Fixed values.
FINANCED, NOT_FINANCED = "FINANCIADO", "SIN FINANCIACIÓN"
PRIVATE, TRADE = "Particular", "Profesional"
NON_VEHICLES = ["SILENCE", "MOTO", "DUCATI"]
SKIPPED_BRANDS = ["DUCATI", "HONDA"]
PLACE_PALMAS, PLACE_TENERIFE = "LAS PALMAS", "S/C TENERIFE"
GEAR_MARKET = {"S": "Automático", "Manual": "Manual", "Automática": "Automático"}
GEAR_MOTOR = {
    "manual": "Manual",
    "automatico": "Automático",
    "automat": "Automático",
    "Manual": "Manual",
    "Automático": "Automático",
}
FUEL_MOTOR = {
    "gasolina": "Gasolina",
    "diesel": "Diésel",
    "Gasolina": "Gasolina",
    "Diesel": "Diesel",
    "híbrido": "Híbrido",
    "hibrido": "Híbrido",
    "Híbrido": "Híbrido",
    "electrico": "Eléctrico",
    "eléctrico": "Eléctrico",
    "Eléctrico": "Eléctrico",
}


def price(text: Column, cut: str | None = None) -> Column:
    """Digits of a price; `cut` ends the number (decimals, a second price)."""
    whole = token(text, 0, cut) if cut else text
    return strip(drop_text(whole, ".", "€"))


def kms(text: Column, unit: str = "km") -> Column:
    return strip(drop_text(token(text, 0, unit), "."))


def power_in_brackets(text: Column) -> Column:
    """ "85 kW (115 CV)" to "115"; null without a bracket."""
    return strip(token(token(F.upper(text), 1, "("), 0, "CV"))


def power_before_unit(text: Column) -> Column:
    return drop_text(strip(token(text, 0, "CV")), ".")


def power_last_line(details: Column) -> Column:
    """The last line that names a power."""
    lines = F.filter(tokens(details, "\n"), lambda t: t.contains(" CV"))
    return strip(drop_text(F.try_element_at(lines, F.lit(-1)), "CV"))


def year_after_slash(text: Column) -> Column:
    return strip(token(text, 1, "/"))


def year_last_slash(text: Column) -> Column:
    return strip(token(text, -1, "/"))


def year_after_bar(text: Column) -> Column:
    return strip(token(text, 1, "|"))


def seller(text: Column) -> Column:
    return F.when(has(F.upper(text), "PARTICULAR"), F.lit(PRIVATE)).otherwise(F.lit(TRADE))


def financed(flag: Column) -> Column:
    return F.when(F.coalesce(flag, F.lit(False)), F.lit(FINANCED)).otherwise(F.lit(NOT_FINANCED))


def financed_by_label(label: Column) -> Column:
    return financed(F.upper(strip(label)) == FINANCED)


def financed_by_second_price(text: Column) -> Column:
    """A second price stands beside the first one."""
    second = token(strip(drop_text(text, ".", "€", "\n")), 1)
    return financed(F.length(second) > 1)


def province(place: Column) -> Column:
    return F.when(has(F.upper(place), "PALMAS"), F.lit(PLACE_PALMAS)).otherwise(F.lit(PLACE_TENERIFE))


def is_vehicle(title: Column) -> Column:
    return ~F.upper(title).rlike("|".join(NON_VEHICLES))


def title_brand(title: Column) -> Column:
    return strip(token(F.replace(title, F.lit("\n"), F.lit(" ")), 0))


def title_model(title: Column) -> Column:
    """Second word; the classes CLASE and SERIE also take the second word after the dash."""
    text = F.replace(title, F.lit("\n"), F.lit(" "))
    word = token(text, 1)
    extra = token(token(text, 1, " - "), 1)
    return F.when(word.isin("CLASE", "SERIE"), F.coalesce(F.concat(word, F.lit(" "), extra), word)).otherwise(word)


def title_model_two_words(title: Column) -> Column:
    """Upper-case second word, with the third for CLASE and SERIE."""
    word = F.upper(token(title, 1))
    both = F.upper(F.array_join(F.slice(tokens(title), 2, 2), " "))
    return F.when(word.contains("CLASE") | word.contains("SERIE"), both).otherwise(word)


def title_model_not_new(title: Column) -> Column:
    word = strip(token(title, 1))
    return F.when(F.upper(word).contains("NUEVO"), strip(token(title, 2))).otherwise(word)


def middle_words(text: Column) -> Column:
    parts = tokens(text)
    return F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0))), " ")


def mapped(c: Column, values: dict[str, str]) -> Column:
    """Value of a fixed map; anything else is null."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[c]


def gear_market(text: Column) -> Column:
    return mapped(capitalise(strip(token(text, 0))), GEAR_MARKET)


def gear_by_name(text: Column) -> Column:
    """Manual by its word, else automatic by a brand name of one; anything else stays."""
    upper = F.upper(text)
    return (
        F.when(text.contains("Manual"), F.lit("Manual"))
        .when(upper.contains("DSG") | upper.contains("TRONIC"), F.lit("Automática"))
        .otherwise(text)
    )


def title_case(text: Column) -> Column:
    """Every word with a capital first letter, the rest in lower case."""
    return F.initcap(text)


def fuel_hybrid_label(text: Column) -> Column:
    return F.when(text.contains("(") | text.contains("Eléctrico"), F.lit("Electrico/hibrido")).otherwise(text)


def model_serie(model: Column, features: Column) -> Column:
    return F.when(model.contains("Serie"), F.coalesce(token(features, 0), model)).otherwise(model)


def brand_fixup(brand: Column) -> Column:
    return respell(brand, {"LAND": "LAND ROVER", "MERCEDES": "MERCEDES BENZ"})


def model_fixup(brand: Column, model: Column) -> Column:
    return F.when((brand == "TOYOTA") & (model == "LAND"), F.lit("LAND CRUISER")).otherwise(model)


def no_float_tail(c: Column) -> Column:
    """ "12500.0" to "12500"."""
    return token(c.cast("string"), 0, ".")


def drop_first_word(text: Column) -> Column:
    return tokens_after(text, 1)


def labelled(lines: Column, label: str) -> Column:
    """The line after the first line that is exactly `label`.

    A search per label is compiled code; a map of all labels built once per row needs
    array functions with lambdas, which are interpreted and took five times as long.
    """
    at = F.array_position(lines, F.lit(label))
    return strip(F.when(at > 0, F.try_element_at(lines, (at + 1).cast("int"))))


def key_lines(text: Column) -> Column:
    """Lines "Key: value" as an array of (k, v); lines without a colon are left out."""
    lines = F.filter(tokens(text, "\n"), lambda t: t.contains(":"))
    parts = F.transform(lines, lambda t: F.split(t, ":", 3))
    return F.transform(parts, lambda p: F.struct(strip(p[0]).alias("k"), strip(p[1]).alias("v")))


def last_of(lines: Column, keys: list[str]) -> Column:
    """Value of whichever of several keys comes last in `key_lines`."""
    return F.try_element_at(F.filter(lines, lambda e: e["k"].isin(keys)), F.lit(-1))["v"]


def has_key(lines: Column, key: str) -> Column:
    return F.exists(lines, lambda e: e["k"] == key)
