"""Cleaning rules for listings, one Column function each.

A rule never raises: where the text lacks the piece a rule needs, the old value
stays or the result is null, as each docstring says.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tasador.functions.text import capitalise, drop_text, fold_accents, has, number, strip, token, tokens, whole

# Labels the silver table uses, and the words the rules look for.
FUELS = ["GASOLINA", "DIESEL", "ELECTRICO/HIBRIDO", "GLP"]
HYBRID = "ELECTRICO/HIBRIDO"
GEARBOXES = ["Manual", "Automatico", "Semiautomatico", "Doble embrague", "Semi-automatico"]
AUTOMATIC = "Automático"
COMPOUND_MODELS = ["clase", "santa", "mini", "grand", "serie", "land"]
PROVINCES = ["S/C TENERIFE", "LAS PALMAS"]
JUNK_PROVINCE = "AÑO DE MATRICULACIÓN:"
UNKNOWN_BRANDS = ["NO SE SABE", "NOSESABE"]
PRICE_RANGE = (1_000, 150_000)
MAX_KMS = 1_000_000
MIN_REGISTRATION = 1990
RECENT_FROM = "2024-01-01"


# -- before the row rules -------------------------------------------------


def brand_prep(brand: Column) -> Column:
    return F.replace(
        F.replace(capitalise(brand), F.lit("-"), F.lit(" ")), F.lit("Mercedes benz"), F.lit("Mercedes")
    )


def cv_prep(cv: Column) -> Column:
    return drop_text(cv, " CV")


# -- row rules, in the order they apply -----------------------------------


def brand_digit(brand: Column) -> Column:
    """Null when empty or when it starts with a digit."""
    return F.when((F.length(brand) > 0) & ~brand.rlike("^[0-9]"), brand)


def fuel_plain(text: Column) -> Column:
    return F.upper(fold_accents(text))


def fuel(plain: Column) -> Column:
    """Label of a plain upper-case fuel text; anything off the list is null."""
    return F.when(plain.contains("HIBRIDO") | plain.contains("ELECTRICO"), F.lit(HYBRID)).when(
        plain.isin(FUELS), plain
    )


def gear_plain(text: Column) -> Column:
    return strip(fold_accents(text))


def gearbox(plain: Column, synonyms: Mapping[str, str] | None = None) -> Column:
    """Known gearboxes only; `synonyms` may map further plain spellings onto the known ones."""
    out = F.when(plain == "Manual", F.lit("Manual")).when(plain.isin(GEARBOXES), F.lit(AUTOMATIC))
    for spelling, known in (synonyms or {}).items():
        out = out.when(plain == spelling, F.lit("Manual" if known == "Manual" else AUTOMATIC))
    return out


def cv(text: Column) -> Column:
    """Two or three characters, starting with a digit, no watts; below 50 a hundred is missing."""
    usable = F.length(text).between(2, 3) & text.rlike("^[0-9]") & ~F.lower(text).contains("w")
    value = number(F.when(usable, text))
    return F.when(value < 50, value + 100).otherwise(value)


def price_text(text: Column) -> Column:
    """A dot in stripped text must be a thousands dot: exactly three characters after the first one."""
    dot = F.instr(text, ".")
    return F.when((dot == 0) | (F.length(text) - dot == 3), text)


def plugin_shift(year: Column, kms: Column) -> tuple[Column, Column]:
    """Plug-in listings carry "year kms" in the distance field."""
    shifted = F.coalesce(year.contains("enchufable") & kms.isNotNull(), F.lit(False))
    return (
        F.when(shifted, token(kms, 0)).otherwise(year),
        F.when(shifted, F.coalesce(token(kms, 1), kms)).otherwise(kms),
    )


def year_part(year: Column) -> Column:
    """ "MM/YYYY" to "YYYY"."""
    return F.when(year.contains("/"), token(year, 1, "/")).otherwise(year)


def year_length(year: Column) -> Column:
    return F.when(F.length(year) == 4, year)


def publication_text(publication: Column, year: Column, as_of: Column) -> Column:
    """Prefix the year the stamp lacks; a missing stamp becomes the run's own."""
    known = F.coalesce(whole(year), F.year(as_of).cast("bigint")).cast("string")
    return F.coalesce(F.concat(known, F.lit("/"), publication), F.date_format(as_of, "yyyy/dd/MM HH:mm"))


def model_default(model: Column, features: Column) -> Column:
    return F.coalesce(model, token(features, 0))


def alfa_model(brand: Column, model: Column) -> Column:
    return F.when(F.lower(brand) == "alfa", F.coalesce(token(model, 1), model)).otherwise(model)


def family(model: Column) -> Column:
    return F.when(F.lower(model).rlike("|".join(COMPOUND_MODELS)), model).otherwise(token(model, 0))


def land_family(model: Column, fam: Column, features: Column) -> tuple[Column, Column]:
    """Land and Hiace; nothing happens without features."""
    hiace = F.lower(features).contains("hiace")
    name = F.when(hiace, F.lit("Hiace")).when(
        features.isNotNull() & (F.lower(fam) == "land"), F.lit("Land Cruiser")
    )
    return F.coalesce(name, model), F.coalesce(name, fam)


def space_family(model: Column, fam: Column) -> tuple[Column, Column]:
    is_space = F.lower(fam) == "space"
    return (
        F.when(is_space, F.lit("Space Star")).otherwise(model),
        F.when(is_space, F.lit("Space Star")).otherwise(fam),
    )


def named_family(brand: Column, fam: Column, features: Column) -> Column:
    """Range, Serie and one-letter Mercedes classes (no family can be two of these)."""
    low = F.lower(fam)
    return (
        F.when(low == "range", F.lit("Range Rover"))
        .when(low == "serie", F.concat(fam, F.lit(" "), F.coalesce(token(features, 0), F.lit("None"))))
        .when((brand == "Mercedes") & (F.length(fam) == 1), F.concat(F.lit("Clase "), fam))
        .otherwise(fam)
    )


def new_family(fam: Column, features: Column) -> Column:
    """ "nuevo" is no family: the first features token is."""
    return F.when(F.lower(fam).contains("nuevo"), F.coalesce(token(features, 0), fam)).otherwise(fam)


def audi_family(fam: Column, features: Column) -> Column:
    return F.when(fam == "Audi", F.coalesce(token(features, 0), fam)).otherwise(fam)


def link_check(link: Column, brand: Column, model: Column, fam: Column, site: Column) -> Column:
    """Keep a link that mentions the vehicle or its site; any missing operand drops it."""
    text = F.lower(link)
    named = None
    for part in (brand, model, fam, site):
        hit = text.contains(F.lower(part))
        named = hit if named is None else named | hit
    present = link.isNotNull() & brand.isNotNull() & model.isNotNull() & fam.isNotNull() & site.isNotNull()
    return F.when(present & named, link)


def finish_append(model: Column, features: Column) -> Column:
    """The model followed by every features token longer than four characters."""
    long_tokens = F.filter(tokens(features), lambda t: F.length(t) > 4)
    return F.when(model.isNotNull(), F.concat_ws(" ", model, long_tokens))


# -- after the row rules --------------------------------------------------


def parse_publication(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyy/d/M H:m"))


def drop_dots(text: Column) -> Column:
    return drop_text(text, ".")


def brand_map(brand: Column) -> Column:
    low = F.lower(brand)
    return (
        F.when(low.contains("opel"), F.lit("Opel"))
        .when(low.contains("hyundai"), F.lit("Hyundai"))
        .when(brand == "Land", F.lit("Land rover"))
        .when(brand == "Citroën", F.lit("Citroen"))
        .when(brand == "Alfa", F.lit("Alfa romeo"))
        .otherwise(brand)
    )


def null_token(text: Column) -> Column:
    return F.when(~text.isin("nan", "None"), text)


def kms_digit(kms: Column) -> Column:
    return F.coalesce(kms.rlike("^[0-9]+$"), F.lit(False))


def age(extracted: Column, registration: Column) -> Column:
    return F.year(extracted).cast("bigint") - registration


def link_anchor(link: Column) -> Column:
    return drop_text(link, "#fotos")


def model_override(model: Column, features: Column) -> Column:
    low = F.lower(model)
    return (
        F.when(has(features, "MITO"), F.lit("MITO"))
        .when(low.contains("santa"), F.lit("SANTA FE"))
        .when(low.contains("rover"), F.lit("RANGE ROVER"))
        .otherwise(model)
    )


def segment_fix(segment: Column, model: Column) -> Column:
    return (
        F.when(F.lower(model).contains("cooper"), F.lit("A0"))
        .when(model == "TUCSON", F.lit("SUVA"))
        .when(model == "SANTA FE", F.lit("SUVB"))
        .otherwise(segment)
    )


def klasse(model: Column) -> Column:
    return strip(drop_text(model, "KLASSE", "CLASE"))


def publication_clamp(publication: Column, extracted: Column) -> Column:
    """No listing was published after it was seen; an unknown date is the sighting."""
    return F.least(F.coalesce(publication, extracted), extracted)


def sale_case(sale: Column) -> Column:
    return F.when(sale.isin("PROFESIONAL", "PARTICULAR"), capitalise(sale)).otherwise(sale)


def brand_eq_model(brand: Column, model: Column, features: Column) -> Column:
    """A model that repeats the brand is read from the features instead."""
    first = F.coalesce(F.upper(token(features, 0)), features)
    second = F.coalesce(F.upper(token(features, 1)), features)
    return F.when(brand == model, F.when(brand == first, second).otherwise(first)).otherwise(model)


def spaceless(brand: Column) -> Column:
    return drop_text(strip(brand), " ")


def brand_final(brand: Column) -> Column:
    """Last name of a spaceless brand; null where the row is to be dropped."""
    return (
        F.when(brand.contains("RENAULT"), F.lit("RENAULT"))
        .when(brand == "VW", F.lit("VOLKSWAGEN"))
        .when(brand == "ASTON", F.lit("ASTONMARTIN"))
        .when(brand == "DSAUTOMOBILES", F.lit("DS"))
        .when(brand.rlike(r"(?U)^[\w\s]*$") & ~brand.isin(UNKNOWN_BRANDS), brand)
    )


def model_final(model: Column) -> Column:
    """Spaceless, hyphenless model; null where the row is to be dropped."""
    named = (
        F.when(model == "CEE'D", F.lit("CEED"))
        .when(model == "UP!", F.lit("UP"))
        .when(model.rlike(r"^ID\.[1-9]+$"), drop_text(model, "."))
        .when((strip(model) != "") & ~model.isin("NUEVO", "|"), model)
    )
    return drop_text(named, "-", " ")


def gear_final(gear: Column) -> Column:
    return F.when(F.lower(gear) == "automático", F.lit("AUTOMATICO")).otherwise(gear)


# -- row predicates -------------------------------------------------------


def in_range(price: Column, kms: Column, registration: Column) -> Column:
    return price.between(*PRICE_RANGE) & (kms <= MAX_KMS) & (registration >= MIN_REGISTRATION)


def p_dot_kept(model: Column) -> Column:
    """Rows whose first "P." is the second character go."""
    return F.instr(model, "P.") != 2


def province_kept(province: Column) -> Column:
    return province.isin(PROVINCES) & (province != JUNK_PROVINCE)


# -- keys -----------------------------------------------------------------


def text_key(columns: list[Column]) -> Column:
    """The columns as one text, a missing value written "None"."""
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("None")) for c in columns])


def digest(columns: list[Column], bits: int = 224) -> Column:
    return F.sha2(text_key(columns), bits)


def exact_key(columns: list[Column]) -> Column:
    """One fixed-width key for many columns: equal exactly when all of them are (null equals null)."""
    parts = [F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns]
    return F.unhex(F.sha2(F.concat_ws("\x1f", *parts), 256))


def surrogate(hex_digest: Column) -> Column:
    """An integer in [0, 9999999) that is the same for the same vehicle on every run."""
    return F.conv(F.substring(hex_digest, 1, 12), 16, 10).cast("bigint") % F.lit(9_999_999)
