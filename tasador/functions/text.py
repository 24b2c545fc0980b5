"""Text helpers shared by extraction, cleaning and matching."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Blank characters that a full strip removes (plain `trim` knows only U+0020).
BLANKS = " \t\n\r\x0b\x0c\x85\xa0"


def _single_letter_folds() -> dict[str, str]:
    """Latin-1 and Latin Extended-A letters whose decomposition starts with a plain letter."""
    folds = {}
    for code in range(0xC0, 0x180):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base.isascii() and base.isalpha():
            folds[chr(code)] = base
    # Letters that do not decompose, and ordinals; fixed values.
    folds.update({"Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ł": "L", "ł": "l", "ı": "i", "º": "o", "ª": "a"})
    folds.update({"\xa0": " ", "’": "'", "‘": "'", "–": "-", "—": "-"})
    return folds


_FOLDS = _single_letter_folds()
_FOLD_FROM = "".join(_FOLDS)
_FOLD_TO = "".join(_FOLDS.values())
# Letters that fold to two characters; fixed values.
_PAIRS = {"ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "€": "EUR"}


def fold_accents(c: Column) -> Column:
    """Plain ASCII spelling: accents off, ligatures spelt out, loose combining marks removed.

    Text of as many bytes as characters is ASCII already and skips the work.
    """
    out = F.translate(c, _FOLD_FROM, _FOLD_TO)
    for letter, pair in _PAIRS.items():
        out = F.replace(out, F.lit(letter), F.lit(pair))
    folded = F.regexp_replace(out, r"\p{Mn}", "")
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(folded)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def capitalise(c: Column) -> Column:
    """First character upper, the rest lower (`initcap` would raise every word)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def drop_text(c: Column, *pieces: str) -> Column:
    """Remove literal pieces of text."""
    for piece in pieces:
        c = F.replace(c, F.lit(piece), F.lit(""))
    return c


def respell(c: Column, spellings: dict[str, str]) -> Column:
    """Whole-text replacements; anything else stays."""
    out = F
    for wrong, right in spellings.items():
        out = out.when(c == wrong, F.lit(right))
    return out.otherwise(c)


def token(c: Column, index: int, sep: str = " ") -> Column:
    """The index-th piece of a split on a literal separator; null when there is none."""
    parts = F.split(c, F.lit("\\Q" + sep + "\\E"), F.lit(-1))
    return F.get(parts, index) if index >= 0 else F.try_element_at(parts, F.lit(index))


def tokens(c: Column, sep: str = " ") -> Column:
    return F.split(c, F.lit("\\Q" + sep + "\\E"), F.lit(-1))


def tokens_after(c: Column, index: int) -> Column:
    """Space-joined tokens from position `index` (0-based) on; empty text when none are left."""
    parts = tokens(c)
    return F.array_join(F.slice(parts, index + 1, F.greatest(F.size(parts) - index, F.lit(0))), " ")


def alphanumeric(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z0-9]", "")


def has(c: Column, piece: str) -> Column:
    """Contains, with null read as no."""
    return F.coalesce(c.contains(piece), F.lit(False))


NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def number(c: Column) -> Column:
    """Text to double, null where it is not a plain number (Java would accept `1d`)."""
    return F.when(c.rlike(NUMBER), F.trim(c).try_cast("double"))


def whole(c: Column) -> Column:
    return F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(c).try_cast("bigint"))


def nfkd(c: Column) -> Column:
    """Compatibility decomposition; Spark has no such function, so one Arrow batch UDF."""
    @F.pandas_udf("string")
    def normalise(batch: pd.Series) -> pd.Series:
        return batch.str.normalize("NFKD")

    return normalise(c)


def bag_tokens(c: Column) -> Column:
    """Telling tokens of a description, upper case.

    Dropped: empties, and tokens that without "(" start with a digit or have at
    most one character.  A token that is nothing but "(" stays.
    """

    def telling(t: Column) -> Column:
        bare = strip(F.replace(t, F.lit("("), F.lit("")))
        return (t != "") & ((bare == "") | ((F.length(bare) > 1) & ~bare.rlike("^[0-9]")))

    return F.transform(F.filter(tokens(c), telling), lambda t: F.upper(t))


def bag(c: Column) -> Column:
    """The telling tokens as one text."""
    return F.array_join(bag_tokens(c), " ")
