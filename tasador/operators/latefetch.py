"""One row per key, chosen on narrow rows; the wide rows are fetched afterwards.

`keyed.keep_first` folds whole rows: structs with texts cannot live in a hash
aggregate, so every wide row is sorted before the exchange and after it, also
where hardly a key comes twice.  Here the choice sees two hashes of the key and
one number for the order, in hash aggregates.  Its result is the list of *contested*
keys, those with several rows; a row whose key is not on it stays where it is.
Only rows that tie in the order are compared column by column.  With too many
contested keys to broadcast, a filter of fixed size holds a bit for each; the rows that
it lets pass, all rows of those keys and few others, are stored and go through the plain
aggregate a part of the keys at a time.

The input is read two times, three where rows tie or the filter is used, so it should be a table or
stored; after long computations the plain aggregate is the better one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasador.operators import keyed
from tasador.operators.keyed import BROADCAST_BYTES, BROADCAST_ROWS, fits_broadcast
from tasador.session import cut_lineage, discard, store

_BITS = {T.BooleanType: 1, T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.DateType: 32, T.LongType: 64, T.TimestampType: 64}
_LARGEST = 126
"""Bits that a decimal of 38 digits holds."""
_WIDE = "decimal(38,0)"


KEY = ["_key1", "_key2"]


def key_hashes(keys: Sequence[str]) -> dict[str, Column]:
    """Two 64-bit hashes of a key under different seeds, by name; null equals null, also beside other columns.

    Two keys of 10**12 meet by chance with a probability below 10**-14.
    """
    parts = [p for k in keys for p in (F.col(f"`{k}`"), F.col(f"`{k}`").isNull())]
    return {name: F.xxhash64(F.lit(i), *parts) for i, name in enumerate(KEY)}


def packed_rank(df: DataFrame, order: Sequence[Column | str]) -> Column:
    """One number that orders like `order` taken column after column, nulls first.

    Whole numbers, dates, timestamps and booleans only; with more bits than a
    decimal holds a ValueError.  Up to 63 bits the number is a bigint.
    """
    columns = [F.col(f"`{o}`") if isinstance(o, str) else o for o in order]
    kinds = [f.dataType for f in df.select(*[c.alias(f"o{i}") for i, c in enumerate(columns)]).schema]
    if any(type(k) not in _BITS for k in kinds):
        raise ValueError(f"an order of fixed-width whole numbers is needed, not {kinds}")
    widths = [_BITS[type(k)] + 1 for k in kinds]
    if sum(widths) > _LARGEST:
        raise ValueError(f"an order of {sum(widths)} bits is too wide")
    number = "bigint" if sum(widths) <= 63 else _WIDE
    whole = lambda n: F.lit(Decimal(n)).cast(number)
    rank = whole(0)
    for column, kind, width in zip(columns, kinds, widths):
        if isinstance(kind, T.DateType):
            column = F.unix_date(column)
        elif isinstance(kind, T.TimestampType):
            column = F.unix_micros(column)
        elif isinstance(kind, T.BooleanType):
            column = column.cast("int")
        # Null is 0, the lowest value 1.
        below = whole(-1 if width == 2 else -(1 << (width - 2)) - 1)
        place = F.coalesce(column.cast(number), below) - below
        rank = (rank * whole(1 << width) + place).cast(number)
    return rank


def contested(narrow: DataFrame, greatest: bool) -> DataFrame:
    """(KEY, _best, _ties, _rows) of every key of (KEY, _rank) with several rows; `_ties` of them are the best.

    Equal pairs are counted first, so a key of a third of all rows is one row per
    input partition and rank.
    """
    pairs = narrow.groupBy(*KEY, "_rank").agg(F.count(F.lit(1)).alias("n"))
    best, ties = (F.max, F.max_by) if greatest else (F.min, F.min_by)
    keys = pairs.groupBy(*KEY).agg(best("_rank").alias("_best"), ties("n", "_rank").alias("_ties"), F.sum("n").alias("_rows"))
    return keys.filter(F.col("_rows") > 1)


FILTER_CELLS = 1 << 20
"""Words of 64 bits in the filter of contested keys: a table of at most so many rows, whatever the input."""


def _cell() -> Column:
    return F.pmod(F.shiftright(KEY[0], 6), F.lit(FILTER_CELLS))


def _bit() -> Column:
    return F.col(KEY[0]).bitwiseAND(F.lit(63)).cast("int")


def _one_bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at)


def contested_bits(known: DataFrame) -> DataFrame:
    """(_at, _bits): a bit for every key of `known`; few other keys share one, the more the more keys there are."""
    return known.select(_cell().alias("_at"), _bit().alias("_bit")).groupBy("_at").agg(F.bit_or(_one_bit(F.col("_bit"))).alias("_bits"))


def _marked(hashed: DataFrame, bits: DataFrame) -> DataFrame:
    """`hashed` plus `_maybe`: whether the row's key has a bit."""
    met = hashed.withColumns({"_at": _cell(), "_bit": _bit()}).join(F.broadcast(bits), "_at", "left")
    return met.withColumn("_maybe", F.coalesce((F.col("_bits").bitwiseAND(_one_bit(F.col("_bit")))) != 0, F.lit(False)))


def _filtered(hashed: DataFrame, known: DataFrame, columns: Sequence[str], fold: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`fold` of the rows whose key has a bit, beside the others as they are.

    All rows of a key pass the filter or none does, so the others are alone with their keys and stay.
    """
    marked, own = _marked(hashed, contested_bits(known)), [f"`{c}`" for c in columns]
    return marked.filter(~F.col("_maybe")).select(*own).unionByName(fold(marked.filter("_maybe").select(*own)))


ROWS_PER_ROUND = 2_000_000
"""Rows of contested keys that are exchanged at a time."""
MOST_ROUNDS = 64


def _filtered_in_rounds(hashed: DataFrame, known: DataFrame, rows: int, columns: Sequence[str], fold: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`_filtered` for `rows` rows of contested keys: the rows with a bit are stored by parts of the keys and folded one part after the other.

    What is exchanged at once does not grow with the rows, up to `MOST_ROUNDS` times `ROWS_PER_ROUND`; stored rows take a fraction of their room in an exchange.
    """
    rounds = max(1, min(MOST_ROUNDS, math.ceil(rows / ROWS_PER_ROUND)))
    marked, own = _marked(hashed, cut_lineage(contested_bits(known))), [f"`{c}`" for c in columns]
    part = F.pmod(KEY[1], F.lit(rounds)).cast("int").alias("_part")
    maybe = store(marked.filter("_maybe").select(*own, part), "_part")
    folded = [store(fold(maybe.filter(F.col("_part") == i).select(*own))) for i in range(rounds)]
    discard(maybe)
    return reduce(DataFrame.unionByName, folded, marked.filter(~F.col("_maybe")).select(*own))


def fold_repeated(df: DataFrame, keys: Sequence[str], fold: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`fold(df)`, for a fold that works key by key and returns a row as it is if no other has its key; null equals null.

    Rows are exchanged by one hash of the key, to find the keys that come more than
    once; only their rows, and the few that share a bit with them, take part in the fold.
    It is one query, so that exchanges inside `df` are made once and read three times;
    computations after the last of them are made three times.  Equal keys need equal
    hashes, so with keys of other kinds than texts, whole numbers, dates, timestamps and booleans all rows are folded.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    if len(kinds) < len(df.columns) or any(type(kinds[k]) not in _BITS and kinds[k] != T.StringType() for k in keys):
        return fold(df)
    # Nulls leave no trace in it, which costs a few rows more; with tests for null beside the columns, plans of many computed columns take minutes.
    key = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    known = df.select(key.alias(KEY[0])).groupBy(KEY[0]).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 1)
    return _filtered(df.withColumn(KEY[0], key), known, df.columns, fold)


def _fetch(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], greatest: bool, max_rows: int, max_bytes: int) -> DataFrame:
    ranked = df.withColumns({**key_hashes(keys), "_rank": packed_rank(df, order)})
    known = cut_lineage(contested(ranked.select(*KEY, "_rank"), greatest))
    some, tied, total = known.agg(F.count(F.lit(1)), F.count_if(F.col("_ties") > 1), F.sum("_rows")).first()
    if not some:
        return df

    pick = keyed.keep_last if greatest else keyed.keep_first
    winner = F.col("_rank") == F.col("_best")
    apart, alone, ties = F.col("_best").isNull(), winner & (F.col("_ties") == 1), winner & (F.col("_ties") > 1)
    marks = known.select(*KEY, "_best", "_ties")
    if not fits_broadcast(marks, max_rows, max_bytes):
        return _filtered_in_rounds(ranked, known, total, df.columns, lambda rows: pick(rows, list(keys), order))
    joined = ranked.join(F.broadcast(marks), KEY, "left")
    chosen, equals = joined.filter(apart | alone), joined.filter(ties)
    chosen = chosen.select(*[f"`{c}`" for c in df.columns])
    if not tied:
        return chosen
    # Equal in key and order: the smallest or greatest row decides, as in the plain aggregate.
    rows = equals.select(*KEY, *[f"`{c}`" for c in df.columns])
    return chosen.unionByName(pick(rows, KEY, []).drop(*KEY))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of `keyed.keep_last`, by late fetch; `order` of whole numbers, dates, timestamps or booleans."""
    return _fetch(df, keys, order, True, max_rows, max_bytes)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of `keyed.keep_first`, by late fetch; `order` of whole numbers, dates, timestamps or booleans."""
    return _fetch(df, keys, order, False, max_rows, max_bytes)
