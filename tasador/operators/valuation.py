"""Residual value from age and condition.

The tables are given; how they combine is this library's choice: price times the
percentage of the age in full years (the last one beyond the table) times the
condition's factor for cars younger than two years or older.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
RESIDUAL_PERCENT = [100, 84, 67, 56, 47, 39, 34, 28, 24, 19, 17, 13, 10]
CONDITION_YOUNG = {"Impecable": 1.05, "Muy Buena": 1.03, "Buena": 1.0, "Regular": 0.954}
CONDITION_OLD = {"Impecable": 1.067, "Muy Buena": 1.03, "Buena": 1.0, "Regular": 0.924}


def _factor(table: dict[str, float], state: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[state]


def residual_value(price: Column, age: Column, state: Column) -> Column:
    """Null for an unknown condition or a negative age."""
    place = F.least(age, F.lit(len(RESIDUAL_PERCENT) - 1)).cast("int")
    percent = F.get(F.array(*[F.lit(p) for p in RESIDUAL_PERCENT]), place)
    factor = F.when(age < 2, _factor(CONDITION_YOUNG, state)).otherwise(_factor(CONDITION_OLD, state))
    return price * percent / 100 * factor
