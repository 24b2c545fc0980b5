"""Row counters between the steps of a plan."""

from __future__ import annotations

import itertools
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

_number = itertools.count()


def counted(df: DataFrame, step: str, counts: Mapping[str, Observation] | None = None) -> DataFrame:
    """Count the rows passing this step, without a job of its own.

    The counter also keeps later filters above the rules.  A filter pushed
    through a projection has the projection's expressions copied into it, once
    per mention; through a chain of rules that mention their input three or four
    times the copies multiply.
    """
    rows = F.count(F.lit(1)).alias("rows")
    if counts and step in counts:
        return df.observe(counts[step], rows)
    return df.observe(f"{step} {next(_number)}", rows)
