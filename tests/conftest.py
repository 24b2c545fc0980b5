import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tasador.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def apply_rule(spark):
    """Values of one rule over rows given as tuples of texts."""

    def run(rule, rows, schema):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
        return [r[0] for r in df.orderBy("i").select(rule(*[F.col(c) for c in df.columns[1:]])).collect()]

    return run


DAY = dt.date(2024, 6, 1)
