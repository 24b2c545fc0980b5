"""The registry of dense numbers."""

import random

import pytest
from pyspark.sql import functions as F

from tasador.operators import numbers as N


def keys(spark, values, parts=3):
    return spark.createDataFrame([(v,) for v in values], "text string").select(F.encode("text", "UTF-8").alias("key")).repartition(parts)


@pytest.mark.parametrize("parts", [1, 5])
def test_numbers_are_dense_kept_and_independent_of_partitions(spark, tmp_path, parts):
    draw, folder = random.Random(3), str(tmp_path / "numbers")
    values = [f"k{i:05d}" for i in range(500)]
    draw.shuffle(values)
    first = {bytes(r.key).decode(): r.number for r in N.register(keys(spark, values[:300] * 2 + [None], parts), folder).collect()}
    assert first == {v: i for i, v in enumerate(sorted(values[:300]))}
    again = {bytes(r.key).decode(): r.number for r in N.register(keys(spark, values, 7 - parts), folder).collect()}
    assert {k: again[k] for k in first} == first
    assert [k for k, _ in sorted(again.items(), key=lambda x: x[1])[300:]] == sorted(values[300:])
    assert sorted(again.values()) == list(range(500))
    assert N.register(keys(spark, []), folder).count() == 500


def test_rows_get_the_numbers_of_their_keys(spark, tmp_path):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(300, None)], "i int, vehicle string")
    folder = str(tmp_path / "numbers")
    for _ in range(2):
        out = N.with_number(rows, F.encode("vehicle", "UTF-8"), folder, "number").collect()
        assert len(out) == 301 and len({r.number for r in out if r.vehicle}) == len({r.vehicle for r in out if r.vehicle}) == 101
        assert [r.number for r in out if r.vehicle is None] == [None] and max(r.number for r in out if r.vehicle) == 100


@pytest.mark.parametrize("most", [0, 1000])
def test_large_batches_meet_the_registry_without_a_semi_join(spark, tmp_path, monkeypatch, most):
    rows = spark.createDataFrame([(i, f"k{i % 90}") for i in range(300)], "i int, vehicle string")
    folder, key, met = str(tmp_path / "numbers"), F.encode("vehicle", "UTF-8"), []
    N.register(keys(spark, [f"k{i}" for i in range(50, 120)]), folder)
    plain = N.lookup
    monkeypatch.setattr(N, "lookup", lambda fact, dim, *args: met.append(dim.count()) or plain(fact, dim, *args))
    monkeypatch.setattr(N, "BROADCAST_ROWS", most)
    out = {r.vehicle: r.number for r in N.with_number(rows, key, folder, "number").collect()}
    assert met == [90 if most else 120]
    order = [*sorted(f"k{i}" for i in range(50, 120)), *sorted(f"k{i}" for i in range(50))]
    assert out == {v: i for i, v in enumerate(order) if int(v[1:]) < 90}


def test_vehicle_numbers_of_the_silver_table(spark, tmp_path):
    from tasador import schemas
    from tasador.plans.silver import with_registry_ids

    rows = spark.range(6).select((F.col("id") + 100).alias("VehicleId"), *[F.concat(F.lit(n), F.col("id") % 3).alias(n) for n in schemas.VEHICLE_PARTS])
    out = with_registry_ids(rows, str(tmp_path / "vehicles"))
    assert out.columns == rows.columns and sorted(r.VehicleId for r in out.collect()) == [0, 0, 1, 1, 2, 2]


def test_only_the_rows_that_are_returned_stay_stored(spark, tmp_path):
    """What the numbers are made of goes with the run, and nothing is checkpointed."""
    from pathlib import Path

    from tasador.session import shared_dir

    top = Path(shared_dir(spark).removeprefix("file:"))
    rows = spark.createDataFrame([(i, f"k{i % 90}") for i in range(300)], "i int, vehicle string")
    before = {*top.glob("stored-*")}, {*top.glob("*/rdd-*")}
    out = N.with_number(rows, F.encode("vehicle", "UTF-8"), str(tmp_path / "numbers"), "number")
    assert len({*top.glob("stored-*")} - before[0]) == 1 and {*top.glob("*/rdd-*")} <= before[1]
    assert sorted({r.number for r in out.collect()}) == list(range(90))
