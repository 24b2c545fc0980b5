"""The whole cleaning job on raw listings built by hand."""

import datetime as dt

import pytest
from pyspark.sql import Observation

from tasador import schemas
from tasador.plans import silver as S

AS_OF = "2024-06-01 10:00:00"


def row(**changes):
    base = dict(
        Marca="Audi", Modelo="A3", Caracteristicas="Sportback tdi Quattro", Kms="45.000", Precio="12.500",
        Combustible="Gasolina", Caja="Manual", Cilindrada="115 CV", AnyoMatriculacion="05/2019", Provincia="Las Palmas",
        Publicacion="15/05 9:7", ExtractedDate=dt.date(2024, 5, 20), Financiado="SIN FINANCIACIÓN", Web="Carplus",
        Venta="PROFESIONAL", Links="https://x/audi#fotos", PublicacionAnyo="2024",
    )
    base.update(changes)
    return tuple(base[n] for n in schemas.BRONZE.names)


ROWS = [
    row(),
    row(),
    row(Marca="Mercedes-benz", Modelo="CLASE A", Precio="900"),
    row(Marca="Mercedes-benz", Modelo="CLASE A", Precio=" 15000 "),
    row(Marca="Mini", Modelo="Mini", Caracteristicas="Mini cooper"),
    row(Marca="VW", Modelo="UP!", Links=None),
    row(Marca="Land", Modelo="Range Evoque", Kms="N/D"),
    row(Marca="Land", Modelo="Range Evoque", Kms="1000000"),
    row(Marca="9bad"),
    row(Provincia="Madrid", Precio="20000"),
    row(ExtractedDate=dt.date(2023, 12, 31), Precio="20001"),
    row(Publicacion="2024-05-01", Precio="20002"),
    row(Modelo=None, Caracteristicas=None, Precio="20003"),
    row(AnyoMatriculacion="1989", Precio="20004"),
]


@pytest.fixture(scope="module")
def inputs(spark):
    bronze = spark.createDataFrame(ROWS, schemas.BRONZE)
    segments = S.segment_dimension(
        spark.createDataFrame([("Audi", "A3", "A", 1), ("AUDI", "A3 ", "B", 2), (None, None, "x", 3)], "Brand string, Model_Cube string, Segment string, seq int"), ["seq"]
    )
    prices = S.fallback_dimension(
        spark.createDataFrame([("VOLKSWAGEN", "UP", "A00", 1), ("LAND ROVER", "RANGEROVER", "SUV", 2)], "Brand string, Model string, Segment string, seq int"), ["seq"]
    )
    return bronze, segments, prices


@pytest.fixture(scope="module")
def silver(inputs):
    return S.build_silver(*inputs, AS_OF)


def test_schema_and_rows(silver):
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in schemas.SILVER]
    got = sorted((r.Brand, r.Model, r.Segment, r.Price) for r in silver.collect())
    assert got == [
        ("AUDI", "A3", "B", 12500.0),
        ("AUDI", "A3", "B", 20002.0),
        ("LANDROVER", "RANGEROVER", "SUV", 12500.0),
        ("MERCEDES", "A", None, 15000.0),
        ("MINI", "COOPER", None, 12500.0),
        ("VOLKSWAGEN", "UP", "A00", 12500.0),
    ]


def test_typed_values(silver):
    r = silver.filter("Brand = 'AUDI' and Price = 12500").first()
    assert (r.Kms, r.CV, r.Registration, r.Age, r.Fuel, r.Gearbox, r.Sale) == (45000, 115.0, 2019, 5, "GASOLINA", "MANUAL", "Profesional")
    assert r.Finish == "A3 SPORTBACK QUATTRO" and r.Links == "https://x/audi"
    assert r.Publication == dt.datetime(2024, 5, 15, 9, 7) and len(r.Id) == 56
    late = silver.filter("Price = 20002").first()
    assert late.Publication == dt.datetime(2024, 5, 20)


def test_running_on_its_own_output_changes_nothing(inputs, silver):
    again = S.build_silver(*inputs, AS_OF, history=silver)
    assert again.exceptAll(silver).count() == 0 and silver.exceptAll(again).count() == 0


def test_new_rows_replace_old_ones(spark, inputs, silver):
    bronze, segments, prices = inputs
    later = spark.createDataFrame([row(ExtractedDate=dt.date(2024, 5, 28), Venta="PARTICULAR")], schemas.BRONZE)
    out = S.build_silver(later, segments, prices, AS_OF, history=silver)
    assert out.count() == silver.count()
    assert out.filter("Brand = 'AUDI' and Price = 12500").first().Sale == "Particular"


def test_order_of_input_does_not_matter(inputs, silver):
    bronze, segments, prices = inputs
    other = S.build_silver(bronze.orderBy("Precio").repartition(3), segments, prices, AS_OF)
    assert other.exceptAll(silver).count() == 0


def test_a_batch_without_a_column(inputs):
    bronze, segments, prices = inputs
    out = S.build_silver(bronze.drop("PublicacionAnyo"), segments, prices, AS_OF)
    assert out.filter("Brand = 'VOLKSWAGEN'").count() == 1


def test_counts_come_with_the_job(inputs):
    counts = {"incoming": Observation("incoming"), "cleaned": Observation("cleaned")}
    S.build_silver(*inputs, AS_OF, counts=counts).collect()
    assert counts["incoming"].get["rows"] == 13 and counts["cleaned"].get["rows"] < 13


def test_plan_stays_in_the_jvm_and_small(inputs):
    plan = S.build_silver(*inputs, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "Window" not in plan
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan
    assert len(plan) < 60_000


def test_kms_estimate_for_one_site(spark):
    df = spark.createDataFrame([("CICAR", "A", 2, 5), ("CICAR", "Z", 2, 5), ("X", "A", 2, 5)], "Web string, Segment string, Age bigint, Kms bigint")
    ratios = spark.createDataFrame([("A", 1000.0)], "Segment string, Ratio_Kms_Age double")
    assert sorted(r.Kms for r in S.estimate_kms(df, ratios).collect()) == [5, 5, 2000]
