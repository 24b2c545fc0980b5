"""Guards of the jobs, the workbook, the record of models."""

import datetime as dt

import pytest
from test_silver import row

from tasador import schemas
from tasador.operators import model as M
from tasador.operators.bronze import EmptyBatch, StaleTable
from tasador.plans import jobs
from tasador.sources import sinks

AS_OF, LATER = "2024-05-22 10:00:00", "2024-06-22 10:00:00"
ORDER = {"book": ["seq"], "prices": ["seq"]}
PRICE_RAW = "Marca string, Modelo string, Matriculacion string, Combustible string, Cilindrada_CV string, Precios string"


@pytest.fixture(scope="module")
def sides(spark):
    names = [*schemas.SEGMENT_BOOK_NAMES, "seq"]
    book = spark.createDataFrame([tuple("Audi" if n == "Marca" else "A3" if n == "Modelo_Cube" else "C" if n == "Segmento" else "x" for n in names[:-1]) + (1,)], ", ".join(f"`{n}` string" for n in names[:-1]) + ", seq int")
    prices = spark.createDataFrame([("SEAT", "LEON", "C", 1)], "Brand string, Model string, Segment string, seq int")
    return book, prices


def test_silver_is_replaced_only_by_a_full_and_fresh_table(spark, sides, tmp_path):
    folder = str(tmp_path / "silver")
    bronze = spark.createDataFrame([row(), row(Precio="13.000")], schemas.BRONZE)
    with pytest.raises(EmptyBatch):
        jobs.refresh_silver(bronze.limit(0), *sides, folder, AS_OF, ORDER)
    with pytest.raises(StaleTable):
        jobs.refresh_silver(bronze, *sides, folder, LATER, ORDER)
    assert sinks.versions(spark, folder) == []
    path = jobs.refresh_silver(bronze, *sides, folder, AS_OF, ORDER)
    assert path.endswith("/v1") and sorted(r.Price for r in sinks.read_current(spark, folder).collect()) == [12500.0, 13000.0]
    assert {r.Segment for r in sinks.read_current(spark, folder).collect()} == {"C"}
    for price in ("14.000", "15.000"):
        jobs.refresh_silver(spark.createDataFrame([row(Precio=price)], schemas.BRONZE), *sides, folder, AS_OF, ORDER)
    assert sinks.read_current(spark, folder).count() == 4
    assert jobs.forget(spark, folder) == [1] and sinks.versions(spark, folder) == [2, 3]


def test_an_empty_price_list_is_not_written(spark, tmp_path):
    folder = str(tmp_path / "prices")
    raw = spark.createDataFrame([("BMW", "Serie 3 320d", "2015-2019", "D", "150", "30000")], PRICE_RAW)
    segments = spark.createDataFrame([("BMW", "SERIE", "D")], "Marca string, Modelo_Cube string, Segmento string")
    with pytest.raises(EmptyBatch):
        jobs.refresh_price_list(raw.limit(0), segments, folder, AS_OF)
    assert sinks.versions(spark, folder) == []
    jobs.refresh_price_list(raw, segments, folder, AS_OF)
    assert sinks.read_current(spark, folder).count() == 1


def test_one_model_is_active(spark, tmp_path):
    folder = str(tmp_path / "models")
    for i in (1, 2):
        M.record(spark, folder, f"/models/{i}", M.PARAMS, dt.date(2024, 5, i))
    rows = sorted(sinks.read_current(spark, folder).collect(), key=lambda r: r.executionDate)
    assert sinks.read_current(spark, folder).schema.names == schemas.MODEL_RECORD.names
    assert [(bytes(r.model), r.active, r.endDate) for r in rows] == [(b"/models/1", False, dt.date(2024, 5, 2)), (b"/models/2", True, None)]
