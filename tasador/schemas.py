"""Declared schemas of every layer, and the column names each layer uses."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(text: str) -> T.StructType:
    """`name type, name type` to a schema, without needing a running session."""
    pairs = [field.strip().rsplit(" ", 1) for field in text.split(",")]
    return T.StructType([T.StructField(name.strip("`"), _TYPES[kind]) for name, kind in pairs])


# Column names below are fixed values: they are the interface of the tables.
BRONZE = _struct(
    "Marca string, Modelo string, Caracteristicas string, Kms string, Precio string, Combustible string, "
    "Caja string, Cilindrada string, AnyoMatriculacion string, Provincia string, Publicacion string, "
    "ExtractedDate date, Financiado string, Web string, Venta string, Links string, PublicacionAnyo string"
)
SILVER = _struct(
    "VehicleId bigint, Id string, Brand string, Model string, Finish string, Features string, Kms bigint, "
    "Price double, Fuel string, Gearbox string, CV double, Registration bigint, Age bigint, Segment string, "
    "Province string, Publication timestamp, ExtractedDate timestamp, Funded string, Web string, Sale string, "
    "Links string"
)
PRICE_LIST = _struct(
    "Brand string, Model string, CV int, Fuel string, Price double, Features string, Segment string, "
    "StarDate int, EndDate int"
)
PRICE_RAW = _struct(
    "Marca string, Modelo string, Matriculacion string, Combustible string, Cilindrada_CV string, Precios string"
)
SEGMENT_CSV = _struct("Marca string, Modelo_Cube string, Segmento string")
GOLDEN = _struct(
    "Brand string, Model string, Shortage double, Fuel string, Gearbox string, CV double, Segment string, "
    "Kms bigint, Price double, Age bigint, Sale string, PriceMed double"
)
INTERVALS = _struct(
    "Brand string, Z double, Coverage double, Width double, Mean_error double, Cost double, Error_pct string"
)
FEATURE_IMPORTANCE = _struct("FeatureName string, Importances double, InventoryDate date")
HOLDOUT = _struct(
    "MeanAbsoluteError double, RootMeanSquareError double, NormalizedMeanSquareError double, "
    "MedianAbsoluteError double, InventoryDate date"
)
KFOLD = _struct(
    "iterations double, `test-MAE-mean` double, `test-MAE-std` double, `train-MAE-mean` double, "
    "`train-MAE-std` double, `test-RMSE-mean` double, `test-RMSE-std` double, `train-RMSE-mean` double, "
    "`train-RMSE-std` double, InventoryDate date"
)
MODEL_RECORD = _struct(
    "endDate date, active boolean, executionDate date, inputFeaturesForTraining string, "
    "hyperparameters string, model binary"
)

BRONZE_TO_SILVER_NAMES = {
    "Marca": "Brand",
    "Modelo": "Model",
    "Caracteristicas": "Features",
    "Precio": "Price",
    "Combustible": "Fuel",
    "Caja": "Gearbox",
    "Cilindrada": "CV",
    "AnyoMatriculacion": "Registration",
    "Provincia": "Province",
    "Publicacion": "Publication",
    "Financiado": "Funded",
    "Venta": "Sale",
    "PublicacionAnyo": "PublicationYear",
}
# Spanish names an older silver table may carry.
SILVER_LEGACY_NAMES = {
    **{k: v for k, v in BRONZE_TO_SILVER_NAMES.items() if k not in ("Cilindrada", "AnyoMatriculacion", "PublicacionAnyo")},
    "Acabado": "Finish",
    "Cilindrada_CV": "CV",
    "Matriculacion": "Registration",
    "Antiguedad": "Age",
    "Segmento": "Segment",
}
SEGMENT_BOOK_NAMES = {
    "Id_Marca_Modelo": "Id_Brand_Model",
    "Marca_Cube": "Brand_Cube",
    "Modelo_Cube": "Model_Cube",
    "Segmento_Cube": "Segment_Cube",
    "Marca": "Brand",
    "Modelo": "Model",
    "Segmento": "Segment",
    "Mercado": "Market",
    "SEG-1 (MSI)": "SEG-1_(MSI)",
    "SEG-2 (MSI)": "SEG-2_(MSI)",
}
PRICE_NAMES = {
    "Marca": "Brand",
    "Modelo": "Model",
    "Cilindrada_CV": "CV",
    "Combustible": "Fuel",
    "Precios": "Price",
    "Caracteristicas": "Features",
    "Segmento": "Segment",
}

LISTING_KEY = ["Marca", "Modelo", "Precio", "Financiado", "Provincia", "AnyoMatriculacion", "Kms"]
SILVER_KEY = [
    "Brand", "Model", "Finish", "Features", "Fuel", "Gearbox", "Province", "Registration", "Kms", "Price", "Web",
]
ID_PARTS = [
    "Brand", "Model", "Registration", "Finish", "Features", "Price", "Fuel", "Gearbox", "Province", "Kms", "Web",
]
VEHICLE_PARTS = ["Brand", "Model", "Registration", "Fuel", "Gearbox", "Finish", "Province", "Kms"]
GOLDEN_FEATURES = GOLDEN.names
