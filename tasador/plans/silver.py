"""Raw listings to the silver table, as one plan.

Everything up to the keys is narrow (no exchange).  The one exchange over the
listings is the survivor aggregate on the business key, taken after both sides
carry their final spelling, so running the job on its own output changes
nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tasador import schemas
from tasador.functions import rules
from tasador.functions.text import capitalise, drop_text, fold_accents, number, respell, strip
from tasador.operators.keyed import keep_last, lookup
from tasador.operators.numbers import with_number
from tasador.operators.steps import counted

# Spelling repairs of the segment dictionary; fixed values.
DIM_BRANDS = {"ALFAROMEO": "ALFA ROMEO", "LANDROVER": "LAND ROVER", "CITROËN": "CITROEN"}
DIM_MODELS = {
    "HI LUX": "HILUX",
    "C-ELYSEE": "CELYSEE",
    "C-HR": "CHR",
    "500L LIVING MPV": "500L",
    "500X 5P": "500X",
}
TRIMMED = ["Price", "Brand", "Features", "Model", "Kms", "Fuel", "Gearbox", "Registration", "Province", "Funded"]
UPPERED = ["Brand", "Model", "Features", "Fuel", "Gearbox", "Province", "Family", "Web"]


def stamp(as_of: str | dt.datetime | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp")


def rename_bronze(bronze: DataFrame) -> DataFrame:
    """English names; columns a batch lacks come as nulls, unknown ones stay."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schemas.BRONZE if f.name not in bronze.columns}
    return bronze.withColumns(missing).withColumnsRenamed(schemas.BRONZE_TO_SILVER_NAMES)


def recent(bronze: DataFrame, since: str = rules.RECENT_FROM) -> DataFrame:
    return bronze.filter(F.col("ExtractedDate") >= F.lit(since).cast("date"))


def prepare(df: DataFrame) -> DataFrame:
    return df.withColumns({"Brand": rules.brand_prep(F.col("Brand")), "CV": rules.cv_prep(F.col("CV"))})


def rule_stage(df: DataFrame, **columns: Column) -> DataFrame:
    """One projection of rules that read only columns of earlier stages."""
    return df.withColumns(columns)


def row_rules(df: DataFrame, as_of, gear_synonyms: Mapping[str, str] | None = None) -> DataFrame:
    """The per-listing rules; adds `Family`."""
    c = F.col
    year, kms = rules.plugin_shift(c("Registration"), c("Kms"))
    df = rule_stage(
        df,
        Fuel=rules.fuel_plain(c("Fuel")),
        Gearbox=rules.gear_plain(c("Gearbox")),
        Price=strip(c("Price")),
        Registration=year,
        Kms=kms,
        Model=fold_accents(rules.model_default(c("Model"), c("Features"))),
        Publication=rules.publication_text(c("Publication"), c("PublicationYear"), stamp(as_of)),
    )
    df = rule_stage(
        df,
        Brand=rules.brand_digit(c("Brand")),
        Fuel=rules.fuel(c("Fuel")),
        Gearbox=rules.gearbox(c("Gearbox"), gear_synonyms),
        CV=rules.cv(c("CV")),
        Price=rules.price_text(c("Price")),
        Registration=rules.year_part(c("Registration")),
        Model=rules.alfa_model(c("Brand"), c("Model")),
    )
    df = rule_stage(df, Family=rules.family(c("Model")), Registration=rules.year_length(c("Registration")))
    model, fam = rules.land_family(c("Model"), c("Family"), c("Features"))
    df = rule_stage(df, Model=model, Family=fam)
    model, fam = rules.space_family(c("Model"), c("Family"))
    df = rule_stage(df, Model=model, Family=fam)
    df = rule_stage(df, Family=rules.named_family(c("Brand"), c("Family"), c("Features")))
    df = rule_stage(df, Family=rules.new_family(c("Family"), c("Features")))
    return rule_stage(
        df,
        Links=rules.link_check(c("Links"), c("Brand"), c("Model"), c("Family"), c("Web")),
        Model=rules.finish_append(c("Model"), c("Features")),
        Family=rules.audi_family(c("Family"), c("Features")),
    )


def tidy(df: DataFrame) -> DataFrame:
    """Case, blanks, dates, numbers."""
    c = F.col
    df = df.withColumns({n: capitalise(c(n)) for n in ("Model", "Features")})
    df = df.withColumns({n: strip(c(n)) for n in TRIMMED})
    df = rule_stage(
        df,
        ExtractedDate=c("ExtractedDate").cast("timestamp"),
        Publication=rules.parse_publication(c("Publication")),
        Kms=rules.drop_dots(c("Kms")),
        Price=rules.drop_dots(c("Price")),
        Brand=rules.brand_map(c("Brand")),
    )
    texts = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    df = df.withColumns({n: rules.null_token(c(n)) for n in texts})
    df = rule_stage(
        df,
        Kms=F.when(rules.kms_digit(c("Kms")), c("Kms").try_cast("bigint")),
        Price=number(c("Price")),
        Registration=number(c("Registration")).cast("bigint"),
    )
    df = df.withColumns({n: F.upper(c(n)) for n in UPPERED})
    return rule_stage(
        df,
        Age=rules.age(c("ExtractedDate"), c("Registration")),
        Links=rules.link_anchor(c("Links")),
        Finish=c("Model"),
        Model=rules.model_override(c("Family"), c("Features")),
    ).drop("Family", "PublicationYear")


REQUIRED = ["Brand", "Price", "Registration", "Province", "Fuel", "Gearbox", "Kms"]


def with_fields(df: DataFrame, names: Sequence[str] = REQUIRED) -> DataFrame:
    """Rows that have every one of the fields."""
    return df.dropna(subset=list(names))


def required(df: DataFrame) -> DataFrame:
    """Cleaned rows with every required field, inside the accepted ranges."""
    return with_fields(df).filter(rules.in_range(F.col("Price"), F.col("Kms"), F.col("Registration")))


def with_history(fresh: DataFrame, history: DataFrame | None) -> DataFrame:
    """Old and new rows, told apart by `_batch`; columns one side lacks are null there."""
    new = fresh.withColumn("_batch", F.lit(1))
    return new if history is None else history.withColumn("_batch", F.lit(0)).unionByName(new, allowMissingColumns=True)


def segment_book(book: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """(Brand, Model_Cube, Segment) of the segment workbook, whose headers are Spanish."""
    return book.withColumnsRenamed(schemas.SEGMENT_BOOK_NAMES).select("Brand", "Model_Cube", "Segment", *order)


def segment_dimension(segments: DataFrame, order: list[str]) -> DataFrame:
    """(Brand, Model, Segment), repaired, one row per join key, last wins."""
    plain = segments.select(
        F.upper(strip(F.col("Brand"))).alias("Brand"), F.upper(strip(F.col("Model_Cube"))).alias("Model"), "Segment", *order
    )
    keyed = plain.withColumns(
        {"Brand": respell(F.col("Brand"), DIM_BRANDS), "Model": respell(F.col("Model"), DIM_MODELS)}
    )
    return keep_last(keyed, ["Brand", "Model"], order).drop(*order)


def attach_segment(df: DataFrame, dimension: DataFrame) -> DataFrame:
    df = lookup(df.drop("Segment"), dimension, ["Brand", "Model"])
    return df.withColumn("Segment", rules.segment_fix(F.col("Segment"), F.col("Model")))


def fallback_dimension(price_list: DataFrame, order: list[str]) -> DataFrame:
    """Segments of the price list under the listings' final spelling, last wins."""
    keyed = price_list.select(
        drop_text(F.col("Brand"), " ").alias("Brand"),
        drop_text(rules.klasse(F.col("Model")), "-", " ").alias("Model"),
        F.col("Segment").alias("ListSegment"),
        *order,
    )
    return keep_last(keyed, ["Brand", "Model"], order).drop(*order)


def fill_segment(df: DataFrame, dimension: DataFrame) -> DataFrame:
    """Only missing segments are filled."""
    joined = lookup(df, dimension, ["Brand", "Model"])
    return joined.withColumn("Segment", F.coalesce("Segment", "ListSegment")).drop("ListSegment")


def with_ids(df: DataFrame, bits: int = 224) -> DataFrame:
    vehicle = rules.digest([F.col(n) for n in schemas.VEHICLE_PARTS], bits)
    return df.withColumns(
        {
            "Id": rules.digest([F.col(n) for n in schemas.ID_PARTS], bits),
            "VehicleId": rules.surrogate(vehicle),
        }
    )


def with_registry_ids(df: DataFrame, folder: str) -> DataFrame:
    """Vehicle numbers from the registry in `folder`: dense, one per vehicle, the same on every run."""
    parts = [F.col(n) for n in schemas.VEHICLE_PARTS]
    return with_number(df.drop("VehicleId"), F.unhex(rules.digest(parts)), folder, "VehicleId").select(*df.columns)


def estimate_kms(df: DataFrame, ratios: DataFrame, site: str = "CICAR") -> DataFrame:
    """For one site, distance = age x the segment's yearly distance.  Off unless called."""
    joined = lookup(df, ratios.select("Segment", "Ratio_Kms_Age"), ["Segment"])
    estimate = (F.col("Age") * F.col("Ratio_Kms_Age")).cast("bigint")
    kms = F.when(F.col("Web") == site, F.coalesce(estimate, F.col("Kms"))).otherwise(F.col("Kms"))
    return joined.withColumn("Kms", kms).drop("Ratio_Kms_Age")


def new_listings(
    bronze: DataFrame,
    segments: DataFrame,
    as_of,
    since: str = rules.RECENT_FROM,
    gear_synonyms: Mapping[str, str] | None = None,
    bits: int = 224,
    counts: Mapping[str, Observation] | None = None,
) -> DataFrame:
    """Cleaned rows of this run; `segments` is a `segment_dimension`."""
    df = with_fields(rename_bronze(recent(bronze, since)), ["Brand", "Province", "Fuel", "Gearbox"])
    df = counted(df, "incoming", counts)
    df = counted(row_rules(prepare(df), as_of, gear_synonyms), "ruled", counts)
    df = required(counted(tidy(df), "tidied", counts))
    df = with_ids(attach_segment(df, segments), bits)
    df = df.withColumns(
        {
            "Publication": F.coalesce(F.col("Publication"), stamp(as_of)),
            "Model": F.when(rules.p_dot_kept(F.col("Model")), F.col("Model")),
        }
    )
    return counted(df, "cleaned", counts)


def final_spelling(df: DataFrame) -> DataFrame:
    """Province filter, then the last brand and model repairs; null brand or model marks a row to drop."""
    c = F.col
    df = df.filter(rules.province_kept(c("Province")))
    df = df.withColumns(
        {
            "Gearbox": rules.gear_final(c("Gearbox")),
            "Publication": rules.publication_clamp(c("Publication"), c("ExtractedDate")),
            "Sale": rules.sale_case(c("Sale")),
            "Model": rules.klasse(c("Model")),
            "Brand": strip(c("Brand")),
        }
    )
    df = rule_stage(
        df,
        Model=rules.brand_eq_model(c("Brand"), c("Model"), c("Features")),
        Brand=rules.spaceless(c("Brand")),
    )
    return df.withColumns({"Brand": rules.brand_final(c("Brand")), "Model": rules.model_final(c("Model"))})


def typed(df: DataFrame, schema=schemas.SILVER) -> DataFrame:
    """The declared columns, in order, in their declared types; texts that do not parse become null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def build_silver(
    bronze: DataFrame,
    segments: DataFrame,
    price_segments: DataFrame,
    as_of,
    history: DataFrame | None = None,
    since: str = rules.RECENT_FROM,
    gear_synonyms: Mapping[str, str] | None = None,
    bits: int = 224,
    counts: Mapping[str, Observation] | None = None,
) -> DataFrame:
    """Bronze rows plus the previous silver table to the next silver table.

    `segments` and `price_segments` are keyed dimensions.  Where a vehicle is in
    both, the new row replaces the old one.  `counts` holds an Observation per
    step whose row count is wanted: incoming, ruled, tidied, cleaned, spelt.
    """
    fresh = new_listings(bronze, segments, as_of, since, gear_synonyms, bits, counts)
    both = with_history(fresh, None if history is None else typed(history.withColumnsRenamed(schemas.SILVER_LEGACY_NAMES)))
    return typed(fill_segment(newest(counted(with_fields(counted(final_spelling(both), "ruled twice"), ["Brand", "Model"]), "spelt", counts)), price_segments))


def newest(df: DataFrame, key: Sequence[str] = schemas.SILVER_KEY) -> DataFrame:
    """The last row of each business key, newer batch first.

    The key is folded into one digest: the survivor aggregate then sorts by 32
    bytes instead of eleven texts.  Rows without brand or model are dropped
    before, between two counters: there they are not shuffled, and the rule chain
    is not copied into the filter.
    """
    keyed = df.select("_batch", *schemas.SILVER.names, rules.exact_key([F.col(n) for n in key]).alias("_key"))
    kept = keep_last(keyed, ["_key"], ["_batch", "ExtractedDate"])
    return kept.drop("_key", "_batch")


def segment_gaps(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and missing segments before and after the fallback, with their share."""

    def measure(df: DataFrame, label: str) -> DataFrame:
        gaps = F.count_if(F.col("Segment").isNull())
        rows = F.count(F.lit(1))
        return df.agg(rows.alias("rows"), gaps.alias("gaps"), (100.0 * gaps / rows).alias("gap_pct")).select(
            F.lit(label).alias("step"), "rows", "gaps", "gap_pct"
        )

    return measure(before, "before").unionByName(measure(after, "after"))


def row_counts(steps: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("step"), "rows") for n, df in steps.items()]
    return reduce(DataFrame.unionByName, parts)
