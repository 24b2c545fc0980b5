"""Chat formatting by perspective: every speaker of a dialogue is the assistant once.  Column expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasador.llm.common import stored

SYSTEM = ("system",)
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
UNKNOWN = "unknown"
CHUNK = 200_000
"""Characters of a dialogue in one row, but for a single turn that is longer."""


def _clean(text: Column) -> Column:
    """Text in which nothing can be read as a marker."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|im_"), F.lit("< |im_"))


def _name(speaker: Column) -> Column:
    return F.regexp_replace(_clean(F.coalesce(speaker, F.lit(UNKNOWN))), "[\\n\\r]", " ")


def segments(turns: DataFrame, system: Sequence[str] = SYSTEM) -> DataFrame:
    """One row per turn and perspective: the rendered turn, its place in the rendered dialogue, its mask.

    `turns`: conv_id, turn, role (the speaker) and text; other columns are not read.
    Every speaker but the `system` ones is a perspective.  In it the speaker's own
    turns are the assistant's, the others' are those of users by name, system
    turns stay.  Turns are in order of `turn` (null first), equal ones by speaker
    and md5 of the text; repeated rows are repeated turns.  A turn without a
    speaker is said by a user called unknown, whose perspective nobody takes; a
    null text is empty; rows without conv_id form one dialogue.  A dialogue in
    which only the system speaks has no perspective.

    Columns: conv_id, perspective, start (characters before it in the dialogue),
    segment, mask_start and mask_end (the trained part of the segment: text and end
    marker of the assistant's turns; null elsewhere).

    A dialogue of any length is spread: turns are sorted over the whole table by
    ranges, lengths are summed within a range, and the sums of the ranges are
    added up; no task has more than a range of a dialogue.
    """
    tie = F.md5(F.coalesce("text", F.lit("")))
    said = turns.select("conv_id", "turn", F.col("role").alias("speaker"), _clean(F.col("text")).alias("body"), tie.alias("tie"), F.monotonically_increasing_id().alias("row"))
    people = said.filter(F.col("speaker").isNotNull() & ~F.col("speaker").isin(*system)).select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    met = said.join(people, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    own = F.col("speaker").eqNullSafe(F.col("perspective"))
    role = F.when(own, F.lit("assistant")).when(F.col("speaker").isin(*system), _name(F.col("speaker"))).otherwise(F.concat(F.lit("user name="), _name(F.col("speaker"))))
    met = met.withColumn("head", F.concat(F.lit(OPEN), role, F.lit("\n"))).withColumn("own", own)
    met = met.select("conv_id", "perspective", "turn", "speaker", "tie", "row", "own", F.length("head").alias("head"), F.concat("head", "body", F.lit(CLOSE + "\n")).alias("segment"))
    order = ["turn", "speaker", "tie", "row"]
    line = met.repartitionByRange("conv_id", "perspective", *order).sortWithinPartitions("conv_id", "perspective", *order)
    line = stored(line.withColumn("range", F.spark_partition_id()).withColumn("size", F.length("segment").cast("bigint")), "turns")

    key = ["conv_id", "perspective", "range"]
    before = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = line.groupBy(*key).agg(F.sum("size").alias("sum")).withColumn("first", F.coalesce(F.sum("sum").over(earlier), F.lit(0)))
    sums = sums.select(F.col("conv_id").alias("_c"), F.col("perspective").alias("_p"), F.col("range").alias("_r"), "first")
    inside = line.withColumn("inside", F.coalesce(F.sum("size").over(before), F.lit(0)))
    placed = inside.join(sums, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("perspective") == F.col("_p")) & (F.col("range") == F.col("_r")))
    return placed.select(
        "conv_id",
        "perspective",
        (F.col("first") + F.col("inside")).alias("start"),
        "segment",
        F.when(F.col("own"), F.col("head")).cast("bigint").alias("mask_start"),
        F.when(F.col("own"), F.col("size") - 1).alias("mask_end"),  # without the line end
    )


def dialogues(found: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """`segments` put together: conv_id, perspective, chunk, start, n_turns, text, mask.

    A dialogue is cut between turns into rows of about `chunk` characters; most
    dialogues are the one row of chunk 0.  `text` of all chunks in order is the whole
    rendered dialogue.  `mask` has [start, end) pairs of characters of `text` to be
    trained on.  A row holds no more than `chunk` characters and one turn.
    """
    parts = F.struct("start", "segment", "mask_start", "mask_end")
    rows = found.withColumn("chunk", F.floor(F.col("start") / chunk).cast("bigint")).groupBy("conv_id", "perspective", "chunk").agg(F.sort_array(F.collect_list(parts)).alias("parts"))
    rows = rows.withColumn("start", F.get("parts", F.lit(0))["start"])
    masked = F.filter("parts", lambda p: p["mask_start"].isNotNull())
    mask = F.transform(masked, lambda p: F.array(p["start"] - F.col("start") + p["mask_start"], p["start"] - F.col("start") + p["mask_end"]))
    return rows.select("conv_id", "perspective", "chunk", "start", F.size("parts").cast("bigint").alias("n_turns"), F.array_join(F.transform("parts", lambda p: p["segment"]), "").alias("text"), mask.alias("mask"))


SQL = f"""WITH t AS (SELECT conv_id, turn, role, md5(coalesce(text, '')) AS tie, replace(coalesce(text, ''), '<|im_', '< |im_') AS body FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role IS NOT NULL AND role <> 'system'),
s AS (SELECT t.conv_id, perspective, turn, role, tie, role IS NOT DISTINCT FROM perspective AS own, body,
    '{OPEN}' || CASE WHEN role IS NOT DISTINCT FROM perspective THEN 'assistant' WHEN role = 'system' THEN role ELSE 'user name=' || coalesce(role, '{UNKNOWN}') END || chr(10) AS head
    FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
z AS (SELECT *, head || body || '{CLOSE}' || chr(10) AS segment FROM s),
o AS (SELECT *, CAST(coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, role NULLS FIRST, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place FROM z),
c AS (SELECT *, place // {CHUNK} AS chunk, min(place) OVER (PARTITION BY conv_id, perspective, place // {CHUNK}) AS start FROM o)
SELECT conv_id, perspective, chunk, start, count(*) AS n_turns, string_agg(segment, '' ORDER BY place) AS text,
    coalesce(string_agg((place - start + length(head)) || '-' || (place - start + length(segment) - 1), ',' ORDER BY place) FILTER (own), '') AS mask FROM c GROUP BY 1, 2, 3, 4"""
