"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Nothing here changes a result.  The skew setting lets a shuffled join split a
# hot key even where the split costs one more exchange downstream.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What a query has shuffled goes when it ends, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # HotSpot never compiles a method above 8000 bytes of bytecode.  The long rule chains exceed
    # that as one whole-stage method; below this limit they run as many small compiled ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else built."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "tasador", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    # Checkpoints go once nothing refers to them any more.
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir` of the session, else the one the program has set.

    Only a local master may go without either; it then gets a fresh temporary
    folder, because there driver and executors share one disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured or context.getCheckpointDir():
        return configured or context.getCheckpointDir()
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tasador-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared folder so a lost executor costs no recomputation; what is stored there is not stored again."""
    if getattr(df, "_stored", False):
        return df
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    stored = df.checkpoint(eager=True)
    stored._stored = True  # of this frame only: what is derived from it is another object
    return stored


def store(df: DataFrame, *parts: str) -> DataFrame:
    """`df` as a compressed table in the shared folder: a fraction of a checkpoint's room, and there until `discard` or the folder's owner deletes it.

    Rows of equal `parts`, the last columns, lie in a folder of their own.  What a table cannot hold, columns without a type or of one name, is checkpointed.
    """
    spark = df.sparkSession
    if len({c.lower() for c in df.columns}) < len(df.columns) or any(re.search("void|interval", kind) for _, kind in df.dtypes):
        return cut_lineage(df)
    folder = f"{shared_dir(spark).rstrip('/')}/stored-{uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*parts).parquet(folder)
    kept = spark.read.schema(df.schema).parquet(folder)
    kept._stored, kept._folder = True, folder
    return kept


def discard(*frames: DataFrame) -> None:
    """Delete what `store` made, once nothing that is still to be computed reads it; other frames are left alone."""
    for df in frames:
        if folder := getattr(df, "_folder", None):
            context = df.sparkSession.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
