"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Results depend on these, so every session gets them.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Two-digit hex prefixes and state codes must stay strings when they come from a path.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# These only make runs faster; a session that sets them itself keeps its own values.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows sent to Python may be whole texts, trajectories or stop lists, so batches are bounded in bytes.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # Folders of a table are listed level by level, by default with a task for each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
}


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

def build_session(app_name: str = "dwellmap", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; extra settings are passed as ``key__with__dots=value``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (REQUIRED_CONF | RUNTIME_CONF).items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else built, without changing what it chose itself."""
    chosen = spark.conf.getAll
    for key, value in (REQUIRED_CONF | RUNTIME_CONF).items():
        if key in REQUIRED_CONF or key not in chosen:
            spark.conf.set(key, value)
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only by a single-process session that names none.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="dwellmap-")
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage at a stage boundary: write to the shared folder and read back.

    A Parquet table survives lost executors like a checkpoint does, and unlike one it is read with
    only the columns asked for and tells the optimizer its size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    # Once the table stands, nothing reads the shuffles that made it; a long chain of stages would
    # otherwise hold all of them until the driver collects its garbage.
    chosen = _CLEANUP in spark.conf.getAll
    if not chosen:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if not chosen:
            spark.conf.unset(_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete stage tables that no later step reads. Frames that were not written are left alone."""
    for table in tables:
        spark = table.sparkSession
        root = shared_dir(spark).rstrip("/") + "/"
        for file in table.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(file)
            folder = path.getParent()
            if folder.getName().startswith("stage-"):
                fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
                if fs.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(root)).equals(
                    fs.makeQualified(folder.getParent())
                ):
                    fs.delete(folder, True)
