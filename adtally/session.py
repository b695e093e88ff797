"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


#: Shuffle partitions planned on a cluster: at 128 MB each, 0.5 TB a shuffle. Raise it with the input.
SHUFFLE_WIDTH = 4000


def build_session(
    app_name: str = "adtally",
    master: str | None = None,
    shuffle_width: int | None = None,
    scratch: str | None = None,
    **settings: object,
) -> SparkSession:
    """A session with the settings the library is written for.

    ``shuffle_width`` partitions are planned for every shuffle, and adaptive
    execution coalesces them to about 128 MB each; it never plans more. Local
    sessions keep Spark's own count unless it is given. ``scratch`` is the
    folder for written intermediates, which every executor must reach.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    )
    if shuffle_width or not (master or "").startswith("local"):
        width = shuffle_width or SHUFFLE_WIDTH
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(width))
    if scratch:
        builder = builder.config("spark.checkpoint.dir", scratch)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates, from ``spark.checkpoint.dir``.

    Without that setting a local session takes a folder of its warehouse. A cluster fails: the warehouse may be a folder
    of the driver's machine, which executors on others don't see.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root; never reused, so nothing is overwritten."""
    return f"{scratch_root(spark)}/adtally/{label}-{uuid.uuid4().hex}"


def write_stage(df: DataFrame, label: str) -> str:
    """Write ``df`` to the scratch folder and return where.

    The files outlive a lost executor, and fix the contents before the tables
    they were read from are replaced.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` read back from its stage, which cuts its lineage."""
    return df.sparkSession.read.schema(df.schema).parquet(write_stage(df, label))


def drop_stage(spark: SparkSession, path: str) -> None:
    """Remove a stage whose rows have been written where they belong."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
