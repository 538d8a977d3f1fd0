"""Session defaults and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: ``spark.checkpoint.dir``.

    Only a session on one machine (tests) may leave it unset: it gets a temporary folder that is deleted at the end. On
    a cluster the folder must be named, since executors would write to disks of their own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_winnowry_dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="winnowry-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        found = spark._winnowry_dir = "file://" + path
    return found.rstrip("/")


def cut_path(df: DataFrame, name: str, by: tuple[str, ...] = (), **options: object) -> tuple[DataFrame, str]:
    """``cut``, with the columns of folders and the options of the writer, and the path."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    spark.__dict__.setdefault("_winnowry_cuts", []).append(path)
    df.write.options(**options).parquet(path, partitionBy=list(by) or None)
    return spark.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage that survives lost executors.

    The table stays, for later reads of what is derived from it, until ``clear``.
    """
    return cut_path(df, name)[0]


def clear(spark: SparkSession) -> int:
    """Delete all tables that ``cut`` wrote in this session; results that were not stored elsewhere go with them."""
    paths = spark.__dict__.pop("_winnowry_cuts", [])
    jvm = spark._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(paths)
