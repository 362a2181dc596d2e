"""Session helpers: a local session for tests/bench and lineage cutting.

Library code never creates its own session; it takes the caller's.  Tables
that cut lineage go to the folder that the session names (``shared_dir``).
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "candlewick") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CANDLEWICK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share, for tables that cut lineage.

    ``spark.checkpoint.dir`` of the session, else a folder in the session's
    warehouse (which Spark always has, and which a cluster shares as well).
    No machine-local temporary folder is ever used.
    """
    sc = spark.sparkContext
    return (sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
            or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_candlewick").rstrip("/")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch while a table is written.  A batch lies in the executor and in its Python
#: worker at once, in buffers that grow by doubling, so Spark's 64 MB come to several hundred for a core.
BATCH_BYTES = "16m"


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def compiled_methods(spark: SparkSession) -> None:
    """Have generated methods split below the 8000 bytes that HotSpot compiles.

    A select of dozens of formulas makes a longer one, which Spark would run
    interpreted for every row.  A limit the session sets itself is kept.
    """
    if spark.conf.get(METHOD_LIMIT, None) is None:
        spark.conf.set(METHOD_LIMIT, "8000")


@dataclass
class Saved:
    """A written table: ``df`` reads it, ``drop()`` deletes its folder."""

    df: DataFrame
    path: str

    def drop(self) -> bool:
        """Delete the folder through the Hadoop FileSystem API (any shared
        store).  Call it once nothing lazy still reads ``df``."""
        spark = self.df.sparkSession
        hpath = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return bool(hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True))


def save(df: DataFrame, name: str = "table") -> Saved:
    """Cut lineage: write ``df`` as Parquet under :func:`shared_dir` and read
    it back.

    One pass computes and writes the data (a reliable ``checkpoint()`` of an
    unpersisted plan computes it twice); the table survives executor loss,
    and later reads prune columns and push filters like any Parquet scan.
    Shuffle files that only the write needed are deleted with its end, and
    Arrow batches are bounded unless the session bounds them itself.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/candlewick-tables/{name}-{uuid.uuid4().hex}"
    cleanup, batch = spark.conf.get(SHUFFLE_CLEANUP), spark.conf.get(ARROW_BYTES, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    if batch is None:
        spark.conf.set(ARROW_BYTES, BATCH_BYTES)
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, cleanup)
        if batch is None:
            spark.conf.unset(ARROW_BYTES)
    return Saved(spark.read.schema(df.schema).parquet(path), path)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """:func:`save` for a table that stays (the caller needs no handle)."""
    return save(df, name).df
