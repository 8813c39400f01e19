"""Session defaults and the shared folder for staged tables."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
METHOD_KEY = "spark.sql.codegen.hugeMethodLimit"
#: Java compiles no method of more bytes; a longer one is interpreted, row by row.
COMPILED_BYTES = 8000


def local_session(app_name: str = "triagelake", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks on one machine.

    On a cluster the session comes from spark-submit and only needs
    ``spark.checkpoint.dir`` to point at shared storage.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def staging_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Unset is accepted on a local master only, where driver and tasks share one
    disk; a cluster without the setting is an error, since a machine-local
    folder would be lost together with the executor that wrote it.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors can reach")
    return _local_folder(spark.sparkContext.applicationId)


@functools.cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"triagelake-{application}-")


def compiled_rows(spark: SparkSession) -> None:
    """Projections too long for one compiled method are generated in pieces; results stay the same.

    For this session from now on; a lower limit that is set already is kept.
    """
    if int(spark.conf.get(METHOD_KEY)) > COMPILED_BYTES:
        spark.conf.set(METHOD_KEY, str(COMPILED_BYTES))


def spread(df: DataFrame) -> DataFrame:
    """Occupy all cores when a table comes in few large row groups; otherwise unchanged.

    For scanned tables only (asking a shuffled frame for its partitions would run it).
    Tables with at least as many input partitions as cores are never shuffled by this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Cuts the lineage: later jobs read the files, so a lost executor costs one
    re-read and never another run of the steps before.
    """
    spark = df.sparkSession
    path = f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
