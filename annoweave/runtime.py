"""Session helpers: reading tables, shared working tables, cluster width."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUN = uuid.uuid4().hex
#: Whether a job's shuffle files are removed when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings that the engine expects."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for working tables that every executor can read.

    It is the one that ``spark.checkpoint.dir`` names. Only where the cluster
    names none (a local run, a test) a temporary folder is made and set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="annoweave-")
        spark.sparkContext.setCheckpointDir(f"file://{named}")
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path of the shared folder; what is written there goes when the application ends."""
    path = f"{shared_dir(spark)}/work-{_RUN}/{label}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def materialise(df: DataFrame, label: str = "t") -> DataFrame:
    """Write ``df`` as a table of the shared folder and read it back.

    Cuts the lineage: what follows never recomputes ``df``, and a lost executor
    takes nothing with it. The table goes when the application ends, or before
    with :func:`free`; the shuffle files that led to it go once it is written.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def free(df: DataFrame) -> None:
    """Deletes the table of :func:`materialise` that nothing will read again."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if f"/work-{_RUN}/" in f"{path.toString()}/":
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def width(spark: SparkSession) -> int:
    """Shuffle partitions of the session, for operators that must name a number."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, *cols) -> DataFrame:
    """Hash-partitioned for costly rows: at least one partition per core, and never merged into fewer by their bytes."""
    spark = df.sparkSession
    return df.repartition(max(width(spark), spark.sparkContext.defaultParallelism), *cols)
