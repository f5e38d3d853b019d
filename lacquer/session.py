"""Session defaults, table access and the shared work folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "lacquer", cores: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LACQUER_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied tables: a parquet file or a folder of parts."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores, where a scan gives fewer tasks than there are cores.

    Large inputs have enough tasks and are left as they are, so nothing is shuffled there.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a session on one machine (a local master) gets a temporary folder; any
    other fails, since executors would write to disks of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir is not set, and executors of {master or 'this master'} share no folder")
        made = getattr(shared_dir, "_made", None)
        if made is None:
            folder = tempfile.mkdtemp(prefix="lacquer-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            made = shared_dir._made = f"file://{folder}"
        base = made
    return base.rstrip("/")


def materialise(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors.

    What is written goes when the driver ends, or with ``clear_work``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lacquer-{label}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Folders of ``materialise`` that still stand.
_written: list[str] = []


def clear_work(spark: SparkSession) -> int:
    """Remove what ``materialise`` wrote in this process; tables that read it can be used no more.  Returns how many folders."""
    count = 0
    while _written:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        count += bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True))
    return count


def small_rows(df: DataFrame, bound: int, what: str) -> list:
    """Rows of a table whose size is bounded by its nature; fails above ``bound`` instead of collecting more."""
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{what} has more than {bound} rows; it is expected to be a bounded table")
    return rows
