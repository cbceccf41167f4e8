"""Session factory and cluster settings that the operators rely on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings every session gets; a cluster's own submit settings win.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, name: str = "quaymark", **conf: str) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = DEFAULTS | {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.memory": os.environ.get("QUAYMARK_DRIVER_MEMORY", "8g"),
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Operators that run Python on the executors need it there; the driver's own import
    path says nothing about theirs.
    """
    context = spark.sparkContext
    if getattr(context, "_quaymark_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="quaymark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / "quaymark_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    context.addPyFile(str(archive))
    context._quaymark_shipped = True


def heavy_partitions(spark: SparkSession) -> int:
    """Tasks for a step that is heavy per row though small in bytes.

    Adaptive execution would merge its partitions by size into a task or two; a
    repartitioning by number is left alone.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a session without that setting and with a local master (tests) gets a
    temporary folder of its own; on a cluster the setting must be there, as a
    machine-local folder would not be seen by the other executors.
    """
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="quaymark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    base = "file://" + folder
    spark.conf.set("spark.checkpoint.dir", base)
    spark.sparkContext.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for a written intermediate table."""
    return f"{shared_dir(spark)}/quaymark/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def cleaned(spark: SparkSession):
    """Actions that write in here drop the files of their own shuffles as they end, so that none pile up over a query of several steps."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back.

    This cuts the lineage with a table that survives the loss of any executor.
    Columns and types stay as they are. ``discard`` deletes the table once all that
    reads it has been written itself.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with cleaned(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete intermediate tables of ``written`` that nothing will read any more."""
    for df in tables:
        _delete(df.sparkSession, df.scratch)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this session; for when the results of its queries have been read."""
    _delete(spark, f"{shared_dir(spark)}/quaymark/{spark.sparkContext.applicationId}")


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
