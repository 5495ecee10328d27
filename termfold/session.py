"""Session settings and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent
_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)

def local_session(cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and single-machine runs; on a cluster use spark-submit's."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("termfold")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Not needed where it is installed there or given to spark-submit by --py-files.
    """
    context = spark.sparkContext
    if not any(Path(file).name.startswith("termfold-package") for file in context.listFiles):
        base = Path(tempfile.mkdtemp(prefix="termfold-")) / "termfold-package"
        archive = shutil.make_archive(str(base), "zip", PACKAGE.parent, PACKAGE.name)
        context.addPyFile(archive)


def scratch_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Every executor must see it, so on a cluster it has to be set. Only a local
    master, where driver and executors share one disk, falls back to a new
    temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="termfold-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the scratch folder, inside the current run's folder if there is one."""
    folder = _run_folder.get() or f"{scratch_folder(spark)}/termfold"
    return f"{folder}/{uuid.uuid4().hex}/{name}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder wherever it is; DataFrames have no call for that, so this goes to the file system's own."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch_run(spark: SparkSession):
    """Delete what the block stored in the scratch folder when it ends.

    For jobs that leave their result elsewhere: no DataFrame may outlive the block.
    """
    folder = f"{scratch_folder(spark)}/termfold/run-{uuid.uuid4().hex}"
    outer = _run_folder.set(folder)
    try:
        yield
    finally:
        _run_folder.reset(outer)
        delete_folder(spark, folder)


def saved(spark: SparkSession, make: Callable[[], DataFrame], path: str, format: str = "parquet", mode: str = "error") -> None:
    """Write the DataFrame that ``make`` returns, and delete what it has stored in the scratch folder on the way."""
    with scratch_run(spark):
        make().write.format(format).mode(mode).save(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the scratch folder and read it back.

    Cuts the lineage in a way that survives lost executors, keeps later reads
    column-pruned, and gives the planner the true size of the table: it then
    broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it
    above, so no join here needs a broadcast hint.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def reused(df: DataFrame):
    """Keep ``df`` in memory and on disk for the actions inside the block."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
