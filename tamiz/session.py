"""Session helpers: a local session for tests and benches, and the shared work folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g", name: str = "tamiz") -> SparkSession:
    """A local session with the settings that every test and bench uses (UTC, AQE, Arrow)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_root(spark: SparkSession) -> str:
    """The shared folder in which lineage is cut and tables are staged.

    It is ``spark.checkpoint.dir`` of the session. Only where that is unset, as in tests on one machine, a temporary
    folder is made and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), f"tamiz-work-{os.getpid()}")
        spark.sparkContext.setCheckpointDir(root)
        return spark.sparkContext.getCheckpointDir()
    return root


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`work_root`, for a table that one program writes and reads; it is removed when that ends."""
    path = f"{work_root(spark).rstrip('/')}/tamiz/{label}-{uuid.uuid4().hex}"
    if not _work:
        atexit.register(_tidy)  # runs before the session's own end, which was registered earlier
    _work.add(path)
    return path


#: Paths given by :func:`work_path` that are still there.
_work: set[str] = set()


def _tidy() -> None:
    spark = SparkSession.getActiveSession()
    for path in list(_work) if spark is not None else []:
        try:
            remove(spark, path)
        except Exception:  # the session is gone; what is left lies in the work folder
            return


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a plan cut that survives a lost executor."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder of :func:`work_path` that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _work.discard(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A :func:`staged` whose tables are removed at the end, for work whose result is written elsewhere by then."""
    paths: list[str] = []

    def stage(df: DataFrame, label: str) -> DataFrame:
        paths.append(work_path(spark, label))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield stage
    finally:
        for p in paths:
            remove(spark, p)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores, for work that is heavy for each row.

    Only a plain scan with fewer partitions than cores is moved, which is small: no more than a split for each core. Anything
    else, and any larger scan, stays as it is.
    """
    execution = df._jdf.queryExecution()
    plan = execution.executedPlan().toString()
    cores = df.sparkSession.sparkContext.defaultParallelism
    if "Exchange" in plan or "AdaptiveSparkPlan" in plan or execution.toRdd().getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable on the executors, once per application; nothing to do where ``PYTHONPATH`` has it."""
    context, home = spark.sparkContext, Path(__file__).resolve().parent.parent
    if getattr(context, "_tamiz_shipped", False) or str(home) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    folder = tempfile.mkdtemp(prefix="tamiz-")
    context.addPyFile(shutil.make_archive(f"{folder}/tamiz", "zip", root_dir=home, base_dir="tamiz"))
    context._tamiz_shipped = True
