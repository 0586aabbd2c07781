"""Session helpers: the settings the jobs rely on and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "vacancia") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    n = os.cpu_count() if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", os.path.join(tempfile.gettempdir(), "vacancia-warehouse"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> SparkSession:
    """Every timestamp rule here is written for UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder all executors can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a
    local session, where driver and executors are one process, may fall back to
    the machine's temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; no shared folder to write to")
    return os.path.join(tempfile.mkdtemp(prefix="vacancia-"), name)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that run inside go when each ends, not when the driver collects its garbage.

    For writes: a frame that is collected or counted twice would make its shuffles again.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` written once to a fresh folder, laid out by the columns ``by``; what follows reads it back."""
    path = work_dir(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
