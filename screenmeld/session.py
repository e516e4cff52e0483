"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_TASK_KEY = "spark.screenmeld.rowsPerTask"
ROWS_PER_TASK = 2_000_000
#: Rows of a staged file. A task reads at most 32 files (of 128 MB, with 4 MB for opening each), so this bounds the
#: rows that it sorts for a shuffle, however well they are compressed.
ROWS_PER_FILE = 250_000
LOCAL_DIR_KEY = "spark.screenmeld.localDir"


def local_session(app: str = "screenmeld", cpus: int | str = "*",
                  shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and single-machine runs; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def rows_per_task(spark: SparkSession) -> int:
    """Most rows one task may hold in an ordered window before the key is split."""
    return int(spark.conf.get(ROWS_PER_TASK_KEY, str(ROWS_PER_TASK)))


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder; on a cluster a
    machine-local path would lose the data together with the executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    created = spark.conf.get(LOCAL_DIR_KEY, None)
    if created is None:
        created = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set(LOCAL_DIR_KEY, created)
    return created


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/screenmeld/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """Spark's own access to the folder of a path, whatever store it is in."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def fitting_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that fit a path or pattern, each with its store."""
    files, where = _file_system(spark, pattern)
    return [f.getPath().toString() for f in files.globStatus(where) or []]


def path_exists(spark: SparkSession, pattern: str) -> bool:
    return bool(fitting_paths(spark, pattern))


def delete(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders; for the bounded lists of what a commit has replaced."""
    for path in paths:
        files, where = _file_system(spark, path)
        files.delete(where, True)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage with a table that survives the loss of any executor and
    keeps column pruning, unlike a row checkpoint.
    """
    path = new_path(df.sparkSession, name)
    df.write.mode("errorifexists").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_if_large(df: DataFrame, rows: int, name: str = "stage") -> DataFrame:
    """Stage only where recomputing the input would cost more than a write."""
    if rows <= rows_per_task(df.sparkSession):
        return df
    return stage(df, name)
