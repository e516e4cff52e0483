"""File inventories: existence, size and time of files as the state of a run."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenmeld.functions.names import basename, parent, stem
from screenmeld.session import path_exists
from screenmeld.sources.listing import list_files

# How much of a pose file decides its verdict.
HEAD_BYTES = 4096
TAIL_BYTES = 1024


def inventory(spark: SparkSession, root: str, pattern: str = "*.pdbqt",
              subdir: str | None = None) -> DataFrame:
    """(path, length, modified) of matching files in all folders below ``root``.

    A missing ``subdir`` falls back to the root. File contents are not read.
    """
    base = f"{root}/{subdir}" if subdir else root
    return list_files(spark, base if not subdir or path_exists(spark, base) else root, pattern)


def recent_files(spark: SparkSession, root: str, hours: float,
                 pattern: str = "*_docked.pdbqt") -> DataFrame:
    """Files written in the last ``hours``."""
    since = datetime.now(timezone.utc) - timedelta(hours=hours)
    return list_files(spark, root, pattern).filter(F.col("modified") >= F.lit(since))


def with_names(files: DataFrame) -> DataFrame:
    path = F.col("path")
    return files.select("*", basename(path).alias("file"), stem(path).alias("stem"),
                        parent(path).alias("folder"))


def pose_verdict(content: Column, length: Column) -> Column:
    """What is wrong with a pose file, judged by its first and last bytes.

    ``content`` is binary or text; NULL content could not be read.
    """
    head = F.substring(content, 1, HEAD_BYTES).cast("string")
    tail = F.when(length > TAIL_BYTES, F.substring(content, -TAIL_BYTES, TAIL_BYTES)).otherwise(
        F.substring(content, 1, HEAD_BYTES)).cast("string")
    full = F.filter(F.transform(F.split(tail, "\n"), lambda ln: F.btrim(ln, F.lit(" \t\r"))),
                    lambda ln: ln != "")
    last = F.try_element_at(full, F.lit(-1))
    return (F.when(length == 0, "empty").when(content.isNull(), "unreadable")
            .when(~head.contains("REMARK VINA RESULT"), "no energy remark")
            .when(last.isNull() | (last != "ENDMDL"), "truncated").otherwise("ok"))


def pose_verdicts(spark: SparkSession, root: str) -> DataFrame:
    """(path, target, file, verdict) of all pose files below ``root``."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*_docked.pdbqt").load(root))
    path = F.col("path")
    judged = files.select("path", pose_verdict(F.col("content"), F.col("length")).alias("verdict"))
    empty = list_files(spark, root, "*_docked.pdbqt").filter("length = 0")
    rows = judged.unionByName(empty.select("path", F.lit("empty").alias("verdict")))
    return rows.select("path", parent(path).alias("target"), basename(path).alias("file"), "verdict")


def quarantine(verdicts: DataFrame) -> DataFrame:
    """Defective files with a name that stays unique across targets."""
    return verdicts.filter("verdict <> 'ok'").select(
        "path", "verdict", F.concat("target", F.lit("__"), "file").alias("new_name"))


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("verdict").agg(F.count(F.lit(1)).alias("files"))
