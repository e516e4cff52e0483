"""Text inputs as rows with their place: whole small files or single lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenmeld.sources.listing import list_files


def plain_path(uri: Column) -> Column:
    """Path as written on disk from the encoded URI that file scans report."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def whole_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """(path, value): one row per file, empty ones too, for inputs that are small each."""
    source = spark.read.options(**options).text(path, wholetext=True)
    rows = source.select(plain_path(F.col("_metadata.file_path")).alias("path"), "value")
    files = list_files(spark, path, options.get("pathGlobFilter", "*"),
                       str(options.get("recursiveFileLookup", "false")).lower() == "true")
    return rows.unionByName(files.filter("length = 0").select("path", F.lit("").alias("value")))


def lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """(path, block, seq, value): splittable lines with an order inside each file.

    ``block`` is the start of the file split and ``seq`` rises inside it, so the
    pair orders the lines of a file without reading it in one task.
    """
    return (spark.read.options(**options).text(path)
            .select(plain_path(F.col("_metadata.file_path")).alias("path"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("seq"), "value"))


def lines_of(files: DataFrame) -> DataFrame:
    """(path, block, seq, value) from whole files, numbered from 1."""
    parts = F.posexplode(F.split("value", "\r\n|\n|\r"))
    return files.select("path", parts).select(
        "path", F.lit(0).cast("long").alias("block"), (F.col("pos") + 1).cast("long").alias("seq"),
        F.col("col").alias("value"))
