"""File listings made by tasks: folders are listed level by level, each by the task it is dealt to.

Spark's own file index holds every file on the driver and leaves out zero-length files. Here the driver sees
neither names nor sizes of files; it starts with the roots and counts the folders of each level. Tasks reach a store through
``pyarrow.fs``; stores that only Spark's readers reach are listed by :func:`indexed_files`.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenmeld.session import fitting_paths, stage

ENTRY = "path string, length long, modified timestamp, folder boolean"
AT_ONCE = 10_000


def _split(uri: str) -> tuple[str, str]:
    """Store and path of a qualified location such as ``file:/data`` or ``hdfs://host/data``."""
    scheme, rest = uri.split(":", 1)
    if rest.startswith("//"):
        host, _, path = rest[2:].partition("/")
        return f"{scheme}://{host}", f"/{path}"
    return f"{scheme}:", rest


def store_of(uri: str) -> stores.FileSystem:
    store, _ = _split(uri)
    return stores.FileSystem.from_uri(f"{store}/" if "//" in store else f"{store}///")[0]


def reachable(uri: str) -> bool:
    """Whether tasks can list the store of a location without Spark's readers."""
    try:
        store_of(uri)
    except (pa.ArrowInvalid, NotImplementedError, OSError):
        return False
    return True


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Direct entries of each folder; a path that is a file is its own entry."""
    names = ["path", "length", "modified", "folder"]
    types = [pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.bool_()]
    for batch in batches:
        for uri in batch.column("path").to_pylist():
            store, path = _split(uri)
            files = store_of(uri)
            found = files.get_file_info(path)
            if found.type == stores.FileType.Directory:
                found = files.get_file_info(stores.FileSelector(path))
            else:
                found = [found] if found.type == stores.FileType.File else []
            # as Spark's readers do it
            shown = [x for x in found if not x.base_name.startswith(".")
                     and (not x.base_name.startswith("_") or "=" in x.base_name)]
            for k in range(0, len(shown), AT_ONCE):
                part = [(f"{store}{x.path}", x.size or 0, x.mtime, x.type == stores.FileType.Directory)
                        for x in shown[k:k + AT_ONCE]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names)


def indexed_files(spark: SparkSession, root: str, recursive: bool) -> DataFrame:
    """(path, length, modified) from the file index Spark makes for a scan, for stores only Spark reaches.

    The index, which the driver holds for any scan of the folder, gives zero-length files without their time.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    files = reader.load(root)
    seen = files.select("path", "length", F.col("modificationTime").alias("modified"))
    listed = spark.createDataFrame([(p,) for p in files.inputFiles()], "path string")
    plain = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    empty = listed.select(F.regexp_replace(plain, "^file:/+", "file:/").alias("path")).join(seen, "path", "left_anti")
    return seen.unionByName(empty.select("path", F.lit(0).cast("long").alias("length"),
                                         F.lit(None).cast("timestamp").alias("modified")))


def list_files(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(path, length, modified) of the files below ``root`` whose names fit ``pattern``, zero-length ones too.

    Hidden names are left out, as in Spark's readers. Without ``recursive`` only ``key=value`` folders are entered.
    """
    name = F.regexp_extract("path", "[^/]*$", 0)
    fits = name.rlike(fnmatch.translate(pattern))
    roots = fitting_paths(spark, root)
    if not roots:
        raise FileNotFoundError(root)
    if not all(map(reachable, roots)):
        return indexed_files(spark, root, recursive).filter(fits)
    level = spark.createDataFrame([(r,) for r in roots], "path string")
    found, tasks = [], 1
    while True:
        entries = stage(level.repartition(tasks).mapInArrow(_entries, ENTRY), "listing")
        found.append(entries.filter(~F.col("folder")))
        level = entries.filter("folder" if recursive else name.contains("=") & F.col("folder")).select("path")
        folders = level.count()
        if not folders:
            break
        tasks = min(folders, 4 * spark.sparkContext.defaultParallelism)
    return reduce(DataFrame.unionByName, found).filter(fits).select("path", "length", "modified")
