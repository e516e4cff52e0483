"""Incremental processing of arriving files with Structured Streaming.

Progress lives in the checkpoint, so a restarted query continues with the files
it has not seen. Ranking needs whole targets and stays a batch query.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql import types as T

from screenmeld.catalog import score
from screenmeld.functions.names import parent, stem
from screenmeld.sources.poses import ENERGY, heavy_atoms, pose_bodies
from screenmeld.sources.text import plain_path
from screenmeld.streaming import versions

POSE_FILES = ("target string, ligand string, path string, modified timestamp, "
              "poses array<struct<pose: int, score_vina: double, coords: array<struct<x: double, y: double, z: double>>>>")


def pose_file_stream(spark: SparkSession, root: str, per_trigger: int | None = None) -> DataFrame:
    """Arriving pose files as (target, ligand, path, modified, value)."""
    reader = spark.readStream.option("pathGlobFilter", "*_docked.pdbqt").option(
        "recursiveFileLookup", "true")
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    files = reader.text(root, wholetext=True)
    path = plain_path(F.col("_metadata.file_path"))
    return files.select(parent(path).alias("target"),
                        F.regexp_replace(stem(path), "_docked$", "").alias("ligand"),
                        path.alias("path"), F.col("_metadata.file_modification_time").alias("modified"), "value")


def ingest_poses(files: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Parse arriving pose files into a table with one row per ligand; see :func:`ingested_poses`.

    The checkpoint knows which files were read, so a query that was stopped goes on with the others. Of
    several files of a ligand, in whatever order they arrive, the one modified last counts (by path among equal times); a
    file that is written again under its old path isn't read again.
    """
    bodies = pose_bodies(files)
    pose = F.struct("pose", F.nullif(F.regexp_extract("body", ENERGY, 1), F.lit("")).try_cast("double").alias("score_vina"),
                    heavy_atoms(F.col("body")).alias("coords"))
    rows = bodies.select("target", "ligand", "path", "modified", pose.alias("p"))
    by_file = lambda batch: batch.groupBy("target", "ligand", "path", "modified").agg(
        F.sort_array(F.collect_list("p")).alias("poses"))
    return (rows.writeStream.foreachBatch(lambda batch, n: versions.add(
                by_file(batch), n, out, ("target", "ligand"), ("modified", "path", versions.BATCH)))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def pose_files_kept(spark: SparkSession, out: str) -> DataFrame:
    """(target, ligand, path, modified, poses) of the files that count so far."""
    return versions.read(spark, out, POSE_FILES, ("target", "ligand"), ("modified", "path", versions.BATCH))


def ingested_poses(spark: SparkSession, out: str) -> DataFrame:
    """(target, ligand, pose, score_vina, coords) of the files that count so far."""
    return pose_files_kept(spark, out).select("target", "ligand", F.inline("poses"))


def table_stream(spark: SparkSession, path: str, schema: T.StructType | str,
                 files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def upsert_stream(rows: DataFrame, out: str, checkpoint: str,
                  keys: Sequence[str] = ("target", "ligand"), order: Sequence[str] = ("generation",),
                  fanout: int = versions.FANOUT) -> StreamingQuery:
    """Keep the last version of each key in a table of runs; see :mod:`versions` and :func:`upserted`.

    The batch number comes before ``order``: a later batch wins, and replaying a batch gives the same table.
    """
    return (rows.writeStream.foreachBatch(lambda batch, n: versions.add(batch, n, out, keys, (versions.BATCH, *order), fanout))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def upserted(spark: SparkSession, out: str, schema: T.StructType | str, keys: Sequence[str] = ("target", "ligand"),
             order: Sequence[str] = ("generation",)) -> DataFrame:
    return versions.read(spark, out, schema, keys, (versions.BATCH, *order))


def first_names(rows: DataFrame, out: str, checkpoint: str,
                keys: Sequence[str] = ("name",)) -> StreamingQuery:
    """Let each name pass once, over all runs that share the checkpoint.

    The state grows with the distinct names; that is the point of it.
    """
    return (rows.dropDuplicates(list(keys)).writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def live_counts(rows: DataFrame, out: str, checkpoint: str,
                by: Sequence[str] = ("target", "status")) -> StreamingQuery:
    """Running counts per target and status; each batch replaces the table."""
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    return (counts.writeStream.outputMode("complete").foreachBatch(replace)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


class BlockState(StatefulProcessor):
    """The rows of one block so far, which come back whole with each verdict on it.

    They are one value of the state, so that a batch reads and writes each of its blocks once and not row by row.
    """

    def __init__(self, schema: T.StructType, gated: Sequence[str], minimum: float, keys: Sequence[str]) -> None:
        self.schema, self.gated, self.minimum = schema, list(gated), minimum
        self.at = [schema.names.index(k) for k in keys]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getValueState("rows", "packed binary")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = pickle.loads(bytes(self.rows.get()[0])) if self.rows.exists() else []
        kept = {tuple(r[k] for k in self.at): r for r in held}
        # of equal keys in one batch the last in this order stays, however the rows were dealt
        for r in sorted(map(tuple, rows), key=lambda r: [(x is not None, str(x)) for x in r]):
            kept[tuple(r[k] for k in self.at)] = r
        self.rows.update((pickle.dumps(list(kept.values()), pickle.HIGHEST_PROTOCOL),))
        filled = lambda c: sum(r[self.schema.names.index(c)] is not None for r in kept.values())
        good = all(filled(c) / len(kept) >= self.minimum for c in self.gated)
        named = Row(*self.schema.names, "accepted")
        for r in kept.values():
            yield named(*r, good)

    def close(self) -> None:
        pass


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
BLOCK = ("target", "block")


def gate_blocks(rows: DataFrame, scores: Sequence[str], out: str, checkpoint: str, minimum: float = 0.99,
                keys: Sequence[str] = ("ligand", "pose")) -> StreamingQuery:
    """Judge blocks as their rows arrive and keep all rows with ``accepted``; see :func:`gated`.

    A block may arrive in many batches. Its rows are state under (target, block), so a batch reads and
    writes the blocks it brings and no others; a block fits one task, as it does when it is scored. Each time
    all rows of a touched block go to the table together, and the commit of the batch there moves it from one side to
    the other: a run that breaks off anywhere leaves each block whole on the side it had. A row that arrives again (same
    block and ``keys``) replaces the earlier one; of several in one batch a fixed one stays.
    """
    schema = rows.schema
    gated = [score(k).column for k in scores if score(k).gated]
    judge = BlockState(schema, gated, minimum, [*BLOCK, *keys])
    judged = rows.groupBy(*BLOCK).transformWithState(
        judge, T.StructType([*schema.fields, T.StructField("accepted", T.BooleanType())]), "Update", "None")
    conf = rows.sparkSession.conf
    before = conf.get(STORE_KEY)
    conf.set(STORE_KEY, ROCKS)  # the query takes it over when it starts
    try:
        return (judged.writeStream.outputMode("update")
                .foreachBatch(lambda batch, n: versions.add(batch, n, out, (*BLOCK, *keys)))
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        conf.set(STORE_KEY, before)


def gated(spark: SparkSession, out: str, schema: T.StructType | str, keys: Sequence[str] = ("ligand", "pose")) -> DataFrame:
    """All rows so far with the verdict on their block in ``accepted``; ``schema`` is that of the arriving rows."""
    plain = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return versions.read(spark, out, T.StructType([*plain.fields, T.StructField("accepted", T.BooleanType())]), (*BLOCK, *keys))
