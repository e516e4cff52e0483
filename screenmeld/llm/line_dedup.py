"""Line dedup over levelled sorted runs of line hashes. DataFrame operations only.

A run is a table (h1, h2, docs, last) bucketed and sorted by the 128-bit hash of line keys: number of documents of the batch
that brought the key and the largest doc_id among them. ``add`` takes one batch and merge-anti-joins its keys with the runs:
keys that no run holds become rows of a new run of level 0, so a key has one row in all runs together; the others become
increments, a table without order. When a level holds ``fanout`` runs they are written as one run of the next level, so a key is
rewritten once per level; nothing is added up there. Buckets are the hash partitioning of the keys: the anti-joins read the
runs in place and only the batch moves. ``totals`` adds the increments, few beside the keys, to the rows of the runs.

``drop_repeated`` works through a corpus that way and then drops the lines of keys found in at least ``min_docs``
documents everywhere but in the largest doc_id. Per document the dropped positions cut the list of lines into slices, so a
text costs time in proportion to its length. A batch has ``BATCH_ROWS`` rows at most on average; the tables of the runs are
dropped at the end.

Defined cases: NULL or empty text is one empty line; rows that share a doc_id (NULL too) count as one document; rows that share
the largest doc_id all keep the line (so does NULL where there is no other doc_id); keys shorter than ``min_chars``
never drop; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenmeld.llm.text import SPACE, ascii_lower, join_small
from screenmeld.session import delete, new_path, stage

KEYS = ["h1", "h2"]
#: A corpus is taken in batches of about so many rows, in ``BATCHES`` at least.
BATCH_ROWS = 50_000_000
BATCHES = 4
FANOUT = 4


class LineRuns:
    """The runs of one corpus; every run is a table in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT) -> None:
        self.spark, self.fanout, self.buckets = spark, fanout, int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.paths: dict[str, str] = {}
        self.increments: list[str] = []

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = new_path(self.spark, name)
        (rows.write.format("parquet").bucketBy(self.buckets, *KEYS).sortBy(*KEYS)
         .option("path", self.paths[name]).saveAsTable(name))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(n) for level in self.levels for n in level]

    def add(self, keys: DataFrame) -> None:
        """Add a batch of ``h1, h2, doc_id``, one row per document and key; no document comes in two batches."""
        batch = keys.groupBy(*KEYS).agg(F.count("*").alias("docs"), F.max("doc_id").alias("last"))
        older = self.runs()
        if older:
            batch = stage(batch, "line_batch")
        fresh = batch
        for run in older:
            fresh = fresh.join(run, KEYS, "left_anti")
        self._write(fresh, 0)
        if older:
            path = new_path(self.spark, "line_increments")
            batch.join(self.spark.table(self.levels[0][-1]), KEYS, "left_anti").write.parquet(path)
            self.increments.append(path)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            names, self.levels[level] = self.levels[level], []
            # read as files: Spark takes a union of bucketed tables for partitioned by key, which it isn't
            rows = self.spark.read.schema(self.spark.table(names[0]).schema).parquet(*[self.paths[n] for n in names])
            self._write(rows.repartition(self.buckets, *KEYS), level + 1)
            self._drop(names)
            level += 1

    def totals(self) -> DataFrame:
        """One row per key of all batches: ``h1, h2, docs, last``."""
        if not self.increments:
            return self.spark.table(self.levels[0][0])
        more = (self.spark.read.schema(self.runs()[0].schema).parquet(*self.increments).groupBy(*KEYS)
                .agg(F.sum("docs").alias("more"), F.max("last").alias("later")))
        added = [run.join(more, KEYS, "left").select(
            *KEYS, (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"), F.greatest("last", "later").alias("last"))
            for run in self.runs()]
        return reduce(DataFrame.unionByName, added)

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")
        delete(self.spark, [self.paths.pop(n) for n in names])

    def drop(self) -> None:
        """Drop all runs and increments."""
        self._drop([n for level in self.levels for n in level])
        delete(self.spark, self.increments)
        self.levels, self.increments = [[]], []


def line_keys(lines: Column, min_chars: int) -> Column:
    """128-bit hash of each line's key; NULL for keys that are too short."""
    trimmed = F.transform(lines, lambda x: F.btrim(x, F.lit(SPACE)))
    lowered = F.transform(trimmed, ascii_lower)
    return F.transform(lowered, lambda x: F.when(
        F.length(x) >= min_chars,
        F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit("line"), x).alias("h2"))))


def _held(hashed: DataFrame) -> DataFrame:
    """``h1, h2, doc_id``, one row per document and key; only ids of several rows are sorted out by a shuffle."""
    several = stage(hashed.groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1")
                    .select(F.col("doc_id").alias("_id")), "repeated_ids")
    count = several.count()
    distinct = F.explode(F.array_distinct(F.filter("keys", lambda k: k.isNotNull())))
    rows = hashed.select("doc_id", "batch", distinct.alias("key")).select("doc_id", "batch", "key.h1", "key.h2")
    if not count:
        return rows
    same = rows["doc_id"].eqNullSafe(several["_id"])
    return join_small(rows, several, count, same, "left_anti").unionByName(
        join_small(rows, several, count, same, "left_semi").distinct())


def drop_repeated(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int | None = None,
                  fanout: int = FANOUT) -> DataFrame:
    """Rows of ``docs`` as struct ``doc`` without text, with ``kept`` text, ``n_lines`` and ``n_dropped``.

    ``given`` says whether there was a text.
    """
    spark = docs.sparkSession
    if batches is None:
        batches = max(BATCHES, math.ceil(docs.count() / BATCH_ROWS))
    text = F.coalesce("text", F.lit(""))
    # a row is known by its id and text, so that rows which share an id are told apart
    lines = F.split(text, "\n")
    path = new_path(spark, "line_hashes")
    (docs.select("doc_id", F.xxhash64(text).alias("row"), line_keys(lines, min_chars).alias("keys"),
                 F.pmod(F.xxhash64("doc_id"), F.lit(batches)).alias("batch"))
     .write.partitionBy("batch").parquet(path))
    schema = "doc_id {}, row long, keys array<struct<h1: long, h2: long>>, batch int".format(
        docs.schema["doc_id"].dataType.simpleString())
    hashed = spark.read.schema(schema).parquet(path)

    runs, held = LineRuns(spark, fanout), _held(hashed)
    for number in range(batches):
        runs.add(held.filter(F.col("batch") == number).select("doc_id", *KEYS))
    frequent = stage(runs.totals().filter(F.col("docs") >= min_docs).select(*KEYS, "last"), "frequent_lines")
    runs.drop()
    placed = (hashed.select("doc_id", "row", F.posexplode("keys").alias("at", "key"))
              .filter(F.col("key").isNotNull()).select("doc_id", "row", "at", "key.h1", "key.h2"))
    hits = join_small(placed, frequent, frequent.count(),
                      (placed["h1"] == frequent["h1"]) & (placed["h2"] == frequent["h2"]))
    drops = (hits.filter(~F.col("doc_id").eqNullSafe(F.col("last")))
             .groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row"))
             .agg(F.sort_array(F.collect_set("at")).alias("_at")))
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]  # the text itself moves as lines alone
    rows = docs.select(F.struct(*others).alias("doc"), F.col("text").isNotNull().alias("given"),
                       F.xxhash64(text).alias("row"), lines.alias("lines"))
    joined = rows.join(drops, rows["doc.doc_id"].eqNullSafe(F.col("_id")) & (rows["row"] == F.col("_row")), "left")
    # the lines between two neighbouring dropped positions stay
    at = F.coalesce("_at", F.array().cast("array<int>"))
    edges = F.arrays_zip(F.concat(F.array(F.lit(-1)), at).alias("a"),
                         F.concat(at, F.array(F.size("lines"))).alias("b"))
    stretches = F.transform(edges, lambda e: F.slice(F.col("lines"), e["a"] + 2, e["b"] - e["a"] - 1))
    return joined.select("doc", "given", F.size("lines").cast("long").alias("n_lines"), F.size(at).cast("long").alias("n_dropped"),
                         F.array_join(F.flatten(stretches), "\n").alias("kept"))


def without_repeated_lines(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text`` and ``n_chars`` set anew; columns as they are."""
    rows = drop_repeated(docs, **settings)
    fresh = {"text": F.when(F.col("given"), F.col("kept")), "n_chars": F.length("kept").cast("long")}
    return rows.select(*[(fresh[c] if c in fresh else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
