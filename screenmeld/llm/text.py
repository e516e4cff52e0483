"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenmeld.session import stage

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
#: Rows up to which a per-source or per-partition table is broadcast; beyond it a plain join is used.
BROADCAST_ROWS = 100_000


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for NULL and empty texts."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(trimmed) > 0, F.size(F.split(trimmed, SPACES))).otherwise(0).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; texts that are all ASCII take the fast built-in."""
    upper = "".join(map(chr, range(65, 91)))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower()))


def partitions_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def lowest_hashes(rows: DataFrame, key: str, seed: int, most: int) -> DataFrame:
    """The rows whose hash of ``key`` is among the ``most`` lowest, ties included, with that hash as ``at``.

    The limit is found on the hashes alone, so no task sorts or sends texts.
    """
    at = F.xxhash64(F.lit(seed), F.col(key))
    last = rows.select(at.alias("at")).orderBy("at").limit(most).agg(F.max("at")).first()[0]
    return rows.withColumn("at", at).filter(F.col("at") <= F.lit(last).cast("long"))


def join_small(rows: DataFrame, table: DataFrame, count: int, on: Column, how: str = "inner") -> DataFrame:
    """Join a table of known row count: broadcast up to ``BROADCAST_ROWS``, else a shuffle join."""
    return rows.join(F.broadcast(table) if count <= BROADCAST_ROWS else table, on, how)


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """Add ``number``, the 0-based position along ``order`` over the whole table.

    Rows are range-partitioned and sorted; only one count per partition meets in one task.
    """
    placed = stage(df.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("_row", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_row", 33)
    before = (placed.groupBy(part.alias("_part")).count()
              .select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before")))
    return (placed.withColumn("_part", part).join(F.broadcast(before), "_part")  # a row per partition
            .withColumn("number", F.col("_before") + F.col("_row").bitwiseAND((1 << 33) - 1))
            .drop("_part", "_row", "_before"))


#: Arrow types of the result columns that ``map_values`` can build.
ARROW = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64(),
         "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def map_values(rows: DataFrame, column: str, prepare: Callable[[], Callable[[list], list[tuple]]],
               added: str, keep_column: bool = False) -> DataFrame:
    """Add to the rows the ``added`` columns that a Python function gives for the values of ``column``.

    The column itself goes unless ``keep_column``; a kept text is handed over as UTF-8 bytes.

    ``prepare`` runs once per task and returns a function from a batch of values to one tuple for each.
    All other columns pass through as Arrow data, so NULL and large ids stay what they are.
    """
    fields = [tuple(c.split()) for c in added.split(", ")]
    keep = [c for c in rows.columns if keep_column or c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = prepare()
        for batch in batches:
            values = batch.column(column)
            out = compute((values.cast(pa.binary()) if keep_column else values).to_pylist())
            made = [pa.array([r[i] for r in out], ARROW[kind]) for i, (_, kind) in enumerate(fields)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *made],
                                             [*keep, *(name for name, _ in fields)])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in keep]
    return rows.mapInArrow(run, ", ".join([*kept, added]))
