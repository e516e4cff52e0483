"""Delimited result tables with fixed or tolerant headers."""

from __future__ import annotations

import csv
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenmeld.catalog import KEYS, columns_of
from screenmeld.functions.names import COLUMN_ALIASES, match_header
from screenmeld.functions.numbers import number_or_null, success_flag
from screenmeld.sources.records import first_lines, join_records, with_file
from screenmeld.sources.text import lines, plain_path

SEPARATORS = (",", ";", "\t", "|")
#: Different header lines of one table.
MOST_LAYOUTS = 1000


def with_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``; absent ones are typed NULLs."""
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in df.columns
         else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def docking_results(spark: SparkSession, path: str) -> DataFrame:
    """Docking table with repaired truth values and energies."""
    return repair_docking(spark.read.option("header", True).csv(path))


def repair_docking(raw: DataFrame) -> DataFrame:
    others = [c for c in raw.columns
              if c not in ("ligand", "success", "best_energy_kcal_mol", "error")]
    return raw.select(*others, "ligand", success_flag(F.col("success")).alias("success"),
                      number_or_null(F.col("best_energy_kcal_mol")).alias("best_energy_kcal_mol"),
                      F.nullif("error", F.lit("")).alias("error"))


def partial_scores(rows: DataFrame, scores: Iterable[str] = KEYS) -> DataFrame:
    """Block files of raw scores from their lines; blanks and missing columns are NULL.

    Files may differ in their headers: each is read by the names in its own
    first line.
    """
    data = rows.filter(F.btrim("value") != "")
    body = with_file(data, first_lines(data)).filter(
        (F.col("block") != F.col("h.block")) | (F.col("seq") != F.col("h.seq")))
    trim = lambda text: F.transform(F.split(text, ","), lambda f: F.btrim(f, F.lit(" \t\r")))
    names, values = trim(F.col("h.value")), trim(F.col("value"))
    width = F.least(F.size(names), F.size(values))
    cell = F.map_from_arrays(F.slice(names, F.lit(1), width), F.slice(values, F.lit(1), width))
    cut = body.select("path", cell.alias("_c"))
    get = lambda n: F.nullif(F.try_element_at("_c", F.lit(n)), F.lit(""))
    return cut.select("path", get("ligand").alias("ligand"),
                      get("pose").try_cast("int").alias("pose"),
                      *[number_or_null(get(c)).alias(c) for c in columns_of(scores)])


def sniff_separator(line: str) -> str:
    """The separator that cuts a header into most parts."""
    return max(SEPARATORS, key=lambda s: (line.count(s), -SEPARATORS.index(s)))


def _header(line: str, sep: str) -> list[str]:
    """Column names of a header line; empty and repeated ones get their place, as Spark's CSV reader does it."""
    names = next(csv.reader([line], delimiter=sep), [])
    low = [n.lower() for n in names]
    return [f"_c{i}" if not n else n if low.count(n.lower()) == 1 else f"{n}{i}" for i, n in enumerate(names)]


def sniffed_csv(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, str | None]]:
    """:func:`sniffed_lines` of the files under a path."""
    return sniffed_lines(lines(spark, path))


def sniffed_lines(rows: DataFrame) -> tuple[DataFrame, dict[str, str | None]]:
    """A table with guessed separators and its logical columns; each file is read by its own header line.

    Quoted fields may hold line breaks. Blank lines between records are left out. Distinct header lines are the layouts;
    they come to the driver, as their names become columns, and more than ``MOST_LAYOUTS`` are an error: the files have no headers
    then. A logical column has the name it has in the first layout, in the order of paths, that knows it.
    """
    heads = first_lines(rows.filter(F.btrim("value") != ""))
    counts = heads.groupBy(F.col("h.value").alias("head")).agg(F.min("path").alias("p")).orderBy("p", "head").limit(MOST_LAYOUTS + 1)
    layouts = [r["head"] for r in counts.collect()]
    if len(layouts) > MOST_LAYOUTS:
        raise ValueError(f"over {MOST_LAYOUTS} different header lines")
    columns: dict[str, None] = {}
    known: dict[str, str] = {}
    table = []
    for head in layouts:
        sep = sniff_separator(head)
        names = _header(head, sep)
        for k in COLUMN_ALIASES:
            found = match_header(names, k)
            if found and known.setdefault(k, found) not in names:
                names[names.index(found)] = known[k]
        columns |= dict.fromkeys(names)
        table.append((head, sep, names))
    width = max((len(t[2]) for t in table), default=0)
    if not width:
        return rows.select().limit(0), dict.fromkeys(COLUMN_ALIASES)
    small = rows.sparkSession.createDataFrame(table, "head string, sep string, names array<string>")
    files = heads.join(F.broadcast(small), F.col("h.value") == F.col("head")).select("path", "h", "sep", "names")  # MOST_LAYOUTS rows
    body = with_file(rows, files).filter((F.col("block") > F.col("h.block")) | (
        (F.col("block") == F.col("h.block")) & (F.col("seq") > F.col("h.seq"))))
    records = join_records(body, "sep", SEPARATORS, ["sep", "names"]).filter(F.btrim("value") != "")
    schema = ", ".join(f"c{i} string" for i in range(width))
    options = lambda s: {"sep": s, "multiLine": "true", "escape": '"'}
    cells = F.coalesce(*[F.when(F.col("sep") == s, F.from_csv("value", schema, options(s))) for s in SEPARATORS])
    cut = records.select("names", cells.alias("r")).select("names", F.array(*[F.col(f"r.c{i}") for i in range(width)]).alias("v"))
    df = cut.select(*[F.get("v", F.array_position("names", F.lit(n)).cast("int") - 1).alias(n) for n in columns])
    return df, {k: known.get(k) for k in COLUMN_ALIASES}


def resolve_columns(df: DataFrame) -> DataFrame:
    """Logical report columns from whatever headers the table has."""
    found = {k: match_header(df.columns, k) for k in COLUMN_ALIASES}
    return df.select(*[(F.col(f"`{c}`") if c else F.lit(None)).cast("string").alias(k)
                       for k, c in found.items()])


def rename_map(spark: SparkSession, path: str) -> DataFrame:
    """Old and molecule names by new file name; rows without a new name drop."""
    return usable_renames(spark.read.option("header", True).option("sep", ";").csv(path))


def usable_renames(raw: DataFrame) -> DataFrame:
    want = T.StructType([T.StructField(c, T.StringType())
                         for c in ("new_name", "old_name", "mol_name")])
    return with_columns(raw, want).filter("new_name IS NOT NULL AND new_name <> ''")


def telemetry(spark: SparkSession, path: str) -> DataFrame:
    """Header-less samples of GPU index, utilisation, memory and power."""
    schema = "gpu int, util double, mem double, power double"
    return (spark.read.option("ignoreLeadingWhiteSpace", True).schema(schema).csv(path)
            .withColumn("path", plain_path(F.col("_metadata.file_path"))))
