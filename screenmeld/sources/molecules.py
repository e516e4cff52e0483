"""Molecule libraries: record files and delimited lists, names and accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenmeld.functions.names import basename, mol_name
from screenmeld.operators.ordering import Rows, rank_rows
from screenmeld.sources.records import with_file
from screenmeld.sources.text import lines

# Header names of the structure and the name column.
SMILES_HEADERS = ("smiles", "canonical_smiles", "smi", "structure")
NAME_HEADERS = ("name", "id", "chembl_id", "molecule_chembl_id", "title", "compound",
                "compound_id", "identifier")


def extension(path: Column) -> Column:
    plain = F.regexp_replace(F.lower(basename(path)), r"\.gz$", "")
    return F.regexp_extract(plain, r"\.([^.]+)$", 1)


def detect_format(path: Column) -> Column:
    """``sdf`` or ``smiles`` by extension; anything else fails the query."""
    ext = extension(path)
    return (F.when(ext.isin("sdf", "sd", "mol"), "sdf")
            .when(ext.isin("smi", "smiles", "csv", "tsv", "txt"), "smiles")
            .when(ext == "pdb", F.raise_error(
                F.lit("PDB has no bond orders; convert it to SDF or SMILES first")))
            .otherwise(F.raise_error(F.concat(F.lit("unknown molecule format: "), path))))


def sdf_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, block, seq, payload, raw_name): splittable scan at ``$$$$`` lines.

    A trailing piece without the end-of-molecule line is not a record.
    """
    raw = lines(spark, path, lineSep="$$$$\n")
    record = F.regexp_replace("value", r"\$\$\$\$\s*$", "")
    return (raw.withColumn("payload", record).filter(F.col("payload").contains("M  END"))
            .select("path", "block", "seq", "payload",
                    F.btrim(F.element_at(F.split("payload", "\r?\n"), 1)).alias("raw_name")))


def delimiter(line: Column, path: Column) -> Column:
    """Regex of the separator: tab, ``;`` or ``,`` for CSV/TSV, otherwise blanks."""
    fixed = (F.when(line.contains("\t"), "\t").when(line.contains(";"), ";")
             .when(line.contains(","), ","))
    return F.coalesce(F.when(extension(path).isin("csv", "tsv"), fixed), F.lit(r"\s+"))


def _position(fields: Column, explicit: str, aliases: tuple[str, ...]) -> Column:
    """0-based index of an explicit column or the first known alias; else NULL."""
    if explicit.isdigit():
        return F.lit(int(explicit))
    lowered = F.transform(fields, lambda f: F.lower(F.btrim(f)))
    if explicit:
        at = F.array_position(lowered, explicit.strip().lower()).cast("int")
        return F.when(at > 0, at - 1).otherwise(F.raise_error(
            F.lit(f"column {explicit!r} is not in the header")).cast("int"))
    found = [F.array_position(lowered, a).cast("int") for a in aliases]
    return F.coalesce(*[F.when(f > 0, f - 1) for f in found])


def _fields(line: Column, separator: Column) -> Column:
    return F.split(F.when(separator == r"\s+", F.btrim(line, F.lit(" \t\r"))).otherwise(line),
                   separator)


def list_layout(data: DataFrame, smiles_col: str = "", name_col: str = "") -> DataFrame:
    """One row per file: separator, column positions, header flag, first line."""
    first = data.groupBy("path").agg(
        F.min_by(F.struct("block", "seq", "value"), F.struct("block", "seq")).alias("f"))
    cut = first.select("path", "f", delimiter(F.col("f.value"), F.col("path")).alias("separator"))
    fields = _fields(F.col("f.value"), F.col("separator"))
    found = cut.select("path", "f", "separator", _position(fields, smiles_col, SMILES_HEADERS).alias("s"),
                       _position(fields, name_col, NAME_HEADERS).alias("n"))
    both = F.col("s").isNotNull() & F.col("n").isNotNull()
    name_first = extension(F.col("path")).isin("csv", "tsv")
    return found.select(
        "path", "separator", F.col("f.block").alias("first_block"), F.col("f.seq").alias("first_seq"),
        F.coalesce("s", F.when(name_first, 1).otherwise(0)).alias("smiles_at"),
        F.coalesce("n", F.when(name_first, 0).otherwise(1)).alias("name_at"),
        (both & F.lit(not smiles_col.isdigit())).alias("has_header"))


def molecule_list(rows: DataFrame, smiles_col: str = "", name_col: str = "") -> DataFrame:
    """(path, block, seq, payload, raw_name) from lines of SMILES lists.

    Blank and ``#`` lines are skipped. The first remaining line of a file is its
    header only if both columns were recognised in it.
    """
    data = rows.filter((F.btrim(F.col("value"), F.lit(" \t\r")) != "")
                       & ~F.ltrim(F.col("value"), F.lit(" \t")).startswith("#"))
    layout = list_layout(data, smiles_col, name_col)
    joined = with_file(data, layout).filter(
        ~(F.col("has_header") & (F.col("block") == F.col("first_block"))
          & (F.col("seq") == F.col("first_seq"))))
    parts = F.transform(_fields(F.col("value"), F.col("separator")),
                        lambda f: F.btrim(f, F.lit(" \t\r")))
    cut = joined.select("path", "block", "seq", "smiles_at", "name_at", parts.alias("p"))
    return (cut.select("path", "block", "seq", F.get("p", F.col("smiles_at")).alias("payload"),
                       F.coalesce(F.get("p", F.col("name_at")), F.lit("")).alias("raw_name"))
            .filter(F.col("payload").isNotNull() & (F.col("payload") != "")))


def index_molecules(molecules: DataFrame, prefix: Column | None = None,
                    rows: Rows = None) -> DataFrame:
    """Add the position ``idx`` in the library and the file-safe ``name``.

    The library is the ``lib`` column, or the file when there is none.
    """
    lib = molecules if "lib" in molecules.columns else molecules.withColumn("lib", F.col("path"))
    placed = rank_rows(lib, ["lib"], ["path", "block", "seq"], "_at", "first", rows)
    idx = (F.col("_at") - 1).alias("idx")
    with_idx = placed.select(*lib.columns, idx)
    return with_idx.select("*", mol_name(F.col("raw_name"), F.col("idx"), prefix).alias("name"))


def first_by_name(molecules: DataFrame, keys: tuple[str, ...] = ("lib", "name"),
                  order: str = "idx") -> DataFrame:
    """Flag the first row of each name (``kept``); later ones are duplicates.

    The first position comes from an aggregate that combines before the
    shuffle, so one very common name does not gather in a task.
    """
    firsts = molecules.groupBy(*keys).agg(F.min(order).alias("_first"))
    return (molecules.join(firsts, list(keys))
            .withColumn("kept", F.col(order) == F.col("_first")).drop("_first"))


def pending(molecules: DataFrame, done: DataFrame, keys: tuple[str, ...] = ("name",)) -> DataFrame:
    """Molecules without a non-empty output; positions stay as they were."""
    return molecules.join(done.filter("length > 0").select(*keys).distinct(), list(keys), "left_anti")


def ingest_accounting(flagged: DataFrame) -> DataFrame:
    """Counts per library: read, queued, skipped, duplicate, unnamed.

    Expects the flags ``kept`` and ``exists`` and the ``raw_name``.
    """
    kept, exists = F.col("kept"), F.col("exists")
    return flagged.groupBy("lib").agg(
        F.count(F.lit(1)).alias("read"), F.count_if(kept & ~exists).alias("queued"),
        F.count_if(kept & exists).alias("skipped"), F.count_if(~kept).alias("duplicate"),
        F.count_if(F.btrim("raw_name") == "").alias("unnamed"))


def status_counts(results: DataFrame, by: tuple[str, ...] = ("lib",)) -> DataFrame:
    """OK, ERROR and TIMEOUT counts with the success share."""
    ok = F.count_if(F.col("status") == "OK")
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), ok.alias("ok"),
        F.count_if(F.col("status") == "ERROR").alias("error"),
        F.count_if(F.col("status") == "TIMEOUT").alias("timeout"),
        (ok * 100.0 / F.count(F.lit(1))).alias("ok_pct"))
