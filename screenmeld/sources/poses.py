"""Docked pose files as tables: energies, bodies, coordinates, embedded SMILES.

The parsers take ``(path, value)`` rows, so they work on files as well as on
text that is already in a table. A pose keeps its number in the file for good.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenmeld.functions.names import parent, stem
from screenmeld.sources.text import whole_files

# Energy remark, atom records and hydrogen types of the format.
ENERGY = r"(?m)^REMARK[^\S\n]+VINA[^\S\n]+RESULT:[^\S\n]*([^\s]*)"
HYDROGENS = ("H", "HD", "HS")


def pose_files(spark: SparkSession, results_dir: str) -> DataFrame:
    """(target, ligand, path, value) of ``<target>/<ligand>_docked.pdbqt``."""
    files = whole_files(spark, results_dir, pathGlobFilter="*_docked.pdbqt",
                        recursiveFileLookup="true")
    return files.select(parent(F.col("path")).alias("target"),
                        F.regexp_replace(stem(F.col("path")), "_docked$", "").alias("ligand"),
                        "path", "value")


def leading_number(text: Column) -> Column:
    """Number at the start of a text, ``-.5`` included; NULL without one."""
    return F.nullif(F.regexp_extract(text, r"^[-+]?(?:\d+\.?\d*|\.\d+)", 0), F.lit("")).try_cast("double")


def pose_energies(files: DataFrame) -> DataFrame:
    """One row per energy remark that holds a number: pose number from 1 and energy.

    A remark without one still counts, so later poses keep their numbers.
    """
    found = F.regexp_extract_all("value", F.lit(ENERGY), F.lit(1))
    others = [c for c in files.columns if c != "value"]
    return files.select(*others, F.posexplode(found)).select(
        *others, (F.col("pos") + 1).cast("int").alias("pose"),
        leading_number(F.col("col")).alias("energy")).filter(F.col("energy").isNotNull())


def best_energy(files: DataFrame) -> DataFrame:
    """Energy of the first pose; without one the docking failed."""
    first = leading_number(F.regexp_extract("value", ENERGY, 1))
    others = [c for c in files.columns if c != "value"]
    return files.select(*others, first.alias("energy"), first.isNull().alias("failed"))


def _keep_lines(text: Column, keep) -> Column:
    return F.filter(F.split(text, "\r?\n"), keep)


def pose_bodies(files: DataFrame) -> DataFrame:
    """(…, pose, body): pose texts without MODEL and ENDMDL lines.

    A file without MODEL records is one pose. Otherwise only lines between a MODEL
    and its ENDMDL belong to a pose.
    """
    value = F.col("value")
    closed = value.rlike(r"(?m)^ENDMDL")
    parts = F.split(value, r"(?m)^ENDMDL[^\n]*\n?")
    opened = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1),
                         lambda p: F.regexp_replace(p, r"(?sm)\A.*?^(?=MODEL)", ""))
    models = F.when(closed, opened).otherwise(
        F.when(~value.rlike(r"(?m)^MODEL") & (F.btrim(value) != ""), F.array(value)))
    others = [c for c in files.columns if c != "value"]
    body = F.array_join(_keep_lines(F.col("col"), lambda ln: ~ln.startswith("MODEL") & (ln != "")),
                        "\n")
    return files.select(*others, F.posexplode(models)).select(
        *others, (F.col("pos") + 1).cast("int").alias("pose"), body.alias("body"))


def heavy_atoms(body: Column) -> Column:
    """Coordinates of the non-hydrogen atoms of a pose body, in file order."""
    def element(line: Column) -> Column:
        typed = F.when(F.length(line) >= 78, F.btrim(F.substring(line, 78, 2)))
        named = F.regexp_replace(F.substring(line, 13, 4), r"[^\p{L}]", "")
        return F.coalesce(F.nullif(typed, F.lit("")), named)

    def at(line: Column) -> Column:
        axis = lambda start: F.btrim(F.substring(line, start, 8)).try_cast("double")
        return F.struct(axis(31).alias("x"), axis(39).alias("y"), axis(47).alias("z"))

    atoms = _keep_lines(body, lambda ln: ln.rlike("^(ATOM|HETATM)")
                        & ~element(ln).isin(*HYDROGENS))
    return F.filter(F.transform(atoms, at),
                    lambda p: p["x"].isNotNull() & p["y"].isNotNull() & p["z"].isNotNull())


def embedded_smiles(text: Column) -> Column:
    """All ``REMARK SMILES`` parts of the first model, joined without a separator."""
    first = F.element_at(F.split(text, "(?m)^ENDMDL"), 1)
    rest = F.transform(
        _keep_lines(first, lambda ln: ln.startswith("REMARK SMILES")),
        lambda ln: F.btrim(F.substr(ln, F.lit(len("REMARK SMILES") + 1)), F.lit(" \t\r")))
    return F.array_join(F.filter(rest, lambda s: ~F.upper(s).rlike("^(IDX|INDEX)")), "")


def render_pose(number: Column, remarks: Column, body: Column) -> Column:
    """MODEL text of one pose: header, remark lines, body, ENDMDL."""
    lines = F.array_append(F.concat(
        F.array(F.concat(F.lit("MODEL     "), number.cast("string"))), remarks, F.array(body)),
        F.lit("ENDMDL"))
    return F.array_join(F.filter(lines, lambda ln: ln.isNotNull() & (ln != "")), "\n")


def compact_poses(spark: SparkSession, results_dir: str, out: str) -> None:
    """Read millions of small pose files once and keep them as Parquet by target."""
    bodies = pose_bodies(pose_files(spark, results_dir))
    table = bodies.select(
        "target", "ligand", "pose",
        leading_number(F.regexp_extract("body", ENERGY, 1)).alias("score_vina"), heavy_atoms(F.col("body")).alias("coords"), "body")
    table.write.partitionBy("target").parquet(out)
