"""Selections, report joins and throughput tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenmeld.functions.names import is_receptor_file, mol_key, norm, pose_file_parts
from screenmeld.functions.numbers import breakable, report_number
from screenmeld.operators.ordering import Rows, fill_down, order_preserving_index

BASE_FIELDS = ("rank", "ligand", "file", "ecr_score", "best_pose")


def fill_blank_join(base: DataFrame, extra: DataFrame, base_key: str, extra_key: str,
                    within: Sequence[str] = (), order: str | None = None) -> DataFrame:
    """Attach extra columns by normalised name; filled values of ``base`` stay.

    ``_docked`` is dropped from extra keys and the last row of a key wins.
    """
    keys = [*within, "_key"]
    keyed = extra.withColumn("_key", norm(F.replace(F.col(extra_key), F.lit("_docked"), F.lit(""))))
    values = [c for c in extra.columns if c not in within and c != extra_key and c != order]
    last = F.max_by(F.struct(*values), F.col(order) if order else F.struct(*values))
    one = (keyed.filter("_key <> ''").groupBy(*keys).agg(last.alias("_x")))
    joined = base.withColumn("_key", norm(F.col(base_key))).join(one, keys, "left")

    def filled(c: str) -> Column:
        kept = F.col(c)
        blank = F.btrim(kept.cast("string")) == ""
        return F.coalesce(F.when(~blank, kept), F.col(f"_x.{c}"), kept).alias(c)

    new = [F.col(f"_x.{c}").alias(c) for c in values if c not in base.columns]
    return joined.select(*[filled(c) if c in values else F.col(c) for c in base.columns], *new)


def cascade_match(rows: DataFrame, records: DataFrame) -> DataFrame:
    """Match report rows to pose records: file name, then unique name, then rank.

    ``rows(series, row, file, name, rank)`` and ``records(series, filename,
    orig_name, mol_name, file_rank)``. Names that fit several records are not
    used. Every row offers its keys with a priority, so one equi-join serves all
    three steps and rows without a key take no part in it.
    """
    rec = F.struct("filename", "mol_name", "file_rank")
    offers = F.array(
        F.struct(F.lit(1).alias("step"), F.col("filename").alias("key")),
        F.struct(F.lit(1).alias("step"), F.col("orig_name").alias("key")),
        F.struct(F.lit(2).alias("step"), mol_key(F.col("mol_name")).alias("key")),
        F.struct(F.lit(2).alias("step"),
                 F.when(F.col("orig_name").isNotNull(), mol_key(F.col("orig_name"))).alias("key")),
        F.struct(F.lit(3).alias("step"), F.col("file_rank").cast("string").alias("key")))
    index = (records.select("series", rec.alias("rec"), F.inline(offers))
             .filter("key IS NOT NULL AND key <> ''")
             .groupBy("series", "step", "key")
             .agg(F.max_by("rec", "rec.filename").alias("rec"), F.count(F.lit(1)).alias("n"))
             .filter("step <> 2 OR n = 1"))
    asks = F.array(F.struct(F.lit(1).alias("step"), F.btrim("file").alias("key")),
                   F.struct(F.lit(2).alias("step"), mol_key(F.col("name")).alias("key")),
                   F.struct(F.lit(3).alias("step"), F.col("rank").cast("string").alias("key")))
    found = (rows.select("series", "row", F.inline(asks)).filter("key IS NOT NULL AND key <> ''")
             .join(index, ["series", "step", "key"])
             .groupBy("series", "row").agg(F.min_by(F.struct("rec", "step"), "step").alias("m")))
    return rows.join(found, ["series", "row"], "left").select(
        *rows.columns, F.col("m.rec.filename").alias("matched_file"),
        F.coalesce("m.rec.mol_name", "name").alias("mol_name"), F.col("m.step").alias("matched_by"))


def unmatched_records(matched: DataFrame, records: DataFrame) -> DataFrame:
    """Pose records whose rank no report row carries."""
    ranks = matched.select("series", F.col("rank").cast("int").alias("file_rank"))
    return records.join(ranks, ["series", "file_rank"], "left_anti")


def pose_records(files: DataFrame, renames: DataFrame | None = None) -> DataFrame:
    """(series, filename, orig_name, mol_name, file_rank) without receptor files."""
    parts = pose_file_parts(F.col("filename"))
    out = files.filter(~is_receptor_file(F.col("filename"))).select(
        "series", "filename", parts["rank"].alias("file_rank"), parts["name"].alias("_name"))
    if renames is None:
        return out.select("series", "filename", F.lit(None).cast("string").alias("orig_name"),
                          F.col("_name").alias("mol_name"), "file_rank")
    known = renames.select(F.col("new_name").alias("filename"), F.col("old_name").alias("orig_name"),
                           F.nullif("mol_name", F.lit("")).alias("_mol"))
    return out.join(known, "filename", "left").select(
        "series", "filename", "orig_name", F.coalesce("_mol", "_name").alias("mol_name"), "file_rank")


def guess_ligands(rows: DataFrame, files: DataFrame, value: str = "value",
                  keys: Sequence[str] = ("target",), bound: Rows = None) -> DataFrame:
    """Ligand whose file name starts with the value, the first in order.

    Names that start with a text lie together in sorted order, and the first of them is the first name
    that isn't smaller. Values and names are therefore sorted once and each value looks at the next name;
    nothing is made per prefix, names may be of any length, and a target of any size is cut into ranges. Blank values match nothing.
    """
    asked = rows.withColumns({"_name": F.btrim(value), "_kind": F.lit(0), "_file": F.lit(None).cast("string")})
    known = files.select(*keys, F.col("ligand").alias("_name"), F.lit(1).alias("_kind"), F.col("ligand").alias("_file"))
    both = asked.unionByName(known, allowMissingColumns=True)
    placed = order_preserving_index(both, list(keys), ["_name", "_kind"], "_at", bound)
    # from the largest name down, the last file seen is the next one in order
    seen = fill_down(placed.withColumn("_back", -F.col("_at")), list(keys), ["_back"], {"_next": F.col("_file")}, bound)
    fits = F.col("_next").startswith(F.col("_name")) & (F.col("_name") != "")
    return seen.filter("_kind = 0").select(*rows.columns, F.when(fits, F.col("_next")).alias("ligand"))


def with_pose_file(selected: DataFrame, files: DataFrame,
                   keys: Sequence[str] = ("target", "ligand")) -> tuple[DataFrame, DataFrame]:
    """Selected ligands with a pose file, and those to warn about."""
    have = files.select(*keys)
    return selected.join(have, list(keys), "left_semi"), selected.join(have, list(keys), "left_anti")


def selection_table(parts: Sequence[DataFrame]) -> DataFrame:
    """Base columns first, then the union of all further columns."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    rest = [c for c in out.columns if c not in BASE_FIELDS]
    return out.select(*[c for c in BASE_FIELDS if c in out.columns], *rest)


def report_order(rows: DataFrame, n: int | None = None, rank: str = "rank") -> DataFrame:
    """By numeric rank, anything else last."""
    number = F.col(rank).cast("string").try_cast("int")
    ties = [c for c in rows.columns if c != rank]
    ordered = rows.orderBy(number.asc_nulls_last(), *ties)
    return ordered if n is None else ordered.limit(n)


def report_rows(matched: DataFrame) -> DataFrame:
    """Columns of the collected report with formatted numbers."""
    return matched.select(
        F.col("series").alias("SERIE"), F.col("rank").alias("RANK"),
        F.col("mol_name").alias("MOL_NAME"), F.coalesce("matched_file", F.lit("")).alias("DATEI"),
        F.col("path").alias("PFAD"), breakable(F.col("smiles")).alias("SMILES"),
        report_number(F.col("ecr"), 4).alias("ECR"),
        report_number(F.col("vina")).alias("score_vina_best"),
        report_number(F.col("cnn")).alias("score_dense_cnnaffinity_best"),
        F.col("pose").cast("string").alias("Pose"))


def first_files(files: DataFrame, n: int) -> DataFrame:
    """Fixed sample of molecules: the first ``n`` paths."""
    return files.orderBy("path").limit(n)


# --- throughput ---

def throughput(runs: DataFrame, results: DataFrame) -> DataFrame:
    """Successful ligands and ligands per hour of each run."""
    ok = results.groupBy("run").agg(F.count_if("success").alias("ligands_ok"))
    rate = F.when(F.col("wall_s") > 0, F.col("ligands_ok") / F.col("wall_s") * 3600)
    return runs.join(ok, "run", "left").select(
        *runs.columns, F.coalesce("ligands_ok", F.lit(0)).alias("ligands_ok"),
        F.coalesce(F.round(rate), F.lit(0.0)).alias("ligands_per_h"))


def telemetry_summary(samples: DataFrame) -> DataFrame:
    """Mean utilisation and power, largest memory per run."""
    return samples.groupBy("run").agg(F.avg("util").alias("gpu_util_pct"),
                                      F.avg("power").alias("power_w"),
                                      F.max("mem").alias("mem_mib_max"))


def speedup(runs: DataFrame) -> DataFrame:
    """Speed-up and efficiency against the run with the fewest GPUs of the series.

    The table has one row per benchmark run.
    """
    series = Window.partitionBy("mode", "batch_size")
    base = F.min_by(F.struct("ligands_per_h", "gpus"), F.struct("gpus", "run")).over(series)
    gain = F.coalesce(F.col("ligands_per_h") / F.when(F.col("_b.ligands_per_h") > 0,
                                                      F.col("_b.ligands_per_h")), F.lit(0.0))
    share = F.col("gpus") / F.when(F.col("_b.gpus") > 0, F.col("_b.gpus"))
    return runs.withColumn("_b", base).select(
        *runs.columns, gain.alias("speedup"),
        F.coalesce(F.lit(100.0) * gain / F.when(share > 0, share), F.lit(0.0))
        .alias("efficiency_pct"))


def plateau_batch(runs: DataFrame, tolerance_pct: float = 3.0,
                  by: Sequence[str] = ("mode",)) -> DataFrame:
    """Smallest batch within the tolerance of the best throughput; failures are out."""
    good = runs.filter("exit = 0 AND ligands_per_h > 0")
    # later runs of a batch replace earlier ones, the maximum is over all runs
    last = good.groupBy(*by, "batch_size").agg(F.max_by("ligands_per_h", "run").alias("_lph"),
                                               F.max("ligands_per_h").alias("_most"))
    best = last.groupBy(*by).agg(F.max("_most").alias("_best"))
    near = last.join(best, list(by)).filter(
        F.col("_lph") >= F.col("_best") * (1 - tolerance_pct / 100.0))
    return near.groupBy(*by).agg(F.min("batch_size").alias("batch_size"))


def granularity(runs: DataFrame, per_gpu: int = 4) -> DataFrame:
    """Chunks, rounds and the speed-up that the chunk size allows at most."""
    chunks = F.ceil(F.col("ligands_in") / F.col("chunk_size"))
    rounds = F.ceil(chunks / F.col("gpus"))
    most = chunks / rounds
    return runs.select("*", chunks.alias("chunks"), rounds.alias("rounds"),
                       most.alias("max_speedup"), (most * 100.0 / F.col("gpus")).alias("max_pct"),
                       ((F.col("gpus") > 1) & (chunks < F.col("gpus") * per_gpu)).alias("too_coarse"))
