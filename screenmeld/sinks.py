"""Result sinks: Parquet keeps full doubles, CSV sinks round as the formats ask."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmeld.catalog import KEYS, score
from screenmeld.functions.numbers import csv_number
from screenmeld.operators.evaluate import label_from_name
from screenmeld.operators.reconcile import in_result_order

# Digits of the text formats and the refinement columns.
SCORE_DIGITS, ECR_DIGITS, PARTIAL_DIGITS, RERANK_DIGITS = 4, 6, 6, 3
REFINEMENT_COLUMNS = (
    "refined_rank", "ligand", "ecr_rank", "ecr_score", "combined_score", "refined_vina",
    "refined_cnnscore", "refined_cnnaffinity", "original_vina", "original_cnnscore",
    "original_cnnaffinity", "delta_vina", "delta_cnnaffinity", "refinement_mode")
BENCHMARK_COLUMNS = (
    "run", "gpus", "mode", "batch_size", "chunk_size", "ligands_in", "ligands_ok", "wall_s",
    "ligands_per_h", "gpu_util_pct", "power_w", "mem_mib_max", "exit")
DOCKING_COLUMNS = ("ligand", "success", "best_energy_kcal_mol", "error")


def _get(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def pose_csv_rows(df: DataFrame) -> DataFrame:
    """The 27 columns of a pose table as text-ready values, with its target."""
    cols = [score(k) for k in KEYS]
    scores = [csv_number(_get(df, s.column, "double"), SCORE_DIGITS).alias(s.column) for s in cols]
    ranks = [_get(df, s.rank_column, "long").alias(s.rank_column) for s in cols]
    terms = [csv_number(F.coalesce(_get(df, s.term_column, "double"), F.lit(0.0)), ECR_DIGITS)
             .alias(s.term_column) for s in cols]
    return df.select("target", "ligand", "pose", *scores, *ranks, *terms,
                     csv_number(F.col("ecr_total"), ECR_DIGITS).alias("ecr_total"))


def ligand_csv_rows(df: DataFrame) -> DataFrame:
    """Ligand ranking with ``active`` from the name, blank if unknown."""
    best = [csv_number(_get(df, f"{score(k).column}_best", "double"), SCORE_DIGITS)
            .alias(f"{score(k).column}_best") for k in KEYS]
    return df.select("target", "ecr_rank", "ligand",
                     csv_number(F.col("ecr_score"), ECR_DIGITS).alias("ecr_score"), "best_pose", *best,
                     label_from_name(F.col("ligand")).alias("active"))


def refinement_csv_rows(df: DataFrame) -> DataFrame:
    whole = ("refined_rank", "ligand", "ecr_rank", "refinement_mode")
    digits = {"ecr_score": ECR_DIGITS, "combined_score": ECR_DIGITS}
    return df.select("target", *[
        _get(df, c, "string").alias(c) if c in whole
        else csv_number(_get(df, c, "double"), digits.get(c, SCORE_DIGITS)).alias(c)
        for c in REFINEMENT_COLUMNS])


def partial_csv_rows(df: DataFrame) -> DataFrame:
    return df.select("target", "ligand", "pose", *[
        csv_number(_get(df, score(k).column, "double"), PARTIAL_DIGITS).alias(score(k).column)
        for k in KEYS])


def rerank_csv_rows(df: DataFrame, scores: Sequence[str]) -> DataFrame:
    """Re-ranking with the columns of the active scores only."""
    return df.select("target", "ecr_rank", "ligand",
                     csv_number(F.col("ecr_score"), ECR_DIGITS).alias("ecr_score"), "best_pose",
                     *[csv_number(F.col(f"{score(k).column}_best"), RERANK_DIGITS)
                       .alias(f"{score(k).column}_best") for k in scores])


def write_table(df: DataFrame, path: str, by: Sequence[str] = ("target",),
                mode: str = "errorifexists") -> None:
    """Parquet by target; other options of Spark's writer apply through the session."""
    df.write.mode(mode).partitionBy(*by).parquet(path)


def write_sorted_csv(df: DataFrame, path: str, order: Sequence[str], by: str = "target",
                     sep: str = ",", mode: str = "errorifexists") -> None:
    """CSV folders per target whose files, in name order, hold the sorted rows.

    Rows are range-partitioned by target and sort key, so a large target is
    written by many tasks.
    """
    (df.repartitionByRange(by, *order).sortWithinPartitions(by, *order)
     .write.mode(mode).option("header", True).option("sep", sep).partitionBy(by).csv(path))


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def write_blocks(df: DataFrame, path: str) -> None:
    """Raw scores of blocks; only the blocks that are written are replaced.

    The commit protocol publishes a block as a whole or not at all.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("target", "block").parquet(path))


def write_docking_results(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Successes by energy, then failures."""
    ordered = in_result_order(df).select(*DOCKING_COLUMNS)
    ordered.write.mode(mode).option("header", True).csv(path)


def write_ranking(df: DataFrame, path: str, scores: Sequence[str], weights: Mapping[str, float],
                  sigma_fraction: float, revision: str = "") -> None:
    """A ranking and, next to it, a table with the parameters it was made with."""
    write_table(df, f"{path}/ranking")
    meta = df.sparkSession.createDataFrame(
        [(list(scores), dict(weights), float(sigma_fraction), revision)],
        "scores array<string>, weights map<string,double>, sigma_fraction double, revision string")
    meta.write.parquet(f"{path}/_ranking_meta")


def read_ranking_meta(spark, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/_ranking_meta")


def combined_pose_text(df: DataFrame) -> DataFrame:
    """(target, rank, value): one MODEL per ranked ligand with its remarks."""
    energy = F.when(F.col("refined_vina").isNotNull(), F.concat(
        F.lit("REMARK VINA RESULT:    "), csv_number(F.col("refined_vina"), 3),
        F.lit("      0.000      0.000")))
    body = F.array_join(F.filter(F.split("body", "\n"), lambda ln: ~ln.startswith("MODEL")
                                 & ~ln.startswith("ENDMDL") & (ln != "")), "\n")
    text = F.concat_ws(
        "\n", F.concat(F.lit("MODEL     "), F.col("refined_rank").cast("string")),
        F.concat(F.lit("REMARK  LIGAND: "), F.col("ligand")),
        F.concat(F.lit("REMARK  ECR_RANK: "), F.col("ecr_rank").cast("string")),
        F.concat(F.lit("REMARK  REFINED_RANK: "), F.col("refined_rank").cast("string")),
        energy, body, F.lit("ENDMDL"))
    return df.select("target", F.col("refined_rank").alias("rank"), text.alias("value"))


def write_combined_poses(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    texts = combined_pose_text(df)
    (texts.repartitionByRange("target", "rank").sortWithinPartitions("target", "rank")
     .select("target", "value").write.mode(mode).partitionBy("target").text(path))


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode(mode).text(path)


def benchmark_csv_rows(runs: DataFrame) -> DataFrame:
    """Measured runs with the columns of ``BENCHMARK_COLUMNS``; what a run lacks stays blank."""
    return runs.select(*[F.coalesce(_get(runs, c, "string").cast("string"), F.lit("")).alias(c)
                         for c in BENCHMARK_COLUMNS])


def duplicate_name_rows(flagged: DataFrame, number: str, name: str) -> DataFrame:
    """``number<TAB>name`` lines of the rows that lost a name collision (``kept`` is false)."""
    return flagged.filter(~F.col("kept")).select(
        F.concat_ws("\t", F.col(number).cast("string"), F.col(name)).alias("value"))


def validation_csv_rows(results: DataFrame) -> DataFrame:
    """Every column of a validation table as text, numbers in full, blanks for missing values."""
    return results.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in results.columns])
