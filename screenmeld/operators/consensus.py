"""Exponential consensus ranking: ranks, terms, ligand aggregation, top lists."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenmeld.catalog import (SIGMA_FRACTION, available, consensus_weights,
                                normalized_weight_columns, score)
from screenmeld.operators.ordering import Bound, Rows, bound_of, rank_rows, stored, with_totals
from screenmeld.session import rows_per_task, stage

MAX_TARGETS = 10_000
GROUP_LIMIT = 1000
REFINEMENT_DIGITS = 9


@dataclass(frozen=True)
class Profile:
    """Rows and filled scores per target, taken once from the pose table.

    ``bounded`` says that the number of targets was checked, so tables with a
    fixed number of rows per target may be broadcast.
    """

    rows: Bound
    table: DataFrame
    bounded: bool

    def attach(self, df: DataFrame, small: DataFrame, on: Sequence[str]) -> DataFrame:
        return df.join(F.broadcast(small) if self.bounded else small, list(on))


def profile(poses: DataFrame, scores: Iterable[str] | None = None,
            target: str = "target") -> Profile:
    """Count poses and non-NULL scores per target in one aggregate."""
    keys = available(poses, scores) if scores is not None else available(poses)
    counts = poses.groupBy(target).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(score(k).column).alias(f"n_{k}") for k in keys])
    head = counts.limit(MAX_TARGETS + 1).collect()
    if len(head) <= MAX_TARGETS:
        table = poses.sparkSession.createDataFrame(head, counts.schema)
        sizes = [r["n"] for r in head]
        return Profile(Bound(max(sizes, default=0), sum(sizes)), table, True)
    sizes = counts.agg(F.max("n"), F.sum("n")).first()
    return Profile(Bound(sizes[0], sizes[1]), counts, False)


def rank_scores(poses: DataFrame, scores: Sequence[str], ties: str = "first",
                target: str = "target", rows: Rows = None,
                higher_is_better: Mapping[str, bool] | None = None) -> DataFrame:
    """Add ``rank_<score>`` per target (1 = best); a NULL score has no rank.

    ``ties='first'`` breaks ties by (ligand, pose), ``ties='min'`` gives equal
    scores the same rank. Up to ``rows_per_task`` poses per target the ranks are windows
    over the wide rows; beyond, one function after the other is ranked. Keys of ``poses`` are then
    read twice per function, so what is dear to make should be stored, and so should the result if it is read again.
    """
    if ties not in ("first", "min"):
        raise ValueError(f"unknown tie rule {ties!r}")
    rows = bound_of(poses, rows)
    higher = higher_is_better or {}

    def signed(k: str) -> Column:
        col = F.col(score(k).column)
        return -col if higher.get(k, False) else col

    if rows.largest <= rows_per_task(poses.sparkSession):
        def ranked(k: str) -> Column:
            order = [signed(k).asc_nulls_last()]
            over = Window.partitionBy(target).orderBy(
                *order, *(["ligand", "pose"] if ties == "first" else []))
            value = F.row_number() if ties == "first" else F.rank()
            return (F.when(F.col(score(k).column).isNotNull(), value.over(over).cast("long"))
                    .alias(score(k).rank_column))
        return poses.select("*", *[ranked(k) for k in scores])

    tail = ["ligand", "pose"] if ties == "first" else []
    out = poses
    for k in scores:
        ranked = rank_rows(out.withColumn("_key", signed(k)), [target], ["_key", *tail], score(k).rank_column, ties, rows,
                           source=poses.withColumn("_key", signed(k)), unranked=True)
        out = ranked.drop("_key")
    return out


def term(rank: Column, n: Column, sigma_fraction: Column | float) -> Column:
    """``exp(-rank / sigma)`` with ``sigma = max(n / fraction, 1)``; no rank gives 0."""
    fraction = F.lit(float(sigma_fraction)) if isinstance(sigma_fraction, (int, float)) \
        else sigma_fraction
    sigma = F.greatest(n.cast("double") / fraction, F.lit(1.0))
    return F.coalesce(F.exp(-rank / sigma), F.lit(0.0))


def consensus_poses(ranked: DataFrame, scores: Sequence[str], prof: Profile,
                    weights: Mapping[str, float] | None = None,
                    sigma_fraction: float = SIGMA_FRACTION, target: str = "target") -> DataFrame:
    """Add ``ecr_<score>`` terms and the weighted ``ecr_total`` of each pose.

    ``n`` counts all poses of the target, with or without a score. A function
    without any value in a target is left out there and the weights of the
    others are scaled up in proportion.
    """
    base = consensus_weights(scores, weights)
    shares = normalized_weight_columns(
        scores, {k: F.lit(base[k]) for k in scores},
        {k: F.col(f"n_{k}") > 0 for k in scores})
    per_target = prof.table.select(
        target, F.col("n").alias("_n"), *[shares[k].alias(f"_w_{k}") for k in scores])
    joined = prof.attach(ranked, per_target, [target])
    terms = joined.select(*ranked.columns, *[f"_w_{k}" for k in scores], *[
        term(F.col(score(k).rank_column), F.col("_n"), sigma_fraction).alias(score(k).term_column)
        for k in scores])
    total = sum((F.col(f"_w_{k}") * F.col(score(k).term_column) for k in scores), F.lit(0.0))
    return terms.select(*ranked.columns, *[score(k).term_column for k in scores],
                        total.alias("ecr_total"))


def best_pose(posed: DataFrame, scores: Sequence[str], keys: Sequence[str] = ("target", "ligand"),
              value: str = "ecr_total", keep: Sequence[str] = (), dealt: bool = False) -> DataFrame:
    """The pose with the largest ``value`` per ligand; the lowest pose wins ties.

    Poses of a ligand lie apart after ranking. They are dealt before they are aggregated, so that they are sorted once
    and not on both sides of a shuffle; ``dealt`` says that they were.
    """
    pick = F.max_by(
        F.struct(F.col("pose"), F.col(value), *[F.col(score(k).column) for k in scores],
                 *[F.col(c) for c in keep]),
        F.struct(F.col(value), -F.col("pose")))
    # the last key has the most values, so a sort that starts with it compares fewer whole keys
    return ((posed if dealt else posed.repartition(*keys)).groupBy(*reversed(keys)).agg(pick.alias("b"))
            .select(*keys, F.col("b.pose").alias("best_pose"), F.col(f"b.{value}").alias("ecr_score"),
                    *[F.col(f"b.{score(k).column}").alias(f"{score(k).column}_best")
                      for k in scores],
                    *[F.col(f"b.{c}").alias(c) for c in keep]))


def best_by_score(poses: DataFrame, key: str, higher_is_better: bool = False,
                  keys: Sequence[str] = ("target", "ligand"),
                  keep: Sequence[str] = ()) -> DataFrame:
    """The pose with the best single score per ligand; NULL scores are left out."""
    col = F.col(score(key).column)
    goodness = col if higher_is_better else -col
    pick = F.max_by(F.struct("pose", score(key).column, *keep), F.struct(goodness, -F.col("pose")))
    return (poses.filter(col.isNotNull()).groupBy(*keys).agg(pick.alias("b"))
            .select(*keys, "b.*"))


def rank_ligands(ligands: DataFrame, value: str = "ecr_score", name: str = "ecr_rank",
                 target: Sequence[str] = ("target",), rows: Rows = None) -> DataFrame:
    """Number the ligands of a target by falling ``value``, ties by ligand."""
    keyed = ligands.withColumn("_falling", -F.col(value))
    rows = bound_of(keyed, rows)
    keyed = stored(keyed, rows, "ligands")
    return rank_rows(keyed, list(target), ["_falling", "ligand"], name, "first",
                     rows, staged=True, source=keyed).drop("_falling")


def rerank(poses: DataFrame, scores: Sequence[str], weights: Mapping[str, float] | None = None,
           sigma_fraction: float = SIGMA_FRACTION, ties: str = "first",
           prof: Profile | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Ranked ligands of all targets from stored pose scores (no re-scoring)."""
    prof = prof or profile(poses, scores)
    ranked = rank_scores(poses, scores, ties, rows=prof.rows)
    posed = consensus_poses(ranked, scores, prof, weights, sigma_fraction)
    return rank_ligands(best_pose(posed, scores, keep=keep), rows=prof.rows)


def rerank_scenarios(poses: DataFrame, scores: Sequence[str],
                     scenarios: Mapping[str, Mapping[str, float] | None],
                     sigma_fraction: float = SIGMA_FRACTION, ties: str = "first",
                     prof: Profile | None = None, numbered: bool = True) -> DataFrame:
    """Many weightings in one job: ranks are computed once and shared; ``numbered`` adds ``ecr_rank`` of the ligands."""
    prof = prof or profile(poses, scores)
    ranked = rank_scores(poses, scores, ties, rows=prof.rows)
    sets = {name: consensus_weights(scores, w) for name, w in scenarios.items()}
    table = F.array(*[F.struct(F.lit(n).alias("scenario"),
                               *[F.lit(w[k]).alias(f"raw_{k}") for k in scores])
                      for n, w in sets.items()])
    shares = normalized_weight_columns(
        scores, {k: F.col(f"raw_{k}") for k in scores}, {k: F.col(f"n_{k}") > 0 for k in scores})
    per_target = (prof.table.select("*", F.inline(table))
                  .select("target", "scenario", F.col("n").alias("_n"),
                          *[shares[k].alias(f"_w_{k}") for k in scores]))
    nested = per_target.groupBy("target").agg(
        F.first("_n").alias("_n"),
        F.collect_list(F.struct("scenario", *[f"_w_{k}" for k in scores])).alias("_sets"))
    terms = prof.attach(ranked, nested, ["target"]).select(
        "target", "ligand", "pose", *[score(k).column for k in scores], "_sets",
        *[term(F.col(score(k).rank_column), F.col("_n"), sigma_fraction)
          .alias(score(k).term_column) for k in scores]).repartition("target", "ligand")
    posed = terms.select("*", F.inline("_sets")).withColumn("ecr_total", sum(
        (F.col(f"_w_{k}") * F.col(score(k).term_column) for k in scores), F.lit(0.0)))
    ligands = best_pose(posed, scores, keys=("scenario", "target", "ligand"), dealt=True)
    if not numbered:
        return ligands
    return rank_ligands(ligands, target=("scenario", "target"), rows=prof.rows.times(len(sets)))


def top_n(ligands: DataFrame, n: int, value: str = "ecr_score",
          target: Sequence[str] = ("target",), rows: Rows = None) -> DataFrame:
    """Best ``n`` ligands per target, an unreadable score or NaN counting as 0.

    A limit on the row number lets Spark cut every input partition to ``n``
    rows per target before the shuffle, so a large target stays spread out. Spark
    does so up to 1000 rows; longer lists are cut from the full ranking.
    """
    number = F.col(value).try_cast("double")
    safe = F.coalesce(F.when(~F.isnan(number), number), F.lit(0.0))
    if n > GROUP_LIMIT:
        keyed = ligands.withColumn("_falling", -safe)
        return (rank_rows(keyed, list(target), ["_falling", "ligand"], "rank", "first", rows)
                .filter(F.col("rank") <= n).drop("_falling").withColumn("rank", F.col("rank").cast("int")))
    over = Window.partitionBy(*target).orderBy(safe.desc(), F.col("ligand"))
    return (ligands.withColumn("rank", F.row_number().over(over))
            .filter(F.col("rank") <= n))


def top_fraction(ligands: DataFrame, fraction: float, value: str = "ecr_score",
                 rows: Rows = None) -> DataFrame:
    """Best ``max(1, ceil(n * fraction))`` ligands per target."""
    if not 0.0 < fraction <= 1.0:
        raise ValueError("fraction must lie in (0, 1]")
    numbered = rank_ligands(ligands, value, "rank", rows=rows)
    sized = with_totals(numbered, ["target"], {"_n": F.lit(1)}, rows)
    quota = F.greatest(F.lit(1), F.ceil(F.col("_n") * F.lit(float(fraction))))
    return sized.filter(F.col("rank") <= quota).drop("_n")


def refinement_score(cnnscore: Column, affinity: Column, vina: Column) -> Column:
    """0.3 CNN score + 0.3 affinity/10 + 0.4 -vina/12 over the present parts.

    Affinity and vina parts are clipped to [0, 1]; weights of missing parts are
    shared out in proportion, and nothing present gives 0.
    """
    clip = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    parts = [(0.3, cnnscore), (0.3, clip(affinity / F.lit(10.0))), (0.4, clip(-vina / F.lit(12.0)))]
    present = [cnnscore.isNotNull(), affinity.isNotNull(), vina.isNotNull()]
    top = sum((F.when(p, F.lit(w) * v).otherwise(F.lit(0.0))
               for (w, v), p in zip(parts, present)), F.lit(0.0))
    share = sum((F.when(p, F.lit(w)).otherwise(F.lit(0.0))
                 for (w, _), p in zip(parts, present)), F.lit(0.0))
    return F.coalesce(top / F.nullif(share, F.lit(0.0)), F.lit(0.0))


def rank_refinement(results: DataFrame, rows: Rows = None) -> DataFrame:
    """Deltas, combined score and rank of refined poses; scores equal at 9 decimals tie and go by ligand.

    Expects refined and original values in raw direction: ``refined_cnnscore``,
    ``refined_cnnaffinity``, ``refined_vina``, ``original_cnnaffinity``,
    ``original_vina``.
    """
    scored = results.select(
        "*",
        (F.col("refined_vina") - F.col("original_vina")).alias("delta_vina"),
        (F.col("refined_cnnaffinity") - F.col("original_cnnaffinity")).alias("delta_cnnaffinity"),
        refinement_score(F.col("refined_cnnscore"), F.col("refined_cnnaffinity"),
                         F.col("refined_vina")).alias("combined_score"))
    tied = scored.withColumn("_tied", F.round("combined_score", REFINEMENT_DIGITS))
    return rank_ligands(tied, "_tied", "refinement_rank", rows=rows).drop("_tied")


def refinement_gain(ranked: DataFrame) -> DataFrame:
    """How many refined poses improved clearly, per target."""
    return ranked.groupBy("target").agg(
        F.count(F.lit(1)).alias("refined"),
        F.count_if(F.col("delta_vina") < -0.1).alias("vina_improved"),
        F.count_if(F.col("delta_cnnaffinity") > 0.1).alias("affinity_improved"))
