"""Consensus parameter search and leave-one-target-out cross-validation.

Ranks do not depend on sigma or weights, so they are computed once. Every grid
point is then evaluated once per target into a metric table of
``targets x grid`` rows; each search and validation method is a small query on
that table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenmeld.catalog import SIGMA_FRACTION, score
from screenmeld.functions.grids import GridPoint
from screenmeld.operators import consensus as C
from screenmeld.operators.counting import (MOST_ACTIVES, MOST_POSES, counted_metrics, listed_metrics,
                                            most_actives)
from screenmeld.operators.evaluate import ranking_metrics
from screenmeld.session import stage, stage_if_large

METRICS = ("auc", "ef1", "ef5", "auprc")
POSES_PER_SLICE = 64
EVALUATIONS_PER_TASK = 20_000_000
VALUE_DIGITS = 12  # consensus sums that are equal on paper must tie
METRIC_DIGITS = 9


def grid_ligands(poses: DataFrame, scores: Sequence[str], grid: Sequence[GridPoint],
                 prof: C.Profile | None = None, ties: str = "min",
                 higher_is_better: Mapping[str, bool] | None = None) -> DataFrame:
    """Best consensus value per (target, gid, ligand) for every grid point.

    Poses are placed by (target, ligand, slice of 64 poses) before they are
    multiplied by the grid, so the maximum is complete inside a task and the
    shuffle moves poses, not poses x grid. Ligands with more poses than a slice
    are spread over several tasks and merged by a second, small aggregation,
    which is left out when no pose number reaches the slice size.
    """
    prof = prof or C.profile(poses, scores)
    ranked = C.rank_scores(poses, scores, ties, rows=prof.rows, higher_is_better=higher_is_better)
    ranked = prof.attach(ranked, prof.table.select("target", F.col("n").alias("_n")), ["target"])
    if "pose" in poses.columns:
        most = poses.agg(F.max("pose")).first()[0] or 0
        part = F.floor(F.col("pose") / POSES_PER_SLICE).cast("int")
    else:  # without numbers any deal of a ligand's poses will do
        most = POSES_PER_SLICE
        part = F.pmod(F.xxhash64(*[score(k).rank_column for k in scores]), F.lit(POSES_PER_SLICE)).cast("int")
    # a fixed number: the exploded size, not the shuffled one, decides the task count
    tasks = max(poses.sparkSession.sparkContext.defaultParallelism,
                ceil(prof.rows.total * len(grid) / EVALUATIONS_PER_TASK))
    placed = ranked.select("target", "ligand", "active", part.alias("_slice"), "_n",
                           *[score(k).rank_column for k in scores]).repartition(
        tasks, "target", "ligand", "_slice")
    sigmas: dict[int, list[GridPoint]] = {}
    for p in grid:
        sigmas.setdefault(p.sigma, []).append(p)
    by_sigma = F.array(*[
        F.struct(F.lit(float(s)).alias("_sigma"), F.array(*[
            F.struct(F.lit(p.gid).alias("gid"),
                     *[F.lit(float(w)).alias(f"_w_{k}") for k, w in zip(scores, p.weights)])
            for p in points]).alias("_points")) for s, points in sigmas.items()])
    terms = placed.select("*", F.inline(by_sigma)).select(
        "target", "ligand", "active", "_slice", "_points",
        *[C.term(F.col(score(k).rank_column), F.col("_n"), F.col("_sigma"))
          .alias(score(k).term_column) for k in scores])
    value = sum((F.col(f"_w_{k}") * F.col(score(k).term_column) for k in scores), F.lit(0.0))
    best = (terms.select("*", F.inline("_points"))
            .groupBy("target", "ligand", "_slice", "gid")
            .agg(F.max(value).alias("ecr"), F.max("active").alias("active")))
    if most >= POSES_PER_SLICE:
        best = best.groupBy("target", "ligand", "gid").agg(
            F.max("ecr").alias("ecr"), F.max("active").alias("active"))
    return best.select("target", "gid", "ligand", "active",
                       (-F.round("ecr", VALUE_DIGITS)).alias("key"))


def grid_metrics(poses: DataFrame, scores: Sequence[str], grid: Sequence[GridPoint],
                 prof: C.Profile | None = None, ties: str = "min") -> DataFrame:
    """AUC, EF1, EF5 and AUPRC per (target, gid).

    Decoys are counted between actives where a target has few of these. Otherwise a task evaluates one
    sigma on the listed ranks of a target, or, beyond what it can hold, the ligands of every grid point are ordered.
    """
    prof = prof or C.profile(poses, scores)
    few = most_actives(poses) <= MOST_ACTIVES
    if few or prof.rows.largest <= MOST_POSES:
        ranked = C.rank_scores(poses, scores, ties, rows=prof.rows)
        ranked = prof.attach(ranked, prof.table.select("target", F.col("n").alias("_n")), ["target"])
        names = [score(k).rank_column for k in scores]
        # read more than once below
        ranked = stage_if_large(ranked.select("target", "ligand", "active", "_n", *names), prof.rows.largest, "ranked")
        if few:
            return counted_metrics(ranked, names, grid)
        return listed_metrics(ranked, names, grid, prof.rows.total, prof.table.count())
    bound = prof.rows.times(len(grid))
    ligands = grid_ligands(poses, scores, grid, prof, ties)
    ligands = stage_if_large(ligands, prof.rows.largest, "grid")
    return ranking_metrics(ligands, ("target", "gid"), (0.01, 0.05), bound, prof.bounded)


def staged_grid_metrics(poses: DataFrame, scores: Sequence[str], grid: Sequence[GridPoint],
                        prof: C.Profile | None = None) -> DataFrame:
    """The metric table written once; all methods below read it several times."""
    return stage(grid_metrics(poses, scores, grid, prof), "grid-metrics")


def grid_table(metrics: DataFrame, scores: Sequence[str], grid: Sequence[GridPoint]) -> DataFrame:
    """Grid parameters (gid, kind, sigma, weights text and map), configuration-sized."""
    rows = [(p.gid, p.kind, p.sigma, p.text(scores),
             {score(k).label: float(w) for k, w in zip(scores, p.weights)}) for p in grid]
    return F.broadcast(metrics.sparkSession.createDataFrame(
        rows, "gid int, kind string, sigma int, weights string, weight_map map<string,double>"))


def _first_best(value: Column) -> Column:
    """gid with the largest value; the earlier grid entry wins ties."""
    return F.max_by("gid", F.struct(F.round(value, METRIC_DIGITS), -F.col("gid")))


def oracle_params(metrics: DataFrame, params: DataFrame, metric: str = "ef1") -> DataFrame:
    """Best grid point of each target on the target itself (an upper bound)."""
    usable = metrics.join(params.filter("kind = 'grid'"), "gid").filter(F.col(metric).isNotNull())
    return usable.groupBy("target").agg(_first_best(F.col(metric)).alias("gid"))


def _aggregate(values: Column, how: str) -> Column:
    if how == "median":
        return F.percentile(values, 0.5)
    if how == "mean":
        return F.avg(values)
    raise ValueError(f"unknown aggregation {how!r}")


def global_params(metrics: DataFrame, params: DataFrame, metric: str = "ef1",
                  how: str = "median", kind: str = "grid") -> DataFrame:
    """One row: the grid point with the best aggregate over all targets."""
    usable = metrics.join(params.filter(F.col("kind") == kind), "gid").filter(
        F.col(metric).isNotNull())
    each = usable.groupBy("gid").agg(_aggregate(F.col(metric), how).alias("_v"))
    return each.agg(_first_best(F.col("_v")).alias("gid")).filter("gid IS NOT NULL")


def leave_one_out(metrics: DataFrame, metric: str = "ef1", how: str = "median") -> DataFrame:
    """(test_target, gid, value): aggregate of the metric over all other targets.

    Dropping one of n sorted values only shifts the positions behind it, so the
    median of the rest follows from the row's own position and the values next
    to the middle. No pairs of targets are formed. Windows hold one row per
    target.
    """
    alone = Window.partitionBy("gid")
    v = F.col(metric)
    if how == "mean":
        n, total = F.count(v).over(alone), F.sum(v).over(alone)
        rest = n - v.isNotNull().cast("int")
        value = (total - F.coalesce(v, F.lit(0.0))) / F.when(rest > 0, rest)
        return metrics.select(F.col("target").alias("test_target"), "gid", value.alias("value"))
    if how != "median":
        raise ValueError(f"unknown aggregation {how!r}")
    placed = metrics.select(
        "target", "gid", v.alias("_v"), F.count(v).over(alone).alias("_n"),
        F.row_number().over(alone.orderBy(v.asc_nulls_last(), "target")).alias("_r"))
    known = F.col("_v").isNotNull()
    # position of the row among the values; a row without value drops nothing
    own = F.when(known, F.col("_r")).otherwise(F.col("_n") + 1)
    rest = F.when(known, F.col("_n") - 1).otherwise(F.col("_n"))
    spots = placed.select("*", own.alias("_own"), rest.alias("_m"))

    def at(position: Column) -> Column:
        return F.max(F.when(known & (F.col("_r") == position), F.col("_v"))).over(alone)

    # middle positions of n - 1 and of n values, each also one further
    n = F.col("_n")
    stats = spots.select(
        "*", *[at(F.expr(f"({m} + 1) div 2") + shift).alias(f"_lo{i}{shift}")
               for i, m in enumerate(("(_n - 1)", "_n")) for shift in (0, 1)],
        *[at(F.expr(f"({m} + 2) div 2") + shift).alias(f"_hi{i}{shift}")
          for i, m in enumerate(("(_n - 1)", "_n")) for shift in (0, 1)])

    def middle(side: str) -> Column:
        expr = "(_m + 1) div 2" if side == "lo" else "(_m + 2) div 2"
        behind = F.expr(expr) >= F.col("_own")
        which = F.col("_m") == n
        return (F.when(which, F.when(behind, F.col(f"_{side}11")).otherwise(F.col(f"_{side}10")))
                .otherwise(F.when(behind, F.col(f"_{side}01")).otherwise(F.col(f"_{side}00"))))

    value = F.when(F.col("_m") > 0, (middle("lo") + middle("hi")) / 2.0)
    return stats.select(F.col("target").alias("test_target"), "gid", value.alias("value"))


def loo_params(metrics: DataFrame, params: DataFrame, metric: str = "ef1", how: str = "median",
               kind: str = "grid") -> DataFrame:
    """Per held-out target, the grid point that is best on the other targets."""
    chosen = metrics.join(params.filter(F.col("kind") == kind).select("gid"), "gid")
    rest = leave_one_out(chosen, metric, how).filter("value IS NOT NULL")
    return (rest.groupBy("test_target").agg(_first_best(F.col("value")).alias("gid"))
            .withColumnRenamed("test_target", "target"))


def _method(picked: DataFrame, metrics: DataFrame, params: DataFrame, name: str) -> DataFrame:
    return (picked.join(metrics, ["target", "gid"]).join(params, "gid")
            .select("target", F.lit(name).alias("method"), "sigma", "weights", *METRICS))


def single_score_baselines(poses: DataFrame, scores: Sequence[str], prof: C.Profile,
                           higher_is_better: Mapping[str, bool] | None = None) -> DataFrame:
    """Each score alone, on pose 1 and on the best pose of a ligand."""
    higher = higher_is_better or {}

    def keyed(k: str) -> Column:
        col = F.col(score(k).column)
        return -col if higher.get(k, False) else col + F.lit(0.0)

    # one aggregate per ligand, whose few values become rows behind it
    kinds = {"(Best Pose)": F.lit(True), "(Pose 1)": F.col("pose") == 1}
    each = [(f"{score(k).label} {kind}", F.when(chosen & keyed(k).isNotNull(), keyed(k)))
            for k in scores for kind, chosen in kinds.items()]
    wide = poses.groupBy("ligand", "target").agg(*[x for i, (_, key) in enumerate(each) for x in (
        F.min(key).alias(f"_key{i}"), F.max(F.when(key.isNotNull(), F.col("active"))).alias(f"_active{i}"))])
    best = wide.select("target", "ligand", F.inline(F.array(*[
        F.struct(F.lit(name).alias("method"), F.col(f"_key{i}").alias("key"), F.col(f"_active{i}").alias("active"))
        for i, (name, _) in enumerate(each)]))).filter("key IS NOT NULL")
    out = ranking_metrics(best.select("target", "method", "ligand", "active", "key"),
                          ("target", "method"), (0.01, 0.05), prof.rows.times(2 * len(scores)),
                          prof.bounded)
    none = F.lit(None)
    return out.select("target", "method", none.cast("int").alias("sigma"),
                      none.cast("string").alias("weights"), *METRICS)


def cross_validation(poses: DataFrame, scores: Sequence[str], grid: Sequence[GridPoint],
                     metric: str = "ef1", how: str = "median",
                     prof: C.Profile | None = None) -> DataFrame:
    """One row per fold and method with the four metrics on the held-out target."""
    prof = prof or C.profile(poses, scores)
    if prof.bounded and prof.table.count() < 3:
        raise ValueError("leave-one-target-out needs at least 3 targets")
    metrics = staged_grid_metrics(poses, scores, grid, prof)
    params = grid_table(metrics, scores, grid)
    targets = metrics.select("target").distinct()
    default = next(p.gid for p in grid if p.kind == "equal" and p.sigma == SIGMA_FRACTION)
    fixed = targets.select("target", F.lit(default).alias("gid"))
    equal_cv = targets.join(loo_params(metrics, params, metric, how, "equal"), "target", "left")
    equal_cv = equal_cv.select("target", F.coalesce("gid", F.lit(default)).alias("gid"))
    best = global_params(metrics, params, metric, how)
    overall = metrics.join(F.broadcast(best), "gid").select("target", "gid")  # best: one row
    parts = [
        single_score_baselines(poses, scores, prof),
        _method(fixed, metrics, params, "ECR Equal"),
        _method(equal_cv, metrics, params, "ECR Equal (CV)"),
        _method(oracle_params(metrics, params, metric), metrics, params, "ECR Oracle"),
        _method(loo_params(metrics, params, metric, how), metrics, params, "ECR LOO-CV"),
        _method(overall, metrics, params, "ECR Global"),
    ]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    folds = targets.select("target", F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy("target")).alias("fold"))  # one row per target
    return rows.join(F.broadcast(folds) if prof.bounded else folds, "target").select(
        "fold", F.col("target").alias("test_target"), "method", "sigma", "weights", *METRICS)


# --- tables over the fold results; all inputs have one row per fold and method ---

def method_summary(results: DataFrame, metric: str = "ef1") -> DataFrame:
    return (results.filter(F.col(metric).isNotNull()).groupBy("method")
            .agg(F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("std"),
                 F.count(F.lit(1)).alias("n")))


def best_single(summary: DataFrame) -> DataFrame:
    """Best mean among the single scores, for pose 1 and for the best pose."""
    kind = F.regexp_extract("method", r"\((Pose 1|Best Pose)\)$", 1)
    return (summary.select(kind.alias("kind"), "method", "mean").filter("kind <> ''")
            .groupBy("kind").agg(F.max("mean").alias("mean"),
                                 F.max_by("method", F.struct("mean", "method")).alias("method")))


def method_table(results: DataFrame, methods: Sequence[str], metric: str = "ef1") -> DataFrame:
    """Folds by methods for one metric."""
    return results.groupBy("test_target").pivot("method", list(methods)).agg(F.first(metric))


def fold_gaps(results: DataFrame, metric: str = "ef1") -> DataFrame:
    """Oracle minus leave-one-out and leave-one-out minus equal, per fold."""
    wide = method_table(results, ["ECR Equal", "ECR LOO-CV", "ECR Oracle"], metric)
    loo, oracle, equal = (F.col(f"`{m}`") for m in ("ECR LOO-CV", "ECR Oracle", "ECR Equal"))
    return wide.select("test_target", equal.alias("equal"), loo.alias("loo"),
                       oracle.alias("oracle"), (oracle - loo).alias("gap"),
                       (loo - equal).alias("gain"))


def generalisation_gap(results: DataFrame, metric: str = "ef1") -> DataFrame:
    """Mean gap to the oracle, effects of sigma and weights, verdict."""
    mean = lambda m: F.avg(F.when(F.col("method") == m, F.col(metric)))
    means = results.agg(mean("ECR LOO-CV").alias("loo"), mean("ECR Oracle").alias("oracle"),
                        mean("ECR Equal").alias("equal"), mean("ECR Equal (CV)").alias("equal_cv"))
    gap = F.col("oracle") - F.col("loo")
    pct = F.when(F.col("oracle") > 0, gap / F.col("oracle") * 100.0).otherwise(F.lit(0.0))
    verdict = (F.when(pct < 10, "generalises well").when(pct < 25, "moderate gap")
               .otherwise("large gap"))
    return means.select("*", gap.alias("gap"), pct.alias("gap_pct"),
                        (F.col("equal_cv") - F.col("equal")).alias("sigma_effect"),
                        (F.col("loo") - F.col("equal_cv")).alias("weight_effect"),
                        (F.col("loo") - F.col("equal")).alias("total_effect"),
                        verdict.alias("verdict"))


def sigma_distribution(results: DataFrame, method: str = "ECR LOO-CV") -> DataFrame:
    counts = (results.filter((F.col("method") == method) & F.col("sigma").isNotNull())
              .groupBy("sigma").agg(F.count(F.lit(1)).alias("folds")))
    share = F.col("folds") * 100.0 / F.sum("folds").over(Window.partitionBy(F.lit(0)))
    return counts.select("sigma", "folds", share.alias("share_pct"))


def sigma_stability(results: DataFrame, method: str = "ECR LOO-CV") -> DataFrame:
    """Spread of the chosen sigma over folds and how many agree on the mode."""
    rows = results.filter((F.col("method") == method) & F.col("sigma").isNotNull())
    spread = rows.agg(
        F.count(F.lit(1)).alias("folds"), F.percentile("sigma", 0.5).cast("int").alias("median"),
        F.avg("sigma").alias("mean"), F.stddev_pop("sigma").alias("std"),
        F.min("sigma").alias("min"), F.max("sigma").alias("max"), F.lit(0).alias("_k"))
    mode = sigma_distribution(results, method).agg(
        F.max_by(F.struct("sigma", "share_pct"), F.struct("folds", -F.col("sigma"))).alias("m"),
        F.lit(0).alias("_k"))
    pct = F.col("m.share_pct")
    verdict = F.when(pct >= 70, "stable").when(pct >= 40, "moderately stable").otherwise("unstable")
    return spread.join(mode, "_k").select(
        "folds", "median", "mean", "std", "min", "max", F.col("m.sigma").alias("mode"),
        pct.alias("mode_pct"), verdict.alias("verdict"))


def weights_long(results: DataFrame, method: str = "ECR LOO-CV") -> DataFrame:
    """Rendered weights back to rows (test_target, label, weight)."""
    picked = results.filter((F.col("method") == method) & F.col("weights").isNotNull())
    pairs = F.split("weights", "/")
    return (picked.select("test_target", F.explode(pairs).alias("p"))
            .select("test_target", F.element_at(F.split("p", "="), 1).alias("label"),
                    F.element_at(F.split("p", "="), 2).cast("double").alias("weight")))


def weight_stability(results: DataFrame, method: str = "ECR LOO-CV") -> DataFrame:
    """Spread of each weight over folds; ``removable`` marks mostly zero weights."""
    part = weights_long(results, method).groupBy("label").agg(
        F.percentile("weight", 0.5).alias("median"), F.avg("weight").alias("mean"),
        F.stddev_pop("weight").alias("std"), F.min("weight").alias("min"),
        F.max("weight").alias("max"),
        (F.count_if(F.col("weight") == 0) * 100.0 / F.count(F.lit(1))).alias("zero_pct"))
    return part.select("*", (F.col("zero_pct") >= 80).alias("removable"))


def weight_verdict(stability: DataFrame) -> DataFrame:
    part = stability.agg(F.avg("std").alias("mean_std"),
                         F.count_if(F.col("std") < 0.15).alias("consistent"),
                         F.count(F.lit(1)).alias("scores"),
                         F.count_if("removable").alias("removable"))
    verdict = (F.when(F.col("mean_std") < 0.10, "stable")
               .when(F.col("mean_std") < 0.20, "moderately stable").otherwise("unstable"))
    return part.select("*", verdict.alias("verdict"))


def global_agreement(results: DataFrame) -> DataFrame:
    """Global parameters against the folds: equal sigmas, distance of weights."""
    first = results.filter(F.col("method") == "ECR Global").orderBy("fold").limit(1)
    chosen = first.select("sigma", F.lit(0).alias("_k"))
    folds = results.filter(F.col("method") == "ECR LOO-CV").select(
        F.col("sigma").alias("fold_sigma"), F.lit(0).alias("_k"))
    agree = (folds.join(F.broadcast(chosen), "_k").groupBy("_k").agg(
        F.first("sigma").alias("global_sigma"), F.count(F.lit(1)).alias("folds"),
        F.count_if(F.col("sigma") == F.col("fold_sigma")).alias("agreeing")))
    medians = weight_stability(results).select("label", "median")
    first_weights = weights_long(first, "ECR Global").select(
        "label", F.col("weight").alias("global_weight"))
    distance = (medians.join(first_weights, "label", "left").agg(
        F.sqrt(F.sum(F.pow(F.coalesce("global_weight", F.lit(0.0)) - F.col("median"), 2)))
        .alias("distance"), F.lit(0).alias("_k")))
    verdict = (F.when(F.col("distance") < 0.10, "good").when(F.col("distance") < 0.25, "moderate")
               .otherwise("poor"))
    return agree.join(distance, "_k").select("global_sigma", "folds", "agreeing", "distance",
                                             verdict.alias("agreement"))


def recommendation(results: DataFrame, metric: str = "ef1") -> DataFrame:
    """Global parameters, their optimistic and the honest mean, removable scores."""
    first = results.filter(F.col("method") == "ECR Global").orderBy("fold").limit(1).select(
        "sigma", "weights", F.lit(0).alias("_k"))
    means = results.agg(
        F.avg(F.when(F.col("method") == "ECR Global", F.col(metric))).alias("optimistic_mean"),
        F.avg(F.when(F.col("method") == "ECR LOO-CV", F.col(metric))).alias("honest_mean"),
        F.lit(0).alias("_k"))
    removable = weight_stability(results).agg(
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("removable"), F.col("label")))), ", ")
        .alias("removable"), F.lit(0).alias("_k"))
    return first.join(means, "_k").join(removable, "_k").drop("_k")
