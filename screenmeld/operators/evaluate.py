"""Quality of a ranking against labels: curves, scalars, separation, tables.

All operators take long rows ``(group..., ligand, active, key)`` where a smaller
``key`` is better; :func:`labelled` makes them from wide score columns. Every
target and score is evaluated in the same job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenmeld.catalog import EF_FRACTIONS
from screenmeld.functions.numbers import fixed
from screenmeld.functions.stats import kolmogorov_p
from screenmeld.operators.ordering import (Rows, bound_of, cumulate, dealt_in_cells, exact_quantiles, rank_rows,
                                           with_totals)
from screenmeld.session import rows_per_task, stage

GROUP = ("target", "score")


def label_from_name(ligand: Column) -> Column:
    """1 for names ending in ``_a``, 0 for ``_d``, otherwise unknown."""
    return (F.when(ligand.endswith("_a"), F.lit(1)).when(ligand.endswith("_d"), F.lit(0)))


def with_labels(df: DataFrame) -> DataFrame:
    """Derive ``active`` where the table lacks it and drop unlabelled rows then."""
    if "active" in df.columns:
        return df
    return df.withColumn("active", label_from_name(F.col("ligand"))).filter("active IS NOT NULL")


def labelled(df: DataFrame, columns: Mapping[str, bool], target: str = "target") -> DataFrame:
    """Long rows of the named columns; the flag says whether larger is better."""
    def signed(name: str, higher: bool) -> Column:
        value = F.col(name).cast("double")
        return -value if higher else value + F.lit(0.0)

    entries = F.array(*[F.struct(F.lit(c).alias("score"), signed(c, h).alias("key"))
                        for c, h in columns.items()])
    long = df.select(target, "ligand", "active", F.explode(entries).alias("e"))
    bad = F.isnan("e.key") | (F.abs(F.col("e.key")) == float("inf"))
    return (long.filter(F.col("e.key").isNotNull() & ~bad)
            .select(target, "e.score", "ligand", "active", "e.key"))


def _ratio(top: Column, bottom: Column) -> Column:
    return top / F.when(bottom != 0, bottom)


def auc_and_ap(df: DataFrame, group: Sequence[str] = GROUP, rows: Rows = None,
               weight: Column | None = None) -> DataFrame:
    """ROC AUC with ties counted half and average precision over thresholds.

    With running counts that include equal keys, sums over decoys of actives
    at least as good, and over actives of decoys at least as good, give
    ``AUC = (A - B + P*N) / (2*P*N)``. NULL if a class is missing.
    """
    w = F.lit(1).cast("long") if weight is None else weight.cast("long")
    run = cumulate(df.withColumn("_w", w), group, ["key"],
                   {"_tp": F.col("_w") * F.col("active"), "_n": F.col("_w")}, rows)
    is_active = F.col("active") == 1
    part = run.groupBy(*group).agg(
        F.sum(F.when(is_active, F.col("_w")).otherwise(0)).alias("actives"),
        F.sum(F.when(is_active, 0).otherwise(F.col("_w"))).alias("decoys"),
        F.sum(F.when(~is_active, F.col("_w") * F.col("_tp")).otherwise(0).cast("double"))
        .alias("_a"),
        F.sum(F.when(is_active, F.col("_w") * (F.col("_n") - F.col("_tp"))).otherwise(0)
              .cast("double")).alias("_b"),
        F.sum(F.when(is_active & (F.col("_w") > 0),
                     F.col("_w") * F.col("_tp") / F.col("_n")).otherwise(0.0)).alias("_p"))
    pairs = F.col("actives").cast("double") * F.col("decoys")
    return part.select(
        *group, "actives", "decoys",
        _ratio(F.col("_a") - F.col("_b") + pairs, pairs * 2.0).alias("auc"),
        F.when(pairs > 0, F.col("_p") / F.col("actives")).alias("auprc"))


def ef_name(fraction: float) -> str:
    return f"ef{int(round(fraction * 100))}"


def enrichment(df: DataFrame, group: Sequence[str] = GROUP,
               fractions: Sequence[float] = EF_FRACTIONS, rows: Rows = None,
               bounded: bool = False) -> DataFrame:
    """Enrichment factors: hits among the best ``max(1, ceil(f*n))`` over ``f * actives``."""
    numbered = rank_rows(df, group, ["key", "ligand"], "_r", "first", rows)
    sized = with_totals(numbered, group, {"_n": F.lit(1), "_pos": F.col("active")}, rows, bounded)
    return _enrichment_of(sized, group, fractions)


def _quota(fraction: float) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.col("_n") * F.lit(float(fraction))))


def _enrichment_of(sized: DataFrame, group: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    hits = [F.sum(F.when(F.col("_r") <= _quota(f), F.col("active")).otherwise(0)).alias(f"_h{i}")
            for i, f in enumerate(fractions)]
    part = sized.groupBy(*group).agg(F.max("_pos").alias("_pos"), *hits)
    return part.select(*group, *[
        _ratio(F.col(f"_h{i}").cast("double"), F.col("_pos") * F.lit(float(f))).alias(ef_name(f))
        for i, f in enumerate(fractions)])


def _placed(df: DataFrame, group: Sequence[str], rows: Rows, bounded: bool) -> DataFrame:
    """Rows with their rank, the actives and rows up to their key, and the rows and actives of the group."""
    rows, hit = bound_of(df, rows), F.col("active").cast("long")
    if rows.largest > rows_per_task(df.sparkSession):
        df = stage(df, "ordered")
        dealt = dealt_in_cells(df, df, group, "key", rows, {"hits": hit})
        if dealt is not None:
            along = Window.partitionBy("_cell", *group).orderBy("key", "ligand")
            ties = Window.partitionBy("_cell", *group).orderBy("key")  # its frame takes in all equal keys
            return dealt.select(
                *df.columns, (F.col("_before") + F.row_number().over(along)).alias("_r"),
                (F.col("_before_hits") + F.coalesce(F.sum(hit).over(ties), F.lit(0))).alias("_tp"),
                (F.col("_before") + F.count(F.lit(1)).over(ties)).alias("_upto"),
                F.col("_all").alias("_n"), F.col("_all_hits").alias("_pos"))
    numbered = rank_rows(df, group, ["key", "ligand"], "_r", "first", rows, staged=True)
    run = cumulate(numbered, group, ["key"], {"_tp": hit, "_upto": F.lit(1).cast("long")}, rows)
    return with_totals(run, group, {"_n": F.lit(1), "_pos": F.col("active")}, rows, bounded)


def ranking_metrics(df: DataFrame, group: Sequence[str] = GROUP,
                    fractions: Sequence[float] = (0.01, 0.05), rows: Rows = None,
                    bounded: bool = False) -> DataFrame:
    """AUC, average precision and enrichment from one ordering of each group.

    The ranking by (key, ligand) also serves the running counts by key, so a
    group is shuffled and sorted once for all metrics.
    """
    sized = _placed(df, group, rows, bounded)
    is_active = F.col("active") == 1
    hits = [F.sum(F.when(F.col("_r") <= _quota(f), F.col("active")).otherwise(0)).alias(f"_h{i}")
            for i, f in enumerate(fractions)]
    part = sized.groupBy(*group).agg(
        F.max("_pos").alias("_pos"), F.max("_n").alias("_n"),
        F.sum(F.when(~is_active, F.col("_tp")).otherwise(0)).cast("double").alias("_a"),
        F.sum(F.when(is_active, F.col("_upto") - F.col("_tp")).otherwise(0)).cast("double")
        .alias("_b"),
        F.sum(F.when(is_active, F.col("_tp") / F.col("_upto")).otherwise(0.0)).alias("_p"), *hits)
    pairs = F.col("_pos").cast("double") * (F.col("_n") - F.col("_pos"))
    return part.select(
        *group,
        _ratio(F.col("_a") - F.col("_b") + pairs, pairs * 2.0).alias("auc"),
        F.when(pairs > 0, F.col("_p") / F.col("_pos")).alias("auprc"),
        *[_ratio(F.col(f"_h{i}").cast("double"), F.col("_pos") * F.lit(float(f))).alias(ef_name(f))
          for i, f in enumerate(fractions)])


def thresholds(df: DataFrame, group: Sequence[str] = GROUP, rows: Rows = None) -> DataFrame:
    """One row per distinct key: counts there (tp, fp) and up to it (ctp, cfp)."""
    counts = df.groupBy(*group, "key").agg(
        F.sum("active").alias("tp"), F.sum(1 - F.col("active")).alias("fp"))
    return cumulate(counts, group, ["key"], {"ctp": F.col("tp"), "cfp": F.col("fp")}, rows)


def curves(df: DataFrame, group: Sequence[str] = GROUP, rows: Rows = None,
           bounded: bool = False) -> DataFrame:
    """ROC and PR points per distinct key: tpr, fpr, precision, recall."""
    steps = thresholds(df, group, rows)
    sized = with_totals(steps, group, {"_p": F.col("tp"), "_q": F.col("fp")}, rows, bounded)
    return sized.select(
        *group, "key", "ctp", "cfp",
        _ratio(F.col("ctp").cast("double"), F.col("_p")).alias("tpr"),
        _ratio(F.col("cfp").cast("double"), F.col("_q")).alias("fpr"),
        (F.col("ctp") / (F.col("ctp") + F.col("cfp"))).alias("precision"),
        _ratio(F.col("ctp").cast("double"), F.col("_p")).alias("recall"))


def class_balance(df: DataFrame, target: str = "target") -> DataFrame:
    """Ligands, actives, decoys, ratio ``1:k`` and share of actives."""
    actives = F.sum(F.when(F.col("active") == 1, 1).otherwise(0))
    decoys = F.sum(F.when(F.col("active") == 0, 1).otherwise(0))
    part = df.groupBy(target).agg(F.count(F.lit(1)).alias("ligands"), actives.alias("actives"),
                                  decoys.alias("decoys"))
    return part.select(
        target, "ligands", "actives", "decoys",
        F.concat(F.lit("1:"), F.expr("decoys div greatest(1, actives)").cast("string"))
        .alias("ratio"),
        (F.col("actives") * 100.0 / F.col("ligands")).alias("active_pct"),
        (F.col("actives") / F.col("ligands")).alias("auprc_baseline"))


def class_stats(df: DataFrame, group: Sequence[str] = GROUP, rows: Rows = None) -> DataFrame:
    """n, mean, sample std, median, min, max of the stored values per class."""
    keys = [*group, "active"]
    basic = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg("key").alias("mean"),
        F.stddev_samp("key").alias("std"), F.min("key").alias("min"), F.max("key").alias("max"))
    median = exact_quantiles(df, keys, "key", [0.5], rows).select(
        *keys, F.col("value").alias("median"))
    return basic.join(median, keys)


def cohens_d(df: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Standardised class difference; positive means that actives are better."""
    pos, neg = F.col("active") == 1, F.col("active") == 0
    part = df.groupBy(*group).agg(
        F.count_if(pos).alias("n_a"), F.count_if(neg).alias("n_d"),
        F.avg(F.when(pos, F.col("key"))).alias("m_a"), F.avg(F.when(neg, F.col("key"))).alias("m_d"),
        F.var_samp(F.when(pos, F.col("key"))).alias("v_a"),
        F.var_samp(F.when(neg, F.col("key"))).alias("v_d"))
    pooled = F.sqrt(((F.col("n_a") - 1) * F.col("v_a") + (F.col("n_d") - 1) * F.col("v_d"))
                    / (F.col("n_a") + F.col("n_d") - 2))
    enough = (F.col("n_a") >= 2) & (F.col("n_d") >= 2)
    value = F.when(enough, (F.col("m_d") - F.col("m_a")) / F.when(pooled != 0, pooled))
    return part.select(*group, "n_a", "n_d", value.alias("cohens_d"))


def ks_statistic(df: DataFrame, group: Sequence[str] = GROUP, rows: Rows = None,
                 bounded: bool = False) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance with its limiting p-value."""
    points = curves(df, group, rows, bounded)
    part = points.groupBy(*group).agg(
        F.max("ctp").alias("n_a"), F.max("cfp").alias("n_d"),
        F.max(F.abs(F.col("tpr") - F.col("fpr"))).alias("_d"))
    enough = (F.col("n_a") >= 2) & (F.col("n_d") >= 2)
    stat = F.when(enough, F.col("_d"))
    return part.select(*group, stat.alias("ks_stat"), F.when(
        enough, kolmogorov_p(F.col("_d"), F.col("n_a"), F.col("n_d"))).alias("ks_p"))


def histogram(df: DataFrame, group: Sequence[str] = GROUP, edges: int = 45,
              rows: Rows = None, bounded: bool = False) -> DataFrame:
    """Class densities between the 1 % and 99 % quantiles in ``edges - 1`` bins."""
    q = exact_quantiles(df, group, "key", [0.01, 0.99], rows)
    span = q.groupBy(*group).agg(F.max(F.when(F.col("p") < 0.5, F.col("value"))).alias("lo"),
                                 F.max(F.when(F.col("p") > 0.5, F.col("value"))).alias("hi"))
    joined = df.join(F.broadcast(span) if bounded else span, list(group)).filter(
        (F.col("key") >= F.col("lo")) & (F.col("key") <= F.col("hi")) & (F.col("hi") > F.col("lo")))
    bins = edges - 1
    slot = F.least(F.floor((F.col("key") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins),
                   F.lit(bins - 1)).cast("int")
    counts = joined.groupBy(*group, "lo", "hi", "active", slot.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy(*group, "active")  # at most edges - 1 rows
    width = (F.col("hi") - F.col("lo")) / bins
    return counts.select(*group, "active", "bin", "n",
                         (F.col("lo") + F.col("bin") * width).alias("left_edge"),
                         (F.col("n") / (F.sum("n").over(inside) * width)).alias("density"))


def direction_selftest(aucs: DataFrame, score: str = "score", min_targets: int = 3) -> DataFrame:
    """Scores whose median AUC over targets says that the direction is flipped.

    Rows are one per target and score, so the exact median stays small.
    """
    part = aucs.filter("auc IS NOT NULL").groupBy(score).agg(
        F.count(F.lit(1)).alias("targets"), F.percentile("auc", 0.5).alias("median_auc"),
        F.count_if(F.col("auc") < 0.5).alias("below_half"))
    return part.select(
        score, "targets", "median_auc", "below_half", (1.0 - F.col("median_auc")).alias("mirrored"),
        ((F.col("targets") >= min_targets) & (F.col("median_auc") < 0.5)).alias("suspect"))


def compare_scores(metrics: DataFrame, scores: Sequence[str], value: str) -> DataFrame:
    """Targets by scores: one column per score for the given metric."""
    return (metrics.groupBy("target").pivot("score", list(scores)).agg(F.first(value)))


def with_ci(value: Column, lo: Column, hi: Column, digits: int = 4) -> Column:
    """``value [lo–hi]`` with fixed digits, ``N/A`` for a missing value."""
    text = fixed(value, digits)
    band = F.concat(F.lit(" ["), fixed(lo, digits), F.lit("–"), fixed(hi, digits), F.lit("]"))
    return F.when(value.isNull(), "N/A").when(lo.isNull(), text).otherwise(F.concat(text, band))


def dataset_text(ligands: DataFrame) -> DataFrame:
    """(target, text): ligands, actives, decoys, their ratio and the share of actives."""
    part = ligands.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.sum("active").alias("a"), F.sum(1 - F.col("active")).alias("d"))
    ratio = F.floor(F.col("d") / F.greatest(F.lit(1), F.col("a")))
    return part.select("target", F.concat(
        F.col("n").cast("string"), F.lit(" ligands, "), F.col("a").cast("string"), F.lit(" actives, "), F.col("d").cast("string"),
        F.lit(" decoys, 1:"), ratio.cast("string"), F.lit(", "), fixed(F.col("a") * 100.0 / F.col("n"), 2), F.lit(" %")).alias("text"))


def signed(value: Column, digits: int = 4) -> Column:
    """Number with fixed digits and its sign, ``n/a`` for a missing value."""
    return F.coalesce(F.concat(F.when(value >= 0, "+").otherwise(""), fixed(value, digits)), F.lit("n/a"))


def full_report(values: DataFrame, intervals: DataFrame, ligands: DataFrame, metrics: Sequence[str],
                separation: DataFrame | None = None, correlations: DataFrame | None = None) -> DataFrame:
    """(target, score, section, text) of every section of the report.

    Each metric of each score with its interval; the data set of each target (score ``''``); how far classes lie
    apart by ``separation`` (target, score, cohens_d, ks_stat); and ``correlations`` (target, subset, score_x, score_y, n, pearson) of
    pairs of scores, named ``x ~ y``, among all ligands and among actives.
    """
    entries = F.array(*[F.struct(F.lit(m).alias("section"), F.col(m).alias("value")) for m in metrics])
    each = values.select("target", "score", F.inline(entries)).filter(F.col("value").isNotNull())
    named = intervals.select("target", "score", F.col("metric").alias("section"), "lo", "hi")
    rows = each.join(named, ["target", "score", "section"], "left").select(
        "target", "score", "section", with_ci(F.col("value"), F.col("lo"), F.col("hi")).alias("text"))
    rows = rows.unionByName(dataset_text(ligands).select(
        "target", F.lit("").alias("score"), F.lit("dataset").alias("section"), "text"))
    if separation is not None:
        rows = rows.unionByName(separation.select("target", "score", F.lit("separation").alias("section"), F.concat(
            F.lit("d "), signed(F.col("cohens_d")), F.lit(", KS "), F.coalesce(fixed(F.col("ks_stat"), 4), F.lit("n/a"))).alias("text")))
    if correlations is not None:
        few = F.concat(F.lit("too few (n="), F.col("n").cast("string"), F.lit(")"))
        text = F.concat(signed(F.col("pearson")), F.lit(" (n="), F.col("n").cast("string"), F.lit(")"))
        rows = rows.unionByName(correlations.select(
            "target", F.concat_ws(" ~ ", "score_x", "score_y").alias("score"),
            F.concat(F.lit("correlation, "), "subset").alias("section"), F.when(F.col("n") < 3, few).otherwise(text).alias("text")))
    return rows


def weighted_metrics(df: DataFrame, group: Sequence[str] = GROUP,
                     fractions: Sequence[float] = EF_FRACTIONS, rows: Rows = None,
                     bounded: bool = False, weight: str = "weight") -> DataFrame:
    """:func:`ranking_metrics` for rows that stand for ``weight`` equal rows each."""
    w = F.col(weight).cast("long")
    placed = cumulate(df, group, ["key", "ligand"], {"_pos": w}, rows)
    run = cumulate(placed, group, ["key"], {"_tp": w * F.col("active"), "_upto": w}, rows)
    sized = with_totals(run, group, {"_n": w, "_act": w * F.col("active")}, rows, bounded)
    is_active = F.col("active") == 1
    before = F.col("_pos") - w
    hits = [F.sum(F.when(is_active, F.greatest(F.lit(0), F.least(w, _quota(f) - before)))
                  .otherwise(0)).alias(f"_h{i}") for i, f in enumerate(fractions)]
    part = sized.groupBy(*group).agg(
        F.max("_act").alias("_act"), F.max("_n").alias("_n"),
        F.sum(F.when(~is_active, (w * F.col("_tp")).cast("double")).otherwise(0.0)).alias("_a"),
        F.sum(F.when(is_active, (w * (F.col("_upto") - F.col("_tp"))).cast("double"))
              .otherwise(0.0)).alias("_b"),
        F.sum(F.when(is_active, w * F.col("_tp") / F.col("_upto")).otherwise(0.0)).alias("_p"),
        *hits)
    pairs = F.col("_act").cast("double") * (F.col("_n") - F.col("_act"))
    return part.select(
        *group, _ratio(F.col("_a") - F.col("_b") + pairs, pairs * 2.0).alias("auc"),
        F.when(pairs > 0, F.col("_p") / F.col("_act")).alias("auprc"),
        *[_ratio(F.col(f"_h{i}").cast("double"), F.col("_act") * F.lit(float(f))).alias(ef_name(f))
          for i, f in enumerate(fractions)])
