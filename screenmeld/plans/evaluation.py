"""Queries: ranking quality against labels and agreement between scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenmeld.operators import consensus as C
from screenmeld.operators import correlate as R
from screenmeld.operators import evaluate as E
from screenmeld.plans.fixtures import POSE1, SCORES, poses
from screenmeld.plans.ranking import rounded
from screenmeld.plans.registry import query

COLUMNS = [f"score_{s}" for s in SCORES]
DIRECTIONS = {**{c: False for c in COLUMNS}, "ecr_total": True}


def evaluated(spark, sf):
    """Pose 1 of each ligand with its consensus over pose-1 rows (competition ranks)."""
    first = poses(spark, sf).filter("pose = 1")
    prof = C.profile(first, SCORES)
    posed = C.consensus_poses(C.rank_scores(first, SCORES, "min", rows=prof.rows), SCORES, prof)
    return posed.withColumn("ecr_total", F.round("ecr_total", 12)), prof


def long_rows(spark, sf):
    wide, prof = evaluated(spark, sf)
    return E.labelled(wide, DIRECTIONS), prof.rows.times(len(DIRECTIONS)), prof.bounded


def _long_sql() -> str:
    ranks = ", ".join(
        f"CASE WHEN score_{s} IS NOT NULL THEN rank() OVER (PARTITION BY target ORDER BY score_{s}"
        f" ASC NULLS LAST) END AS rank_{s}" for s in SCORES)
    total = " + ".join(
        f"CAST(1.0/3 AS DOUBLE) * coalesce(exp(-rank_{s} / greatest(CAST(n AS DOUBLE) / 4.0, 1.0)),"
        " 0.0)" for s in SCORES)
    parts = " UNION ALL ".join(
        [f"SELECT target, '{c}' AS score, ligand, active, {c} AS key FROM e1 WHERE {c} IS NOT NULL"
         for c in COLUMNS]
        + ["SELECT target, 'ecr_total' AS score, ligand, active, -ecr_total AS key FROM e1"])
    return f"""WITH {POSE1},
r1 AS (SELECT *, {ranks}, count(*) OVER (PARTITION BY target) AS n FROM pose1),
e1 AS (SELECT *, round({total}, 12) AS ecr_total FROM r1),
long AS ({parts}),
steps AS (SELECT target, score, key, CAST(sum(active) AS DOUBLE) AS tp,
  CAST(sum(1 - active) AS DOUBLE) AS fp FROM long GROUP BY ALL),
cum AS (SELECT *, sum(tp) OVER w AS ctp, sum(fp) OVER w AS cfp,
  sum(tp) OVER (PARTITION BY target, score) AS p, sum(fp) OVER (PARTITION BY target, score) AS q
  FROM steps WINDOW w AS (PARTITION BY target, score ORDER BY key))
"""


LONG = _long_sql()


@query("roc_auc", LONG + """
SELECT target, score, CAST(max(p) AS BIGINT) AS actives, CAST(max(q) AS BIGINT) AS decoys,
  round(sum(fp * (ctp - tp / 2)) / nullif(max(p) * max(q), 0), 6) AS auc
FROM cum GROUP BY target, score""")
def roc_auc(spark, sf):
    long, rows, _ = long_rows(spark, sf)
    return rounded(E.auc_and_ap(long, rows=rows).drop("auprc"), "auc", digits=6)


@query("average_precision", LONG + """
SELECT target, score, round(sum(tp * ctp / (ctp + cfp)) / nullif(max(p), 0), 6) AS auprc
FROM cum GROUP BY target, score""")
def average_precision(spark, sf):
    long, rows, _ = long_rows(spark, sf)
    return rounded(E.auc_and_ap(long, rows=rows).select("target", "score", "auprc"), "auprc",
                   digits=6)


def ef_sql(source: str, group: str, fractions=(0.01, 0.05, 0.10)) -> str:
    parts = ", ".join(
        f"round(sum(CASE WHEN r <= greatest(1, ceil(n * CAST({f} AS DOUBLE))) THEN active ELSE 0 END)"
        f" / nullif(max(pos) * CAST({f} AS DOUBLE), 0), 6) AS ef{round(f * 100)}" for f in fractions)
    return f"""SELECT {group}, {parts} FROM (
  SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY key, ligand) AS r,
    count(*) OVER (PARTITION BY {group}) AS n, sum(active) OVER (PARTITION BY {group}) AS pos
  FROM {source}) s GROUP BY {group}"""


@query("enrichment_factors", LONG + ef_sql("long", "target, score"))
def enrichment_factors(spark, sf):
    long, rows, bounded = long_rows(spark, sf)
    out = E.enrichment(long, rows=rows, bounded=bounded)
    return rounded(out, "ef1", "ef5", "ef10", digits=6)


@query("ranking_metrics", LONG + f""",
ef AS ({ef_sql("long", "target, score", (0.01, 0.05))})
SELECT c.target, c.score, c.auc, c.auprc, ef1, ef5 FROM (
  SELECT target, score, round(sum(fp * (ctp - tp / 2)) / nullif(max(p) * max(q), 0), 6) AS auc,
    round(sum(tp * ctp / (ctp + cfp)) / nullif(max(p), 0), 6) AS auprc
  FROM cum GROUP BY target, score) c JOIN ef USING (target, score)""")
def ranking_metrics(spark, sf):
    long, rows, bounded = long_rows(spark, sf)
    out = E.ranking_metrics(long, rows=rows, bounded=bounded)
    return rounded(out, "auc", "auprc", "ef1", "ef5", digits=6)


@query("roc_pr_curves", LONG + """
SELECT target, score, round(key, 9) AS key, CAST(ctp AS BIGINT) AS ctp, CAST(cfp AS BIGINT) AS cfp,
  round(ctp / nullif(p, 0), 9) AS tpr, round(cfp / nullif(q, 0), 9) AS fpr,
  round(ctp / (ctp + cfp), 9) AS precision, round(ctp / nullif(p, 0), 9) AS recall FROM cum""")
def roc_pr_curves(spark, sf):
    long, rows, bounded = long_rows(spark, sf)
    out = E.curves(long, rows=rows, bounded=bounded)
    return rounded(out, "key", "tpr", "fpr", "precision", "recall")


@query("class_balance", f"""WITH {POSE1}
SELECT target, count(*) AS ligands, CAST(sum(active) AS BIGINT) AS actives,
  CAST(sum(1 - active) AS BIGINT) AS decoys,
  concat('1:', CAST(CAST(sum(1 - active) AS BIGINT) // greatest(1, CAST(sum(active) AS BIGINT))
    AS VARCHAR)) AS ratio,
  round(sum(active) * CAST(100 AS DOUBLE) / count(*), 6) AS active_pct,
  round(sum(active) / CAST(count(*) AS DOUBLE), 6) AS auprc_baseline
FROM pose1 GROUP BY target""")
def class_balance(spark, sf):
    first = poses(spark, sf).filter("pose = 1")
    return rounded(E.class_balance(first), "active_pct", "auprc_baseline", digits=6)


@query("score_stats_by_class", LONG + """
SELECT target, score, active, count(*) AS n, round(avg(key), 6) AS mean,
  round(stddev_samp(key), 6) AS std, round(quantile_cont(key, 0.5), 6) AS median,
  round(min(key), 6) AS min, round(max(key), 6) AS max
FROM long WHERE score <> 'ecr_total' GROUP BY target, score, active""")
def score_stats_by_class(spark, sf):
    first = poses(spark, sf).filter("pose = 1")
    long = E.labelled(first, {c: False for c in COLUMNS})
    rows = C.profile(first, SCORES).rows.times(len(COLUMNS))
    return rounded(E.class_stats(long, rows=rows), "mean", "std", "median", "min", "max", digits=6)


@query("cohens_d", LONG + """
SELECT target, score, CAST(na AS BIGINT) AS n_a, CAST(nd AS BIGINT) AS n_d,
  CASE WHEN na >= 2 AND nd >= 2 THEN round((md - ma) / nullif(sqrt(((na - 1) * va + (nd - 1) * vd)
    / (na + nd - 2)), 0), 6) END AS cohens_d
FROM (SELECT target, score, count(*) FILTER (WHERE active = 1) AS na,
  count(*) FILTER (WHERE active = 0) AS nd, avg(key) FILTER (WHERE active = 1) AS ma,
  avg(key) FILTER (WHERE active = 0) AS md, var_samp(key) FILTER (WHERE active = 1) AS va,
  var_samp(key) FILTER (WHERE active = 0) AS vd FROM long GROUP BY target, score) s""")
def cohens_d(spark, sf):
    long, _, _ = long_rows(spark, sf)
    return rounded(E.cohens_d(long), "cohens_d", digits=6)


@query("ks_statistic", LONG + """,
d AS (SELECT target, score, max(abs(ctp / p - cfp / q)) AS d, max(p) AS p, max(q) AS q
  FROM cum GROUP BY target, score),
l AS (SELECT *, d * sqrt(p * q / (p + q)) AS lam FROM d)
SELECT target, score, round(d, 6) AS ks_stat, round(CASE WHEN lam < 0.2 THEN 1.0 ELSE
  least(1.0, greatest(0.0, 2 * list_sum(list_transform(range(1, 101), lambda k :
    (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k * k * lam * lam))))) END, 6) AS ks_p
FROM l WHERE p >= 2 AND q >= 2""")
def ks_statistic(spark, sf):
    long, rows, bounded = long_rows(spark, sf)
    return rounded(E.ks_statistic(long, rows=rows, bounded=bounded), "ks_stat", "ks_p", digits=6)


@query("score_histogram", LONG + """,
span AS (SELECT target, score, quantile_cont(key, CAST(0.01 AS DOUBLE)) AS lo,
  quantile_cont(key, CAST(0.99 AS DOUBLE)) AS hi FROM long GROUP BY target, score),
binned AS (SELECT l.target, l.score, active, lo, hi,
  CAST(least(floor((key - lo) / (hi - lo) * 44), 43) AS INT) AS bin
  FROM long l JOIN span s ON l.target = s.target AND l.score = s.score
  WHERE key >= lo AND key <= hi AND hi > lo),
counts AS (SELECT target, score, active, lo, hi, bin, count(*) AS n FROM binned GROUP BY ALL)
SELECT target, score, active, bin, n, round(lo + bin * (hi - lo) / 44, 6) AS left_edge,
  round(n / (sum(n) OVER (PARTITION BY target, score, active) * (hi - lo) / 44), 6) AS density
FROM counts WHERE score <> 'ecr_total'""")
def score_histogram(spark, sf):
    first = poses(spark, sf).filter("pose = 1")
    prof = C.profile(first, SCORES)
    long = E.labelled(first, {c: False for c in COLUMNS})
    out = E.histogram(long, rows=prof.rows.times(len(COLUMNS)), bounded=prof.bounded)
    return rounded(out, "left_edge", "density", digits=6)


AUC_SQL = LONG + """,
aucs AS (SELECT target, score, sum(fp * (ctp - tp / 2)) / nullif(max(p) * max(q), 0) AS auc
  FROM cum GROUP BY target, score)
"""


@query("direction_selftest", AUC_SQL + """
SELECT score, count(*) AS targets, round(median(auc), 6) AS median_auc,
  count(*) FILTER (WHERE auc < 0.5) AS below_half, round(1 - median(auc), 6) AS mirrored,
  count(*) >= 3 AND median(auc) < 0.5 AS suspect
FROM aucs WHERE auc IS NOT NULL GROUP BY score""")
def direction_selftest(spark, sf):
    long, rows, _ = long_rows(spark, sf)
    out = E.direction_selftest(E.auc_and_ap(long, rows=rows))
    return rounded(out, "median_auc", "mirrored", digits=6)


@query("auc_by_target_and_score", AUC_SQL + """
SELECT target, round(max(auc) FILTER (WHERE score = 'score_vina'), 6) AS score_vina,
  round(max(auc) FILTER (WHERE score = 'score_cnnaffinity'), 6) AS score_cnnaffinity,
  round(max(auc) FILTER (WHERE score = 'score_deltalinf9xgb'), 6) AS score_deltalinf9xgb,
  round(max(auc) FILTER (WHERE score = 'ecr_total'), 6) AS ecr_total
FROM aucs GROUP BY target""")
def auc_by_target_and_score(spark, sf):
    long, rows, _ = long_rows(spark, sf)
    out = E.compare_scores(E.auc_and_ap(long, rows=rows), list(DIRECTIONS), "auc")
    return rounded(out, *DIRECTIONS, digits=6)


def _pairs_sql() -> str:
    combos = [(a, b) for i, a in enumerate(COLUMNS) for b in COLUMNS[i + 1:]]
    arms = [f"SELECT target, 'all' AS subset, '{a}' AS score_x, '{b}' AS score_y, ligand, "
            f"{a} AS x, {b} AS y FROM pose1 WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
            for a, b in combos]
    arms += [a.replace("'all'", "'actives'") + " AND active = 1" for a in arms]
    return f"WITH {POSE1},\npairs AS ({' UNION ALL '.join(arms)})\n"


PAIRS = _pairs_sql()
PKEY = "target, subset, score_x, score_y"


def pair_rows(spark, sf):
    first = poses(spark, sf).filter("pose = 1")
    return R.score_pairs(first, COLUMNS), C.profile(first, SCORES).rows.times(6)


@query("pearson_pairs", PAIRS + f"""
SELECT {PKEY}, count(*) AS n, CASE WHEN count(*) >= 3 AND stddev_pop(x) > 0 AND stddev_pop(y) > 0
  THEN round(corr(x, y), 6) END AS pearson FROM pairs GROUP BY {PKEY}""")
def pearson_pairs(spark, sf):
    first = poses(spark, sf).filter("pose = 1")
    return rounded(R.pearson(first, COLUMNS), "pearson", digits=6)


SPEARMAN = PAIRS + f""",
avg_ranks AS (SELECT {PKEY},
  rank() OVER (PARTITION BY {PKEY} ORDER BY x)
    + (count(*) OVER (PARTITION BY {PKEY}, x) - 1) / 2.0 AS rx,
  rank() OVER (PARTITION BY {PKEY} ORDER BY y)
    + (count(*) OVER (PARTITION BY {PKEY}, y) - 1) / 2.0 AS ry FROM pairs),
rho AS (SELECT {PKEY}, count(*) AS n, CASE WHEN count(*) >= 3 AND stddev_pop(rx) > 0
  AND stddev_pop(ry) > 0 THEN corr(rx, ry) END AS spearman FROM avg_ranks GROUP BY {PKEY})
"""


@query("spearman_pairs", SPEARMAN + f"SELECT {PKEY}, n, round(spearman, 6) AS spearman FROM rho")
def spearman_pairs(spark, sf):
    pairs, rows = pair_rows(spark, sf)
    return rounded(R.spearman(pairs, rows), "spearman", digits=6)


@query("kendall_pairs", PAIRS + f""",
s AS (SELECT a.target, a.subset, a.score_x, a.score_y,
  CAST(sum(sign(a.x - b.x) * sign(a.y - b.y)) AS DOUBLE) AS s,
  CAST(sum(abs(sign(a.x - b.x))) AS DOUBLE) AS sx, CAST(sum(abs(sign(a.y - b.y))) AS DOUBLE) AS sy
  FROM pairs a JOIN pairs b ON a.target = b.target AND a.subset = b.subset
    AND a.score_x = b.score_x AND a.score_y = b.score_y GROUP BY ALL),
n AS (SELECT {PKEY}, count(*) AS n FROM pairs GROUP BY {PKEY})
SELECT {PKEY}, n, CASE WHEN n >= 3 AND sx > 0 AND sy > 0
  THEN round(s / sqrt(sx) / sqrt(sy), 6) END AS kendall FROM s JOIN n USING ({PKEY})""")
def kendall_pairs(spark, sf):
    pairs, rows = pair_rows(spark, sf)
    return rounded(R.kendall(pairs, rows).drop("_z"), "kendall", digits=6)


def _tail_sql(start: str, end: str, density: str) -> str:
    """Simpson's rule in SQL: share of a density on [0, end] at or above start; ``{w}`` is the point."""
    def area(low: str) -> str:
        point = density.replace("{w}", f"({low} + i * ({end} - {low}) / 1000)")
        return (f"(({end} - {low}) / 1000 * list_sum(list_transform(range(1001), lambda i : "
                f"(CASE WHEN i IN (0, 1000) THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END) * exp({point}))))")
    return f"CASE WHEN {start} >= {end} THEN 0.0 ELSE {area(start)} / {area('CAST(0 AS DOUBLE)')} END"


def _correlation_p_sql(r: str) -> str:
    root = "sqrt(CAST(n - 2 AS DOUBLE))"
    tail = _tail_sql(f"({root} * asin(least(abs({r}), 1.0)))", f"least({root} * pi() / 2, 12.0)",
                     f"(n - 3) * ln(cos({{w}} / {root}))")
    return f"CASE WHEN n > 2 AND {r} IS NOT NULL THEN {tail} END"


ALL_THREE = SPEARMAN + f""",
pear AS (SELECT {PKEY}, CASE WHEN count(*) >= 3 AND stddev_pop(x) > 0 AND stddev_pop(y) > 0
  THEN corr(x, y) END AS pearson FROM pairs GROUP BY {PKEY}),
ksum AS (SELECT a.target, a.subset, a.score_x, a.score_y,
  CAST(sum(sign(a.x - b.x) * sign(a.y - b.y)) AS DOUBLE) / 2 AS s,
  CAST(sum(abs(sign(a.x - b.x))) AS DOUBLE) AS sx, CAST(sum(abs(sign(a.y - b.y))) AS DOUBLE) AS sy
  FROM pairs a JOIN pairs b ON a.target = b.target AND a.subset = b.subset
    AND a.score_x = b.score_x AND a.score_y = b.score_y GROUP BY ALL),
{", ".join(f"""ties_{v} AS (SELECT {PKEY}, CAST(sum(t * (t - 1)) AS DOUBLE) AS {v}1,
  CAST(sum(t * (t - 1) * (t - 2)) AS DOUBLE) AS {v}2, CAST(sum(t * (t - 1) * (2 * t + 5)) AS DOUBLE) AS {v}3
  FROM (SELECT {PKEY}, {v}, count(*) AS t FROM pairs GROUP BY {PKEY}, {v}) GROUP BY {PKEY})""" for v in "xy")},
k AS (SELECT {PKEY}, CASE WHEN n >= 3 AND sx > 0 AND sy > 0 THEN 2 * s / sqrt(sx) / sqrt(sy) END AS kendall,
  CASE WHEN n >= 3 AND sx > 0 AND sy > 0 THEN s / sqrt((CAST(n AS DOUBLE) * (n - 1) * (2 * n + 5) - x3 - y3) / 18
    + x1 * y1 / (2.0 * n * (n - 1)) + x2 * y2 / (9.0 * n * (n - 1) * (n - 2))) END AS z
  FROM ksum JOIN rho USING ({PKEY}) JOIN ties_x USING ({PKEY}) JOIN ties_y USING ({PKEY}))
SELECT {PKEY}, n, round(pearson, 6) AS pearson, round({_correlation_p_sql("pearson")}, 6) AS pearson_p,
  round(spearman, 6) AS spearman, round({_correlation_p_sql("spearman")}, 6) AS spearman_p,
  round(kendall, 6) AS kendall,
  round(CASE WHEN z IS NOT NULL THEN {_tail_sql("abs(z)", "CAST(12 AS DOUBLE)", "-{w} * {w} / 2")} END, 6) AS kendall_p
FROM rho JOIN pear USING ({PKEY}) JOIN k USING ({PKEY})"""


@query("correlations_with_p", ALL_THREE)
def correlations_with_p(spark, sf):
    first = poses(spark, sf).filter("pose = 1")
    out = R.all_correlations(first, COLUMNS, C.profile(first, SCORES).rows)
    return rounded(out, "pearson", "pearson_p", "spearman", "spearman_p", "kendall", "kendall_p", digits=6)


@query("orthogonality_median", SPEARMAN + """
SELECT score_x, score_y, count(*) AS targets, round(median(spearman), 6) AS median_rho
FROM rho WHERE subset = 'all' AND spearman IS NOT NULL GROUP BY score_x, score_y""")
def orthogonality_median(spark, sf):
    pairs, rows = pair_rows(spark, sf)
    return rounded(R.orthogonality(R.spearman(pairs, rows)), "median_rho", digits=6)


@query("orthogonality_matrix", SPEARMAN + """,
m AS (SELECT score_x, score_y, median(spearman) AS r FROM rho WHERE subset = 'all' GROUP BY ALL),
b AS (SELECT score_x, score_y, r FROM m UNION ALL SELECT score_y, score_x, r FROM m
  UNION ALL SELECT DISTINCT score_x, score_x, CAST(1 AS DOUBLE) FROM m
  UNION ALL SELECT 'score_deltalinf9xgb', 'score_deltalinf9xgb', CAST(1 AS DOUBLE))
SELECT score_x, round(max(r) FILTER (WHERE score_y = 'score_vina'), 6) AS score_vina,
  round(max(r) FILTER (WHERE score_y = 'score_cnnaffinity'), 6) AS score_cnnaffinity,
  round(max(r) FILTER (WHERE score_y = 'score_deltalinf9xgb'), 6) AS score_deltalinf9xgb
FROM b GROUP BY score_x""")
def orthogonality_matrix(spark, sf):
    pairs, rows = pair_rows(spark, sf)
    medians = R.orthogonality(R.spearman(pairs, rows))
    return rounded(R.orthogonality_matrix(medians, COLUMNS), *COLUMNS, digits=6)


PAIR_NAMES = [f"{a}|{b}" for i, a in enumerate(COLUMNS) for b in COLUMNS[i + 1:]]


def _orthogonality_table_sql() -> str:
    cols = ", ".join(f"""max(spearman) FILTER (WHERE concat(score_x, '|', score_y) = '{n}') AS "{n}\""""
                     for n in PAIR_NAMES)
    plain = ", ".join(f'round("{n}", 6) AS "{n}"' for n in PAIR_NAMES)
    med = ", ".join(f'round(median("{n}"), 6)' for n in PAIR_NAMES)
    return SPEARMAN + f""",
w AS (SELECT target, {cols} FROM rho WHERE subset = 'all' GROUP BY target)
SELECT target, {plain} FROM w UNION ALL SELECT 'MEDIAN', {med} FROM w"""


@query("orthogonality_table", _orthogonality_table_sql())
def orthogonality_table(spark, sf):
    pairs, rows = pair_rows(spark, sf)
    out = R.orthogonality_table(R.spearman(pairs, rows), COLUMNS)
    return out.select("target", *[F.round(F.col(f"`{n}`"), 6).alias(n) for n in PAIR_NAMES])


@query("ols_lines", PAIRS + f"""
SELECT {PKEY}, count(*) AS n, round(regr_slope(y, x), 6) AS slope,
  round(regr_intercept(y, x), 6) AS intercept FROM pairs GROUP BY {PKEY}""")
def ols_lines(spark, sf):
    first = poses(spark, sf).filter("pose = 1")
    return rounded(R.ols_lines(first, COLUMNS), "slope", "intercept", digits=6)
