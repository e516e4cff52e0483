"""Queries: parameter grid, leave-one-target-out validation, stability tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenmeld.catalog import score
from screenmeld.functions.grids import parameter_grid
from screenmeld.operators import consensus as C
from screenmeld.operators import search as S
from screenmeld.plans.fixtures import POSES, SCORES, poses
from screenmeld.plans.ranking import rounded
from screenmeld.plans.registry import query

GRID = parameter_grid(SCORES)
DEFAULT_GID = next(p.gid for p in GRID if p.kind == "equal" and p.sigma == 4)
LABELS = [score(s).label for s in SCORES]


def _ranked_sql() -> str:
    return ", ".join(f"CASE WHEN score_{s} IS NOT NULL THEN rank() OVER (PARTITION BY target "
                     f"ORDER BY score_{s} ASC NULLS LAST) END AS rank_{s}" for s in SCORES)


def _metric_members() -> str:
    points = ", ".join("({}, '{}', {}, {}, '{}')".format(
        p.gid, p.kind, p.sigma, ", ".join(f"CAST({w} AS DOUBLE)" for w in p.weights),
        p.text(SCORES)) for p in GRID)
    value = " + ".join(f"w{i} * coalesce(exp(-rank_{s} / greatest(n / CAST(sigma AS DOUBLE), 1.0)), 0)"
                       for i, s in enumerate(SCORES, 1))
    return f"""WITH {POSES},
params(gid, kind, sigma, w1, w2, w3, weights) AS (VALUES {points}),
ranked AS (SELECT *, {_ranked_sql()}, CAST(count(*) OVER (PARTITION BY target) AS DOUBLE) AS n
  FROM poses),
lig AS (SELECT target, gid, ligand, max(active) AS active, -round(max({value}), 12) AS key
  FROM ranked CROSS JOIN params GROUP BY target, gid, ligand),
{_metrics_of('lig', 'target, gid', 'gm')}"""


def _metrics_of(source: str, group: str, name: str) -> str:
    ef = ", ".join(f"sum(CASE WHEN r <= greatest(1, ceil(n * CAST({f} AS DOUBLE))) THEN active ELSE 0 END)"
                   f" / nullif(max(pos) * CAST({f} AS DOUBLE), 0) AS ef{round(f * 100)}"
                   for f in (0.01, 0.05))
    return f"""{name}_rows AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY key, ligand) AS r,
    sum(active) OVER (PARTITION BY {group} ORDER BY key) AS tp,
    count(*) OVER (PARTITION BY {group} ORDER BY key) AS upto,
    count(*) OVER (PARTITION BY {group}) AS n, sum(active) OVER (PARTITION BY {group}) AS pos
  FROM {source}),
{name} AS (SELECT {group},
  (CAST(sum((1 - active) * tp) AS DOUBLE) - sum(active * (upto - tp)) + max(pos) * (max(n) - max(pos)))
    / nullif(2.0 * max(pos) * (max(n) - max(pos)), 0) AS auc, {ef},
  CASE WHEN max(pos) > 0 AND max(pos) < max(n)
    THEN sum(active * tp / CAST(upto AS DOUBLE)) / max(pos) END AS auprc
  FROM {name}_rows GROUP BY {group})"""


GM = _metric_members()
FIRST_BEST = "row_number() OVER (PARTITION BY {p} ORDER BY round({v}, 9) DESC, gid) = 1"
SEARCH = GM + f""",
grid_gm AS (SELECT g.* FROM gm g JOIN params USING (gid) WHERE kind = 'grid'),
oracle AS (SELECT target, gid FROM grid_gm WHERE ef1 IS NOT NULL
  QUALIFY {FIRST_BEST.format(p='target', v='ef1')}),
folds AS (SELECT target AS test_target, row_number() OVER (ORDER BY target) AS fold
  FROM (SELECT DISTINCT target FROM gm) t),
loo_values AS (SELECT f.test_target, g.gid, kind, median(ef1) AS v FROM folds f
  JOIN gm g ON g.target <> f.test_target JOIN params USING (gid)
  WHERE ef1 IS NOT NULL GROUP BY ALL),
loo AS (SELECT test_target AS target, gid FROM loo_values WHERE kind = 'grid'
  QUALIFY {FIRST_BEST.format(p='test_target', v='v')}),
equal_cv AS (SELECT test_target AS target, gid FROM loo_values WHERE kind = 'equal'
  QUALIFY {FIRST_BEST.format(p='test_target', v='v')}),
overall AS (SELECT gid FROM (SELECT gid, median(ef1) AS v FROM grid_gm WHERE ef1 IS NOT NULL
  GROUP BY gid) x ORDER BY round(v, 9) DESC, gid LIMIT 1)
"""


def _singles_sql() -> str:
    arms = " UNION ALL ".join(
        f"SELECT target, '{score(s).label} (Best Pose)' AS method, ligand, max(active) AS active, "
        f"min(score_{s}) AS key FROM poses WHERE score_{s} IS NOT NULL GROUP BY target, ligand "
        f"UNION ALL SELECT target, '{score(s).label} (Pose 1)', ligand, active, score_{s} FROM poses "
        f"WHERE pose = 1 AND score_{s} IS NOT NULL" for s in SCORES)
    return f"singles AS ({arms}), {_metrics_of('singles', 'target, method', 'sm')}"


def _results_members() -> str:
    picks = {"ECR Equal": f"(SELECT DISTINCT target, {DEFAULT_GID} AS gid FROM gm)",
             "ECR Equal (CV)": "equal_cv", "ECR Oracle": "oracle", "ECR LOO-CV": "loo",
             "ECR Global": "(SELECT DISTINCT target, (SELECT gid FROM overall) AS gid FROM gm)"}
    arms = " UNION ALL ".join(
        f"SELECT p.target, '{m}' AS method, sigma, weights, auc, ef1, ef5, auprc FROM {src} p "
        f"JOIN gm ON gm.target = p.target AND gm.gid = p.gid JOIN params ON params.gid = p.gid"
        for m, src in picks.items())
    return SEARCH + f""", {_singles_sql()},
results AS (SELECT fold, test_target, method, sigma, weights, auc, ef1, ef5, auprc FROM (
  SELECT target, method, CAST(NULL AS INT) AS sigma, CAST(NULL AS VARCHAR) AS weights, auc, ef1, ef5,
    auprc FROM sm UNION ALL {arms}) r JOIN folds ON folds.test_target = r.target)
"""


RESULTS = _results_members()
METRICS_6 = "round(auc, 6) AS auc, round(ef1, 6) AS ef1, round(ef5, 6) AS ef5, round(auprc, 6) AS auprc"


@query("grid_metrics", GM + f"SELECT target, gid, {METRICS_6} FROM gm")
def grid_metrics(spark, sf):
    return rounded(S.grid_metrics(poses(spark, sf, numbered=False), SCORES, GRID), *S.METRICS, digits=6)


def _searched(spark, sf):
    metrics = S.staged_grid_metrics(poses(spark, sf, numbered=False), SCORES, GRID)
    return metrics, S.grid_table(metrics, SCORES, GRID)


@query("oracle_params", SEARCH + f"""
SELECT o.target, o.gid, sigma, weights, {METRICS_6} FROM oracle o
JOIN gm ON gm.target = o.target AND gm.gid = o.gid JOIN params ON params.gid = o.gid""")
def oracle_params(spark, sf):
    metrics, params = _searched(spark, sf)
    best = S.oracle_params(metrics, params).join(metrics, ["target", "gid"]).join(params, "gid")
    return rounded(best.select("target", "gid", "sigma", "weights", *S.METRICS), *S.METRICS, digits=6)


@query("loo_params", SEARCH + "SELECT target, gid, sigma, weights FROM loo JOIN params USING (gid)")
def loo_params(spark, sf):
    metrics, params = _searched(spark, sf)
    return S.loo_params(metrics, params).join(params, "gid").select(
        "target", "gid", "sigma", "weights")


@query("loo_values", SEARCH + """
SELECT test_target, gid, round(v, 6) AS value FROM loo_values""")
def loo_values(spark, sf):
    metrics, _ = _searched(spark, sf)
    return rounded(S.leave_one_out(metrics), "value", digits=6)


@query("loo_mean_values", SEARCH + """
SELECT f.test_target, g.gid, round(avg(ef1), 6) AS value FROM folds f
JOIN gm g ON g.target <> f.test_target WHERE ef1 IS NOT NULL GROUP BY ALL""")
def loo_mean_values(spark, sf):
    metrics, _ = _searched(spark, sf)
    return rounded(S.leave_one_out(metrics, how="mean"), "value", digits=6)


@query("equal_sigma_cv", SEARCH + """
SELECT target, gid, sigma FROM equal_cv JOIN params USING (gid)""")
def equal_sigma_cv(spark, sf):
    metrics, params = _searched(spark, sf)
    return S.loo_params(metrics, params, kind="equal").join(params, "gid").select(
        "target", "gid", "sigma")


@query("global_params", SEARCH + """
SELECT gid, sigma, weights FROM overall JOIN params USING (gid)""")
def global_params(spark, sf):
    metrics, params = _searched(spark, sf)
    return S.global_params(metrics, params).join(params, "gid").select("gid", "sigma", "weights")


def _results(spark, sf):
    return S.cross_validation(poses(spark, sf), SCORES, GRID)


@query("loo_results", RESULTS + f"""
SELECT CAST(fold AS INT) AS fold, test_target, method, sigma, weights, {METRICS_6} FROM results""")
def loo_results(spark, sf):
    return rounded(_results(spark, sf), *S.METRICS, digits=6)


@query("single_score_baselines", f"""WITH {POSES}, {_singles_sql()}
SELECT target, method, CAST(NULL AS INT) AS sigma, CAST(NULL AS VARCHAR) AS weights, {METRICS_6}
FROM sm""")
def single_score_baselines(spark, sf):
    data = poses(spark, sf)
    out = S.single_score_baselines(data, SCORES, C.profile(data, SCORES))
    return rounded(out, *S.METRICS, digits=6)


@query("method_summary", RESULTS + """
SELECT method, round(avg(ef1), 6) AS mean, round(stddev_samp(ef1), 6) AS std, count(*) AS n
FROM results WHERE ef1 IS NOT NULL GROUP BY method""")
def method_summary(spark, sf):
    return rounded(S.method_summary(_results(spark, sf)), "mean", "std", digits=6)


@query("best_single_method", RESULTS + r""",
s AS (SELECT regexp_extract(method, '\((Pose 1|Best Pose)\)$', 1) AS kind, method, avg(ef1) AS mean
  FROM results WHERE ef1 IS NOT NULL GROUP BY method)
SELECT kind, method, round(mean, 6) AS mean FROM s WHERE kind <> ''
QUALIFY row_number() OVER (PARTITION BY kind ORDER BY mean DESC, method DESC) = 1""")
def best_single_method(spark, sf):
    best = S.best_single(S.method_summary(_results(spark, sf)))
    return rounded(best, "mean", digits=6)


@query("fold_gaps", RESULTS + """,
w AS (SELECT test_target, max(ef1) FILTER (WHERE method = 'ECR Equal') AS equal,
  max(ef1) FILTER (WHERE method = 'ECR LOO-CV') AS loo,
  max(ef1) FILTER (WHERE method = 'ECR Oracle') AS oracle FROM results GROUP BY test_target)
SELECT test_target, round(equal, 6) AS equal, round(loo, 6) AS loo, round(oracle, 6) AS oracle,
  round(oracle - loo, 6) AS gap, round(loo - equal, 6) AS gain FROM w""")
def fold_gaps(spark, sf):
    return rounded(S.fold_gaps(_results(spark, sf)), "equal", "loo", "oracle", "gap", "gain", digits=6)


@query("generalisation_gap", RESULTS + """,
m AS (SELECT avg(ef1) FILTER (WHERE method = 'ECR LOO-CV') AS loo,
  avg(ef1) FILTER (WHERE method = 'ECR Oracle') AS oracle,
  avg(ef1) FILTER (WHERE method = 'ECR Equal') AS equal,
  avg(ef1) FILTER (WHERE method = 'ECR Equal (CV)') AS equal_cv FROM results),
g AS (SELECT *, oracle - loo AS gap,
  CASE WHEN oracle > 0 THEN (oracle - loo) / oracle * 100 ELSE 0 END AS gap_pct FROM m)
SELECT round(loo, 6) AS loo, round(oracle, 6) AS oracle, round(equal, 6) AS equal,
  round(equal_cv, 6) AS equal_cv, round(gap, 6) AS gap, round(gap_pct, 6) AS gap_pct,
  round(equal_cv - equal, 6) AS sigma_effect, round(loo - equal_cv, 6) AS weight_effect,
  round(loo - equal, 6) AS total_effect, CASE WHEN gap_pct < 10 THEN 'generalises well'
  WHEN gap_pct < 25 THEN 'moderate gap' ELSE 'large gap' END AS verdict FROM g""")
def generalisation_gap(spark, sf):
    out = S.generalisation_gap(_results(spark, sf))
    return rounded(out, *[c for c in out.columns if c != "verdict"], digits=6)


@query("sigma_distribution", RESULTS + """
SELECT sigma, count(*) AS folds, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct
FROM results WHERE method = 'ECR LOO-CV' GROUP BY sigma""")
def sigma_distribution(spark, sf):
    return rounded(S.sigma_distribution(_results(spark, sf)), "share_pct", digits=6)


@query("sigma_stability", RESULTS + """,
l AS (SELECT sigma FROM results WHERE method = 'ECR LOO-CV' AND sigma IS NOT NULL),
m AS (SELECT sigma, count(*) * 100.0 / (SELECT count(*) FROM l) AS pct FROM l GROUP BY sigma
  ORDER BY count(*) DESC, sigma LIMIT 1)
SELECT (SELECT count(*) FROM l) AS folds, CAST(floor((SELECT median(sigma) FROM l)) AS INT) AS median,
  round((SELECT avg(sigma) FROM l), 6) AS mean, round((SELECT stddev_pop(sigma) FROM l), 6) AS std,
  (SELECT min(sigma) FROM l) AS min, (SELECT max(sigma) FROM l) AS max, sigma AS mode,
  round(pct, 6) AS mode_pct, CASE WHEN pct >= 70 THEN 'stable' WHEN pct >= 40
    THEN 'moderately stable' ELSE 'unstable' END AS verdict FROM m""")
def sigma_stability(spark, sf):
    return rounded(S.sigma_stability(_results(spark, sf)), "mean", "std", "mode_pct", digits=6)


WEIGHTS_LONG = RESULTS + """,
wl AS (SELECT test_target, split_part(p, '=', 1) AS label, CAST(split_part(p, '=', 2) AS DOUBLE) AS weight
  FROM (SELECT test_target, unnest(string_split(weights, '/')) AS p FROM results
        WHERE method = 'ECR LOO-CV') x),
ws AS (SELECT label, median(weight) AS median, avg(weight) AS mean, stddev_pop(weight) AS std,
  min(weight) AS min, max(weight) AS max,
  count(*) FILTER (WHERE weight = 0) * CAST(100 AS DOUBLE) / count(*) AS zero_pct FROM wl GROUP BY label)
"""


@query("weight_stability", WEIGHTS_LONG + """
SELECT label, round(median, 6) AS median, round(mean, 6) AS mean, round(std, 6) AS std, min, max,
  round(zero_pct, 6) AS zero_pct, zero_pct >= 80 AS removable FROM ws""")
def weight_stability(spark, sf):
    out = S.weight_stability(_results(spark, sf))
    return rounded(out, "median", "mean", "std", "zero_pct", digits=6)


@query("weight_verdict", WEIGHTS_LONG + """,
v AS (SELECT avg(std) AS mean_std, count(*) FILTER (WHERE std < 0.15) AS consistent,
  count(*) AS scores, count(*) FILTER (WHERE zero_pct >= 80) AS removable FROM ws)
SELECT round(mean_std, 6) AS mean_std, consistent, scores, removable,
  CASE WHEN mean_std < 0.10 THEN 'stable' WHEN mean_std < 0.20 THEN 'moderately stable'
  ELSE 'unstable' END AS verdict FROM v""")
def weight_verdict(spark, sf):
    return rounded(S.weight_verdict(S.weight_stability(_results(spark, sf))), "mean_std", digits=6)


@query("global_agreement", WEIGHTS_LONG + """,
g AS (SELECT sigma, weights FROM results WHERE method = 'ECR Global' ORDER BY fold LIMIT 1),
gw AS (SELECT split_part(p, '=', 1) AS label, CAST(split_part(p, '=', 2) AS DOUBLE) AS w
  FROM (SELECT unnest(string_split(weights, '/')) AS p FROM g) x),
d AS (SELECT sqrt(sum(pow(coalesce(w, 0) - median, 2))) AS distance FROM ws LEFT JOIN gw USING (label)),
a AS (SELECT count(*) AS folds, count(*) FILTER (WHERE sigma = (SELECT sigma FROM g)) AS agreeing
  FROM results WHERE method = 'ECR LOO-CV')
SELECT (SELECT sigma FROM g) AS global_sigma, folds, agreeing, round(distance, 6) AS distance,
  CASE WHEN distance < 0.10 THEN 'good' WHEN distance < 0.25 THEN 'moderate' ELSE 'poor' END
  AS agreement FROM a, d""")
def global_agreement(spark, sf):
    return rounded(S.global_agreement(_results(spark, sf)), "distance", digits=6)


@query("recommendation", WEIGHTS_LONG + """,
g AS (SELECT sigma, weights FROM results WHERE method = 'ECR Global' ORDER BY fold LIMIT 1)
SELECT sigma, weights,
  round((SELECT avg(ef1) FROM results WHERE method = 'ECR Global'), 6) AS optimistic_mean,
  round((SELECT avg(ef1) FROM results WHERE method = 'ECR LOO-CV'), 6) AS honest_mean,
  coalesce((SELECT string_agg(label, ', ' ORDER BY label) FROM ws WHERE zero_pct >= 80), '')
    AS removable FROM g""")
def recommendation(spark, sf):
    return rounded(S.recommendation(_results(spark, sf)), "optimistic_mean", "honest_mean", digits=6)


@query("method_comparison", RESULTS + """
SELECT test_target, round(max(auc) FILTER (WHERE method = 'ECR Equal'), 6) AS equal,
  round(max(auc) FILTER (WHERE method = 'ECR Equal (CV)'), 6) AS equal_cv,
  round(max(auc) FILTER (WHERE method = 'ECR LOO-CV'), 6) AS loo,
  round(max(auc) FILTER (WHERE method = 'ECR Global'), 6) AS overall,
  round(max(auc) FILTER (WHERE method = 'ECR Oracle'), 6) AS oracle
FROM results GROUP BY test_target""")
def method_comparison(spark, sf):
    names = {"ECR Equal": "equal", "ECR Equal (CV)": "equal_cv", "ECR LOO-CV": "loo",
             "ECR Global": "overall", "ECR Oracle": "oracle"}
    wide = S.method_table(_results(spark, sf), list(names), "auc")
    return wide.select("test_target", *[F.round(F.col(f"`{m}`"), 6).alias(n)
                                        for m, n in names.items()])
