"""Queries: consensus ranking, ligand aggregation, top lists, refinement."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenmeld.operators import consensus as C
from screenmeld.plans.fixtures import POSES, SCORES, poses
from screenmeld.plans.registry import query

SCENARIOS = {
    "equal": None,
    "vina_heavy": {"vina": 0.6, "cnnaffinity": 0.2, "deltalinf9xgb": 0.2},
    "cnn_only": {"cnnaffinity": 1.0},
    "pair": {"vina": 2.0, "deltalinf9xgb": 1.0},
}


def ecr_members(ties: str, w: tuple[str, str, str] = ("1.0/3", "1.0/3", "1.0/3")) -> str:
    """WITH members ``ranked`` and ``ecr`` (pose level) for the SQL twins."""
    fn = "row_number()" if ties == "first" else "rank()"
    tail = ", ligand, pose" if ties == "first" else ""

    def one(s: str) -> str:
        return (f"CASE WHEN score_{s} IS NOT NULL THEN {fn} OVER (PARTITION BY target ORDER BY "
                f"score_{s} ASC NULLS LAST{tail}) END AS rank_{s}")

    def exp(s: str) -> str:
        return (f"coalesce(exp(-rank_{s} / greatest(CAST(n AS DOUBLE) / 4.0, 1.0)), 0.0)"
                f" AS ecr_{s}")

    ranks = ", ".join(one(s) for s in SCORES)
    terms = ", ".join(exp(s) for s in SCORES)
    total = " + ".join(f"CAST({x} AS DOUBLE) * ecr_{s}" for x, s in zip(w, SCORES))
    return f"""{POSES},
ranked AS (SELECT *, {ranks}, count(*) OVER (PARTITION BY target) AS n FROM poses),
terms AS (SELECT *, {terms} FROM ranked),
ecr AS (SELECT *, {total} AS ecr_total FROM terms)"""


BEST = """best AS (
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target, ligand
  ORDER BY ecr_total DESC, pose) AS rn FROM ecr) x WHERE rn = 1)"""

ECR_FIRST = "WITH " + ecr_members("first") + ", " + BEST
ECR_MIN = "WITH " + ecr_members("min") + ", " + BEST

RANKED_SQL = """
SELECT target, ligand, pose AS best_pose, round(ecr_total, 9) AS ecr_score,
  CAST(row_number() OVER (PARTITION BY target ORDER BY ecr_total DESC, ligand) AS BIGINT) AS ecr_rank,
  score_vina AS score_vina_best, score_cnnaffinity AS score_cnnaffinity_best,
  score_deltalinf9xgb AS score_deltalinf9xgb_best, active
FROM best"""


def rounded(df, *cols, digits=9):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("ecr_rerank", ECR_FIRST + RANKED_SQL)
def ecr_rerank(spark, sf):
    return rounded(C.rerank(poses(spark, sf), SCORES, keep=["active"]), "ecr_score")


@query("ecr_min_rank", ECR_MIN + RANKED_SQL)
def ecr_min_rank(spark, sf):
    return rounded(C.rerank(poses(spark, sf), SCORES, ties="min", keep=["active"]), "ecr_score")


@query("ecr_pose_terms", ECR_FIRST + """
SELECT target, ligand, pose, CAST(rank_vina AS BIGINT) AS rank_vina,
  CAST(rank_cnnaffinity AS BIGINT) AS rank_cnnaffinity,
  CAST(rank_deltalinf9xgb AS BIGINT) AS rank_deltalinf9xgb, round(ecr_vina, 9) AS ecr_vina,
  round(ecr_cnnaffinity, 9) AS ecr_cnnaffinity, round(ecr_deltalinf9xgb, 9) AS ecr_deltalinf9xgb,
  round(ecr_total, 9) AS ecr_total
FROM ecr""")
def ecr_pose_terms(spark, sf):
    data = poses(spark, sf)
    prof = C.profile(data, SCORES)
    posed = C.consensus_poses(C.rank_scores(data, SCORES, rows=prof.rows), SCORES, prof)
    terms = [f"ecr_{s}" for s in SCORES] + ["ecr_total"]
    return rounded(posed.select("target", "ligand", "pose", *[f"rank_{s}" for s in SCORES], *terms),
                   *terms)


@query("ligand_best_pose", ECR_FIRST + """
SELECT target, ligand, pose AS best_pose, round(ecr_total, 9) AS ecr_score,
  score_vina AS score_vina_best, score_cnnaffinity AS score_cnnaffinity_best,
  score_deltalinf9xgb AS score_deltalinf9xgb_best FROM best""")
def ligand_best_pose(spark, sf):
    data = poses(spark, sf)
    prof = C.profile(data, SCORES)
    posed = C.consensus_poses(C.rank_scores(data, SCORES, rows=prof.rows), SCORES, prof)
    return rounded(C.best_pose(posed, SCORES), "ecr_score")


def _scenario_sql() -> str:
    sets = {"equal": (1, 1, 1), "vina_heavy": (0.6, 0.2, 0.2), "cnn_only": (0, 1, 0),
            "pair": (2, 0, 1)}
    total = {k: sum(v) for k, v in sets.items()}
    rows = ", ".join("('{}', {})".format(k, ", ".join(
        f"CAST({x} AS DOUBLE) / CAST({total[k]} AS DOUBLE)" for x in v)) for k, v in sets.items())
    return f"""WITH {ecr_members("first")},
sets(scenario, w1, w2, w3) AS (VALUES {rows}),
mixed AS (SELECT scenario, target, ligand, pose,
  w1 * ecr_vina + w2 * ecr_cnnaffinity + w3 * ecr_deltalinf9xgb AS total FROM terms CROSS JOIN sets),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scenario, target, ligand
  ORDER BY total DESC, pose) AS rn FROM mixed) x WHERE rn = 1)
SELECT scenario, target, ligand, pose AS best_pose, round(total, 9) AS ecr_score,
  CAST(row_number() OVER (PARTITION BY scenario, target ORDER BY total DESC, ligand) AS BIGINT)
    AS ecr_rank FROM best"""


@query("ecr_weight_scenarios", _scenario_sql())
def ecr_weight_scenarios(spark, sf):
    out = C.rerank_scenarios(poses(spark, sf), SCORES, SCENARIOS)
    return rounded(out.select("scenario", "target", "ligand", "best_pose", "ecr_score", "ecr_rank"),
                   "ecr_score")


@query("top_n_per_target", ECR_FIRST + """
SELECT target, ligand, best_pose, ecr_score, rank FROM (
  SELECT target, ligand, pose AS best_pose, round(ecr_total, 9) AS ecr_score,
    CAST(row_number() OVER (PARTITION BY target ORDER BY ecr_total DESC, ligand) AS INT) AS rank
  FROM best) r WHERE rank <= 10""")
def top_n_per_target(spark, sf):
    data = poses(spark, sf)
    prof = C.profile(data, SCORES)
    posed = C.consensus_poses(C.rank_scores(data, SCORES, rows=prof.rows), SCORES, prof)
    top = C.top_n(C.best_pose(posed, SCORES), 10)
    return rounded(top.select("target", "ligand", "best_pose", "ecr_score", "rank"), "ecr_score")


@query("top_fraction", ECR_FIRST + """
SELECT target, ligand, best_pose, ecr_score, rank FROM (
  SELECT target, ligand, pose AS best_pose, round(ecr_total, 9) AS ecr_score,
    CAST(row_number() OVER (PARTITION BY target ORDER BY ecr_total DESC, ligand) AS BIGINT) AS rank,
    count(*) OVER (PARTITION BY target) AS n
  FROM best) r WHERE rank <= greatest(1, ceil(n * CAST(0.15 AS DOUBLE)))""")
def top_fraction(spark, sf):
    data = poses(spark, sf)
    prof = C.profile(data, SCORES)
    posed = C.consensus_poses(C.rank_scores(data, SCORES, rows=prof.rows), SCORES, prof)
    top = C.top_fraction(C.best_pose(posed, SCORES), 0.15, rows=prof.rows)
    return rounded(top.select("target", "ligand", "best_pose", "ecr_score", "rank"), "ecr_score")


@query("best_pose_by_score", f"""WITH {POSES}
SELECT target, ligand, pose, score_cnnaffinity FROM (
  SELECT *, row_number() OVER (PARTITION BY target, ligand ORDER BY score_cnnaffinity, pose) AS rn
  FROM poses WHERE score_cnnaffinity IS NOT NULL) x WHERE rn = 1""")
def best_pose_by_score(spark, sf):
    return C.best_by_score(poses(spark, sf), "cnnaffinity")


REFINED = f"""{POSES},
refined AS (SELECT target, ligand, pose, -score_deltalinf9xgb / 6.0 AS refined_cnnscore,
  -score_cnnaffinity + (pose - 2) * CAST(0.2 AS DOUBLE) AS refined_cnnaffinity,
  CASE WHEN pose = 3 THEN NULL ELSE score_vina * CAST(1.05 AS DOUBLE) END AS refined_vina,
  -score_cnnaffinity AS original_cnnaffinity, score_vina AS original_vina FROM poses),
parts AS (SELECT *,
  CASE WHEN refined_cnnscore IS NULL THEN CAST(0 AS DOUBLE) ELSE CAST(0.3 AS DOUBLE) END AS w1,
  CASE WHEN refined_cnnaffinity IS NULL THEN CAST(0 AS DOUBLE) ELSE CAST(0.3 AS DOUBLE) END AS w2,
  CASE WHEN refined_vina IS NULL THEN CAST(0 AS DOUBLE) ELSE CAST(0.4 AS DOUBLE) END AS w3,
  coalesce(refined_cnnscore, 0) AS v1,
  greatest(0.0, least(1.0, coalesce(refined_cnnaffinity, 0) / 10.0)) AS v2,
  greatest(0.0, least(1.0, coalesce(-refined_vina, 0) / 12.0)) AS v3 FROM refined),
combined AS (SELECT *, CASE WHEN w1 + w2 + w3 = 0 THEN 0.0
  ELSE (w1 * v1 + w2 * v2 + w3 * v3) / (w1 + w2 + w3) END AS combined_score FROM parts)"""


def refined(spark, sf):
    data = poses(spark, sf)
    return data.select(
        "target", "ligand", "pose",
        (-F.col("score_deltalinf9xgb") / 6.0).alias("refined_cnnscore"),
        (-F.col("score_cnnaffinity") + (F.col("pose") - 2) * 0.2).alias("refined_cnnaffinity"),
        F.when(F.col("pose") != 3, F.col("score_vina") * 1.05).alias("refined_vina"),
        (-F.col("score_cnnaffinity")).alias("original_cnnaffinity"),
        F.col("score_vina").alias("original_vina"))


@query("refine_combined_score", f"""WITH {REFINED}
SELECT target, ligand, round(combined_score, 9) AS combined_score,
  round(refined_vina - original_vina, 9) AS delta_vina,
  round(refined_cnnaffinity - original_cnnaffinity, 9) AS delta_cnnaffinity,
  CAST(row_number() OVER (PARTITION BY target ORDER BY round(combined_score, 9) DESC, ligand)
    AS BIGINT) AS refinement_rank
FROM combined WHERE pose = 1""")
def refine_combined_score(spark, sf):
    first = refined(spark, sf).filter("pose = 1")
    scored = first.select(
        "target", "ligand", "refined_vina", "original_vina", "refined_cnnaffinity",
        "original_cnnaffinity", "refined_cnnscore")
    ranked = C.rank_refinement(scored)
    return rounded(ranked.select("target", "ligand", "combined_score", "delta_vina",
                                 "delta_cnnaffinity", "refinement_rank"),
                   "combined_score", "delta_vina", "delta_cnnaffinity")


@query("refinement_gain", f"""WITH {REFINED}
SELECT target, count(*) AS refined,
  CAST(count(*) FILTER (WHERE refined_vina - original_vina < -0.1) AS BIGINT) AS vina_improved,
  CAST(count(*) FILTER (WHERE refined_cnnaffinity - original_cnnaffinity > 0.1) AS BIGINT)
    AS affinity_improved
FROM combined GROUP BY target""")
def refinement_gain(spark, sf):
    deltas = refined(spark, sf).select(
        "target", (F.col("refined_vina") - F.col("original_vina")).alias("delta_vina"),
        (F.col("refined_cnnaffinity") - F.col("original_cnnaffinity")).alias("delta_cnnaffinity"))
    return C.refinement_gain(deltas)
