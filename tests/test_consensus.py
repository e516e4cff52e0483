"""Consensus ranking on hand rows: golden example, ties, NULLs, weights."""

import math

import pytest
from pyspark.sql import functions as F

from screenmeld import catalog
from screenmeld.operators import consensus as C

GOLDEN = [("ligA", 1, -9.0, -0.90), ("ligA", 2, -8.0, -0.70), ("ligB", 1, -9.5, -0.40),
          ("ligB", 2, -7.0, None), ("ligC", 1, -8.5, -0.95), ("ligC", 2, -6.0, -0.10)]
SCHEMA = "target string, ligand string, pose int, score_vina double, score_cnnscore double"
SCORES = ["vina", "cnnscore"]


@pytest.fixture(scope="module")
def golden(spark):
    return spark.createDataFrame([("t", *r) for r in GOLDEN], SCHEMA)


def test_golden_example(golden):
    prof = C.profile(golden, SCORES)
    posed = C.consensus_poses(C.rank_scores(golden, SCORES, rows=prof.rows), SCORES, prof)
    got = {(r["ligand"], r["pose"]): round(r["ecr_total"], 4) for r in posed.collect()}
    assert got == {("ligA", 1): 0.2636, ("ligA", 2): 0.1024, ("ligB", 1): 0.2915,
                   ("ligB", 2): 0.0178, ("ligC", 1): 0.3244, ("ligC", 2): 0.0270}
    ranked = C.rerank(golden, SCORES).orderBy("ecr_rank").collect()
    assert [r["ligand"] for r in ranked] == ["ligC", "ligB", "ligA"]
    assert [r["best_pose"] for r in ranked] == [1, 1, 1]


def test_split_ranks_equal_plain(golden, spark, tiny_tasks):
    spark.conf.set("spark.screenmeld.rowsPerTask", "2")
    split = sorted(C.rerank(golden, SCORES).collect())
    spark.conf.set("spark.screenmeld.rowsPerTask", "1000")
    assert split == sorted(C.rerank(golden, SCORES).collect())


def test_rank_ties(spark):
    df = spark.createDataFrame([("t", "b", 1, -1.0, None), ("t", "a", 1, -1.0, None),
                                ("t", "c", 1, -0.5, None)], SCHEMA)
    first = {r["ligand"]: r["rank_vina"] for r in C.rank_scores(df, ["vina"], "first").collect()}
    least = {r["ligand"]: r["rank_vina"] for r in C.rank_scores(df, ["vina"], "min").collect()}
    assert first == {"a": 1, "b": 2, "c": 3}
    assert least == {"a": 1, "b": 1, "c": 3}


def test_function_without_data_is_left_out(spark):
    df = spark.createDataFrame([("t", "a", 1, -2.0, None), ("t", "b", 1, -1.0, None)], SCHEMA)
    prof = C.profile(df, SCORES)
    posed = C.consensus_poses(C.rank_scores(df, SCORES), SCORES, prof).orderBy("ligand").collect()
    # two poses, fraction 4: sigma has a floor of 1; vina alone carries the weight
    assert posed[0]["ecr_total"] == pytest.approx(math.exp(-1))
    assert posed[1]["ecr_total"] == pytest.approx(math.exp(-2))


def test_no_score_at_all(spark):
    df = spark.createDataFrame([("t", "a", 1, None, None)], SCHEMA)
    row = C.rerank(df, SCORES).collect()[0]
    assert (row["ecr_score"], row["ecr_rank"], row["score_vina_best"]) == (0.0, 1, None)


def test_sigma_counts_all_poses(golden):
    row = C.consensus_poses(C.rank_scores(golden, ["cnnscore"]), ["cnnscore"],
                            C.profile(golden, ["cnnscore"]))
    best = row.agg(F.max("ecr_total")).first()[0]
    assert best == pytest.approx(math.exp(-1 / 1.5))  # 6 poses, one of them without a value


def test_weights():
    assert catalog.consensus_weights(["vina", "ad4"], {"vina": 3, "ad4": 1}) == {"vina": .75, "ad4": .25}
    assert catalog.consensus_weights(["vina", "ad4"], {"vina": 0}) == {"vina": .5, "ad4": .5}
    assert catalog.consensus_weights(["vina", "ad4"], {"vina": -1, "ad4": 2}, strict=False)["ad4"] == 1
    with pytest.raises(ValueError):
        catalog.consensus_weights(["vina"], {"vina": -1})
    assert catalog.weights_from_text("vina=0.2, cnnscore=0.5") == {"vina": 0.2, "cnnscore": 0.5}
    for bad in ("vina", "nope=1", "vina=x"):
        with pytest.raises(ValueError):
            catalog.weights_from_text(bad)
    with pytest.raises(ValueError):
        catalog.active_scores({"vina_enabled": False})
    assert catalog.active_scores({"ad4_enabled": True}) == ["ad4"]


def test_scenarios_match_single_runs(golden):
    sets = {"equal": None, "heavy": {"vina": 3.0, "cnnscore": 1.0}}
    many = C.rerank_scenarios(golden, SCORES, sets)
    for name, w in sets.items():
        one = C.rerank(golden, SCORES, w).select("ligand", "ecr_score", "ecr_rank")
        got = many.filter(F.col("scenario") == name).select("ligand", "ecr_score", "ecr_rank")
        assert sorted(got.collect()) == sorted(one.collect())


def test_direction_and_finite(spark):
    df = spark.createDataFrame([(1.0, float("nan")), (float("inf"), 2.0)],
                               "score_cnnscore double, score_vina double")
    clean = catalog.finite(df).collect()
    assert [tuple(r) for r in clean] == [(1.0, None), (None, 2.0)]
    turned = catalog.correct_direction(df).first()
    assert turned["score_cnnscore"] == -1.0
    assert catalog.restore_raw(catalog.correct_direction(df)).first()["score_cnnscore"] == 1.0


def test_catalogue_tables(spark):
    assert catalog.score_catalog(spark).count() == 8
    known = {r["key"] for r in catalog.score_catalog(spark).collect()}
    used = catalog.experiments(spark).select(F.explode("scores").alias("k")).collect()
    assert {r["k"] for r in used} <= known


def test_top_lists(spark):
    rows = [("t", f"l{i}", str(i / 10)) for i in range(10)] + [("t", "bad", "n/a")]
    df = spark.createDataFrame(rows, "target string, ligand string, ecr_score string")
    assert [r["ligand"] for r in C.top_n(df, 2).orderBy("rank").collect()] == ["l9", "l8"]
    assert C.top_n(df, 2000).orderBy("rank").collect()[-1]["ligand"] == "l0"
    num = df.filter("ligand <> 'bad'").withColumn("ecr_score", F.col("ecr_score").cast("double"))
    assert C.top_fraction(num, 0.15).count() == 2
    assert C.top_fraction(num, 0.01).count() == 1
    with pytest.raises(ValueError):
        C.top_fraction(num, 0.0)


def test_refinement_score(spark):
    df = spark.createDataFrame([(0.5, 5.0, -6.0), (None, 20.0, None), (None, None, None),
                                (None, None, 3.0)], "s double, a double, v double")
    got = [r[0] for r in df.select(C.refinement_score(F.col("s"), F.col("a"), F.col("v"))).collect()]
    assert got == pytest.approx([0.5, 1.0, 0.0, 0.0])


def test_ranks_and_top_lists_agree_at_every_size(spark):
    from screenmeld.operators import consensus as C
    rows = [("t", f"l{i % 7}", 1 + i % 2, float(i % 5) if i % 11 else float("nan")) for i in range(120)]
    poses = spark.createDataFrame(rows, "target string, ligand string, pose int, score_vina double")
    ligands = spark.createDataFrame(
        [("t" if i % 3 else None, f"l{i:04d}", [None, float("nan"), -0.0, float(i % 40)][i % 4]) for i in range(1500)],
        "target string, ligand string, ecr_score double")
    seen = []
    for size in ("1000000", "10"):
        spark.conf.set("spark.screenmeld.rowsPerTask", size)
        try:
            ranks = sorted(r.rank_vina for r in C.rank_scores(poses, ["vina"]).collect())
            tops = [C.top_n(ligands, n) for n in (1000, 1001)]
            lists = [sorted((str(r.target), r["rank"], r.ligand) for r in t.collect() if r["rank"] <= 400) for t in tops]
            assert lists[0] == lists[1] and tops[0].schema["rank"].dataType == tops[1].schema["rank"].dataType
            seen.append((ranks, lists))
        finally:
            spark.conf.unset("spark.screenmeld.rowsPerTask")
    assert seen[0] == seen[1] and seen[0][0] == list(range(1, 121))


def test_a_column_of_the_user_is_ranked(spark):
    from screenmeld.operators import consensus as C
    mine = catalog.register(catalog.Score("mine", "Mine", False, "user", source="my_docking"))
    assert catalog.register(mine) is mine
    poses = spark.createDataFrame([("t", "a", 1, -3.0, -1.0), ("t", "b", 1, -2.0, -9.0), ("t", "c", 1, -1.0, None)],
                                  "target string, ligand string, pose int, my_docking double, score_vina double")
    got = {r.ligand: (r.rank_mine, r.rank_vina) for r in C.rank_scores(poses, ["mine", "vina"]).collect()}
    assert got == {"a": (1, 2), "b": (2, 1), "c": (3, None)}
    top = C.rerank(poses, ["mine"]).orderBy("ecr_rank").first()
    assert top.ligand == "a"


def test_refinement_scores_equal_on_paper_go_by_ligand(spark):
    rows = [("t", "b", 0.1 + 0.2), ("t", "a", 0.3), ("t", "c", 0.4)]
    none = F.lit(None).cast("double")
    df = spark.createDataFrame(rows, "target string, ligand string, refined_cnnscore double").select(
        "*", *[none.alias(c) for c in ("refined_cnnaffinity", "refined_vina", "original_cnnaffinity", "original_vina")])
    got = {r["ligand"]: r["refinement_rank"] for r in C.rank_refinement(df).collect()}
    assert got == {"c": 1, "a": 2, "b": 3}
