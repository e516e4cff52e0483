"""Run state, reports, properties, audits, scoring, sinks and streaming."""

import json
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from screenmeld import sinks
from screenmeld.operators import audit as A
from screenmeld.operators import consensus as C
from screenmeld.operators import properties as Y
from screenmeld.operators import reconcile as R
from screenmeld.operators import report as O
from screenmeld.operators import scoring as G
from screenmeld.streaming import ingest as I


def df(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_remaining_and_completed_make_the_library(spark):
    lib = df(spark, "target string, ligand string", *[("t", f"l{i}") for i in range(9)])
    files = lib.filter("ligand IN ('l1', 'l2')")
    log = df(spark, "target string, ligand string, energy double", ("t", "l2", -1.0), ("t", "l3", None))
    done = R.completed_union(files, log)
    assert {r["ligand"]: r["energy"] for r in done.collect()} == {"l1": None, "l2": -1.0, "l3": None}
    left = R.remaining(lib, done)
    assert left.count() + done.count() == lib.count()


def test_chunk_merge(spark):
    chunks = df(spark, "target string, ligand string, success boolean, best_energy_kcal_mol double, error string, "
                       "file string, line int",
                ("t", "a", True, -7.0, None, "chunk0001", 1), ("t", "a", False, None, "x", "chunk0002", 1),
                ("t", "", True, -1.0, None, "chunk0002", 2))
    older = df(spark, "target string, ligand string, success boolean, best_energy_kcal_mol double, error string, "
                      "file string, line int", ("t", "a", True, -1.0, None, "zzz", 9), ("t", "b", True, -2.0, None, "zzz", 9))
    got = {r["ligand"]: r["success"] for r in R.merge_chunks(chunks, older).collect()}
    assert got == {"a": False, "b": True}


def test_result_order_and_sinks(spark, tmp_path):
    res = df(spark, "ligand string, success boolean, best_energy_kcal_mol double, error string, target string",
             ("c", True, None, None, "t"), ("a", True, -7.0, None, "t"), ("f", False, -9.0, "x", "t"),
             ("b", True, -8.0, None, "t"))
    assert [r["ligand"] for r in R.in_result_order(res).collect()] == ["b", "a", "c", "f"]
    assert [r["ligand"] for r in R.best_successes(res).collect()] == ["b", "a"]
    sinks.write_docking_results(res, str(tmp_path / "d"))
    back = spark.read.option("header", True).csv(str(tmp_path / "d"))
    assert back.columns == list(sinks.DOCKING_COLUMNS) and back.count() == 4


def test_block_checkpoint_replaces_only_its_block(spark, tmp_path):
    path = str(tmp_path / "blocks")
    one = df(spark, "ligand string, score_vina double, target string, block int", ("a", -1.0, "t", 0), ("b", -2.0, "t", 1))
    sinks.write_blocks(one, path)
    sinks.write_blocks(one.filter("block = 1").withColumn("score_vina", F.lit(-9.0)), path)
    got = {r["ligand"]: r["score_vina"] for r in spark.read.parquet(path).collect()}
    assert got == {"a": -1.0, "b": -9.0}


def test_pose_and_ligand_sinks(spark, tmp_path):
    poses = df(spark, "target string, ligand string, pose int, score_vina double, score_cnnscore double",
               ("t", "b_d", 1, -7.12345, None), ("t", "a_a", 1, -8.0, -0.5), ("u", "c", 1, -1.0, -0.1))
    prof = C.profile(poses, ["vina", "cnnscore"])
    posed = C.consensus_poses(C.rank_scores(poses, ["vina", "cnnscore"]), ["vina", "cnnscore"], prof)
    rows = sinks.pose_csv_rows(posed)
    assert len(rows.columns) == 28  # 27 columns and the target folder
    sinks.write_sorted_csv(rows, str(tmp_path / "poses"), ["ligand", "pose"])
    text = "".join(f.read_text() for f in sorted((tmp_path / "poses" / "target=t").glob("*.csv")))
    assert text.index("a_a,1,-8.0000") < text.index("b_d,1," + f"{-7.12345:.4f}")
    ranked = C.rerank(poses, ["vina", "cnnscore"])
    active = {r["ligand"]: r["active"] for r in sinks.ligand_csv_rows(ranked).collect()}
    assert active == {"a_a": 1, "b_d": 0, "c": None}
    sinks.write_ranking(ranked, str(tmp_path / "rank"), ["vina", "cnnscore"], {"vina": 0.5, "cnnscore": 0.5}, 4)
    meta = sinks.read_ranking_meta(spark, str(tmp_path / "rank")).first()
    assert meta["sigma_fraction"] == 4.0 and meta["weights"] == {"vina": 0.5, "cnnscore": 0.5}
    assert "score_vina_best" in sinks.rerank_csv_rows(ranked, ["vina"]).columns
    assert len(sinks.refinement_csv_rows(ranked).columns) == 15
    assert sinks.partial_csv_rows(poses).filter("ligand = 'b_d'").first()["score_vina"] == "-7.123450"


def test_combined_poses(spark, tmp_path):
    poses = df(spark, "target string, ligand string, ecr_rank int, refined_rank int, refined_vina double, body string",
               ("t", "x", 4, 2, None, "MODEL 1\nATOM x\nENDMDL"), ("t", "y", 1, 1, -7.5, "ATOM y"))
    sinks.write_combined_poses(poses, str(tmp_path / "p"))
    text = "".join(f.read_text() for f in sorted((tmp_path / "p" / "target=t").glob("*.txt")))
    assert text.splitlines()[:6] == ["MODEL     1", "REMARK  LIGAND: y", "REMARK  ECR_RANK: 1", "REMARK  REFINED_RANK: 1",
                                     "REMARK VINA RESULT:    -7.500      0.000      0.000", "ATOM y"]
    assert text.count("ENDMDL") == 2
    sinks.write_json(poses.select("target", "ligand"), str(tmp_path / "j"))
    lines = "".join(f.read_text() for f in (tmp_path / "j").glob("*.txt")).splitlines()
    assert sorted(json.loads(x)["ligand"] for x in lines) == ["x", "y"]
    sinks.write_csv(poses, str(tmp_path / "c"), sep=";")
    sinks.write_table(poses, str(tmp_path / "q"))


def test_progress(spark):
    lib = df(spark, "target string, ligand string", ("a", "1"), ("a", "2"), ("b", "3"))
    states = df(spark, "target string, ligand string, state string", ("a", "1", "done"), ("a", "2", "failed"), ("a", "9", "done"))
    got = {r["target"]: (r["expected"], r["handled"], r["remaining"]) for r in R.progress(lib, states).collect()}
    assert got == {"a": (2, 2, 0), "b": (1, 0, 1), "TOTAL": (3, 2, 1)}


def test_block_progress_sees_changed_block_size(spark):
    files = df(spark, "target string, ligand string", *[("t", f"l{i}") for i in range(10)])
    saved = df(spark, "target string, block long, ligand string", *[("t", 0, f"l{i}") for i in range(3)], ("t", 7, "l9"))
    row = R.block_progress(files, saved, 4).filter("target = 't'").first()
    assert (row["blocks"], row["done"], row["remaining"], row["stale"], row["inconsistent"]) == (3, 0, 3, 1, 1)
    row = R.block_progress(files, saved, 3).filter("target = 't'").first()
    assert (row["blocks"], row["done"], row["inconsistent"]) == (4, 1, 0)


def test_coverage_gate(spark):
    parts = df(spark, "target string, block int, score_vina double, score_ad4 double",
               *[("t", 0, None, -1.0)] * 10, *[("t", 1, -1.0, None)], *[("t", 1, -1.0, -1.0)] * 9)
    got = {(r["block"], r["score"]): r["passed"] for r in R.coverage(parts, ["vina", "ad4"], 0.95).collect()}
    assert got == {(0, "vina"): True, (0, "ad4"): True, (1, "vina"): True, (1, "ad4"): False}
    good, bad = R.gated_blocks(parts, ["vina", "ad4"], 0.95)
    assert (good.count(), bad.count()) == (10, 10)


def test_config_audit_rules(spark):
    rows = [("r", "UNIDOCK", "search_mode", "slow"), ("r", "UNIDOCK", "batch_size", "9000"),
            ("r", "RESCORE", "vinardo_enabled", "true"), ("r", "RESCORE", "cnnscore_enabled", "true"),
            ("r", "RESCORE", "gnina_binary", "/g"), ("r", "REFINEMENT", "enabled", "1"),
            ("r", "REFINEMENT", "refinement_mode", "x"), ("s", "RESCORE", "vina_enabled", "no"), ("ok", "RESCORE", "x", "1")]
    got = {}
    for r in A.config_audit(spark.createDataFrame(rows, "run string, section string, key string, value string")).collect():
        got.setdefault(r["run"], set()).add(r["rule"])
    assert got == {"r": {"search_mode unknown", "batch larger than chunk", "empirical scores outweigh",
                         "refinement_mode unknown"}, "s": {"no active score"}}


def test_report_helpers(spark):
    rows = df(spark, "rank string, name string", ("10", "a"), ("x", "b"), ("2", "c"))
    assert [r["name"] for r in O.report_order(rows).collect()] == ["c", "a", "b"]
    assert O.report_order(rows, 1).count() == 1
    files = df(spark, "target string, ligand string, path string", ("t", "a1", "p2"), ("t", "a2", "p1"))
    got = O.guess_ligands(df(spark, "target string, value string", ("t", "a"), ("t", "q")), files).collect()
    assert {r["value"]: r["ligand"] for r in got} == {"a": "a1", "q": None}
    have, lack = O.with_pose_file(df(spark, "target string, ligand string", ("t", "a1"), ("t", "zz")), files)
    assert (have.count(), lack.first()["ligand"]) == (1, "zz")
    assert O.first_files(files, 1).first()["path"] == "p1"
    part = O.selection_table([df(spark, "ligand string, x int, rank int", ("a", 1, 1)), df(spark, "ligand string, y int", ("b", 2))])
    assert part.columns == ["rank", "ligand", "x", "y"]


@pytest.mark.parametrize("split", [False, True])
def test_guesses_equal_a_comparison_of_all(spark, split, request):
    if split:
        request.getfixturevalue("tiny_tasks")
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abé") for _ in range(rng.randint(1, n)))
    files = sorted({("hot" if rng.random() < 0.8 else "t", word(6)) for _ in range(150)} | {("hot", "ab" * 300)})
    asked = [("hot" if rng.random() < 0.8 else "t", k, rng.choice([f" {word(4)} ", word(7), "ab" * 299, "", None])) for k in range(120)]
    got = {r.k: r.ligand for r in O.guess_ligands(df(spark, "target string, k int, value string", *asked),
                                                  df(spark, "target string, ligand string", *files)).collect()}
    want = {k: min((x for s, x in files if s == t and v and v.strip() and x.startswith(v.strip())), default=None) for t, k, v in asked}
    assert got == want and sum(x is not None for x in want.values()) > 20


def test_records_and_unmatched(spark):
    files = df(spark, "series string, filename string", ("s", "0001_abc_docked.pdbqt"), ("s", "00_target.pdbqt"), ("s", "0002_x.pdbqt"))
    renames = df(spark, "new_name string, old_name string, mol_name string", ("0002_x.pdbqt", "orig_docked.pdbqt", "Real"))
    rec = O.pose_records(files, renames)
    assert {r["filename"]: r["mol_name"] for r in rec.collect()} == {"0001_abc_docked.pdbqt": "abc", "0002_x.pdbqt": "Real"}
    rows = df(spark, "series string, row int, file string, name string, rank int", ("s", 1, "orig_docked.pdbqt", "?", 9), ("s", 2, None, "ABC", 8),
              ("s", 3, "", "", 2))
    got = {r["row"]: (r["matched_file"], r["matched_by"]) for r in O.cascade_match(rows, rec).collect()}
    assert got == {1: ("0002_x.pdbqt", 1), 2: ("0001_abc_docked.pdbqt", 2), 3: ("0002_x.pdbqt", 3)}
    assert O.unmatched_records(O.cascade_match(rows, rec), rec).first()["file_rank"] == 1


def test_speedup_and_plateau(spark):
    runs = df(spark, "run int, gpus int, mode string, batch_size int, ligands_per_h double, exit int",
              (1, 1, "fast", 500, 100.0, 0), (2, 2, "fast", 500, 180.0, 0), (3, 1, "fast", 1000, 101.0, 0), (4, 1, "fast", 2000, 300.0, 1))
    got = {r["run"]: (r["speedup"], r["efficiency_pct"]) for r in O.speedup(runs).collect()}
    assert got[2] == (pytest.approx(1.8), pytest.approx(90.0))
    assert O.plateau_batch(runs.filter("gpus = 1"), 3.0).first()["batch_size"] == 500


def test_properties(spark):
    suffix = "drugbank_approved_percentile"
    mols = spark.createDataFrame([(600.0, 0.2, 0.9, 10.0, 90.0, None), (None, 0.7, 0.7, 10.0, 90.0, 0.1)],
                                 f"molecular_weight double, `NR-AR` double, `SR-p53` double, `NR-AR_{suffix}` double, "
                                 f"`SR-p53_{suffix}` double, CYP3A4_Veith double")
    rows = Y.with_summaries(mols).collect()
    assert [r["tox21_max"] for r in rows] == [0.9, 0.7]
    assert [r[f"tox21_max_{suffix}"] for r in rows] == [90.0, 10.0]  # a tie goes to the first column
    assert [r["tox21_n_above_0.5"] for r in rows] == [1, 2]
    assert [r["physchem_flags"] for r in rows] == ["MW > 500", ""]
    assert [r["cyp_inhibition_max"] for r in rows] == [None, 0.1]
    lit = Y.lights(mols, {"NR-AR": "down", "SR-p53": "ctx"}).first()
    assert (lit["light_NR-AR"], lit["light_SR-p53"]) == ("good", None)
    assert "hERG" in Y.missing_percentiles(mols.columns)
    good, bad = Y.broadcast_back(df(spark, "smiles string, n int", ("C", 1), ("C", 2), ("X", 3)), df(spark, "smiles string, v int", ("C", 7)))
    assert (good.count(), bad.first()["n"]) == (2, 3)


@pytest.fixture
def make_limited():
    def make():
        def run(batch):
            if len(batch) > 3:
                raise G.ResourceError("out of memory")
            if (batch["k"] == 7).any():
                raise ValueError("bad row")
            return pd.DataFrame({"v": batch["k"] * 2.0})
        return run
    return make


def test_halving_never_drops_rows(spark, make_limited):
    out = G.score_batches(spark.range(20).withColumnRenamed("id", "k").coalesce(1), make_limited, ["v"], 10, depth=4)
    rows = {r["k"]: (r["v"], r["status"]) for r in out.collect()}
    assert len(rows) == 20
    assert rows[0] == (0.0, "OK") and rows[7][1] == "ERROR"
    stuck = G.score_batches(spark.range(8).withColumnRenamed("id", "k").coalesce(1), make_limited, ["v"], 8, depth=0)
    assert {r["status"] for r in stuck.collect()} == {"ERROR"}


def test_timeout_status(spark):
    def make():
        def run(batch):
            raise TimeoutError("too slow")
        return run
    row = G.score_batches(spark.range(1), make, ["v"]).first()
    assert (row["status"], row["error"]) == ("TIMEOUT", "too slow")


def test_stream_names_across_runs(spark, tmp_path):
    src = str(tmp_path / "src")
    run = lambda: I.first_names(I.table_stream(spark, src, "name string"), str(tmp_path / "out"),
                                str(tmp_path / "cp")).awaitTermination()
    df(spark, "name string", ("a",), ("a",), ("b",)).coalesce(1).write.parquet(src)
    run()
    df(spark, "name string", ("b",), ("c",)).coalesce(1).write.mode("append").parquet(src)
    run()
    assert sorted(r["name"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_nan_counts_as_missing(spark):
    from screenmeld.operators import properties as Y
    nan = float("nan")
    row = spark.createDataFrame([(nan, 0.7, nan, 150.0)], "a double, b double, p double, w double")
    best = Y.with_maximum(row, ["a", "b"], "top").first()
    assert best.top == 0.7
    got = row.select(Y.count_above(["a", "b"]).alias("n"), Y.light(F.lit("up"), F.col("p")).alias("l"),
                     Y.light_by_value(F.col("p"), (1.0, 2.0)).alias("v"),
                     Y.light_by_value(F.col("w"), (1.0, 2.0)).alias("w")).first()
    assert (got.n, got.l, got.v, got.w) == (1, None, None, "risk")


def test_benchmark_duplicate_and_validation_rows(spark):
    from screenmeld import sinks
    runs = spark.createDataFrame([(1, 2, 0)], "run int, gpus int, exit int")
    row = sinks.benchmark_csv_rows(runs).first()
    assert tuple(row.asDict()) == sinks.BENCHMARK_COLUMNS and (row.run, row.gpus, row.wall_s) == ("1", "2", "")
    named = spark.createDataFrame([(0, "a", True), (1, "a", False)], "i int, name string, kept boolean")
    assert [r.value for r in sinks.duplicate_name_rows(named, "i", "name").collect()] == ["1\ta"]
    assert sinks.validation_csv_rows(named.limit(1)).first().kept == "true"
