"""Text sources, inventories and clustering on generated files."""

import gzip
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenmeld.functions import names as N
from screenmeld.functions import numbers as X
from screenmeld.operators import clustering as K
from screenmeld.operators.ordering import rank_rows
from screenmeld.session import ROWS_PER_TASK_KEY, stage
from screenmeld.sources import inventory as I
from screenmeld.sources import logs as L
from screenmeld.sources import molecules as M
from screenmeld.sources import poses as P
from screenmeld.sources import sections as S
from screenmeld.sources import tables as T
from screenmeld.sources import text

ATOM = "ATOM  {:5d} {:<4s} LIG A   1    {:8.3f}{:8.3f}{:8.3f}  1.00  0.00     0.000 {}"


def model(n, energy, xs, extra=""):
    atoms = [ATOM.format(i, f"C{i}", x, 0.0, 0.0, "C") for i, x in enumerate(xs, 1)]
    atoms.append(ATOM.format(9, "H9", 50.0, 50.0, 50.0, "HD"))
    return "\n".join([f"MODEL {n}", f"REMARK VINA RESULT:    {energy}      0.000      0.000", *filter(None, [extra]),
                      "ROOT", *atoms, "TORSDOF 2", "ENDMDL", ""])


@pytest.fixture(scope="module")
def results(tmp_path_factory):
    root = tmp_path_factory.mktemp("results")
    files = {
        "t1/a_docked.pdbqt": model(1, -9.0, [0, 1], "REMARK SMILES CC") + model(2, -8.5, [0.5, 1.5])
        + model(3, -8.0, [9, 10]),
        "t1/b_docked.pdbqt": "REMARK VINA RESULT:    -5.5  0.0  0.0\nROOT\n" + ATOM.format(1, "C1", 1, 2, 3, "C"),
        "t2/c_docked.pdbqt": "", "t2/d_docked.pdbqt": "MODEL 1\nATOM\nENDMDL\n",
        "t2/e_docked.pdbqt": model(1, -7.0, [0]) + "MODEL 2\nREMARK VINA RESULT:  -6.0",
        "t2/notes.txt": "x",
    }
    for name, body in files.items():
        path = root / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(body)
    return root


def test_pose_files(spark, results):
    files = P.pose_files(spark, str(results))
    energies = {(r["target"], r["ligand"], r["pose"]): r["energy"] for r in P.pose_energies(files).collect()}
    assert energies == {("t1", "a", 1): -9.0, ("t1", "a", 2): -8.5, ("t1", "a", 3): -8.0, ("t1", "b", 1): -5.5,
                        ("t2", "e", 1): -7.0, ("t2", "e", 2): -6.0}
    failed = {r["ligand"] for r in P.best_energy(files).filter("failed").collect()}
    assert failed == {"c", "d"}
    bodies = {(r["ligand"], r["pose"]): r["body"] for r in P.pose_bodies(files).collect()}
    # a file without MODEL is one pose, the open model of e is none
    assert set(bodies) == {("a", 1), ("a", 2), ("a", 3), ("b", 1), ("d", 1), ("e", 1)}
    assert "TORSDOF 2" in bodies["a", 1] and "MODEL" not in bodies["a", 1]
    smiles = {r["ligand"]: r["s"] for r in files.select("ligand", P.embedded_smiles(F.col("value")).alias("s")).collect()}
    assert smiles["a"] == "CC"


def test_heavy_atoms_skip_hydrogens(spark, results):
    atoms = P.pose_bodies(P.pose_files(spark, str(results))).withColumn("a", P.heavy_atoms(F.col("body")))
    got = {(r["ligand"], r["pose"]): [tuple(p) for p in r["a"]] for r in atoms.collect()}
    assert got["a", 2] == [(0.5, 0.0, 0.0), (1.5, 0.0, 0.0)]
    assert got["b", 1] == [(1.0, 2.0, 3.0)]


def test_compact_poses(spark, results, tmp_path):
    out = str(tmp_path / "compact")
    P.compact_poses(spark, str(results), out)
    assert spark.read.parquet(out).filter("target = 't1'").count() == 4


def brute_leaders(poses, cutoff):
    kept = []
    for energy, pose, xyz in sorted(poses):
        if all(np.sqrt(np.mean(np.sum((xyz[:len(o)] - o[:len(xyz)]) ** 2, axis=1))) >= cutoff for _, o in kept):
            kept.append((pose, xyz))
    return [p for p, _ in kept]


def test_leader_clustering(spark, results):
    files = P.pose_files(spark, str(results)).filter("ligand = 'a'")
    kept = K.cluster_poses(files, 2.0).orderBy("cluster_rank").collect()
    assert [r["pose"] for r in kept] == [1, 3]  # numbers of the original file
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for f in range(20):
        poses = [(float(e), i + 1, rng.normal(size=(4, 3))) for i, e in enumerate(rng.normal(size=7))]
        want[f] = brute_leaders(poses, 1.6)
        rows.append((f, [(e, p, [tuple(map(float, a)) for a in c]) for e, p, c in poses]))
    schema = "f int, poses array<struct<energy:double,pose:int,coords:array<struct<x:double,y:double,z:double>>>>"
    got = spark.createDataFrame(rows, schema).select("f", K.leaders(F.col("poses"), 1.6)["pose"].alias("p"))
    assert {r["f"]: r["p"] for r in got.collect()} == want


def test_clustering_keeps_all_without_coordinates(spark):
    schema = "poses array<struct<energy:double,pose:int,coords:array<struct<x:double,y:double,z:double>>>>"
    df = spark.createDataFrame([([(-1.0, 1, [(0.0, 0.0, 0.0)]), (-0.5, 2, [])],)], schema)
    assert df.select(K.leaders(F.col("poses"), 2.0)["pose"]).first()[0] == [1, 2]


def test_filtered_text(spark, results):
    files = P.pose_files(spark, str(results)).filter("ligand = 'a'").drop("path")
    kept = spark.createDataFrame([("t1", "a", 1), ("t1", "a", 3)], "target string, ligand string, pose int")
    value = K.filtered_text(files, kept, ("target", "ligand")).first()["value"]
    assert value.count("ENDMDL") == 2 and "-8.5" not in value


def test_verdicts_and_inventory(spark, results):
    got = {r["file"]: r["verdict"] for r in I.pose_verdicts(spark, str(results)).collect()}
    assert got == {"a_docked.pdbqt": "ok", "b_docked.pdbqt": "truncated", "c_docked.pdbqt": "empty",
                   "d_docked.pdbqt": "no energy remark", "e_docked.pdbqt": "truncated"}
    bad = {r["new_name"] for r in I.quarantine(I.pose_verdicts(spark, str(results))).collect()}
    assert "t2__c_docked.pdbqt" in bad and len(bad) == 4
    counts = {r["verdict"]: r["files"] for r in I.verdict_counts(I.pose_verdicts(spark, str(results))).collect()}
    assert counts["truncated"] == 2
    inv = I.inventory(spark, str(results), "*_docked.pdbqt")
    assert inv.count() == 5 and inv.filter("length = 0").count() == 1
    assert I.inventory(spark, str(results), "*_docked.pdbqt", "missing").count() == 5
    assert I.inventory(spark, str(results), "*_docked.pdbqt", "t1").count() == 2
    named = {r["stem"] for r in I.with_names(inv).collect()}
    assert "a_docked" in named


def test_recent_files(spark, results):
    old = results / "t1" / "a_docked.pdbqt"
    os.utime(old, (1_000_000_000, 1_000_000_000))
    assert I.recent_files(spark, str(results), 1.0).count() == 4


def test_sdf_records(spark, tmp_path):
    record = "{}\n  x\n\n  1  0\nM  END\n> <id>\n1\n\n$$$$\n"
    (tmp_path / "lib.sdf").write_text(record.format("one") + record.format("two") + "cut\n  x\n")
    with gzip.open(tmp_path / "more.sdf.gz", "wt") as fh:
        fh.write(record.format("three"))
    rows = M.sdf_records(spark, str(tmp_path / "*.sdf*"))
    assert {r["raw_name"] for r in rows.collect()} == {"one", "two", "three"}


def test_molecule_lists(spark, tmp_path):
    (tmp_path / "a.csv").write_text("# c\nmol1,CCO\n\nmol2,CC\n,CN\nmol4,\n")
    (tmp_path / "b.csv").write_text("Compound_ID;x;SMILES\nm;1;CCC\n")
    (tmp_path / "c.smi").write_text("CCO  ethanol\nC\tmethane extra\nCC\n")
    (tmp_path / "d.tsv").write_text("smiles\tlogp\nCCN\t1.0\n")
    rows = M.molecule_list(text.lines(spark, str(tmp_path)))
    got = {(os.path.basename(r["path"]), r["payload"]): r["raw_name"] for r in rows.collect()}
    # d.tsv names only one of the two columns, so its first row counts as data
    assert got == {("a.csv", "CCO"): "mol1", ("a.csv", "CC"): "mol2", ("a.csv", "CN"): "",
                   ("b.csv", "CCC"): "m", ("c.smi", "CCO"): "ethanol", ("c.smi", "C"): "methane",
                   ("c.smi", "CC"): "", ("d.tsv", "smiles"): "smiles", ("d.tsv", "CCN"): "CCN"}
    named = M.index_molecules(rows.withColumn("lib", F.lit("L")), F.lit("LIB 1_"))
    assert sorted(r["idx"] for r in named.collect()) == list(range(named.count()))
    explicit = M.molecule_list(text.lines(spark, str(tmp_path / "d.tsv")), "0", "1")
    assert {r["payload"] for r in explicit.collect()} == {"smiles", "CCN"}


def test_formats(spark):
    ok = spark.createDataFrame([("a.SDF.gz", "sdf"), ("b.smi", "smiles"), ("c.csv.gz", "smiles")], "p string, f string")
    assert ok.filter(M.detect_format(F.col("p")) != F.col("f")).count() == 0
    for bad in ("x.pdb", "x.xyz"):
        with pytest.raises(Exception):
            spark.createDataFrame([(bad,)], "p string").select(M.detect_format(F.col("p"))).collect()


def test_names(spark):
    def one(col):
        return spark.range(1).select(col).first()[0]
    lit = F.lit
    assert one(N.mol_key(lit("/p/0001_Drugs_mol_0022884_docked.pdbqt"))) == "drugsmol0022884"
    assert one(N.mol_key(lit("abc-pose3.sdf"))) == "abc"
    assert one(N.name_prefix(lit(" LIB 02_ "))) == "LIB_02"
    assert one(N.mol_name(lit("ä b/c"), lit(3))) == "ä_b_c"
    assert one(N.mol_name(lit("  "), lit(12), lit("L"))) == "L_mol_0000012"
    assert len(one(N.mol_name(lit("x" * 99), lit(1)))) == 60
    assert one(N.safe_label(lit("..ä.."))) == ".._.." and one(N.safe_label(lit("ää"))) == "unnamed"
    assert one(N.output_path(lit("m"), lit(20001))) == "0002/m.pdbqt"
    assert one(N.output_path(lit("m"), lit(1), flat=True)) == "m.pdbqt"
    assert one(N.extracted_name(lit(12345), lit("a_mol_7"), lit("t"), "ligand")) == "12345_mol_7.pdbqt"
    assert one(N.library_prefix(lit("/data/LIB 7/x.sdf"))) == "LIB_7"
    assert one(N.is_receptor_file(lit("x_RECEPTOR.pdbqt"))) is True
    assert tuple(one(N.pose_file_parts(lit("0007_ab_docked.PDBQT")))) == (7, "ab")
    assert N.match_header(["Rank", "ECR-Score"], "ecr") == "ECR-Score"
    assert N.match_header(["my pose col"], "pose") == "my pose col"
    assert N.match_header(["x"], "smiles") is None


def test_number_texts(spark):
    def one(col):
        return spark.range(1).select(col).first()[0]
    num = lambda v: one(X.report_number(F.lit(v)))
    assert [num(v) for v in (None, " ", "x", "0", "1.23456", "0.0001", "-2500000")] == \
        ["-", "-", "x", "0.000", "1.235", "1.000e-04", "-2.500e+06"]
    prop = lambda v: one(X.property_number(F.lit(v).cast("double")))
    assert [prop(v) for v in (None, 5.0, 1234.0, 123.456, 1.2345, 0.12345)] == \
        ["—", "5", "1234.00", "123.46", f"{1.2345:.3f}", f"{0.12345:.4f}"]
    assert one(X.duration_text(F.lit(3723.9))) == "1h02m03s" and one(X.duration_text(F.lit(63))) == "1m03s"
    assert one(X.duration_text(F.lit(9))) == "9s" and one(X.percent_text(F.lit(1.25))) == "1.2"
    assert one(X.count_text(F.lit(12345))) == "12,345" and one(X.count_text(F.lit(0))) == "—"
    assert one(X.breakable(F.lit("a" * 25))) == "a" * 12 + "​" + "a" * 12 + "​a"
    assert one(X.breakable(F.lit("a" * 24))).count("​") == 1
    assert one(X.eta_seconds(F.lit(5), F.lit(20), F.lit(10.0))) == 30.0
    assert one(X.truthy(F.lit(" JA "))) is True and one(X.number_or_null(F.lit("None"))) is None


def test_pocket_list(spark, tmp_path):
    (tmp_path / "p.txt").write_text("7, C\n#POCKET_1\n#rank, Smiles\n\n1, CCO\nx; y, CC, -8\n# other\n2\tCN\nalone\n"
                                    "#pocket\n5;CO\n")
    rows = text.lines_of(text.whole_files(spark, str(tmp_path)))
    got = [(r["pocket"], r["rank"], r["smiles"]) for r in S.pocket_entries(rows).orderBy("seq").collect()]
    assert got == [("UNASSIGNED", 7, "C"), ("POCKET_1", 1, "CCO"), ("POCKET_1", 3, "CC"),
                   ("POCKET_1", 2, "CN"), ("POCKET", 5, "CO")]
    assert [r["kind"] for r in S.pocket_rejects(rows).orderBy("seq").collect()] == ["unknown comment", "no separator"]


def test_target_config(spark, tmp_path):
    (tmp_path / "config.txt").write_text(
        "# all targets\nT1\nCENTER [1, 2.5, -3]\nBOX_SIZE [20,20,20]\n\nT2\nCENTER [0,0,0]\n\n"
        "T3\ncenter [1,1,1]\nBOX_SIZE = [9,9,9]\nLIGAND_SUBDIR = lib3\nT4\nCENTER [1,1,1]\nBOX_SIZE [1,1,1]\n")
    rows = text.lines_of(text.whole_files(spark, str(tmp_path)))
    blocks = S.target_blocks(rows)
    got = {r["target"]: (r["center"], r["ligand_subdir"], r["problem"]) for r in blocks.collect()}
    assert got["T1"] == ([1.0, 2.5, -3.0], None, None)
    assert got["T2"][2] == "missing: box_size"
    assert got["T3"] == ([1.0, 1.0, 1.0], "lib3", None) and got["T4"][2] is None
    have = spark.createDataFrame([("T1",), ("T4",)], "target string")
    assert {r["target"] for r in S.targets(blocks, have).collect()} == {"T1", "T4"}
    assert {r["target"] for r in S.targets_without_receptor(blocks, have).collect()} == {"T3"}


def test_manifest(spark, tmp_path):
    (tmp_path / "MANIFEST.txt").write_text("Job 1\nfree = 2\n[a]\nKey = x = y # c\n; none\n[b]\nkey=2\nw_vina = 0.5\n"
                                           "w_ad4=0\nvina_enabled = Yes\nsigma_fraction=4\n")
    pairs = S.settings(text.lines_of(text.whole_files(spark, str(tmp_path))))
    got = {(r["section"], r["key"]): r["value"] for r in pairs.collect()}
    assert got[("_GLOBAL", "free")] == "2" and got[("A", "key")] == "x = y" and got[("B", "key")] == "2"
    row = S.manifest_summary(pairs).first()
    assert row["weights"] == ["AutoDock Vina=0.5"] and row["active_scores"] == ["Vina"]
    assert (row["sigma_fraction"], row["clustering"], row["scoring"]) == ("4", "off", "-")


def test_run_log(spark, tmp_path):
    (tmp_path / "pipeline.log").write_text("\n".join([
        "[GPU 0] [1/9] early -9.9 kcal/mol", "x === TARGET 1/2: T1 ===", "[GPU 0] [1/9] a -7.1 kcal/mol",
        "[GPU 0] [2/9] b -7.2 kcal/mol FEHLER", "[GPU 0] [3/9] a -7.5 kcal/mol", "y === TARGET 2/2: T2 ===",
        "[GPU 1] [1/9] c 1-2 kcal/mol", "=== PIPELINE ENDE ===", "[GPU 1] [2/9] d -1.0 kcal/mol"]))
    rows = text.lines(spark, str(tmp_path))
    got = {(r["target"], r["ligand"]): r["energy"] for r in L.completed_from_log(rows).collect()}
    assert got == {("T1", "a"): -7.5, ("T2", "c"): None}


def test_scorer_output(spark, tmp_path):
    (tmp_path / "o.txt").write_text("## x\nAffinity: -6.5 (kcal/mol)\nCNNscore: 0.5\nCNNaffinity: 6.4\n"
                                    "Affinity: -5 0.1\nCNNscore: 1.5\nCNNaffinity: 9\nAffinity: bad\n")
    rows = L.scorer_poses(text.lines(spark, str(tmp_path))).orderBy("pose").collect()
    assert [(r["pose"], r["affinity"], r["cnnscore"], r["cnnaffinity"]) for r in rows] == [
        (1, -6.5, 0.5, 6.4), (2, -5.0, None, None), (3, None, None, None)]


def test_scorer_lines_are_counted_by_piece(spark, monkeypatch, tiny_tasks):
    """A file of many pieces and blocks gets the numbers of one window, without sampled ranges."""
    from screenmeld.operators import ordering
    from screenmeld.sources import records

    monkeypatch.setattr(records, "PIECE_BITS", 4)
    monkeypatch.setattr(ordering, "_sample_ranges", lambda *a: pytest.fail("ranges were sampled"))
    rows = [(f"p{k % 2}", k // 100, k, text.format(k)) for k in range(400)
            for text in [("Affinity: -{}.5 (kcal/mol)", "CNNscore: 0.{}", "CNNaffinity: {}.5")[k // 2 % 3]]]
    got = sorted(L.scorer_poses(spark.createDataFrame(rows, "path string, block long, seq long, value string")).collect())
    want = [(f"p{o}", i + 1, -(6 * i + o + 0.5), float(f"0.{6 * i + o + 2}"), 6 * i + o + 4.5 if 6 * i + o + 4 < 400 else None)
            for o in (0, 1) for i in range(67) if 6 * i + o < 400]
    assert [tuple(r) for r in got if r.pose < 66] == [w for w in want if w[1] < 66]


def test_scorer_poses_that_cross_pieces_and_blocks(spark, monkeypatch, tiny_tasks):
    """Lines are read and written once: a pose takes what follows in later pieces and blocks, up to the next opening."""
    from screenmeld.sources import records

    monkeypatch.setattr(records, "PIECE_BITS", 1)
    staged = []
    monkeypatch.setattr(L, "stage", lambda df, name: staged.append((name, df.columns)) or stage(df, name))
    lines = ["CNNscore: 0.9", "Affinity: -1.5 (kcal/mol)", "CNNscore: 0.1", "note", "CNNscore: 0.2", "note", "CNNaffinity: 5",
             "note", "CNNscore: bad", " CNNaffinity: 6\r", "Affinity: -2\t0.1", "Affinity: bad", "note", "see CNNscore: 0.4",
             "CNNscore: 0.5", "CNNaffinity: 7", "Affinity:", "CNNscore: 1.5", "CNNaffinity: 8", "Affinity: -3", "CNNscore: 0.3"]
    rows = [(p, k // 5, k, line) for p in ("a", "b", None) for k, line in enumerate(lines)]
    rows += [("c", 0, k, "CNNscore: 0.5") for k in range(9)]
    data = spark.createDataFrame(rows, "path string, block long, seq long, value string")
    want = [(1, -1.5, 0.2, 6.0), (2, -2.0, None, None), (3, None, 0.5, 7.0), (4, None, None, None), (5, -3.0, 0.3, None)]
    got = [tuple(r) for r in L.scorer_poses(data).orderBy("path", "pose").collect()]
    assert got == [(p, *w) for p in (None, "a", "b") for w in want]
    assert [n for n, _ in staged] == ["poses", "pieces"] and not any("value" in c for _, c in staged)
    plain = L.scorer_poses(data, 1)
    assert [tuple(r) for r in plain.orderBy("path", "pose").collect()] == got


def test_scorer_query_ranks_lines_in_blocks(spark, monkeypatch, tiny_tasks):
    """The largest group that is ordered is a block of a file, and its lines aren't dealt again."""
    from screenmeld.plans import texts

    sf, bounds = "/root/testdata/sf0.001", []
    monkeypatch.setattr(texts, "ORDERS_PER_BLOCK", 4)
    monkeypatch.setattr(texts, "rank_rows", lambda *a, **k: bounds.append(a[5]) or rank_rows(*a, **k))
    got = sorted(map(tuple, texts.scorer_poses(spark, sf).collect()), key=str)
    assert bounds[0].largest <= 25
    spark.conf.unset(ROWS_PER_TASK_KEY)
    assert got == sorted(map(tuple, texts.scorer_poses(spark, sf).collect()), key=str)


def test_refinement_output(spark):
    rows = [(1, "Affinity: -7.2 (kcal/mol)\nCNNscore: 0.8\nCNNaffinity: 7.5\n"), (2, "  1   -7.2  0.0  0.82  7.5\n"),
            (3, "Affinity: -7.2 (kcal/mol)\n"), (4, "")]
    got = {r["id"]: (r["vina"], r["cnnscore"], r["cnnaffinity"], r["ok"]) for r in
           L.refinement_outputs(spark.createDataFrame(rows, "id int, value string")).collect()}
    assert got == {1: (-7.2, 0.8, 7.5, True), 2: (-7.2, 0.82, 7.5, True), 3: (-7.2, None, None, False),
                   4: (None, None, None, False)}


def test_tables(spark, tmp_path):
    (tmp_path / "top.csv").write_text("Rank;Ligand;ECR_Score\n1;a;0.5\n")
    df, cols = T.sniffed_csv(spark, str(tmp_path / "top.csv"))
    assert (cols["rank"], cols["name"], cols["ecr"], cols["vina"]) == ("Rank", "Ligand", "ECR_Score", None)
    assert T.resolve_columns(df).first()["ecr"] == "0.5"
    part = tmp_path / "partials"
    part.mkdir()
    (part / "scores_00000.csv").write_text("ligand,pose,score_vina,score_ad4\na,1,-7.5,\n")
    (part / "scores_00001.csv").write_text("pose,ligand,score_cnnscore\n2,b,0.5\n")
    got = {r["ligand"]: (r["pose"], r["score_vina"], r["score_ad4"], r["score_cnnscore"]) for r in
           T.partial_scores(text.lines(spark, str(part))).collect()}
    assert got == {"a": (1, -7.5, None, None), "b": (2, None, None, 0.5)}
    (tmp_path / "dock.csv").write_text("ligand,success,best_energy_kcal_mol,error\na,True,-7,\nb,0,None,oops\n")
    rows = T.docking_results(spark, str(tmp_path / "dock.csv")).orderBy("ligand").collect()
    assert [tuple(r) for r in rows] == [("a", True, -7.0, None), ("b", False, None, "oops")]
    (tmp_path / "rename_map.csv").write_text("old_name;new_name\nx;y\nz;\n")
    assert [tuple(r) for r in T.rename_map(spark, str(tmp_path / "rename_map.csv")).collect()] == [("y", "x", None)]
    (tmp_path / "gpu.csv").write_text("0, 50, 1000, 300.5\n1, 70, 2000, 310.5\n")
    row = T.telemetry(spark, str(tmp_path / "gpu.csv")).agg(F.avg("util"), F.max("mem")).first()
    assert tuple(row) == (60.0, 2000.0)


def test_pose_numbers_and_lines_outside_models(spark):
    from screenmeld.sources import poses as P
    text = ("REMARK before\nMODEL 1\nREMARK VINA RESULT:    -.5  0 0\nATOM a\nENDMDL\nREMARK between\n"
            "MODEL 2\nREMARK VINA RESULT: none\nATOM b\nENDMDL\nMODEL 3\nREMARK VINA RESULT: -7.25 0 0\nENDMDL\ntail")
    files = spark.createDataFrame([("f", text)], "path string, value string")
    assert [(r.pose, r.energy) for r in P.pose_energies(files).collect()] == [(1, -0.5), (3, -7.25)]
    bodies = [r.body for r in P.pose_bodies(files).orderBy("pose").collect()]
    assert len(bodies) == 3 and not any("between" in b or "before" in b or "tail" in b for b in bodies)
    assert bodies[1] == "REMARK VINA RESULT: none\nATOM b"


def test_weight_texts_of_any_precision(spark):
    from screenmeld.catalog import decode_weights
    df = spark.createDataFrame([("A=0.125/B=12.00/C=0.3333",)], "w string")
    assert df.select(decode_weights(F.col("w")).alias("m")).first().m == {"A": 0.125, "B": 12.0, "C": 0.3333}


def test_sniffed_files_have_their_own_layouts(spark, tmp_path):
    from screenmeld.sources import tables as T
    top = tmp_path / "top"
    top.mkdir()
    (top / "a.csv").write_text('Rank;Ligand;ECR_Score\n1;"x;1";0.5\n\n2;y;\n')
    (top / "b.csv").write_text('ECR_Score,extra,Rank,Ligand\n0.25,"q,r",3,z\n')
    (top / "c.csv").write_text("Ligand\tRank\nRank\t4\n")
    df, cols = T.sniffed_csv(spark, str(top))
    assert df.columns == ["Rank", "Ligand", "ECR_Score", "extra"]
    assert sorted(tuple(r) for r in df.collect()) == [
        ("1", "x;1", "0.5", None), ("2", "y", None, None), ("3", "z", "0.25", "q,r"), ("4", "Rank", None, None)]
    assert (cols["rank"], cols["name"], cols["ecr"], cols["vina"]) == ("Rank", "Ligand", "ECR_Score", None)
    assert sorted(r["ecr"] or "" for r in T.resolve_columns(df).collect()) == ["", "", "0.25", "0.5"]
    (top / "d.csv").write_text("Molecule,rank\nw,5\n")
    rows = T.resolve_columns(T.sniffed_csv(spark, str(top))[0]).collect()
    assert {(r["name"], r["rank"]) for r in rows} >= {("w", "5"), ("z", "3")}
