"""Queries: text parsers over texts that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenmeld.catalog import decode_weights, encode_weights
from screenmeld.functions import names as N
from screenmeld.functions import numbers as X
from screenmeld.functions import stats as ST
from screenmeld.operators import clustering as K
from screenmeld.operators.ordering import fill_down, measured, rank_rows
from screenmeld.plans.fixtures import POSES, poses, row_count, table
from screenmeld.plans.registry import query
from screenmeld.sources import inventory as I
from screenmeld.sources import logs as L
from screenmeld.sources import molecules as M
from screenmeld.sources import poses as P
from screenmeld.sources import sections as S
from screenmeld.sources import tables as T

POSES_PER_FILE = 64
#: Order numbers in a block of a scorer's file, as a power of two.
ORDERS_PER_BLOCK = 18


def pose_texts(spark, sf):
    """Pose files of at most 64 poses each: (target, ligand, part, value)."""
    data = poses(spark, sf)
    milli = F.floor(-F.col("score_vina") * 1000).cast("double") / 1000.0
    slot = F.floor((F.col("pose") - 1) / POSES_PER_FILE).cast("int")
    atom = "ATOM  %5d %-4s LIG A   1    %8.3f%8.3f%8.3f  1.00  0.00     0.000 %-2s"
    x = milli + F.col("pose")
    body = F.concat_ws(
        "\n",
        F.format_string("REMARK VINA RESULT:    %.3f      0.000      0.000", -milli),
        F.concat(F.lit("REMARK SMILES CC"), F.col("pose").cast("string")),
        F.lit("REMARK SMILES IDX 1 2"), F.lit("REMARK SMILES (N)O"), F.lit("ROOT"),
        F.format_string(atom, F.lit(1), F.lit("C1"), x, F.lit(1.5), F.lit(2.0), F.lit("C")),
        F.format_string(atom, F.lit(2), F.lit("H1"), x, F.lit(9.0), F.lit(9.0), F.lit("HD")),
        F.format_string(atom, F.lit(3), F.lit("O1"), x, F.lit(-1.5), F.lit(4.0), F.lit("OA")),
        F.lit("TORSDOF 3"))
    model = F.concat(F.lit("MODEL "), F.col("pose").cast("string"), F.lit("\n"), body,
                     F.lit("\nENDMDL\n"))
    grouped = data.select("target", "ligand", slot.alias("part"), "pose", model.alias("m")).groupBy(
        "target", "ligand", "part").agg(
        F.array_sort(F.collect_list(F.struct("pose", "m"))).alias("models"))
    return grouped.select("target", "ligand", "part",
                          F.array_join(F.transform("models", lambda s: s["m"]), "").alias("value"))


FILES = POSES + """,
files AS (SELECT target, ligand, CAST((pose - 1) // 64 AS INT) AS part,
  CAST((pose - 1) % 64 + 1 AS INT) AS pose, pose AS number,
  floor(-score_vina * 1000) / 1000 AS milli FROM poses)"""


@query("pose_energies", f"""WITH {FILES}
SELECT target, ligand, part, pose, -milli AS energy FROM files""")
def pose_energies(spark, sf):
    return P.pose_energies(pose_texts(spark, sf))


@query("pose_best_energy", f"""WITH {FILES}
SELECT target, ligand, part, -milli AS energy, false AS failed FROM files WHERE pose = 1""")
def pose_best_energy(spark, sf):
    return P.best_energy(pose_texts(spark, sf))


@query("pose_heavy_atoms", f"""WITH {FILES}
SELECT target, ligand, part, pose, 2 AS atoms, round(2 * (milli + number), 3) AS sum_x,
  CAST(6 AS DOUBLE) AS sum_z FROM files""")
def pose_heavy_atoms(spark, sf):
    atoms = P.pose_bodies(pose_texts(spark, sf)).withColumn("a", P.heavy_atoms(F.col("body")))
    total = lambda axis: F.aggregate("a", F.lit(0.0), lambda s, p: s + p[axis])
    return atoms.select("target", "ligand", "part", "pose", F.size("a").alias("atoms"),
                        F.round(total("x"), 3).alias("sum_x"), total("z").alias("sum_z"))


@query("pose_embedded_smiles", f"""WITH {FILES}
SELECT target, ligand, part, concat('CC', number, '(N)O') AS smiles FROM files WHERE pose = 1""")
def pose_embedded_smiles(spark, sf):
    return pose_texts(spark, sf).select("target", "ligand", "part",
                                        P.embedded_smiles(F.col("value")).alias("smiles"))


@query("pose_text_roundtrip", f"""WITH {FILES}
SELECT target, ligand, part, number AS model, -milli AS energy FROM files""")
def pose_text_roundtrip(spark, sf):
    """Split, render as combined poses, and read back."""
    bodies = P.pose_bodies(pose_texts(spark, sf))
    number = F.col("part") * POSES_PER_FILE + F.col("pose")
    text = P.render_pose(number, F.array(F.concat(F.lit("REMARK  LIGAND: "), F.col("ligand"))),
                         F.col("body"))
    back = bodies.select("target", "ligand", "part", text.alias("value"))
    model = F.regexp_extract("value", r"^MODEL\s+(\d+)", 1).cast("int")
    return P.best_energy(back.withColumn("model", model)).drop("failed")


@query("pose_clusters", f"""WITH RECURSIVE {FILES},
o AS (SELECT target, ligand, part, pose, -milli AS energy, round(milli + number, 3) AS x,
  row_number() OVER (PARTITION BY target, ligand, part ORDER BY -milli, pose) AS i FROM files),
s AS (SELECT target, ligand, part, i, [x] AS leaders, true AS kept, pose, energy FROM o WHERE i = 1
  UNION ALL SELECT o.target, o.ligand, o.part, o.i,
    CASE WHEN c.near THEN s.leaders ELSE list_append(s.leaders, o.x) END, NOT c.near, o.pose, o.energy
  FROM s JOIN o ON o.target = s.target AND o.ligand = s.ligand AND o.part = s.part AND o.i = s.i + 1,
  LATERAL (SELECT len(list_filter(s.leaders, lambda l :
    sqrt(((l - o.x) * (l - o.x) + (l - o.x) * (l - o.x)) / 2) < 1.5)) > 0 AS near) c)
SELECT target, ligand, part, pose, CAST(row_number() OVER (PARTITION BY target, ligand, part ORDER BY i)
  AS INT) AS cluster_rank, energy FROM s WHERE kept""")
def pose_clusters(spark, sf):
    return K.cluster_poses(pose_texts(spark, sf), 1.5)


@query("pose_filtered_text", f"""WITH {FILES}
SELECT target, ligand, part, count(*) AS models, min(-milli) AS best FROM files
WHERE pose <= 2 GROUP BY target, ligand, part""")
def pose_filtered_text(spark, sf):
    files = pose_texts(spark, sf)
    keys = ("target", "ligand", "part")
    kept = P.pose_energies(files).filter("pose <= 2")
    again = K.filtered_text(files, kept, keys)
    return P.pose_energies(again).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("models"), F.min("energy").alias("best"))


def _broken_texts(spark, sf):
    items = table(spark, sf, "orders")
    k = F.col("o_orderkey") % 5
    good = F.concat(F.lit("MODEL 1\nREMARK VINA RESULT:  -7.1  0.0  0.0\nATOM "),
                    F.col("o_orderkey").cast("string"), F.lit("\nENDMDL\n\n"))
    text = (F.when(k == 0, F.lit("")).when(k == 1, F.lit("MODEL 1\nENDMDL\n"))
            .when(k == 2, F.substring(good, 1, 50)).otherwise(good))
    return items.select(
        F.concat(F.lit("T"), (F.col("o_custkey") % 4).cast("string")).alias("target"),
        F.concat(F.lit("lig_"), F.col("o_orderkey").cast("string"), F.lit("_docked.pdbqt"))
        .alias("file"), text.alias("content"))


VERDICTS = """WITH v AS (SELECT concat('T', o_custkey % 4) AS target,
  concat('lig_', o_orderkey, '_docked.pdbqt') AS file,
  CASE o_orderkey % 5 WHEN 0 THEN 'empty' WHEN 1 THEN 'no energy remark' WHEN 2 THEN 'truncated'
  ELSE 'ok' END AS verdict FROM orders)
"""


def verdicts(spark, sf):
    texts = _broken_texts(spark, sf)
    return texts.select("target", "file", F.concat("target", F.lit("/"), "file").alias("path"),
                        I.pose_verdict(F.col("content"), F.length("content")).alias("verdict"))


@query("pose_verdicts", VERDICTS + "SELECT target, verdict, count(*) AS files FROM v GROUP BY ALL")
def pose_verdicts(spark, sf):
    return verdicts(spark, sf).groupBy("target", "verdict").agg(F.count(F.lit(1)).alias("files"))


@query("pose_quarantine", VERDICTS + """
SELECT concat(target, '/', file) AS path, verdict, concat(target, '__', file) AS new_name
FROM v WHERE verdict <> 'ok'""")
def pose_quarantine(spark, sf):
    return I.quarantine(verdicts(spark, sf))


def library_lines(spark, sf):
    """SMILES lists from customers: CSV with header, TSV without, and .smi files."""
    c = table(spark, sf, "customer")
    name, smiles = F.col("c_name"), F.concat(F.lit("C1=N"), F.col("c_nationkey").cast("string"))
    seg = F.lower("c_mktsegment")
    path = (F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), F.concat(seg, F.lit(".csv")))
            .when(F.col("c_mktsegment") == "FURNITURE", F.concat(seg, F.lit(".tsv.gz")))
            .otherwise(F.concat(seg, F.lit(".smi"))))
    no_name = F.when(F.col("c_custkey") % 11 == 0, F.lit("")).otherwise(name)
    value = (F.when(F.col("c_custkey") % 50 == 0, F.concat(F.lit("# note "), name))
             .when(path.endswith(".csv"), F.concat(smiles, F.lit(";"), no_name))
             .when(path.endswith(".tsv.gz"), F.concat(no_name, F.lit("\t"), smiles))
             .otherwise(F.concat(smiles, F.lit("  "), no_name)))
    rows = c.select(path.alias("path"), F.lit(0).cast("long").alias("block"),
                    F.col("c_custkey").alias("seq"), value.alias("value"))
    heads = rows.filter(F.col("path").endswith(".csv")).select("path").distinct().select(
        "path", F.lit(0).cast("long").alias("block"), F.lit(-1).cast("long").alias("seq"),
        F.lit("canonical_smiles;compound_id").alias("value"))
    return rows.unionByName(heads)


# a .tsv line with an empty name still has its structure in the second column
LIBRARY = """WITH lib AS (SELECT CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING')
    THEN concat(lower(c_mktsegment), '.csv') WHEN c_mktsegment = 'FURNITURE'
    THEN concat(lower(c_mktsegment), '.tsv.gz') ELSE concat(lower(c_mktsegment), '.smi') END AS path,
  c_custkey AS seq, concat('C1=N', c_nationkey) AS payload,
  CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_name END AS raw_name
  FROM customer WHERE c_custkey % 50 <> 0),
idx AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY seq) - 1 AS idx FROM lib)
"""


@query("molecule_list", LIBRARY + "SELECT path, seq, payload, raw_name FROM lib")
def molecule_list(spark, sf):
    return M.molecule_list(library_lines(spark, sf)).drop("block")


@query("molecule_formats", """
SELECT DISTINCT concat(lower(c_mktsegment), CASE c_nationkey % 3 WHEN 0 THEN '.sdf.gz'
  WHEN 1 THEN '.smi' ELSE '.CSV' END) AS path,
  CASE c_nationkey % 3 WHEN 0 THEN 'sdf' ELSE 'smiles' END AS format FROM customer""")
def molecule_formats(spark, sf):
    ext = (F.when(F.col("c_nationkey") % 3 == 0, ".sdf.gz").when(F.col("c_nationkey") % 3 == 1, ".smi")
           .otherwise(".CSV"))
    paths = table(spark, sf, "customer").select(
        F.concat(F.lower("c_mktsegment"), ext).alias("path")).distinct()
    return paths.select("path", M.detect_format(F.col("path")).alias("format"))


@query("mol_names", LIBRARY + """
SELECT path, idx, CASE WHEN raw_name = '' THEN concat('LIB_02_mol_', lpad(CAST(idx AS VARCHAR), 7, '0'))
  ELSE left(concat('LIB_02_', replace(raw_name, '#', '_')), 60) END AS name FROM idx""")
def mol_names(spark, sf):
    mols = M.index_molecules(M.molecule_list(library_lines(spark, sf)), F.lit("LIB 02_"),
                             row_count(spark, sf, "customer") + 10)
    return mols.select("path", "idx", "name")


PARTS_LIB = """WITH lib AS (SELECT p_brand AS lib, p_name AS name, p_partkey AS idx FROM part),
flagged AS (SELECT *, row_number() OVER (PARTITION BY lib, name ORDER BY idx) = 1 AS kept FROM lib)
"""


def _part_library(spark, sf):
    return table(spark, sf, "part").select(F.col("p_brand").alias("lib"), F.col("p_name").alias("name"),
                                           F.col("p_partkey").alias("idx"))


@query("first_wins_dedup", PARTS_LIB + "SELECT lib, name, idx, kept FROM flagged")
def first_wins_dedup(spark, sf):
    return M.first_by_name(_part_library(spark, sf))


@query("ingest_accounting", PARTS_LIB + """
SELECT lib, count(*) AS read, count(*) FILTER (WHERE kept AND idx % 3 <> 0) AS queued,
  count(*) FILTER (WHERE kept AND idx % 3 = 0) AS skipped,
  count(*) FILTER (WHERE NOT kept) AS duplicate, count(*) FILTER (WHERE idx % 7 = 0) AS unnamed
FROM flagged GROUP BY lib""")
def ingest_accounting(spark, sf):
    flagged = M.first_by_name(_part_library(spark, sf)).select(
        "*", (F.col("idx") % 3 == 0).alias("exists"),
        F.when(F.col("idx") % 7 == 0, " ").otherwise(F.col("name")).alias("raw_name"))
    return M.ingest_accounting(flagged)


@query("conversion_status", """
SELECT o_orderpriority AS lib, count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS ok,
  count(*) FILTER (WHERE o_orderstatus = 'O') AS error,
  count(*) FILTER (WHERE o_orderstatus = 'P') AS timeout,
  round(count(*) FILTER (WHERE o_orderstatus = 'F') * CAST(100 AS DOUBLE) / count(*), 6) AS ok_pct
FROM orders GROUP BY o_orderpriority""")
def conversion_status(spark, sf):
    s = F.col("o_orderstatus")
    rows = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("lib"),
        F.when(s == "F", "OK").when(s == "O", "ERROR").when(s == "P", "TIMEOUT").alias("status"))
    out = M.status_counts(rows)
    return out.withColumn("ok_pct", F.round("ok_pct", 6))


@query("pending_molecules", """
SELECT p_partkey AS idx, p_name AS name FROM part
WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)""")
def pending_molecules(spark, sf):
    done = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("idx"),
        F.when(F.col("l_quantity") > 45, 1).otherwise(0).alias("length"))
    mols = table(spark, sf, "part").select(F.col("p_partkey").alias("idx"), F.col("p_name").alias("name"))
    return M.pending(mols, done, ("idx",))


@query("subfolder_paths", """
SELECT p_partkey AS idx, concat(lpad(CAST(CAST(floor(p_partkey * 37 / 10000) AS BIGINT) AS VARCHAR), 4, '0'),
  '/', replace(p_name, ' ', '_'), '.pdbqt') AS path FROM part""")
def subfolder_paths(spark, sf):
    name = N.mol_name(F.col("p_name"), F.col("p_partkey"))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("idx"), N.output_path(name, F.col("p_partkey") * 37).alias("path"))


def pocket_file_lines(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey") % 10
    smiles = F.concat(F.lit("C"), F.col("p_size").cast("string"))
    key = F.col("p_partkey").cast("string")
    value = (F.when(k == 3, F.concat(F.lit("#POCKET_"), F.col("p_size").cast("string")))
             .when(k == 4, "#rank, Smiles").when(k == 5, F.concat(F.lit("x, "), smiles))
             .when(k == 6, F.concat(key, F.lit("\t"), smiles, F.lit("\t-7.5")))
             .when(k == 7, F.lit("# what is this")).when(k == 8, F.lit("lonely"))
             .otherwise(F.concat(key, F.lit(", "), smiles, F.lit(", -8.1"))))
    return p.select(F.col("p_brand").alias("path"), F.lit(0).cast("long").alias("block"),
                    F.col("p_partkey").alias("seq"), value.alias("value"))


POCKETS = """WITH m AS (SELECT p_brand AS path, p_partkey AS seq, p_partkey % 10 AS k,
  concat('C', p_size) AS smiles, CASE WHEN p_partkey % 10 = 3 THEN concat('POCKET_', p_size) END AS h
  FROM part),
f AS (SELECT *, coalesce(last_value(h IGNORE NULLS) OVER (PARTITION BY path ORDER BY seq
  ROWS UNBOUNDED PRECEDING), 'UNASSIGNED') AS pocket FROM m)
"""


@query("pocket_entries", POCKETS + """
SELECT path, pocket, CASE WHEN k = 5 THEN running ELSE seq END AS rank, smiles, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY path ORDER BY seq) AS running
  FROM f WHERE k NOT IN (3, 4, 7, 8)) e""")
def pocket_entries(spark, sf):
    return S.pocket_entries(pocket_file_lines(spark, sf), row_count(spark, sf, "part")).drop("block")


@query("pocket_rejects", POCKETS + """
SELECT path, seq, pocket, CASE k WHEN 7 THEN 'unknown comment' ELSE 'no separator' END AS kind
FROM f WHERE k IN (7, 8)""")
def pocket_rejects(spark, sf):
    return S.pocket_rejects(pocket_file_lines(spark, sf), row_count(spark, sf, "part")).select(
        "path", "seq", "pocket", "kind")


@query("target_blocks", """
SELECT concat('cfg_', s_nationkey) AS path, CASE WHEN s_suppkey % 11 <> 5
    THEN concat('T', s_suppkey) END AS target,
  CASE WHEN s_suppkey % 11 <> 5 THEN CAST(s_suppkey AS DOUBLE) END AS center_x,
  CASE WHEN s_suppkey % 7 <> 0 THEN CAST(22.5 AS DOUBLE) END AS box_z,
  CASE WHEN s_suppkey % 3 = 0 THEN concat('lib', s_nationkey) END AS ligand_subdir,
  CASE WHEN s_suppkey % 11 = 5 AND s_suppkey % 7 = 0 THEN 'missing: name, center, box_size'
       WHEN s_suppkey % 11 = 5 THEN 'missing: name, center'
       WHEN s_suppkey % 7 = 0 THEN 'missing: box_size' END AS problem
FROM supplier WHERE NOT (s_suppkey % 11 = 5 AND s_suppkey % 7 = 0 AND s_suppkey % 3 <> 0)""")
def target_blocks(spark, sf):
    s = table(spark, sf, "supplier")
    key = F.col("s_suppkey").cast("string")
    named = F.col("s_suppkey") % 11 != 5
    entries = F.array_compact(F.array(
        F.when(named, F.concat(F.lit("T"), key)),
        F.lit("# a comment"),
        F.when(named, F.concat(F.lit("CENTER = ["), key, F.lit(".0, 1.5, -2]"))),
        F.when(F.col("s_suppkey") % 7 != 0, F.lit("BOX_SIZE = [20, 21.5, 22.5]")),
        F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("ligand_subdir = lib"),
                                                     F.col("s_nationkey").cast("string"))),
        F.lit("  ")))
    rows = s.select(F.concat(F.lit("cfg_"), F.col("s_nationkey").cast("string")).alias("path"),
                    F.col("s_suppkey").alias("k"), F.posexplode(entries)).select(
        "path", F.lit(0).cast("long").alias("block"), (F.col("k") * 10 + F.col("pos")).alias("seq"),
        F.col("col").alias("value"))
    blocks = S.target_blocks(rows, row_count(spark, sf, "supplier") * 6)
    return blocks.select("path", "target", F.get("center", F.lit(0)).alias("center_x"),
                         F.get("box_size", F.lit(2)).alias("box_z"), "ligand_subdir", "problem")


def manifest_lines(spark, sf):
    s = table(spark, sf, "supplier")
    key = F.col("s_suppkey")
    text = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    entries = F.array(
        F.lit("free text before = 1"), F.lit("[docking]  # stage"),
        F.lit("binary = unidock ; engine"),
        text("scoring = ", F.when(key % 5 == 0, F.lit("ad4")).otherwise(F.lit("vina"))),
        text("seed = ", (key % 2).cast("string")), F.lit("[Rescore]"),
        text("VINA_ENABLED = ", F.when(key % 3 == 0, F.lit("Ja")).otherwise(F.lit("no"))),
        F.lit("dense_enabled = on"), F.lit("dense_model = dense  # ensemble"),
        text("w_vina = 0.", (key % 4).cast("string")), F.lit("w_dense_cnnaffinity = 0.5"),
        text("w_ad4 = ", F.when(key % 13 == 0, F.lit("-0.2")).otherwise(F.lit("0.0"))),
        text("sigma_fraction = ", (key % 6 + 1).cast("string")), F.lit("cluster_poses = true"),
        F.lit("[refinement]"), F.lit("enabled = true"),
        text("top_fraction = ", F.when(key % 17 == 0, F.lit("1.5")).otherwise(F.lit("0.15"))))
    return s.select(F.concat(F.lit("run_"), key.cast("string")).alias("path"),
                    F.posexplode(entries)).select(
        "path", F.lit(0).cast("long").alias("block"), F.col("pos").cast("long").alias("seq"),
        F.col("col").alias("value"))


MANIFEST_ROWS = 17


def manifest_settings(spark, sf):
    return S.settings(manifest_lines(spark, sf), row_count(spark, sf, "supplier") * MANIFEST_ROWS)


@query("manifest_settings", """
SELECT concat('run_', s_suppkey) AS run, section, count(*) AS keys FROM supplier, (VALUES
  ('_GLOBAL', 1), ('DOCKING', 3), ('RESCORE', 8), ('REFINEMENT', 2)) v(section, n),
  (SELECT unnest(range(8)) AS i) r WHERE i < n GROUP BY ALL""")
def settings_per_section(spark, sf):
    return manifest_settings(spark, sf).groupBy("run", "section").agg(
        F.count(F.lit(1)).alias("keys"))


@query("manifest_summary", """
SELECT concat('run_', s_suppkey) AS run, round(0.5 + (s_suppkey % 4) / 10.0
    + CASE WHEN s_suppkey % 13 = 0 THEN -0.2 ELSE 0 END, 6) AS weight_sum,
  CASE WHEN s_suppkey % 3 = 0 THEN 'Vina,dense' ELSE 'dense' END AS active_scores,
  CAST(s_suppkey % 6 + 1 AS VARCHAR) AS sigma_fraction, 'RMSD ?' AS clustering,
  CASE WHEN s_suppkey % 5 = 0 THEN 'ad4' ELSE 'vina' END AS scoring,
  CASE WHEN s_suppkey % 2 = 0 THEN 'random' ELSE '1' END AS seed, 'unidock' AS binary,
  'dense' AS models FROM supplier""")
def manifest_summary(spark, sf):
    out = S.manifest_summary(manifest_settings(spark, sf))
    return out.select("run", F.round("weight_sum", 6).alias("weight_sum"),
                      F.array_join("active_scores", ",").alias("active_scores"), "sigma_fraction",
                      "clustering", "scoring", "seed", "binary",
                      F.array_join("models", ",").alias("models"))


def log_lines(spark, sf):
    o = table(spark, sf, "orders")
    k, key = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    value = (F.when(k % 97 == 0, F.lit("2026 === PIPELINE END ==="))
             .when(k % 20 == 0, F.concat(F.lit("2026 === TARGET 1/3: T"),
                                         F.expr("CAST((o_orderkey div 20) % 3 AS STRING)"),
                                         F.lit(" ===")))
             .when(k % 9 == 0, F.concat(F.lit("[GPU 0] [5/9] lig_"), key, F.lit("  -7.1 kcal/mol FEHLER")))
             .otherwise(F.concat(F.lit("10:00 [GPU 0] [5/9] lig_"), (k % 500).cast("string"),
                                 F.lit("  -"), (k % 13).cast("string"), F.lit(".5 kcal/mol"))))
    return o.select(F.concat(F.lit("log_"), F.col("o_orderstatus")).alias("path"),
                    F.lit(0).cast("long").alias("block"), k.alias("seq"), value.alias("value"))


LOG = """WITH l AS (SELECT concat('log_', o_orderstatus) AS path, o_orderkey AS k,
  CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 20 = 0
    THEN concat('T', (o_orderkey // 20) % 3) END AS mark FROM orders),
f AS (SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY path ORDER BY k
  ROWS UNBOUNDED PRECEDING) AS target FROM l)
SELECT path, target, concat('lig_', k % 500) AS ligand, arg_max(-(k % 13 + 0.5), k) AS energy
FROM f WHERE target <> '' AND mark IS NULL AND k % 9 <> 0 GROUP BY path, target, k % 500"""


@query("completed_from_log", LOG.replace("-(k % 13 + 0.5)", "CAST(-(k % 13 + 0.5) AS DOUBLE)"))
def completed_from_log(spark, sf):
    return L.completed_from_log(log_lines(spark, sf), row_count(spark, sf, "orders"))


def scorer_lines(spark, sf):
    """Three scorer lines per line item, in the order of an output file per 200th part.

    Like files that are read in splits, a file has blocks, here of 2**ORDERS_PER_BLOCK order numbers, and lines are placed inside them.
    """
    i = table(spark, sf, "lineitem")
    file = F.col("l_partkey") % 200
    path = F.concat(F.lit("part_"), file.cast("string"))
    ship = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    block = F.shiftright(F.col("l_orderkey").cast("long"), ORDERS_PER_BLOCK)
    base = i.select(path.alias("path"), block.alias("block"), "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
                    "l_extendedprice", "l_quantity", "l_discount", "l_tax", ship.alias("ship"))
    placed = rank_rows(base, ["path", "block"], ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
                                                 "l_extendedprice", "l_quantity", "l_discount", "l_tax",
                                                 "ship"],
                       "at", "first", measured(i.select(file.alias("file"), block.alias("block")), ["file", "block"], row_count(spark, sf, "lineitem")))
    cents = F.round(F.col("l_discount") * 100).cast("int").cast("string")
    entries = F.array(
        F.concat(F.lit("  Affinity: -"), F.col("l_quantity").cast("int").cast("string"),
                 F.lit(".25 (kcal/mol)")),
        F.concat(F.lit("CNNscore: "), F.when(F.col("l_linenumber") == 7, F.lit("1.5")).otherwise(
            F.concat(F.lit("0."), cents))),
        F.concat(F.lit("CNNaffinity: "), F.col("l_linenumber").cast("string"), F.lit(".5")))
    return placed.select("path", "block", F.posexplode(entries), "at").select(
        "path", "block", (F.col("at") * 3 + F.col("pos")).alias("seq"),
        F.col("col").alias("value"))


@query("scorer_poses", """
WITH p AS (SELECT concat('part_', l_partkey % 200) AS path, row_number() OVER (
    PARTITION BY l_partkey % 200 ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey,
    l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate) AS pose, * FROM lineitem)
SELECT path, CAST(pose AS INT) AS pose, -(l_quantity + CAST(0.25 AS DOUBLE)) AS affinity,
  CASE WHEN l_linenumber <> 7 THEN CAST(concat('0.', CAST(round(l_discount * 100) AS INT)) AS DOUBLE)
    END AS cnnscore,
  CASE WHEN l_linenumber <> 7 THEN l_linenumber + CAST(0.5 AS DOUBLE) END AS cnnaffinity FROM p""")
def scorer_poses(spark, sf):
    return L.scorer_poses(scorer_lines(spark, sf), row_count(spark, sf, "lineitem") * 3)


@query("refinement_outputs", """
SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 3 THEN NULL
    ELSE CAST(-p_size - 0.5 AS DOUBLE) END AS vina,
  CASE p_partkey % 4 WHEN 0 THEN CAST(0.25 AS DOUBLE) WHEN 1 THEN CAST(0.75 AS DOUBLE) END AS cnnscore,
  CASE p_partkey % 4 WHEN 0 THEN CAST(6.5 AS DOUBLE) WHEN 1 THEN CAST(7.5 AS DOUBLE) END AS cnnaffinity,
  p_partkey % 4 IN (0, 1) AS ok FROM part""")
def refinement_outputs(spark, sf):
    p = table(spark, sf, "part")
    size = F.col("p_size").cast("string")
    k = F.col("p_partkey") % 4
    value = (F.when(k == 0, F.concat(F.lit("Affinity: -"), size, F.lit(
        ".5 (kcal/mol)\nCNNscore: 0.25\nCNNaffinity: 6.5\nCNNvariance: 0.1\n")))
        .when(k == 1, F.concat(F.lit("mode |  affinity\n-----+------\n   1   -"), size,
                               F.lit(".5   0.000   0.75   7.5\n   2  -1.0  0.0  0.1  2.0\n")))
        .when(k == 2, F.concat(F.lit("Affinity: -"), size, F.lit(".5 (kcal/mol)\n")))
        .otherwise(F.lit("crashed\n")))
    return L.refinement_outputs(p.select(F.col("p_partkey").alias("id"), value.alias("value")))


@query("docking_table_repair", """
SELECT o_orderkey AS id, concat('lig_', o_orderkey) AS ligand, o_orderkey % 4 IN (0, 1) AS success,
  CASE WHEN o_orderkey % 3 = 0 THEN -CAST(o_orderkey % 12 AS DOUBLE) END AS best_energy_kcal_mol,
  CASE WHEN o_orderkey % 4 = 3 THEN 'no pose' END AS error FROM orders""")
def docking_table_repair(spark, sf):
    k = F.col("o_orderkey")
    raw = table(spark, sf, "orders").select(
        k.alias("id"), F.concat(F.lit("lig_"), k.cast("string")).alias("ligand"),
        F.when(k % 4 == 0, " True").when(k % 4 == 1, "YES").when(k % 4 == 2, "no").otherwise("False")
        .alias("success"),
        F.when(k % 3 == 0, F.concat(F.lit("-"), (k % 12).cast("string"))).when(k % 3 == 1, "None")
        .otherwise("").alias("best_energy_kcal_mol"),
        F.when(k % 4 == 3, "no pose").otherwise("").alias("error"))
    return T.repair_docking(raw)


@query("partial_scores", """
SELECT concat('scores_', lpad(CAST(p_size AS VARCHAR), 5, '0')) AS path, p_name AS ligand,
  CAST(p_partkey % 9 + 1 AS INT) AS pose,
  CASE WHEN p_size % 2 = 0 OR p_partkey % 5 <> 0 THEN -p_retailprice END AS score_vina,
  CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS DOUBLE) END AS score_ad4 FROM part""")
def partial_scores(spark, sf):
    p = table(spark, sf, "part")
    path = F.concat(F.lit("scores_"), F.lpad(F.col("p_size").cast("string"), 5, "0"))
    even = F.col("p_size") % 2 == 0
    pose = (F.col("p_partkey") % 9 + 1).cast("string")
    vina = F.concat(F.lit("-"), F.col("p_retailprice").cast("string"))
    value = F.when(even, F.concat_ws(",", "p_name", pose, F.col("p_size").cast("string"), vina)
                   ).otherwise(F.concat_ws(",", pose, F.when(F.col("p_partkey") % 5 == 0, F.lit(""))
                                           .otherwise(vina), "p_name"))
    rows = p.select(path.alias("path"), F.lit(0).cast("long").alias("block"),
                    F.col("p_partkey").alias("seq"), value.alias("value"))
    heads = p.select(path.alias("path"), even.alias("even")).distinct().select(
        "path", F.lit(0).cast("long").alias("block"), F.lit(-1).cast("long").alias("seq"),
        F.when(F.col("even"), "ligand,pose,score_ad4,score_vina")
        .otherwise("pose,score_vina,ligand").alias("value"))
    return T.partial_scores(rows.unionByName(heads), ["vina", "ad4"])


@query("report_columns", """
SELECT CAST(c_custkey AS VARCHAR) AS rank, c_name AS name, CAST(c_nationkey AS VARCHAR) AS pose,
  c_mktsegment AS file, CAST(NULL AS VARCHAR) AS ecr, CAST(NULL AS VARCHAR) AS smiles FROM customer""")
def report_columns(spark, sf):
    odd = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Ranking"), F.col("c_name").alias("Ligand Name"),
        F.col("c_nationkey").alias("Pose-ID"), F.col("c_mktsegment").alias("my PDBQT column"))
    return T.resolve_columns(odd).select("rank", "name", "pose", "file", "ecr", "smiles")


@query("rename_map", """
SELECT concat(p_partkey, '_x.pdbqt') AS new_name, concat('old_', p_partkey) AS old_name,
  CAST(NULL AS VARCHAR) AS mol_name FROM part WHERE p_partkey % 4 <> 0""")
def rename_map(spark, sf):
    key = F.col("p_partkey").cast("string")
    raw = table(spark, sf, "part").select(
        F.when(F.col("p_partkey") % 4 != 0, F.concat(key, F.lit("_x.pdbqt"))).otherwise("")
        .alias("new_name"), F.concat(F.lit("old_"), key).alias("old_name"))
    return T.usable_renames(raw)


@query("marker_fill_down", """
SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (
  PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS marker FROM events""")
def marker_fill_down(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type",
                                          F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    mark = F.when(F.col("event_type") == "signup", F.col("event_id"))
    return fill_down(e, ["user_id"], ["at", "event_id"], {"marker": mark},
                     row_count(spark, sf, "events")).select("event_id", "marker")


@query("norm_keys", """
SELECT c_custkey AS id, regexp_replace(lower(c_name), '[^a-z0-9]+', '', 'g') AS plain,
  regexp_replace(lower(c_name), '[^a-z0-9]+', '', 'g') AS mol_key FROM customer""")
def norm_keys(spark, sf):
    path = F.concat(F.lit("/x/"), F.lpad((F.col("c_custkey") % 1000).cast("string"), 4, "0"), F.lit("_"),
                    F.col("c_name"), F.lit("_docked.PDBQT"))
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), N.norm(F.col("c_name")).alias("plain"),
        N.mol_key(path).alias("mol_key"))


@query("extracted_file_names", """
SELECT p_partkey AS id, concat(lpad(CAST(p_size AS VARCHAR), 4, '0'), '_', p_brand, '.pdbqt') AS by_target,
  concat(lpad(CAST(p_size AS VARCHAR), 4, '0'), '_mol_', p_partkey, '.pdbqt') AS by_ligand,
  concat(lpad(CAST(p_size AS VARCHAR), 4, '0'), '_LIB_mol_', p_partkey, '_docked.pdbqt') AS in_full,
  p_size AS rank, concat('LIB_mol_', p_partkey) AS name, regexp_replace(regexp_replace(p_name,
    '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g') AS label FROM part""")
def extracted_file_names(spark, sf):
    ligand = F.concat(F.lit("LIB_mol_"), F.col("p_partkey").cast("string"))
    made = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), N.safe_label(F.col("p_name")).alias("label"),
        *[N.extracted_name(F.col("p_size"), ligand, F.col("p_brand"), m).alias(n) for m, n in
          (("target", "by_target"), ("ligand", "by_ligand"), ("full", "in_full"))])
    parts = N.pose_file_parts(F.col("in_full"))
    return made.select("*", parts["rank"].alias("rank"), parts["name"].alias("name"))


@query("weight_string_roundtrip", """
SELECT p_partkey AS id, printf('A=%.2f/B=%.2f', (p_size % 4) / 4.0, 1 - (p_size % 4) / 4.0) AS text,
  CAST((p_size % 4) / 4.0 AS DOUBLE) AS a FROM part""")
def weight_string_roundtrip(spark, sf):
    a = (F.col("p_size") % 4) / 4.0
    made = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        encode_weights(F.create_map(F.lit("B"), 1 - a, F.lit("A"), a)).alias("text"))
    return made.select("id", "text", decode_weights(F.col("text"))["A"].alias("a"))


@query("receptor_files", """
SELECT p_partkey AS id, p_partkey % 5 IN (0, 1, 2) AS receptor FROM part""")
def receptor_files(spark, sf):
    k = F.col("p_partkey") % 5
    name = (F.when(k == 0, F.lit("00_target.pdbqt")).when(k == 1, F.concat("p_brand", F.lit("_Target.PDBQT")))
            .when(k == 2, F.concat("p_brand", F.lit("_receptor.pdbqt")))
            .when(k == 3, F.concat("p_brand", F.lit("_docked.pdbqt"))).otherwise(F.lit("target.pdbqt")))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), N.is_receptor_file(name).alias("receptor"))


@query("p_value_texts", """
SELECT p_partkey AS id, CASE WHEN p IS NULL THEN 'n/a' WHEN p < 0.001 THEN 'p < 0.001' WHEN p < 0.01 THEN 'p < 0.01'
  WHEN p < 0.05 THEN 'p < 0.05' ELSE 'p = ' || printf('%.3f', p) END AS label,
  CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE '' END AS stars
FROM (SELECT p_partkey, CASE WHEN p_partkey % 7 > 0 THEN (p_partkey % 200) / CAST(2000 AS DOUBLE) END AS p FROM part)""")
def p_value_texts(spark, sf):
    k = F.col("p_partkey")
    p = F.when(k % 7 > 0, (k % 200) / F.lit(2000.0))
    return table(spark, sf, "part").select(k.alias("id"), ST.p_label(p).alias("label"), ST.p_stars(p).alias("stars"))


@query("spaced_points", """
SELECT p_partkey AS id, i, round(p_size + i * (p_retailprice - p_size) / 4, 6) AS x
FROM part, (SELECT unnest(range(5)) AS i)""")
def spaced_points(spark, sf):
    points = ST.linspace(F.col("p_size").cast("double"), F.col("p_retailprice").cast("double"), 5)
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.posexplode(points).alias("i", "x")).select(
        "id", F.col("i").cast("long").alias("i"), F.round("x", 6).alias("x"))


@query("number_texts", """
SELECT l_orderkey AS o, l_linenumber AS n, l_quantity AS q, count(*) AS rows,
  printf('%.3f', l_quantity) AS fixed, printf('%.3e', l_quantity * 1000000) AS exponent,
  CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS whole,
  printf('%dh%02dm%02ds', CAST(1 + l_quantity AS BIGINT), CAST(l_linenumber AS BIGINT),
    CAST(l_quantity AS BIGINT)) AS duration
FROM lineitem GROUP BY ALL""")
def number_texts(spark, sf):
    q = F.col("l_quantity")
    rows = table(spark, sf, "lineitem").groupBy(
        F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), q.alias("q")).agg(
        F.count(F.lit(1)).alias("rows"))
    q = F.col("q")
    return rows.select(
        "o", "n", "q", "rows", X.report_number(q).alias("fixed"),
        X.report_number(q * 1_000_000).alias("exponent"), X.property_number(q).alias("whole"),
        X.duration_text((1 + q) * 3600 + F.col("n") * 60 + q).alias("duration"))


@query("breakable_text", """
SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN '-'
  ELSE rtrim(regexp_replace(text, '(.{12})', '\\1' || chr(8203), 'gs'), chr(8203)) END AS text FROM documents""")
def breakable_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.breakable(F.col("text")).alias("text"))
