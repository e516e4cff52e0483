"""Queries: files that Spark writes from the tables and reads back, orders as positions, and rules that the other fixtures leave idle."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenmeld.catalog import Score, register
from screenmeld.operators import clustering as K
from screenmeld.operators import consensus as C
from screenmeld.operators import reconcile as R
from screenmeld.operators import report as O
from screenmeld.operators.ordering import order_preserving_index
from screenmeld.plans.fixtures import POSES, poses, row_count, table
from screenmeld.plans.operations import BLOCK, BLOCKS_SQL, LIB, MATCH, _blocks, _records, _report_rows, library
from screenmeld.plans.ranking import rounded
from screenmeld.plans.registry import query
from screenmeld.plans.texts import FILES, manifest_settings, pose_texts
from screenmeld.session import new_path
from screenmeld.sinks import partial_csv_rows
from screenmeld.sources import inventory as I
from screenmeld.sources import molecules as M
from screenmeld.sources import poses as P
from screenmeld.sources import tables as T


def _positions(ordered, rows):
    """Place of each row in an ordered table, as its partitions and their rows stand."""
    placed = ordered.withColumn("_id", F.monotonically_increasing_id()).withColumn("_all", F.lit(0))
    return order_preserving_index(placed, ["_all"], ["_id"], "position", rows).drop("_id", "_all")


@query("sniffed_report", """
SELECT CAST(p_partkey AS VARCHAR) AS "Rank", concat(p_name, chr(10), '"', p_brand, '"') AS "Ligand",
  CASE WHEN p_size % 4 <> 3 THEN CAST(p_size AS VARCHAR) END AS "ECR_Score",
  CASE WHEN p_size % 4 = 2 THEN concat('a,b;', p_size) END AS extra FROM part""")
def sniffed_report(spark, sf):
    """Four layouts with separators, column orders and columns of their own; names hold a line break and quotes."""
    p = table(spark, sf, "part")
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    kind = F.col("p_size") % 4
    name = F.concat(F.lit('"'), "p_name", F.lit("\n"), F.lit('""'), "p_brand", F.lit('"""'))
    layouts = [("Rank;Ligand;ECR_Score", ";", [key, name, size]), ("ECR_Score,Rank,Ligand", ",", [size, key, name]),
               ("Ligand|extra|Rank|ECR_Score", "|", [name, F.concat(F.lit("a,b;"), size), key, size]),
               ("Rank\tLigand", "\t", [key, name])]
    value, head = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, (first, sep, cells) in enumerate(layouts):
        value = F.when(kind == k, F.concat_ws(sep, *cells)).otherwise(value)
        head = F.when(kind == k, F.lit(first)).otherwise(head)
    path = F.concat(F.lit("report_"), kind.cast("string"), F.lit(".csv"))
    texts = p.select(path.alias("path"), "p_partkey", F.posexplode(F.split(value, "\n")))
    rows = texts.select("path", F.floor(F.col("p_partkey") / 500).cast("long").alias("block"),
                        (F.col("p_partkey") * 2 + F.col("pos")).cast("long").alias("seq"), F.col("col").alias("value"))
    heads = p.select(path.alias("path"), F.lit(-1).cast("long").alias("block"), F.lit(0).cast("long").alias("seq"),
                     head.alias("value")).distinct()
    return T.sniffed_lines(rows.unionByName(heads))[0]


def _written_parts(spark, sf):
    path = new_path(spark, "library_files")
    table(spark, sf, "part").select(
        F.concat(F.lit("T"), (F.col("p_size") % 5).cast("string")).alias("target"), F.col("p_name").alias("value")
    ).write.partitionBy("target").text(path)
    return path


SIZES = "SELECT concat('target=T', p_size % 5) AS folder, CAST(sum(strlen(p_name) + 1) AS BIGINT) AS bytes FROM part GROUP BY ALL"


def _bytes(files):
    return I.with_names(files).groupBy("folder").agg(F.sum("length").alias("bytes"))


@query("file_inventory", SIZES)
def file_inventory(spark, sf):
    return _bytes(I.inventory(spark, _written_parts(spark, sf), "*.txt", subdir="absent"))


@query("recent_file_inventory", SIZES)
def recent_file_inventory(spark, sf):
    return _bytes(I.recent_files(spark, _written_parts(spark, sf), 24, "*.txt"))


@query("telemetry_files", """
SELECT CAST(user_id % 4 AS INT) AS gpu, count(*) AS samples, round(avg(value), 6) AS util, max(value) AS most
FROM events GROUP BY ALL""")
def telemetry_files(spark, sf):
    path = new_path(spark, "telemetry")
    e = table(spark, sf, "events")
    e.select(F.concat_ws(", ", (F.col("user_id") % 4).cast("string"), F.col("value").cast("string"), F.lit("1000"),
                         F.lit("300.5")).alias("value")).write.text(path)
    return T.telemetry(spark, path).groupBy("gpu").agg(
        F.count("*").alias("samples"), F.round(F.avg("util"), 6).alias("util"), F.max("util").alias("most"))


@query("missing_score_weights", f"""WITH {POSES},
p AS (SELECT target, ligand, pose, score_vina, CASE WHEN target <> 'RF' THEN score_cnnaffinity END AS score_cnnaffinity FROM poses),
r AS (SELECT *, count(*) OVER (PARTITION BY target) AS n,
  row_number() OVER (PARTITION BY target ORDER BY score_vina, ligand, pose) AS a,
  CASE WHEN score_cnnaffinity IS NOT NULL THEN row_number() OVER (
    PARTITION BY target ORDER BY score_cnnaffinity NULLS LAST, ligand, pose) END AS b FROM p)
SELECT target, ligand, pose, round(CASE WHEN target = 'RF' THEN 1 ELSE CAST(0.25 AS DOUBLE) END
    * exp(-a / greatest(n / CAST(4 AS DOUBLE), 1))
  + CASE WHEN target = 'RF' THEN 0 ELSE CAST(0.75 AS DOUBLE) END
    * coalesce(exp(-b / greatest(n / CAST(4 AS DOUBLE), 1)), 0), 9) AS ecr_total FROM r""")
def missing_score_weights(spark, sf):
    """One target lacks a whole score: the other takes its weight there."""
    data = poses(spark, sf).withColumn("score_cnnaffinity", F.when(F.col("target") != "RF", F.col("score_cnnaffinity")))
    scores = ["vina", "cnnaffinity"]
    prof = C.profile(data, scores)
    posed = C.consensus_poses(C.rank_scores(data, scores, rows=prof.rows), scores, prof, {"vina": 0.25, "cnnaffinity": 0.75})
    return rounded(posed.select("target", "ligand", "pose", "ecr_total"), "ecr_total")


@query("block_size_changed", f"""WITH {BLOCKS_SQL},
n AS (SELECT target, count(*) AS n, CAST(ceil(count(*) / CAST({2 * BLOCK} AS DOUBLE)) AS BIGINT) AS blocks FROM lig GROUP BY target),
s AS (SELECT target, block, count(*) AS held FROM placed GROUP BY ALL),
f AS (SELECT n.target, n, blocks, count(*) FILTER (block < blocks) AS saved, count(*) FILTER (block >= blocks) AS stale,
  min(block) FILTER (block < blocks) AS first, arg_min(held, block) FILTER (block < blocks) AS held
  FROM n JOIN s ON n.target = s.target GROUP BY ALL),
e AS (SELECT target, n, blocks, stale, CAST(held <> least({2 * BLOCK}, n - first * {2 * BLOCK}) AS INT) AS inconsistent,
  CASE WHEN held <> least({2 * BLOCK}, n - first * {2 * BLOCK}) THEN 0 ELSE saved END AS done FROM f)
SELECT coalesce(target, 'TOTAL') AS target, CAST(sum(n) AS BIGINT) AS n, CAST(sum(blocks) AS BIGINT) AS blocks,
  CAST(sum(done) AS BIGINT) AS done, CAST(sum(blocks) - sum(done) AS BIGINT) AS remaining, CAST(sum(stale) AS BIGINT) AS stale,
  CAST(sum(inconsistent) AS BIGINT) AS inconsistent, CAST(0 AS BIGINT) AS ranked FROM e GROUP BY ROLLUP(target)""")
def block_size_changed(spark, sf):
    """Blocks saved with half the size that is in force now."""
    data, saved = _blocks(spark, sf)
    return R.block_progress(data, saved, 2 * BLOCK)


@query("library_positions", f"""WITH {LIB}
SELECT target, ligand, CAST(row_number() OVER (PARTITION BY target ORDER BY ligand) - 1 AS BIGINT) AS position FROM lib""")
def library_positions(spark, sf):
    return order_preserving_index(library(spark, sf).select("target", "ligand"), ["target"], ["ligand"], "position",
                                  row_count(spark, sf, "orders"))


@query("docking_result_positions", f"""WITH {LIB},
r AS (SELECT target, ligand, o_orderstatus <> 'P' AS success, CASE WHEN o_orderkey % 6 <> 0 THEN -o_totalprice END AS energy FROM lib)
SELECT target, ligand, CAST(row_number() OVER (ORDER BY success DESC, CASE WHEN success THEN energy END ASC NULLS LAST, ligand) - 1
  AS BIGINT) AS position FROM r""")
def docking_result_positions(spark, sf):
    res = library(spark, sf).select(
        "target", "ligand", (F.col("o_orderstatus") != "P").alias("success"),
        F.when(F.col("o_orderkey") % 6 != 0, -F.col("o_totalprice")).alias("best_energy_kcal_mol"))
    return _positions(R.in_result_order(res), row_count(spark, sf, "orders")).select("target", "ligand", "position")


@query("report_positions", """
WITH r AS (SELECT CASE WHEN p_size % 7 = 0 THEN p_brand ELSE CAST(p_size AS VARCHAR) END AS rank, p_partkey AS part FROM part)
SELECT rank, part, CAST(row_number() OVER (ORDER BY TRY_CAST(rank AS INT) NULLS LAST, part) - 1 AS BIGINT) AS position FROM r""")
def report_positions(spark, sf):
    rows = table(spark, sf, "part").select(
        F.when(F.col("p_size") % 7 == 0, F.col("p_brand")).otherwise(F.col("p_size").cast("string")).alias("rank"),
        F.col("p_partkey").alias("part"))
    return _positions(O.report_order(rows), row_count(spark, sf, "part"))


@query("first_part_files", "SELECT concat('lib/', p_partkey, '.sdf') AS path FROM part ORDER BY path LIMIT 25")
def first_part_files(spark, sf):
    return O.first_files(table(spark, sf, "part").select(
        F.concat(F.lit("lib/"), F.col("p_partkey").cast("string"), F.lit(".sdf")).alias("path")), 25)


@query("unmatched_records", MATCH + """
SELECT series, filename, file_rank FROM rec WHERE NOT EXISTS (
  SELECT 1 FROM rows r WHERE r.series = rec.series AND r.rank = rec.file_rank AND r.row % 3 <> 0)""")
def unmatched_records(spark, sf):
    rows = _report_rows(spark, sf).filter("row % 3 <> 0")
    return O.unmatched_records(rows, _records(spark, sf)).select("series", "filename", "file_rank")


@query("manifest_values", """
SELECT concat('run_', s_suppkey) AS run, section, key, CASE key
    WHEN 'scoring' THEN CASE WHEN s_suppkey % 5 = 0 THEN 'ad4' ELSE 'vina' END
    WHEN 'seed' THEN CAST(s_suppkey % 2 AS VARCHAR)
    WHEN 'vina_enabled' THEN CASE WHEN s_suppkey % 3 = 0 THEN 'Ja' ELSE 'no' END
    WHEN 'w_vina' THEN concat('0.', s_suppkey % 4)
    WHEN 'w_ad4' THEN CASE WHEN s_suppkey % 13 = 0 THEN '-0.2' ELSE '0.0' END
    WHEN 'sigma_fraction' THEN CAST(s_suppkey % 6 + 1 AS VARCHAR)
    WHEN 'top_fraction' THEN CASE WHEN s_suppkey % 17 = 0 THEN '1.5' ELSE '0.15' END
    ELSE v END AS value
FROM supplier, (VALUES ('_GLOBAL', 'free text before', '1'), ('DOCKING', 'binary', 'unidock'), ('DOCKING', 'scoring', ''),
  ('DOCKING', 'seed', ''), ('RESCORE', 'vina_enabled', ''), ('RESCORE', 'dense_enabled', 'on'), ('RESCORE', 'dense_model', 'dense'),
  ('RESCORE', 'w_vina', ''), ('RESCORE', 'w_dense_cnnaffinity', '0.5'), ('RESCORE', 'w_ad4', ''), ('RESCORE', 'sigma_fraction', ''),
  ('RESCORE', 'cluster_poses', 'true'), ('REFINEMENT', 'enabled', 'true'), ('REFINEMENT', 'top_fraction', '')) e(section, key, v)""")
def manifest_values(spark, sf):
    return manifest_settings(spark, sf).select("run", "section", "key", "value")


@query("pose_filtered_lines", f"""WITH {FILES},
m AS (SELECT target, ligand, part, pose, milli + number AS x, concat('MODEL ', pose, chr(10),
    printf('REMARK VINA RESULT:    %.3f      0.000      0.000', -milli), chr(10), 'REMARK SMILES CC', number, chr(10),
    'REMARK SMILES IDX 1 2', chr(10), 'REMARK SMILES (N)O', chr(10), 'ROOT', chr(10)) AS head FROM files WHERE pose % 3 = 1)
SELECT target, ligand, part, md5(string_agg(concat(head,
  printf('ATOM  %5d %-4s LIG A   1    %8.3f%8.3f%8.3f  1.00  0.00     0.000 %-2s', 1, 'C1', x, CAST(1.5 AS DOUBLE), CAST(2 AS DOUBLE), 'C'), chr(10),
  printf('ATOM  %5d %-4s LIG A   1    %8.3f%8.3f%8.3f  1.00  0.00     0.000 %-2s', 2, 'H1', x, CAST(9 AS DOUBLE), CAST(9 AS DOUBLE), 'HD'), chr(10),
  printf('ATOM  %5d %-4s LIG A   1    %8.3f%8.3f%8.3f  1.00  0.00     0.000 %-2s', 3, 'O1', x, CAST(-1.5 AS DOUBLE), CAST(4 AS DOUBLE), 'OA'), chr(10),
  'TORSDOF 3', chr(10), 'ENDMDL'), chr(10) ORDER BY pose)) AS md5 FROM m GROUP BY ALL""")
def pose_filtered_lines(spark, sf):
    """The re-assembled text itself, of every third pose of a file."""
    files = pose_texts(spark, sf)
    kept = P.pose_energies(files).filter("pose % 3 = 1")
    keys = ("target", "ligand", "part")
    return K.filtered_text(files, kept, keys).select(*keys, F.md5("value").alias("md5"))


@query("sdf_molecules", """
SELECT concat('mol ', p_partkey) AS raw_name, concat(' mol ', p_partkey, chr(10), '  prog', chr(10), chr(10), '  1  0', chr(10),
  'M  END', chr(10), '> <ID>', chr(10), p_name, chr(10), chr(10)) AS payload FROM part WHERE p_size % 7 <> 0""")
def sdf_molecules(spark, sf):
    """Records of SDF files; pieces without the end of their molecule are none."""
    path, p = new_path(spark, "library_sdf"), table(spark, sf, "part")
    end = F.when(F.col("p_size") % 7 == 0, "M  CUT\n").otherwise("M  END\n")
    p.select(F.concat(F.lit(" mol "), F.col("p_partkey").cast("string"), F.lit("\n  prog\n\n  1  0\n"), end, F.lit("> <ID>\n"),
                      "p_name", F.lit("\n\n$$$$")).alias("value")).write.text(path)
    return M.sdf_records(spark, path).select("raw_name", "payload")


@query("user_score_ranks", f"""WITH {POSES}
SELECT target, ligand, pose, CAST(row_number() OVER (PARTITION BY target ORDER BY score_vina + 2 * score_deltalinf9xgb, ligand, pose)
  AS BIGINT) AS rank FROM poses WHERE score_deltalinf9xgb IS NOT NULL""")
def user_score_ranks(spark, sf):
    """A scoring function of the user, ranked like the built-in ones."""
    mine = register(Score("query_mix", "Mix", False, "user", source="mix"))
    data = poses(spark, sf).withColumn("mix", F.col("score_vina") + 2 * F.col("score_deltalinf9xgb"))
    ranked = C.rank_scores(data, [mine.key], rows=C.profile(data, [mine.key]).rows)
    return ranked.select("target", "ligand", "pose", F.col(mine.rank_column).alias("rank")).filter("rank IS NOT NULL")


@query("partial_csv_text", f"""WITH {POSES}
SELECT target, ligand, pose, CASE WHEN score_vina IS NULL THEN '' ELSE printf('%.6f', score_vina) END AS score_vina,
  CASE WHEN score_cnnaffinity IS NULL THEN '' ELSE printf('%.6f', score_cnnaffinity) END AS score_cnnaffinity, '' AS score_ad4 FROM poses""")
def partial_csv_text(spark, sf):
    return partial_csv_rows(poses(spark, sf)).select(
        "target", "ligand", "pose", *[F.coalesce(c, F.lit("")).alias(c) for c in ("score_vina", "score_cnnaffinity", "score_ad4")])
