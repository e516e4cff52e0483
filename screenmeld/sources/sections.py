"""Files with section headers: pocket lists, target configs, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmeld.functions.names import safe_label
from screenmeld.functions.numbers import truthy
from screenmeld.operators.ordering import Rows, cumulate, fill_down, rank_rows

# Header patterns of pocket lists and display names of weights.
POCKET_HEADER = r"(?i)^#\s*pocket[\s_:.-]*(.*)$"
COLUMN_HEADER = r"(?i)^#.*\b(rank|smiles)\b"
WEIGHT_LABELS = {
    "w_vina": "AutoDock Vina",
    "w_vinardo": "Vinardo",
    "w_ad4": "AutoDock4",
    "w_cnnaffinity": "GNINA CNNaffinity (pK)",
    "w_cnnscore": "GNINA CNNscore (0-1)",
    "w_deltalinf9xgb": "Delta-Lin_F9XGB",
    "w_dense_cnnaffinity": "GNINA dense CNNaffinity (pK)",
    "w_dense_cnnscore": "GNINA dense CNNscore (0-1)",
}

_BLANK = " \t\r"


def _stripped(rows: DataFrame) -> DataFrame:
    return rows.withColumn("value", F.btrim("value", F.lit(_BLANK)))


def pocket_lines(rows: DataFrame, bound: Rows = None) -> DataFrame:
    """Classified lines of pocket lists with the pocket they belong to.

    ``kind`` is ``entry``, ``header``, ``columns`` or a reason for rejection.
    """
    text = _stripped(rows).filter(F.col("value") != "")
    value = F.col("value")
    is_comment = value.startswith("#")
    is_pocket = value.rlike(POCKET_HEADER)
    label = F.btrim(F.regexp_extract(value, POCKET_HEADER, 1))
    pocket = F.when(is_pocket, F.when(label == "", F.lit("POCKET")).otherwise(
        F.concat(F.lit("POCKET_"), safe_label(label))))
    filled = fill_down(text, ["path"], ["block", "seq"], {"pocket": pocket}, bound)
    separator = (F.when(value.contains(","), ",").when(value.contains("\t"), "\t")
                 .when(value.contains(";"), ";"))
    parts = F.transform(F.split(value, separator), lambda p: F.btrim(p, F.lit(_BLANK)))
    cut = filled.select("*", separator.alias("_sep"), parts.alias("_parts"))
    smiles = F.get("_parts", F.lit(1))
    kind = (F.when(is_pocket, "header").when(is_comment & value.rlike(COLUMN_HEADER), "columns")
            .when(is_comment, "unknown comment").when(F.col("_sep").isNull(), "no separator")
            .when(smiles.isNull() | (smiles == ""), "no smiles").otherwise("entry"))
    return cut.select("path", "block", "seq", "value", kind.alias("kind"),
                      F.coalesce("pocket", F.lit("UNASSIGNED")).alias("pocket"),
                      F.get("_parts", F.lit(0)).alias("rank_text"), smiles.alias("smiles"))


def pocket_entries(rows: DataFrame, bound: Rows = None) -> DataFrame:
    """(path, pocket, rank, smiles, block, seq); a rank that is no number becomes
    the running number of the entry in its file."""
    entries = pocket_lines(rows, bound).filter("kind = 'entry'")
    numbered = rank_rows(entries, ["path"], ["block", "seq"], "_running", "first", bound)
    given = F.when(F.col("rank_text").rlike(r"^[+-]?\d+$"), F.col("rank_text").try_cast("long"))
    return numbered.select("path", "pocket", F.coalesce(given, F.col("_running")).alias("rank"),
                           "smiles", "block", "seq")


def pocket_rejects(rows: DataFrame, bound: Rows = None) -> DataFrame:
    return pocket_lines(rows, bound).filter(
        F.col("kind").isin("unknown comment", "no separator", "no smiles"))


def _numbers(value: Column) -> Column:
    inner = F.regexp_extract(value, r"\[([^\]]+)\]", 1)
    return F.when(inner != "", F.transform(
        F.split(inner, ","), lambda x: F.btrim(x).try_cast("double")))


def target_blocks(rows: DataFrame, bound: Rows = None) -> DataFrame:
    """One row per block of a target config, with ``problem`` where it is broken.

    A block ends at a blank line or at the next name. Any number of config
    files is read in one pass.
    """
    text = _stripped(rows).filter(~F.col("value").startswith("#"))
    value, upper = F.col("value"), F.upper("value")
    kind = (F.when(value == "", "blank").when(upper.startswith("CENTER"), "center")
            .when(upper.startswith("BOX_SIZE"), "box_size")
            .when(upper.startswith("LIGAND_SUBDIR") & value.contains("="), "ligand_subdir")
            .when(value.rlike(r"^[\w-]+$"), "name").otherwise("unknown"))
    typed = text.withColumn("kind", kind)
    starts = F.col("kind").isin("blank", "name").cast("int")
    blocks = cumulate(typed, ["path"], ["block", "seq"], {"_starts": starts}, bound)
    # a name opens its block, a blank line closes the one before it
    data = blocks.filter("kind <> 'blank'")
    pick = lambda k, c: F.max_by(F.when(F.col("kind") == k, c),
                                 F.when(F.col("kind") == k, F.struct("block", "seq")))
    part = data.groupBy("path", F.col("_starts").alias("no")).agg(
        pick("name", value).alias("target"), pick("center", _numbers(value)).alias("center"),
        pick("box_size", _numbers(value)).alias("box_size"),
        pick("ligand_subdir", F.btrim(F.regexp_extract(value, "=(.*)$", 1))).alias("ligand_subdir"),
        F.min(F.when(F.col("kind") == "unknown", value)).alias("_unknown"))
    missing = F.array_compact(F.array(*[
        F.when(F.col(c).isNull(), F.lit(n)) for c, n in
        (("target", "name"), ("center", "center"), ("box_size", "box_size"))]))
    problem = (F.when(F.col("_unknown").isNotNull(), F.concat(F.lit("unknown line: "), "_unknown"))
               .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", "))))
    return part.select("path", "no", "target", "center", "box_size", "ligand_subdir",
                       problem.alias("problem"))


def targets(blocks: DataFrame, receptors: DataFrame | None = None) -> DataFrame:
    """Usable targets; ``receptors(target)`` lists the structures that exist."""
    good = blocks.filter("problem IS NULL").select("target", "center", "box_size", "ligand_subdir")
    return good if receptors is None else good.join(receptors.select("target"), "target", "left_semi")


def targets_without_receptor(blocks: DataFrame, receptors: DataFrame) -> DataFrame:
    return blocks.filter("problem IS NULL").join(receptors.select("target"), "target", "left_anti")


def settings(rows: DataFrame, bound: Rows = None) -> DataFrame:
    """Long (run, section, key, value, block, seq) rows of INI-like text.

    Comments behind ``#`` and ``;`` are cut off, sections are upper case, keys
    lower case; lines before the first section belong to ``_GLOBAL``. The run
    is the file.
    """
    bare = F.btrim(F.regexp_replace("value", "[#;].*$", ""), F.lit(_BLANK))
    text = rows.withColumn("value", bare).filter(F.col("value") != "")
    header = F.col("value").rlike(r"^\[.*\]$")
    section = F.when(header, F.upper(F.btrim(F.regexp_extract("value", r"^\[(.*)\]$", 1))))
    filled = fill_down(text, ["path"], ["block", "seq"], {"section": section}, bound)
    at = F.instr("value", "=")
    return filled.filter(~header & (at > 0)).select(
        F.col("path").alias("run"), F.coalesce("section", F.lit("_GLOBAL")).alias("section"),
        F.lower(F.btrim(F.substring("value", F.lit(1), at - 1))).alias("key"),
        F.btrim(F.expr("substring(value, instr(value, '=') + 1)")).alias("value"), "block", "seq")


def latest_settings(pairs: DataFrame) -> DataFrame:
    """The last value of each (run, section, key)."""
    return pairs.groupBy("run", "section", "key").agg(
        F.max_by("value", F.struct("block", "seq")).alias("value"),
        F.min(F.struct("block", "seq")).alias("first_at"))


def manifest_weights(pairs: DataFrame) -> DataFrame:
    """Non-zero weights of each run with display name, sum and rank by size."""
    known = latest_settings(pairs).filter(F.col("key").startswith("w_"))
    names = F.create_map(*[F.lit(x) for kv in WEIGHT_LABELS.items() for x in kv])
    number = F.btrim("value").try_cast("double")
    rows = known.select("run", F.coalesce(F.try_element_at(names, F.col("key")), F.col("key"))
                        .alias("label"), number.alias("weight"), "first_at").filter("weight <> 0")
    return rows.groupBy("run", "label").agg(F.min_by("weight", "first_at").alias("weight"))


# Switches of the scoring functions and other settings that a summary shows.
SCORE_FLAGS = {"Vina": "vina_enabled", "Vinardo": "vinardo_enabled", "AD4": "ad4_enabled",
               "CNNaffinity": "cnnaffinity_enabled", "CNNscore": "cnnscore_enabled",
               "dense": "dense_enabled", "Delta-Lin_F9XGB": "deltalinf9xgb_enabled"}
SUMMARY_KEYS = ("sigma_fraction", "cluster_poses", "cluster_rmsd_cutoff", "binary", "scoring", "search_mode",
                "exhaustiveness", "num_modes", "energy_range", "seed", "gnina_use_gpu", "dense_model",
                "cnn_model", "enabled")


def manifest_summary(pairs: DataFrame) -> DataFrame:
    """One row per run: weights, flags, sigma, clustering and docking settings."""
    keys = latest_settings(pairs)
    # the first section that has a key wins
    value = lambda k: F.min_by(F.when(F.col("key") == k, F.col("value")),
                               F.when(F.col("key") == k, F.col("first_at")))
    wide = keys.groupBy("run").agg(*[value(k).alias(k) for k in (*SCORE_FLAGS.values(), *SUMMARY_KEYS)])
    weights = manifest_weights(pairs).groupBy("run").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("weight", "label")), asc=False),
                    lambda w: F.concat(w["label"], F.lit("="), w["weight"].cast("string")))
        .alias("weights"), F.sum("weight").alias("weight_sum"))
    on = F.array_compact(F.array(*[F.when(truthy(F.col(k)), F.lit(n)) for n, k in SCORE_FLAGS.items()]))
    dash = lambda k: F.coalesce(k, F.lit("-"))
    models = F.array_compact(F.array(
        F.when(truthy(F.col("dense_enabled")), dash("dense_model")),
        F.when(truthy(F.col("cnnaffinity_enabled")) | truthy(F.col("cnnscore_enabled")),
               dash("cnn_model")),
        F.when(truthy(F.col("deltalinf9xgb_enabled")), F.lit("Delta-Lin_F9XGB"))))
    clustering = F.when(truthy(F.col("cluster_poses")), F.concat(
        F.lit("RMSD "), F.coalesce("cluster_rmsd_cutoff", F.lit("?")))).otherwise("off")
    seed = F.when(F.btrim("seed") == "0", "random").otherwise(F.coalesce(F.nullif("seed", F.lit("")),
                                                                       F.lit("-")))
    return wide.join(weights, "run", "left").select(
        "run", "weights", "weight_sum", on.alias("active_scores"), models.alias("models"),
        dash("sigma_fraction").alias("sigma_fraction"), clustering.alias("clustering"),
        *[dash(c).alias(c) for c in ("binary", "scoring", "search_mode", "exhaustiveness",
                                     "num_modes", "energy_range")],
        seed.alias("seed"), F.coalesce(truthy(F.col("gnina_use_gpu")), F.lit(False)).alias("gpu"),
        truthy(F.coalesce("enabled", F.lit("true"))).alias("rescoring"))
