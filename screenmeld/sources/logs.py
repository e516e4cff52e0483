"""Run logs and scorer output as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenmeld.operators.ordering import MOST_STARTS, Rows, bound_of, fill_down, join_groups
from screenmeld.session import rows_per_task, stage
from screenmeld.sources.records import PIECE, pieces

# Line patterns of run logs and scorer output.
TARGET_LINE = r"===\s+TARGET\s+\d+/\d+:\s+(\S+)\s+==="
ANY_TARGET = r"===\s+TARGET\s+\d+/\d+:"
SUCCESS_LINE = r"\[\w[\w\s]*\]\s+\[\d+/\d+\]\s+(\S+)\s+([-\d.]+)\s+kcal/mol"
TABLE_ROW = r"(?m)^\s*1\s+([-\d.]+)\s+([-\d.]+)\s+([-\d.]+)\s+([-\d.]+)"
LONGEST = 2**31 - 1


def completed_from_log(rows: DataFrame, bound: Rows = None) -> DataFrame:
    """(path, target, ligand, energy): ligands reported done in a target's block.

    A block runs until another target or a PIPELINE/RESTART banner; lines that
    report an error do not count. The last report of a ligand wins. All targets
    of all logs are read in one pass.
    """
    value = F.col("value")
    target = F.nullif(F.regexp_extract(value, TARGET_LINE, 1), F.lit(""))
    ends = value.contains("===") & (value.rlike(ANY_TARGET) | value.contains("PIPELINE")
                                    | value.contains("RESTART"))
    mark = F.coalesce(target, F.when(ends, F.lit("")))
    filled = fill_down(rows, ["path"], ["block", "seq"], {"_target": mark}, bound)
    hits = filled.filter((F.col("_target") != "") & value.rlike(SUCCESS_LINE)
                         & ~value.contains("FEHLER") & mark.isNull())
    found = hits.select("path", F.col("_target").alias("target"), "block", "seq",
                        F.regexp_extract(value, SUCCESS_LINE, 1).alias("ligand"),
                        F.regexp_extract(value, SUCCESS_LINE, 2).try_cast("double").alias("energy"))
    last = F.max_by(F.struct("energy"), F.struct("block", "seq"))
    return found.groupBy("path", "target", "ligand").agg(last.alias("l")).select(
        "path", "target", "ligand", "l.energy")


def _in_order(lines: DataFrame, numbers: list[str], keys: list[str], order: list[str]) -> DataFrame:
    """(keys, pose, a column per number): the poses of each stretch of lines (kind, number), read once along their order.

    A line of kind 0 opens a pose. Lines ahead of the first opening are pose 0. ``numbers`` names the column of each kind.
    """
    opens = F.when(F.col("kind") == 0, 1).otherwise(0)
    pose = F.sum(opens).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)  # hashed, not sorted, where it is one number

    def last(kind: int) -> Column:
        hit = (F.col("kind") == kind) & F.col("number").isNotNull()
        return F.max_by(F.when(hit, F.col("number")), F.when(hit, place))

    numbered = lines.select(*dict.fromkeys([*keys, *order]), "kind", "number").withColumn("pose", pose)
    return numbered.groupBy(*keys, "pose").agg(*[last(kind).alias(name) for kind, name in enumerate(numbers)])


def _along_pieces(poses: DataFrame, names: list[str]) -> DataFrame:
    """Poses numbered inside their piece, as poses of the file: from a small table with a row per piece.

    It has the openings of earlier pieces, and what later pieces say of a piece's last pose ahead of their first opening.
    """
    heads = [F.max(F.when(F.col("pose") == 0, F.col(n))).alias(n) for n in names]
    earlier = Window.partitionBy("path").orderBy("block", "piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = stage(poses.groupBy(*PIECE).agg(F.max("pose").alias("_poses"), *heads).withColumn(
        "_before", F.coalesce(F.sum("_poses").over(earlier), F.lit(0))), "pieces")
    place = F.struct("block", "piece")
    said = counts.groupBy("path", F.col("_before").alias("_upto")).agg(
        *[F.max_by(F.when(F.col(n).isNotNull(), F.col(n)), F.when(F.col(n).isNotNull(), place)).alias(f"_later_{n}") for n in names])
    upto = counts.filter("_poses > 0").select(*PIECE, "_before", "_poses", (F.col("_before") + F.col("_poses")).alias("_upto"))
    small = join_groups(upto, said, ["path", "_upto"], "left").drop("_upto")
    joined = join_groups(poses.filter("pose > 0"), F.broadcast(small) if counts.count() <= MOST_STARTS else small, PIECE)
    later = lambda n: F.when(F.col("pose") == F.col("_poses"), F.col(f"_later_{n}"))
    return joined.select("path", (F.col("_before") + F.col("pose")).alias("pose"), *[F.coalesce(later(n), F.col(n)).alias(n) for n in names])


def scorer_poses(rows: DataFrame, bound: Rows = None) -> DataFrame:
    """(path, pose, affinity, cnnscore, cnnaffinity): the n-th affinity line is pose n.

    A CNN score outside [0, 1] or missing voids both CNN values of the pose. Files beyond a task are read piece by piece.
    """
    value = F.col("value")
    names = {"Affinity:": "affinity", "CNNscore:": "_s", "CNNaffinity:": "_a"}
    # by the line as it is: a filter on what was read would be moved ahead of that, and each line read twice
    named = rows.filter(reduce(Column.__or__, [value.contains(k) for k in names]))
    text = named.withColumn("value", F.btrim("value", F.lit(" \t\r")))
    # 0 to 2 and a number: narrow rows, as these are sorted
    kind = F.coalesce(*[F.when(value.startswith(k), F.lit(i).cast("byte")) for i, k in enumerate(names)])
    rest = F.btrim(F.coalesce(*[F.when(value.startswith(k), F.substring(value, len(k) + 1, LONGEST)) for k in names]))
    word = reduce(lambda w, white: F.substring_index(w, white, 1), " \t\n\x0b\f\r", rest)
    number = F.when(value.startswith("Affinity:"), word).otherwise(rest).try_cast("double")
    text = text.select("path", "block", "seq", kind.alias("kind"), number.alias("number"))
    numbers = list(names.values())
    if bound_of(rows, bound).largest <= rows_per_task(rows.sparkSession):
        part = _in_order(text, numbers, ["path"], ["block", "seq"]).filter("pose > 0")
    else:
        part = _along_pieces(stage(_in_order(pieces(text), numbers, PIECE, ["seq"]), "poses"), numbers)
    valid = F.col("_s").between(0.0, 1.0)
    return part.select("path", F.col("pose").cast("int").alias("pose"), "affinity",
                       F.when(valid, F.col("_s")).alias("cnnscore"),
                       F.when(valid, F.col("_a")).alias("cnnaffinity"))


def refinement_outputs(files: DataFrame) -> DataFrame:
    """Scores of refinement outputs: key/value lines, else row 1 of the table.

    A result needs a CNN score or an affinity; otherwise ``ok`` is false.
    """
    def cell(i: int):
        return F.nullif(F.regexp_extract("value", TABLE_ROW, i), F.lit("")).try_cast("double")

    keyed = files.select("*", *[F.try_element_at(F.filter(F.transform(
        F.regexp_extract_all("value", F.lit(rf"(?m)^\s*{k}:\s*([^\s(]+)"), F.lit(1)),
        lambda v: v.try_cast("double")), lambda v: v.isNotNull()), F.lit(-1)).alias(f"_{n}")
        for k, n in (("Affinity", "vina"), ("CNNscore", "score"), ("CNNaffinity", "aff"))])
    table = F.col("_vina").isNull() & F.col("_score").isNull()
    pick = lambda c, i: F.when(table, F.coalesce(cell(i), F.col(c))).otherwise(F.col(c))
    others = [c for c in files.columns if c != "value"]
    out = keyed.select(*others, pick("_vina", 1).alias("vina"), pick("_score", 3).alias("cnnscore"),
                       pick("_aff", 4).alias("cnnaffinity"))
    return out.withColumn("ok", F.col("cnnscore").isNotNull() | F.col("cnnaffinity").isNotNull())
