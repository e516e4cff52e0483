"""Leader clustering of the poses of one file by RMSD.

A pose file holds a handful of poses, so the sequential rule runs inside one
row as an array fold; nothing is grouped or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmeld.sources.poses import pose_bodies, heavy_atoms, ENERGY


def rmsd(a: Column, b: Column) -> Column:
    """Root mean square distance without superposition over the shorter length."""
    n = F.least(F.size(a), F.size(b))
    square = lambda d: d * d
    parts = F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda p, q: (
        square(p["x"] - q["x"]) + square(p["y"] - q["y"]) + square(p["z"] - q["z"])))
    total = F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v)
    return F.coalesce(F.sqrt(total / F.when(n > 0, n)), F.lit(float("inf")))


def leaders(poses: Column, cutoff: float) -> Column:
    """Leaders of an array of (energy, pose, coords), best energy first.

    A pose closer than ``cutoff`` to an earlier leader joins it, otherwise it
    becomes a leader. With one pose, or with a pose without coordinates, all
    are kept.
    """
    ordered = F.array_sort(poses)
    empty = F.slice(ordered, 1, 0)

    def step(kept: Column, p: Column) -> Column:
        near = F.exists(kept, lambda k: rmsd(k["coords"], p["coords"]) < cutoff)
        return F.when(near, kept).otherwise(F.concat(kept, F.array(p)))

    complete = (F.size(poses) > 1) & ~F.exists(poses, lambda p: F.size(p["coords"]) == 0)
    return F.when(complete, F.aggregate(ordered, empty, step)).otherwise(ordered)


def pose_arrays(files: DataFrame) -> DataFrame:
    """(…, poses): energy, original pose number and coordinates of each file."""
    value = F.col("value")
    others = [c for c in files.columns if c != "value"]
    parts = F.split(value, r"(?m)^ENDMDL[^\n]*\n?")
    models = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    one = lambda body, i: F.struct(
        F.nullif(F.regexp_extract(body, ENERGY, 1), F.lit("")).try_cast("double").alias("energy"),
        (i + 1).cast("int").alias("pose"), heavy_atoms(body).alias("coords"))
    return files.select(*others, F.transform(models, one).alias("poses"))


def cluster_poses(files: DataFrame, cutoff: float) -> DataFrame:
    """(…, pose, cluster_rank, energy) of the kept poses; pose numbers stay original."""
    arrays = pose_arrays(files)
    others = [c for c in arrays.columns if c != "poses"]
    kept = arrays.select(*others, F.posexplode(leaders(F.col("poses"), cutoff)))
    return kept.select(*others, F.col("col.pose").alias("pose"),
                       (F.col("pos") + 1).cast("int").alias("cluster_rank"),
                       F.col("col.energy").alias("energy"))


def filtered_text(files: DataFrame, kept: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Pose texts of the selected poses only, re-assembled per file."""
    bodies = pose_bodies(files).join(kept.select(*keys, "pose"), [*keys, "pose"], "left_semi")
    model = F.concat(F.lit("MODEL "), F.col("pose").cast("string"), F.lit("\n"), F.col("body"),
                     F.lit("\nENDMDL"))
    part = bodies.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("pose", model.alias("text")))).alias("m"))
    return part.select(*keys, F.array_join(F.transform("m", lambda s: s["text"]), "\n")
                       .alias("value"))
