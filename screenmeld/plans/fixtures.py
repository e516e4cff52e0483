"""Screening tables derived from the given TPC-H-like tables, for Spark and DuckDB.

Each Spark function has a SQL twin of the same name in capitals; the twin is a
``WITH`` member that reads the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenmeld.operators.ordering import measured, rank_rows
from screenmeld.session import stage_if_large

SCORES = ["vina", "cnnaffinity", "deltalinf9xgb"]

POSES = """poses AS (
SELECT target, ligand, CAST(pose AS INT) AS pose, active,
       score_vina, score_cnnaffinity, score_deltalinf9xgb
FROM (
  SELECT concat(l_returnflag, l_linestatus) AS target,
         concat('lig_', CAST(l_partkey AS VARCHAR),
                CASE WHEN l_partkey % 20 = 0 THEN '_a' ELSE '_d' END) AS ligand,
         CASE WHEN l_partkey % 20 = 0 THEN 1 ELSE 0 END AS active,
         row_number() OVER (PARTITION BY l_returnflag, l_linestatus, l_partkey
           ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey,
                    l_quantity, l_discount, l_tax, l_shipdate) AS pose,
         -l_extendedprice / 10000.0 AS score_vina,
         CASE WHEN l_linenumber = 7 THEN NULL
              ELSE -(l_quantity / 10.0 + l_discount) END AS score_cnnaffinity,
         CASE WHEN l_tax = 0.08 THEN NULL
              ELSE -(l_discount * 50 + l_tax * 10) END AS score_deltalinf9xgb
  FROM lineitem) t)"""

# pose 1 of every ligand
POSE1 = POSES + ", pose1 AS (SELECT * FROM poses WHERE pose = 1)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_count(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Rows of a table from the Parquet footers."""
    return table(spark, sf_dir, name).count()


def poses(spark: SparkSession, sf_dir: str, numbered: bool = True) -> DataFrame:
    """Line items as poses: target = flags, ligand = part, pose = price order.

    Without ``numbered`` all poses come without their number, so none is ordered or written.
    """
    rows = row_count(spark, sf_dir, "lineitem")
    items = table(spark, sf_dir, "lineitem")
    suffix = F.when(F.col("l_partkey") % 20 == 0, "_a").otherwise("_d")
    based = items.select(
        F.concat("l_returnflag", "l_linestatus").alias("target"), "l_partkey",
        (-F.col("l_extendedprice")).alias("_price"), "l_orderkey", "l_linenumber", "l_suppkey",
        "l_quantity", "l_discount", "l_tax",
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("_ship"))
    order = ["_price", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_discount",
             "l_tax", "_ship"]
    key = ["l_partkey", "target"]  # a ligand is a part; its name is made after the sort
    placed = rank_rows(based, key, order, "pose", "first", measured(based, key, rows)) if numbered else based
    ready = placed.select(
        "target", F.concat(F.lit("lig_"), F.col("l_partkey").cast("string"), suffix).alias("ligand"),
        *([F.col("pose").cast("int").alias("pose")] if numbered else []), F.when(F.col("l_partkey") % 20 == 0, 1).otherwise(0).alias("active"),
        (F.col("_price") / 10000.0).alias("score_vina"),
        F.when(F.col("l_linenumber") != 7, -(F.col("l_quantity") / 10.0 + F.col("l_discount")))
        .alias("score_cnnaffinity"),
        F.when(F.col("l_tax") != 0.08, -(F.col("l_discount") * 50 + F.col("l_tax") * 10))
        .alias("score_deltalinf9xgb"))
    return stage_if_large(ready, rows, "poses") if numbered else ready


def pose1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best-priced line per (target, part); needs no ordering, only one aggregate."""
    return poses(spark, sf_dir).filter("pose = 1")
