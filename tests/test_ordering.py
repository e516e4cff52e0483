"""Ordered operators: split ranges must give what one window gives."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from screenmeld.operators.ordering import (Bound, cumulate, exact_quantiles, fill_down, measured,
                                           order_preserving_index, rank_rows, with_totals)


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds a third of the rows and one value a third of that group."""
    rng = random.Random(3)
    rows = []
    for i in range(600):
        group = "hot" if i % 3 == 0 else f"g{i % 7}"
        value = 1.5 if i % 9 == 0 else float(rng.randint(0, 40))
        rows.append((group, i, value, i % 2))
    return spark.createDataFrame(rows, "grp string, id long, v double, hit int").cache()


def by_id(df, *cols):
    return {r["id"]: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("method, fn", [("min", F.rank), ("first", F.row_number)])
def test_rank_split_equals_window(skewed, tiny_tasks, method, fn):
    order = ["v"] if method == "min" else ["v", "id"]
    want = skewed.withColumn("r", fn().over(Window.partitionBy("grp").orderBy(*order)))
    got = rank_rows(skewed, ["grp"], order, "r", method)
    assert by_id(got, "r") == by_id(want, "r")


def test_average_rank(skewed, tiny_tasks):
    got = by_id(rank_rows(skewed, ["grp"], ["v"], "r", "average"), "r")
    pdf = skewed.toPandas()
    want = pdf.groupby("grp")["v"].rank(method="average")
    assert got == {int(i): (w,) for i, w in zip(pdf["id"], want)}


def test_cumulate_includes_ties(skewed, tiny_tasks):
    over = Window.partitionBy("grp").orderBy("v").rangeBetween(Window.unboundedPreceding, 0)
    want = skewed.select("id", F.sum("hit").over(over).alias("a"), F.count("id").over(over).alias("b"))
    got = cumulate(skewed, ["grp"], ["v"], {"a": F.col("hit"), "b": F.lit(1)})
    assert by_id(got, "a", "b") == by_id(want, "a", "b")


def test_fill_down(skewed, tiny_tasks):
    mark = F.when(F.col("id") % 17 == 0, F.col("id"))
    over = Window.partitionBy("grp").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.select("id", F.last(mark, ignorenulls=True).over(over).alias("m"))
    got = fill_down(skewed, ["grp"], ["id"], {"m": mark})
    assert by_id(got, "m") == by_id(want, "m")


def test_quantiles(skewed, tiny_tasks):
    probs = [0.0, 0.01, 0.5, 0.73, 1.0]
    got = {(r["grp"], r["p"]): r["value"] for r in exact_quantiles(skewed, ["grp"], "v", probs).collect()}
    pdf = skewed.toPandas()
    for (g, p), v in got.items():
        assert v == pytest.approx(pdf[pdf.grp == g]["v"].quantile(p)), (g, p)
    assert len(got) == len(probs) * pdf.grp.nunique()


def test_totals_and_index(skewed, tiny_tasks):
    got = by_id(with_totals(skewed, ["grp"], {"n": F.lit(1)}), "n")
    sizes = skewed.groupBy("grp").count().collect()
    assert {n for (n,) in got.values()} == {r["count"] for r in sizes}
    idx = order_preserving_index(skewed, ["grp"], ["v", "id"])
    for r in idx.groupBy("grp").agg(F.min("idx").alias("a"), F.max("idx").alias("b"),
                                    F.count_distinct("idx").alias("n")).collect():
        assert (r["a"], r["b"] + 1) == (0, r["n"])


def test_result_does_not_depend_on_partitioning(skewed, tiny_tasks):
    a = by_id(rank_rows(skewed.repartition(7, "id"), ["grp"], ["v", "id"], "r", "first"), "r")
    b = by_id(rank_rows(skewed.coalesce(1), ["grp"], ["v", "id"], "r", "first"), "r")
    assert a == b


def test_measured_bound(skewed, tiny_tasks):
    assert measured(skewed, ["grp"], 600) == Bound(200, 600)


def test_bad_method(skewed):
    with pytest.raises(ValueError):
        rank_rows(skewed, ["grp"], ["v"], method="dense")


def _odd(spark):
    """NULL groups, NULL, NaN and -0.0 keys, timestamps, dates, decimals, binaries and repeated keys."""
    import datetime as dt
    from decimal import Decimal
    rng = random.Random(5)
    rows = []
    for i in range(400):
        v = rng.choice([None, float("nan"), -0.0, 0.0, 1.5, float(rng.randint(-9, 9)), float("inf")])
        k = rng.randint(0, 30)
        rows.append((rng.choice(["a", "a", "b", None]), i, v,
                     rng.choice([None, dt.datetime(2024, 10, 27, k % 4, 30, 0, k)]), dt.date(2020, 1, 1 + k % 28),
                     rng.choice([None, Decimal(k) / 8]), bytes([k, 255 - k]), i % 3))
    return spark.createDataFrame(rows, "grp string, id long, v double, t timestamp, d date, n decimal(12,3), b binary, hit int")


@pytest.mark.parametrize("key", ["v", "t", "d", "n", "b"])
def test_both_paths_agree_on_odd_keys(spark, key):
    df = _odd(spark)
    runs = {
        "first": lambda: rank_rows(df, ["grp"], [key, "id"], "r", "first"),
        "min": lambda: rank_rows(df, ["grp"], [key], "r", "min"),
        "average": lambda: rank_rows(df, ["grp"], [key], "r", "average"),
        "sums": lambda: cumulate(df, ["grp"], [key], {"r": F.col("hit")}),
        "fill": lambda: fill_down(df, ["grp"], [key, "id"], {"r": F.when(F.col("hit") == 0, F.col("id"))}),
        "totals": lambda: with_totals(df, ["grp"], {"r": F.col("hit")}),
    }
    got = {}
    for size in ("1000", "25"):
        spark.conf.set("spark.screenmeld.rowsPerTask", size)
        try:
            out = {name: run() for name, run in runs.items()}
            got[size] = {name: (x.schema["r"].dataType, by_id(x, "r")) for name, x in out.items()}
        finally:
            spark.conf.unset("spark.screenmeld.rowsPerTask")
    assert got["1000"] == got["25"]


def test_ranks_follow_from_places_unless_a_key_fills_ranges(spark, tiny_tasks, monkeypatch):
    from screenmeld.operators import ordering as O
    used = []
    monkeypatch.setattr(O, "_ranked_in_place", lambda *a, run=O._ranked_in_place: used.append(a[4]) or run(*a))
    monkeypatch.setattr(O, "_range_number", lambda *a: pytest.fail("keys were searched row by row"))
    df = spark.range(900).selectExpr("if(id % 3 = 0, 'hot', concat('g', id % 50)) AS grp", "id", "double(id * 7 % 300) AS v")
    for method, fn, order in (("first", F.row_number, ["v", "id"]), ("min", F.rank, ["v"])):
        want = df.withColumn("r", fn().over(Window.partitionBy("grp").orderBy(*order)))
        assert by_id(rank_rows(df, ["grp"], order, "r", method), "r") == by_id(want, "r")
    assert used == ["first", "min"]


@pytest.mark.parametrize("method, fn", [("min", F.rank), ("first", F.row_number)])
def test_cells_rank_without_writing_rows(spark, tiny_tasks, monkeypatch, method, fn):
    """NULL keys have no rank, other special values their place, and only counts are written."""
    from screenmeld.operators import ordering

    rng = random.Random(5)
    special = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0]
    rows = [("hot" if i % 3 else None, i, special[i % 6] if i % 11 == 0 else rng.gauss(0, 5) ** 3) for i in range(600)]
    df = spark.createDataFrame(rows, "grp string, id long, v double").cache()
    names = []
    monkeypatch.setattr(ordering, "ROWS_PER_CELL", 2)
    monkeypatch.setattr(ordering, "stage", lambda d, name="stage": names.append(name) or d.cache())
    spark.conf.set("spark.screenmeld.rowsPerTask", "200")
    order = ["v"] if method == "min" else ["v", "id"]
    over = Window.partitionBy("grp").orderBy(F.col("v").asc_nulls_last(), *order[1:])
    want = df.withColumn("r", F.when(F.col("v").isNotNull(), fn().over(over).cast("long")))
    got = rank_rows(df, ["grp"], order, "r", method, source=df, unranked=True)
    assert by_id(got, "r") == by_id(want, "r")
    assert names == ["spans", "starts"]


@pytest.mark.parametrize("unranked", [True, False])
@pytest.mark.parametrize("method", ["min", "average"])
def test_few_values_rank_without_moving_rows(spark, tiny_tasks, monkeypatch, method, unranked):
    from screenmeld.operators import ordering

    monkeypatch.setattr(ordering, "ROWS_PER_VALUE", 10)
    special = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1.5, 2.5]
    df = spark.createDataFrame([("hot" if i % 3 else None, i, special[i % 7 + i % 2]) for i in range(700)], "grp string, id long, v double").cache()
    over = Window.partitionBy("grp").orderBy(F.col("v").asc_nulls_last() if unranked else F.col("v"))
    ties = (F.count(F.lit(1)).over(Window.partitionBy("grp", "v")) - 1) / 2.0
    rank = F.rank().over(over).cast("long") if method == "min" else F.rank().over(over) + ties
    want = df.withColumn("r", F.when(F.col("v").isNotNull(), rank) if unranked else rank)
    got = rank_rows(df, ["grp"], ["v"], "r", method, source=df, unranked=unranked)
    assert got.schema["r"].dataType == want.schema["r"].dataType and by_id(got, "r") == by_id(want, "r")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan


def test_tasks_of_a_window_grow_with_the_table(spark, tiny_tasks, monkeypatch):
    """Small groups are sorted by more tasks in a larger table, not by a fixed number of ever larger ones."""
    from screenmeld.operators import ordering

    monkeypatch.setattr(ordering, "ROWS_PER_RANGE", 20)
    df = spark.range(900).selectExpr("id % 300 AS grp", "id")
    bound = ordering.Bound(3, 900)
    for got in (rank_rows(df, ["grp"], ["id"], "r", "first", bound), cumulate(df, ["grp"], ["id"], {"r": F.lit(1)}, bound)):
        assert got.rdd.getNumPartitions() == 45
        assert sorted(r["r"] for r in got.collect()) == [1] * 300 + [2] * 300 + [3] * 300


def test_hashes_bound_the_largest_group(spark, tiny_tasks):
    df = spark.range(300).select((F.col("id") % 60).alias("g"))
    assert 5 <= measured(df, ["g"], 300).largest <= 25
    assert measured(spark.range(300).select(F.lit(1).alias("g")), ["g"], 300).largest == 300
