"""Evaluation operators against brute force in numpy."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenmeld.functions import stats
from screenmeld.functions.grids import parameter_grid, weight_grid
from screenmeld.operators import bootstrap as B
from screenmeld.operators import correlate as R
from screenmeld.operators import evaluate as E
from screenmeld.operators import search as S


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return [("t", "s", f"l{i:03d}", int(rng.random() < 0.3), float(rng.randint(0, 25))) for i in range(120)]


@pytest.fixture(scope="module")
def long(spark, rows):
    return spark.createDataFrame(rows, "target string, score string, ligand string, active int, key double")


def brute_auc(rows):
    pos = [r[4] for r in rows if r[3]]
    neg = [r[4] for r in rows if not r[3]]
    return sum((p < n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)


def brute_ap(rows):
    total, ap, tp, n = sum(r[3] for r in rows), 0.0, 0, 0
    for k in sorted({r[4] for r in rows}):
        at = [r[3] for r in rows if r[4] == k]
        tp, n = tp + sum(at), n + len(at)
        ap += sum(at) * tp / n / total
    return ap


@pytest.mark.parametrize("split", [False, True])
def test_metrics(spark, long, rows, split, request):
    if split:
        request.getfixturevalue("tiny_tasks")
    got = E.ranking_metrics(long, fractions=(0.01, 0.05, 0.1)).first()
    assert got["auc"] == pytest.approx(brute_auc(rows))
    assert got["auprc"] == pytest.approx(brute_ap(rows))
    best = sorted(rows, key=lambda r: (r[4], r[2]))
    pos = sum(r[3] for r in rows)
    for f, n in ((0.01, 2), (0.05, 6), (0.1, 12)):
        assert got[E.ef_name(f)] == pytest.approx(sum(r[3] for r in best[:n]) / (f * pos))
    assert E.auc_and_ap(long).first()["auc"] == pytest.approx(brute_auc(rows))


def test_auc_of_reversed_ranking(long):
    a = E.auc_and_ap(long).first()["auc"]
    b = E.auc_and_ap(long.withColumn("key", -F.col("key"))).first()["auc"]
    assert a + b == pytest.approx(1.0)


def test_single_class_gives_null(spark):
    df = spark.createDataFrame([("t", "s", "a", 1, 1.0), ("t", "s", "b", 1, 2.0)],
                               "target string, score string, ligand string, active int, key double")
    row = E.ranking_metrics(df).first()
    assert row["auc"] is None and row["auprc"] is None
    none = E.ranking_metrics(df.withColumn("active", F.lit(0))).first()
    assert none["auc"] is None and none["ef1"] is None
    assert E.cohens_d(df).first()["cohens_d"] is None


def test_labels_and_directions(spark):
    df = spark.createDataFrame([("t", "x_a", 0.9, float("nan")), ("t", "y_d", 0.1, 2.0), ("t", "z", 0.5, 1.0)],
                               "target string, ligand string, hi double, lo double")
    kept = E.with_labels(df)
    assert {r["ligand"]: r["active"] for r in kept.collect()} == {"x_a": 1, "y_d": 0}
    long = {(r["score"], r["ligand"]): r["key"] for r in E.labelled(kept, {"hi": True, "lo": False}).collect()}
    assert long == {("hi", "x_a"): -0.9, ("hi", "y_d"): -0.1, ("lo", "y_d"): 2.0}


def test_separation(long, rows):
    a = np.array([r[4] for r in rows if r[3]])
    d = np.array([r[4] for r in rows if not r[3]])
    pooled = math.sqrt(((len(a) - 1) * a.var(ddof=1) + (len(d) - 1) * d.var(ddof=1)) / (len(a) + len(d) - 2))
    assert E.cohens_d(long).first()["cohens_d"] == pytest.approx((d.mean() - a.mean()) / pooled)
    grid = np.unique(np.concatenate([a, d]))
    ks = max(abs((a <= g).mean() - (d <= g).mean()) for g in grid)
    assert E.ks_statistic(long).first()["ks_stat"] == pytest.approx(ks)


def brute_tau(x, y):
    s = sx = sy = 0
    for i, j in itertools.combinations(range(len(x)), 2):
        a, b = np.sign(x[i] - x[j]), np.sign(y[i] - y[j])
        s, sx, sy = s + a * b, sx + abs(a), sy + abs(b)
    return s / math.sqrt(sx) / math.sqrt(sy)


@pytest.mark.parametrize("split", [False, True])
def test_correlations(spark, split, request):
    rng = random.Random(8)
    data = [("t", f"l{i}", i % 5 == 0, float(rng.randint(0, 30)), float(rng.randint(0, 400)) / 7)
            for i in range(90)]
    data = [(t, l, int(a), x, y + x) for t, l, a, x, y in data]
    df = spark.createDataFrame(data, "target string, ligand string, active int, p double, q double")
    if split:
        request.getfixturevalue("tiny_tasks")
    got = {r["subset"]: r for r in R.all_correlations(df, ["p", "q"]).collect()}
    for subset in ("all", "actives"):
        part = [r for r in data if subset == "all" or r[2]]
        x, y = np.array([r[3] for r in part]), np.array([r[4] for r in part])
        rank = lambda v: np.array([(v < u).sum() + ((v == u).sum() + 1) / 2 for u in v])
        r = got[subset]
        assert r["n"] == len(part)
        assert r["pearson"] == pytest.approx(np.corrcoef(x, y)[0, 1])
        assert r["spearman"] == pytest.approx(np.corrcoef(rank(x), rank(y))[0, 1])
        assert r["kendall"] == pytest.approx(brute_tau(x, y))
        assert 0 <= r["kendall_p"] <= 1


def test_p_values(spark):
    # for n = 10 the distribution of r is a polynomial: p(0.5) = 289 / 2048; for n = 3 it is 1 - 2 asin(r) / pi
    rows = spark.createDataFrame([(0.5, 10), (0.1, 100), (1.0, 10), (0.0, 10), (float("nan"), 10), (0.6, 3), (0.5, 2), (1e-4, 10**9)],
                                 "r double, n long")
    got = [r[0] for r in rows.select(stats.correlation_p(F.col("r"), F.col("n"))).collect()]
    assert got[:4] == pytest.approx([289 / 2048, 0.322217, 0.0, 1.0], abs=2e-6)
    assert got[4] is None and got[6] is None
    assert got[5] == pytest.approx(1 - 2 * math.asin(0.6) / math.pi, abs=1e-9)
    assert got[7] == pytest.approx(math.erfc(1e-4 * math.sqrt(1e9 / 2)), abs=1e-6)
    z = spark.createDataFrame([(0.0,), (-1.5,), (4.0,), (30.0,), (None,)], "z double")
    two = [r[0] for r in z.select(stats.normal_two_sided_p(F.col("z"))).collect()]
    assert two[:4] == pytest.approx([math.erfc(x / math.sqrt(2)) for x in (0, 1.5, 4, 30)], abs=1e-9) and two[4] is None


def test_p_texts(spark):
    df = spark.createDataFrame([(0.0001,), (0.004,), (0.03,), (0.5,), (None,)], "p double")
    rows = df.select(stats.p_label(F.col("p")), stats.p_stars(F.col("p"))).collect()
    assert [tuple(r) for r in rows] == [("p < 0.001", "***"), ("p < 0.01", "**"), ("p < 0.05", "*"),
                                        ("p = 0.500", ""), ("n/a", "")]
    grid = spark.range(1).select(stats.linspace(F.lit(0.0), F.lit(1.0), 5)).first()[0]
    assert grid == pytest.approx([0, .25, .5, .75, 1])


def test_kolmogorov_limit(spark):
    # lambda = 1 has probability 0.26999967
    df = spark.range(1).select(stats.kolmogorov_p(F.lit(0.1), F.lit(200), F.lit(200)).alias("p"))
    assert df.first()["p"] == pytest.approx(0.2699996, abs=1e-6)


def test_bootstrap_is_exact_and_repeatable(spark, long, rows):
    ligands = long.select("target", "ligand", "active")
    a = B.bootstrap_weights(ligands, 15)
    sizes = a.groupBy("replicate", "active").agg(F.sum("weight").alias("n")).collect()
    pos = sum(r[3] for r in rows)
    assert {(r["active"], r["n"]) for r in sizes} == {(1, pos), (0, len(rows) - pos)}
    assert sorted(a.collect()) == sorted(B.bootstrap_weights(ligands.repartition(5), 15).collect())
    other = B.bootstrap_weights(ligands, 15, seed=7)
    assert sorted(a.collect()) != sorted(other.collect())


@pytest.mark.parametrize("size", [3, 40, 2048])
def test_bootstrap_metrics_against_expanded_rows(spark, long, rows, size, monkeypatch):
    monkeypatch.setattr(B, "RANGE_ROWS", size)  # equal keys lie in several ranges
    monkeypatch.setattr(B, "BLOCK", max(size, 7))
    ligands = long.select("target", "ligand", "active")
    got = {r["replicate"]: r for r in B.bootstrap_metrics(long, ligands, 5).collect()}
    weights = B.bootstrap_weights(ligands, 5).collect()
    key = {r[2]: r for r in rows}
    for b in range(5):
        drawn = [key[w["ligand"]] for w in weights if w["replicate"] == b for _ in range(w["weight"])]
        assert got[b]["auc"] == pytest.approx(brute_auc(drawn))
        assert got[b]["auprc"] == pytest.approx(brute_ap(drawn))
        best = sorted(drawn, key=lambda r: (r[4], r[2]))
        pos = sum(r[3] for r in drawn)
        assert got[b]["ef10"] == pytest.approx(sum(r[3] for r in best[:12]) / (0.1 * pos))
    few = B.confidence_intervals(B.bootstrap_metrics(long, ligands, 5))
    assert few.filter("lo IS NOT NULL").count() == 0  # needs more than ten replicates


def test_interpolation(spark):
    pts = [(0.0, 0.0), (0.3, 0.5), (0.31, 0.7), (1.0, 1.0)]
    df = spark.createDataFrame([("c", *p) for p in pts], "g string, x double, y double")
    got = [r["y"] for r in B.interpolate(df, ["g"], 50).orderBy("i").collect()]
    want = np.interp(np.linspace(0, 1, 50), [p[0] for p in pts], [p[1] for p in pts])
    assert got == pytest.approx(list(want))


def test_weight_grid():
    assert [len(weight_grid(k)) for k in (1, 2, 3, 4)] == [1, 11, 66, 286]
    assert weight_grid(2, 0.5) == [(0.0, 1.0), (0.5, 0.5), (1.0, 0.0)]
    assert all(sum(w) == pytest.approx(1) for w in weight_grid(3))


def test_leave_one_out_equals_medians(spark):
    rng = random.Random(2)
    vals = {(t, g): (None if rng.random() < 0.2 else float(rng.randint(0, 6)))
            for t in "abcdefg" for g in range(6)}
    df = spark.createDataFrame([(t, g, v) for (t, g), v in vals.items()], "target string, gid int, ef1 double")
    for how, fn in (("median", np.median), ("mean", np.mean)):
        for r in S.leave_one_out(df, how=how).collect():
            rest = [v for (t, g), v in vals.items() if g == r["gid"] and t != r["test_target"] and v is not None]
            assert r["value"] == pytest.approx(fn(rest)) if rest else r["value"] is None


def brute_grid(poses, grid, scores):
    """Metric EF1 of every grid point by direct computation."""
    out = {}
    for t in {p["target"] for p in poses}:
        mine = [p for p in poses if p["target"] == t]
        n = len(mine)
        for g in grid:
            sigma, best = max(n / g.sigma, 1.0), {}
            for p in mine:
                v = 0.0
                for s, w in zip(scores, g.weights):
                    x = p[f"score_{s}"]
                    if x is not None:
                        r = 1 + sum(q[f"score_{s}"] is not None and q[f"score_{s}"] < x for q in mine)
                        v += w * math.exp(-r / sigma)
                best[p["ligand"]] = (max(best.get(p["ligand"], (0.0,))[0], v), p["active"])
            order = sorted(((-round(v, 12), lig, a) for lig, (v, a) in best.items()))
            pos = sum(a for _, _, a in order)
            k = max(1, math.ceil(0.01 * len(order)))
            out[t, g.gid] = sum(a for _, _, a in order[:k]) / (0.01 * pos) if pos else None
    return out


def test_grid_against_brute_force(spark, tiny_tasks):
    rng = random.Random(4)
    rows = [(t, f"l{i}", p, int(i % 4 == 0), -rng.random(), None if rng.random() < .2 else -float(rng.randint(0, 9)))
            for t in "xyz" for i in range(12) for p in (1, 2, 70)]
    df = spark.createDataFrame(rows, "target string, ligand string, pose int, active int, "
                                     "score_vina double, score_cnnscore double")
    scores, grid = ["vina", "cnnscore"], parameter_grid(["vina", "cnnscore"], (2, 4), 0.5)
    want = brute_grid([r.asDict() for r in df.collect()], grid, scores)
    metrics = S.grid_metrics(df, scores, grid)
    got = {(r["target"], r["gid"]): r["ef1"] for r in metrics.collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    best = S.oracle_params(metrics, S.grid_table(metrics, scores, grid)).collect()
    for r in best:
        top = max(v for (t, g), v in want.items() if t == r["target"] and grid[g].kind == "grid")
        assert want[r["target"], r["gid"]] == pytest.approx(top)
        assert r["gid"] == min(g for (t, g), v in want.items()
                               if t == r["target"] and grid[g].kind == "grid" and v == pytest.approx(top))


def test_cross_validation_needs_three_targets(spark):
    df = spark.createDataFrame([("a", "l", 1, 1, -1.0)], "target string, ligand string, pose int, active int, "
                                                        "score_vina double")
    with pytest.raises(ValueError):
        S.cross_validation(df, ["vina"], parameter_grid(["vina"], (4,), 0.5))


@pytest.mark.parametrize("head", ["42|AF|0|7|", "x" * 50, "y" * 63, "z" * 130])
def test_hashes_of_arrays_are_md5(head):
    from hashlib import md5
    for first in (0, 95, 123_450):
        slots = range(first, first + 5)
        for length in {len(str(k)) for k in slots}:
            names = [str(k) for k in slots if len(str(k)) == length]
            digits = np.array([list(n.encode()) for n in names], np.uint8).T
            assert B._hashes(head.encode(), digits).tolist() == [
                int(md5((head + n).encode()).hexdigest()[:8], 16) for n in names]


def test_counts_of_draws_are_not_broadcast(spark):
    """Counts per block are as large as the weights, though they come from a few rows of sizes."""
    table = spark.createDataFrame([("t", f"l{k}", k % 2) for k in range(50)], "target string, ligand string, active int")
    plan = B.bootstrap_weights(table, 12)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Broadcast" not in plan


def test_listed_bootstrap_equals_shuffled_draws(spark, monkeypatch):
    rng = random.Random(8)
    ligands = [(t, f"l{k}", int(rng.random() < share)) for t, n, share in (("hot", 150, .2), ("few", 3, .5), ("none", 9, 0))
               for k in range(n)]
    long = spark.createDataFrame([(t, s, x, a, float(rng.randint(-4, 4))) for t, x, a in ligands for s in ("u", "v")
                                  if rng.random() < 0.9], "target string, score string, ligand string, active int, key double")
    table = spark.createDataFrame(ligands, "target string, ligand string, active int")
    monkeypatch.setattr(B, "ROWS_PER_RANGE", 30)  # equal keys lie in several ranges and batches
    monkeypatch.setattr(B, "BLOCK", 64)
    monkeypatch.setattr(B, "NAMES_PER_BLOCK", 40)
    monkeypatch.setattr(B, "HASHES_AT_ONCE", 16)
    monkeypatch.setattr(B, "REPLICATES_PER_TASK", 5)

    def runs():
        found = {"weights": B.bootstrap_weights(table, 12), "metrics": B.bootstrap_metrics(long, table, 12, scores=2),
                 **{k: B.bootstrap_band(long, table, k, 12, scores=2) for k in ("roc", "pr")}}
        return {k: (df.columns, sorted(map(tuple, df.collect()), key=str)) for k, df in found.items()}

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        got = runs()
        monkeypatch.setattr(B, "MOST_LIGANDS", -1)
        want = runs()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for name, (columns, rows) in want.items():
        assert sorted(got[name][0]) == sorted(columns) and len(got[name][1]) == len(rows) > 0, name
        by = [c for c in columns if c in ("target", "score", "ligand", "replicate", "i")]
        as_map = lambda cols, rows: {tuple(dict(zip(cols, r))[c] for c in by): dict(zip(cols, r)) for r in rows}
        mine, theirs = as_map(*got[name]), as_map(columns, rows)
        assert mine.keys() == theirs.keys()
        for k, row in theirs.items():
            assert mine[k] == pytest.approx(row, abs=1e-9), (name, k)


def test_spearman_ranks_wide_groups_in_cells(spark, monkeypatch):
    """Groups under the rows of a task, but over those of a range, aren't sorted whole in one task."""
    from screenmeld.operators import correlate, ordering

    monkeypatch.setattr(ordering, "ROWS_PER_RANGE", 50)
    names = []
    real = ordering.stage
    monkeypatch.setattr(ordering, "stage", lambda d, name="stage": names.append(name) or real(d, name))
    rows = [("t", "all", "a", "b", str(i), float(i * 7 % 90), float(i * i % 31)) for i in range(300)]
    df = spark.createDataFrame(rows, "target string, subset string, score_x string, score_y string, ligand string, x double, y double")
    got = correlate.spearman(df).first()
    pdf = df.select("x", "y").toPandas()
    assert got["spearman"] == pytest.approx(pdf["x"].rank().corr(pdf["y"].rank()), abs=1e-12)
    assert names == ["pairs", "spans", "starts", "spans", "starts"]


def test_wide_pairs_carry_a_number_for_their_group(spark, tiny_tasks, monkeypatch):
    from screenmeld.operators import correlate

    groups, ranked = [], correlate.rank_rows
    monkeypatch.setattr(correlate, "rank_rows", lambda df, group, *a, **k: groups.append((group, df.columns)) or ranked(df, group, *a, **k))
    rows = [(t, "all", "a", b, str(i), float(i * 7 % 90), float(i * i % 31)) for t in ("t", None) for b in ("b", "c") for i in range(60)]
    df = spark.createDataFrame(rows, "target string, subset string, score_x string, score_y string, ligand string, x double, y double")
    got = {tuple(r)[:4]: tuple(r)[4:] for r in correlate.spearman(df).collect()}
    pdf = df.limit(60).select("x", "y").toPandas()
    want = pytest.approx(pdf["x"].rank().corr(pdf["y"].rank()), abs=1e-12)
    assert got == {(t, "all", "a", b): (60, want) for t in ("t", None) for b in ("b", "c")}
    assert groups[0] == (["_group"], ["_group", "x", "y"])


def test_staged_files_are_short(spark, monkeypatch):
    """A task that reads staged rows gets a bounded number of them, however well they are compressed."""
    from screenmeld import session

    monkeypatch.setattr(session, "ROWS_PER_FILE", 100)
    files = session.stage(spark.range(950).coalesce(1)).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == 950 and max(r["count"] for r in files) <= 100
