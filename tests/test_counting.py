"""Grid metrics by counting decoys between actives against the ordering of every grid point."""

import random

import numpy as np
import pytest

from screenmeld.functions.grids import GridPoint
from screenmeld.operators import counting as N
from screenmeld.operators import search as S

SCORES = ["vina", "cnnaffinity"]
GRID = [GridPoint(k, "grid", s, w) for k, (s, w) in enumerate(
    (s, w) for s in (2, 4, 40) for w in ((1.0, 0.0), (0.5, 0.5), (0.3, 0.7), (0.0, 1.0)))]


def rows():
    rng = random.Random(4)
    out = []
    for target, ligands in (("hot", 150), ("small", 12), ("decoys", 20), ("actives", 3)):
        for k in range(ligands):
            active = {"decoys": 0, "actives": 1}.get(target, int(rng.random() < 0.2))
            for pose in range(1, 60 if k == 5 else rng.randint(2, 4)):
                a = rng.choice([None, -float(rng.randint(1, 12))])  # ties and missing scores
                out.append((target, f"lé{k:03d}", pose, active, a, -rng.random() if rng.random() < 0.9 else None))
    return out


@pytest.fixture(scope="module")
def poses(spark):
    return spark.createDataFrame(rows(), "target string, ligand string, pose int, active int, score_vina double, "
                                         "score_cnnaffinity double").repartition(3).cache()


@pytest.mark.parametrize("size", [30, 50_000])
def test_counting_equals_ordering(spark, poses, size, monkeypatch):
    monkeypatch.setattr(N, "POSES_PER_SLICE", size)
    table = lambda: {(r.target, r.gid): r for r in S.grid_metrics(poses, SCORES, GRID).collect()}
    got = table()
    monkeypatch.setattr(S, "MOST_ACTIVES", -1)
    want = table()
    assert got.keys() == want.keys() and len(got) == 4 * len(GRID)
    for k, r in want.items():
        for c in ("auc", "auprc", "ef1", "ef5"):
            assert got[k][c] == (r[c] if r[c] is None else pytest.approx(r[c], abs=1e-12)), (k, c)


@pytest.mark.parametrize("size", [3, 8192])
def test_lists_of_ranks_equal_ordering(spark, poses, size, monkeypatch):
    monkeypatch.setattr(N, "LIGANDS_AT_ONCE", size)
    monkeypatch.setattr(S, "MOST_ACTIVES", -1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # ligands lie in several batches
    used = []
    monkeypatch.setattr(S, "listed_metrics", lambda *a: used.append(1) or N.listed_metrics(*a))
    try:
        table = lambda: {(r.target, r.gid): r for r in S.grid_metrics(poses, SCORES, GRID).collect()}
        got = table()
        monkeypatch.setattr(S, "MOST_POSES", -1)
        want = table()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert used == [1] and got.keys() == want.keys() and len(got) == 4 * len(GRID)
    for k, r in want.items():
        for c in ("auc", "auprc", "ef1", "ef5"):
            assert got[k][c] == (r[c] if r[c] is None else pytest.approx(r[c], abs=1e-12)), (k, c)


def test_dropped_poses_are_never_best():
    rng = np.random.default_rng(1)
    for _ in range(50):
        ranks = rng.integers(1, 8, (40, 3)).astype(float)
        ranks[rng.random(ranks.shape) < 0.2] = np.inf
        kept = N._undominated(ranks)
        terms = np.exp(-ranks / 5)
        for w in rng.dirichlet([1, 1, 1], 30):
            assert (terms[kept] @ w).max() == pytest.approx((terms @ w).max())


def test_no_poses(spark, poses):
    assert S.grid_metrics(poses.limit(0), SCORES, GRID).count() == 0


def test_a_target_goes_to_few_tasks(spark, poses, monkeypatch):
    """Ranks are copied once per task that shares the sigmas of a target, not once per sigma."""
    from screenmeld.operators import consensus as C

    lists, listed = [], N._listed
    monkeypatch.setattr(S, "MOST_ACTIVES", -1)
    monkeypatch.setattr(N, "TASKS_PER_CORE", 0.1)
    monkeypatch.setattr(N, "_listed", lambda *a: lists.append(a) or listed(*a))
    got = S.grid_metrics(poses, SCORES, GRID)
    sigmas = {p.sigma for p in GRID}
    assert len(sigmas) > 1 and got.count() == C.profile(poses, SCORES).table.count() * len(GRID)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "sigmas" in plan and len(lists) == 1


def test_neighbours_drop_only_what_is_never_best():
    rng = np.random.default_rng(2)
    ligand = np.sort(rng.integers(0, 60, 900))
    ranks = rng.integers(1, 9, (3, len(ligand))).astype(float)
    ranks[rng.random(ranks.shape) < 0.2] = np.inf
    kept, terms = N._may_be_best(ranks, ligand), np.exp(-ranks / 5)
    assert kept.sum() < len(ligand) / 2
    starts = lambda x: np.append(0, np.flatnonzero(x[1:] != x[:-1]) + 1)
    for w in [*rng.dirichlet([1, 1, 1], 30), np.array([0.0, 1.0, 0.0])]:
        want = np.maximum.reduceat(w @ terms, starts(ligand))
        assert np.array_equal(np.maximum.reduceat((w @ terms)[kept], starts(ligand[kept])), want)


@pytest.mark.parametrize("most", [1, 3, 32])
def test_layers_give_the_best_of_each_ligand(most, monkeypatch):
    monkeypatch.setattr(N, "MOST_LAYERS", most)
    monkeypatch.setattr(N, "LIGANDS_AT_ONCE", 7)
    rng = np.random.default_rng(3)
    count = rng.integers(1, 9, 50)
    starts, terms = np.cumsum(count) - count, rng.random((2, count.sum()))
    layers = N._Layers(starts, count.sum())
    assert sorted(layers.poses) == list(range(count.sum()))
    best = layers.best((0.3, 0.7), terms[:, layers.poses])
    assert np.array_equal(best, np.maximum.reduceat(0.3 * terms[0] + 0.7 * terms[1], starts)[layers.order])


def test_packed_ranks_leave_out_dominated_poses_and_mix_targets():
    import pyarrow as pa
    rows = [("a", "l1", 0, 3), ("b", "l1", 0, 5), ("a", "l1", 1, 9), ("a", "l2", 0, 4), ("b", "l3", 0, 2)]
    batch = lambda part: pa.RecordBatch.from_pylist([
        {"target": t, "ligand": k, "active": x, "_n": 9, "r": r, "_part": 0} for t, k, x, r in part])
    got = [r for b in N._packed(["r"])([batch(rows[:3]), batch(rows[3:]), batch(rows[:1]).slice(0, 0)]) for r in b.to_pylist()]
    unpacked = [(r["target"], *(np.frombuffer(r["rows"], "<i4", r["poses"]).tolist(),),
                 np.frombuffer(r["rows"], bool, offset=4 * r["poses"]).tolist()) for r in got]
    # the active pose of l1 is dropped, its label is not
    assert unpacked == [("a", [3], [True, True]), ("b", [5], [True, False]), ("a", [4], [True, False]), ("b", [2], [True, False])]


def test_grid_needs_no_pose_numbers(spark, poses, monkeypatch):
    monkeypatch.setattr(S, "MOST_ACTIVES", -1)
    table = lambda df: sorted(S.grid_metrics(df, SCORES, GRID).collect())
    want = table(poses)
    assert table(poses.drop("pose")) == want
    monkeypatch.setattr(S, "MOST_POSES", -1)
    for a, b in zip(table(poses.drop("pose")), want, strict=True):
        for c in ("target", "gid", "auc", "auprc", "ef1", "ef5"):
            assert a[c] == (pytest.approx(b[c], abs=1e-12) if isinstance(b[c], float) else b[c]), (a, b)


@pytest.mark.parametrize("held", [1, 6, 40])
def test_keys_of_many_ligands_are_counted_range_by_range(spark, poses, held, monkeypatch):
    """Ligands beyond what a task holds, and fractions that end among equal keys."""
    monkeypatch.setattr(S, "MOST_ACTIVES", -1)
    table = lambda: sorted(S.grid_metrics(poses, SCORES, GRID).collect())
    want = table()
    for name, value in (("KEYS_HELD", held), ("KEY_CELLS", 5), ("POSES_AT_ONCE", 9), ("POSES_PER_PIECE", 4), ("SPOOLED_BYTES", 50)):
        monkeypatch.setattr(N, name, value)
    for a, b in zip(table(), want, strict=True):
        for c in ("target", "gid", "auc", "auprc", "ef1", "ef5"):
            assert a[c] == (pytest.approx(b[c], abs=1e-12) if isinstance(b[c], float) else b[c]), (a, b)


def packed_batches(ligands):
    """Ranks of a target, as they reach the task that evaluates them."""
    import pyarrow as pa
    rng = np.random.default_rng(5)
    for a in range(0, ligands, 2000):
        held = rng.integers(1, 5 * ligands, (2, 10_000)).astype("<i4")
        starts, own = np.arange(10_000) % 5 == 0, np.repeat(np.arange(2000) % 20 == 0, 5)
        yield pa.RecordBatch.from_pydict({
            "target": ["t"], "_n": [5 * ligands], "_part": pa.array([a // 2000], pa.int32()), "number": pa.array([0], pa.int32()),
            "poses": pa.array([10_000], pa.int32()), "rows": [held.tobytes() + starts.tobytes() + own.tobytes()], "sigmas": [[2, 4]]})


def test_memory_of_a_task_does_not_follow_the_poses(monkeypatch):
    import tracemalloc
    monkeypatch.setattr(N, "KEYS_HELD", 20_000)
    monkeypatch.setattr(N, "POSES_AT_ONCE", 20_000)
    monkeypatch.setattr(N, "SPOOLED_BYTES", 100_000)
    points = [(0, 2, (0.5, 0.5)), (1, 4, (0.3, 0.7))]
    peaks = []
    for ligands in (20_000, 160_000):
        tracemalloc.start()
        found = list(N._listed(points, 2, (0.01, 0.05))(packed_batches(ligands)))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert [b.num_rows for b in found] == [2]
    assert peaks[1] < 1.5 * peaks[0]


def test_ranks_are_packed_in_small_rows(spark):
    """A batch has thousands of rows, so each is small."""
    import pyarrow as pa
    batch = pa.RecordBatch.from_pylist([{"target": "t", "ligand": f"l{k:05d}", "active": k % 2, "_n": 3000, "r": k + 1, "_part": 0} for k in range(3000)])
    rows = [r for b in N._packed(["r"])([batch]) for r in b.to_pylist()]
    assert max(len(r["rows"]) for r in rows) <= 6 * 256 and [r["number"] for r in rows] == list(range(len(rows)))
    assert np.concatenate([np.frombuffer(r["rows"], "<i4", r["poses"]) for r in rows]).tolist() == list(range(1, 3001))
