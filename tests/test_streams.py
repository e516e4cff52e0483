"""Streams: restarts, replays, broken-off batches and what a batch reads and rewrites."""

import os
import random
import time

import pytest
from pyspark.sql import types as T

from screenmeld.session import delete
from screenmeld.streaming import ingest as I
from screenmeld.streaming import versions as V


def df(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


BODY = "MODEL 1\nREMARK VINA RESULT:  {}  0  0\nENDMDL\n"


def test_pose_files_resume_late_and_again(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")

    def arrive(name, *energies, at):
        file = root / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("".join(BODY.format(e).replace("MODEL 1", f"MODEL {k}") for k, e in enumerate(energies, 1)))
        os.utime(file, (at, at))

    def run():
        I.ingest_poses(I.pose_file_stream(spark, str(root)), out, str(tmp_path / "cp")).awaitTermination()
        return sorted((r.ligand, r.pose, r.score_vina) for r in I.ingested_poses(spark, out).collect())

    now = time.time()
    arrive("run1/t1/a_docked.pdbqt", -7.0, at=now - 50)
    assert run() == [("a", 1, -7.0)]
    arrive("run1/t1/b_docked.pdbqt", -7.5, -6.0, at=now - 40)
    arrive("run1/t1/none_docked.txt", -1.0, at=now)
    assert run() == [("a", 1, -7.0), ("b", 1, -7.5), ("b", 2, -6.0)]
    arrive("run2/t1/b_docked.pdbqt", -9.0, at=now - 30)  # docked again: the newer file counts, with one pose only
    arrive("run0/t1/a_docked.pdbqt", -1.0, at=now - 90)  # arrives late and is older
    assert run() == [("a", 1, -7.0), ("b", 1, -9.0)]
    assert run() == [("a", 1, -7.0), ("b", 1, -9.0)]  # nothing new


def test_upsert_keeps_the_last_version(spark, tmp_path):
    schema = "target string, ligand string, generation int, v int"
    src, out = str(tmp_path / "src"), str(tmp_path / "out")

    def arrive(*rows):
        df(spark, schema, *rows).coalesce(1).write.mode("append").parquet(src)
        I.upsert_stream(I.table_stream(spark, src, schema), out, str(tmp_path / "cp")).awaitTermination()
        return {r["ligand"]: r["v"] for r in I.upserted(spark, out, schema).collect()}

    assert arrive(("t", "a", 5, 1), ("t", "b", 1, 1), ("t", "b", 2, 3)) == {"a": 1, "b": 3}
    assert arrive(("t", "a", 1, 2), ("t", None, 1, 2)) == {"a": 2, "b": 3, None: 2}  # the later batch wins
    assert arrive(("t", "b", 0, 9)) == {"a": 2, "b": 9, None: 2}


@pytest.fixture
def short(monkeypatch):
    monkeypatch.setattr(V, "SNAPSHOT", 4)


def _rows(spark, rng, n, number):
    return [("hot" if rng.random() < 0.8 else f"t{rng.randint(0, 3)}", f"l{rng.randint(0, 60)}", number, rng.random()) for _ in range(n)]


def test_runs_are_merged_by_prefix_and_stay_bounded(spark, tmp_path, short):
    """A hot target, more batches than a level holds, replays and a batch that broke off."""
    rng, out, schema = random.Random(1), str(tmp_path / "t"), "target string, ligand string, generation int, v double"
    keys, order, want, levels = ("target", "ligand"), (V.BATCH, "generation", "v"), {}, set()
    for number in range(11):
        batch = _rows(spark, rng, 30, number)
        for r in sorted(batch):
            if want.get(r[:2], (-1, -1))[:2] <= (number, r[2]):
                old = want.get(r[:2])
                want[r[:2]] = max(old, (number, *r[2:])) if old and old[0] == number else (number, *r[2:])
        frame = df(spark, schema, *batch)
        if number == 5:  # rows are written, the commit isn't: readers see the batches before only
            seen = {(r.target, r.ligand): r.v for r in V.read(spark, out, schema, keys, order).collect()}
            V.add(frame, number, out, keys, order, fanout=2)
            os.remove(f"{out}/commits/batch=5/_SUCCESS")
            assert {(r.target, r.ligand): r.v for r in V.read(spark, out, schema, keys, order).collect()} == seen
        V.add(frame, number, out, keys, order, fanout=2)
        if number % 3 == 0:
            V.add(frame, number, out, keys, order, fanout=2)  # replayed
        live = V.live_runs(V.commits(spark, out)).collect()
        levels |= {r.run_level for r in live}
        entries = V.commits(spark, out).filter(f"batch = {number}").collect()
        rewritten = sum(r.rows for r in entries if r.added and r.run_batch == number and r.run_level > 0)
        assert rewritten <= 2 * 30 * max(levels | {1})  # fanout batches per level
        got = {(r.target, r.ligand): r.v for r in V.read(spark, out, schema, keys, order).collect()}
        assert got == {k: v[-1] for k, v in want.items()}
    assert {0, 1, 2} <= levels
    kept = [d for d in os.listdir(f"{out}/commits")]
    assert len(kept) <= 8


def test_empty_and_absent_tables(spark, tmp_path):
    schema, keys = "target string, ligand string, v int", ("target", "ligand")
    out = str(tmp_path / "none")
    assert V.read(spark, out, schema, keys).count() == 0
    V.add(df(spark, schema), 0, out, keys)
    assert V.read(spark, out, schema, keys).count() == 0
    V.add(df(spark, schema, ("a", "b", 1)), 1, out, keys)
    assert [tuple(r) for r in V.read(spark, out, schema, keys).collect()] == [("a", "b", 1)]


GATE = "target string, ligand string, pose int, score_cnnaffinity double, block int"


@pytest.fixture
def gate(spark, tmp_path):
    src, checkpoint, out = str(tmp_path / "in"), str(tmp_path / "cp"), str(tmp_path / "gate")

    def arrive(*rows):
        df(spark, GATE, *rows).coalesce(1).write.mode("append").parquet(src)
        I.gate_blocks(I.table_stream(spark, src, GATE), ["cnnaffinity"], out, checkpoint, 0.6).awaitTermination()
        return read()

    def read():
        rows = I.gated(spark, out, GATE).select("accepted", "block", "ligand", "score_cnnaffinity").collect()
        return [sorted((r[1], r[2], r[3]) for r in rows if r[0] is side) for side in (True, False)]

    arrive.read, arrive.out = read, out
    return arrive


def test_gate_joins_the_parts_of_a_block(gate):
    assert gate(("t x", "a", 1, -1.0, 0), ("t x", "b", 1, None, 1)) == [[(0, "a", -1.0)], [(1, "b", None)]]
    assert gate(("t x", "c", 1, None, 0), ("t x", "d", 1, -2.0, 1)) == [
        [], [(0, "a", -1.0), (0, "c", None), (1, "b", None), (1, "d", -2.0)]]
    # block 1 turns good by a row that is sent again; block 2 is new, block 0 isn't touched
    assert gate(("t x", "b", 1, -3.0, 1), ("t x", "e", 1, -4.0, 2)) == [
        [(1, "b", -3.0), (1, "d", -2.0), (2, "e", -4.0)], [(0, "a", -1.0), (0, "c", None)]]


def test_a_batch_writes_only_its_blocks(spark, gate):
    gate(*[("t", f"l{k}", 1, -1.0, k // 5) for k in range(50)])
    gate(("t", "new", 1, None, 3))
    entries = V.commits(spark, gate.out).filter("batch = 1").collect()
    assert sum(r.rows for r in entries if r.added) == 6  # block 3 alone: five rows and the new one


def test_a_broken_off_gate_leaves_each_block_on_one_side(spark, gate):
    before = gate(("t", "a", 1, -1.0, 0), ("t", "b", 1, -1.0, 1))
    after = gate(("t", "c", 1, None, 0), ("t", "d", 1, None, 0))
    assert before[0] == [(0, "a", -1.0), (1, "b", -1.0)] and after[0] == [(1, "b", -1.0)] and len(after[1]) == 3
    # as if the second batch had ended between writing rows and committing them
    os.remove(f"{gate.out}/commits/batch=1/_SUCCESS")
    assert gate.read() == before
    # and as if it had ended before it wrote all its rows
    delete(spark, [f"{gate.out}/runs/run_batch=1/_SUCCESS"])
    assert gate.read() == before


def test_gate_query_reads_several_batches(spark, monkeypatch):
    from screenmeld.plans import QUERIES
    numbers, add = [], V.add
    monkeypatch.setattr(V, "add", lambda rows, n, *rest: (numbers.append(n), add(rows, n, *rest)))
    rows = QUERIES["stream_gated_blocks"](spark, "/root/testdata/sf0.001").collect()
    assert len(numbers) >= 3 and sum(r.poses for r in rows) == 6000 and len({(r.target, r.block) for r in rows}) == len(rows)


def test_block_sink_replaces_only_its_blocks(spark, tmp_path):
    from screenmeld.sinks import write_blocks
    out = str(tmp_path / "blocks")
    write_blocks(df(spark, GATE, ("t", "a", 1, -1.0, 0), ("t", "b", 1, -1.0, 1)), out)
    write_blocks(df(spark, GATE, ("t", "c", 1, -2.0, 1)), out)
    assert sorted((r.block, r.ligand) for r in spark.read.parquet(out).collect()) == [(0, "a"), (1, "c")]


def test_a_block_is_one_value_of_the_state(spark):
    """A batch reads and writes a block at once; its rows are not entries of a list in the state."""
    class Value:
        held, writes = None, 0
        exists = lambda self: self.held is not None
        get = lambda self: self.held

        def update(self, new):
            self.held, self.writes = new, self.writes + 1

    class Handle:
        value = Value()
        getValueState = lambda self, name, schema: self.value

    schema = T.StructType.fromDDL("target string, block int, ligand string, pose int, score_x double")
    state, handle = I.BlockState(schema, ["score_x"], 0.5, ["target", "block", "ligand", "pose"]), Handle()
    state.init(handle)
    run = lambda *rows: sorted(map(tuple, state.handleInputRows(("t", 0), iter(rows), None)))
    assert run(("t", 0, "a", 1, -1.0), ("t", 0, "b", 1, -2.0)) == [("t", 0, "a", 1, -1.0, True), ("t", 0, "b", 1, -2.0, True)]
    assert run(("t", 0, "a", 1, -3.0)) == [("t", 0, "a", 1, -3.0, True), ("t", 0, "b", 1, -2.0, True)]
    assert handle.value.writes == 2 and isinstance(handle.value.held[0], bytes)
