"""Metrics of a parameter grid by counting decoys between actives.

All metrics follow from where the decoys lie between the actives of a target, so neither values nor ranks of ligands
leave a task. The poses of a target are dealt in slices of whole ligands; the actives, which are few, go with every
slice. A task computes the consensus value of its ligands for one grid point after the other and counts its decoys
per interval between actives. Counts of a slice are as long as the list of actives, they are added up
per target and grid point, and metrics come from the sums.

A slice holds at least four poses of decoys for each of actives, so actives are copied at most a quarter as often as
there are poses. Poses that can't be the best of their ligand under any weights and sigma (another one has no worse rank
in all functions) are dropped before the shuffle where a ligand has many.

Lists of many actives make the counts long. Targets of up to ``MOST_POSES`` poses are then evaluated some sigmas per task
(:func:`listed_metrics`): the ranks of a target, four bytes each in order of ligands and without poses that can't be the best of
their ligand, go to a few tasks that share its sigmas. A task writes them to a file of its own and reads that once for as many grid points
as ``KEYS_HELD`` allows, orders the decoys' values of each and looks the actives up in them; the values of more ligands than that are taken
range by range. So its memory doesn't follow the target, and nothing is shuffled per grid point.
"""

from __future__ import annotations

import os
import tempfile
import zlib
from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenmeld.functions.grids import GridPoint
from screenmeld.operators.evaluate import ef_name
from screenmeld.session import stage

#: Most actives of a target for which this way is taken; their lists are held and sent once per grid point.
MOST_ACTIVES = 10_000
POSES_PER_SLICE = 50_000
#: Poses of a ligand in one batch up to which all are kept.
FEW_POSES = 16
#: Most poses of a target whose ranks are listed, as these take four bytes each.
MOST_POSES = 2_000_000_000
#: Poses packed in a row, so that an Arrow batch of 10,000 rows stays below 40 MB.
POSES_PER_PIECE = 256
#: Keys of ligands held and sorted by a task, in eight bytes each, and cells by which the keys of more are cut in ranges.
KEYS_HELD = 32_000_000
KEY_CELLS = 1 << 16
#: Packed poses of a target that a task holds in memory; more go to a file.
SPOOLED_BYTES = 64 << 20
POSES_PER_RANGE = 1_000_000
MOST_TASKS = 2000
TASKS_PER_CORE = 3
#: Poses, of whole ligands, that are evaluated together.
POSES_AT_ONCE = 1 << 18
#: Poses of a ligand on either side of a pose that it is compared with.
NEIGHBOURS = 32
#: Poses of a ligand that lie in layers.
MOST_LAYERS = 32
#: Ligands evaluated together, so that their terms stay in the processor's cache.
LIGANDS_AT_ONCE = 8192
DIGITS = 12  # consensus sums that are equal on paper must tie


def _ranks(batch: pa.RecordBatch | pa.Table, names: Sequence[str]) -> np.ndarray:
    return np.stack([batch.column(c).cast(pa.float64()).fill_null(np.inf).to_numpy() for c in names], axis=1)


def _undominated(ranks: np.ndarray) -> np.ndarray:
    """Rows that no other row equals or beats in all columns; of equal rows the first."""
    order, kept = np.argsort(ranks.sum(axis=1), kind="stable"), []
    for i in order:
        if not kept or not (ranks[kept] <= ranks[i]).all(axis=1).any():
            kept.append(i)
    return np.array(kept)


def _thinned(names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = pc.binary_join_element_wise(*(batch.column(c).fill_null("") for c in ("target", "ligand")), "\0")
            of = of.dictionary_encode().indices.to_numpy()
            count = np.bincount(of)
            if not len(of) or count.max() <= FEW_POSES:
                yield batch
                continue
            keep = np.flatnonzero(count[of] <= FEW_POSES)
            ranks, many = _ranks(batch, names), [keep]
            for k in np.flatnonzero(count > FEW_POSES):
                rows = np.flatnonzero(of == k)
                many.append(rows[_undominated(ranks[rows])])
            yield batch.take(pa.array(np.sort(np.concatenate(many))))
    return run


def _values(points: Sequence[tuple], ranks: np.ndarray, n: float, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each grid point's best value per ligand, as whole numbers of the last digit that counts."""
    sigma, terms = None, []
    for gid, fraction, weights in points:
        if fraction != sigma:
            sigma = fraction
            terms = [np.exp(-ranks[:, k] / max(n / float(fraction), 1.0)) for k in range(ranks.shape[1])]
        total = np.zeros(len(ranks))
        for w, term in zip(weights, terms):
            total = total + w * term
        yield gid, np.floor(np.maximum.reduceat(total, starts) * 10.0 ** DIGITS + 0.5).astype(np.int64)


def _pack(*arrays: np.ndarray) -> bytes:
    return zlib.compress(b"".join(x.astype("<i4").tobytes() for x in arrays), 1)


def _counted(points: Sequence[tuple], names: Sequence[str]):
    """Function from the poses of one slice to a row per grid point: counts of decoys between actives."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("ligand")
        ligand = table.column("ligand")
        texts = np.array(ligand.to_pylist(), object)
        starts = np.append(0, np.flatnonzero(texts[1:] != texts[:-1]) + 1)
        # as Arrow sorts texts by bytes, a ligand's place here is its order by name
        active = np.maximum.reduceat(table.column("active").to_numpy() == 1, starts)
        own, others = np.flatnonzero(active), np.flatnonzero(~active)
        target, n = table.column("target")[0].as_py(), table.column("_n")[0].as_py()
        gids, packed = [], []
        for gid, value in _values(points, _ranks(table, names), float(n), starts):
            key = -value
            mine = own[np.lexsort((own, key[own]))]  # actives by key and name
            levels, level = np.unique(key[mine], return_inverse=True)
            code = 2 * (level * len(active) + mine) + 1
            at = np.searchsorted(levels, key[others])
            tied = at < len(levels)
            tied[tied] = levels[at[tied]] == key[others][tied]
            place = np.searchsorted(code, 2 * (at * len(active) + np.where(tied, others, 0)))
            gids.append(gid)
            packed.append(_pack(level, np.bincount(place, minlength=len(own) + 1),
                                np.bincount(at[~tied], minlength=len(levels) + 1), np.bincount(at[tied], minlength=len(levels))))
        rows = len(gids)
        return pa.table({"target": pa.array([target] * rows, pa.string()), "gid": pa.array(gids, pa.int32()),
                         "actives": pa.array([len(own)] * rows, pa.int32()), "counts": pa.array(packed, pa.binary())})
    return run


def _metrics(fractions: Sequence[float]):
    """Function from the counts of all slices to the metrics of one target and grid point."""
    def run(table: pa.Table) -> pa.Table:
        p = table.column("actives")[0].as_py()
        total = None
        for packed in table.column("counts"):
            numbers = np.frombuffer(zlib.decompress(packed.as_py()), "<i4").astype(np.int64)
            level, counts = numbers[:p], numbers[p:]
            total = counts if total is None else total + counts
        levels = level[-1] + 1 if p else 0
        place, below, equal = total[:p + 1], total[p + 1:p + levels + 2], total[p + levels + 2:]
        decoys = int(place.sum())
        out = {"auc": None, "auprc": None} | {ef_name(f): None for f in fractions}
        if p:
            better = np.cumsum(below[:levels]) + np.cumsum(equal) - equal  # decoys with a smaller key, per level
            number = np.cumsum(np.bincount(level, minlength=levels))[level]
            if decoys:
                worse = decoys - better - equal
                out["auc"] = float((2.0 * worse + equal)[level].sum() / (2.0 * p * decoys))
                out["auprc"] = float((number / (number + (better + equal)[level])).sum() / p)
            rank = np.arange(1, p + 1) + np.cumsum(place[:p])
            for f in fractions:
                hits = int((rank <= max(1, np.ceil((p + decoys) * f))).sum())
                out[ef_name(f)] = float(hits) / (p * f)
        row = {"target": pa.array([table.column("target")[0].as_py()], pa.string()),
               "gid": pa.array([table.column("gid")[0].as_py()], pa.int32())}
        return pa.table(row | {c: pa.array([x], pa.float64()) for c, x in out.items()})
    return run


def most_actives(poses: DataFrame) -> int:
    """The most rows of actives that a target has."""
    return poses.filter("active = 1").groupBy("target").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]


def _thin(ranked: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns that count, without poses that can't be the best of their ligand where it has many."""
    thin = ranked.select("target", "ligand", F.col("active").cast("int").alias("active"), F.col("_n").cast("long"),
                         *[F.col(c).cast("long") for c in names])
    kinds = "target string, ligand string, active int, _n long, " + ", ".join(f"{c} long" for c in names)
    # one label per ligand, as its poses are ranked together
    return thin.mapInArrow(_thinned(names), kinds)


def counted_metrics(ranked: DataFrame, names: Sequence[str], grid: Sequence[GridPoint],
                    fractions: Sequence[float] = (0.01, 0.05)) -> DataFrame:
    """AUC, AUPRC and enrichment per (target, gid).

    ``ranked`` has the poses with the rank columns ``names`` and ``_n``, the number of poses of the target.
    """
    points = [(p.gid, p.sigma, p.weights) for p in sorted(grid, key=lambda p: (p.sigma, p.gid))]
    labelled = _thin(ranked, names)
    sizes = ranked.groupBy("target").agg(
        F.count("*").alias("_all"), F.count(F.when(F.col("active") == 1, 1)).alias("_own"))
    slices = F.greatest(F.lit(1), F.least(F.ceil(F.col("_all") / POSES_PER_SLICE), F.floor(
        F.col("_all") / F.greatest(4 * F.col("_own"), F.lit(1))))).cast("int")
    dealt = labelled.join(sizes.select("target", slices.alias("_slices")), "target")
    everywhere = F.sequence(F.lit(0), F.col("_slices") - 1)
    one = F.array(F.pmod(F.xxhash64("ligand"), F.col("_slices")).cast("int"))
    placed = dealt.withColumn("_slice", F.explode(F.when(F.col("active") == 1, everywhere).otherwise(one))).drop("_slices")
    counts = placed.groupBy("target", "_slice").applyInArrow(
        _counted(points, names), "target string, gid int, actives int, counts binary")
    return counts.groupBy("target", "gid").applyInArrow(
        _metrics(fractions), "target string, gid int, auc double, auprc double, "
        + ", ".join(f"{ef_name(f)} double" for f in fractions))


def _may_be_best(ranks: np.ndarray, ligand: np.ndarray) -> np.ndarray:
    """Whether a pose may be the best of its ligand: none of its neighbours there has no worse rank in all functions.

    The poses of a ligand lie together. Each is compared with the ``NEIGHBOURS`` next to it on both sides; of equal ones the first stays.
    """
    kept = np.ones(len(ligand), bool)
    for step in range(1, min(NEIGHBOURS, len(ligand) - 1) + 1):
        one = np.flatnonzero(ligand[step:] == ligand[:-step])
        if not len(one):
            break
        a, b = ranks[:, one], ranks[:, one + step]
        first = (a <= b).all(axis=0)
        kept[(one + step)[first]] = False
        kept[one[~first & (b <= a).all(axis=0)]] = False
    return kept


def _packed(names: Sequence[str]):
    """Function from poses in order of ligands to rows of up to ``POSES_PER_PIECE`` poses of a target: ranks, ligands' first poses, actives.

    Only poses that may be the best of their ligand are packed. The targets of a batch may be mixed.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, number = {}, 0
        for batch in batches:
            targets, ligands = (batch.column(c).dictionary_encode() for c in ("target", "ligand"))
            of, code = (x.indices.fill_null(-1).to_numpy() for x in (targets, ligands))
            ranks = np.ascontiguousarray(_ranks(batch, names).T)
            active = batch.column("active").to_numpy(zero_copy_only=False) == 1
            for t in np.unique(of):
                rows = np.flatnonzero(of == t)
                first = np.append(True, code[rows][1:] != code[rows][:-1])
                begins = np.ones(int(first.sum()), bool)
                target, last = batch.column("target")[rows[0]].as_py(), batch.column("ligand")[rows[-1]].as_py()
                # a ligand may go on from the batch before
                begins[0] = target not in before or before[target] != batch.column("ligand")[rows[0]].as_py()
                before[target] = last
                ligand = np.cumsum(first) - 1
                kept = np.flatnonzero(_may_be_best(ranks[:, rows], ligand))
                own = np.logical_or.reduceat(active[rows], np.flatnonzero(first))  # a ligand's, whichever pose stays
                ligand = ligand[kept]
                starts = np.append(True, ligand[1:] != ligand[:-1]) & begins[ligand]
                held = ranks[:, rows[kept]]
                held, own = np.where(np.isinf(held), 0, held).astype("<i4"), own[ligand]
                cuts = [slice(a, a + POSES_PER_PIECE) for a in range(0, len(kept), POSES_PER_PIECE)]
                pieces = len(cuts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([target] * pieces, pa.string()), pa.array([batch.column("_n")[rows[0]].as_py()] * pieces, pa.int64()),
                     pa.array([batch.column("_part")[rows[0]].as_py()] * pieces, pa.int32()),
                     pa.array(np.arange(number, number + pieces), pa.int32()), pa.array([len(starts[x]) for x in cuts], pa.int32()),
                     pa.array([held[:, x].tobytes() + starts[x].tobytes() + own[x].tobytes() for x in cuts], pa.binary())],
                    ["target", "_n", "_part", "number", "poses", "rows"])
                number += pieces
    return run


class _Layers:
    """Poses in layers: the first ones of all ligands, the second ones, and so on, ligands with most poses first.

    The best of a ligand is then an elementwise maximum of layers. What ligands have beyond ``MOST_LAYERS`` poses follows ligand by ligand.
    """

    def __init__(self, starts: np.ndarray, poses: int) -> None:
        count = np.diff(np.append(starts, poses))
        self.ligands = len(count)
        #: The ligands in the order of the layers.
        self.order = np.argsort(-count, kind="stable")
        count, starts = count[self.order], starts[self.order]
        above = lambda j: int(np.searchsorted(-count, -j))
        self.sizes = [above(j) for j in range(min(int(count[0]), MOST_LAYERS))]
        self.at = np.concatenate([[0], np.cumsum(self.sizes)])
        more = above(MOST_LAYERS)
        self.rest = np.cumsum(count[:more] - MOST_LAYERS) - (count[:more] - MOST_LAYERS)
        tail = [np.arange(s + MOST_LAYERS, s + c) for s, c in zip(starts[:more], count[:more])]
        #: The poses in layers.
        self.poses = np.concatenate([starts[:k] + j for j, k in enumerate(self.sizes)] + tail)

    def best(self, weights: Sequence[float], terms: np.ndarray) -> np.ndarray:
        """Largest weighted sum of ``terms``, whose columns are in layers, per ligand in their order."""
        def total(a: int, b: int | None) -> np.ndarray:
            found = np.zeros(terms[0, a:b].shape)
            for w, term in zip(weights, terms):
                if w:
                    found += w * term[a:b]
            return found

        out = np.empty(self.ligands)
        for a in range(0, len(out), LIGANDS_AT_ONCE):
            out[a:a + LIGANDS_AT_ONCE] = total(a, min(a + LIGANDS_AT_ONCE, len(out)))
            for at, size in zip(self.at[1:], self.sizes[1:]):
                if size <= a:
                    break
                here = out[a:min(a + LIGANDS_AT_ONCE, size)]
                np.maximum(here, total(at + a, at + a + len(here)), out=here)
        if len(self.rest):
            more = out[:len(self.rest)]
            np.maximum(more, np.maximum.reduceat(total(self.at[-1], None), self.rest), out=more)
        return out


class _Poses:
    """The poses of a target, in a file where they are many: whole ligands of about ``POSES_AT_ONCE`` poses at a time, in layers.

    Ligands come in order of their names. What is held doesn't depend on how many poses there are.
    """

    def __init__(self, k: int, n: float) -> None:
        self.k, self.n = k, n
        self.actives = self.decoys = 0
        where = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        self.file = tempfile.SpooledTemporaryFile(SPOOLED_BYTES, dir=where or None)
        self.pieces: list[tuple[_Layers, int, int]] = []
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.poses, self.due = 0, POSES_AT_ONCE

    def add(self, rows: bytes, m: int) -> None:
        self.waiting.append((np.frombuffer(rows, "<i4", self.k * m).reshape(self.k, m),
                             *np.frombuffer(rows, bool, 2 * m, 4 * self.k * m).reshape(2, m)))
        self.poses += m
        if self.poses >= self.due:
            self.flush(False)

    def flush(self, ended: bool) -> None:
        """Write what waits, without the last ligand where it may go on."""
        if not self.waiting:
            return
        ranks, starts, active = (np.concatenate(x, axis=-1) for x in zip(*self.waiting))
        self.waiting, first = [], np.flatnonzero(starts)
        stop = len(starts) if ended else int(first[-1])
        if stop < len(starts):
            self.waiting = [(ranks[:, stop:], starts[stop:], active[stop:])]
        self.poses = len(starts) - stop
        self.due = self.poses + POSES_AT_ONCE
        first = first[first < stop]
        if not len(first):
            return
        layers = _Layers(first, stop)
        own = np.logical_or.reduceat(active[:stop], first)[layers.order]
        self.file.seek(0, os.SEEK_END)
        at = self.file.tell()
        for x in (np.ascontiguousarray(ranks[:, layers.poses]), own, layers.order.astype("<i4")):
            self.file.write(x.tobytes())
        layers.poses = layers.order = None
        self.pieces.append((layers, at, stop))
        self.actives += int(own.sum())
        self.decoys += int((~own).sum())

    def keys(self, points: Sequence[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray, Iterator[np.ndarray]]]:
        """Per piece: which ligands are active, their places by name and their keys at each of ``points``, all of one sigma."""
        scale = max(self.n / float(points[0][1]), 1.0)
        for layers, at, poses in self.pieces:
            self.file.seek(at)
            ranks = np.frombuffer(self.file.read(4 * self.k * poses), "<i4").reshape(self.k, poses)
            own = np.frombuffer(self.file.read(layers.ligands), bool)
            order = np.frombuffer(self.file.read(4 * layers.ligands), "<i4")
            terms = np.empty((self.k, poses))
            for term, rank in zip(terms, ranks):
                np.divide(rank, -scale, out=term)
                np.exp(term, out=term)
                term *= rank > 0
            yield own, order, (-np.floor(layers.best(weights, terms) * 10.0 ** DIGITS + 0.5).astype(np.int64) for _, _, weights in points)


def _ranges(poses: _Poses, point: tuple) -> list[tuple[int, int]]:
    """Ranges of keys, first and last, that hold at most ``KEYS_HELD`` ligands each or a single key."""
    def cut(low: int, high: int) -> list[tuple[int, int]]:
        width = (high - low) // KEY_CELLS + 1
        counts = np.zeros((high - low) // width + 1, np.int64)
        for _, _, (key,) in poses.keys([point]):
            counts += np.bincount((key[(key >= low) & (key <= high)] - low) // width, minlength=len(counts))
        out, first, held = [], 0, 0
        for i, n in enumerate(counts.tolist()):
            if held and held + n > KEYS_HELD:
                out.append((low + first * width, low + i * width - 1))
                first, held = i, 0
            held += n
            if n > KEYS_HELD and width > 1:
                out += cut(low + i * width, min(high, low + (i + 1) * width - 1))
                first, held = i + 1, 0
            elif n > KEYS_HELD:
                out.append((low + i, low + i))
                first, held = i + 1, 0
        return out + ([(low + first * width, high)] if held else [])

    ends = [(int(key.min()), int(key.max())) for _, _, (key,) in poses.keys([point])]
    return cut(min(a for a, _ in ends), max(b for _, b in ends))


class _Sums:
    """Metrics of one grid point from its keys, range by range."""

    def __init__(self, poses: _Poses, fractions: Sequence[float]) -> None:
        self.p, self.q = poses.actives, poses.decoys
        self.mine = self.others = self.area = 0
        self.precision = 0.0
        self.first = [max(1, int(np.ceil((self.p + self.q) * f))) for f in fractions]
        self.hits: list[int | None] = [None] * len(fractions)
        #: Fractions that end among equal keys of both kinds: number, key, and how many ligands of the key belong to it.
        self.tied: list[tuple[int, int, int]] = []

    def _end(self, i: int, key: int, mine: int, others: int, tied: int, tied_own: int) -> None:
        """Fraction ``i`` ends at ``key``, of which there are ``tied`` behind ``mine`` and ``others`` better ones."""
        left = self.first[i] - mine - others
        self.hits[i] = mine
        if left >= tied or tied_own == 0 or tied_own == tied:
            self.hits[i] += min(left, tied_own)
        else:
            self.tied.append((i, key, left))

    def add(self, mine: np.ndarray, others: np.ndarray) -> None:
        """The sorted keys of a range's actives and decoys."""
        before = self.mine + self.others
        for i, first in enumerate(self.first):
            if self.hits[i] is None and first <= before + len(mine) + len(others):
                k = first - before
                last = int(np.partition(np.concatenate([mine[:k], others[:k]]), k - 1)[k - 1])
                a, b = np.searchsorted(mine, [last, last + 1]), np.searchsorted(others, [last, last + 1])
                self._end(i, last, self.mine + int(a[0]), self.others + int(b[0]), int(a[1] - a[0] + b[1] - b[0]), int(a[1] - a[0]))
        for at in range(0, len(mine), POSES_AT_ONCE):
            part = mine[at:at + POSES_AT_ONCE]
            better, upto = np.searchsorted(others, part) + self.others, np.searchsorted(others, part, "right") + self.others
            number = np.searchsorted(mine, part, "right") + self.mine
            self.area += int((2 * (self.q - upto) + (upto - better)).sum())
            self.precision += float((number / (number + upto)).sum())
        self.mine += len(mine)
        self.others += len(others)

    def add_equal(self, key: int, mine: int, others: int) -> None:
        """A key that so many actives and decoys have."""
        before = self.mine + self.others
        for i, first in enumerate(self.first):
            if self.hits[i] is None and first <= before + mine + others:
                self._end(i, key, self.mine, self.others, mine + others, mine)
        self.mine, self.others = self.mine + mine, self.others + others
        self.area += mine * (2 * (self.q - self.others) + others)
        self.precision += mine * self.mine / max(1, self.mine + self.others)

    def result(self, fractions: Sequence[float]) -> list[float | None]:
        if not self.p:
            return [None] * (2 + len(fractions))
        return [self.area / (2.0 * self.p * self.q) if self.q else None, self.precision / self.p if self.q else None,
                *(float(h) / (self.p * f) for h, f in zip(self.hits, fractions))]


def _evaluated(poses: _Poses, points: Sequence[tuple], fractions: Sequence[float]) -> Iterator[tuple[int, list]]:
    """Metrics at grid points of one sigma, as many together as ``KEYS_HELD`` keys allow."""
    ligands = poses.actives + poses.decoys
    together = max(1, min(len(points), KEYS_HELD // max(1, ligands)))
    sums = [_Sums(poses, fractions) for _ in points]
    if ligands <= KEYS_HELD:
        mine, others = (np.empty((together, n), np.int64) for n in (poses.actives, poses.decoys))
        for start in range(0, len(points), together):
            group, a, b = points[start:start + together], 0, 0
            for own, _, keys in poses.keys(group):
                n = int(own.sum())
                for j, key in enumerate(keys):
                    mine[j, a:a + n], others[j, b:b + len(own) - n] = key[own], key[~own]
                a, b = a + n, b + len(own) - n
            for j in range(len(group)):
                mine[j].sort()
                others[j].sort()
                sums[start + j].add(mine[j], others[j])
    else:
        for point, total in zip(points, sums):
            for low, high in _ranges(poses, point):
                found = ([], [])
                counts = [0, 0]
                for own, _, (key,) in poses.keys([point]):
                    inside = (key >= low) & (key <= high)
                    for kind, which in enumerate((inside & own, inside & ~own)):
                        counts[kind] += int(which.sum())
                        if low < high:
                            found[kind].append(key[which])
                if low < high:
                    total.add(*(np.sort(np.concatenate(x)) for x in found))
                else:
                    total.add_equal(low, *counts)
    # equal keys count by name where a fraction ends among them
    tied = [(i, point, total) for i, (point, total) in enumerate(zip(points, sums)) if total.tied]
    if tied:
        left = [[[*t, 0] for t in total.tied] for _, _, total in tied]
        for own, order, keys in poses.keys([point for _, point, _ in tied]):
            for ends, key in zip(left, keys):
                for end in ends:
                    if end[2]:
                        equal = np.flatnonzero(key == end[1])
                        equal = equal[np.argsort(order[equal])][:end[2]]
                        end[2] -= len(equal)
                        end[3] += int(own[equal].sum())
        for (_, _, total), ends in zip(tied, left):
            for i, _, _, more in ends:
                total.hits[i] += more
    for (gid, _, _), total in zip(points, sums):
        yield gid, total.result(fractions)


def _listed(points: Sequence[tuple], k: int, fractions: Sequence[float]):
    """Function from the packed poses of targets, in order of targets, their sigmas and ligands, to metrics at the grid points of these sigmas."""
    names = ["gid", "auc", "auprc", *(ef_name(f) for f in fractions)]

    def measured(target: str, poses: _Poses, sigmas: Sequence[int]) -> pa.RecordBatch:
        poses.flush(True)
        rows = [(gid, *found) for sigma in sigmas
                for gid, found in _evaluated(poses, [p for p in points if p[1] == sigma], fractions)]
        poses.file.close()
        columns = zip(names, zip(*rows), [pa.int32(), *[pa.float64()] * (len(names) - 1)])
        return pa.RecordBatch.from_pydict({"target": pa.array([target] * len(rows), pa.string()),
                                           **{c: pa.array(x, t) for c, x, t in columns}})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, poses = None, None
        for batch in batches:
            of = zip(batch.column("target").to_pylist(), batch.column("sigmas").to_pylist())
            for i, group in enumerate(of):
                if group != now:
                    if poses:
                        yield measured(now[0], poses, now[1])
                    now, poses = group, _Poses(k, float(batch.column("_n")[i].as_py()))
                poses.add(batch.column("rows")[i].as_py(), batch.column("poses")[i].as_py())
        if poses:
            yield measured(now[0], poses, now[1])
    return run


def listed_metrics(ranked: DataFrame, names: Sequence[str], grid: Sequence[GridPoint], poses: int, targets: int,
                   fractions: Sequence[float] = (0.01, 0.05)) -> DataFrame:
    """As :func:`counted_metrics`, by lists of a target's ranks; ``poses`` and ``targets`` say how many there are."""
    points = [(p.gid, p.sigma, p.weights) for p in grid]
    sigmas = sorted({p.sigma for p in grid})
    cores = ranked.sparkSession.sparkContext.defaultParallelism
    listed = ranked.select("target", "ligand", "active", "_n", *names)
    # a ligand lies in one range, so the order of ranges and batches is that of a target's ligands; sorted by names first,
    # as rows of one target differ there
    sorted_by = (listed.repartitionByRange(max(cores, ceil(poses / POSES_PER_RANGE)), "target", "ligand")
                 .sortWithinPartitions("ligand", "target").withColumn("_part", F.spark_partition_id()))
    packed = stage(sorted_by.mapInArrow(
        _packed(names), "target string, _n long, _part int, number int, poses int, rows binary"), "packed-ranks")
    # a target's ranks go to as many tasks as keep the cores busy, not to one per sigma
    parts = min(len(sigmas), max(1, ceil(TASKS_PER_CORE * cores / max(targets, 1))))
    parts = ceil(len(sigmas) / ceil(len(sigmas) / parts))
    numbers = packed.select("target").distinct().withColumn(
        "_list", parts * (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("target")) - 1))  # one row per target
    shares = F.array(*[F.struct(F.lit(i).alias("_share"), F.array(*[F.lit(s) for s in sigmas[i::parts]]).alias("sigmas"))
                       for i in range(parts)])
    each = packed.join(F.broadcast(numbers) if targets <= MOST_TASKS else numbers, "target").select("*", F.inline(shares))
    # each list has a partition of its own; the grid, not the bytes shuffled, decides how many there are
    placed = each.repartitionById(max(1, min(targets * parts, MOST_TASKS)), F.col("_list") + F.col("_share")).drop(
        "_list", "_share").sortWithinPartitions("target", "sigmas", "_part", "number")
    return placed.mapInArrow(
        _listed(points, len(names), fractions), "target string, gid int, auc double, auprc double, "
        + ", ".join(f"{ef_name(f)} double" for f in fractions))
