import random
import zlib
from collections import defaultdict

import pytest

from screenmeld.llm import shards as S
from screenmeld.llm.queries import QUERIES


def parts_needed(sizes, capacity):
    if max(sizes) > capacity:
        return float("inf")
    parts, room = 0, 0
    for x in sizes:
        if x > room:
            parts, room = parts + 1, capacity
        room -= x
    return parts


def smallest(sizes, shards):
    low, high = 1, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if parts_needed(sizes, middle) <= shards else (middle + 1, high)
    return low


class Table:
    """Running sums that answer like the table in Spark, and count what is read."""

    def __init__(self, sizes):
        self.sums, total = [], 0
        for x in sizes:
            total += x
            self.sums.append(total)


def refine(marks, table, stretches, bins):
    rows = []
    for a, b in stretches:
        width = max(1, -(-(b - a) // bins))
        inside = defaultdict(list)
        for x in table.sums:
            if a < x < b:
                inside[(x - a) // width].append(x)
        rows += [{"a": min(v), "b": max(v), "n": len(v)} for v in inside.values()]
        assert len(inside) <= bins + 1
    return rows


@pytest.mark.parametrize("seed", range(60))
def test_capacity_is_the_smallest(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 5, 17, 40, rng.randint(1, 3000)]) for _ in range(rng.randint(1, 400))]
    shards, bins = rng.choice([1, 2, 3, 7, 40]), rng.choice([2, 5, 64])
    table, marks = Table(sizes), S.Marks(sum(sizes))

    class Frame:  # stands in for the table of running sums
        def filter(self, _): return self
        def groupBy(self, _): return self
        def agg(self, *_): return self
        def collect(self): return refine(marks, table, self.stretches, bins)

    frame = Frame()
    while stretches := marks.open_stretches(shards):
        frame.stretches = stretches
        marks.refine(frame, stretches, bins)
    capacity = marks.smallest(shards, False)
    assert capacity == smallest(sizes, shards) == marks.smallest(shards, True)
    cuts = marks.cuts(capacity, shards, False)
    assert cuts[-1] == sum(sizes) and set(cuts) <= set(table.sums)
    assert max(b - a for a, b in zip([0, *cuts], cuts)) == capacity


def check(docs, rows, shards, least=None):
    """Whole rows, whole groups, gapless slots, and the smallest capacity of the rest."""
    assert sorted((str(d.doc_id), len((d.text or "").encode()) + 16, zlib.crc32((d.text or "").encode())) for d in docs) == sorted(
        (str(r.doc_id), r["size"], r.text_crc32) for r in rows)
    slots, sizes, homes, groups = defaultdict(list), defaultdict(int), defaultdict(set), defaultdict(int)
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
        homes[r["size"], r.text_crc32].add(r.shard)
        groups[r["size"], r.text_crc32] += r["size"]
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in homes.values())
    return sizes, groups


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    rows, docs = QUERIES["op12_minimax_shards"](spark, sf_dir).collect(), spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    sizes, groups = check(docs, rows, 40)
    total, largest = sum(sizes.values()), max(groups.values())
    assert max(sizes.values()) <= max(total / 40 + largest, largest)
    again = {tuple(r) for r in QUERIES["op12_minimax_shards"](spark, sf_dir).collect()}
    assert again == {tuple(r) for r in rows}


@pytest.mark.parametrize("marks", [16, 4096])
def test_stretches_of_the_hash_order(spark, make, marks):
    rng = random.Random(9)
    docs = make([(k, "x" * rng.randint(0, 900) + str(k // 3)) for k in range(500)])
    rows = S.shard(docs, 11, marks).collect()
    sizes, _ = check(docs.collect(), rows, 11)
    order = docs.selectExpr("octet_length(text) + 16 AS size", "xxhash64(text) AS h1", "xxhash64('text', text) AS h2").groupBy(
        "h1", "h2").sum("size").orderBy("h1", "h2").collect()
    assert max(sizes.values()) == smallest([r[2] for r in order], 11)


def test_a_third_of_all_bytes_in_one_group(make):
    docs = make([(k, "the same text again") for k in range(400)] + [(1000 + k, f"own text of document {k} " * 2) for k in range(300)])
    rows = S.shard(docs, 8).collect()
    sizes, groups = check(docs.collect(), rows, 8)
    largest = max(groups.values())
    rest = sorted(sizes.values())[:-1]
    assert sorted(sizes.values())[-1] == largest and len(rest) == 7  # alone, and no shard is empty
    assert max(rest) - min(rest) < 0.1 * max(rest)


def test_odd_rows(odd, empty, make):
    check(odd.collect(), S.shard(odd, 4).collect(), 4)
    assert S.shard(empty).count() == 0
    one = S.shard(make([(1, "only")]), 3).collect()
    assert [(r.shard, r.slot) for r in one] == [(0, 0)] or len(one) == 1 and one[0].slot == 0
    check(odd.collect(), S.shard(odd, 1).collect(), 1)
