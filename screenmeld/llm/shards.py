"""Sharding by a minimax contiguous partition. DataFrame operations only.

Documents of equal text form atomic groups, known by a 128-bit hash. A group's size is the sum of its documents' sizes. Groups
stand in the order of their hashes, and shards are stretches of that order: the smallest capacity that lets ``shards``
stretches hold all groups is found by binary search, each capacity is checked greedily, and the stretches are cut there.

A group larger than an even share of what is left needs a shard of its own whatever the cuts are (``oversized``, at most
one per shard), and would leave other shards empty if it set the capacity for all; such groups come first in the
order and the search runs over the rest.

The search needs running sums, which stay distributed. ``Marks`` holds a bounded table of some of them and knows
where others lie in between. A greedy check then gives bounds for each cut, and so for the capacity; the next
round reads finer marks only where a cut may still fall (at most ``MARKS`` for each cut), until every cut
is exact. Each round narrows the stretches by a factor of about ``MARKS / (2 * shards)``.

Slots number the documents of a shard by hash and doc_id over range partitions, so no task sees a whole shard or group.

Defined cases: a NULL text has no bytes and is in the group of the empty text; rows that repeat a doc_id are placed each for
itself; texts whose 128-bit hashes collide would stay together, which keeps all guarantees; with fewer groups than shards some shards are
empty; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenmeld.llm.text import numbered
from screenmeld.session import stage

SHARDS = 40
#: Bytes a document takes beside its text.
OVERHEAD = 16
#: Running sums that one round reads for each cut, at most.
MARKS = 4096


def running_sums(groups: DataFrame) -> DataFrame:
    """``h1, h2, upto``: the sum of sizes up to and with each group, in the order of hashes."""
    key = ["h1", "h2"]
    placed = stage(groups.repartitionByRange(*key).sortWithinPartitions(*key)
                   .withColumn("part", F.spark_partition_id()), "groups")
    before = (placed.groupBy("part").agg(F.sum("bytes").alias("bytes"))
              .select("part", (F.sum("bytes").over(Window.orderBy("part")) - F.col("bytes")).alias("before")))
    inside = F.sum("bytes").over(Window.partitionBy("part").orderBy(*key).rowsBetween(Window.unboundedPreceding, 0))
    return stage(placed.join(F.broadcast(before), "part")  # a row per partition
                 .select(*key, (F.col("before") + inside).alias("upto")), "running")


class Marks:
    """Some running sums in order; ``after[i]`` tells whether others may lie between marks i and i + 1."""

    def __init__(self, total: int) -> None:
        self.at, self.after = [0, total], [total > 0, False]

    def reach(self, start: int, capacity: int) -> tuple[int, int]:
        """Bounds of the largest running sum that is at most ``start + capacity``."""
        i = bisect_right(self.at, start + capacity) - 1
        return self.at[i], start + capacity if self.after[i] else self.at[i]

    def cuts(self, capacity: int, shards: int, upper: bool) -> list[int]:
        """Greedy cuts, each as far as it may lie (``upper``) or surely lies."""
        found, at = [], 0
        for _ in range(shards):
            at = self.reach(at, capacity)[upper]
            found.append(min(at, self.at[-1]))
        return found

    def smallest(self, shards: int, upper: bool) -> int:
        """The smallest capacity whose greedy check ends with everything placed, by binary search."""
        low, high = 0, self.at[-1]
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, upper)[-1] >= self.at[-1]:
                high = middle
            else:
                low = middle + 1
        return low

    def open_stretches(self, shards: int) -> list[tuple[int, int]]:
        """Where unread running sums may still decide a cut; disjoint and in order."""
        low, high = self.smallest(shards, True), self.smallest(shards, False)
        found: list[tuple[int, int]] = []
        for a, b in zip(self.cuts(low, shards, False), self.cuts(high, shards, True)):
            first, last = bisect_right(self.at, a) - 1, bisect_right(self.at, b) - 1
            unread = [i for i in range(first, last + 1) if self.after[i]]
            if unread:
                found.append((self.at[unread[0]], self.at[unread[-1] + 1]))
        merged: list[tuple[int, int]] = []
        for a, b in sorted(found):
            if merged and a < merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return merged

    def refine(self, sums: DataFrame, stretches: list[tuple[int, int]], marks: int) -> None:
        """Read the first and last running sum of every bin of the stretches."""
        upto, bins, offset = F.col("upto"), F.lit(None), 0
        for a, b in reversed(stretches):
            width = max(1, -(-(b - a) // marks))
            # the upper end of a stretch is a mark already
            bins = F.when((upto > a) & (upto < b), F.lit(offset) + F.floor((upto - a) / F.lit(width))).otherwise(bins)
            offset += marks + 1
        inside = reduce(Column.__or__, [(upto > a) & (upto < b) for a, b in stretches])
        read = (sums.filter(inside).groupBy(bins.alias("bin"))
                .agg(F.min("upto").alias("a"), F.max("upto").alias("b"), F.count("*").alias("n")).collect())
        known = dict(zip(self.at, self.after))
        for a, b in stretches:
            known |= {at: False for at in self.at[bisect_right(self.at, a) - 1:bisect_right(self.at, b) - 1]}
        for r in read:
            known |= {r["b"]: False, r["a"]: r["n"] > 2}
            if r["n"] > 2:
                known |= {at: True for at in self.at[bisect_right(self.at, r["a"]):bisect_left(self.at, r["b"])]}
        self.at = sorted(known)
        self.after = [known[at] for at in self.at]


def minimax_cuts(sums: DataFrame, total: int, shards: int, marks: int = MARKS) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the running sums at which its greedy stretches end."""
    table = Marks(total)
    while stretches := table.open_stretches(shards):
        table.refine(sums, stretches, marks)
    capacity = table.smallest(shards, False)
    return capacity, table.cuts(capacity, shards, False)


def oversized(groups: DataFrame, total: int, shards: int) -> list[tuple[int, int, int]]:
    """``h1, h2, bytes`` of groups larger than an even share of the bytes and shards that are left."""
    found: list[tuple[int, int, int]] = []
    while len(found) < shards - 1:
        share = (total - sum(x[2] for x in found)) / (shards - len(found))
        # those above an even share are fewer than the shards left
        larger = groups.filter(F.col("bytes") > share).orderBy(F.col("bytes").desc(), "h1", "h2").limit(shards).collect()
        new = [tuple(r) for r in larger if tuple(r) not in found]
        if not new:
            break
        found = (found + new)[:shards - 1]
    return found


def shard(docs: DataFrame, shards: int = SHARDS, marks: int = MARKS) -> DataFrame:
    """One row per document with its shard and its place there."""
    text = F.coalesce("text", F.lit(""))
    thin = stage(docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
                             F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("h1"),
                             F.xxhash64(F.lit("text"), text).alias("h2")), "sizes")
    groups = stage(thin.groupBy("h1", "h2").agg(F.sum("size").alias("bytes")), "text_groups")
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    alone = oversized(groups, total, shards)
    key = F.struct("h1", "h2")
    point = lambda a, b: F.struct(F.lit(a).cast("long").alias("h1"), F.lit(b).cast("long").alias("h2"))
    # each shard's last group is its cut; later stretches may be empty and then add nothing
    rest = groups.filter(~key.isin([point(a, b) for a, b, _ in alone])) if alone else groups
    sums, left = running_sums(rest), total - sum(x[2] for x in alone)
    _, cuts = minimax_cuts(sums, left, shards - len(alone), marks)
    ends = sorted((r["h1"], r["h2"]) for r in sums.filter(F.col("upto").isin(sorted(set(cuts)))).select("h1", "h2").collect())
    number = F.lit(len(alone))
    for a, b in ends[:-1]:
        number = number + (key > point(a, b)).cast("int")
    for k, (a, b, _) in enumerate(alone):
        number = F.when(key == point(a, b), k).otherwise(number)
    placed = numbered(thin.withColumn("shard", number.cast("int")), F.col("shard"), F.col("h1"), F.col("h2"), F.col("doc_id"))
    first = Window.orderBy("shard")
    counts = thin.select(number.cast("int").alias("shard")).groupBy("shard").count()
    starts = counts.select(F.col("shard").alias("of"), (F.sum("count").over(first) - F.col("count")).alias("start"))
    return placed.join(F.broadcast(starts), placed["shard"] == starts["of"]).select(  # a row per shard
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("number") - F.col("start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
