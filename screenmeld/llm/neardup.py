"""MinHash near-dedup verified by odd sketches.

1. Every text becomes the set of its distinct word shingles (64-bit hashes). Equal sets are one class, so exact
   copies cost one row however many there are.
2. MinHash samples of a class are banded (``bands`` x ``rows``; a pair at similarity 0.8 is missed with
   probability ``(1 - 0.8**rows)**bands``, 7e-6) and folded into an odd sketch: each sample flips
   one bit, so the popcount of the XOR of two sketches estimates a high similarity.
3. Members of a band's bucket are compared with the bucket's smallest id, not with each other: first each with
   its smallest such hub, then with the others if they still lie in another component. In buckets that still span components,
   up to ``HUBS`` members of the smallest ones are compared with all members of other components that are within reach and
   are then done; this goes on until no bucket spans two. Reach is a bound from the shingles that a text shares with no
   other one still open: heavily edited copies leave before any pair is looked at. Buckets are dealt in chunks of members that
   meet the hubs inside a task, so rows grow with the members, and no link between components is left out.
4. Pairs whose sketches are further apart than all but ``MISS`` of the pairs at the threshold are dropped, which most pairs of a
   similarity under 0.6 are; the rest are confirmed on the full sets. Components follow by least labels and pointer jumping.

Defined cases: a text with fewer words than a shingle is one shingle of all its words; NULL, empty or wordless
texts have an empty set and link with nothing; rows that share a doc_id are one document; a NULL doc_id gets no
component and is kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenmeld.llm.text import map_values, partitions_of
from screenmeld.session import stage

BANDS, ROWS = 30, 5
SKETCH_BITS = 1024
#: Probability that the sketches drop a pair that just reaches the threshold.
MISS = 1e-6
HUBS = 256
CHUNK = 256
MEMBER = ["band", "node", "label", "n", "reach"]
CACHE_WORDS = 1_000_000


class _Words(dict):
    """64-bit hashes of words, kept for the worker's next texts up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(raw: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of one UTF-8 text."""
    found = (raw or b"").lower().split()
    ids = np.fromiter(map(_words.__getitem__, found), np.uint64, len(found))
    size = min(words, len(ids))
    if not size:
        return ids
    made = np.zeros(len(ids) - size + 1, np.uint64)
    for k in range(size):
        made = _mix(made + np.uint64(0x9E3779B97F4A7C15) + ids[k:len(ids) - size + 1 + k])
    return np.unique(made)


class _Signer:
    def __init__(self, words: int, bands: int, rows: int) -> None:
        rng = np.random.default_rng(2024)
        k = bands * rows
        self.words, self.bands, self.rows = words, bands, rows
        self.flip = rng.integers(0, 1 << 32, (k, 1), np.uint64).astype(np.uint32)
        self.times = (rng.integers(0, 1 << 31, (k, 1), np.uint64) * 2 + 1).astype(np.uint32)
        self.salt = _mix(np.arange(1, k + 1, dtype=np.uint64))

    def __call__(self, raws: list[bytes | None]) -> list[tuple]:
        return [self.sign(raw) for raw in raws]

    def sign(self, raw: bytes | None) -> tuple:
        found = shingle_set(raw, self.words)
        if not len(found):
            return 0, None, None, None, None
        digest = xxhash.xxh3_128_digest(found.tobytes())
        d1, d2 = np.frombuffer(digest, np.int64).tolist()
        short = (found >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.flip), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(short), 1024):
            np.minimum(least, (((short[at:at + 1024] ^ self.flip) * self.times)
                               ^ self.flip).min(axis=1), out=least)
        samples = _mix(least.astype(np.uint64) + self.salt)
        keys = np.zeros(self.bands, np.uint64)
        for column in samples.reshape(self.bands, self.rows).T:
            keys = _mix(keys + column)
        bits = np.bincount((samples % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
        sketch = np.packbits(bits.astype(np.uint8)).view(np.int64)
        return len(found), d1, d2, keys.view(np.int64).tolist(), sketch.tolist()


def signatures(docs: DataFrame, words: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, d1, d2`` (digest of the set), ``bands`` and ``sketch`` for every row."""
    raw = docs.select("doc_id", F.col("text").cast("binary").alias("raw"))
    return map_values(raw, "raw", lambda: _Signer(words, bands, rows),
                      "n_shingles long, d1 long, d2 long, bands array<long>, sketch array<long>")


def most_apart(threshold: float, samples: int, miss: float = MISS) -> float:
    """Differing bits that the sketches of a pair at ``threshold`` exceed with probability ``miss``.

    Samples differ independently, each of them throws two items at the bits, and items that meet cancel out.
    """
    items = 2 * samples * (1 - threshold)
    keep = (1 - 2 / SKETCH_BITS) ** items
    spread = math.sqrt(4 * samples * threshold * (1 - threshold) * keep**2 + 2 * items**2 / SKETCH_BITS)
    return SKETCH_BITS / 2 * (1 - keep) + NormalDist().inv_cdf(1 - miss) * spread


def far_apart(a: Column, b: Column, threshold: float, samples: int) -> Column:
    apart = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return apart > most_apart(threshold, samples)


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for the nodes of ``a, b`` links: the least id that can be reached."""
    both = stage(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnsRenamed({"node": "b", "label": "other"}), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("other").alias("near")))
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        fresh = stage(lower.join(up, "label").select("node", F.least("label", "up").alias("label"), "was"), "labels")
        labels = fresh.select("node", "label")
        if fresh.filter("label < was").isEmpty():
            return labels


def _exact(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full shingle sets reach the threshold."""
    side = lambda at: texts.select(F.col("node").alias(at), F.col("raw").alias(f"raw_{at}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None
        for batch in batches:
            hits = []
            for a, b in zip(batch.column("raw_a").to_pylist(), batch.column("raw_b").to_pylist()):
                if b != last:  # hubs come sorted, so a hub's set is made once in a row
                    last, kept = b, shingle_set(b, words)
                found = shingle_set(a, words)
                both = len(np.intersect1d(found, kept, assume_unique=True))
                hits.append(100 * both >= percent * (len(found) + len(kept) - both))
            out = batch.select(["a", "b"]).filter(pa.array(hits, pa.bool_()))
            yield from [out] if out.num_rows else []

    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "raw_a", "raw_b").mapInArrow(
        run, f"a {kind}, b {kind}")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _reach(nodes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``node, n, reach``: set size, and a bound on the size of sets that can reach the threshold.

    Shingles that no other of the nodes has cannot be shared. With ``u`` of them in a set of ``n``, a set of
    ``m`` shingles can reach the threshold only if ``percent * m <= 100 * n - (100 + percent) * u``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, raw in enumerate(batch.column("raw").to_pylist()):
                found = shingle_set(raw, words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").take(pa.array(np.full(len(found), at))), pa.array(found.view(np.int64))],
                    ["node", "shingle"])

    kind = nodes.schema["node"].dataType.simpleString()
    shingles = texts.join(nodes, "node", "left_semi").select("node", "raw").mapInArrow(run, f"node {kind}, shingle long")
    owned = shingles.groupBy("shingle").agg(F.count("*").alias("times"), F.min("node").alias("node"))
    alone = owned.filter("times = 1").groupBy("node").agg(F.count("*").alias("alone"))
    sized = shingles.groupBy("node").agg(F.count("*").alias("n"))
    reach = 100 * F.col("n") - (100 + percent) * F.coalesce("alone", F.lit(0))
    return sized.join(alone, "node", "left").select("node", "n", reach.alias("reach"))


def _against_hubs(members: DataFrame, hubs: DataFrame, texts: DataFrame, sketches: DataFrame, words: int,
                  percent: int, samples: int) -> DataFrame:
    """Confirmed links ``a, b`` between members and hubs of their bucket that lie in different components.

    A bucket is dealt in chunks of about ``CHUNK`` members, each with all hubs of the bucket ahead of its members. Pairs
    out of reach, with sketches too far apart, or between components that the chunk has linked already are passed over.
    """
    dealt = members.groupBy("band").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    own = members.join(dealt, "band").select(
        *MEMBER, F.pmod(F.xxhash64("node"), F.col("chunks")).alias("chunk"), F.lit(1).alias("turn"))
    ahead = hubs.join(dealt, "band").select(
        *MEMBER, F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("turn"))
    most = most_apart(percent / 100, samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, known, sets, table, joined = None, [], [], None, {}

        def top(label: int) -> int:
            while label in joined:
                label = joined[label]
            return label

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if place != (row["band"], row["chunk"]):
                    place, known, sets, table, joined = (row["band"], row["chunk"]), [], [], None, {}
                found = shingle_set(row["raw"], words)
                fact = (row["node"], row["label"], row["n"], row["reach"])
                sketch = np.array(row["sketch"], np.int64)
                if row["turn"] == 0:
                    known.append((*fact, sketch))
                    sets.append(found)
                    continue
                if table is None:
                    table = [np.array(c) for c in zip(*known)]
                node, label, n, reach = fact
                apart = np.bitwise_count((table[4] ^ sketch).view(np.uint64)).sum(axis=1)
                fits = ((table[1] != label) & (percent * table[2] <= reach) & (percent * n <= table[3]) & (apart <= most))
                for k in np.flatnonzero(fits):
                    x, y = top(label), top(int(table[1][k]))
                    if x == y:
                        continue
                    both = len(np.intersect1d(found, sets[k], assume_unique=True))
                    if 100 * both >= percent * (len(found) + len(sets[k]) - both):
                        out.append((node, int(table[0][k])))
                        joined[max(x, y)] = min(x, y)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, batch.schema.field("node").type) for c in zip(*out)], ["a", "b"])

    kind = members.schema["node"].dataType.simpleString()
    rows = own.unionByName(ahead).join(texts, "node").join(sketches, "node")
    return (rows.repartition(partitions_of(rows), "band", "chunk").sortWithinPartitions("band", "chunk", "turn")
            .mapInArrow(run, f"a {kind}, b {kind}"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    signed = stage(signatures(docs, words, bands, rows), "signed")
    nodes = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stage(nodes.groupBy("d1", "d2").agg(F.min("doc_id").alias("node")), "classes")
    heads = (nodes.join(classes.select(F.col("node").alias("doc_id"), "d1", "d2"), ["doc_id", "d1", "d2"])
             .dropDuplicates(["doc_id", "d1", "d2"]).select(F.col("doc_id").alias("node"), "bands", "sketch"))
    heads = stage(heads, "heads")
    placed = heads.select("node", F.explode("bands").alias("band"))
    shared = placed.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    buckets = stage(placed.join(shared.drop("n"), "band"), "buckets")
    inside = stage(buckets.select("node").distinct(), "inside")
    sketches = stage(heads.select("node", "sketch").join(inside, "node", "left_semi"), "sketches")
    texts = stage(docs.select(F.col("doc_id").alias("node"), F.col("text").cast("binary").alias("raw"))
                  .join(inside, "node", "left_semi"), "texts")
    links, labels = None, None

    def near(pairs: DataFrame) -> DataFrame:
        side = lambda at: sketches.select(F.col("node").alias(at), F.col("sketch").alias(f"s_{at}"))
        met = pairs.join(side("a"), "a").join(side("b"), "b")
        return met.filter(~far_apart(F.col("s_a"), F.col("s_b"), percent / 100, bands * rows)).select("a", "b")

    def linked(pairs: DataFrame) -> DataFrame:
        """Add confirmed pairs to the links and give the labels so far."""
        nonlocal links
        fresh = stage(pairs, "confirmed")
        if labels is not None and fresh.isEmpty():
            return labels
        links = fresh if links is None else links.union(fresh)
        return components(links)

    def parted(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """The pairs that lie in different components."""
        side = lambda at: labels.select(F.col("node").alias(at), F.col("label").alias(f"l_{at}"))
        return (pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
                .filter(F.coalesce("l_a", "a") != F.coalesce("l_b", "b")).select("a", "b"))

    spokes = stage(near(buckets.filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()),
                   "spokes")
    labels = linked(_exact(spokes.groupBy("a").agg(F.min("b").alias("b")), texts, words, percent))
    labels = linked(_exact(parted(spokes, labels), texts, words, percent))
    def spanning(rows: DataFrame) -> DataFrame:
        """Rows of buckets that still span two components, with the size of their component in the bucket."""
        sizes = rows.groupBy("band", "label").agg(F.count("*").alias("size"))
        spread = sizes.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
        return rows.join(spread, "band").join(sizes, ["band", "label"])

    rows_open = stage(spanning(_labelled(buckets.filter("node <> hub").select("band", "node"), labels)), "open")
    reach = stage(_reach(rows_open.select("node").distinct(), texts, words, percent), "reach")
    rows_open = rows_open.select("band", "node").join(reach, "node")
    ends = rows_open.groupBy("band").agg(F.min("n").alias("least"), F.max("reach").alias("most"))
    within = rows_open.join(ends, "band").filter(
        (percent * F.col("least") <= F.col("reach")) & (percent * F.col("n") <= F.col("most")))
    rows_open = within.select("band", "node", "n", "reach")
    while True:
        rows_open = stage(spanning(_labelled(rows_open, labels)), "open")
        if rows_open.isEmpty():
            break
        turn = Window.partitionBy("band").orderBy("size", "label", "node")
        hubs = stage(rows_open.withColumn("turn", F.row_number().over(turn)).filter(F.col("turn") <= HUBS)
                     .select(*MEMBER), "hubs")
        labels = linked(_against_hubs(rows_open.select(*MEMBER), hubs, texts, sketches, words, percent, bands * rows))
        rows_open = (rows_open.join(hubs.select("band", "node"), ["band", "node"], "left_anti")
                     .select("band", "node", "n", "reach"))

    found = classes.join(labels, "node", "left").select("d1", "d2", F.coalesce("label", "node").alias("found"))
    rows_ = signed.select("doc_id", "n_shingles", "d1", "d2").join(found, ["d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return rows_.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component; columns as they are."""
    gone = (near_duplicates(docs, **settings).filter("NOT kept")
            .select(F.col("doc_id").alias("_gone")).distinct())
    return docs.join(gone, docs["doc_id"] == F.col("_gone"), "left_anti")
