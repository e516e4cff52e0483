"""Best-fit packing with Martello-Toth dominance reduction.

Documents become token ids (closed by an end id) and pieces of at most ``capacity`` ids; only
longer documents are cut, and only the first piece may be shorter. All lengths lie between 1 and
``capacity``, so the whole corpus is packed as one instance on its histogram of lengths: at most
``capacity`` counts reach the driver, whatever the corpus.

On the histogram, item sets that dominate every other choice for the largest open length are fixed with
their full multiplicity (``reduce_dominated``), and the remainder is packed best-fit decreasing (``best_fit``). The result
is a short list of patterns; each place in a pattern takes a range of the ranks of its length. Ranks are given
inside each tokenizing task and shifted by the counts of earlier tasks, so no length is gathered anywhere.

Defined cases: a NULL or empty text is the end id alone; repeated rows are packed each for itself; ties in
length go by task and order of reading; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenmeld.session import stage

CAPACITY = 1024
END = 2
#: Texts with this marker, or with letters beyond the Latin blocks, go through the slower of the two encoders.
MARKER = "<|endoftext|>"
BEYOND_LATIN = re.compile("[^\x00-ɏ]")
_encoders: dict[str, object] = {}


def encoder(path: str, ranks: str, pattern: str):
    """Function from texts to ids, made once per worker.

    Both libraries give the ids of the same byte-level vocabulary; the one that reads ranks is four times as fast. The
    other keeps its say where they could differ: marker strings and newer Unicode tables.
    """
    if path not in _encoders:
        import tiktoken
        from tokenizers import Tokenizer

        full = Tokenizer.from_file(path)
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        quick = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=table, special_tokens={})

        def encode(text: str) -> list[int]:
            if MARKER in text or BEYOND_LATIN.search(text):
                return full.encode(text, add_special_tokens=False).ids
            return quick.encode_ordinary(text)
        _encoders[path] = encode
    return _encoders[path]


def pieces(docs: DataFrame, path: str, ranks: str, pattern: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """One row per piece, with its task and its rank among the task's pieces of equal length."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = encoder(path, ranks, pattern), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows: list[tuple] = []
            for at, text in enumerate(batch.column("text").to_pylist()):
                ids = np.array([*encode(text or ""), end], "<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((at, k, a, b - a, zlib.crc32(ids[a:b].tobytes()), task, seen[b - a]))
                    seen[b - a] += 1
            cols = list(zip(*rows)) or [()] * 7
            types = (pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64())
            made = [pa.array(c, t) for c, t in zip(cols, types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(made[0]), *made[1:]],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, rank long")


def reduce_dominated(counts: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix sets that dominate all other sets with the largest open length; lowers ``counts`` in place.

    For a length and the room it leaves: alone if nothing else fits; with the largest that fits if that fills the room,
    if no two others fit, or if no two that fit are together larger; with the best pair if at most two others fit, the pair
    holds the largest that fits, and no pair strictly between its lengths fits.
    """
    fixed = []

    def smallest(n: int, skip: int, above: int = 0, below: int = capacity + 1) -> list[int]:
        found = []
        for x in range(above + 1, below):
            found += [x] * min(n - len(found), counts[x] - (x == skip))
            if len(found) == n:
                break
        return found

    def choose(top: int) -> tuple[int, ...] | None:
        room = capacity - top
        low = smallest(3, top)
        if not low or low[0] > room:
            return (top,)
        single = next(x for x in range(room, 0, -1) if counts[x] - (x == top) > 0)
        if top + single == capacity or len(low) < 2 or low[0] + low[1] > room:
            return (top, single)
        if len(low) == 3 and sum(low) <= room:
            return None
        pair, b = (0, 0), 1
        for a in range(room, 0, -1):
            if counts[a] - (a == top) > 0:
                b = next((x for x in range(min(a, room - a), 0, -1)
                          if counts[x] - (x == top) - (x == a) > 0), 0)
                if b and a + b > sum(pair):
                    pair = (a, b)
        a, b = pair
        if single >= a + b:
            return (top, single)
        between = smallest(2, top, b, a)
        if single == a and (len(between) < 2 or sum(between) > room):
            return (top, a, b)
        return None

    changed = True
    while changed:
        changed = False
        for top in range(capacity, 0, -1):
            while counts[top] > 0 and (items := choose(top)):
                times = min(counts[x] // n for x, n in Counter(items).items())
                for x in items:
                    counts[x] -= times
                fixed.append((items, times))
                changed = True
    return fixed


def best_fit(counts: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: bins that look alike are filled together."""
    rooms: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    rooms_full = []
    for size in range(capacity, 0, -1):
        left = counts[size]
        while left:
            room = next((r for r in range(size, capacity + 1) if rooms[r]), None)
            items, bins = rooms[room].pop() if room is not None else ((), left)
            room = capacity if room is None else room
            each = room // size
            used = min(bins, left // each)
            if not used:
                each, used = left, 1
            if items and bins > used:
                rooms[room].append((items, bins - used))
            rooms[room - each * size].append((items + (size,) * each, used))
            left -= each * used
    for group in rooms:
        rooms_full += group
    return rooms_full


def places(counts: list[int], capacity: int) -> tuple[np.ndarray, ...]:
    """Sorted ``length << 44 | first rank``, first sequence and offset of every place, and the last."""
    counts = list(counts)
    patterns = reduce_dominated(counts, capacity)
    patterns += best_fit(counts, capacity)
    rows, used, sequence = [], Counter(), 0
    for items, times in patterns:
        offset = 0
        for size in items:
            rows.append((size << 44 | used[size], sequence, offset))
            used[size] += times
            offset += size
        sequence += times
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3


def pack(docs: DataFrame, path: str, ranks: str, pattern: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Pieces of all rows with ``sequence_id`` and ``offset``."""
    rows = stage(pieces(docs, path, ranks, pattern, capacity, end), "pieces")
    counts = [0] * (capacity + 1)
    for size, n in rows.groupBy("length").count().collect():  # at most one row per possible length
        counts[size] = n
    keys, sequences, offsets = places(counts, capacity)
    tasks = rows.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    shifted = rows.join(tasks.select("task", "length", before.alias("before")), ["task", "length"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy()
            at = np.searchsorted(keys, key, "right") - 1
            names = [c for c in batch.schema.names if c != "key"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequences[at] + key - keys[at]), pa.array(offsets[at])],
                [*names, "sequence_id", "offset"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return shifted.select("doc_id", "piece", "start", "length", "ids_crc32",
                          (F.shiftleft("length", 44).bitwiseOR(F.col("rank") + F.col("before"))).alias("key")).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
