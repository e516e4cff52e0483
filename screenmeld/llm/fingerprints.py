"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes marks boundaries; chunking is normalised: up to the average size only the rarer
marks (1 in 256) cut, beyond it the commoner ones (1 in 16) do, and ``LARGEST`` bytes cut in any case. Marks depend on
the bytes around them alone, so an insertion changes the chunks near it and no others. A fingerprint is the set of chunk
digests with their lengths; ``containment`` is the share of a text, by length of its distinct chunks, found in the other.

``compare_edited`` sets each document against its next one by doc_id without a global window: documents
are dealt into id ranges cut at approximate quantiles, and the first document of each range is
sent to the range before it as well (the very first to the last), so texts are shuffled once.

Defined cases: NULL text is empty, an empty text has an empty fingerprint, and two empty ones are alike (1.0); NULL doc_id
sorts first; rows with one doc_id follow each other by text hash; a single row is its own next one; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenmeld.llm.text import partitions_of

SMALLEST, AVERAGE, LARGEST = 16, 64, 256
RARE, COMMON = 24, 28  # the top 8 or 4 bits of a hash are zero
RANGES_PER_TASK = 4
FIRST = -(1 << 63)
GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, np.uint64).astype(np.uint32)


def boundaries(raw: bytes) -> list[int]:
    """Ends of the chunks of one text."""
    mark = GEAR[np.frombuffer(raw, np.uint8)]
    for width in (1, 2, 4, 8, 16):  # from hashes over ``width`` bytes to hashes over twice as many
        wider = mark.copy()
        wider[width:] += mark[:-width] << np.uint32(width)
        mark = wider
    rare = (np.flatnonzero(mark >> np.uint32(RARE) == 0) + 1).tolist()
    common = (np.flatnonzero(mark >> np.uint32(COMMON) == 0) + 1).tolist()
    ends, start, size = [], 0, len(raw)
    while start < size:
        at = bisect_left(rare, start + SMALLEST)
        end = rare[at] if at < len(rare) and rare[at] <= start + AVERAGE else 0
        if not end:
            at = bisect_left(common, start + AVERAGE)
            end = min(common[at] if at < len(common) else size, start + LARGEST, size)
        ends.append(end)
        start = end
    return ends


def chunk_set(text: str) -> dict[str, int]:
    """Digest and length in bytes of every distinct chunk."""
    raw = text.encode("utf-8", "surrogatepass")
    found, start = {}, 0
    for end in boundaries(raw):
        found[xxhash.xxh3_64_hexdigest(raw[start:end])[:12]] = end - start
        start = end
    return found


def fingerprint(chunks: dict[str, int]) -> str:
    return " ".join(sorted(f"{digest}{size:03x}" for digest, size in chunks.items()))


def containment(inner: dict[str, int], outer: dict[str, int]) -> float:
    if not inner:
        return 0.0 if outer else 1.0
    return sum(size for digest, size in inner.items() if digest in outer) / sum(inner.values())


COLUMNS = [("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
           ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def _in_ranges(docs: DataFrame) -> DataFrame:
    """``doc_id, text, range, guest`` with each range's successor as its guest, placed and sorted by range."""
    tasks = partitions_of(docs)
    ranges = tasks * RANGES_PER_TASK
    key = F.coalesce("doc_id", F.lit(FIRST))
    shares = [k / ranges for k in range(1, ranges)]
    cut = docs.agg(F.percentile_approx(key, shares, max(10_000, 10 * ranges))).first()[0]
    cuts = np.unique(np.array(cut or [], np.int64))

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy(), "right").astype(np.int32))

    firsts = docs.groupBy(range_of(key).alias("range")).agg(F.min(key).alias("first")).orderBy("range").collect()
    starts = np.array([r["first"] for r in firsts], np.int64)  # one per range
    before = np.roll(np.array([r["range"] for r in firsts], np.int64), 1)

    @F.pandas_udf("array<int>")
    def ranges_of(keys: pd.Series) -> pd.Series:
        keys = keys.to_numpy()
        own = np.searchsorted(cuts, keys, "right")
        at = np.minimum(np.searchsorted(starts, keys), len(starts) - 1)
        # a guest's range is written as -1 - range
        return pd.Series([[o, -1 - before[k]] if starts[k] == x else [o] for o, k, x in zip(own, at, keys)])

    placed = docs.select("doc_id", "text", key.alias("key"), F.explode(ranges_of(key)).alias("to"))
    guest = F.col("to") < 0
    return (placed.select("doc_id", "text", "key", F.when(guest, -1 - F.col("to")).otherwise(F.col("to")).alias("range"),
                          guest.alias("guest"))
            .repartition(tasks, "range")
            .sortWithinPartitions("range", "guest", "key", F.xxhash64("text"), "text"))


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and its likeness to that and to the next text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the last own row, until its successor comes
        for batch in batches:
            ids, rows = [], []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "range", "guest")]
            for doc_id, text, place, guest in zip(*columns):
                text = text or ""
                chunks = chunk_set(text)
                if waiting and waiting[0] == place:
                    _, last_id, last, known = waiting
                    half = len(last) // 2
                    edited = last[:len(last) - half] + text[:half]
                    changed = chunk_set(edited)
                    ids.append(last_id)
                    rows.append((len(last), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                                 fingerprint(known), fingerprint(changed), containment(known, changed),
                                 containment(known, chunks)))
                waiting = None if guest else (place, doc_id, text, chunks)
            if rows:
                made = [pa.array(c, kind) for c, (_, kind) in zip(zip(*rows), COLUMNS)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("doc_id").type), *made],
                                                 ["doc_id", *(name for name, _ in COLUMNS)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _in_ranges(docs).mapInArrow(
        run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")
