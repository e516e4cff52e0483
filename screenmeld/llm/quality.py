"""Quality rules: compression bands over whole documents and fixed chunks.

A document is kept unless a plain rule fails (too few words, too many words inside repeated
three-word windows) or its zstandard ratio lies outside the band for its length, or more than
``CHUNK_SHARE`` of its 4 KiB chunks lie outside the chunk band. High ratios mean repetition,
low ones encoded or random bytes. Short texts compress less, hence limits by length.

What follows the last full chunk counts as one more chunk. It is out if the final 4 KiB lie outside the chunk band or if it
is longer than ``TAIL_BYTES`` and lies outside the band of a text of its length. Texts below 4 KiB have the whole ratio only.

Defined cases: NULL and empty texts have no words, ratio 0 and fail the plain rules; rows are judged one
by one, so ties, repeated rows and empty tables need no rule; other columns pass through unread.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenmeld.llm.text import map_values

#: Up to so many bytes, lowest and highest ratio of a whole document.
BANDS = ((300, 1.0, 1.9), (600, 1.12, 2.05), (1200, 1.2, 2.2), (2500, 1.3, 2.32), (5000, 1.4, 2.45),
         (10000, 1.5, 2.6), (30000, 1.5, 2.75), (float("inf"), 1.5, 2.95))
CHUNK_BYTES = 4096
CHUNK_BAND = (1.4, 2.75)
CHUNK_SHARE = 0.25
TAIL_BYTES = 1200
LEVEL = 3
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
INNER_BYTES = bytes(range(0x80, 0xC0))  # of UTF-8 characters beyond ASCII

COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, ratio double, n_chunks long, n_chunks_out long, kept boolean")


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice in the text."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    _, pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)
    _, at, counts = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    again = counts[at] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= again
    return int(covered.sum())


def band(size: int) -> tuple[float, float]:
    """Lowest and highest ratio of a text of so many bytes."""
    return next((low, high) for top, low, high in BANDS if size <= top)


def judge(raw: bytes | None, pack: zstandard.ZstdCompressor) -> tuple:
    """The columns of ``COLUMNS`` for one UTF-8 text."""
    raw = raw or b""
    words = raw.split()
    seen: set[bytes] = set()
    dup_lines = 0
    for line in raw.split(b"\n"):
        if line.strip(SPACE):
            dup_lines += line in seen
            seen.add(line)
    repeat = repeated_words(words)
    failed = len(words) < 50 or 100 * repeat > 50 * len(words)
    ratio = len(raw) / len(pack.compress(raw)) if raw else 0.0
    low, high = band(len(raw))
    chunks = len(raw) // CHUNK_BYTES
    out = 0
    for k in range(chunks):
        r = CHUNK_BYTES / len(pack.compress(raw[k * CHUNK_BYTES:(k + 1) * CHUNK_BYTES]))
        out += not CHUNK_BAND[0] <= r <= CHUNK_BAND[1]
    tail = raw[chunks * CHUNK_BYTES:]
    if chunks and tail:
        least, most = band(len(tail))
        chunks += 1
        out += not (CHUNK_BAND[0] <= CHUNK_BYTES / len(pack.compress(raw[-CHUNK_BYTES:])) <= CHUNK_BAND[1]
                    and (len(tail) <= TAIL_BYTES or least <= len(tail) / len(pack.compress(tail)) <= most))
    kept = not failed and low <= ratio <= high and out <= CHUNK_SHARE * chunks
    return (len(words), len(raw.translate(None, SPACE + INNER_BYTES)),
            len(raw) - len(raw.translate(None, SYMBOLS)), dup_lines, repeat, failed, ratio, chunks, out, kept)


def compression_bands(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``COLUMNS`` for every row."""
    def prepare():
        pack = zstandard.ZstdCompressor(level=LEVEL)
        return lambda raws: [judge(raw, pack) for raw in raws]

    return map_values(docs.select("doc_id", F.col("text").cast("binary").alias("raw")), "raw", prepare, COLUMNS)
