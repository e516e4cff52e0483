"""Alignment of two tokenizers by divide and conquer at shared cuts.

A document is encoded twice: a space and its text by the byte-level vocabulary (A), the text by the piece vocabulary (B), which adds the
space. Byte offsets where a token of A and a token of B both end cut the two token lists into groups. They are found by divide and
conquer: from the middle of an interval outwards, ends of A are looked up among the ends of B by bisection; the common end that is met
first splits the interval, and both halves go on. Intervals without one, and those with a single token on a side, are leaf groups. All
open intervals of half a megabyte of text take each step together.

Inside a group every token of A meets the tokens of B whose bytes overlap it: one link for each stretch between two neighbouring ends of
either side. A link's weight is how many links of the whole corpus join the same two ids.

Only counts leave the tokenizing tasks: each document's row carries its distinct id pairs and how often each occurs; texts are never shuffled. Pair
counts are summed over the corpus. A pair with more than 1/``COMMON`` of all links is common: fewer than ``COMMON`` can be, so their counts
are broadcast. The others are joined by pair; none of them holds more than that share, so no key is hot. The highest count of each id of B has one row per
vocabulary entry and is broadcast.

Defined cases: NULL and empty texts, and texts whose joined token bytes differ from space and text on either side, have no tokens, zero
counts and an empty digest; rows that repeat a doc_id are kept apart and each counts; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenmeld.llm.packing import BEYOND_LATIN, MARKER
from screenmeld.session import stage

#: Most rows of the table of common pairs that is broadcast.
COMMON = 1_000_000
#: Bytes of text that are aligned together.
TOGETHER = 1 << 19
SHIFT = 20  # a pair of ids is one number: A's id above, B's below
_pairs: dict[str, Tokenizers] = {}


def byte_letters() -> dict[str, int]:
    """Letters that byte-level vocabularies use for bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Tokenizers:
    """Both encoders with the bytes of each id, made once per worker."""

    def __init__(self, path: str, ranks: str, pattern: str, pieces: str) -> None:
        import base64

        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        letters = byte_letters()
        with open(path, encoding="utf-8") as file:
            entries = json.load(file)
        ids = entries["model"]["vocab"] | {t["content"]: t["id"] for t in entries["added_tokens"]}
        self.bytes_a = [b""] * (max(ids.values()) + 1)
        for word, at in ids.items():
            self.bytes_a[at] = bytes(letters[c] for c in word) if all(c in letters for c in word) else word.encode()
        self.full = Tokenizer.from_file(path)
        self.full.encode_special_tokens = True
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        # reads the same vocabulary faster; the other has its say where the two could differ
        self.quick = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_file=pieces)
        piece = lambda k: (bytes([int(self.second.id_to_piece(k)[3:5], 16)]) if self.second.is_byte(k)
                           else self.second.id_to_piece(k).replace("▁", " ").encode())
        self.bytes_b = [piece(k) for k in range(self.second.get_piece_size())]

    def first_ids(self, text: str) -> list[int]:
        if MARKER in text or BEYOND_LATIN.search(text):
            return self.full.encode(text, add_special_tokens=False).ids
        return self.quick.encode_ordinary(text)


def tokenizers(**files: str) -> Tokenizers:
    if files["path"] not in _pairs:
        _pairs[files["path"]] = Tokenizers(**files)
    return _pairs[files["path"]]


def shared_cuts(a: np.ndarray, b: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Common ends of two ascending lists of ends by divide and conquer; ``docs`` are common ends to start from.

    Returns the positions in ``a`` and in ``b`` of every common end, in order, as two rows.
    """
    ends_a, ends_b = np.searchsorted(a, docs), np.searchsorted(b, docs)
    found = [np.stack([ends_a, ends_b])]
    # intervals: tokens a0..a1 and b0..b1, both ends included
    before = lambda x: np.concatenate([[0], x[:-1] + 1])
    a0, a1, b0, b1 = before(ends_a), ends_a, before(ends_b), ends_b
    while True:
        wide = (a1 > a0) & (b1 > b0)
        a0, a1, b0, b1 = a0[wide], a1[wide], b0[wide], b1[wide]
        if not len(a0):
            break
        middle = np.clip(np.searchsorted(a, (np.where(a0 > 0, a[a0 - 1], 0) + a[a1]) // 2), a0, a1 - 1)
        cut_a, cut_b = np.full(len(a0), -1), np.full(len(a0), -1)
        todo, away = np.arange(len(a0)), 0
        while len(todo):
            for sign in (1, -1) if away else (1,):
                at = middle[todo] + sign * away
                inside = (at >= a0[todo]) & (at < a1[todo]) & (cut_a[todo] < 0)
                rows, at = todo[inside], at[inside]
                there = np.searchsorted(b, a[at])
                same = b[there] == a[at]
                cut_a[rows[same]], cut_b[rows[same]] = at[same], there[same]
            away += 1
            todo = todo[(cut_a[todo] < 0) & ((middle[todo] - away >= a0[todo]) | (middle[todo] + away < a1[todo]))]
        split = cut_a >= 0
        a0, a1, b0, b1, cut_a, cut_b = (x[split] for x in (a0, a1, b0, b1, cut_a, cut_b))
        found.append(np.stack([cut_a, cut_b]))
        a0, a1 = np.concatenate([a0, cut_a + 1]), np.concatenate([cut_a, a1])
        b0, b1 = np.concatenate([b0, cut_b + 1]), np.concatenate([cut_b, b1])
    cuts = np.concatenate(found, axis=1)
    return cuts[:, np.argsort(cuts[0])]


class Aligner:
    """Rows of counts, digest and id pairs for batches of texts."""

    def __init__(self, words: Tokenizers) -> None:
        self.words = words
        self.size_a = np.array([len(x) for x in words.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in words.bytes_b], np.int64)
        # id texts with what follows them inside a group and at its end
        texts = lambda n, end: np.array([f"{k}{x}".encode() for x in (",", end) for k in range(n)], object)
        self.texts_a, self.texts_b = texts(len(self.size_a), "|"), texts(len(self.size_b), ";")

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of both sides for each text; None where there are none or their bytes aren't the text's."""
        second = self.words.second.encode([x or "" for x in texts], num_threads=1)
        out: list[tuple[list[int], list[int]] | None] = []
        for text, b in zip(texts, second):
            if not text:
                out.append(None)
                continue
            raw, a = f" {text}".encode(), self.words.first_ids(f" {text}")
            fits = (b"".join(map(self.words.bytes_a.__getitem__, a)) == raw
                    and b"".join(map(self.words.bytes_b.__getitem__, b)) == raw)
            out.append((a, b) if fits else None)
        return out

    def rows(self, texts: list[str | None]) -> list[tuple]:
        """``n_a, n_b, n_groups, n_links, groups_sha256``, distinct pairs and their numbers for each text."""
        coded = self.encode(texts)
        some = [x for x in coded if x]
        done = iter(self._aligned(some) if some else [])
        return [next(done) if x else (0, 0, 0, 0, "", [], []) for x in coded]

    def _aligned(self, coded: list[tuple[list[int], list[int]]]) -> Iterator[tuple]:
        ids_a, ids_b = (np.concatenate([np.array(x[k], np.int64) for x in coded]) for k in (0, 1))
        n_a, n_b = (np.cumsum([len(x[k]) for x in coded]) for k in (0, 1))
        a, b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        cuts = shared_cuts(a, b, a[n_a - 1])
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[cuts[0]], last_b[cuts[1]] = True, True
        # tokens in the order of groups, A before B in each
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        start_b, end_a = np.concatenate([[0], cuts[1][:-1] + 1]), cuts[0] + 1
        order = np.empty(len(a) + len(b), object)
        order[np.arange(len(a)) + start_b[group_a]] = self.texts_a[ids_a + last_a * len(self.size_a)]
        order[np.arange(len(b)) + end_a[group_b]] = self.texts_b[ids_b + last_b * len(self.size_b)]
        # one link for each stretch between two ends of either side: ends of A, and those of B that A doesn't share
        merged = np.argsort(np.concatenate([a, b[~last_b]]), kind="stable")
        of_a = merged < len(a)
        shared = np.concatenate([last_a, np.zeros(len(b) - len(cuts[0]), bool)])[merged]
        at_a, of_b = np.cumsum(of_a) - of_a, ~of_a | shared
        pairs = ids_a[at_a] << SHIFT | ids_b[np.cumsum(of_b) - of_b]
        groups = np.searchsorted(cuts[0], n_a - 1) + 1
        links = n_a + n_b - groups
        before = (0, 0, 0, 0)
        for now in zip(n_a, n_b, groups, links):
            text = b"".join(order[before[0] + before[1]:now[0] + now[1]].tolist())[:-1]
            own, times = np.unique(pairs[before[3]:now[3]], return_counts=True)
            yield (*(int(y - x) for x, y in zip(before, now)), hashlib.sha256(text).hexdigest(), own, times.astype(np.int32))
            before = now


def token_pairs(docs: DataFrame, **files: str) -> DataFrame:
    """Each row's counts and digest with the distinct ``pairs`` of linked ids and their ``times``; ``row`` tells rows apart."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    types = [*[pa.int64()] * 4, pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, seen = Aligner(tokenizers(**files)), TaskContext.get().partitionId() << 40
        for batch in batches:
            texts, start, size = batch.column("text"), 0, 0
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for k, n in enumerate(sizes):
                size += n
                if size < TOGETHER and k + 1 < len(sizes):
                    continue
                made = list(zip(*aligner.rows(texts[start:k + 1].to_pylist())))
                rows = pa.array(range(seen + start, seen + k + 1), pa.int64())
                yield pa.RecordBatch.from_arrays([rows, batch.column("doc_id")[start:k + 1],
                                                  *[pa.array(c, t) for c, t in zip(made, types)]], ["row", "doc_id", *names])
                start, size = k + 1, 0
            seen += len(sizes)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
             "pairs array<long>, times array<int>")


def align(docs: DataFrame, common: int = COMMON, **files: str) -> DataFrame:
    """One row per row of ``docs``: counts of tokens, groups and links, link weights and the digest of the groups."""
    rows = stage(token_pairs(docs, **files), "alignment")
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
    each = each.withColumnRenamed("pairs", "pair")
    sums = each.groupBy("pair").agg(F.sum("times").alias("count"))
    second = F.col("pair").bitwiseAND((1 << SHIFT) - 1)
    sums = stage(sums.withColumn("b", second), "pair_counts")
    highest = sums.groupBy("b").agg(F.max("count").alias("most"))  # a row per vocabulary entry
    total = sums.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    counts = sums.join(F.broadcast(highest), "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    often = counts.filter(F.col("count") * common > total)
    seldom = counts.filter(F.col("count") * common <= total)
    tried = each.join(F.broadcast(often), "pair", "left")
    weigh = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
             F.sum(F.col("times") * F.col("count")).alias("count_sum")]
    known = tried.filter(F.col("count").isNotNull()).groupBy("row").agg(*weigh)
    late = tried.filter(F.col("count").isNull()).select("row", "pair", "times")
    rest = late.join(seldom, "pair").groupBy("row").agg(*weigh)
    weights = known.unionByName(rest).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    kept = rows.drop("pairs", "times")
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return kept.join(weights, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", none("n_best"), none("count_sum"), "groups_sha256")
