import random
import zlib

import numpy as np
import pytest

from screenmeld.llm import packing as P
from screenmeld.llm.queries import QUERIES, vocabulary


def fewest(items, capacity):
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(at, bins):
        if len(bins) >= best[0]:
            return
        if at == len(items):
            best[0] = len(bins)
            return
        tried = set()
        for k in range(len(bins)):
            if bins[k] + items[at] <= capacity and bins[k] not in tried:
                tried.add(bins[k])
                bins[k] += items[at]
                go(at + 1, bins)
                bins[k] -= items[at]
        go(at + 1, [*bins, items[at]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(120))
def test_reduction_keeps_an_optimum_and_packing_is_whole(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 17, 30])
    items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
    counts = [items.count(x) for x in range(capacity + 1)]
    fixed = P.reduce_dominated(counts, capacity)
    rest = [x for x in range(capacity + 1) for _ in range(counts[x])]
    assert sum(n for _, n in fixed) + (fewest(rest, capacity) if rest else 0) == fewest(items, capacity)
    packed = fixed + P.best_fit(counts, capacity)
    assert sorted(x for group, n in packed for x in group * n) == sorted(items)
    assert all(sum(group) <= capacity for group, _ in packed)


def test_best_fit_equals_the_plain_rule():
    rng = random.Random(5)
    for _ in range(50):
        items = sorted((rng.randint(1, 40) for _ in range(60)), reverse=True)
        bins = []
        for x in items:
            fit = min((b for b in bins if b >= x), default=None)
            if fit is None:
                bins.append(40 - x)
            else:
                bins[bins.index(fit)] -= x
        got = P.best_fit([items.count(x) for x in range(41)], 40)
        assert sum(n for _, n in got) == len(bins)


def check(rows, docs):
    from tokenizers import Tokenizer
    full = Tokenizer.from_file(vocabulary()["path"])
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for doc_id, text in docs:
        ids = np.array([*full.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted(pieces[doc_id], key=lambda r: r.piece)
        assert sum(r.length for r in own) == len(ids)
        assert [r.start for r in own] == list(np.cumsum([0, *[r.length for r in own]])[:-1])
        assert all(r.length == 1024 for r in own[1:]) and all(r.length <= 1024 for r in own)
        assert all(zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for r in own)


def gapless(rows):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return sequences


def test_odd_rows(odd, make, empty):
    rows = P.pack(odd, **vocabulary()).collect()
    gapless(rows)
    single = odd.filter("doc_id IN (1, 2, 3, 4, 8, 9, 10)")
    check(P.pack(single, **vocabulary()).collect(), [(r.doc_id, r.text) for r in single.collect()])
    assert len([r for r in rows if r.doc_id == 7]) == 2  # a repeated row is packed twice
    assert P.pack(empty, **vocabulary()).count() == 0
    special = make([(1, "a <|endoftext|> b"), (2, "日本語 テキスト"), (3, "x" * 5000)])
    check(P.pack(special, **vocabulary()).collect(), [(r.doc_id, r.text) for r in special.collect()])


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op2_best_fit_packing"](spark, sf).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, docs)
    sequences = gapless(rows)
    assert len(sequences) <= 1.01 * -(-sum(r.length for r in rows) // 1024) + 1
