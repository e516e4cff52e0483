import random

import numpy as np
import pytest

from screenmeld.llm import neardup as N
from screenmeld.llm.queries import QUERIES

KEYS = ["doc_id", "n_shingles", "component_id", "kept"]


def plain(rows, words, percent=80):
    """Components by comparing all pairs of sets."""
    sets = {}
    for doc_id, text in rows:
        found = (text or "").encode().lower().split()
        size = min(words, len(found))
        sets[doc_id] = {tuple(found[k:k + size]) for k in range(len(found) - size + 1)} if size else set()
    parent = {d: d for d in sets}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return sorted((d, len(sets[d]), top(d), top(d) == d) for d in ids)


def got(df, words):
    return sorted(tuple(r) for r in N.near_duplicates(df, words=words).select(*KEYS).collect())


@pytest.mark.parametrize("words", [1, 2, 5])
def test_chains_and_groups_match_brute_force(make, words):
    rng = random.Random(words)
    vocabulary = [f"w{k}" for k in range(300)]
    rows, n = [], 0
    for _ in range(12):
        text = [rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 40, 90]))]
        for _ in range(rng.randint(1, 12)):  # each copy is an edit of the one before: chains
            rows.append((n, " ".join(text)))
            n += 1
            text = list(text)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
    rng.shuffle(rows)
    assert got(make(rows), words) == plain(rows, words)


def test_one_hub_at_a_time(make, monkeypatch):
    """However few hubs a round takes, the components are the same."""
    monkeypatch.setattr(N, "HUBS", 4)
    rng = random.Random(9)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for n in range(40):
        text = list(base)
        for _ in range(rng.randint(0, 12)):
            text[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        rows.append((n, " ".join(text)))
    assert got(make(rows), 1) == plain(rows, 1)


def test_odd_rows(odd, empty):
    rows = {}
    for r in N.near_duplicates(odd, words=5).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert len([r for v in rows.values() for r in v]) == odd.count()
    for doc_id in (1, 2, 3):  # NULL, empty, wordless: linked with nothing
        assert rows[doc_id][0].n_shingles == 0 and rows[doc_id][0].component_id == doc_id and rows[doc_id][0].kept
    assert rows[12][0].component_id == 11 and rows[11][0].kept
    assert rows[None][0].component_id is None and rows[None][0].kept
    assert N.near_duplicates(empty).count() == 0
    kept = N.one_of_each(odd)
    assert kept.columns == odd.columns
    assert N.one_of_each(empty).count() == 0


def bits_apart(size, shared, times=150):
    """Differing bits of the sketches of random pairs of sets of ``size`` shingles, ``shared`` of them in both."""
    rng, signer, found = random.Random(size), N._Signer(1, N.BANDS, N.ROWS), []
    for _ in range(times):
        words = [str(rng.random()) for _ in range(2 * size - shared)]
        a, b = (np.array(signer.sign(" ".join(w).encode())[4]) for w in (words[:size], words[size - shared:]))
        found.append(int(np.bitwise_count((a ^ b).view(np.uint64)).sum()))
    return np.array(found)


@pytest.mark.parametrize("size,shared", [(9, 8), (90, 80), (450, 400)])
def test_sketches_keep_pairs_at_the_threshold(size, shared):
    apart = bits_apart(size, shared)
    most = N.most_apart(0.8, N.BANDS * N.ROWS)
    assert (apart <= most).all() and most - apart.mean() > 3.5 * apart.std()


@pytest.mark.parametrize("size,shared", [(9, 6), (90, 60), (450, 300)])
def test_sketches_drop_pairs_at_half(size, shared):
    assert (bits_apart(size, shared) > N.most_apart(0.8, N.BANDS * N.ROWS)).mean() > 0.95


def test_components_of_a_long_chain(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, 101), (102, 100)]
    random.Random(1).shuffle(links)
    labels = dict(tuple(r) for r in N.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert labels == {**{k: 0 for k in range(61)}, 100: 100, 101: 100, 102: 100}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = sorted(tuple(r) for r in QUERIES["op10_near_duplicates"](spark, sf).select(*KEYS).collect())
    assert rows == plain(docs, 2)
