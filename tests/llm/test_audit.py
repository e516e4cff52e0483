import random
import re
from collections import Counter
from itertools import permutations

import pytest

from oracle import compare, connect
from screenmeld.llm import audit as A
from screenmeld.llm import text as T
from screenmeld.llm.queries import QUERIES, SQL

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {f for f, test in {
        "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": re.search(r"[#$%&*|]", text)}.items() if test}


def brute(docs, labels):
    """Every order applied row by row."""
    rows = [(i, s or "", t or "") for i, t, s in docs]
    bad = [fails(t) | ({"E"} if i is not None and any(j is not None and j < i and u == t for j, _, u in rows) else set())
           for i, _, t in rows]
    out = {}
    for order in map("".join, permutations("ABCDE")):
        gone = [False] * len(rows)
        for step, f in enumerate(order, 1):
            for part in {s for _, s, _ in rows}:
                out[part, order, step] = Counter()
            for k, (i, part, _) in enumerate(rows):
                c = out[part, order, step]
                removed = f in bad[k] and not gone[k]
                c["removed"] += removed
                c["redundant"] += f in bad[k] and gone[k]
                c["unique_fails"] += bad[k] == {f}
                c["good_lost"] += removed and i is not None and (i, 1) in {(j, q) for j, q, _ in labels}
                c["toxic_lost"] += removed and i is not None and (i, 1) in {(j, x) for j, _, x in labels}
                gone[k] |= removed
                c["kept"] += not gone[k]
    total = Counter()
    for (part, order, step), c in out.items():
        total[part, order[step - 1]] += c["removed"]
    return {k: tuple(c[n] for n in COUNTS[:-1]) + (total[k[0], k[1][k[2] - 1]],) for k, c in out.items()}


def got(df):
    rows = df.collect()
    found = {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_its_twin(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    name = "op11_filter_audit"
    assert compare(spark, connect(sf_dir), QUERIES[name], SQL[name], sf_dir)[0] == "ok"


def cases():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["Ab", "c", "d$", "e", f"w{k}"]) for k in range(n)) for n in (3, 199, 200, 260)]
    texts += ["w " * 300, " ".join(f"w{k}" for k in range(250)), "", None, "  \n", "ABC", "é | ü"]
    docs = [(k, rng.choice(texts), rng.choice(["a", "b", None, ""])) for k in range(60)]
    docs += [(7, docs[7][1], docs[7][2]), (None, texts[0], "a"), (None, texts[0], "a"), (70, "other", "only")]
    labels = [(k, rng.randint(0, 1), rng.choice([0, 1, None])) for k in range(0, 60, 2)] + [(4, 1, 1), (None, 1, 1), (999, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("limits", [{}, {"PARTS": 3}, {"PARTS": 1}, {"BROADCAST_ROWS": 0}])
def test_brute_force_with_odd_rows(spark, make, monkeypatch, limits):
    if "PARTS" in limits:
        monkeypatch.setattr(A, "PARTS", limits["PARTS"])  # 1: nothing is hot
    else:
        monkeypatch.setattr(T, "BROADCAST_ROWS", limits.get("BROADCAST_ROWS", T.BROADCAST_ROWS))
    docs, labels = cases()
    rows = make([(i, t, "en", s) for i, t, s in docs])
    marks = spark.createDataFrame([(*x, "extra") for x in labels], "doc_id long, quality int, toxic int, text string")
    assert got(A.filter_interactions(rows, marks)) == brute(docs, labels)


def test_long_texts_and_empty_tables(spark, make, odd, empty):
    marks = spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int")
    long = make([(1, "Word " * 40_000), (2, "x" * 300_000), (3, "x" * 300_000), (4, "x" * 299_999 + "y")])
    table = got(A.filter_interactions(long, marks))
    assert table["a", "EABCD", 1] == (3, 1, 0, 0, 0, 0, 60)
    assert table["a", "ABCDE", 5][:3] == (0, 0, 1)
    assert got(A.filter_interactions(odd, marks.limit(0)))["a", "DCBAE", 1][0] > 0
    assert A.filter_interactions(empty, marks).count() == 0


def test_equal_hashes_of_different_texts_are_told_apart(spark, make, monkeypatch):
    docs = make([(1, "one"), (2, "two"), (3, "one"), (4, "two"), (5, "six")])
    named = docs.selectExpr("doc_id", "source AS part", "1L AS h1", "2L AS h2", "length(text) AS chars", "text")
    assert sorted(r.doc_id for r in A.repeated_texts(named, named.select("h1", "h2"), 5).collect()) == [3, 4]
