import re

import pytest

from screenmeld.llm import mixing as M
from screenmeld.llm.queries import QUERIES


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Fill levels by hand: cap, share the excess again, repeat."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped = set()
    while True:
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        total = sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and weight[s] * rest / total > most * sizes[s]} if total else set()
        if not over:
            return {s: most * sizes[s] if s in capped else weight[s] * rest / total for s in names}
        capped |= over


def test_query_targets_and_totals(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = QUERIES["op4_mix_sources"](spark, sf).collect()
        docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
        count = {d.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for d in docs}
        sizes, taken, largest = {}, {}, {}
        for r in rows:
            assert r["size"] == count[r.doc_id] and 0 <= r.taken <= 2 * r["size"]
            sizes[r.source] = sizes.get(r.source, 0) + r["size"]
            taken[r.source] = taken.get(r.source, 0) + r.taken
            largest[r.source] = max(largest.get(r.source, 0), r["size"])
        want = targets(sizes)
        for r in rows:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        for s, t in want.items():
            assert abs(taken[s] - t) <= largest[s] / 2 + 1


def test_reruns_agree(spark):
    run = lambda: sorted(tuple(r) for r in QUERIES["op4_mix_sources"](spark, "/root/testdata/sf0.001").collect())
    assert run() == run()


def test_odd_rows(odd, empty):
    plan = M.sample_plan(odd).collect()
    assert len(plan) == odd.count()
    assert {r.doc_id: r["size"] for r in plan if r.doc_id in (1, 2, 3)} == {1: 0, 2: 0, 3: 0}
    assert all(r.taken <= 2 * r["size"] for r in plan)
    mixed = M.mixed(odd)
    assert mixed.columns == odd.columns
    assert M.sample_plan(empty).count() == 0 and M.mixed(empty).count() == 0


def test_equal_documents_share_a_rate(make):
    # equal documents of one source: every other one is taken once more at rate 1.5
    docs = make([(k, "w " * 10, "en", "a") for k in range(400)])
    copies = [r.copies for r in M.sample_plan(docs).collect()]
    assert set(copies) == {1, 2} and sum(copies) == 600


def mean_copies(make, lean):
    docs = make([(k, "w " * (20 if k % 2 else 300), "en", "a" if k % 3 else "b") for k in range(3000)])
    sums, rates = {}, {}
    for r in M.sample_plan(docs, lean=lean).collect():
        sums.setdefault((r.source, r["size"]), []).append(r.copies)
        rates[r.source, r["size"]] = r.rate
    return {k: sum(v) / len(v) for k, v in sums.items()}, rates


def test_longer_documents_have_higher_odds(make):
    means, rates = mean_copies(make, 0.25)
    for key, mean in means.items():
        assert mean == pytest.approx(rates[key], abs=0.07)
    assert rates["a", 300] == 2 * rates["a", 20] and means["a", 300] > means["a", 20] + 0.3


def test_equal_odds_take_equal_shares(make):
    means, rates = mean_copies(make, 0)
    assert rates["a", 300] == pytest.approx(rates["a", 20])
    assert means["a", 300] == pytest.approx(means["a", 20], abs=0.1)


def test_rates_meet_the_target_within_the_limit(spark):
    rows = [("a", 3, 100), ("a", 5, 900), ("a", 9, 5000), ("a", 14, 40000), ("b", 2, 10), (None, 4, 300), (None, 7, 10)]
    sizes = spark.createDataFrame(rows, "source string, class int, size long")
    goal = {"a": 70_000.0, "b": 20.0, None: 100.0}
    total = {s: sum(n for t, _, n in rows if t == s) for s in goal}
    targets = spark.createDataFrame([(s, total[s], t) for s, t in goal.items()], "source string, source_size long, target double")
    got = M.inclusion_rates(sizes, targets, 2.0, 0.25).collect()
    assert len(got) == len(rows) and all(0 < r.rate <= 2 for r in got)
    for s, t in goal.items():
        assert sum(r.rate * r.words for r in got if r.source == s) == pytest.approx(t)
    rate = {r["class"]: r.rate for r in got if r.source is None}
    assert rate[7] / rate[4] == pytest.approx(2 ** 0.75)
