import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from oracle import compare, connect
from screenmeld.llm import line_dedup as L
from screenmeld.llm.queries import QUERIES, SQL

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    for doc_id, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            holders[k].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        drop = [len(key(x)) >= min_chars and len(h := holders[key(x)]) >= min_docs
                and doc_id != max((d for d in h if d is not None), default=None) for x in lines]
        out.append((doc_id, len(lines), sum(drop), "\n".join(x for x, d in zip(lines, drop) if not d)))
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("doc.doc_id", "n_lines", "n_dropped", "kept").collect()]


def order(rows):
    return sorted(rows, key=str)


def test_odd_rows_match_brute_force(odd):
    want = plain([(r.doc_id, r.text) for r in odd.collect()])
    assert order(rows_of(L.drop_repeated(odd))) == order(want)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (3, 2), (5, 3)])
def test_batches_and_levels_do_not_change_the_result(odd, batches, fanout):
    want = plain([(r.doc_id, r.text) for r in odd.collect()])
    assert order(rows_of(L.drop_repeated(odd, batches=batches, fanout=fanout))) == order(want)


def test_empty_table(empty):
    assert L.drop_repeated(empty).count() == 0
    assert L.without_repeated_lines(empty).columns == empty.columns


def test_columns_stay(odd):
    out = L.without_repeated_lines(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert out.filter("doc_id = 1").first().text is None
    assert out.filter("doc_id = 4").first().text == odd.filter("doc_id = 4").first().text


def batches_of(spark, runs):
    seen = defaultdict(list)
    for batch in range(9):
        keys = [(k % 7, k // 7, batch * 100 + k) for k in range(batch, batch + 20)]
        for a, b, d in keys:
            seen[a, b].append(d)
        runs.add(spark.createDataFrame(keys, "h1 long, h2 long, doc_id long"))
    return {k: (len(v), max(v)) for k, v in seen.items()}


def totals_of(runs):
    return sorted((r.h1, r.h2, r.docs, r["last"]) for r in runs.totals().collect())


def test_runs_hold_each_key_once_over_several_levels(spark):
    runs = L.LineRuns(spark, fanout=2)
    want = batches_of(spark, runs)
    assert totals_of(runs) == sorted((*k, *v) for k, v in want.items())
    assert len(runs.levels) > 3 and all(len(level) < 2 for level in runs.levels)
    assert sum(t.count() for t in runs.runs()) == len(want)
    names = [n for level in runs.levels for n in level]
    runs.drop()
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_the_anti_join_decides(spark, monkeypatch):
    frame = type(spark.range(1))
    join = frame.join
    runs = L.LineRuns(spark, fanout=2)
    monkeypatch.setattr(frame, "join", lambda self, other, on=None, how=None: (
        self if how == "left_anti" else join(self, other, on, how)))
    want = batches_of(spark, runs)
    assert totals_of(runs) != sorted((*k, *v) for k, v in want.items())


def test_rows_of_one_id_are_one_document(make):
    line = "a line of more than twenty characters"
    rows = [(1, line), (1, f"{line}\nx"), (1, line), (2, line), (3, "other")]
    docs = make(rows)
    assert order(rows_of(L.drop_repeated(docs))) == order(plain(rows))
    assert L.drop_repeated(docs).agg(F.sum("n_dropped")).first()[0] == 0


def test_query_matches_its_twin(spark):
    sf = "/root/testdata/sf0.001"
    verdict, n = compare(spark, connect(sf), QUERIES["op1_line_dedup"], SQL["op1_line_dedup"], sf)
    assert verdict == "ok" and n > 0


def test_plan_has_no_python(spark):
    plan = QUERIES["op1_line_dedup"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_kept_digest_is_of_the_kept_text(make):
    got = L.drop_repeated(make([(1, "x\ny")])).select(F.sha2("kept", 256).alias("s")).first().s
    assert got == hashlib.sha256(b"x\ny").hexdigest()
