import hashlib
import random

from screenmeld.llm import fingerprints as P
from screenmeld.llm.queries import QUERIES


def check(rows, docs):
    assert len(rows) == len(docs)
    by_id = {r.doc_id: r for r in rows}
    docs = sorted(docs)
    for k, (doc_id, text) in enumerate(docs):
        text, after = text or "", docs[(k + 1) % len(docs)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, other = P.chunk_set(text), P.chunk_set(edited)
        r = by_id[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == P.fingerprint(own) and r.edited_fingerprint == P.fingerprint(other)
        assert r.near_edited == P.containment(own, other)
        assert r.near_next == P.containment(own, P.chunk_set(after))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op7_content_chunks"](spark, sf).collect(), docs)


def test_gaps_and_single_rows(make):
    for ids in ([5], [-7, 10**15], list(range(0, 4000, 37))):
        docs = [(k, f"text number {k} " * (k % 5)) for k in ids]
        check(P.compare_edited(make(docs)).collect(), docs)


def test_gear_marks_equal_the_rolling_hash():
    rng = random.Random(2)
    raw = bytes(rng.randrange(256) for _ in range(3000))
    marks, h = [], 0
    for b in raw:
        h = (h << 1) + int(P.GEAR[b]) & 0xFFFFFFFF
        marks.append(h)
    ends, start = [], 0
    while start < len(raw):
        end = next((k + 1 for k in range(start + P.SMALLEST - 1, min(start + P.AVERAGE, len(raw))) if marks[k] >> P.RARE == 0), 0)
        end = end or next((k + 1 for k in range(start + P.AVERAGE - 1, min(start + P.LARGEST, len(raw)))
                           if marks[k] >> P.COMMON == 0), min(start + P.LARGEST, len(raw)))
        ends.append(end)
        start = end
    assert P.boundaries(raw) == ends


def test_an_insertion_changes_few_chunks():
    rng = random.Random(6)
    text = " ".join(rng.choice("lorem ipsum dolor sit amet elit sed".split()) + str(rng.randrange(99)) for _ in range(2000))
    moved = text[:300] + "inserted words " + text[300:]
    assert P.containment(P.chunk_set(text), P.chunk_set(moved)) > 0.95
    assert P.containment({}, {}) == 1.0 and P.containment({}, {"a": 1}) == 0.0 and P.containment({"a": 1}, {}) == 0.0


def test_odd_rows(odd, empty):
    rows = P.compare_edited(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.fingerprint == "" for r in rows if r.doc_id in (1, 2))
    sevens = [r.fingerprint for r in rows if r.doc_id == 7]
    assert len(sevens) == 2 and len(set(sevens)) == 1
    assert P.compare_edited(empty).count() == 0
